"""Areas that two polygons share, exactly and as expressions, and what tells clouds from frames and lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions import geometry as g

# What a cloud's outline must be, the zones of a sheet (x0, y0, x1, y1 as shares) whose outlines are no clouds, and frames.
LEAST_CORNERS, LEAST_BUMPS, LEAST_SOLID, MOST_ASPECT, LEAST_AREA, MOST_AREA = 6, 1.10, 0.15, 8.0, 800, 0.30
ZONES = {
    "title_block": (0.50, 0.82, 0.99, 1.00),
    "notes_block": (0.00, 0.78, 0.50, 1.00),
    "legend": (0.50, 0.72, 0.99, 0.82),
    "border_top": (0.00, 0.00, 1.00, 0.01),
    "border_bottom": (0.00, 0.98, 1.00, 1.00),
    "border_left": (0.00, 0.00, 0.01, 1.00),
    "border_right": (0.99, 0.00, 1.00, 1.00),
}
FRAME_RUN, SMOOTH_RUN, SMOOTH = 0.45, 0.10, 2.2


def flat(polygon: Column) -> Column:
    """A polygon's corners as one array x, y, x, y, ...: half the size of an array of structs."""
    return F.flatten(F.transform(polygon, lambda q: F.array(q["x"].cast("double"), q["y"].cast("double"))))


def _corners(polygons):
    """(values, first, n): an Arrow array of `flat` polygons' coordinates, of each the place of its first one and the number of its corners, 0 where it has under three."""
    import numpy as np

    ends = polygons.offsets.to_numpy()
    n = np.diff(ends) // 2 * polygons.is_valid().to_numpy(zero_copy_only=False)
    return polygons.values.to_numpy(zero_copy_only=False).astype(float), ends[:-1], np.where(n < 3, 0, n)


def _sides(table, rows, width: int):
    """(a, b, m, c, s) of polygons, a row of sides each: a side as y = m x + c from a to b, and whether the polygon lies below it (1) or above (-1); upright sides and those beyond a polygon's are empty (a = b)."""
    import numpy as np

    values, first, n = table
    at = first[rows, None] + 2 * np.minimum(np.arange(width), n[rows, None] - 1)
    x1, y1 = values[at], values[at + 1]
    x2, y2 = np.roll(x1, -1, axis=1), np.roll(y1, -1, axis=1)
    flat = x1 != x2
    m = np.where(flat, (y2 - y1) / np.where(flat, x2 - x1, 1.0), 0.0)
    turned = (x1 * y2 - x2 * y1).sum(axis=1, keepdims=True)
    return np.minimum(x1, x2), np.maximum(x1, x2), m, y1 - m * x1, np.where(x1 > x2, 1.0, -1.0) * np.sign(turned)


#: Numbers that a task holds at once of pairs of sides.
_PAIRS = 200_000


def _areas(a, b):
    import numpy as np
    import pyarrow as pa

    tables = _corners(a), _corners(b)
    wide = np.maximum(tables[0][2], tables[1][2])
    out = np.zeros(len(a))
    some = np.flatnonzero((tables[0][2] > 0) & (tables[1][2] > 0))
    some = some[np.argsort(wide[some], kind="stable")]
    at = 0
    while at < len(some):
        rows = some[at : at + max(1, _PAIRS // int(wide[some[at]]))]
        rows = rows[wide[rows] <= 2 * wide[rows[0]]]
        at += len(rows)
        p, q = (_sides(t, rows, int(t[2][rows].max())) for t in tables)
        total = np.zeros(len(rows))
        for k in range(p[0].shape[1]):
            ea, eb, em, ec, es = (v[:, k, None] for v in p)
            low, high = np.maximum(ea, q[0]), np.minimum(eb, q[1])
            d1, d2 = (em - q[2]) * low + ec - q[3], (em - q[2]) * high + ec - q[3]
            top, gap = np.maximum(d1, d2), np.abs(d1 - d2)
            mixed = top * top / np.where(gap > 0, 2 * gap, 1.0)
            above = np.where((d1 >= 0) & (d2 >= 0), (d1 + d2) / 2, np.where((d1 <= 0) & (d2 <= 0), 0.0, mixed))
            under = np.where(high > low, (high - low) * (em * (low + high) / 2 + ec - above), 0.0)
            total += es[:, 0] * (q[4] * under).sum(axis=1)
        out[rows] = np.maximum(total, 0.0)
    null = ~(a.is_valid().to_numpy(zero_copy_only=False) & b.is_valid().to_numpy(zero_copy_only=False))
    return pa.array(out, mask=null)


def shared_area(a: Column, b: Column) -> Column:
    """The area of the intersection of two simple polygons (arrays of x and y), convex or not; 0 under three corners.

    A polygon is the region under its upper sides less that under its lower ones, so the shared area is a signed sum over pairs of sides of the area
    under both; only sides above the same x meet. Null polygons give null. A batch of pairs is one matrix for each side."""
    return flat_area(flat(a), flat(b))


def flat_area(a: Column, b: Column) -> Column:
    """`shared_area` of polygons that are `flat`. It counts as not deterministic so that a filter on it doesn't compute it again."""
    return F.arrow_udf(_areas, "double").asNondeterministic()(a, b)


def centroid(polygon: Column) -> tuple[Column, Column]:
    """The centre of a polygon's area; the mean of its corners where it has none."""
    n = F.size(polygon)

    def part(i: Column) -> Column:
        p, q = F.get(polygon, i), F.get(polygon, (i + 1) % n)
        cross = (p["x"] * q["y"] - q["x"] * p["y"]).cast("double")
        return F.struct(cross.alias("a"), ((p["x"] + q["x"]) * cross).alias("x"), ((p["y"] + q["y"]) * cross).alias("y"))

    parts = F.transform(F.sequence(F.lit(0), n - 1), part)
    a, x, y = (_summed(parts, name) for name in ("a", "x", "y"))
    mean = [_summed(F.transform(polygon, lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))), name) / n for name in ("x", "y")]
    flat = F.abs(a) < 1e-6
    return F.when(flat, mean[0]).otherwise(x / F.nullif(3 * a, F.lit(0.0))), F.when(flat, mean[1]).otherwise(y / F.nullif(3 * a, F.lit(0.0)))


def _summed(parts: Column, name: str) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda z, e: z + e[name])


def aspect(polygon: Column) -> Column:
    """Longer over shorter side of a polygon's box, both counting the pixels at either end; 999 under one pixel."""
    b = g.polygon_box(polygon)
    w, h = b["x2"] - b["x1"] + 1, b["y2"] - b["y1"] + 1
    return F.when(F.least(w, h) < 1, 999.0).otherwise(F.greatest(w, h) / F.least(w, h))


def _thinned(points: list[tuple[float, float]], epsilon: float) -> list[tuple[float, float]]:
    """A closed outline without corners that lie up to epsilon off the line between their neighbours that stay: cut at its two farthest corners, then at the farthest from each chord."""
    if len(points) < 3:
        return points

    def far(k: int) -> int:
        return max(range(len(points)), key=lambda i: (points[i][0] - points[k][0]) ** 2 + (points[i][1] - points[k][1]) ** 2)

    start = far(0)
    ring = points[start:] + points[:start] + [points[start]]
    half = max(range(len(ring)), key=lambda i: (ring[i][0] - ring[0][0]) ** 2 + (ring[i][1] - ring[0][1]) ** 2)
    keep, todo = {0, half, len(ring) - 1}, [(0, half), (half, len(ring) - 1)]
    while todo:
        a, b = todo.pop()
        (ax, ay), (bx, by) = ring[a], ring[b]
        long = ((bx - ax) ** 2 + (by - ay) ** 2) ** 0.5
        worst, at = epsilon, None
        for i in range(a + 1, b):
            x, y = ring[i]
            d = abs((bx - ax) * (y - ay) - (by - ay) * (x - ax)) / long if long else ((x - ax) ** 2 + (y - ay) ** 2) ** 0.5
            if d > worst:
                worst, at = d, i
        if at is not None:
            keep.add(at)
            todo += [(a, at), (at, b)]
    return [ring[i] for i in sorted(keep)][:-1]


def _runs(polygons, epsilon):
    import pandas as pd

    out = []
    for polygon, e in zip(polygons, epsilon, strict=True):
        pts = [] if polygon is None else _thinned([(float(p["x"]), float(p["y"])) for p in polygon], float(e))
        out.append(max((((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) ** 0.5 for p, q in zip(pts, pts[1:] + pts[:1], strict=True)), default=0.0) if len(pts) > 1 else 0.0)
    return pd.Series(out)


def straight_run(polygon: Column, epsilon: float = 5.0) -> Column:
    """The longest straight run of an outline once corners up to epsilon off are dropped; the order-dependent cutting has no built-in."""
    return F.pandas_udf(_runs, "double", F.PandasUDFType.SCALAR)(polygon, F.lit(epsilon))


def is_frame(run: Column, bumps: Column, width: Column, height: Column) -> Column:
    """Whether an outline is a frame, a border or a long pipe: a run over 0.45 of the sheet's diagonal, or over 0.10 on a smooth outline."""
    diagonal = F.hypot(width, height)
    return (run > FRAME_RUN * diagonal) | ((run > SMOOTH_RUN * diagonal) & (bumps < SMOOTH))


def is_cloud(polygon: Column, hull: Column, width: Column, height: Column, any_zone: bool = False) -> Column:
    """Whether an outline may be a revision cloud: corners, bumps, solidity, aspect and area in range, and, unless any_zone, its centre outside the sheet's zones."""
    area, (x, y) = g.polygon_area(polygon), centroid(polygon)
    ok = (F.size(polygon) >= LEAST_CORNERS) & (g.scallopedness(polygon, hull) >= LEAST_BUMPS) & (g.solidity(polygon, hull) >= LEAST_SOLID) & (aspect(polygon) <= MOST_ASPECT) & (area >= LEAST_AREA) & (area <= MOST_AREA * width * height)
    if not any_zone:
        for x0, y0, x1, y1 in ZONES.values():
            ok = ok & ~(x.between(x0 * width, x1 * width) & y.between(y0 * height, y1 * height))
    return F.coalesce(ok, F.lit(False))
