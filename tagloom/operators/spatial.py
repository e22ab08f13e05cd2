"""Spatial joins on a grid: boxes go to the cells that they touch, pairs meet by equi-join on (drawing, cell), and a pair
counts in one cell alone (the later of the two first cells), so no pass removes duplicates. No plan has a product of rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import geometry as g

DK = ["drawing_id"]


def cells(df: DataFrame, box: str, cell: int, pad: float = 0) -> DataFrame:
    """df once for each grid cell that its box, grown by pad, touches: columns __cx, __cy and its first cell __x0, __y0."""
    b = F.col(box)

    def at(v: Column) -> Column:
        return F.floor(v / cell).cast("int")

    first = df.withColumn("__x0", at(b["x1"] - pad)).withColumn("__y0", at(b["y1"] - pad))
    wide = first.withColumn("__cx", F.explode(F.sequence(F.col("__x0"), F.greatest(F.col("__x0"), at(b["x2"] + pad)))))
    return wide.withColumn("__cy", F.explode(F.sequence(F.col("__y0"), F.greatest(F.col("__y0"), at(b["y2"] + pad)))))


def grid_join(left: DataFrame, right: DataFrame, radius: float, left_box: str = "box", right_box: str = "box", cell: int = 400, by: list[str] = DK) -> DataFrame:
    """(by, l struct, r struct): all pairs whose boxes, the left one grown by radius, touch. An exact predicate goes on top."""
    a, b = cells(left, left_box, cell, radius), cells(right, right_box, cell)
    la = a.select(*by, "__cx", "__cy", "__x0", "__y0", F.struct(*[F.col(c) for c in left.columns]).alias("l"))
    rb = b.select(*by, "__cx", "__cy", F.col("__x0").alias("__rx"), F.col("__y0").alias("__ry"), F.struct(*[F.col(c) for c in right.columns]).alias("r"))
    met = la.join(rb, [*by, "__cx", "__cy"]).where((F.col("__cx") == F.greatest("__x0", "__rx")) & (F.col("__cy") == F.greatest("__y0", "__ry")))
    lb, rr = F.col("l")[left_box], F.col("r")[right_box]
    near = (rr["x1"] <= lb["x2"] + radius) & (rr["x2"] >= lb["x1"] - radius) & (rr["y1"] <= lb["y2"] + radius) & (rr["y2"] >= lb["y1"] - radius)
    return met.where(near).select(*by, "l", "r")


def measured(pairs: DataFrame, **values: Column) -> DataFrame:
    """pairs with further columns, each computed once a pair. A filter on them stays behind the join, as they are a generator's output: moved into the join's
    condition, an expression is repeated wherever it is used."""
    return pairs.select("*", F.inline(F.array(F.struct(*[v.alias(k) for k, v in values.items()]))))


def nearest(left: DataFrame, right: DataFrame, radius: float, distance, node: str = "id", order: str = "ord", inclusive: bool = False, by: list[str] = DK, **names) -> DataFrame:
    """(by, node, nearest struct of right, distance): the right row at the least distance under radius; the first in order of several."""
    pairs = grid_join(left, right, radius, by=by, **names).withColumn("d", distance(F.col("l"), F.col("r")))
    first = F.when(F.col("d").isNotNull(), F.struct("d", F.col("r")[order]))
    best = pairs.groupBy(*by, F.col(f"l.{node}").alias(node)).agg(F.min_by("r", first).alias("nearest"), F.min("d").alias("distance"))
    return best.where(F.col("distance") <= radius if inclusive else F.col("distance") < radius)


def smallest_container(rows: DataFrame, holders: DataFrame, node: str = "id", order: str = "ord", pad: float = 0, by: list[str] = DK) -> DataFrame:
    """(by, node, holder): the smallest of the holders whose box contains a row's; never the row itself."""
    pairs = grid_join(rows, holders, pad, by=by).where(F.col("l")[node] != F.col("r")[node]).where(g.contains(F.col("r")["box"], F.col("l")["box"], pad))
    return pairs.groupBy(*by, F.col(f"l.{node}").alias(node)).agg(F.min_by(F.col("r")[node], F.struct(g.area(F.col("r")["box"]), F.col("r")[order])).alias("holder"))


def neighbours(rows: DataFrame, radius: float, most: int = 5, nearest_first: bool = False, node: str = "id", order: str = "ord", by: list[str] = DK) -> DataFrame:
    """(by, node, other, distance, rank): up to `most` rows whose centres lie within radius: the first in input order, or the nearest."""
    pairs = grid_join(rows, rows, radius, by=by).where(F.col("l")[node] != F.col("r")[node]).withColumn("d", g.center_distance(F.col("l")["box"], F.col("r")["box"])).where(F.col("d") <= radius)
    keys = [F.col("d"), F.col(f"r.{order}")] if nearest_first else [F.col(f"r.{order}")]
    rank = F.row_number().over(Window.partitionBy(*by, f"l.{node}").orderBy(*keys))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= most).select(*by, F.col(f"l.{node}").alias(node), F.col(f"r.{node}").alias("other"), F.round("d", 3).alias("distance"), "rank")


#: Pairs that a task holds of a cell at once.
_BLOCK = 500_000


def _nearest_ways(cell, window: float, most: int):
    """(l, r, way, rank) of a cell: its own rows (home) and, by direction, the nearest `most` of all rows in it, by distance, then id. l and r are places in the cell."""
    import numpy as np
    import pyarrow.compute as pc

    x1, y1, x2, y2 = (cell[c].to_numpy().astype(float) for c in ("__x1", "__y1", "__x2", "__y2"))
    code = np.asarray(pc.rank(cell["__node"].combine_chunks(), tiebreaker="dense"))
    x, y = (x1 + x2) / 2, (y1 + y2) / 2
    home = np.flatnonzero(cell["__home"].to_numpy(zero_copy_only=False))
    step = max(1, _BLOCK // len(code))
    for k in range(0, len(home), step):
        own = home[k : k + step]
        dx, dy = x[None, :] - x[own, None], y[None, :] - y[own, None]
        far = np.sqrt(dx * dx + dy * dy)
        i, r = np.nonzero((far <= window) & (code[None, :] != code[own, None]))
        l, d, u, v = own[i], far[i, r], dx[i, r], dy[i, r]
        over = (x1[l] < x2[r]) & (x2[l] > x1[r]) & (y1[l] < y2[r]) & (y2[l] > y1[r])
        way = np.where(over, 0, np.where(np.abs(u) >= np.abs(v), np.where(u >= 0, 1, 2), np.where(v >= 0, 3, 4)))
        order = np.lexsort((code[r], d, way, l))
        l, r, way = l[order], r[order], way[order]
        at = np.arange(len(l))
        new = np.r_[True, (l[1:] != l[:-1]) | (way[1:] != way[:-1])][: len(l)]
        rank = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
        near = rank <= most
        yield l[near], r[near], way[near], rank[near]


def directions(rows: DataFrame, window: float = 700, most: int = 5, node: str = "id", by: list[str] = DK) -> DataFrame:
    """(by, node, direction, other, rank): the nearest `most` rows in each direction within a window.

    Each row is at home in the cell that holds its centre, and is dealt to those that the window around its centre touches: so all that a row may
    meet is in one cell, and its nearest are chosen there. Pairs are neither shuffled nor sorted by Spark."""
    import pyarrow as pa

    b = F.col("box")
    x, y = g.center(b)
    corners = [b[c].cast("double").alias(f"__{c}") for c in ("x1", "y1", "x2", "y2")]
    spots = rows.select(*by, F.col(node).alias("__node"), *corners, F.struct(x.alias("x1"), y.alias("y1"), x.alias("x2"), y.alias("y2")).alias("__spot")).where("__node IS NOT NULL AND __spot.x1 IS NOT NULL AND __spot.y1 IS NOT NULL")
    size = max(1, math.ceil(4 * window))
    dealt = cells(spots, "__spot", size, window)
    at = [F.floor(F.col(f"__spot.{v}1") / size).cast("int") for v in ("x", "y")]
    dealt = dealt.select(*by, "__cx", "__cy", "__node", "__x1", "__y1", "__x2", "__y2", ((F.col("__cx") == at[0]) & (F.col("__cy") == at[1])).alias("__home"))
    kind = {f.name: f.dataType.simpleString() for f in dealt.schema}
    shape = ", ".join([f"`{c}` {kind[c]}" for c in by] + [f"`{node}` {kind['__node']}, direction string, other {kind['__node']}, rank int"])
    ways = pa.array(["overlaps", "right_of", "left_of", "below", "above"])

    def nearest_of(cell: pa.Table) -> pa.Table:
        parts = []
        for l, r, way, rank in _nearest_ways(cell, window, most):
            ends = [cell["__node"].take(pa.array(v)) for v in (l, r)]
            parts.append(pa.table([*[cell[c].take(pa.array(l)) for c in by], ends[0], ways.take(pa.array(way)), ends[1], pa.array(rank.astype("int32"))], names=[*by, node, "direction", "other", "rank"]))
        return pa.concat_tables(parts) if parts else pa.table([*[cell[c].slice(0, 0) for c in by], cell["__node"].slice(0, 0), ways.slice(0, 0), cell["__node"].slice(0, 0), pa.array([], pa.int32())], names=[*by, node, "direction", "other", "rank"])

    return dealt.groupBy(*by, "__cx", "__cy").applyInArrow(nearest_of, shape)


def pairs_by_iou(rows: DataFrame, least: float, node: str = "id", by: list[str] = DK) -> DataFrame:
    """(by, a, b, iou): unordered pairs whose boxes overlap by at least `least`."""
    pairs = grid_join(rows, rows, 0, by=by).where(F.col("l")[node] < F.col("r")[node]).withColumn("iou", g.iou(F.col("l")["box"], F.col("r")["box"]))
    return pairs.where(F.col("iou") >= least).select(*by, F.col(f"l.{node}").alias("a"), F.col(f"r.{node}").alias("b"), F.round("iou", 6).alias("iou"))


def in_regions(rows: DataFrame, regions: DataFrame, by: list[str] = DK) -> DataFrame:
    """rows whose centre lies in a region's polygon (columns box, polygon): semi-join behind the grid."""
    x, y = g.center(F.col("box"))
    spots = rows.withColumn("__spot", F.struct(x.alias("x1"), y.alias("y1"), x.alias("x2"), y.alias("y2")))
    hit = grid_join(spots, regions, 0, left_box="__spot", by=by).where(g.point_in_polygon(F.col("l")["__spot"]["x1"], F.col("l")["__spot"]["y1"], F.col("r")["polygon"]))
    return rows.join(hit.select(*by, F.col("l.id").alias("id")).distinct(), [*by, "id"], "left_semi")


def overlapping_tiles(tiles: DataFrame, regions: DataFrame, by: list[str] = DK) -> DataFrame:
    """Tiles that a region's box overlaps (strictly)."""
    hit = grid_join(tiles, regions, 0, by=by).where(g.overlaps(F.col("l")["box"], F.col("r")["box"]))
    return tiles.join(hit.select(*by, F.col("l.id").alias("id")).distinct(), [*by, "id"], "left_semi")


def band_density(rows: DataFrame, value: str, band: int = 15, by: list[str] = DK) -> DataFrame:
    """rows with `near`: how many others lie less than `band` away in `value` (an integer or half); a range window on twice the value."""
    twice = (2 * F.col(value)).cast("int")
    w = Window.partitionBy(*by).orderBy(twice).rangeBetween(-(2 * band - 1), 2 * band - 1)
    return rows.withColumn("near", F.count(F.lit(1)).over(w) - 1)


def endpoint_pairs(ends: DataFrame, low: float, high: float, by: list[str] = DK) -> DataFrame:
    """(by, p, q, distance): for each unordered pair of pipelines the least distance of two ends, between low and high. ends: id, line, box (a point)."""
    pairs = grid_join(ends, ends, high, by=by).where(F.col("l")["line"] < F.col("r")["line"]).withColumn("d", g.center_distance(F.col("l")["box"], F.col("r")["box"]))
    pairs = pairs.where((F.col("d") > low) & (F.col("d") <= high))
    return pairs.groupBy(*by, F.col("l.line").alias("p"), F.col("r.line").alias("q")).agg(F.round(F.min("d"), 3).alias("distance"))


def least_distances(rows: DataFrame, segments: DataFrame, radius: float, by: list[str] = DK) -> DataFrame:
    """(by, id, line, distance): the least distance of a row (id, box) to a line's segments (line, seg, box), up to radius.

    A distance bounds its group after the aggregate, here and in `nearest`: a filter on pairs is moved into the join's condition, which repeats what the
    expression shares until the compiled method is too large for the JVM to optimise."""
    pairs = grid_join(rows, segments, radius, by=by).withColumn("d", g.box_segment_distance(F.col("l")["box"], F.col("r")["seg"]))
    return pairs.groupBy(*by, F.col("l.id").alias("id"), F.col("r.line").alias("line")).agg(F.min("d").alias("distance")).where(F.col("distance") <= radius)


def hub_edges(equipment: DataFrame, segments: DataFrame, radius: float = 90, by: list[str] = DK) -> DataFrame:
    """(by, equipment, line, distance): every pipeline within radius of an equipment box. segments: id, line, seg, box."""
    near = least_distances(equipment.select(*by, "id", "box"), segments.select(*by, "line", "seg", "box"), radius, by)
    return near.select(*by, F.col("id").alias("equipment"), "line", F.round("distance", 3).alias("distance"))


def drive_hints(equipment: DataFrame, links: DataFrame, align: float = 90, gap: float = 700, by: list[str] = DK) -> DataFrame:
    """(by, a, b): pairs of equipment in line within `align`, at most `gap` apart, that share no pipeline. links: (by, equipment, line)."""
    pairs = grid_join(equipment, equipment, gap, by=by).where(F.col("l")["id"] < F.col("r")["id"])
    (ax, ay), (bx, by_) = g.center(F.col("l")["box"]), g.center(F.col("r")["box"])
    pairs = pairs.where((F.abs(ay - by_) <= align) | (F.abs(ax - bx) <= align)).where(g.edge_gap(F.col("l")["box"], F.col("r")["box"]) <= gap).select(*by, F.col("l.id").alias("a"), F.col("r.id").alias("b"))
    x, y = links.select(*by, F.col("equipment").alias("a"), "line"), links.select(*by, F.col("equipment").alias("b"), "line")
    shared = x.join(y, [*by, "line"]).where("a < b").select(*by, "a", "b").distinct()
    return pairs.join(shared, [*by, "a", "b"], "left_anti")


def adjacent_glyph(rows: DataFrame, factor: float = 1.5, by: list[str] = DK) -> DataFrame:
    """rows (id, symbol, tag boxes) with has_glyph: an own symbol apart from the tag, or another's in the window around the tag."""
    window = rows.withColumn("__pad", F.greatest(F.col("tag")["y2"] - F.col("tag")["y1"], F.lit(1)) * factor)
    t = F.col("tag")
    window = window.withColumn("box", F.struct((t["x1"] - F.col("__pad")).alias("x1"), (t["y1"] - F.col("__pad")).alias("y1"), (t["x2"] + F.col("__pad")).alias("x2"), (t["y2"] + F.col("__pad")).alias("y2")))
    own = g.glyph_is_distinct(F.col("symbol"), F.col("tag"))
    glyphs = rows.where(own).select(*by, "id", F.col("symbol").alias("box"))
    hit = grid_join(window.select(*by, "id", "box"), glyphs, 0, by=by).where(F.col("l")["id"] != F.col("r")["id"]).where(g.overlaps(F.col("l")["box"], F.col("r")["box"])).select(*by, F.col("l.id").alias("id")).distinct().withColumn("__hit", F.lit(True))
    return rows.join(hit, [*by, "id"], "left").withColumn("has_glyph", own | F.coalesce("__hit", F.lit(False))).drop("__hit")


def leader_lines(rows: DataFrame, leaders: DataFrame, direct: float = 80, radius: float = 20, by: list[str] = DK) -> DataFrame:
    """(by, id, leader, distance) of rows (id, box, tag_box): a symbol whose tag is at most `direct` away, edge to edge, has an implied leader line of that length; another has
    the leader line (ord, seg, box) nearest to its centre, under radius, if there is one. Rows without a tag box only have the latter."""
    gap = g.edge_gap(F.col("box"), F.col("tag_box"))
    marked = rows.select(*by, "id", "box", F.when(F.col("tag_box").isNotNull() & (gap <= direct), gap).alias("__gap"))
    x, y = g.center(F.col("box"))
    spots = marked.where("__gap IS NULL").select(*by, "id", F.struct(x.alias("x1"), y.alias("y1"), x.alias("x2"), y.alias("y2")).alias("box"))
    near = nearest(spots, leaders.select(*by, "ord", "seg", "box"), radius, lambda l, r: g.point_segment_distance(l["box"]["x1"], l["box"]["y1"], r["seg"]), by=by)
    out = marked.join(near.select(*by, "id", F.col("distance").alias("__d")), [*by, "id"], "left")
    d = F.coalesce("__gap", "__d")
    return out.select(*by, "id", d.isNotNull().alias("leader"), F.round(d, 3).alias("distance"))
