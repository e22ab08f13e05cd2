"""Traced pipelines that go on in neighbouring ones: groups that can meet by a fixed point, answers replayed in order inside each."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.graph import component_of
from tagloom.operators.repair import SURE
from tagloom.operators.spatial import grid_join
from tagloom.staging import merged, staged

DK = ["drawing_id"]


def _box(prefix: str = "") -> list:
    return [f(F.col(f"{prefix}box.{v}")).alias(v) for v, f in (("x1", F.min), ("y1", F.min), ("x2", F.max), ("y2", F.max))]


def meeting_groups(segments: DataFrame, active: DataFrame, reach: float, by: list[str] = DK, max_rounds: int = 60) -> DataFrame:
    """(by, line, group): lines that merges of the active ones (line) could bring together, whatever their order; other lines are their own.

    A group whose box, grown by reach, holds an end of another's segment (line, seg, box) takes it in, if it has an active line, and then has a larger box: a spatial
    join and a union in turn until nothing meets. Any box that merges can make lies in its group's, so groups are independent."""
    s = F.col("seg")
    points = F.array(*[F.struct(s[f"x{k}"].alias("x"), s[f"y{k}"].alias("y")) for k in (0, 1)])
    ends = segments.select(*by, "line", F.explode(points).alias("p")).select(*by, "line", F.struct(F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("p.x").alias("x2"), F.col("p.y").alias("y2")).alias("box"))
    lines = segments.groupBy(*by, "line").agg(*_box()).join(merged(active.select(*by, "line").distinct().withColumn("live", F.lit(True))), [*by, "line"], "left")
    now = staged(lines.select(*by, "line", F.col("line").alias("group"), F.struct("x1", "y1", "x2", "y2").alias("box"), F.coalesce("live", F.lit(False)).alias("live")), "groups")
    for _ in range(max_rounds):
        groups = now.groupBy(*by, "group").agg(*_box(), F.max("live").alias("live")).select(*by, "group", F.struct("x1", "y1", "x2", "y2").alias("box"), "live")
        own = ends.join(merged(now.select(*by, "line", "group")), [*by, "line"]).select(*by, "group", "box")
        met = grid_join(groups.where("live").select(*by, "group", "box"), merged(own), reach, by=by).where(F.col("l.group") != F.col("r.group")).select(*by, F.col("l.group").alias("a"), F.col("r.group").alias("b")).distinct()
        met = staged(met, "met")
        if met.isEmpty():
            return now.select(*by, "line", "group")
        joined = component_of(groups.select(*by, "group"), met, "group", by).select(*by, "group", F.col("root").alias("__to"))
        now = staged(now.join(merged(joined), [*by, "group"]).select(*by, "line", F.col("__to").alias("group"), "box", "live"), "groups")
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")


def _replay(segments: pd.DataFrame, traces: pd.DataFrame, snap: float, align: float) -> list[tuple]:
    """(ord, step, keep, drop) of a group's merges, and (ord, -1, line, None) for where each trace ends up."""
    segments = segments.sort_values("ord")
    line, pts = segments["line"].to_numpy().copy(), segments[["x0", "y0", "x1", "y1"]].to_numpy(dtype=float)
    low, high = pts.reshape(-1, 2, 2).min(axis=1), pts.reshape(-1, 2, 2).max(axis=1)
    box = {k: [*low[line == k].min(axis=0), *high[line == k].max(axis=0)] for k in set(line.tolist())}
    size = segments["line"].value_counts().to_dict()
    out = []
    for t in traces.sort_values("ord").itertuples():
        at, step = t.line, 0
        for side in t.directions if t.go and t.line in box else ():
            x1, y1, x2, y2 = box[at]
            hit = pd.Series(False, index=range(len(line)))
            for x, y in ((pts[:, 0], pts[:, 1]), (pts[:, 2], pts[:, 3])):
                high_ok, wide_ok = (y >= y1 - align) & (y <= y2 + align), (x >= x1 - align) & (x <= x2 + align)
                if side == "LEFT":
                    hit |= (x >= x1 - snap) & (x <= x1) & high_ok
                elif side == "RIGHT":
                    hit |= (x >= x2) & (x <= x2 + snap) & high_ok
                elif side == "UP":
                    hit |= (y >= y1 - snap) & (y <= y1) & wide_ok
                elif side == "DOWN":
                    hit |= (y >= y2) & (y <= y2 + snap) & wide_ok
            for other in dict.fromkeys(line[(hit.to_numpy()) & (line != at)].tolist()):
                if other not in box or other == at:
                    continue
                keep, drop = (at, other) if size[at] >= size[other] else (other, at)
                a, b = box[keep], box.pop(drop)
                box[keep] = [min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])]
                size[keep] += size[drop]
                line[line == drop] = keep
                out.append((t.ord, step, keep, drop))
                at, step = keep, step + 1
        out.append((t.ord, -1, at, None))
    return out


def trace_merges(segments: DataFrame, traces: DataFrame, snap: float = 50, align: float = 30, by: list[str] = DK) -> DataFrame:
    """(by, ord, step, keep, drop): what answers merge, and with step -1 the line at which each trace ends up.

    traces (line, ord, continues, confidence, directions) come in order of ord, unique in a drawing. One that goes on, with high or medium confidence, takes its directions in turn: the lines
    with a segment end beyond that side of its box, up to snap away and in line with it within align, in order of their segments, are
    merged with it; the one with more segments stays, of equal ones the traced, and the trace goes on as it, with its larger box. A trace whose
    line an earlier one took, or that has no segments, merges nothing. segments: (line, ord, type, seg, box); those whose type isn't a pipe, or without a line, are left out.

    Groups that can't meet (`meeting_groups`) are replayed apart, each in one task: at worst a drawing is one group."""
    pipes = segments.where(F.col("line").isNotNull() & F.contains(F.coalesce(F.col("type"), F.lit("")), F.lit("pipe"))) if "type" in segments.columns else segments.where(F.col("line").isNotNull())
    go = F.coalesce(F.col("continues"), F.lit(False)) & F.coalesce(F.lower(F.col("confidence")).isin(*SURE), F.lit(False))
    asked = traces.select(*by, "line", "ord", go.alias("go"), F.transform(F.coalesce("directions", F.array().cast("array<string>")), lambda d: F.upper(F.coalesce(d, F.lit("")))).alias("directions"))
    groups = staged(meeting_groups(pipes, asked.where("go"), max(snap, align), by), "groups")
    s = F.col("seg")
    left = pipes.join(merged(groups), [*by, "line"]).select(*by, "group", "line", "ord", *[s[v].cast("double").alias(v) for v in ("x0", "y0", "x1", "y1")])
    right = asked.join(merged(groups.withColumnRenamed("group", "__group")), [*by, "line"])  # traces of lines without segments end where they began
    kinds = {f.name: f.dataType.simpleString() for f in right.schema}
    shape = ", ".join([f"`{c}` {kinds[c]}" for c in by] + [f"ord {kinds['ord']}, step int, keep {kinds['line']}, drop {kinds['line']}"])

    def replayed(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        rows = _replay(a, b.rename(columns=lambda c: c[2:]), snap, align) if len(b) else []
        out = pd.DataFrame(rows, columns=["ord", "step", "keep", "drop"])
        for name, value in zip(by, key):
            out[name] = value
        if len(a) and a["line"].dtype.kind == "i":
            out = out.astype({"keep": "Int64", "drop": "Int64"})
        return out[[*by, "ord", "step", "keep", "drop"]]

    some = left.join(merged(right.select(*by, F.col("__group").alias("group")).distinct()), [*by, "group"], "left_semi")
    right = right.toDF(*[f"t_{c}" for c in right.columns])
    found = some.groupBy(*by, "group").cogroup(right.groupBy(*[f"t_{c}" for c in by], "t___group")).applyInPandas(replayed, shape)
    alone = asked.join(merged(groups.select(*by, "line")), [*by, "line"], "left_anti").select(*by, "ord", F.lit(-1).alias("step"), F.col("line").alias("keep"), F.lit(None).cast(kinds["line"]).alias("drop"))
    return found.unionAll(alone)


def valves_in_pipelines(candidates: DataFrame, traces: DataFrame, merges: DataFrame, by: list[str] = DK) -> DataFrame:
    """candidates (tag) with in_pipeline and in_pipeline_id: those whose tag, trimmed and in capitals, a trace names among its valves (ord, valves), with the line at which
    that trace ended up (`trace_merges`); of several traces the last. Blank tags are in none."""
    ends = merges.where("step = -1").select(*by, "ord", F.col("keep").alias("line"))
    named = traces.select(*by, "ord", F.explode("valves").alias("v")).select(*by, "ord", F.upper(F.trim(F.coalesce("v", F.lit("")))).alias("__key")).where("__key <> ''")
    last = named.join(ends, [*by, "ord"]).groupBy(*by, "__key").agg(F.max_by("line", "ord").alias("in_pipeline_id"))
    out = candidates.withColumn("__key", F.upper(F.trim(F.coalesce("tag", F.lit(""))))).join(last, [*by, "__key"], "left").drop("__key")
    return out.withColumn("in_pipeline", F.col("in_pipeline_id").isNotNull())
