"""Flow through junctions: known directions spread from line to line, first come first kept, and turn with the ends that meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.staging import new_folder, staged

DK = ["drawing_id"]


def _end(x: Column, y: Column) -> Column:
    """Whether a point is at the first end of an axis (a, b): it is unless b is strictly closer."""
    def far(p: str) -> Column:
        return F.hypot(F.col(p)["x"] - x, F.col(p)["y"] - y)

    return far("a") <= far("b")


def junction_links(meets: DataFrame, junctions: DataFrame, axes: DataFrame, by: list[str] = DK) -> tuple[DataFrame, DataFrame]:
    """(links, blocked) of lines (junction, line) that meet at junctions (junction, ord, x, y, degree), lines having an axis (line, a, b).

    links (p, q, ord, flip), both ways: two lines that a junction passes flow between; flip: they meet with like ends, so a direction along one
    axis is the opposite one along the other. blocked (junction, line): a junction of degree over 2, or of more than two lines, passes nothing.
    Lines without an axis don't count; one that meets a junction twice does so once."""
    at = meets.select(*by, "junction", "line").distinct().join(junctions.select(*by, "junction", "ord", "x", "y", "degree"), [*by, "junction"]).join(axes.select(*by, "line", "a", "b"), [*by, "line"])
    at = at.select(*by, "junction", "ord", "degree", "line", _end(F.col("x"), F.col("y")).alias("first"))
    sizes = at.groupBy(*by, "junction").agg(F.count(F.lit(1)).alias("n"), F.first("degree").alias("degree"), F.first("ord").alias("ord"), F.min(F.struct("line", "first")).alias("l"), F.max(F.struct("line", "first")).alias("r"))
    passes = (F.col("degree") <= 2) & (F.col("n") <= 2)
    pairs = sizes.where(passes & (F.col("n") == 2)).select(*by, "ord", F.col("l.line").alias("p"), F.col("r.line").alias("q"), (F.col("l.first") == F.col("r.first")).alias("flip"))
    links = pairs.select(*by, "p", "q", "ord", "flip").unionAll(pairs.select(*by, F.col("q").alias("p"), F.col("p").alias("q"), "ord", "flip"))
    blocked = at.join(sizes.where(~passes).select(*by, "junction"), [*by, "junction"], "left_semi").select(*by, "junction", "line")
    return links, blocked


def flow_propagation(seeds: DataFrame, meets: DataFrame, junctions: DataFrame, axes: DataFrame, by: list[str] = DK, max_rounds: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """(flow, split): directions (line, direction, evidence, hops) of all lines that flow reaches from seeds (line, direction, evidence, ord), and the
    junctions (junction) where it stops because it would split or merge.

    Seeds come in order of ord, of a line's several the first. From each line in turn flow passes its junctions in order of theirs (see
    `junction_links`) to lines whose direction isn't known yet; who is reached first comes first afterwards. That is a breadth-first walk, and
    the rounds are its levels: neighbours of a level lie in it, the one before or the next, so each round compares with two levels only,
    writes its own and leaves the plan as long as it was. A level's order is one sort by range, so a drawing isn't one task."""
    links, blocked = junction_links(meets, junctions, axes, by)
    links = staged(links, "links")
    folder = new_folder(links.sparkSession, "flow")
    first = seeds.join(axes.select(*by, "line"), [*by, "line"], "left_semi").groupBy(*by, "line").agg(F.min_by(F.struct("direction", "evidence"), "ord").alias("s"), F.min("ord").alias("o"))
    level = first.select(*by, "line", (F.col("s.direction") == "forward").alias("forward"), F.col("s.evidence").alias("evidence"), "o", F.lit(0).cast("long").alias("o2"))
    seen = None
    for hops in range(max_rounds):
        path = f"{folder}/level={hops}"
        level.orderBy(*by, "o", "o2", "line").select(*by, "line", "forward", "evidence", F.monotonically_increasing_id().alias("rank"), F.lit(hops).alias("hops")).write.parquet(path)
        level = links.sparkSession.read.parquet(path)
        if hops and level.isEmpty():
            break
        known = level.select(*by, F.col("line").alias("q"))
        near = links.join(level.select(*by, F.col("line").alias("p"), "forward", "rank"), [*by, "p"])
        near = near.join(known if seen is None else known.unionAll(seen), [*by, "q"], "left_anti")
        seen = known
        best = near.groupBy(*by, F.col("q").alias("line")).agg(F.min(F.struct("rank", "ord", (F.col("forward") != F.col("flip")).alias("forward"))).alias("s"))
        level = best.select(*by, "line", "s.forward", F.lit("propagated").alias("evidence"), F.col("s.rank").alias("o"), F.col("s.ord").cast("long").alias("o2"))
    else:
        raise RuntimeError(f"more than {max_rounds} levels")
    every = links.sparkSession.read.option("basePath", folder).parquet(folder).drop("level")
    flow = every.select(*by, "line", F.when(F.col("forward"), "forward").otherwise("reverse").alias("direction"), "evidence", "hops")
    split = blocked.join(flow.select(*by, "line"), [*by, "line"], "left_semi").select(*by, "junction").distinct()
    return flow, split
