"""Repair of pipelines from answers: an ordered log of merges, what it leaves of lines, segments and junctions, and elbow candidates."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import geometry as g
from tagloom.operators.graph import components
from tagloom.operators.spatial import grid_join
from tagloom.staging import staged

DK = ["drawing_id"]
# How sure an answer must be.
SURE = ("high", "medium")


def accepted(answers: DataFrame, verdict: str = "connected", says=True) -> DataFrame:
    """answers whose verdict is `says` (a word in any case) and whose confidence is high or medium (in any case); null verdicts and confidences aren't."""
    told = F.lower(F.col(verdict)) == says if isinstance(says, str) else F.col(verdict) == says
    return answers.where(told & F.lower(F.col("confidence")).isin(*SURE))


def _outcomes(rows: DataFrame, by: list[str]) -> DataFrame:
    """What entries (ord, kind, a, b, and of either line live and size) come to, on their own: (by, ord, kind, keep, drop, result, size)."""
    gap, both, one = F.col("kind") == "gap", F.col("alive_a") & F.col("alive_b"), F.col("a") == F.col("b")
    keep = F.when(gap, F.when(both, F.when(F.col("size_b") > F.col("size_a"), F.col("b")).otherwise(F.col("a")))).otherwise(F.when(F.col("alive_a"), F.col("a")).when(F.col("alive_b"), F.col("b")))
    drop = F.when(both & ~one, F.when(F.col("keep") == F.col("a"), F.col("b")).otherwise(F.col("a")))
    own = F.when(F.col("keep") == F.col("a"), F.col("size_a")).otherwise(F.col("size_b"))
    more = F.when(F.col("drop").isNull(), F.lit(0)).when(F.col("drop") == F.col("a"), F.col("size_a")).otherwise(F.col("size_b"))
    result = F.when(gap, F.when(F.col("keep").isNull(), "separate").otherwise("merged")).otherwise(F.when(F.col("keep").isNull(), "noise").otherwise("elbow"))
    made = rows.withColumn("keep", keep).withColumn("drop", drop)
    return made.select(*by, "ord", "kind", "keep", "drop", result.alias("result"), (own + more + F.when(gap, 0).otherwise(1)).alias("size"))


def _in_order(logs: Iterator[pd.DataFrame], group: list[str]) -> Iterator[pd.DataFrame]:
    """Entries group by group, in each in order, one after another; each brings what is known of its lines at the start. Only the lines of one group are held."""
    now, live, size = None, {}, {}
    for log in logs:
        out = []
        for own, kind, a, b, live_a, live_b, size_a, size_b in zip(zip(*(log[c] for c in group)), log.kind, log.a, log.b, log.alive_a, log.alive_b, log.size_a, log.size_b):
            if own != now:
                now, live, size = own, {}, {}
            for x, alive, n in ((a, live_a, size_a), (b, live_b, size_b)):
                live.setdefault(x, alive)
                size.setdefault(x, n)
            keep = drop = None
            if kind == "gap":
                if live[a] and live[b]:
                    keep, drop = (b, a) if size[b] > size[a] else (a, b)
            else:
                keep = a if live[a] else b if live[b] else None
                if keep is not None:
                    size[keep] += 1
                    other = b if keep == a else a
                    drop = other if other != keep and live[other] else None
            if drop is not None:
                size[keep] += size[drop]
                live[drop] = False
            out.append((keep, drop, ("separate" if keep is None else "merged") if kind == "gap" else "noise" if keep is None else "elbow"))
        yield log.assign(keep=[o[0] for o in out], drop=[o[1] for o in out], result=[o[2] for o in out])


def replay_merges(lines: DataFrame, log: DataFrame, by: list[str] = DK, rounds: int = 2) -> DataFrame:
    """(by, ord, kind, keep, drop, result) of every entry of a log (ord, kind, a, b) of lines (line, segments), in order of ord, which is unique in a drawing.

    A `gap` merges a and b unless an earlier entry removed one of them (separate): b stays if it has more segments, else a. An `elbow`
    gives one segment to a, or to b where a is gone (noise where both are), and merges the other, if it is still there, whatever their
    sizes; a and b may be one line. Entries that name other lines than `lines` find them gone.

    An entry can be decided as soon as it is the first undecided one of both its lines: such entries share no line, so a round
    decides them all at once, and entries between lines that are gone with them. Chains of entries that wait for each other longer than
    `rounds` are finished in order, a connected group of entries after another in a task, which holds the lines of one alone."""
    state = staged(lines.groupBy(*by, "line").agg(F.max("segments").cast("long").alias("size")).withColumn("alive", F.lit(True)), "lines")
    left = staged(log.select(*by, "ord", "kind", "a", "b"), "log")
    found: list[DataFrame] = []

    def known(rows: DataFrame, state: DataFrame) -> DataFrame:
        for x in ("a", "b"):
            rows = rows.join(state.select(*by, F.col("line").alias(x), F.col("alive").alias(f"alive_{x}"), F.col("size").alias(f"size_{x}")), [*by, x], "left")
        return rows.fillna({"alive_a": False, "alive_b": False, "size_a": 0, "size_b": 0})

    for _ in range(rounds):
        if left.isEmpty():
            break
        touched = left.select(*by, "ord", F.explode(F.array("a", "b")).alias("x")).groupBy(*by, "x").agg(F.min("ord").alias("first"))
        ready = left.join(touched.select(*by, F.col("x").alias("a"), F.col("first").alias("ord")), [*by, "a", "ord"], "left_semi").join(touched.select(*by, F.col("x").alias("b"), F.col("first").alias("ord")), [*by, "b", "ord"], "left_semi")
        done = staged(_outcomes(known(ready, state), by), "merges")
        grown = done.where("keep IS NOT NULL").select(*by, F.col("keep").alias("line"), F.col("size").alias("new"), F.lit(False).alias("lost"))
        gone = done.where("drop IS NOT NULL").select(*by, F.col("drop").alias("line"), F.lit(0).cast("long").alias("new"), F.lit(True).alias("lost"))
        state = staged(state.join(grown.unionAll(gone), [*by, "line"], "left").select(*by, "line", F.coalesce("new", "size").alias("size"), (F.col("alive") & ~F.coalesce("lost", F.lit(False))).alias("alive")), "lines")
        over = F.when(F.col("kind") == "gap", ~(F.col("alive_a") & F.col("alive_b"))).otherwise(~(F.col("alive_a") | F.col("alive_b")))
        rest = staged(known(left.join(done.select(*by, "ord"), [*by, "ord"], "left_anti"), state).withColumn("over", over), "log")
        found += [done, _outcomes(rest.where("over"), by)]
        left = rest.where("NOT over").select(*by, "ord", "kind", "a", "b")
    if not left.isEmpty():
        of = components(left, by).select(*by, F.col("node").alias("a"), F.col("root").alias("__group"))
        rows = known(left, state).join(of, [*by, "a"], "left").withColumn("__group", F.coalesce("__group", "a"))
        kinds = {f.name: f.dataType.simpleString() for f in left.schema}
        shape = ", ".join([f"`{c}` {kinds[c]}" for c in [*by, "ord", "kind"]] + [f"keep {kinds['a']}, drop {kinds['a']}, result string"])

        def finish(logs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for one in _in_order(logs, [*by, "__group"]):
                yield one[[*by, "ord", "kind", "keep", "drop", "result"]].astype({"keep": one["a"].dtype.name.replace("int", "Int"), "drop": one["a"].dtype.name.replace("int", "Int")})

        found.append(staged(rows.repartition(*by, "__group").sortWithinPartitions(*by, "__group", "ord").mapInPandas(finish, shape), "merges"))
    every = log.limit(0).select(*by, "ord", "kind", F.col("a").alias("keep"), F.col("b").alias("drop"), F.lit("").alias("result"))
    for part in found:  # two a round at most, each a scan of what a round wrote
        every = every.unionByName(part.select(*by, "ord", "kind", "keep", "drop", "result"))
    return every


def remap(merges: DataFrame, by: list[str] = DK, max_rounds: int = 60) -> DataFrame:
    """(by, line, into): the line that each removed one ends up in. A line is removed once, so the steps form trees; they double each round."""
    now = staged(merges.where("drop IS NOT NULL").select(*by, F.col("drop").alias("line"), F.col("keep").alias("into")), "remap")
    for _ in range(max_rounds):
        far = now.select(*by, F.col("line").alias("into"), F.col("into").alias("far"))
        both = now.join(far, [*by, "into"], "left")
        if both.where("far IS NOT NULL").isEmpty():
            return now
        now = staged(both.select(*by, "line", F.coalesce("far", "into").alias("into")), "remap")
    raise RuntimeError(f"steps longer than 2 ** {max_rounds}")


def renamed(rows: DataFrame, into: DataFrame, column: str = "line", by: list[str] = DK) -> DataFrame:
    """rows with the lines of a column replaced by those that they were merged into (`remap`)."""
    found = into.select(*by, F.col("line").alias(column), F.col("into").alias("__into"))
    out = rows.join(found, [*by, column], "left").withColumn(column, F.coalesce("__into", column))
    return out.select(rows.columns)


def repair(segments: DataFrame, junctions: DataFrame, meets: DataFrame, gaps: DataFrame, elbows: DataFrame, crossings: DataFrame, by: list[str] = DK) -> dict[str, DataFrame]:
    """segments (id, line, length, box), junctions (junction, ...) and meets (junction, line) after answers: gaps (ord, a, b, connected,
    confidence) first, then elbows (ord, a, b, segment, type, confidence), in order; crossings (junction, junction_type, confidence) go.

    Returns merges (the log's outcomes), segments, lines (line, segments, length, box) from their segments alone, junctions and meets. Accepted elbow
    segments belong to the line that took them, from where they are merged on like others. Lines without segments have no box and aren't listed. A line's
    length is a sum in a fixed order: segments that merges brought, then its own, elbows first in either, by id. A sum of doubles depends on the order,
    and on the edge of two roundings so does the result."""
    one = accepted(gaps).select(*by, F.col("ord").cast("long").alias("ord"), F.lit("gap").alias("kind"), "a", "b")
    two = accepted(elbows, "type", "elbow").select(*by, F.col("ord").cast("long").alias("ord"), F.lit("elbow").alias("kind"), "a", "b", "segment")
    base = one.groupBy(*by).agg((F.max("ord") + 1).alias("__after"))  # elbows come behind the last gap
    two = staged(two.join(base, by, "left").withColumn("ord", F.col("ord") + F.coalesce("__after", F.lit(0))).drop("__after"), "elbows")
    counts = segments.where("line IS NOT NULL").groupBy(*by, "line").agg(F.count(F.lit(1)).alias("segments"))
    merges = replay_merges(counts, one.unionByName(two.drop("segment")), by)
    into = remap(merges, by)
    given = two.select(*by, "ord", "segment").join(merges.where("result = 'elbow'").select(*by, "ord", "keep"), [*by, "ord"]).groupBy(*by, F.col("segment").alias("id")).agg(F.max_by("keep", "ord").alias("__keep"))
    taken = segments.join(given, [*by, "id"], "left").withColumn("line", F.coalesce("__keep", "line")).withColumn("__first", F.col("line"))
    moved = renamed(taken, into, by=by)
    kept = moved.select(segments.columns)
    b = F.col("box")
    whole = F.struct(F.min(b["x1"]).alias("x1"), F.min(b["y1"]).alias("y1"), F.max(b["x2"]).alias("x2"), F.max(b["y2"]).alias("y2"))
    place = [(F.col("__first") == F.col("line")).alias("own"), F.col("__keep").isNull().alias("given"), F.col("id")]
    lines = moved.where("line IS NOT NULL").groupBy(*by, "line").agg(F.count(F.lit(1)).alias("segments"), F.array_sort(F.collect_list(F.struct(*place, F.col("length").cast("double").alias("length")))).alias("__l"), whole.alias("box"))
    lines = lines.withColumn("length", F.round(F.aggregate("__l", F.lit(0.0), lambda z, v: z + F.coalesce(v["length"], F.lit(0.0))), 1)).select(*by, "line", "segments", "length", "box")
    crossed = accepted(crossings, "junction_type", "crossing").select(*by, "junction").distinct()
    links = renamed(meets.select(*by, "junction", "line"), into, by=by).distinct().join(crossed, [*by, "junction"], "left_anti")
    return {"merges": merges, "segments": kept, "lines": lines, "junctions": junctions.join(crossed, [*by, "junction"], "left_anti"), "meets": links}


def elbow_candidates(segments: DataFrame, radius: float = 50, by: list[str] = DK) -> DataFrame:
    """(by, segment, a, b): diagonal segments (id, ord, type, line, seg) both of whose ends have an end of a horizontal or vertical pipe with a line up to radius away: the nearest one's line.

    Of equally near ends the last counts: first ends of all pipes come before second ones, then they go by ord."""
    s = F.col("seg")

    def ends(rows: DataFrame, *columns: str) -> DataFrame:
        pts = F.array(F.struct(F.lit(0).alias("end"), s["x0"].alias("x"), s["y0"].alias("y")), F.struct(F.lit(1).alias("end"), s["x1"].alias("x"), s["y1"].alias("y")))
        e = rows.select(*by, *columns, F.explode(pts).alias("p"))
        return e.select(*by, *columns, "p.end", F.struct(F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("p.x").alias("x2"), F.col("p.y").alias("y2")).alias("box"))

    pipes = ends(segments.where(F.col("type").isin("horizontal_pipe", "vertical_pipe") & F.col("line").isNotNull()), "ord", "line")
    slanted = ends(segments.where("type = 'diagonal_pipe'"), "id")
    met = grid_join(slanted, pipes, radius, by=by).withColumn("d", g.center_distance(F.col("l")["box"], F.col("r")["box"])).where(F.col("d") <= radius)
    best = met.groupBy(*by, F.col("l.id").alias("segment")).agg(*[F.min_by(F.when(F.col("l.end") == k, F.col("r.line")), F.when(F.col("l.end") == k, F.struct(F.col("d"), -F.col("r.end"), -F.col("r.ord")))).alias(x) for k, x in enumerate("ab")])
    return best.where("a IS NOT NULL AND b IS NOT NULL")
