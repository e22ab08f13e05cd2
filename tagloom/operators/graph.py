"""Graph operators as DataFrame fixed points; `by` names the columns (a drawing) that a graph never crosses."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.staging import merged, staged

DK = ["drawing_id"]


#: Edges that a task holds at once.
_EDGES = 250_000


def _codes(values: pa.Array) -> tuple[np.ndarray, int]:
    """The rank of each value among the distinct ones, and their number."""
    told = values.dictionary_encode()
    order = pc.sort_indices(told.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[told.indices.to_numpy()], len(order)


def _stars(edges: pa.Table, by: list[str]) -> pa.Table:
    """The same components as edges (by, a, b): an edge (a, b) from each node to the smallest of its component."""
    keys = {c: pa.chunked_array([*edges[c].chunks, *edges[c].chunks], edges[c].type).combine_chunks() for c in by}
    nodes = pa.chunked_array([*edges["a"].chunks, *edges["b"].chunks], edges["a"].type).combine_chunks()
    code = np.zeros(len(nodes), np.int64)
    for values in (*keys.values(), nodes):
        rank, n = _codes(values)
        code = np.unique(code * n + rank, return_inverse=True)[1]
    _, first, code = np.unique(code, return_index=True, return_inverse=True)
    u, v, least = code[: len(edges)], code[len(edges) :], np.arange(len(first))
    while len(u):
        np.minimum.at(least, np.maximum(u, v), np.minimum(u, v))
        while (least[least] != least).any():
            least = least[least]
        u, v = least[u], least[v]
        u, v = u[u != v], v[u != v]
    k = np.flatnonzero(least != np.arange(len(least)))
    at = pa.array(first[k])
    return pa.table({**{c: keys[c].take(at) for c in by}, "a": nodes.take(at), "b": nodes.take(pa.array(first[least[k]]))}, schema=edges.schema)


def _shortened(edges: DataFrame, by: list[str]) -> DataFrame:
    """Edges (by, a, b), a > b, of the same components, few of which are longer than stars: those of a drawing come together, in order (of a large one in
    several tasks), and a task turns what it holds into stars, a bounded number of edges at a time; a drawing that isn't complete is held on. Without `by` nothing comes together."""
    if not by or not isinstance(edges.schema["a"].dataType, (T.StringType, T.IntegralType)):
        return edges.distinct()

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= _EDGES:
                stars = _stars(pa.Table.from_batches(held), by)
                last = np.logical_and.reduce([pc.equal(stars[c], batch[c][batch.num_rows - 1]).to_numpy() for c in by])
                if 2 * np.count_nonzero(last) > _EDGES:
                    last[:] = False
                yield from stars.filter(pa.array(~last)).to_batches()
                held, n = stars.filter(pa.array(last)).to_batches(), int(np.count_nonzero(last))
        if n:
            yield from _stars(pa.Table.from_batches(held), by).to_batches()

    return edges.hint("rebalance", *[F.col(c) for c in by]).sortWithinPartitions(*by).mapInArrow(shorten, edges.schema)


def _settled(edges: DataFrame, by: list[str]) -> bool:
    """Whether edges (by, a, b) are stars, each once: no node has two roots or is a root with one."""
    own = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("root"), F.lit(1).alias("n")), F.struct(F.col("b").alias("node"), F.col("b").alias("root"), F.lit(0).alias("n")))
    told = edges.select(*by, F.inline(own)).groupBy(*by, "node").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.sum("n").alias("n"))
    return told.where("lo <> hi OR n > 1").isEmpty()


def components(edges: DataFrame, by: list[str] = DK, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(by, node, root): each node with an edge and the smallest node of its component. Large-star and small-star rounds; loops drop out.

    Edges are shortened to stars where a task holds them together, so that rounds only move what is left, and most often none are needed."""
    some = edges.select(*by, F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").dropna(subset=by) if by else edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b")
    now = staged(_shortened(some, by), "edges")
    for _ in range(max_rounds):
        if _settled(now, by):
            break
        both = now.select(*by, F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select(*by, F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy(*by, "u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(merged(low), [*by, "u"]).select(*by, F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy(*by, "a").agg(F.min("b").alias("m"))
        small = large.join(merged(least), [*by, "a"]).where("b <> m").select(*by, F.col("b").alias("a"), F.col("m").alias("b"))
        now = staged(small.unionAll(least.select(*by, "a", F.col("m").alias("b"))).distinct(), "stars")
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return now.select(*by, F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(*by, F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def component_of(nodes: DataFrame, edges: DataFrame, node: str = "node", by: list[str] = DK) -> DataFrame:
    """nodes with root; nodes without an edge are their own."""
    found = components(edges, by).withColumnRenamed("node", node)
    return nodes.join(merged(found), [*by, node], "left").withColumn("root", F.coalesce("root", F.col(node)))


def _keep_in_order(group: pd.DataFrame) -> pd.DataFrame:
    """The rows that a greedy pass loses of one connected group of conflicts (hi, lo): each row comes after all that come before it, and is lost if one of them is kept."""
    worse, waits, lost = {}, {}, set()
    for hi, lo in zip(group["hi"], group["lo"], strict=True):
        worse.setdefault(hi, []).append(lo)
        waits[lo] = waits.get(lo, 0) + 1
        waits.setdefault(hi, 0)
    ready = [n for n, k in waits.items() if not k]
    while ready:
        n = ready.pop()
        for lo in worse.get(n, ()):
            if n not in lost:
                lost.add(lo)
            waits[lo] -= 1
            if not waits[lo]:
                ready.append(lo)
    out = group.iloc[: len(lost)].copy()
    out["n"] = [n for n in dict.fromkeys(group["lo"]) if n in lost]
    return out.drop(columns=["hi", "lo", "__root"])


def greedy_keep(rows: DataFrame, conflicts: DataFrame, node: str = "id", by: list[str] = DK, rounds: int = 20) -> DataFrame:
    """rows that a greedy pass keeps: each in order of priority unless it conflicts with one kept before.

    conflicts: (by, hi, lo), hi being the one that comes first. Rounds: what has no undecided better rival is kept, its
    rivals are dropped; equal to the sequential loop as the order is total. Chains of rivals that wait for each other longer than
    `rounds` are finished in order, a connected group at a time. Not the same as components.
    """
    edges = staged(conflicts.select(*by, "hi", "lo").distinct(), "conflicts")
    lost = None
    for _ in range(rounds):
        if edges.isEmpty():
            break
        held = edges.select(*by, F.col("lo").alias("n")).distinct()
        tops = edges.select(*by, F.col("hi").alias("n")).distinct().join(held, [*by, "n"], "left_anti")
        out = edges.join(tops.withColumnRenamed("n", "hi"), [*by, "hi"]).select(*by, F.col("lo").alias("n")).distinct()
        out = staged(out, "lost")
        lost = out if lost is None else lost.unionAll(out)
        gone = out.unionAll(tops)
        edges = staged(edges.join(gone.withColumnRenamed("n", "hi"), [*by, "hi"], "left_anti").join(out.withColumnRenamed("n", "lo"), [*by, "lo"], "left_anti"), "conflicts")
    if not edges.isEmpty():
        of = components(edges, by, "hi", "lo").select(*by, F.col("node").alias("hi"), F.col("root").alias("__root"))
        kind = edges.select(*by, F.col("lo").alias("n")).schema
        rest = staged(edges.join(of, [*by, "hi"]).groupBy(*by, "__root").applyInPandas(_keep_in_order, kind), "lost")
        lost = rest if lost is None else lost.unionAll(rest)
    return rows if lost is None else rows.join(lost.withColumnRenamed("n", node), [*by, node], "left_anti")


def bfs_tree(edges: DataFrame, roots: DataFrame, by: list[str] = DK, max_depth: int = 10_000) -> DataFrame:
    """(by, node, parent, depth, visit): the breadth-first tree from roots (by, node) over undirected edges (by, a, b).

    Neighbours are visited in order of id; a node's parent is the neighbour of the level before that was visited first.
    """
    both = staged(edges.select(*by, F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(*by, F.col("b").alias("u"), F.col("a").alias("v"))).where("u <> v").distinct(), "adjacent")
    order = Window.partitionBy(*by).orderBy("rank", "node")
    level = staged(roots.select(*by, "node").distinct().withColumn("rank", F.lit(0)).withColumn("visit", F.row_number().over(order)).select(*by, "node", F.lit(None).cast(roots.schema["node"].dataType).alias("parent"), F.lit(0).alias("depth"), "visit"), "level")
    seen = level
    for depth in range(1, max_depth + 1):
        near = both.join(level.select(*by, F.col("node").alias("u"), F.col("visit").alias("rank")), [*by, "u"]).select(*by, F.col("v").alias("node"), "rank", "u")
        new = near.join(seen.select(*by, "node"), [*by, "node"], "left_anti").groupBy(*by, "node").agg(F.min_by("u", "rank").alias("parent"), F.min("rank").alias("rank"))
        level = staged(new.withColumn("visit", F.row_number().over(order)).select(*by, "node", "parent", F.lit(depth).alias("depth"), "visit"), "level")
        if level.isEmpty():
            return seen
        seen = seen.unionAll(level)
    raise RuntimeError(f"deeper than {max_depth}")


def ancestors(parents: DataFrame, by: list[str] = DK, max_depth: int = 1000) -> DataFrame:
    """(by, node, chain, depth, cycle): from (by, node, parent), each node's ancestors from its parent up.

    The walk doubles: chains of 2^k steps are joined end to end, so rounds grow with the logarithm of the depth. A cycle ends at its first repeat.
    """
    base = parents.select(*by, "node", "parent")
    now = staged(base.select(*by, "node", F.when(F.col("parent").isNull(), F.array().cast(f"array<{base.schema['node'].dataType.simpleString()}>")).otherwise(F.array("parent")).alias("chain"), F.col("parent").alias("end"), F.lit(False).alias("cycle")), "chains")
    steps = 1
    while steps <= 2 * max_depth:
        more = now.select(*by, F.col("node").alias("end"), F.col("chain").alias("rest"), F.col("end").alias("end2"), F.col("cycle").alias("cycle2"))
        whole = F.when(F.col("rest").isNull(), F.col("chain")).otherwise(F.concat("chain", "rest"))
        at = F.array_position(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.array_contains(F.slice(F.concat(F.array("node"), "w"), F.lit(1), i), F.element_at("w", i))), True)
        joined = now.join(more, [*by, "end"], "left").withColumn("w", whole)
        cut = F.when(F.size("w") == 0, F.lit(0).cast("long")).otherwise(at)
        joined = joined.withColumn("at", cut)
        new = joined.select(*by, "node", F.when(F.col("at") > 0, F.expr("slice(w, 1, CAST(at - 1 AS INT))")).otherwise(F.col("w")).alias("chain"), F.when(F.col("at") > 0, F.lit(None)).otherwise(F.when(F.col("rest").isNull(), F.lit(None)).otherwise(F.col("end2"))).alias("end"), (F.col("cycle") | F.coalesce("cycle2", F.lit(False)) | (F.col("at") > 0)).alias("cycle"))
        now = staged(new, "chains")
        if now.where("end IS NOT NULL").isEmpty():
            return now.select(*by, "node", "chain", F.size("chain").alias("depth"), "cycle")
        steps *= 2
    raise RuntimeError(f"deeper than {max_depth}")


def reachable(edges: DataFrame, starts: DataFrame, by: list[str] = DK, max_rounds: int = 1000) -> DataFrame:
    """(by, start, node, hops): what directed edges (by, a, b) reach from starts (by, node), in the fewest hops; the start itself at 0."""
    frontier = staged(starts.select(*by, F.col("node").alias("start"), "node", F.lit(0).alias("hops")).distinct(), "reach")
    seen = frontier
    for k in range(1, max_rounds + 1):
        near = frontier.join(edges.select(*by, F.col("a").alias("node"), "b"), [*by, "node"]).select(*by, "start", F.col("b").alias("node")).distinct()
        frontier = staged(near.join(seen.select(*by, "start", "node"), [*by, "start", "node"], "left_anti").withColumn("hops", F.lit(k)), "reach")
        if frontier.isEmpty():
            return seen
        seen = seen.unionAll(frontier)
    raise RuntimeError(f"more than {max_rounds} hops")


def propagate(seeds: DataFrame, edges: DataFrame, by: list[str] = DK, max_rounds: int = 1000) -> DataFrame:
    """(by, node, value, hops): seeds (by, node, value) spread over undirected edges (by, a, b) to nodes without a value; the nearest wins, of several the smallest value.

    Neighbours of a level lie in it, the one before or the next, so a round compares with two levels only."""
    both = staged(edges.select(*by, F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(*by, F.col("b").alias("u"), F.col("a").alias("v"))), "adjacent")
    frontier = staged(seeds.groupBy(*by, "node").agg(F.min("value").alias("value")).withColumn("hops", F.lit(0)), "flow")
    seen, before = frontier, None
    for k in range(1, max_rounds + 1):
        known = frontier.select(*by, "node") if before is None else frontier.select(*by, "node").unionAll(before.select(*by, "node"))
        near = both.join(frontier.withColumnRenamed("node", "u"), [*by, "u"]).groupBy(*by, F.col("v").alias("node")).agg(F.min("value").alias("value"))
        before, frontier = frontier, staged(near.join(known, [*by, "node"], "left_anti").withColumn("hops", F.lit(k)), "flow")
        if frontier.isEmpty():
            return seen
        seen = seen.unionAll(frontier)
    raise RuntimeError(f"more than {max_rounds} rounds")


def loop_members(edges: DataFrame, tags: DataFrame, most: int = 15, by: list[str] = DK) -> DataFrame:
    """(by, loop_id, node, tag, role): members of the components of signal edges, which are named by size; those over `most` members are clusters, CLUSTER-nn."""
    from tagloom.functions.text import loop_role, numbered

    of = components(edges, by).join(tags, [*by, "node"], "left")
    sizes = of.groupBy(*by, "root").agg(F.count(F.lit(1)).alias("size"))
    kind = F.when(F.col("size") > most, "CLUSTER").otherwise("CL")
    n = F.row_number().over(Window.partitionBy(*by, kind).orderBy(F.desc("size"), "root")) - 1
    named = sizes.select(*by, "root", F.concat(kind, numbered("-", n, 2)).alias("loop_id"))
    return of.join(named, [*by, "root"]).select(*by, "loop_id", "node", "tag", loop_role(F.col("tag")).alias("role"))


def control_loops(edges: DataFrame, tags: DataFrame, most: int = 15, by: list[str] = DK) -> DataFrame:
    """(by, loop_id, size, controllers, member_ids) of `loop_members`."""
    of = loop_members(edges, tags, most, by)
    return of.groupBy(*by, "loop_id").agg(F.count(F.lit(1)).alias("size"), F.array_sort(F.collect_list(F.when(F.col("role") == "controller", F.col("tag")))).alias("controllers"), F.array_sort(F.collect_list("node")).alias("member_ids"))
