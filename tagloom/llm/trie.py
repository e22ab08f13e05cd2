"""Prefix trie of conversations, with subtree figures by heavy-path decomposition.

A conversation is rows of arrays, at most PIECE turns each, so a conversation that holds a third of all turns is many rows. A
node is known by two 64-bit exclusive-or sums over its turns, each hashed with its position, so prefixes of pieces join to
prefixes of conversations without a walk. Every node's child with the most conversations continues its path; along a path sums
run from the end over arrays of at most PIECE nodes, and the total at its top goes to the parent on another path. Another
child has at most half its parent's conversations, so paths are classed by the binary length of the number at their tops, a class only
waits for lower ones, and the rounds are at most the logarithm of the number of conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import WORD, new_folder, small_batches, staged

#: Turns or nodes of an array.
PIECE = 1024
_LISTS = ["t1", "t2", "w"]
_KEY = ["h1", "h2"]


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns with the number of their words in place of their text."""
    for whole in batches:
        for b in small_batches(whole, "text"):
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("c", "turn", "role", "t1", "t2")], pc.count_substring_regex(b.column("text"), WORD).cast(pa.int64())], names=["c", "turn", "role", "t1", "t2", "w"])


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns of a partition as rows of at most PIECE turns of one conversation; seq keeps their order over all partitions."""
    seq, held = TaskContext.get().partitionId() << 33, None

    def rows(cols: list[np.ndarray], starts: np.ndarray, end: int) -> pa.RecordBatch:
        nonlocal seq
        n = len(starts)
        made = [pa.array(cols[0][starts]), pa.array(np.arange(seq, seq + n)), *[_lists(np.append(starts, end), v[:end]) for v in cols[1:]]]
        seq += n
        return pa.RecordBatch.from_arrays(made, names=["c", "seq", *_LISTS])

    for b in batches:
        cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("c", *_LISTS)]
        cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
        if not len(cols[0]):
            continue
        new = np.flatnonzero(np.append(True, cols[0][1:] != cols[0][:-1]))
        inside = np.arange(len(cols[0])) - np.repeat(new, np.diff(np.append(new, len(cols[0]))))
        starts = np.flatnonzero(inside % PIECE == 0)
        if len(starts) > 1:
            yield rows(cols, starts[:-1], int(starts[-1]))
        held = [x[starts[-1]:] for x in cols]
    if held is not None:
        yield rows(held, np.zeros(1, dtype=np.int64), len(held[0]))


def pieces(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, seq, first, start, total, t1, t2, w): conversations as rows of at most PIECE turns in order; t1 and t2 are hashes of role and text, w the words.

    Turns go by number, null first; those that share one by role, then by a hash of the text. Null roles and texts are empty
    ones. Rows without a conversation belong to none and are left out; repeated rows are turns of their own; other columns
    aren't read, whatever their names. The order comes from one sort by range, which cuts a long conversation as well."""
    r, t = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role, text))
    rows = conversations.select(F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), r.alias("role"), F.xxhash64(r, t).alias("t1"), F.xxhash64(F.lit(1), r, t).alias("t2"), t.alias("text")).where("c IS NOT NULL")
    counted = staged(rows.mapInArrow(_turns, rows.drop("text").schema.add("w", "long")), "turns")
    ordered = counted.orderBy("c", F.asc_nulls_first("turn"), "role", "t1").select("c", *_LISTS)
    cut = staged(ordered.mapInArrow(_cut, "c long, seq long, t1 array<long>, t2 array<long>, w array<long>"), "pieces")
    every = Window.partitionBy("c")
    before = every.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    n = F.size("w").cast("long")
    start = F.sum(n).over(before)
    return cut.select("c", "seq", start.isNull().alias("first"), F.coalesce(start, F.lit(0)).alias("start"), F.sum(n).over(every).alias("total"), *_LISTS)


def rebuilt(rows: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """`pieces` of conversations that open like their group's first: h turns of conversation c - c % group (all if it has fewer,
    none if it is absent), then c's own behind its first h, with h = crc32(c as decimal text) % most."""
    if most > PIECE:
        raise ValueError("openings are at most one piece")
    rows = rows.withColumn("b", F.col("c") - F.col("c") % group)
    part = F.posexplode(F.arrays_zip(*[F.slice(x, 1, most - 1).alias(x) for x in _LISTS])).alias("i", "z")
    turns = rows.where((F.col("b") == F.col("c")) & (F.col("start") < most - 1)).select("b", "start", part).select("b", (F.col("start") + F.col("i")).alias("at"), *[F.col(f"z.{x}").alias(x) for x in _LISTS])
    heads = turns.where(F.col("at") < most - 1).groupBy("b").agg(F.array_sort(F.collect_list(F.struct("at", *_LISTS))).alias("head"))
    h = F.crc32(F.col("c").cast("string").cast("binary")) % most
    both = rows.join(heads, "b", "left").withColumn("h", h).withColumn("k", F.least("h", F.coalesce(F.size("head").cast("long"), F.lit(0).cast("long"))))
    both = both.withColumn("k", F.greatest("k", F.lit(0).cast("long"))).withColumn("drop", F.least(F.greatest(F.col("h") - F.col("start"), F.lit(0)), F.size("w").cast("long")).cast("int"))

    def turned(x: str):
        own = F.slice(F.col(x), F.col("drop") + 1, F.size(x))
        opening = F.coalesce(F.slice(F.col("head")[x], F.lit(1), F.col("k").cast("int")), F.array().cast("array<bigint>"))
        return F.when(F.col("first"), F.concat(opening, own)).otherwise(own).alias(x)

    start = F.when(F.col("first"), F.lit(0)).otherwise(F.col("start") + F.col("drop") - F.col("h") + F.col("k")).alias("start")
    total = (F.col("k") + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("total")
    return both.select("c", "seq", "first", start, total, *[turned(x) for x in _LISTS])


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with the exclusive-or sums of their prefixes in place of hashes, and of the whole piece (x1, x2)."""
    for b in batches:
        lists = {x: b.column(x) for x in _LISTS}
        offsets = lists["w"].offsets.to_numpy().astype(np.int64)
        base, offsets = offsets[0], offsets - offsets[0]
        sizes, n = np.diff(offsets), int(offsets[-1])
        at = (np.arange(n) - np.repeat(offsets[:-1], sizes) + np.repeat(b.column("start").to_numpy(), sizes) + 1).astype(np.uint64)
        out = {x: b.column(x) for x in ("c", "seq", "first", "start", "total")}
        for k, x in enumerate(("t1", "t2")):
            values = lists[x].values.to_numpy(zero_copy_only=False)[base:base + n].view(np.uint64)
            sums = np.append(np.uint64(0), np.bitwise_xor.accumulate(_mixed(values + _mixed(at * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)))) if n else np.zeros(0, np.uint64))
            before = sums[offsets[:-1]]
            out[f"q{k + 1}"] = _lists(offsets, (sums[1:] ^ np.repeat(before, sizes)).view(np.int64))
            out[f"x{k + 1}"] = pa.array((sums[offsets[1:]] ^ before).view(np.int64))
        out["w"] = _lists(offsets, lists["w"].values.to_numpy(zero_copy_only=False)[base:base + n])
        yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays of nodes in order along a path, with sums of leaves and saved tokens from each node to the array's end, and of the whole array."""
    for b in batches:
        items = b.column("items")
        offsets = items.offsets.to_numpy().astype(np.int64)
        base, offsets = offsets[0], offsets - offsets[0]
        flat = items.values.slice(base, int(offsets[-1]))
        sizes = np.diff(offsets)
        out = {x: b.column(x) for x in ("p1", "p2", "chunk", "g1", "g2", "target")}
        out |= {x: _lists(offsets, flat.field(x).to_numpy(zero_copy_only=False)) for x in _KEY}
        for x in ("leaves", "saved"):
            sums = np.append(0, np.cumsum(flat.field(x).to_numpy(zero_copy_only=False)))
            end = sums[offsets[1:]]
            out[x] = _lists(offsets, np.repeat(end, sizes) - sums[:-1])
            out[f"all_{x}"] = pa.array(end - sums[offsets[:-1]])
        yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's chunks, which come in order and one at a time, joined by commas."""
    key, hasher = None, None

    def made(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.string())], names=[*_KEY, "sha"])

    for b in batches:
        found = []
        for h1, h2, ids in zip(b.column("h1").to_pylist(), b.column("h2").to_pylist(), b.column("ids").to_pylist()):
            if (h1, h2) == key:
                hasher.update(b"," + ids.encode())
                continue
            if key is not None:
                found.append((*key, hasher.hexdigest()))
            key, hasher = (h1, h2), hashlib.sha256(ids.encode())
        if found:
            yield made(found)
    if key is not None:
        yield made([(*key, hasher.hexdigest())])


def _ends(found: DataFrame) -> DataFrame:
    """(h1, h2, sha) of the conversations c that end at each node: ids in order, chunks of 4,096 at most, then one hash over a node's chunks."""
    ids = found.orderBy("h1", "h2", "c").select(*_KEY, "c", F.shiftright(F.monotonically_increasing_id(), 12).alias("chunk"))
    chunks = ids.groupBy(*_KEY, "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("ids"))
    return chunks.repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk").select(*_KEY, "ids").mapInArrow(_digests, "h1 long, h2 long, sha string")


def _heavy_paths(nodes: DataFrame) -> DataFrame:
    """(h1, h2, p1, p2, pos, top): the top of each node's path, the steps from there and its conversations. Pointers double: a node points as
    far up its path as it has come, so those still on their way point at different nodes, and long paths take their logarithm in rounds."""
    own = [F.when(F.col("heavy"), F.col(g)).otherwise(F.col(h)).alias(p) for g, h, p in (("g1", "h1", "p1"), ("g2", "h2", "p2"))]
    now = staged(nodes.select(*_KEY, *own, F.col("heavy").cast("long").alias("pos"), F.when(~F.col("heavy"), F.col("n")).alias("top")), "paths")
    while True:
        open_, done = now.where("top IS NULL"), now.where("top IS NOT NULL")
        if open_.isEmpty():
            return now
        far = now.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("pos").alias("more"), F.col("top").alias("found"))
        moved = open_.drop("top").join(far, ["p1", "p2"]).select(*_KEY, F.col("q1").alias("p1"), F.col("q2").alias("p2"), (F.col("pos") + F.col("more")).alias("pos"), F.col("found").alias("top"))
        now = staged(done.unionByName(moved), "paths")


def _levels(pairs: list[tuple[int, int]], classes: list[int]) -> list[list[int]]:
    """Classes by round: each later than all that give to it."""
    level = dict.fromkeys(classes, 0)
    for low, high in sorted(pairs, key=lambda p: p[1]):
        level[high] = max(level[high], level[low] + 1)
    return [[c for c in classes if level[c] == k] for k in range(max(level.values(), default=-1) + 1)]


def trie(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a row for each node of the trie of `pieces`.

    A node is a distinct sequence of turns with which conversations open, the root the empty one. conv_id is the smallest of its n_convs
    conversations, parent_conv_id its parent's; n_leaves and saved_tokens (conversations but one, times the words of a node's last turn) sum
    up its subtree; ends_sha256 is of the decimal ids, in order, of the conversations that end there. Without conversations there is no node.
    Sequences with equal pairs of 64-bit sums are taken for one. All joins but one are between keys that occur once or were aggregated before; that of
    children with their parents, one of which may have a third of all nodes as children, is left to the adaptive splitting of skewed joins.
    The hash of a node's ids is one sequence: where many end, one task reads their chunks, a row for 4,096 ids, holding one at a time."""
    made = rows.select("c", "seq", "first", "start", "total", *_LISTS).mapInArrow(_prefixes, "c long, seq long, first boolean, start long, total long, q1 array<long>, x1 long, q2 array<long>, x2 long, w array<long>")
    before = Window.partitionBy("c").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    found = staged(made.select("c", "first", "start", "total", "q1", "q2", "w", *[F.coalesce(F.bit_xor(f"x{k}").over(before), F.lit(0)).alias(f"o{k}") for k in (1, 2)]), "prefixes")

    turns = found.select("c", "start", "o1", "o2", "q1", "q2", F.posexplode("w").alias("i", "words"))

    def sum_at(k: int, i) -> F.Column:
        return F.coalesce(F.get(f"q{k}", i), F.lit(0)).bitwiseXOR(F.col(f"o{k}"))

    steps = turns.select("c", (F.col("start") + F.col("i") + 1).alias("depth"), *[sum_at(k, F.col("i")).alias(f"h{k}") for k in (1, 2)], *[sum_at(k, F.col("i") - 1).alias(f"g{k}") for k in (1, 2)], "words")
    below = steps.groupBy(*_KEY).agg(F.first("depth").alias("depth"), F.first("g1").alias("g1"), F.first("g2").alias("g2"), F.min("c").alias("conv"), F.count(F.lit(1)).alias("n"), F.first("words").alias("words"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = found.where("first").agg(F.min("c").alias("conv"), F.count(F.lit(1)).alias("n")).where("n > 0").select(zero.alias("h1"), zero.alias("h2"), zero.alias("depth"), none.alias("g1"), none.alias("g2"), "conv", "n", zero.alias("words"))
    nodes = staged(below.unionByName(root), "nodes")
    kids = nodes.where("depth > 0").groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("n_children"), F.min(F.struct((-F.col("n")).alias("n"), "conv", *_KEY)).alias("s"))
    marks = kids.select(F.col("g1").alias("h1"), F.col("g2").alias("h2"), "n_children", F.lit(False).alias("heavy")).unionAll(kids.select("s.h1", "s.h2", zero, F.lit(True)))
    marks = marks.groupBy(*_KEY).agg(F.max("n_children").alias("n_children"), F.max("heavy").alias("heavy"))
    nodes = staged(nodes.join(marks, _KEY, "left").fillna({"n_children": 0, "heavy": False}), "nodes")

    whole = nodes.join(_heavy_paths(nodes), _KEY).withColumn("class", F.length(F.bin("top")))
    whole = staged(whole, "whole")
    above = whole.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("conv").alias("parent_conv"), F.col("class").alias("parent_class"))
    laid = staged(whole.join(above, ["g1", "g2"], "left").withColumn("target", F.when(F.col("pos") == 0, F.col("parent_class"))).drop("parent_class").repartitionByRange("class", "p1"), "trie")
    pairs = [tuple(r) for r in laid.where("pos = 0").groupBy("class", "target").count().select("class", "target").collect()]  # at most 64 times 64
    folder = new_folder(nodes.sparkSession, "sums")
    sums = "p1 long, p2 long, chunk long, g1 long, g2 long, target int, h1 array<long>, h2 array<long>, leaves array<long>, all_leaves long, saved array<long>, all_saved long, more_leaves long, more_saved long"
    later = Window.partitionBy("p1", "p2").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    for k, classes in enumerate(_levels([p for p in pairs if p[1] is not None], sorted({p[0] for p in pairs}))):
        here = laid.where(F.col("class").isin(classes)).select(*_KEY, "p1", "p2", "pos", "g1", "g2", "target", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("words")).alias("saved"))
        if k:
            given = nodes.sparkSession.read.schema(sums).parquet(folder).where((F.col("chunk") == 0) & F.col("target").isin(classes))
            given = given.groupBy(F.col("g1").alias("h1"), F.col("g2").alias("h2")).agg(F.sum(F.col("all_leaves") + F.col("more_leaves")).alias("a"), F.sum(F.col("all_saved") + F.col("more_saved")).alias("b"))
            here = here.join(given, _KEY, "left").withColumn("leaves", F.col("leaves") + F.coalesce("a", F.lit(0))).withColumn("saved", F.col("saved") + F.coalesce("b", F.lit(0)))
        top = [F.max(F.when(F.col("pos") == 0, F.col(x))).alias(x) for x in ("g1", "g2", "target")]
        arrays = here.groupBy("p1", "p2", F.floor(F.col("pos") / PIECE).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("pos", *_KEY, "leaves", "saved"))).alias("items"), *top)
        summed = arrays.mapInArrow(_suffixes, ", ".join(sums.split(", ")[:12]))
        summed = summed.withColumn("more_leaves", F.coalesce(F.sum("all_leaves").over(later), F.lit(0))).withColumn("more_saved", F.coalesce(F.sum("all_saved").over(later), F.lit(0)))
        summed.write.mode("append").parquet(folder)
    if not pairs:
        total = laid.select(*_KEY, zero.alias("n_leaves"), zero.alias("saved_tokens"))
    else:
        z = nodes.sparkSession.read.schema(sums).parquet(folder).select("more_leaves", "more_saved", F.explode(F.arrays_zip(*_KEY, "leaves", "saved")).alias("z"))
        total = z.select("z.h1", "z.h2", (F.col("z.leaves") + F.col("more_leaves")).alias("n_leaves"), (F.col("z.saved") + F.col("more_saved")).alias("saved_tokens"))
    last = F.size("w") - 1
    ending = found.where((F.col("start") + F.size("w") == F.col("total")) & ((F.size("w") > 0) | (F.col("first") & (F.col("total") == 0)))).select(*[F.when(last >= 0, sum_at(k, last)).otherwise(0).cast("long").alias(f"h{k}") for k in (1, 2)], "c")
    out = laid.join(total, _KEY).join(_ends(ending), _KEY, "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
