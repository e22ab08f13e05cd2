"""SimHash near-duplicates: fingerprints of 64 bits or more, linked by tiled numpy exclusive-or and bit counts.

Fingerprints within a radius r agree in one of r + 1 blocks of bits, so tiles are laid per block value: every pair
within the radius meets in a tile, and the comparison in tiles is exact. Tiles over `tile_rows` are cut by population
count, and only pairs of cuts whose counts are within the radius are laid at all: the others never reach the shuffle. In a
tile rows are sorted by population count and compared only with rows within the radius. A tile returns a spanning forest
of its links, not all pairs.

`near_copies` takes wide fingerprints for candidates only: each is confirmed by the exact similarity of the shingle sets.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import mapper, shuffle_partitions, staged, u64
from tagloom.operators.graph import components


RUN = 1 << 20
GAP = re.compile(rb"[\x20\x09-\x0D]")


def _runs(raw: bytes) -> Iterator[list[bytes]]:
    """The words of raw, those of about RUN bytes at a time."""
    at = 0
    while at < len(raw):
        gap = GAP.search(raw, at + RUN) if at + RUN < len(raw) else None
        end = gap.end() if gap else len(raw)
        yield raw[at:end].split()
        at = end


def shingle_hashes(text: str | None, shingle_words: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle of a text, as often as it occurs. Of a long text the words of a run are held at a time."""
    digest = xxhash.xxh64_intdigest
    out, words = [], []
    for run in _runs((text or "").encode("utf-8", "surrogatepass").lower()):
        words += run
        n = len(words)
        if n < shingle_words:
            continue
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(sizes + 1) - 1
        out.append(np.array([digest(joined[i:j], seed) for i, j in zip((ends - sizes)[: n - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist(), strict=True)], dtype=np.uint64))
        words = words[n - shingle_words + 1 :]  # they begin shingles that go on in the next run
    if not out:
        return np.array([digest(b" ".join(words), seed)] if words else [], dtype=np.uint64)
    return out[0] if len(out) == 1 else np.concatenate(out)


def folded(h: np.ndarray, longs: int = 1) -> np.ndarray:
    """The fingerprint, as `longs` signed numbers, of shingles with these hashes."""
    if len(h) == 0:
        return np.zeros(longs, np.int64)
    out = []
    for k in range(longs):
        if k:
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        counts = np.zeros(64, dtype=np.int64)
        for at in range(0, len(h), 65536):
            counts += np.unpackbits(h[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        out.append(np.packbits(2 * counts > len(h), bitorder="little").view(np.int64)[0])
    return np.array(out, np.int64)


def simhash(text: str | None, shingle_words: int = 3, seed: int = 42, longs: int = 1) -> np.ndarray:
    """The fingerprint of a text as `longs` signed 64-bit numbers.

    A-Z are lower-cased; words are runs of non-white-space (ASCII); shingles count as often as they occur; fewer words
    than a shingle make one shingle; null, empty and blank texts give zeros. A bit is 1 if set in over half the hashes.
    The first number is of the shingles' XXH64; each further one is of those hashes, mixed again.
    """
    return folded(shingle_hashes(text, shingle_words, seed), longs)


def simhash64(text: str | None, shingle_words: int = 3, seed: int = 42) -> int:
    return int(simhash(text, shingle_words, seed)[0])


def names_of(longs: int) -> list[str]:
    return [f"w{k}" for k in range(longs)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, longs: int = 1) -> DataFrame:
    """(id, w0, w1, ...): the fingerprint's numbers, one row per row of docs."""
    names = names_of(longs)
    schema = pa.schema([("id", pa.int64()), *[(w, pa.int64()) for w in names]])

    def make(batch: pa.RecordBatch) -> dict:
        found = np.array([simhash(t, shingle_words, longs=longs) for t in batch.column("text").to_pylist()]).reshape(-1, longs)
        return {"id": batch.column("id")} | {w: found[:, k] for k, w in enumerate(names)}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(mapper(schema, "text", make), ", ".join(f"{x} long" for x in schema.names))


def _forest(x: np.ndarray, left: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as index pairs, of the links between the rows of x; if left, only those between x[:left] and x[left:]; both are sorted by population count."""
    n = len(x)
    label = np.arange(n)
    tops, ends = [], []
    parts = n
    pop = np.bitwise_count(x).sum(axis=1, dtype=np.int64)
    lo, hi = (left, n) if left else (0, n)
    for i in range(left or n):
        start = lo if left else i + 1
        a = start + np.searchsorted(pop[start:hi], pop[i] - radius, "left")
        b = start + np.searchsorted(pop[start:hi], pop[i] + radius, "right")
        if a >= b:
            continue
        near = a + np.flatnonzero(np.bitwise_count(x[a:b] ^ x[i]).sum(axis=1, dtype=np.int32) <= radius)
        if len(near) == 0:
            continue
        names, first = np.unique(label[near], return_index=True)
        other = names != label[i]
        if not other.any():
            continue
        tops += [i] * int(other.sum())
        ends += near[first[other]].tolist()
        label[np.isin(label, names[other])] = label[i]
        parts -= int(other.sum())
        if parts == 1:  # all rows hang together; further links add nothing
            break
    return np.array(tops, dtype=np.int64), np.array(ends, dtype=np.int64)


SMALL_TILE = 16


def tile_forest(key: np.ndarray, side: np.ndarray, two: np.ndarray, x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (as row numbers) of whole tiles: rows are sorted by (key, side, population count); two: the tile is a pair of cuts."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    tile = np.repeat(np.arange(len(starts)), sizes)
    small = (sizes <= SMALL_TILE) & ~two[starts]
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rows = np.flatnonzero(small[tile])
    sub, of = x[rows], tile[rows]
    for shift in range(1, SMALL_TILE):
        if len(sub) <= shift:
            break
        same = np.flatnonzero(of[shift:] == of[:-shift])
        if len(same) == 0:
            break
        near = same[np.bitwise_count(sub[same] ^ sub[same + shift]).sum(axis=1, dtype=np.int32) <= radius]
        a.append(rows[near])
        b.append(rows[near + shift])
    for t in np.flatnonzero(~small):
        s, e = starts[t], starts[t] + sizes[t]
        left = int((side[s:e] == 0).sum()) if two[s] else 0
        if two[s] and left in (0, e - s):
            continue
        i, j = _forest(x[s:e], left, radius)
        a.append(s + i)
        b.append(s + j)
    return np.concatenate(a), np.concatenate(b)


def blocks_of(longs: int, radius: int, bits: int | None) -> list[tuple[int, int, int]]:
    """(number, first bit, width) of the blocks whose values lay out the tiles.

    bits None: radius + 1 blocks over all of one number, which no pair within the radius can miss. Else blocks of `bits`
    bits, as many as go into each number: a pair with distance d of 64 * longs bits misses all k of them with a
    probability of about (1 - (1 - d / (64 * longs)) ** bits) ** k.
    """
    if bits is None:
        if longs != 1:
            raise ValueError("give `bits` for fingerprints of several numbers")
        edges = [64 * i // (radius + 1) for i in range(radius + 2)]
        return [(0, edges[i], edges[i + 1] - edges[i]) for i in range(radius + 1)]
    return [(w, bits * k, bits) for w in range(longs) for k in range(64 // bits)]


def _keyed(nodes: DataFrame, laid: list[tuple[int, int, int]], *columns: str) -> DataFrame:
    """nodes' columns with block and value, a row for each block."""
    key = F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(F.shiftleft(f"w{w}", 64 - at - wide), 64 - wide).alias("value")) for i, (w, at, wide) in enumerate(laid)])
    return nodes.select(*columns, F.explode(key).alias("k")).select(*columns, "k.block", "k.value")


#: A table of cuts with up to so many rows (of some fifty bytes) is broadcast; a larger one is joined by a shuffle.
MOST_CUTS = 100_000


def tiles(rows: DataFrame, reach: int, tile_rows: int, *columns: str) -> DataFrame:
    """(tile, side, two, columns) of rows (block, value, rank, columns): rows that share block and value and whose ranks differ by at most `reach` meet in a tile.

    Up to `tile_rows` rows of one value are one tile. More are cut by rank (a rank with more rows also by a hash of the
    node), and a tile is a cut or a pair of cuts (two; side tells them apart), only of ranks within reach.
    """
    sizes = rows.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile_rows).select("block", "value")
    by_rank = rows.join(sizes, ["block", "value"], "left_semi").groupBy("block", "value", "rank").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("cuts"))
    at = Window.partitionBy("block", "value").orderBy("rank")
    first = F.coalesce(F.sum("cuts").over(at.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    made = by_rank.withColumn("first", first).withColumn("lo", F.min("first").over(at.rangeBetween(-reach, reach))).withColumn("hi", F.max(F.col("first") + F.col("cuts") - 1).over(at.rangeBetween(-reach, reach)))
    big = staged(sizes, "big")
    if big.isEmpty():
        return rows.select(F.xxhash64("block", "value").alias("tile"), F.lit(0).alias("side"), F.lit(False).alias("two"), *columns)
    cuts = staged(made, "cuts")
    cut = rows.join(F.broadcast(cuts) if cuts.count() <= MOST_CUTS else cuts, ["block", "value", "rank"], "left")
    cut = cut.withColumn("cut", F.coalesce(F.col("first") + F.pmod(F.xxhash64("node"), F.col("cuts")), F.lit(0)).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.coalesce("lo", F.lit(0)).cast("int"), F.coalesce("hi", F.lit(0)).cast("int"))))
    return cut.select(
        F.xxhash64("block", "value", F.least("cut", "other"), F.greatest("cut", "other")).alias("tile"),
        (F.col("cut") > F.col("other")).cast("int").alias("side"),
        (F.col("cut") != F.col("other")).alias("two"),
        *columns,
    )


def _ones(names: list[str]):
    return sum((F.bit_count(w) for w in names[1:]), F.bit_count(names[0]))


def links(distinct: DataFrame, radius: int = 3, tile_rows: int = 2048, longs: int = 1, bits: int | None = None) -> DataFrame:
    """(a, b): links between the nodes of distinct (node, w0, ...) that connect whatever is within the radius and shares a block."""
    names = names_of(longs)
    rows = _keyed(distinct.withColumn("rank", _ones(names)), blocks_of(longs, radius, bits), "node", "rank", *names)
    laid = tiles(rows, radius, tile_rows, "node", *names)
    dealt = laid.repartition(shuffle_partitions(distinct.sparkSession), "tile").sortWithinPartitions("tile", "side", _ones(names))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.array([], t) for t in (np.int64, np.int64, bool, *[np.int64] * (longs + 1))]
        for batch in _then_none(batches):
            if batch is not None:
                kept = [np.concatenate([k, batch.column(i).to_numpy(zero_copy_only=False)]) for i, k in enumerate(kept)]
                if len(kept[0]) == 0:
                    continue
                whole = int(np.flatnonzero(kept[0] == kept[0][-1])[0])  # the last tile may go on in the next batch
            else:
                whole = len(kept[0])
            if whole:
                i, j = tile_forest(*(k[:whole] for k in kept[:3]), np.stack([u64(k[:whole]) for k in kept[4:]], axis=1), radius)
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(kept[3][i]), pa.array(kept[3][j])], schema=out)
                kept = [k[whole:] for k in kept]

    return dealt.mapInArrow(compare, "a long, b long")


def _then_none(items: Iterator) -> Iterator:
    yield from items
    yield None


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, shingle_words: int = 3, tile_rows: int = 2048, longs: int = 1, bits: int | None = None) -> DataFrame:
    """(id, w0, ..., component): the smallest id that chains of links reach from each row.

    Null texts count as empty, and those share the fingerprint of zeros. Rows with a null id keep their fingerprint, link
    like any other and never name a component that has another id. Repeated rows stay. Further columns aren't read.
    An empty table gives no rows.
    """
    names = names_of(longs)
    prints = staged(fingerprints(docs, id_col, text_col, shingle_words, longs), "simhash")
    node = F.col("w0") if longs == 1 else F.xxhash64(*names)
    distinct = staged(prints.groupBy(*names).agg(F.min("id").alias("lead")).withColumn("node", node), "distinct")
    roots = components(links(distinct, radius, tile_rows, longs, bits), []).withColumnRenamed("node", "n")
    linked = staged(roots.join(distinct, F.col("n") == F.col("node")).select("node", "root", "lead"), "linked")
    leads = linked.groupBy("root").agg(F.min("lead").alias("component"))
    of = distinct.join(linked.join(leads, "root").select("node", "component"), "node", "left").select(*names, F.coalesce("component", "lead").alias("component"))
    return prints.join(of, names).select("id", *names, "component")


def shingle_set(text: str | None, shingle_words: int) -> set[bytes]:
    """The distinct shingles themselves, by the rules of `simhash`."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return {b" ".join(words[i : i + shingle_words]) for i in range(max(1, len(words) - shingle_words + 1))} if words else set()


def _set_name(h: np.ndarray) -> int:
    """A signed 64-bit name of a sorted set of hashes; different sets share one with a probability of 2 ** -64."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())).view(np.int64))


def first_block(x: np.ndarray, laid: list[tuple[int, int, int]]) -> np.ndarray:
    """The first block in which pairs agree, of their exclusive-ors x (as rows of numbers)."""
    out = np.full(len(x), len(laid), np.int64)
    for i in range(len(laid) - 1, -1, -1):
        w, at, wide = laid[i]
        out[(x[:, w] >> np.uint64(at)) & np.uint64((1 << wide) - 1) == 0] = i
    return out


def tile_pairs(tile: np.ndarray, side: np.ndarray, two: np.ndarray, block: np.ndarray, n: np.ndarray, part: np.ndarray, x: np.ndarray, radius: int, least: Fraction, laid: list[tuple[int, int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, distance): all pairs (as row numbers) of whole tiles within the radius, of different parts, whose sizes n allow a similarity of `least` and that agree in no earlier block (if blocks are laid at all); rows are sorted by (tile, n)."""
    if len(tile) == 0:
        return
    starts = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
    mixed = np.minimum.reduceat(part, starts) != np.maximum.reduceat(part, starts)
    i = np.flatnonzero(np.repeat(mixed, np.diff(np.r_[starts, len(tile)])))
    shift = 1
    while len(i):
        i = i[i + shift < len(tile)]
        j = i + shift
        i = i[(tile[j] == tile[i]) & (least.denominator * n[i] >= least.numerator * n[j])]  # sizes ascend: once out of reach, always
        a = i[(part[i] != part[i + shift]) & (~two[i] | (side[i] != side[i + shift]))]
        differ = x[a] ^ x[a + shift]
        d = np.bitwise_count(differ).sum(axis=1, dtype=np.int32)
        near = np.flatnonzero(d <= radius)
        if laid:
            near = near[first_block(differ[near], laid) == block[a[near]]]
        if len(near):
            yield a[near], a[near] + shift, d[near]
        shift += 1


def tile_links(tile: np.ndarray, part: np.ndarray, sets: list[bytes], found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], least: Fraction) -> list[tuple[int, int]]:
    """Links (as row numbers) with a Jaccard similarity of at least `least` that connect what the found pairs of whole tiles can connect, closest first.

    A pair that earlier links of its tile connect isn't compared; sets: the distinct shingles' hashes in order, as bytes."""
    pairs = [np.stack(p, axis=1) for p in found]
    if not pairs:
        return []
    every = np.concatenate(pairs)
    every = every[np.lexsort((every[:, 2], tile[every[:, 0]]))]
    out: list[tuple[int, int]] = []
    now, held, root = None, {}, {}
    for i, j, _ in every.tolist():
        if tile[i] != now:
            now, held, root = tile[i], {}, {}
        ends = []
        for k in (i, j):
            r = int(part[k])
            while (up := root.get(r, r)) != r:
                r = up
            ends.append(r)
            if k not in held:
                held[k] = np.frombuffer(sets[k], np.uint64)
        if ends[0] == ends[1]:
            continue
        few, many = sorted((held[i], held[j]), key=len)
        common = np.count_nonzero(many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few)
        if least.denominator * common >= least.numerator * (len(held[i]) + len(held[j]) - common):
            out.append((i, j))
            root[max(ends)] = min(ends)
    return out


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole tiles (column tile, sorted), as small as the batches allow."""
    held: list[pa.RecordBatch] = []
    for batch in _then_none(batches):
        if batch is None:
            if held:
                yield pa.Table.from_batches(held)
        elif batch.num_rows:
            tile = batch.column("tile").to_numpy()
            whole = int(np.flatnonzero(tile == tile[-1])[0])  # the last tile may go on in the next batch
            if whole or held and held[-1].column("tile")[-1].as_py() != tile[0]:
                yield pa.Table.from_batches([*held, batch.slice(0, whole)])
                held = []
            held.append(batch.slice(whole))


def _columns(table: pa.Table, longs: int) -> list[np.ndarray]:
    found = [table.column(c).to_numpy() for c in ("tile", "side", "two", "block", "n", "part")]
    return [*found, np.stack([u64(table.column(w).to_numpy()) for w in names_of(longs)], axis=1)]


def candidate_links(rows: DataFrame, distinct: DataFrame, parts: DataFrame, shingle_words: int, radius: int, longs: int, bits: int, least: Fraction, tile_rows: int) -> DataFrame:
    """(a, b): links with a Jaccard similarity of at least `least` that connect all pairs of nodes of different parts which share a block, are within the radius and are that similar.

    A first pass over the tiles finds the nodes that have a candidate there; the second gets only those, with their shingles'
    hashes, and compares. No row is made for a pair that doesn't link. rows: (id, text, digest); distinct: (node, at, n, w0, ...); parts: (node, part).
    """
    names = names_of(longs)
    laid = blocks_of(longs, radius, bits)
    step = -math.log(float(least)) * (1 + 1e-9) if least < 1 else 1e-9  # sizes that allow `least` are at most a step apart
    nodes = distinct.select("node", "n", *names).join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    nodes = staged(nodes.withColumn("rank", F.floor(F.log(F.greatest("n", F.lit(1))) / step)), "parts")
    every = tiles(_keyed(nodes, laid, "node", "part", "n", "rank", *names), 1, tile_rows, "block", "node", "part", "n", *names)
    n = shuffle_partitions(distinct.sparkSession)
    member = pa.schema([("tile", pa.int64()), ("side", pa.int32()), ("two", pa.bool_()), ("block", pa.int32()), ("node", pa.int64())])

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches):
            cols = _columns(table, longs)
            hit = np.zeros(table.num_rows, bool)
            for i, j, _ in tile_pairs(*cols, radius, least, laid):
                hit[i] = hit[j] = True
            if hit.any():
                yield from table.select(member.names).filter(pa.array(hit)).cast(member).to_batches()

    met = staged(every.repartition(n, "tile").sortWithinPartitions("tile", "n").mapInArrow(seek, "tile long, side int, two boolean, block int, node long"), "members")
    wanted = met.select("node").distinct()
    text = node_texts(rows, distinct, wanted)
    hashed = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def sets(batch: pa.RecordBatch) -> dict:
        return {"node": batch.column("node"), "shingles": [np.unique(shingle_hashes(t, shingle_words)).tobytes() for t in batch.column("text").to_pylist()]}

    own = staged(text.mapInArrow(mapper(hashed, "text", sets), "node long, shingles binary"), "sets")
    full = met.join(nodes.select("node", "part", "n", *names), "node").join(own, "node")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches):
            cols = _columns(table, longs)
            node, own = table.column("node").to_numpy(), table.column("shingles").to_pylist()
            made = tile_links(cols[0], cols[5], own, tile_pairs(*cols, radius, least, laid), least)
            if made:
                i, j = np.array(made).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))], schema=out)

    columns = ["tile", "side", "two", "block", "node", "n", "part", *names, "shingles"]
    return staged(full.select(*columns).repartition(n, "tile").sortWithinPartitions("tile", "n").mapInArrow(compare, "a long, b long"), "links")


def node_texts(rows: DataFrame, distinct: DataFrame, ends: DataFrame) -> DataFrame:
    """(node, text) of the distinct nodes in ends, a text for each. rows: (id, text, digest); distinct: (node, at), at being the id and digest of one of a node's rows."""
    want = distinct.join(ends, "node", "left_semi").select("node", F.col("at.id").alias("__id"), F.col("at.digest").alias("__digest"))
    met = rows.join(want, F.col("id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest"))).select("node", "text")
    return staged(met.groupBy("node").agg(F.first("text").alias("text")), "texts")


def confirmed(texts: DataFrame, pairs: DataFrame, shingle_words: int, least: Fraction) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard similarity of at least `least`, compared shingle by shingle; texts: (node, text)."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batch: pa.RecordBatch) -> dict:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        left, right = batch.column("left"), batch.column("right")
        got: dict[str, list] = {"a": [], "b": []}
        last: list = [None, None, None, None]  # a, its set, b, its set
        for k, (i, j) in enumerate(zip(a, b, strict=True)):
            if last[0] != i:
                last[:2] = i, shingle_set(left[k].as_py(), shingle_words)
            if last[2] != j:
                last[2:] = j, shingle_set(right[k].as_py(), shingle_words)
            common = len(last[1] & last[3])
            if least.denominator * common >= least.numerator * (len(last[1]) + len(last[3]) - common):
                got["a"].append(i)
                got["b"].append(j)
        return got

    return staged(both.select("a", "b", "left", "right").mapInArrow(mapper(out, "left", compare), "a long, b long"), "links")


def short_links(distinct: DataFrame, parts: DataFrame, least: Fraction, tile_rows: int) -> DataFrame:
    """(a, b): links that connect all pairs of nodes of different parts with a Jaccard similarity of at least `least`, of the nodes with the hashes of all their shingles (few): exact.

    Two sets of n and m shingles with this similarity share one of the first n - ceil(least * n) + 1 of the one and as many of the other, in any
    order of all shingles. Here the rarest come first; shingles of one node alone have no partner, so nodes meet by equality on few shingles, common ones only if they have
    none that are rarer. Who meets goes through `tiles`, as candidates by blocks do. distinct: (node, n, few); parts: (node, part).
    """
    num, den = least.numerator, least.denominator
    short = distinct.where("few IS NOT NULL AND n > 0").select("node", "n", "few")
    words = short.select("node", "n", F.explode("few").alias("value"))
    common = words.groupBy("value").agg(F.count(F.lit(1)).alias("count")).where("count > 1")
    kept = words.join(common, "value").groupBy("node").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("count", "value"))).alias("own"))
    first = F.col("n") - F.floor((F.col("n") * num + den - 1) / den) + 1 - (F.col("n") - F.size("own"))  # those of one node alone are the rarest
    cut = kept.withColumn("own", F.slice("own", F.lit(1), F.greatest(first, F.lit(0)).cast("int")))
    step = -math.log(float(least)) * (1 + 1e-9) if least < 1 else 1e-9
    whole = cut.select("node", F.explode("own.value").alias("value")).join(short, "node").join(parts, "node", "left")
    keyed = staged(whole.select(F.lit(0).alias("block"), "value", F.floor(F.log("n") / step).alias("rank"), "node", F.coalesce("part", "node").alias("part"), "n", "few"), "short")
    laid = tiles(keyed, 1, tile_rows, "node", "part", "n", "few").repartition(shuffle_partitions(distinct.sparkSession), "tile").sortWithinPartitions("tile", "n")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches):
            tile, side, two, n, part, node = (table.column(c).to_numpy() for c in ("tile", "side", "two", "n", "part", "node"))
            own = [np.sort(np.array(x, np.int64).view(np.uint64)).tobytes() for x in table.column("few").to_pylist()]
            none = np.zeros(len(tile), np.int64)
            made = tile_links(tile, part, own, tile_pairs(tile, side, two, none, n, part, none.view(np.uint64).reshape(-1, 1), 0, least, []), least)
            if made:
                i, j = np.array(made).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))], schema=out)

    return staged(laid.mapInArrow(compare, "a long, b long"), "links")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8, shingle_words: int = 5, longs: int = 8, radius: int = 104, bits: int = 12, tile_rows: int = 512, short: int = 16) -> DataFrame:
    """(id, digest, component, first): for each row its id, a hash of its text, the smallest id that chains of pairs with a Jaccard similarity of at least `least` reach, and whether it is its component's first.

    Similarity is that of the sets of shingles. Texts with equal sets are one node. Fingerprints of the sets give
    candidates, and the sets confirm each: no pair below `least` links. Candidates of a tile are compared there, closest
    first, and only until what can link hangs together, so large families of copies make no row for each of their pairs.
    Fingerprints of few shingles are coarse, so a text of at most `short` shingles also meets every other by its rarest shingles, exactly (`short_links`).
    A first round with a small radius links near-identical texts beforehand. Null texts count as empty, and empty texts are
    copies of each other. First is the row with the smallest (id, digest), null ids last; several rows may be, if they
    share both. Other rules for ids as in `near_duplicates`. An empty table gives no rows; further columns aren't read.
    """
    names = names_of(longs)
    exact = Fraction(least).limit_denominator(1000)
    most = int(short / exact)  # what a set of `short` shingles can be similar to
    schema = pa.schema([("id", pa.int64()), ("digest", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("few", pa.list_(pa.int64())), *[(w, pa.int64()) for w in names]])

    def make(batch: pa.RecordBatch) -> dict:
        sets = [np.unique(shingle_hashes(t, shingle_words)) for t in batch.column("text").to_pylist()]
        found = np.array([folded(h, longs) for h in sets]).reshape(-1, longs)
        return {"id": batch.column("id"), "digest": batch.column("digest"), "node": [_set_name(h) for h in sets], "n": [len(h) for h in sets], "few": [h.view(np.int64) if len(h) <= most else None for h in sets]} | {w: found[:, k] for k, w in enumerate(names)}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("digest", F.xxhash64("text"))
    prints = staged(rows.mapInArrow(mapper(schema, "text", make), ", ".join(f"{x} {'array<long>' if x == 'few' else 'long'}" for x in schema.names)), "simhash")
    distinct = staged(prints.groupBy("node").agg(F.min(F.struct("id", "digest")).alias("at"), F.first("n").alias("n"), F.first("few").alias("few"), *[F.first(w).alias(w) for w in names]), "distinct")
    found = staged(links(distinct.select("node", "w0", "w1"), 12, 4 * tile_rows, 2, bits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "pairs")
    ends = found.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sure = confirmed(node_texts(rows, distinct, ends), found, shingle_words, exact)
    parts = components(sure, []).withColumnRenamed("root", "part")
    sure = sure.unionAll(candidate_links(rows, distinct, parts, shingle_words, radius, longs, bits, exact, tile_rows)).unionAll(short_links(distinct, parts, exact, tile_rows))
    of = distinct.select("node").join(components(sure, []), "node", "left").withColumn("root", F.coalesce("root", "node"))
    each = prints.select("id", "digest", "node").join(of.select("node", "root"), "node")
    key = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    best = each.groupBy("root").agg(F.min(key).alias("best"))
    return each.join(best, "root").select("id", "digest", F.col("best.id").alias("component"), (key == F.col("best")).alias("first"))


def hex_fingerprint(column: str):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
