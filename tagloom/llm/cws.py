"""Document fingerprints by consistent weighted sampling.

A text is a bag of words, each word weighted by how often it occurs. For every sample k and word, gamma(2, 1) variables r
and c and a uniform beta are drawn from a hash of the word and k; a word of weight w gets t = floor(ln w / r + beta) and
ln a = ln c - r (t - beta) - r, and the sample is the (word, t) with the smallest a. Two texts agree on a sample with a
probability equal to the generalised Jaccard similarity of their bags. ln a depends on word, t and k alone and differs
between pairs (word, t) all but surely, so its bits name the sample: a fingerprint keeps 16 hashed bits of each minimum.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import forget, mapper, remembered, shuffle_partitions, small_batches, staged

SAMPLES = 128
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _gamma_table(bits: int = 16) -> np.ndarray:
    """Quantiles of gamma(2, 1) at the middle of 2**bits equal steps, by bisection of 1 - exp(-x)(1 + x)."""
    u = (np.arange(1 << bits) + 0.5) / (1 << bits)
    lo, hi = np.zeros_like(u), np.full_like(u, 60.0)
    for _ in range(60):
        mid = (lo + hi) / 2
        low = -np.expm1(-mid) - mid * np.exp(-mid) < u
        lo, hi = np.where(low, mid, lo), np.where(low, hi, mid)
    return (lo + hi) / 2


_GAMMA = _gamma_table()
_R = _GAMMA.astype(np.float32)
_LN_C = np.log(_GAMMA).astype(np.float32)


def _digest(word: str) -> int:
    try:
        return xxhash.xxh64_intdigest(word)
    except UnicodeEncodeError:
        return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


class Sampler:
    """ln a of every sample, a row for each word and number of times that it occurs.

    About `most` rows are kept, in two generations of half of that each: when the younger is full it becomes the elder, and of
    that elder only what is met again stays. A row's key is the word, and behind a space its number if that isn't 1. One look
    takes at most `most` / 2 keys.
    """

    def __init__(self, samples: int = SAMPLES, most: int = 160_000):
        self.samples, self.half = samples, max(1, most // 2)
        self.offsets = np.arange(1, samples + 1, dtype=np.uint64) * _STEP
        self.index: dict[str, int] = {}
        self.elder: dict[str, int] = {}
        self.table, self.elder_table = (np.empty((self.half, samples), np.float32) for _ in range(2))

    def _draw(self, keys: list[str], at: int, step: int = 256) -> None:
        """Fill the table's rows from `at` on; in steps whose intermediate arrays stay in the processor's cache."""
        words, times = list(keys), np.ones(len(keys), np.float32)
        for i in [i for i, k in enumerate(keys) if " " in k]:
            words[i], _, n = keys[i].partition(" ")
            times[i] = int(n)
        h = np.fromiter(map(_digest, words), np.uint64, len(words))
        whole, spare = (np.empty((step, self.samples), np.uint64) for _ in range(2))
        all_r, all_beta = (np.empty((step, self.samples), np.float32) for _ in range(2))
        for i in range(0, len(keys), step):
            n = min(step, len(keys) - i)
            x, y, r, beta = whole[:n], spare[:n], all_r[:n], all_beta[:n]
            np.add(h[i : i + n, None], self.offsets, out=x)
            for shift, factor in ((30, np.uint64(0xBF58476D1CE4E5B9)), (27, np.uint64(0x94D049BB133111EB)), (31, None)):
                np.right_shift(x, np.uint64(shift), out=y)
                np.bitwise_xor(x, y, out=x)
                if factor is not None:
                    np.multiply(x, factor, out=x)
            base, places = self.table[at + i : at + i + n], y.view(np.int64)
            np.bitwise_and(x, np.uint64(0xFFFF), out=y)
            np.take(_R, places, out=r, mode="clip")
            np.right_shift(x, np.uint64(16), out=y)
            np.bitwise_and(y, np.uint64(0xFFFF), out=y)
            np.take(_LN_C, places, out=base, mode="clip")
            np.multiply(x.view("<u4").reshape(n, self.samples, 2)[:, :, 1], np.float32(2**-32), out=beta, casting="unsafe")
            base += r * (beta - np.float32(1))
            many = np.flatnonzero(times[i : i + n] > 1)
            if len(many):
                t = np.floor(np.log(times[i + many])[:, None] / r[many] + beta[many])
                base[many] -= r[many] * t

    def rows(self, keys: list[str]) -> np.ndarray:
        """The keys' places in the table, which hold until the next call."""
        wanted = set(keys)
        new = wanted.difference(self.index)
        if len(self.index) + len(new) > self.half:
            self.elder, self.index = self.index, {}
            self.elder_table, self.table = self.table, self.elder_table
            new = wanted
        if again := list(self.elder.keys() & new):
            at = len(self.index)
            np.take(self.elder_table, [self.elder[k] for k in again], axis=0, out=self.table[at : at + len(again)], mode="clip")
            self.index.update(zip(again, range(at, at + len(again)), strict=True))
            new = new.difference(again)
        if new:
            at = len(self.index)
            self._draw(list(new), at)
            self.index.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))

    def signatures(self, texts: list[str | None], slice_rows: int = 20_000) -> np.ndarray:
        """16-bit signatures, a row for each text; a text without words gets zeros. Texts that share words do best close together."""
        slice_rows = min(slice_rows, self.half)
        low = np.full((len(texts), self.samples), np.inf, np.float32)
        room = np.empty((slice_rows, self.samples), np.float32)
        keys: list[str] = []
        spans: list[tuple[int, int, int]] = []

        def flush() -> None:
            row = self.rows(keys)
            for i, first, end in spans:
                part = room[: end - first]
                np.take(self.table, row[first:end], axis=0, out=part, mode="clip")
                np.minimum(low[i], part.min(axis=0), out=low[i])
            keys.clear()
            spans.clear()

        for i, t in enumerate(texts):
            bag = [w if n == 1 else f"{w} {n}" for w, n in Counter((t or "").split()).items()]
            for at in range(0, len(bag), slice_rows):
                part = bag[at : at + slice_rows]
                if len(keys) + len(part) > slice_rows:
                    flush()
                spans.append((i, len(keys), len(keys) + len(part)))
                keys += part
        flush()
        bits = low.view(np.uint32).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        out = (bits >> np.uint64(48)).astype(np.uint16)
        out[np.isinf(low).all(axis=1)] = 0
        return out


@remembered
@lru_cache(maxsize=1)
def sampler_of(samples: int) -> Sampler:
    """One in a Python worker: the words that it has drawn for outlive the task, as workers are reused."""
    return Sampler(samples)


def to_hex(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def from_hex(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of samples that agree, corrected for agreement of 16 bits by chance."""
    same = (a == b).mean(axis=-1)
    return np.clip((same - 2.0**-16) / (1 - 2.0**-16), 0.0, 1.0)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(id, fingerprint hex) for each row; null texts count as empty, which have the fingerprint of zeros; equal texts have equal ones."""
    out = pa.schema([("id", pa.int64()), ("fingerprint", pa.string())])

    def make(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column("id"), "fingerprint": [to_hex(s) for s in sampler_of(samples).signatures(batch.column("text").to_pylist())]}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(mapper(out, "text", make, sampler_of), "id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """text with its last quarter (rounded down) replaced by as many code points, or all, from the start of `following`."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def splits_of(sizes: list[tuple[int, int]], most: int) -> np.ndarray:
    """First ids of runs, from (first id, code points) of ranges in order: ranges in a row are put together up to `most` code points."""
    out: list[int] = []
    held = 0
    for first, chars in sizes:
        if not out or held + chars > most:
            out.append(first)
            held = 0
        held += chars
    return np.array(out, dtype=np.int64)


def chain(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_chars: int = 8 << 20) -> DataFrame:
    """(run, head, id, text), each run in a partition of its own: rows in runs by id. The next run's first rows come last in a run, marked head.

    Runs have about `run_chars` code points (more if one id or a short range of ids has more), but there are two to sixteen for each shuffle
    partition, however large the table: a run streams through its task, so it may be long. Splits between runs are ids, from the sizes of
    eight ranges a run of ids and lengths alone; only these come to the driver. The last run is followed by the table's first rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(F.col("id").isNotNull())
    sizes = staged(rows.select("id", F.length("text").cast("long").alias("chars")), "lengths")
    total = sizes.agg(F.sum("chars")).first()[0] or 0
    least = 2 * shuffle_partitions(spark)
    many = max(least, min(4 * least, -(-int(total) // run_chars)))
    ranges = sizes.repartitionByRange(8 * many, "id").groupBy(F.spark_partition_id().alias("p")).agg(F.min("id").alias("id"), F.sum("chars").alias("chars")).collect()
    splits = splits_of(sorted((r["id"], r["chars"]) for r in ranges), max(1, int(total) // many))
    given = spark.sparkContext.broadcast(splits)

    @F.pandas_udf("array<int>")
    def runs(ids):
        import pandas as pd

        s = given.value
        at = np.searchsorted(s, ids.to_numpy(), "right") - 1
        first = s[at] == ids.to_numpy()
        return pd.Series([[int(i), int(i - 1) % len(s)] if f else [int(i)] for i, f in zip(at, first, strict=True)])

    of = rows.withColumn("r", runs("id"))
    dealt = of.select(F.posexplode("r").alias("head", "run"), "id", "text").select("run", "head", "id", "text")
    return dealt.repartitionById(max(1, len(splits)), "run").sortWithinPartitions("run", "head", "id", "text")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), a row per row with an id.

    The next document of a row is the one with the smallest larger id, or after the last id the first; of several rows
    with that id the one whose text sorts first (by UTF-8 bytes). A row with a null id has no place in the order and is left out. A
    lone id is its own next. An empty table gives no rows.
    """
    out = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(sampler_of)
        sampler = sampler_of(samples)
        waiting: list[tuple[int, str, int | np.ndarray]] = []  # rows of one id whose next id isn't here yet; a place in `order`, or a signature
        before = None
        for whole in batches:
            for batch in small_batches(whole, "text", 2 << 20):
                ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
                order: list[str] = []  # texts and their edited texts, close together
                done: list[tuple[int, str, int | np.ndarray, int, int]] = []  # id, text, its place or signature, places of the next and the edited text
                for i, key in enumerate(zip(batch.column("run").to_pylist(), batch.column("head").to_pylist(), ids, strict=True)):
                    place = len(order)
                    order.append(texts[i])
                    if before is not None and key != before:
                        if key[0] == before[0] and not before[1]:
                            for d, t, m in waiting:
                                done.append((d, t, m, place, len(order)))
                                order.append(edited(t, texts[i]))
                        waiting = []
                    before = key
                    if not key[1]:
                        waiting.append((ids[i], texts[i], place))
                sigs = sampler.signatures(order)
                waiting = [(d, t, sigs[m].copy() if isinstance(m, int) else m) for d, t, m in waiting]
                if done:
                    new = [order[d[4]] for d in done]
                    own = np.array([sigs[d[2]] if isinstance(d[2], int) else d[2] for d in done])
                    following, other = sigs[[d[3] for d in done]], sigs[[d[4] for d in done]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([d[0] for d in done], pa.int64()),
                            pa.array([len(d[1]) for d in done], pa.int64()),
                            pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in new]),
                            pa.array([to_hex(s) for s in own]),
                            pa.array([to_hex(s) for s in other]),
                            pa.array(likeness(own, other)),
                            pa.array(likeness(own, following)),
                        ],
                        schema=out,
                    )

    return chain(docs, id_col, text_col).mapInArrow(run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
