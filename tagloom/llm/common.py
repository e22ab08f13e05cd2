"""What the operators share: table access, staging in the shared folder, Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.staging import new_folder, staged  # noqa: F401

#: A word: a run of anything but the six ASCII white-space characters. Java regex.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose column holds at most about `limit` bytes each (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    if sizes.sum() <= limit:
        yield batch
        return
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


_MEMORIES: list = []


def remembered(f):
    """Mark a cached function whose results outlive a task in a Python worker that is used again."""
    _MEMORIES.append(f)
    return f


def forget(keep=None) -> None:
    """Drop what other operators have left in this Python worker, so that it holds one operator's memory at a time, and give back what Arrow has freed."""
    for f in _MEMORIES:
        if f is not keep:
            f.cache_clear()
    pa.default_memory_pool().release_unused()


def mapper(out: pa.Schema, column: str, f: Callable[[pa.RecordBatch], dict[str, Iterable]], keep=None):
    """An Arrow mapper for mapInArrow: f gets slices of bounded size and returns the output columns. keep: the operator's own memory (see `forget`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(keep)
        for whole in batches:
            for batch in small_batches(whole, column):
                if batch.num_rows:
                    made = f(batch)
                    yield pa.RecordBatch.from_arrays([made[x.name] if isinstance(made[x.name], pa.Array) else pa.array(made[x.name], type=x.type) for x in out], schema=out)

    return run


def _appended(df: DataFrame, text_col: str, name: str, kind: str, f: Callable[[list], pa.Array]) -> DataFrame:
    names = [c for c in df.columns if c.lower() != name.lower()]
    source = fresh(df, "__text")
    rows = df.select(*names, F.col(text_col).cast("string").alias(source))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for whole in batches:
            for b in small_batches(whole, source):
                if b.num_rows:
                    yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], f(b.column(source).to_pylist())], names=[*names, name])

    return rows.mapInArrow(run, rows.select(*names).schema.add(name, kind))


def appended(df: DataFrame, text_col: str, name: str, f: Callable[[list], Iterable[float]]) -> DataFrame:
    """df with a double column `name` (one of that name, whatever the case, is replaced): f of the texts, a slice at a time. Other columns pass through as they are."""
    return _appended(df, text_col, name, "double", lambda texts: pa.array(np.asarray(f(texts), dtype=np.float64)))


def appended_text(df: DataFrame, text_col: str, name: str, f: Callable[[str | None], str | None]) -> DataFrame:
    """As `appended`, with a string column: f of each text."""
    return _appended(df, text_col, name, "string", lambda texts: pa.array([f(t) for t in texts], type=pa.string()))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't use (whatever the case)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name = f"_{name}"
    return name


def crc_mod(column: str, by: int):
    """crc32 of the id as decimal text, modulo `by`."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(by)


def u64(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int64, copy=False).view(np.uint64)
