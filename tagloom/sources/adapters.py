"""External answers (vision models, OCR, detectors) as tables: a cache by content hash, and an adapter for what it lacks. No query needs one."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.lookup import worklist


def answer(requests: DataFrame, cache: DataFrame, fields: list[str], ask: Callable[[pd.DataFrame], list[str | None]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(requests with answers, new cache rows): known answers from the cache (key, answer), the rest from `ask`, one call per batch; without an adapter they stay null."""
    known, work = worklist(requests, cache.select("key", "answer"), fields)
    if ask is None:
        return known, cache.limit(0).select("key", "answer")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"key": f["key"], "answer": ask(f)})

    new = work.mapInPandas(run, "key string, answer string")
    both = cache.select("key", "answer").unionAll(new)
    return known.drop("answer").join(both, "key", "left"), new


def accepted(answers: DataFrame, confidence: str = "confidence") -> DataFrame:
    """Answers with high or medium confidence."""
    return answers.where(F.lower(F.col(confidence)).isin("high", "medium"))


def approved_or_detected(approved: DataFrame, detected: DataFrame, by: str = "drawing_id") -> DataFrame:
    """Regions that a person approved, for drawings that have any, else the detected ones."""
    return approved.unionByName(detected.join(approved.select(by).distinct(), by, "left_anti"), allowMissingColumns=True)
