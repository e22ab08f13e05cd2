"""Toxicity by compression distance: windows of a text are compressed with an ordinary and with a toxic zstandard dictionary.

zstandard trains both: the ordinary one on windows of ordinary texts, the toxic one on what sets toxic texts apart, that is
on runs of the words that toxic training texts hold clearly more often (see `telling_words`). Behind the toxic content stands
the ordinary one again, so that the two lengths differ only by what toxic text adds. Sizes and segment lengths of the toxic
dictionary are chosen on the training texts. A window's savings are held against thresholds calibrated on ordinary windows,
and a logistic model of the counts turns them into a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import appended, mapper, staged

WINDOW = 64
LEVEL = 6


def lower(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def windows(raw: bytes, width: int = WINDOW) -> list[bytes]:
    """Consecutive windows over all of raw, of `width` bytes and on to the next space if one follows within 64; one empty window for no text."""
    out, i, n = [], 0, len(raw)
    while i < n:
        j = i + width
        if j < n:
            k = raw.find(b" ", j, j + 64)
            j = k if k >= 0 else j
        out.append(raw[i:j])
        i = j
    return out or [b""]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_dict_id=False, write_checksum=False)


@lru_cache(maxsize=4)
def compressors(ordinary: bytes, toxic: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    """Made once in a Python worker; workers are reused by later tasks."""
    return compressor(ordinary), compressor(toxic)


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    #: Savings in bytes that one in ten, a hundred and a thousand ordinary windows pass.
    thresholds: tuple[float, ...]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def features(self, text: str | None) -> list[float]:
        return features(text, compressors(self.ordinary, self.toxic), self.thresholds)

    def probability(self, texts: Iterable[str | None]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, FEATURES)
        z = ((x - self.mean) / self.scale) @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


QUANTILES = (0.9, 0.99, 0.999)
FEATURES = 3 + 3 * len(QUANTILES)


def savings(text: str | None, pair: tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]) -> np.ndarray:
    """For each window of a text, the bytes that it takes with the ordinary dictionary less those with the toxic one."""
    ordinary, toxic = pair
    return np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(lower(text))], dtype=np.float64)


def features(text: str | None, pair: tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor], thresholds: tuple[float, ...]) -> list[float]:
    """The largest and second largest saving of a window, the windows' number, and for each threshold the share of windows over it and what they save beyond it (by window and by its root)."""
    saved = savings(text, pair)
    n = len(saved)
    top = np.sort(saved)[::-1][:2]
    out = [top[0], top[1] if n > 1 else 0.0, np.log(n)]
    for t in thresholds:
        beyond = np.maximum(saved - t, 0).sum()
        out += [np.count_nonzero(saved > t) / n, beyond / n, beyond / n**0.5]
    return out


def telling_words(toxic: list[bytes], ordinary: list[bytes], least_docs: int = 5) -> dict[bytes, float]:
    """For each word that at least `least_docs` toxic texts hold, by how many standard errors its share among toxic texts exceeds that among ordinary ones."""
    n1, n0 = len(toxic), len(ordinary)
    c1 = Counter(w for b in toxic for w in set(b.split()))
    c1 = {w: n for w, n in c1.items() if n >= least_docs}
    c0 = Counter(w for b in ordinary for w in set(b.split()) if w in c1)
    out = {}
    for w, n in c1.items():
        p = (n + c0[w]) / (n1 + n0)
        out[w] = (n / n1 - c0[w] / n0) / (p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12) ** 0.5
    return out


def telling_runs(toxic: list[bytes], telling: set[bytes], words: int) -> list[bytes]:
    """Training samples of the toxic dictionary: each toxic text without the words that ordinary texts hold as often, cut into runs of `words` words."""
    out = []
    for b in toxic:
        left = [w for w in b.split() if w in telling]
        out += [(b" " + b" ".join(left[i : i + words]) + b" ").ljust(8) for i in range(0, len(left), words)]
    return out


#: Bytes of a trained dictionary that hold its entropy tables, at most about; the content follows.
TABLES = 180


def trained(size: int, samples: list[bytes], **how: int) -> bytes | None:
    """The content of a dictionary that zstandard trains on the samples; None if they are too few."""
    try:
        raw = zstandard.train_dictionary(size, samples, **how).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return None
    return raw[TABLES:] if len(raw) > TABLES + 64 else raw[-64:]


def prior_weights(y: np.ndarray, prior: float | None, care: float = 1.0) -> np.ndarray:
    """Weights that give label 1 the share `prior` that it has where the sample was drawn, times `care`; all 1 without a prior."""
    share = y.mean()
    if prior is None or not 0 < prior < 1:
        return np.where(y == 1, care, 1.0)
    return np.where(y == 1, care * prior / share, (1 - prior) / (1 - share))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method on a weighted, ridge-penalised logistic loss; the first coefficient is the constant."""
    a = np.c_[np.ones(len(x)), x]
    w = np.zeros(a.shape[1])
    penalty = np.r_[1e-6, np.full(a.shape[1] - 1, ridge)]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (weight * (p - y)) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


#: A toxic document that slips through weighs as much as this many ordinary ones that are taken for toxic.
CARE = 2.0
#: What is tried for the toxic dictionary: standard errors that a telling word needs, segment length, bytes, words to a sample.
TRIED = ((6.0, 32, 1024, 4), (6.0, 48, 1024, 6), (8.0, 24, 1024, 2), (8.0, 32, 512, 3), (12.0, 32, 1024, 4))


def _fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(mean, scale, weights, weighted loss) of a logistic model."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = (x - mean) / scale
    w = logistic(a, y, weight)
    z = np.clip(a @ w[1:] + w[0], -30, 30)
    return mean, scale, w, float((weight * (np.log1p(np.exp(z)) - y * z)).sum() / weight.sum())


def fit(texts: list[str | None], labels: list[int], prior: float | None = None, dictionary_bytes: int = 8192, most_windows: int = 20_000, most_tried: int = 400) -> Model:
    """A model of the given texts; prior: the share of label 1 where they come from, if the sample's is another.

    The ordinary dictionary is trained on at most `most_windows` windows, drawn with a fixed seed; the dictionaries in TRIED
    are compared on at most `most_tried` texts of each label. With one label only, every text scores 0.993 (all 1) or 0.007
    (all 0); without labels 0.5.
    """
    raw = [lower(t) for t in texts]
    y = np.array(labels, dtype=float)
    toxic = list(dict.fromkeys(b for b, v in zip(raw, y, strict=True) if v == 1 and b))
    ordinary = list(dict.fromkeys(b for b, v in zip(raw, y, strict=True) if v == 0 and b))
    rng = np.random.default_rng(7)
    some = [w for b in ordinary for w in windows(b)]
    some = [some[i] for i in rng.permutation(len(some))[:most_windows]]
    common = (trained(dictionary_bytes, some) or b" ".join(some)[-dictionary_bytes:]).rjust(16, b" ")
    plain = Model(common, common, (0.0,) * len(QUANTILES), np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1))
    if not len(y) or y.min() == y.max():
        plain.weights[0] = 0.0 if not len(y) else 5.0 * (2 * y[0] - 1)
        return plain
    own = compressor(common)
    base = np.array([len(own.compress(w)) for w in some], dtype=float)

    def model_of(content: bytes) -> Model:
        other = compressor(content + common)
        saved = base - np.array([len(other.compress(w)) for w in some])
        at = tuple(max(0.0, float(np.quantile(saved, q))) for q in QUANTILES) if len(saved) else (0.0,) * len(QUANTILES)
        return Model(common, content + common, at, plain.mean, plain.scale, plain.weights)

    tried = np.sort(np.concatenate([np.flatnonzero(y == v)[:most_tried] for v in (0, 1)]))
    best, least = None, np.inf
    telling = telling_words(toxic, ordinary) if toxic and ordinary else {}
    for least_z, segment, size, words in TRIED:
        content = trained(size, telling_runs(toxic, {w for w, z in telling.items() if z >= least_z}, words), k=segment, d=6)
        if content is None:
            continue
        model = model_of(content)
        loss = _fitted(np.array([model.features(texts[i]) for i in tried]), y[tried], prior_weights(y[tried], None))[3]
        if loss < least:
            best, least = model, loss
    if best is None:  # too little that sets toxic text apart: its texts themselves
        best = model_of(b"\n".join(toxic)[-dictionary_bytes:].rjust(8, b" "))
    best.mean, best.scale, best.weights, _ = _fitted(np.array([best.features(t) for t in texts]), y, prior_weights(y, prior, CARE))
    return best


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, use, most: int = 3000, most_chars: int = 10_000_000, id_col: str = "doc_id", text_col: str = "text", share: float = 0.5, most_lines: int = 400_000) -> tuple[list, list, float | None]:
    """(texts, labels, share of label 1 among all labelled rows): up to `most` labelled texts of at most `most_chars` code points and `most_lines` lines in all, for training.

    A text that alone would take over a quarter of either isn't drawn, so none of any length reaches the driver; the first that fits of each label is in any case.
    Taken are rows for which `use` holds, in the order of a hash of their id; up to `share` of them have label 1. Rows with
    a null label are left out; of rows that share an id the text that sorts first counts. Documents are read once.
    """
    spark = docs.sparkSession
    marked = labels.where(F.col(label).isin(0, 1)).select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("y")).distinct()
    few = marked.where(use(F.col("id"))).withColumn("h", F.xxhash64("id", F.lit(11)))
    prior = few.agg(F.avg("y")).first()[0]
    ones, zeros = (few.where(F.col("y") == v).orderBy("h", "id").limit(n) for v, n in ((1, int(most * share)), (0, most - int(most * share))))
    chosen = ones.unionAll(zeros).collect()  # at most `most` ids
    ids = spark.createDataFrame([(r["id"], r["y"], r["h"]) for r in chosen], "id long, y int, h long")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(ids), "id")
    held = staged(rows.groupBy("id", "y", "h").agg(F.min("text").alias("text")).withColumn("n", F.length("text")).withColumn("lines", F.col("n") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1), "labelled")
    sizes = [r for r in held.select("id", "y", "h", "n", "lines").orderBy("h", "id").collect() if 4 * r["n"] <= most_chars and 4 * r["lines"] <= most_lines]
    first = {r["y"]: r for r in reversed(sizes)}  # of each label
    total, lines, fit_ids = sum(r["n"] for r in first.values()), sum(r["lines"] for r in first.values()), [r["id"] for r in first.values()]
    for r in sizes:  # sizes first, then the texts that fit
        if r is first[r["y"]] or total + r["n"] > most_chars or lines + r["lines"] > most_lines:
            continue
        total, lines = total + r["n"], lines + r["lines"]
        fit_ids.append(r["id"])
    fits = spark.createDataFrame([(i,) for i in set(fit_ids)], "id long")
    found = sorted(held.join(F.broadcast(fits), "id").select("h", "id", "y", "text").collect(), key=lambda r: (r["h"], r["id"], r["y"]))
    return [r["text"] for r in found], [r["y"] for r in found], prior


def with_score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with the probability of label 1 of each row's whole text as a further column `name`. Null texts count as empty; repeated rows and rows without an id stay; an empty table gives no rows; a column of that name is replaced."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    return appended(docs, text_col, name, lambda texts: given.value.probability(texts))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row; see `with_score`."""
    out = pa.schema([("id", pa.int64()), ("score", pa.float64())])
    given = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column("id"), "score": given.value.probability(batch.column("text").to_pylist())}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(mapper(out, "text", make), "id long, score double")
