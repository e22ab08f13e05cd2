"""Document quality by a linear-chain conditional random field over lines.

Each line gets figures of its own and those of its two neighbours; a chain with two states (bad, good) and learned
transitions runs over the lines of a document. Forward-backward gives each line's marginal; their mean, weighted by the
lines' lengths, is the document's quality, which a logistic calibration on the training documents turns into a probability.
Lines have weak labels in training: at first their document's; after half of the rounds, a line whose own figures speak for
the other label as clearly as nine in ten lines of documents with that label do takes it, so chains change state and the
transitions learn more than to stay. All steps are vectorised over many documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import appended, mapper
from tagloom.llm.toxicity import logistic, prior_weights

CHUNK = 1 << 18
#: Chains with more lines than this are cut into blocks; texts are scored in groups of up to eight times as many lines, a longer one with its group.
LONG = 4096
#: Classes of bytes: 0 white space, 1 letters (with all of UTF-8 beyond ASCII), 2 capitals, 3 digits, 4 exclamation marks, 5 bars, 6 symbols, 7 other marks.
CLASS = np.full(256, 7, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = 0
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[33], CLASS[124] = 1, 2, 3, 4, 5
CLASS[128:] = 1
CLASS[[ord(c) for c in "#*$%&<>~^=+@\\/_{}[]"]] = 6
_RNG = np.random.default_rng(20)
BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
PLACE = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
FIGURES = 12


def _chunks(raw: bytes):
    """Runs of whole lines of at most CHUNK bytes (more for one longer line)."""
    at = 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= CHUNK else raw.rfind(b"\n", at, at + CHUNK) + 1 or raw.find(b"\n", at + CHUNK) + 1 or len(raw)
        yield raw[at:end]
        at = end


def _word_hashes(a: np.ndarray, solid: np.ndarray, begin: np.ndarray, stop: np.ndarray, before: int = 0) -> np.ndarray:
    """Hashes of the words a[begin:stop]; before: the bytes of the first one that come before a."""
    long = stop - begin
    flat = np.flatnonzero(solid)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(long) - long, long)
    place[: long[0]] += before
    return np.add.reduceat(BYTE[a[flat]] * PLACE[place & 63] + (place >> 6).astype(np.uint64), np.cumsum(long) - long)


def _mixed(word: np.ndarray, index: np.ndarray) -> np.ndarray:
    return (word ^ (word >> np.uint64(29))) * (index.astype(np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15))


def _figures(by: np.ndarray, words: np.ndarray, again: np.ndarray, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(figures, bytes without the break) of lines with by[k] bytes of class k."""
    x = np.zeros((by.shape[1], FIGURES))
    size = by.sum(0) - 1  # without the break
    full = np.maximum(size - (by[0] - 1), 1)
    some = np.maximum(words, 1)
    x[:, 7], x[:, 8], x[:, 9], x[:, 10] = again / some, distinct / some, np.where(words > 0, full / some / 10, 0), np.log1p(words)
    for i, k in enumerate((2, 3, 4, 5, 6, 7)):
        x[:, i] = by[k] / full
    x[:, 6] = np.log1p(np.maximum(size, 0))
    return x, np.maximum(size, 0)


def _lines(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(figures, hash, bytes) of each line of raw, which ends with a line break."""
    if len(raw) > CHUNK and raw.find(b"\n") == len(raw) - 1:
        return _long_line(raw)
    a = np.frombuffer(raw, np.uint8)
    cls = CLASS[a]
    ends = np.flatnonzero(a == 10)
    starts = np.r_[0, ends[:-1] + 1]
    n = len(starts)
    of = np.repeat(np.arange(n, dtype=np.int32), ends + 1 - starts)
    by = np.stack([np.bincount(of[cls == k], minlength=n) for k in range(8)]).astype(float)
    solid = cls != 0
    begin = np.flatnonzero(solid & np.r_[True, ~solid[:-1]])
    h = np.zeros(n, np.uint64)
    words = again = distinct = np.zeros(n, np.int64)
    if len(begin):
        word = _word_hashes(a, solid, begin, np.flatnonzero(solid & np.r_[~solid[1:], True]) + 1)
        line = of[begin]
        words = np.bincount(line, minlength=n)
        again = np.bincount(line[1:][(word[1:] == word[:-1]) & (line[1:] == line[:-1])], minlength=n)
        order = np.lexsort((word, line))
        w, li = word[order], line[order]
        distinct = np.bincount(li[np.r_[True, (w[1:] != w[:-1]) | (li[1:] != li[:-1])]], minlength=n)
        first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
        index = np.arange(len(line)) - np.repeat(first, np.diff(np.r_[first, len(line)]))
        h[line[first]] = np.add.reduceat(_mixed(word, index), first)
    x, size = _figures(by, words, again, distinct)
    return x, h, size


def _long_line(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of one long line, read in pieces of CHUNK bytes: only its words' hashes are held as a whole."""
    by, held = np.zeros(8), [np.zeros(0, np.uint64)]
    begun, part = 0, np.uint64(0)  # bytes and hash so far of a word that the piece before left open
    for at in range(0, len(raw), CHUNK):
        a = np.frombuffer(raw, np.uint8, min(CHUNK, len(raw) - at), at)
        cls = CLASS[a]
        by += np.bincount(cls, minlength=8)
        solid = cls != 0
        if begun and not solid[0]:
            held.append(np.array([part], np.uint64))
            begun = 0
        begin, stop = np.flatnonzero(solid & np.r_[True, ~solid[:-1]]), np.flatnonzero(solid & np.r_[~solid[1:], True]) + 1
        if not len(begin):
            continue
        word = _word_hashes(a, solid, begin, stop, begun)
        if begun:
            word[:1] += part
        if solid[-1]:
            begun, part, word = int(stop[-1] - begin[-1]) + (begun if len(word) == 1 else 0), word[-1], word[:-1]
        else:
            begun = 0
        held.append(word)
    word = np.concatenate(held)
    h = np.add.reduce(_mixed(word, np.arange(len(word))), dtype=np.uint64)
    x, size = _figures(by[:, None], *(np.array([n]) for n in (len(word), np.count_nonzero(word[1:] == word[:-1]), len(np.unique(word)))))
    return x, np.array([h], np.uint64), size


def _parts(texts: list[str | None], counts: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(figures, hash, bytes) of the texts' lines, about CHUNK bytes at a time; counts gets the lines of each text."""
    pending: list[bytes] = []
    room = 0
    for t in texts:
        raw = (t or "").encode("utf-8", "replace") + b"\n"
        counts.append(raw.count(b"\n"))
        for part in _chunks(raw):
            if pending and room + len(part) > CHUNK:
                yield _lines(b"".join(pending))
                pending, room = [], 0
            pending.append(part)
            room += len(part)
    if pending:
        yield _lines(b"".join(pending))


def _again(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which lines equal an earlier one of their text; lines without words don't."""
    order = np.lexsort((np.arange(len(h)), h, doc))
    out = np.zeros(len(h), bool)
    out[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]]) & (h[order[1:]] != 0)
    return out


def line_figures(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(figures with those of the neighbours, bytes of each line, lines of each text): a text without lines has one empty line."""
    counts: list[int] = []
    found = list(_parts(texts, counts))
    if not counts:
        return np.zeros((0, 3 * FIGURES)), np.zeros(0), np.zeros(0, np.int64)
    x, h, size = (np.concatenate(c) for c in zip(*found, strict=True))
    count = np.array(counts)
    doc = np.repeat(np.arange(len(count)), count)
    x[:, 11] = _again(h, doc)
    before, after = np.zeros_like(x), np.zeros_like(x)
    same = doc[1:] == doc[:-1]
    before[1:][same] = x[:-1][same]
    after[:-1][same] = x[1:][same]
    return np.concatenate([x, before, after], axis=1), size, count


def _forward(e: np.ndarray, move: np.ndarray, start: float) -> np.ndarray:
    """Forward log-odds of one long chain, in blocks: what each does to either state, then what enters each, then its lines, all blocks side by side."""
    n = len(e) - 1
    wide = max(1, math.isqrt(n))
    tall = -(-n // wide)
    own = np.concatenate([e[1:], np.zeros(tall * wide - n)]).reshape(tall, wide)
    bad, good = np.tile([[0.0], [-np.inf]], tall), np.tile([[-np.inf], [0.0]], tall)  # by the state that entered
    for t in range(wide):
        bad, good = np.logaddexp(bad + move[0, 0], good + move[1, 0]), own[:, t] + np.logaddexp(bad + move[0, 1], good + move[1, 1])
    p = np.empty(tall)
    now = e[0] + start
    for k in range(tall):
        p[k] = now
        now = np.logaddexp(good[0, k], good[1, k] + now) - np.logaddexp(bad[0, k], bad[1, k] + now)
    out = np.empty((tall, wide))
    for t in range(wide):
        p = out[:, t] = own[:, t] + np.logaddexp(move[0, 1], p + move[1, 1]) - np.logaddexp(move[0, 0], p + move[1, 0])
    return np.concatenate([[e[0] + start], out.ravel()[:n]])


def _chains(e: np.ndarray, count: np.ndarray, move: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log-odds (good against bad) of every line; e: the lines' own log-odds, move[i, j]: from state i to j."""
    first = np.cumsum(count) - count
    a, b = np.empty_like(e), np.zeros_like(e)
    a[first] = e[first] + start
    for k in np.flatnonzero(count > LONG):
        of = slice(first[k], first[k] + count[k])
        a[of] = _forward(e[of], move, start)
        b[of] = _forward(e[of][::-1], move.T, 0.0)[::-1] - e[of]
    order = np.argsort(-count, kind="stable")
    order = order[count[order] <= LONG]
    ranked, begin = count[order], first[order]
    longest = int(ranked.max(initial=0))
    for t in range(1, longest):
        at = begin[: np.searchsorted(-ranked, -t, "left")] + t  # chains longer than t
        p = a[at - 1]
        a[at] = e[at] + np.logaddexp(move[0, 1], p + move[1, 1]) - np.logaddexp(move[0, 0], p + move[1, 0])
    last = begin + ranked - 1
    for t in range(1, longest):
        at = last[: np.searchsorted(-ranked, -t, "left")] - t
        q = e[at + 1] + b[at + 1]
        b[at] = np.logaddexp(move[1, 0], move[1, 1] + q) - np.logaddexp(move[0, 0], move[0, 1] + q)
    return a, b


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    move: np.ndarray
    start: float
    calibration: np.ndarray

    def marginals(self, x: np.ndarray, count: np.ndarray) -> np.ndarray:
        e = np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias
        a, b = _chains(e, count, self.move, self.start)
        return _sigmoid(a + b)

    def emissions(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(own log-odds of each line, its bytes, lines of each text). Of a line three numbers are held, not its figures: what it says for itself, for the line after it and for the one before it."""
        mean, scale, weights = (v.reshape(3, FIGURES) for v in (self.mean, self.scale, self.weights))

        def told(x: np.ndarray, of: slice) -> np.ndarray:
            return np.stack([np.clip((x - mean[k, of]) / scale[k, of], -6, 6) @ weights[k, of] for k in range(3)])

        most, last = slice(0, FIGURES - 1), slice(FIGURES - 1, FIGURES)
        counts: list[int] = []
        says, h, size = (np.concatenate(c, axis=-1) for c in zip(*((told(x[:, most], most), h, s) for x, h, s in _parts(texts, counts)), strict=True))
        count = np.array(counts)
        doc = np.repeat(np.arange(len(count)), count)
        again = _again(h, doc)
        del h
        no, yes = told(np.array([[0.0], [1.0]]), last).T
        says += np.where(again, yes[:, None], no[:, None])
        none = told(np.zeros((1, FIGURES)), slice(0, FIGURES))[:, 0]  # where a text has no line before or after
        same = doc[1:] == doc[:-1]
        e = says[0] + self.bias
        e[1:] += np.where(same, says[1, :-1], none[1])
        e[:-1] += np.where(same, says[2, 1:], none[2])
        e[0] += none[1]
        e[-1] += none[2]
        return e, size, count

    def quality(self, texts: list[str | None]) -> np.ndarray:
        """The mean marginal, weighted by length (plus one, so that an empty text counts its empty line)."""
        out, group, lines = [np.zeros(0)], [], 0
        for i, t in enumerate(texts):
            group.append(t)
            lines += (t or "").count("\n") + 1
            if lines > 8 * LONG or i == len(texts) - 1:
                e, size, count = self.emissions(group)
                a, b = _chains(e, count, self.move, self.start)
                first = np.cumsum(count) - count
                out.append(np.add.reduceat(_sigmoid(a + b) * (size + 1), first) / np.add.reduceat(size + 1, first))
                group, lines = [], 0
        return np.concatenate(out)

    def probability(self, texts: list[str | None]) -> np.ndarray:
        q = np.clip(self.quality(texts), 1e-4, 1 - 1e-4)
        return _sigmoid(self.calibration[0] + self.calibration[1] * np.log(q / (1 - q)))


def weak_labels(e: np.ndarray, want: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Labels of lines from their documents' (want) and their own log-odds e: a line takes the other label if e is on that side of zero and
    beyond the tenth of that label's lines that is least clear; the line that speaks most for its document's label keeps it."""
    out = want.copy()
    if not (want == 1).any() or not (want == 0).any():
        return out
    out[(want == 0) & (e > max(0.0, float(np.quantile(e[want == 1], 0.1))))] = 1.0
    out[(want == 1) & (e < min(0.0, float(np.quantile(e[want == 0], 0.9))))] = 0.0
    first = np.cumsum(count) - count
    doc = np.repeat(np.arange(len(count)), count)
    clear = np.where(want == 1, e, -e)
    top = clear == np.maximum.reduceat(clear, first)[doc]
    out[top] = want[top]
    return out


def fit(texts: list[str | None], labels: list[int], prior: float | None = None, rounds: int = 120, rate: float = 0.1, ridge: float = 1e-3) -> Model:
    """Adam on the mean log-likelihood of the chains; prior: the share of label 1 where the texts come from. With one label only, every text scores 0.993 (all 1) or 0.007 (all 0); without labels 0.5."""
    x, size, count = line_figures(texts)
    wide = 3 * FIGURES
    model = Model(np.zeros(wide), np.ones(wide), np.zeros(wide), 0.0, np.zeros((2, 2)), 0.0, np.array([0.0, 0.0]))
    y = np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        model.calibration[0] = 0.0 if not len(y) else 5.0 * (2 * y[0] - 1)
        return model
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - model.mean) / model.scale, -6, 6)
    want = np.repeat(y, count)
    # each document counts once, each class half
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    each = np.repeat(weight / count, count)
    inner = np.ones(len(z), bool)
    inner[np.cumsum(count) - 1] = False
    i = np.flatnonzero(inner)
    theta = np.zeros(wide + 6)  # weights, bias, start, four moves
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        move = theta[wide + 2 :].reshape(2, 2)
        e = z @ theta[:wide] + theta[wide]
        if k == rounds // 2 + 1:
            want = weak_labels(e, want, count)
        a, b = _chains(e, count, move, theta[wide + 1])
        p = _sigmoid(a + b)
        miss = (want - p) * each
        g = np.empty_like(theta)
        g[:wide] = miss @ z - ridge * theta[:wide]
        g[wide] = miss.sum()
        g[wide + 1] = miss[np.cumsum(count) - count].sum()
        q = e[i + 1] + b[i + 1]
        pair = np.stack([np.full(len(i), move[0, 0]), move[0, 1] + q, a[i] + move[1, 0], a[i] + move[1, 1] + q], axis=1)
        pair = np.exp(pair - pair.max(1, keepdims=True)) if len(i) else pair
        pair /= pair.sum(1, keepdims=True) if len(i) else 1
        s, t = want[i], want[i + 1] if len(i) else want[i]
        seen = np.stack([(1 - s) * (1 - t), (1 - s) * t, s * (1 - t), s * t], axis=1)
        g[wide + 2 :] = (each[i, None] * (seen - pair)).sum(0) - 10 * ridge * theta[wide + 2 :]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    model.weights, model.bias, model.start, model.move = theta[:wide].copy(), float(theta[wide]), float(theta[wide + 1]), theta[wide + 2 :].reshape(2, 2).copy()
    q = np.clip(model.quality(texts), 1e-4, 1 - 1e-4)
    model.calibration = logistic(np.log(q / (1 - q))[:, None], y, prior_weights(y, prior))
    return model


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
