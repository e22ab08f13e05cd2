"""Best-fit packing of token pieces into sequences by bin completion over size classes.

Pieces have integer sizes up to the length of a sequence, so a packing is a list of (pattern, copies), where a pattern
says how many pieces of each size share a sequence. Only the counts by size come to the driver: at most `limit` numbers,
whatever the input. Branch and bound works on those counts: it takes the largest size left, enumerates the undominated
fillings around it, applies each as often as the counts allow, and prunes by the waste that the best packing known so far
leaves; best-fit packings are the first incumbents. Pieces then find their places by rank within their size.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import mapper, remembered, staged

Pattern = tuple[tuple[int, int], ...]  # (size, pieces), sizes descending


class WordIds:
    """A tokenizer's ids of a text, as little-endian unsigned 32-bit bytes, word by word.

    For tokenizers that drop white space and cut words by a pattern before they merge: a text's ids are those of its
    words in a row, and a word's are those of its parts. About `most` words and `most_parts` parts are kept, in two
    generations each: when the younger is half of that, it becomes the elder, and of that elder only what is met again stays.
    """

    def __init__(self, tokenizer_json: str, most: int = 350_000, most_parts: int = 100_000):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.most_parts = Tokenizer.from_str(tokenizer_json), most, most_parts
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.elder_words: dict[bytes, bytes] = {}
        self.elder_parts: dict[str, bytes] = {}
        told = json.loads(tokenizer_json)
        cut = (told.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        if cut.get("type") != "Split" or not cut.get("invert") or cut.get("behavior") != "Removed":
            raise ValueError("the tokenizer doesn't cut words by a pattern")
        normal = [n["type"] for n in (told.get("normalizer") or {}).get("normalizers", [])]
        if normal != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"the tokenizer normalises otherwise: {normal}")
        self.lines = regex.compile("\\n|" + cut["pattern"]["Regex"])
        if any("<" not in t["content"] for t in told.get("added_tokens", [])):
            raise ValueError("a special token has no <")
        # parts are normalised and cut already; spelt as ByteLevel would, only merging is left. A part's last id is the one with the
        # suffix of words' ends; where the tokenizer cuts or ends words otherwise, no id is marked, and `_ids` takes part by part
        self.plain = Tokenizer.from_str(json.dumps(told | {"normalizer": None, "post_processor": None, "pre_tokenizer": None, "added_tokens": []}))
        vocab, suffix = told["model"]["vocab"], told["model"].get("end_of_word_suffix")
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        rest = [(p["type"], p.get("add_prefix_space"), p.get("use_regex")) for p in told["pre_tokenizer"]["pretokenizers"][1:]]
        if suffix and "<" in suffix and rest == [("ByteLevel", False, False)]:
            self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        others = iter(range(256, 512))
        self.letters = "".join(chr(b if b in kept else next(others)) for b in range(256))
        # words with these bytes are left to the tokenizer: "<" may begin a special token, from U+0240 on NFC, context and Unicode's version may matter
        self.odd = re.compile(rb"[<\xc9-\xff]").search

    def _ids(self, parts: list[str]) -> None:
        for at in range(0, len(parts), 2000):
            some = parts[at : at + 2000]
            spelt = [p if p.isascii() and p.isprintable() else charmap_decode(p.encode(), "strict", self.letters)[0] for p in some]
            ids = np.array(self.plain.encode_batch_fast([spelt], is_pretokenized=True, add_special_tokens=False)[0].ids, dtype="<u4")
            ends = 4 * (np.flatnonzero(self.last[ids]) + 1)
            if len(ends) == len(some) and ends[-1] == 4 * len(ids):
                self.parts.update(zip(some, _cut(ids.tobytes(), ends), strict=True))
            else:
                for p in some:
                    self.parts[p] = np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[bytes]) -> None:
        """All at once: the words, a line each, are lower-cased and cut together."""
        odd = list(filter(self.odd, words))
        for at in range(0, len(odd), 2000):
            some = odd[at : at + 2000]
            found = self.tokenizer.encode_batch([w.decode("utf-8", "replace") for w in some], add_special_tokens=False)
            self.words.update((w, np.array(e.ids, dtype="<u4").tobytes()) for w, e in zip(some, found, strict=True))
        plain = list(set(words).difference(odd)) if odd else words
        lines = b"\n".join(plain).decode().lower() + "\n" * bool(plain)
        flat = self.lines.findall(lines)
        if len(self.parts) > self.most_parts // 2:
            self.elder_parts, self.parts = self.parts, {}
        self._ids(_unknown(set(flat).difference("\n"), self.parts, self.elder_parts))
        self.parts["\n"] = b"\n"  # one byte, where parts have four for each id
        made = list(map(self.parts.__getitem__, flat))
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        self.words.update(zip(plain, _cut(b"".join(made), np.cumsum(sizes)[sizes == 1], 1), strict=True))

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        held: list[str] = []
        chars = 0
        for i, t in enumerate(texts):
            held.append(t or "")
            chars += len(held[-1])
            if chars >= 1 << 22 or i == len(texts) - 1:
                out += self._encode_some(held)
                held, chars = [], 0
        return out

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        """Words are cut and told apart by Arrow, so that Python meets each distinct one once, and put in a row by NumPy."""
        cut = pc.ascii_split_whitespace(pa.array([t.encode("utf-8", "replace") for t in texts], pa.large_string()))
        coded = cut.flatten().dictionary_encode()
        ids = self._known(coded.dictionary.cast(pa.large_binary()).to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, first, word = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        each = sizes[word]
        ends = np.cumsum(each)
        from_ = np.repeat(first[word] - ends + each, each)
        from_ += np.arange(len(from_))
        return _cut(flat[from_].tobytes(), 4 * np.concatenate([[0], ends])[cut.value_lengths().to_numpy().cumsum()])

    def _known(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words; those that only the elder generation has move on to the younger, new ones are learnt."""
        if len(self.words) > self.most // 2:
            self.elder_words, self.words = self.words, {}
        found = list(map(self.words.get, words))
        places = [i for i, x in enumerate(found) if x is None]
        if places:
            missing = [words[i] for i in places]
            elder = list(map(self.elder_words.get, missing))
            self.words.update((w, x) for w, x in zip(missing, elder, strict=True) if x is not None)
            self._learn([w for w, x in zip(missing, elder, strict=True) if x is None])
            for i in places:
                found[i] = self.words[words[i]]
        return found


def _cut(whole: bytes, ends: np.ndarray, mark: int = 0) -> list[bytes]:
    """The pieces up to each end, without the `mark` bytes before it."""
    ends = ends.tolist()
    return [whole[i : j - mark] for i, j in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def _unknown(wanted: set, known: dict, elder: dict) -> list:
    """What of `wanted` neither dictionary has; what only the elder has moves on to the younger."""
    new = wanted.difference(known)
    again = elder.keys() & new  # looks up the smaller of both
    known.update((w, elder[w]) for w in again)
    return list(new.difference(again))


@remembered
@lru_cache(maxsize=2)
def _encoder(tokenizer_json: str) -> WordIds:
    """One for each tokenizer in a Python worker: the words that it has learnt outlive the task, as workers are reused."""
    return WordIds(tokenizer_json)


def encode_texts(tokenizer_json: str, texts: list[str | None]) -> list[bytes]:
    return _encoder(tokenizer_json).encode_all(texts)


def piece_table(docs: DataFrame, tokenizer_json: str, limit: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's pieces; null texts count as empty and have the end id alone."""
    given = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    out = pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    last = np.array([end_id], dtype="<u4").tobytes()

    def make(batch: pa.RecordBatch) -> dict:
        cols: dict[str, list] = {x.name: [] for x in out}
        for doc, found in zip(batch.column("id").to_pylist(), encode_texts(given.value, batch.column("text").to_pylist()), strict=True):
            ids = found + last
            for k, at in enumerate(range(0, len(ids), 4 * limit)):
                piece = ids[at : at + 4 * limit]
                for name, value in zip(cols, (doc, k, at // 4, len(piece) // 4, zlib.crc32(piece)), strict=True):
                    cols[name].append(value)
        return cols

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        yield from mapper(out, "text", make, _encoder)(batches)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, piece int, start long, length long, ids_crc32 long")


def waste_bound(counts: dict[int, int], limit: int) -> int:
    """Sequences that any packing needs: by total size, and (Martello and Toth's L2) by what can't share with the large."""
    sizes = sorted(counts)
    best = -(-sum(s * n for s, n in counts.items()) // limit)
    cum_n = np.cumsum([0] + [counts[s] for s in sizes])
    cum_s = np.cumsum([0] + [s * counts[s] for s in sizes])

    def span(cum, lo: int, hi: int) -> int:  # over sizes in [lo, hi)
        return int(cum[np.searchsorted(sizes, hi)] - cum[np.searchsorted(sizes, lo)])

    for a in [0, *[s for s in sizes if 2 * s <= limit]]:
        alone = span(cum_n, limit - a + 1, limit + 1)
        half_n, half_s = span(cum_n, limit // 2 + 1, limit - a + 1), span(cum_s, limit // 2 + 1, limit - a + 1)
        rest = span(cum_s, max(a, 1), limit // 2 + 1) - (half_n * limit - half_s)
        best = max(best, alone + half_n + max(0, -(-rest // limit)))
    return best


def _greedy(counts: dict[int, int], sizes: list[int], limit: int) -> Pattern:
    """The largest size left, then ever the largest that still fits."""
    left, out = limit, []
    for s in sizes:
        if s <= left and (n := min(counts[s], left // s)):
            out.append((s, n))
            left -= s * n
    return tuple(out)


def _best_fit(counts: dict[int, int], sizes: list[int], limit: int, width: int = 64) -> Pattern:
    """Around the largest size left, the fullest filling of up to three further pieces, or the greedy one if that is fuller."""
    first = sizes[0]
    left = limit - first
    best, filled = _greedy(counts, sizes, limit), 0
    filled = sum(s * n for s, n in best)
    if filled == limit:
        return best
    have = dict(counts)
    have[first] -= 1
    arr = np.array([s for s in reversed(sizes) if have[s] and s <= left])
    if len(arr) == 0:
        return ((first, 1),)
    top = arr[::-1][:width]
    for a in top.tolist():
        room = left - a
        i = int(np.searchsorted(arr, room, "right")) - 1
        while i >= 0 and arr[i] == a and have[a] < 2:
            i -= 1
        b = int(arr[i]) if i >= 0 else 0
        if first + a + b > filled:
            best, filled = _pattern([first, a] + [b] * bool(b)), first + a + b
        for b in top.tolist():
            if b > a or room - b < 1 or (a == b and have[a] < 2):
                continue
            j = int(np.searchsorted(arr, room - b, "right")) - 1
            if j >= 0:
                c = int(arr[j])
                if [a, b].count(c) + 1 <= have[c] and first + a + b + c > filled:
                    best, filled = _pattern([first, a, b, c]), first + a + b + c
        if filled == limit:
            break
    return best


def _pattern(pieces: list[int]) -> Pattern:
    return tuple((s, pieces.count(s)) for s in sorted(set(pieces), reverse=True))


def _copies(counts: dict[int, int], pattern: Pattern) -> int:
    return min(counts[s] // n for s, n in pattern)


def _pack_by(choose, counts: dict[int, int], limit: int) -> list[tuple[Pattern, int]]:
    counts, out = dict(counts), []
    while sizes := sorted((s for s, n in counts.items() if n), reverse=True):
        pattern = choose(counts, sizes, limit)
        m = _copies(counts, pattern)
        for s, n in pattern:
            counts[s] -= m * n
        out.append((pattern, m))
    return out


def completions(counts: dict[int, int], sizes: list[int], limit: int, most_waste: int, width: int = 24) -> list[Pattern]:
    """Undominated fillings around the largest size with at most `most_waste` left over, fullest first.

    A filling is dominated if one piece can be swapped for a larger one that is left and still fits, or if another piece
    can be added (Martello and Toth's test with single pieces). `width`: that many fillings are tried at a node.
    """
    first = sizes[0]
    found: list[tuple[int, list[int]]] = []
    steps = [500]
    minus = [-s for s in sizes]  # ascending, for bisection
    free = [counts[s] for s in sizes]
    free[0] -= 1

    def fitting(i: int, left: int) -> int:
        """The first index from i on of a size that is left and fits."""
        j = max(i, bisect_left(minus, -left))
        while j < len(sizes) and not free[j]:
            j += 1
        return j

    def grow(i: int, left: int, chosen: list[int]) -> None:
        steps[0] -= 1
        if steps[0] < 0 or len(found) >= 8 * width:
            return
        j = fitting(i, left)
        if j == len(sizes):
            if left <= most_waste and not any(sizes[k] > c for c in set(chosen) if (k := fitting(0, c + left)) < len(sizes)):
                found.append((left, list(chosen)))
            return
        while j < len(sizes) and steps[0] >= 0:
            free[j] -= 1
            grow(j, left - sizes[j], [*chosen, sizes[j]])
            free[j] += 1
            j = fitting(j + 1, left)

    grow(0, limit - first, [])
    out = dict.fromkeys(_pattern([first, *c]) for _, c in sorted(found, key=lambda x: (x[0], [-s for s in x[1]])))
    return list(out)[:width]


def pack_counts(counts: dict[int, int], limit: int, max_nodes: int = 1500) -> list[tuple[Pattern, int]]:
    """(pattern, copies) that hold every piece once. Optimal if the incumbent meets the waste bound; else the best packing found: fillings are enumerated with cuts (see `completions`) and a pattern is applied as often as it can be."""
    counts = {s: n for s, n in counts.items() if n}
    if not counts:
        return []
    bound = waste_bound(counts, limit)
    best, used = None, None
    for choose in (_greedy, _best_fit):  # incumbents
        made = _pack_by(choose, counts, limit)
        if used is None or sum(m for _, m in made) < used:
            best, used = made, sum(m for _, m in made)
        if used == bound:
            return best
    total = sum(s * n for s, n in counts.items())
    nodes = [max_nodes]

    def search(left: dict[int, int], made: list[tuple[Pattern, int]], bins: int, waste: int) -> bool:
        nonlocal best, used
        if not left:
            if bins < used:
                best, used = list(made), bins
            return used == bound
        nodes[0] -= 1
        if nodes[0] < 0:
            return True
        allowed = (used - 1) * limit - total - waste
        if allowed < 0 or bins + -(-sum(s * n for s, n in left.items()) // limit) >= used:
            return False
        sizes = sorted(left, reverse=True)
        options = dict.fromkeys([p for p in (_greedy(left, sizes, limit), _best_fit(left, sizes, limit)) if limit - sum(s * n for s, n in p) <= allowed] + completions(left, sizes, limit, allowed))
        for pattern in options:
            lost = limit - sum(s * n for s, n in pattern)
            m = _copies(left, pattern)
            if lost:
                m = min(m, max(1, allowed // lost))
            after = dict(left)
            for s, n in pattern:
                after[s] -= m * n
            if search({s: n for s, n in after.items() if n}, [*made, (pattern, m)], bins + m, waste + m * lost):
                return True
        return False

    import sys

    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))
    search(counts, [], 0, 0)
    return best


def place_table(packing: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """For each size and run of ranks: the first sequence, the pieces in one sequence and their offset; sorted by (size, rank)."""
    rows, next_rank, base = [], {}, 0
    for pattern, m in packing:
        offset = 0
        for s, n in pattern:
            rank = next_rank.get(s, 0)
            rows.append((s, rank, base, n, offset))
            next_rank[s] = rank + m * n
            offset += s * n
        base += m
    rows.sort()
    return dict(zip(("size", "rank", "base", "each", "offset"), np.array(rows, dtype=np.int64).reshape(-1, 5).T, strict=True))


def pack(pieces: DataFrame, limit: int = 2048, shards: int = 256, max_nodes: int = 1500) -> DataFrame:
    """pieces (columns id, piece, length, ...) with sequence_id and offset.

    Every row gets a place, repeated rows too; a row with a null or non-positive length, or one over the limit, is an
    error. An empty table gives no rows. Columns named sequence_id or offset are replaced.
    """
    spark = pieces.sparkSession
    names = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    shard = F.pmod(F.xxhash64("id", "piece"), F.lit(shards)).cast("int")
    rows = staged(pieces.select(*names).withColumn("__shard", shard), "pieces")
    parts = staged(rows.groupBy("length", "__shard").agg(F.count(F.lit(1)).alias("__n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}  # at most `limit` rows
    if bad := [s for s in counts if s is None or not 0 < s <= limit]:
        raise ValueError(f"pieces of length {bad[0]} don't fit into {limit}")
    at = spark.sparkContext.broadcast(place_table(pack_counts(counts, limit, max_nodes)))
    run = Window.partitionBy("length").orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("length", "__shard", F.coalesce(F.sum("__n").over(run), F.lit(0)).alias("__start"))
    within = Window.partitionBy("length", "__shard").orderBy("id", "piece", *[c for c in names if c not in ("id", "piece", "length")])
    ranked = rows.withColumn("__rank", F.row_number().over(within)).join(starts, ["length", "__shard"]).withColumn("__rank", F.col("__rank") + F.col("__start") - 1)
    kept = ranked.select(*names, "__rank")
    schema = kept.drop("__rank").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = at.value
        key = t["size"] * (1 << 45) + t["rank"]
        for b in batches:
            size, rank = b.column("length").to_numpy().astype(np.int64), b.column("__rank").to_numpy()
            i = np.searchsorted(key, size * (1 << 45) + rank, "right") - 1
            copy, slot = np.divmod(rank - t["rank"][i], t["each"][i])
            cols = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(t["base"][i] + copy), pa.array(t["offset"][i] + slot * size)], names=[*names, "sequence_id", "offset"])

    return kept.mapInArrow(place, schema)
