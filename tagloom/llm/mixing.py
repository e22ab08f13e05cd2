"""Mixing sources to target weights by minimum-cost flow over membership patterns.

Documents are aggregated by membership pattern (the set of sources that each belongs to) into token capacities. A flow
network start -> source -> pattern -> end carries each source's quota through the patterns that hold it; the arcs
pattern -> end are one per repetition, each with the pattern's capacity and a cost that grows with the repetition, so a
second pass is bought only where first passes run out. The flow on a pattern is then met by whole passes over its
documents plus a seeded selection of documents for the rest.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import WORD, staged


def water_fill(weights: Sequence[float], caps: Sequence[float], total: float) -> list[float]:
    """Shares of `total` by weight; those over their cap stop there and the excess is dealt again by weight."""
    share = [0.0] * len(weights)
    free = [i for i, w in enumerate(weights) if w > 0]
    left = float(total)
    while free:
        by = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / by > caps[i]]
        if not over:
            for i in free:
                share[i] = left * weights[i] / by
            break
        for i in over:
            share[i] = float(caps[i])
            left -= caps[i]
        free = [i for i in free if i not in set(over)]
    return share


def repetition_cost(k: int) -> int:
    """The cost of a token's k-th repetition (from 1): convex."""
    return k * k


def min_cost_flow(supply: Sequence[int], arcs: Sequence[tuple[int, int]], capacity: Sequence[int], repeats: int) -> list[dict[int, int]]:
    """Route supply[s] tokens of each source s over arcs (s, pattern) into patterns; for each pattern {source: tokens}.

    Each pattern takes up to `repeats` times its capacity, its k-th repetition at repetition_cost(k) a token. What can't be
    routed stays out. Successive shortest paths (Dijkstra with potentials); sources and patterns are few, not documents.
    """
    S, P = len(supply), len(capacity)
    start, end = S + P, S + P + 1
    graph: list[list[int]] = [[] for _ in range(S + P + 2)]
    to: list[int] = []
    room: list[int] = []
    cost: list[int] = []

    def add(u: int, v: int, c: int, w: int) -> int:
        for a, b, r, x in ((u, v, c, w), (v, u, 0, -w)):
            graph[a].append(len(to))
            to.append(b)
            room.append(r)
            cost.append(x)
        return len(to) - 2

    for s, n in enumerate(supply):
        add(start, s, int(n), 0)
    total = int(sum(supply))
    middle = [(s, p, add(s, S + p, total, 0)) for s, p in arcs]
    for p, n in enumerate(capacity):
        for k in range(1, repeats + 1):
            add(S + p, end, int(n), repetition_cost(k))
    height = [0] * len(graph)
    while True:
        far = [math.inf] * len(graph)
        by = [-1] * len(graph)
        far[start] = 0
        heap = [(0, start)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for e in graph[u]:
                if room[e] > 0 and (n := d + cost[e] + height[u] - height[to[e]]) < far[to[e]]:
                    far[to[e]], by[to[e]] = n, e
                    heapq.heappush(heap, (n, to[e]))
        if far[end] == math.inf:
            break
        height = [h + (d if d < math.inf else 0) for h, d in zip(height, far, strict=True)]
        path, u = [], end
        while u != start:
            path.append(by[u])
            u = to[by[u] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push
    out: list[dict[int, int]] = [{} for _ in range(P)]
    for s, p, e in middle:
        if room[e ^ 1]:
            out[p][s] = room[e ^ 1]
    return out


CHOICES = 48


def nearest_sum(sizes: list[int], want: int) -> list[bool]:
    """A choice of sizes whose sum is as near to `want` as any (the lower of two), by dynamic programming over the sums that can be reached, as bits of one number."""
    reach = [1]
    top = (1 << (2 * max(want, 0) + 1)) - 1  # beyond that nothing is nearer than no size at all
    for n in sizes:
        reach.append((reach[-1] | reach[-1] << n) & top)
    low = (reach[-1] & ((1 << (max(want, 0) + 1)) - 1)).bit_length() - 1
    above = reach[-1] >> (want + 1) if want >= 0 else 0
    high = want + 1 + ((above & -above).bit_length() - 1) if above else None
    left = high if high is not None and high - want < want - low else low
    out = [False] * len(sizes)
    for i in range(len(sizes) - 1, -1, -1):
        if not reach[i] >> left & 1:
            out[i] = True
            left -= sizes[i]
    return out


def _fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket's documents the first in seeded order, as far as they fit; of the CHOICES around the place where they end, those whose sum comes nearest to the need."""
    pdf = pdf.sort_values(["h", "id", "size", "row"], kind="stable", ignore_index=True)
    size = pdf["size"].to_numpy(dtype=np.int64)
    need = int(pdf["need"].iloc[0])
    end = int(np.searchsorted(np.cumsum(size), need, "right"))
    a = max(0, min(end - CHOICES // 2, len(size) - CHOICES))
    inside = np.arange(len(size)) < a
    inside[a : a + CHOICES] = nearest_sum(size[a : a + CHOICES].tolist(), need - int(size[:a].sum()))
    return pd.DataFrame({"row": pdf["row"], "extra": inside.astype("int32")})


BUCKET_ROWS = 512
COARSE = 4096


def row_hash(id_: Column, text: Column, seed: int = 17) -> Column:
    """What orders documents in the mix and tells rows of one id with different texts apart."""
    return F.xxhash64(id_.cast("long"), F.xxhash64(text), F.lit(seed))


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    members: str = "source",
    max_repeats: int = 3,
    total: int | None = None,
    seed: int = 17,
) -> tuple[DataFrame, DataFrame]:
    """(documents, sources).

    documents: id, pattern (array of sources), size (words), h (`row_hash`), passes (times that the mix takes it, 0 to
    max_repeats), taken (passes times size); a row per row of docs. sources: source, source_size, target, routed.
    members: a column with a source's name or an array of names. weights by name; None: 1, 2, 3, repeating over the sources
    by code point, null last. total: words in the mix; None: all words.
    Null texts have size 0; a null source is a source; an empty array belongs to none and is never taken. Repeated rows
    count each. An empty table gives no rows. Sources and patterns are held on the driver, documents never.
    """
    many = dict(docs.dtypes)[members].startswith("array")
    pattern = F.array_sort(F.array_distinct(F.coalesce(F.col(members), F.array(F.lit(None).cast("string"))))) if many else F.array(F.col(members).cast("string"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), pattern.alias("pattern"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), row_hash(F.col(id_col), F.col(text_col), seed).alias("h"))
    rows = rows.select("id", "pattern", "size", "h", F.monotonically_increasing_id().alias("row"))
    rows = staged(rows, "mix-rows")
    found = rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    spark = docs.sparkSession
    key = lambda s: (s is None, s or "")  # noqa: E731  Python compares str by code point
    found = sorted(found, key=lambda r: [key(s) for s in r["pattern"]])
    sources = sorted({s for r in found for s in r["pattern"]}, key=key)
    sizes = {s: sum(r["size"] for r in found if s in r["pattern"]) for s in sources}
    weight = [weights.get(s, 0.0) if weights is not None else 1.0 + i % 3 for i, s in enumerate(sources)]
    every = sum(r["size"] for r in found if r["pattern"])
    target = water_fill(weight, [float(max_repeats * sizes[s]) for s in sources], every if total is None else total)
    at = {s: i for i, s in enumerate(sources)}
    flow = min_cost_flow([round(t) for t in target], [(at[s], p) for p, r in enumerate(found) for s in r["pattern"]], [r["size"] for r in found], max_repeats)
    routed = [sum(f.get(i, 0) for f in flow) for i in range(len(sources))]
    told = spark.createDataFrame([(s, int(sizes[s]), float(target[i]), int(routed[i])) for i, s in enumerate(sources)], "source string, source_size long, target double, routed long")
    plan = []
    for p, r in enumerate(found):
        full, rest = divmod(sum(flow[p].values()), r["size"]) if r["size"] else (0, 0)
        plan.append((p, r["pattern"], int(full), int(rest), max(1, min(COARSE, -(-r["n"] // BUCKET_ROWS)))))
    plans = spark.createDataFrame(plan, "p int, pattern array<string>, full int, rest long, buckets int")

    plans = plans.withColumn("pk", F.to_json("pattern")).drop("pattern")
    own = rows.withColumn("pk", F.to_json("pattern")).join(F.broadcast(plans) if len(plan) <= 10_000 else plans, "pk").drop("pk")
    own = own.withColumn("coarse", F.pmod(F.shiftrightunsigned("h", 20), F.col("buckets").cast("long")).cast("int"))
    # Of each pattern, whole buckets up to the one in which the rest ends; that one is cut again, and its last part is filled document by document.
    def ends(parts: DataFrame, by: list[str], bucket: str, need: str) -> DataFrame:
        run = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
        before = parts.withColumn("before", F.coalesce(F.sum("s").over(run), F.lit(0)))
        return before.where((F.col("before") <= F.col(need)) & (F.col("before") + F.col("s") > F.col(need)))

    first = own.groupBy("p", "coarse").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"), F.first("rest").alias("rest"))
    end1 = staged(ends(first, ["p"], "coarse", "rest").select("p", F.col("coarse").alias("end1"), (F.col("rest") - F.col("before")).alias("rest1"), F.greatest(F.lit(1), F.ceil(F.col("n") / BUCKET_ROWS)).cast("int").alias("parts")), "mix-end1")
    cut = own.join(end1, "p", "left").withColumn("fine", F.when(F.col("coarse") == F.col("end1"), F.pmod(F.xxhash64("h"), F.col("parts").cast("long")).cast("int")))
    inside = cut.where(F.col("fine").isNotNull())
    second = inside.groupBy("p", "fine").agg(F.sum("size").alias("s"), F.first("rest1").alias("rest1"))
    end2 = staged(ends(second, ["p"], "fine", "rest1").select("p", F.col("fine").alias("end2"), (F.col("rest1") - F.col("before")).alias("need")), "mix-end2")
    picked = inside.join(end2, "p").where(F.col("fine") == F.col("end2")).select("p", "row", "h", "id", "size", "need").groupBy("p").applyInPandas(_fill, "row long, extra int")
    below = F.coalesce(F.col("coarse") < F.col("end1"), F.lit(False)) | F.coalesce(F.col("fine") < F.col("end2"), F.lit(False))
    out = cut.join(end2, "p", "left").join(picked, "row", "left").select("id", "pattern", "size", "h", F.least(F.lit(max_repeats), F.col("full") + F.coalesce("extra", F.lit(0)) + below.cast("int")).alias("passes"))
    return out.withColumn("taken", F.col("passes") * F.col("size")), told
