"""Duplicate resolution: greedy suppression, duplicate clusters, entity resolution, stitching of split line numbers."""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from math import floor, isfinite

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import geometry as g
from tagloom.functions import text as t
from tagloom.operators.graph import component_of, components, greedy_keep
from tagloom.operators.spatial import grid_join, measured
from tagloom.staging import merged, staged

DK = ["drawing_id"]


def suppress(rows: DataFrame, order: list, rival, reach: float = 0, by: list[str] = DK) -> DataFrame:
    """Greedy suppression: rows (id, box, ...) in `order` stay unless rival(l, r) holds with one that stayed. rival is symmetric and only holds within reach."""
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    pairs = grid_join(ranked, ranked, reach, by=by).where(F.col("l")["__rank"] < F.col("r")["__rank"]).where(rival(F.col("l"), F.col("r")))
    return greedy_keep(rows, pairs.select(*by, F.col("l.id").alias("hi"), F.col("r.id").alias("lo")), by=by)


def nms(rows: DataFrame, least: float = 0.4, same_label: float = 80, by: list[str] = DK) -> DataFrame:
    """Smallest boxes first; out goes what overlaps one that stays by more than `least`, or has its label within 80 px on both axes."""
    def rival(a, b):
        (ax, ay), (bx, by_) = g.center(a["box"]), g.center(b["box"])
        return (g.iou(a["box"], b["box"]) > least) | ((a["label"] == b["label"]) & (F.abs(ax - bx) < same_label) & (F.abs(ay - by_) < same_label))

    return suppress(rows, [g.area(F.col("box")), "id"], rival, same_label, by)


def tile_duplicates(rows: DataFrame, by: list[str] = DK) -> DataFrame:
    """Most confident first; out goes the same key overlapping by more than 0.15, or any by more than 0.55 whose texts are 0.92 alike.

    The built-in rules come first; only pairs of different keys that overlap enough, and whose lengths can be 0.92 alike, are compared text by text in Python."""
    keyed = rows.withColumn("key", t.dedup_key(F.col("tag")))
    few = keyed.select(*by, "id", "box", "key", F.upper("tag").alias("tag"), "conf")
    a, b = F.col("l"), F.col("r")
    before = (a["conf"] > b["conf"]) | (a["conf"].isNotNull() & b["conf"].isNull()) | (a["conf"].eqNullSafe(b["conf"]) & (a["id"] < b["id"]))
    pairs = grid_join(few, few, 0, by=by).where(before)
    pairs = measured(pairs.select(*by, a["id"].alias("hi"), b["id"].alias("lo"), "l", "r"), lap=g.iou(a["box"], b["box"]), same=a["key"] == b["key"])
    pairs = pairs.where("lap > 0.15 AND (same OR lap > 0.55)").select(*by, "hi", "lo", "lap", "same", a["tag"].alias("s"), b["tag"].alias("t"))
    pairs = staged(pairs, "pairs")  # few, and both rules read them
    sure = pairs.where("same")
    short, long = F.least(F.length("s"), F.length("t")), F.greatest(F.length("s"), F.length("t"))
    maybe = pairs.where(F.coalesce(~F.col("same"), F.lit(True)) & (F.col("lap") > 0.55) & (2 * short >= 0.92 * (short + long)))
    alike = maybe.where((F.col("s") == F.col("t")) | (t.fuzzy_ratio(F.col("s"), F.col("t")) >= 0.92))
    return greedy_keep(rows, sure.select(*by, "hi", "lo").unionAll(alike.select(*by, "hi", "lo")), by=by)


def same_tag_nearby(rows: DataFrame, distance: float, by: list[str] = DK) -> DataFrame:
    """Per tag, in order of id, out goes what lies closer than `distance` to one that stays."""
    return suppress(rows, ["id"], lambda a, b: g.center_distance(a["box"], b["box"]) < distance, distance, [*by, "tag"])


def duplicate_pairs(rows: DataFrame, exact_distance: float = 60, overlap: float = 0.20, by: list[str] = DK) -> DataFrame:
    """(by, a, b): pairs that show one physical tag: the same key close by, a long key inside another within 300, a confusable key whose
    symbols or tags overlap or that lies within 120, or a blank tag whose symbol or tag overlaps by half. rows: (id, box, tag) and, if
    there is one, tag_box (null: the symbol's box). Each rule has a pass of the grid of its own, no wider than it reaches: confusable keys meet by equality
    of what they are confused to, blank tags where symbols touch, long keys up to 300 apart, and tags that touch."""
    return _pairs(_keyed(rows.select(*by, "id", "box", "tag", *(["tag_box"] if "tag_box" in rows.columns else []))), exact_distance, overlap, by)


def _keyed(rows: DataFrame) -> DataFrame:
    """rows, staged, with __key: keys are made once a row, not once a pass of the grid or a cell."""
    return staged(rows.withColumn("__key", t.dedup_key(F.col("tag"))), "keyed")


def _pairs(rows: DataFrame, exact_distance: float, overlap: float, by: list[str]) -> DataFrame:
    keyed = rows.select(*by, "id", "box", F.col("__key").alias("key"), t.fold_confusable(F.col("__key")).alias("fold"), *([F.coalesce("tag_box", "box").alias("tag_box")] if "tag_box" in rows.columns else []))
    a, b = F.col("l"), F.col("r")
    lap, d = g.iou(a["box"], b["box"]), g.center_distance(a["box"], b["box"])
    inside = (F.length(a["key"]) >= 6) & (F.length(b["key"]) >= 6) & (a["key"].contains(b["key"]) | b["key"].contains(a["key"]))
    ends = [*by, a["id"].alias("a"), b["id"].alias("b")]
    few = keyed.select(*by, "id", "box", "key")
    # confusable keys; a pair that the long keys' pass finds is left to it
    alike = keyed.where("key <> ''").select(*by, "fold", "id", "box", "key")
    reach = max(exact_distance, 120, 0 if overlap > 0 else 300)
    met = grid_join(alike, alike, reach, cell=800, by=[*by, "fold"]).where(a["id"] < b["id"]).select(*ends, "l", "r", (a["key"] == b["key"]).alias("exact"), inside.alias("inside"))
    hit = "((exact AND d <= {0}) OR lap >= {1} OR d <= 120) AND NOT (inside AND d <= 300)".format(float(exact_distance), float(overlap))
    one = measured(met, lap=lap, d=d).where(hit).select(*by, "a", "b")
    long = few.where(F.length("key") >= 6)
    met = grid_join(long, long, 300, cell=800, by=by).where(a["id"] < b["id"]).where(inside).select(*ends, "l", "r")
    two = measured(met, d=d).where("d <= 300").select(*by, "a", "b")
    met = grid_join(few.where("key = ''"), few, 0, by=by).where((a["id"] < b["id"]) | ((a["id"] > b["id"]) & (b["key"] != ""))).select(*by, F.least(a["id"], b["id"]).alias("a"), F.greatest(a["id"], b["id"]).alias("b"), "l", "r")
    near = one.unionAll(two).unionAll(measured(met, lap=lap).where("lap >= 0.5").select(*by, "a", "b"))
    if "tag_box" not in rows.columns:
        return near
    tags = keyed.withColumn("box", F.col("tag_box"))
    # here box is the tag's: overlap of tags counts however far apart the symbols are
    both = (a["key"] != "") & (b["key"] != "")
    touching = grid_join(tags, tags, 0, by=by).where(a["id"] < b["id"]).where((both & (a["fold"] == b["fold"]) & (lap >= overlap)) | (~both & (lap >= 0.5))).select(*ends)
    return near.unionAll(touching).distinct()


def _score():
    return F.when(F.col("in_registry"), 1.0).otherwise(0.0) + 0.4 * F.col("conf") + 0.3 * F.col("ocr") + 0.2 * F.col("assoc") + F.when(F.col("status") == "PASS", 0.1).otherwise(0.0)


def resolve_duplicates(rows: DataFrame, by: list[str] = DK, exact_distance: float = 60, overlap: float = 0.20) -> DataFrame:
    """rows with root, duplicate_status, merged_into, merged_count and the cluster's box. The primary has the highest score
    (registry 1, 0.4 vision, 0.3 OCR, 0.2 association, 0.1 PASS); the smallest id of several."""
    held = _keyed(rows)
    rows, found = held.drop("__key"), components(_pairs(held, exact_distance, overlap, by), by).withColumnRenamed("node", "id")
    rooted = staged(rows.join(merged(found), [*by, "id"], "left"), "rooted")
    b = F.col("box")
    corners = (("x1", F.min), ("y1", F.min), ("x2", F.max), ("y2", F.max))
    # most rows are alone: only those of clusters are sorted
    alone = rooted.where("root IS NULL").withColumn("root", F.col("id")).withColumn("duplicate_status", F.lit("PRIMARY")).withColumn("merged_into", F.lit(None).cast(rows.schema["id"].dataType)).withColumn("merged_count", F.lit(1).cast("long")).withColumn("merged_box", F.struct(*[b[c].alias(c) for c, _ in corners]))
    of = rooted.where("root IS NOT NULL")
    w = Window.partitionBy(*by, "root")
    first = F.first("id").over(w.orderBy(F.desc("__s"), "id"))
    out = of.withColumn("__s", F.round(_score(), 9)).withColumn("__p", first).withColumn("merged_count", F.count(F.lit(1)).over(w))
    for c, f in corners:
        out = out.withColumn(f"__{c}", f(b[c]).over(w))
    whole = F.struct(*[F.col(f"__{c}").alias(c) for c, _ in corners])
    primary = F.col("id") == F.col("__p")
    out = out.withColumn("duplicate_status", F.when(primary, "PRIMARY").otherwise("DISCARDED")).withColumn("merged_into", F.when(~primary, F.col("__p"))).withColumn("merged_box", whole).drop("__s", "__p", "__x1", "__y1", "__x2", "__y2")
    return alone.unionByName(out)


def merged_primaries(resolved: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, id, tag, ocr, merged_from, box): the primaries of `resolve_duplicates` with the ids that they took, by score, and the best spelling.

    A primary of the register keeps its tag. Another takes the tag of the member with the highest OCR confidence (the first by score of several, itself before all; blank
    ones of others don't count), and then, in order of id, any longer tag that holds what it has so far, compared as duplicates' keys. Spellings are
    made distinct before they meet in one row."""
    primary, tag = F.col("duplicate_status") == "PRIMARY", F.coalesce("tag", F.lit(""))
    ocr, known = F.coalesce("ocr", F.lit(0.0)), F.coalesce("in_registry", F.lit(False))
    none = F.array().cast(f"array<{resolved.schema['id'].dataType.simpleString()}>")
    alone = resolved.where("merged_count = 1").select(*by, "id", tag.alias("tag"), F.when(known, ocr).otherwise(F.round(ocr, 3)).alias("ocr"), none.alias("merged_from"), F.col("merged_box").alias("box"))
    rows = resolved.where("merged_count > 1").withColumn("__s", F.round(_score(), 9)).withColumn("__tag", tag)
    own = primary | (F.col("__tag") != "")
    first = F.when(own, F.struct(ocr, F.when(primary, 1).otherwise(0), "__s", -F.col("id")))
    each = rows.groupBy(*by, "root", "__tag").agg(F.max(first).alias("__first"), F.max(F.when(own, ocr)).alias("__ocr"), F.max(F.when(primary, F.col("id"))).alias("id"), F.max(F.when(primary, ocr)).alias("__own_ocr"), F.max(F.when(primary, F.col("in_registry"))).alias("__known"), F.first("merged_box").alias("box"), F.min("id").alias("at"), F.collect_list(F.when(~primary, F.struct((-F.col("__s")).alias("s"), "id"))).alias("lost"))
    spelt = F.when(F.col("__tag") != "", F.struct("at", F.col("__tag").alias("tag"), t.dedup_key(F.col("__tag")).alias("key")))
    lost = F.array_sort(F.flatten(F.collect_list("lost")))
    out = each.groupBy(*by, "root").agg(F.max_by("__tag", "__first").alias("__best"), F.max("__ocr").alias("__ocr"), F.max(F.when(F.col("id").isNotNull(), F.col("__tag"))).alias("__own"), F.max("id").alias("id"), F.max("__own_ocr").alias("__own_ocr"), F.max("__known").alias("__known"), F.first("box").alias("box"), F.transform(lost, lambda x: x["id"]).alias("merged_from"), F.array_sort(F.collect_list(spelt)).alias("__spelt"))
    start = F.struct(F.col("__best").alias("tag"), t.dedup_key(F.col("__best")).alias("key"))
    longer = F.aggregate("__spelt", start, lambda z, x: F.when((F.length(x["key"]) > F.length(z["key"])) & F.contains(x["key"], z["key"]), F.struct(x["tag"].alias("tag"), x["key"].alias("key"))).otherwise(z))["tag"]
    known = F.coalesce("__known", F.lit(False))
    return alone.unionAll(out.select(*by, "id", F.when(known, F.col("__own")).otherwise(longer).alias("tag"), F.when(known, F.col("__own_ocr")).otherwise(F.round("__ocr", 3)).alias("ocr"), "merged_from", "box"))


def duplicate_links(resolved: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, id, primary, box, primary_box): each discarded row with the primary that it belongs to."""
    own = Window.partitionBy(*by, "root")  # as in resolve_duplicates: one pass, and no further shuffle
    first = F.max(F.when(F.col("duplicate_status") == "PRIMARY", F.struct("box"))).over(own)
    return resolved.withColumn("__first", first).where("duplicate_status = 'DISCARDED' AND __first IS NOT NULL").select(*by, "id", F.col("merged_into").alias("primary"), "box", F.col("__first.box").alias("primary_box"))


def collapse_entities(rows: DataFrame, distance: float = 1500, by: list[str] = DK) -> DataFrame:
    """(by, root, id, tag, category, members, box): rows with one tag and category within `distance` (in chains) as one entity, shown by its most confident, then largest."""
    pairs = grid_join(rows.select(*by, "id", "tag", "category", "box"), rows.select(*by, "id", "tag", "category", "box"), distance, cell=3000, by=[*by, "tag", "category"]).where(F.col("l")["id"] < F.col("r")["id"])
    pairs = pairs.where(g.center_distance(F.col("l")["box"], F.col("r")["box"]) <= distance).select(*by, F.col("l.id").alias("a"), F.col("r.id").alias("b"))
    of = component_of(rows, pairs, "id", by)
    best = F.struct("conf", g.area(F.col("box")), -F.col("id"))
    b = F.col("box")
    return of.groupBy(*by, "root").agg(F.max_by("id", best).alias("id"), F.max_by("tag", best).alias("tag"), F.first("category").alias("category"), F.count(F.lit(1)).alias("members"), F.struct(F.min(b["x1"]).alias("x1"), F.min(b["y1"]).alias("y1"), F.max(b["x2"]).alias("x2"), F.max(b["y2"]).alias("y2")).alias("box"))


def stitch(rows: DataFrame, dy: float = 30, gap: float = 120, by: str = "drawing_id") -> DataFrame:
    """(by, id, tag, parts): piping texts of one line joined over their overlap, first pair first, until none fits; a drawing at a time."""

    def join_up(a: str, b: str) -> str | None:
        if b in a or a in b:
            return max(a, b, key=len)
        n = next((n for n in range(min(len(a), len(b)), 3, -1) if a[-n:] == b[:n]), 0)
        return a + b[n:] if n else None

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        live: dict[int, dict] = {k: dict(r, parts=1) for k, r in enumerate(pdf.sort_values("id").to_dict("records"))}
        # rows by the cells of their left and right ends: what fits a row's other end lies in the cells around it
        lefts: dict[tuple, set[int]] = defaultdict(set)
        rights: dict[tuple, set[int]] = defaultdict(set)

        def cell(r: dict, x: str) -> tuple[int, int]:
            return floor((r["y1"] + r["y2"]) / 2 / tall), floor(r[x] / wide)

        def near(cells: dict[tuple, set[int]], at: tuple[int, int]) -> list[int]:
            return sorted(k for v in (-1, 0, 1) for u in (-1, 0, 1) for k in cells.get((at[0] + v, at[1] + u), ()))

        def put(k: int) -> None:
            lefts[cell(live[k], "x1")].add(k)
            rights[cell(live[k], "x2")].add(k)

        def take(k: int) -> None:
            lefts[cell(live[k], "x1")].discard(k)
            rights[cell(live[k], "x2")].discard(k)

        def merge(i: int, j: int) -> bool:
            a, b = live[i], live[j]
            if i == j or abs((a["y1"] + a["y2"]) - (b["y1"] + b["y2"])) / 2 > dy or not -gap <= b["x1"] - a["x2"] <= gap:
                return False
            made = join_up(a["tag"], b["tag"])
            if not made or len(made) <= max(len(a["tag"]), len(b["tag"])):
                return False
            take(i)
            take(j)
            a.update(tag=made, x1=min(a["x1"], b["x1"]), x2=max(a["x2"], b["x2"]), y1=min(a["y1"], b["y1"]), y2=max(a["y2"], b["y2"]), parts=a["parts"] + b["parts"], id=min(a["id"], b["id"]))
            del live[j]
            put(i)
            return True

        placed = [k for k, r in live.items() if all(isfinite(r[c]) for c in ("x1", "y1", "x2", "y2"))]  # others fit none
        for k in placed:
            put(k)
        at = 0
        while at < len(placed):
            i = placed[at]
            if i not in live or not any(merge(i, j) for j in near(lefts, cell(live[i], "x2"))):
                at += 1
                continue
            # of the rows before i, none fitted another but for what i has become; those after it are tried anew
            while (first := next((h for h in near(rights, cell(live[i], "x1")) if h < i and merge(h, i)), None)) is not None:
                i = first
            at = bisect_left(placed, i)
        live = list(live.values())
        return pd.DataFrame([{by: r[by], "id": r["id"], "tag": r["tag"], "parts": r["parts"]} for r in live], columns=[by, "id", "tag", "parts"])

    tall, wide = max(dy, 1e-6) * 1.001, max(gap, 1e-6) * 1.001
    flat = rows.select(by, "id", "tag", *[F.col("box")[c].cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])
    return flat.groupBy(by).applyInPandas(one, f"{by} {dict(rows.dtypes)[by]}, id {dict(rows.dtypes)['id']}, tag string, parts int")


def leader_clusters(rows: DataFrame, radius: float, by: str = "drawing_id") -> DataFrame:
    """(by, id, cluster): each row, in order of id, joins the first cluster whose first centre is nearer than radius, or begins one."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        heads: dict[tuple, list[tuple]] = defaultdict(list)  # by cells of a radius's width
        out, n, wide = [], 0, max(radius, 1e-6) * 1.001
        for x, y in zip(pdf["cx"], pdf["cy"], strict=True):
            if not (isfinite(x) and isfinite(y)):
                out.append(n)
                n += 1
                continue
            u, v = floor(x / wide), floor(y / wide)
            k = min((k for i in (-1, 0, 1) for j in (-1, 0, 1) for k, hx, hy in heads.get((u + i, v + j), ()) if ((x - hx) ** 2 + (y - hy) ** 2) ** 0.5 < radius), default=n)
            if k == n:
                heads[u, v].append((k, x, y))
                n += 1
            out.append(k)
        return pdf[[by, "id"]].assign(cluster=out)

    cx, cy = g.center(F.col("box"))
    types = dict(rows.dtypes)
    return rows.select(by, "id", cx.alias("cx"), cy.alias("cy")).groupBy(by).applyInPandas(one, f"{by} {types[by]}, id {types['id']}, cluster int")


def running_clusters(rows: DataFrame, radius: float, by: str = "drawing_id") -> DataFrame:
    """(by, id, cluster): rows by x; each joins the last cluster if its running centroid is within radius, else begins one."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["cx", "id"])
        out, k, n, sx, sy = [], -1, 0, 0.0, 0.0
        for x, y in zip(pdf["cx"], pdf["cy"], strict=True):
            if n and ((x - sx / n) ** 2 + (y - sy / n) ** 2) ** 0.5 <= radius:
                n, sx, sy = n + 1, sx + x, sy + y
            else:
                k, n, sx, sy = k + 1, 1, x, y
            out.append(k)
        return pdf[[by, "id"]].assign(cluster=out)

    cx, cy = g.center(F.col("box"))
    types = dict(rows.dtypes)
    return rows.select(by, "id", cx.alias("cx"), cy.alias("cy")).groupBy(by).applyInPandas(one, f"{by} {types[by]}, id {types['id']}, cluster int")
