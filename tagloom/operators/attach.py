"""Attaching by name or nearness: motor boxes that stand for a filtered label, and a model's attachments as graph edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import geometry as g
from tagloom.functions import text as t
from tagloom.operators.spatial import grid_join
from tagloom.staging import staged

DK = ["drawing_id"]
# Site tags whose box may carry no tag of its own, confidences of attachments by word, and the cap where the equipment is a label only.
SITE_TAGS = ("KM-V-201",)
CONFIDENCE = {"high": 0.85, "medium": 0.65}
LABEL_CAP = 0.4


def ordered_assignment(pairs: DataFrame, by: list[str] = DK, max_rounds: int = 1000) -> DataFrame:
    """(by, taker, taken): takers in order of t_ord each take the first by k_ord of what they may (pairs: taker, t_ord, taken, k_ord) and none before took.

    Rounds: every taker asks for the first left to it, what is asked for stays with the first that asked, and nobody behind that one asks for
    it again. Once nobody is refused this is what the loop over the takers gives, as all rank takers alike. Orders are unique in a drawing."""
    left = staged(pairs.select(*by, "taker", "t_ord", "taken", "k_ord"), "pairs")
    for _ in range(max_rounds):
        asked = left.groupBy(*by, "taker", "t_ord").agg(F.min_by("taken", "k_ord").alias("taken"))
        held = staged(asked.groupBy(*by, "taken").agg(F.min_by("taker", "t_ord").alias("taker"), F.min("t_ord").alias("first"), F.count(F.lit(1)).alias("n")), "held")
        if held.where("n > 1").isEmpty():
            return held.select(*by, "taker", "taken")
        left = staged(left.join(held.select(*by, "taken", "first"), [*by, "taken"], "left").where("first IS NULL OR t_ord <= first").drop("first"), "pairs")
    raise RuntimeError(f"takers without an answer after {max_rounds} rounds")


def motor_proxies(rows: DataFrame, site_tags: tuple[str, ...] = SITE_TAGS, radius: float = 400, word: str = "motor", by: list[str] = DK) -> DataFrame:
    """(by, id, tag): boxes that take a site tag, from detections (id, ord, tag, symbol_name, category, box, filtered).

    A site tag that only filtered detections have, not equipment that is left, goes to the first detection in order that is left, has `word` in its
    symbol's name, has no tag or this one, and whose centre is up to `radius` from that of the tag's first filtered detection. Tags are dealt in
    the order given; a box that took one is gone for later ones."""
    key = F.upper(F.trim(F.coalesce("tag", F.lit(""))))
    known = rows.withColumn("__key", key)
    place = F.array_position(F.array(*[F.lit(s) for s in site_tags]), F.col("__key"))
    shown = known.where(~F.col("filtered") & (F.col("category") == "equipment")).select(*by, "__key").distinct()
    labels = known.where(F.col("filtered") & F.col("__key").isin(*site_tags)).join(shown, [*by, "__key"], "left_anti").groupBy(*by, "__key").agg(F.min_by("box", "ord").alias("box")).select(*by, F.col("__key").alias("site"), place.alias("t_ord"), "box")
    boxes = known.where(~F.col("filtered") & F.contains(F.lower(F.coalesce("symbol_name", F.lit(""))), F.lit(word)) & ((F.col("__key") == "") | F.col("__key").isin(*site_tags))).select(*by, "id", "ord", F.col("__key").alias("own"), "box")
    near = grid_join(labels, boxes, radius, by=by).where((g.center_distance(F.col("l")["box"], F.col("r")["box"]) <= radius) & F.col("r.own").isin("", *site_tags)).where((F.col("r.own") == "") | (F.col("r.own") == F.col("l.site")))
    pairs = near.select(*by, F.col("l.site").alias("taker"), F.col("l.t_ord").alias("t_ord"), F.col("r.id").alias("taken"), F.col("r.ord").alias("k_ord"))
    return ordered_assignment(pairs, by).select(*by, F.col("taken").alias("id"), F.col("taker").alias("tag"))


def with_motors(rows: DataFrame, proxies: DataFrame, by: list[str] = DK) -> DataFrame:
    """rows with the tags of `motor_proxies`, category equipment and is_motor_proxy; rows that are only a label (label_only) of a tag that a box took are left out."""
    took = proxies.select(*by, "id", F.col("tag").alias("__tag"))
    out = rows.join(took, [*by, "id"], "left").withColumn("is_motor_proxy", F.col("__tag").isNotNull()).withColumn("category", F.when(F.col("is_motor_proxy"), "equipment").otherwise(F.col("category"))).withColumn("tag", F.coalesce("__tag", "tag")).drop("__tag")
    if "label_only" in rows.columns:
        gone = proxies.select(*by, F.col("tag").alias("__key")).distinct().withColumn("__label", F.lit(True))
        out = out.withColumn("__key", F.upper(F.trim("tag"))).join(gone, [*by, "__key"], "left").where(~(F.coalesce("__label", F.lit(False)) & F.coalesce("label_only", F.lit(False)))).drop("__key", "__label")
    return out


def resolved_names(asked: DataFrame, known: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, name, node): what each asked name (name) means among known ones (tag, node, ord) of the same keys.

    Names are compared trimmed and in capitals: the same one, else one that is the same without area prefixes, else, for three characters or more
    without prefix, one that ends in it; of several the first by name, and of nodes with one tag the first by ord. Each rank is a join by equality; names
    are cut into their endings once."""
    tags = known.withColumn("m", F.upper(F.trim("tag"))).where("m <> ''").groupBy(*by, "m").agg(F.min_by("node", "ord").alias("node"))
    tags = tags.withColumn("bare", t.strip_area_prefix(F.col("m")))
    ask = asked.select(*by, "name").distinct().withColumn("u", F.upper(F.trim(F.coalesce("name", F.lit(""))))).where("u <> ''").withColumn("gs", t.strip_area_prefix(F.col("u")))
    same = ask.select(*by, "name", F.col("u").alias("m")).join(tags.select(*by, "m", "node"), [*by, "m"]).select(*by, "name", F.lit(0).alias("rank"), "m", "node")
    bare = ask.where("gs <> ''").join(tags.select(*by, "m", "node", F.col("bare").alias("gs")), [*by, "gs"]).select(*by, "name", F.lit(1).alias("rank"), "m", "node")
    ends = tags.where(F.length("m") >= 3).select(*by, "m", "node", F.explode(F.transform(F.sequence(F.lit(1), F.length("m") - 2), lambda i: F.substr(F.col("m"), i))).alias("gs"))
    tail = ask.where(F.length("gs") >= 3).join(ends, [*by, "gs"]).select(*by, "name", F.lit(2).alias("rank"), "m", "node")
    best = same.unionAll(bare).unionAll(tail).groupBy(*by, "name").agg(F.min(F.struct("rank", "m", "node")).alias("s"))
    return best.select(*by, "name", "s.node")


def attachment_edges(attachments: DataFrame, instruments: DataFrame, equipment: DataFrame, after: int = 0, by: list[str] = DK) -> tuple[DataFrame, DataFrame]:
    """(edges, outcomes) of a model's attachments (cluster, ord, instrument_tag, parent_equipment, confidence, reasoning).

    Only high and medium confidence counts. The instrument's name is resolved among those of its cluster (instruments: cluster, tag, node, ord), the
    equipment's, if it has the form of an equipment tag, among the drawing's (equipment: tag, node, ord, label_only); an edge to equipment that is a label
    only has a capped confidence. edges: (by, edge_id, a, b, rel, category, directed, confidence, evidence), numbered in order of (cluster, ord) from
    `after` on; outcomes: (by, cluster, ord, word, outcome): edge, low, no_instrument, not_equipment or unknown_equipment."""
    word = F.lower(F.coalesce("confidence", F.lit("unknown")))
    rows = attachments.withColumn("__word", F.when(word.isin("high", "medium", "low"), word).otherwise("unknown"))
    one = resolved_names(rows.select(*by, "cluster", F.col("instrument_tag").alias("name")), instruments, [*by, "cluster"]).select(*by, "cluster", F.col("name").alias("instrument_tag"), F.col("node").alias("__a"))
    two = resolved_names(rows.select(*by, F.col("parent_equipment").alias("name")), equipment, by).select(*by, F.col("name").alias("parent_equipment"), F.col("node").alias("__b"))
    flat = equipment.where("label_only").select(*by, F.col("node").alias("__b"), F.lit(True).alias("__label")).distinct()
    found = rows.join(one, [*by, "cluster", "instrument_tag"], "left").join(two, [*by, "parent_equipment"], "left").join(flat, [*by, "__b"], "left")
    outcome = F.when(~F.col("__word").isin(*CONFIDENCE), "low").when(F.col("__a").isNull(), "no_instrument").when(~t.is_equipment_tag(F.col("parent_equipment")), "not_equipment").when(F.col("__b").isNull(), "unknown_equipment").otherwise("edge")
    found = found.withColumn("outcome", outcome)
    sure: Column = F.when(F.col("__word") == "high", CONFIDENCE["high"]).otherwise(CONFIDENCE["medium"])
    sure = F.when(F.coalesce("__label", F.lit(False)), F.least(sure, F.lit(LABEL_CAP))).otherwise(sure)
    told = F.concat(F.lit("gemini_vision: "), F.coalesce("reasoning", F.lit("")))
    hits = found.where("outcome = 'edge'")
    # numbers in a drawing: the place among those of its cluster, behind those of the clusters before
    before = hits.groupBy(*by, "cluster").agg(F.count(F.lit(1)).alias("n"))
    starts = before.withColumn("__start", F.sum("n").over(Window.partitionBy(*by).orderBy("cluster").rowsBetween(Window.unboundedPreceding, -1))).select(*by, "cluster", F.coalesce("__start", F.lit(0)).alias("__start"))
    at = F.row_number().over(Window.partitionBy(*by, "cluster").orderBy("ord")) - 1
    edges = hits.withColumn("__at", at).join(starts, [*by, "cluster"]).select(*by, F.concat(F.lit("E-"), (F.col("__at") + F.col("__start") + after).cast("string")).alias("edge_id"), F.col("__a").alias("a"), F.col("__b").alias("b"), F.lit("GEMINI_ATTACHED").alias("rel"), F.lit("functional").alias("category"), F.lit(False).alias("directed"), sure.alias("confidence"), told.alias("evidence"))
    return edges, found.select(*by, "cluster", "ord", F.col("__word").alias("word"), "outcome")
