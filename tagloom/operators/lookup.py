"""Lookups, matches and set operations between tags, registers, scopes and answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import text as t


def load_registry(rows: DataFrame, tag: str = "tag", order: str = "ord") -> DataFrame:
    """One row per upper-case tag; of several the last. reg_ord: its place in the file (that of the first)."""
    key = F.upper(F.trim(F.col(tag)))
    keyed = rows.withColumn("reg_tag", key).where(key != "")
    last = keyed.groupBy("reg_tag").agg(F.max_by(F.struct(*[c for c in keyed.columns if c != "reg_tag"]), F.col(order)).alias("entry"), F.min(order).alias("reg_ord"))
    return last


def registry_join(rows: DataFrame, registry: DataFrame, tag: str = "tag") -> DataFrame:
    """rows with match (exact, normalised, none) and matched_key: the exact upper-case tag, else the first register row whose
    normalised tag, or that without its area letter, is the same. registry: load_registry's. A match depends on the tag alone,
    so rows of different drawings that share an id can't take each other's."""
    key = F.upper(F.trim(F.coalesce(F.col(tag), F.lit(""))))
    exact = rows.withColumn("__key", key).join(registry.select(F.col("reg_tag").alias("__key"), F.lit(True).alias("__exact")), "__key", "left")

    def keys(c: Column) -> Column:
        return F.array(F.concat(F.lit("f"), t.registry_key(c)), F.concat(F.lit("p"), t.registry_key_without_area(c)))

    reg = registry.select("reg_tag", "reg_ord", F.explode(keys(F.col("reg_tag"))).alias("__k")).groupBy("__k").agg(F.min(F.struct("reg_ord", "reg_tag")).alias("__m"))
    open_tags = exact.where("__exact IS NULL").select("__key").distinct().select("__key", F.explode(keys(F.col("__key"))).alias("__k")).join(reg, "__k").groupBy("__key").agg(F.min("__m").alias("__m"))
    out = exact.join(open_tags, "__key", "left")
    return out.withColumn("match", F.when(F.col("__exact"), "exact").when(F.col("__m").isNotNull(), "normalised").otherwise("none")).withColumn("matched_key", F.when(F.col("__exact"), F.col("__key")).otherwise(F.col("__m.reg_tag"))).drop("__key", "__exact", "__m")


def scope_exact(rows: DataFrame, scope: DataFrame, name: str = "symbol_name") -> DataFrame:
    """rows with sow_status: blocked names first, then allowed, else UNSPECIFIED. scope: (name, status ALLOW or BLOCK)."""
    up = F.upper(F.trim(F.col(name)))
    one = scope.groupBy(F.upper(F.trim("name")).alias("__n")).agg(F.max((F.col("status") == "BLOCK").cast("int")).alias("__b"))
    return rows.withColumn("__n", up).join(one, "__n", "left").withColumn("sow_status", F.when(F.col("__b") == 1, "OUT_OF_SCOPE").when(F.col("__b") == 0, "IN_SCOPE").otherwise("UNSPECIFIED")).drop("__n", "__b")


def scope_fuzzy(rows: DataFrame, scope: DataFrame, name: str = "symbol_name", least: float = 0.6) -> DataFrame:
    """(name, best, score, status): for each distinct name the scope entry with the highest word overlap, at least `least`; the first of several.

    An equi-join on words and a count, not a product; scope: (ord, name, status)."""
    def words(c: str) -> Column:
        return F.array_distinct(F.split(F.upper(F.trim(F.col(c))), r"\s+"))

    a = rows.select(F.col(name).alias("name")).where(F.col(name).isNotNull()).distinct().withColumn("w", words("name"))
    b = scope.select(F.col("name").alias("best"), "status", "ord").withColumn("v", words("best"))
    met = a.select("name", F.size("w").alias("n"), F.explode("w").alias("word")).join(b.select("best", "status", "ord", F.size("v").alias("m"), F.explode("v").alias("word")), "word")
    hits = met.groupBy("name", "best", "status", "ord", "n", "m").agg(F.count(F.lit(1)).alias("c")).withColumn("score", F.round(F.col("c") / F.greatest("n", "m"), 6)).where(F.col("score") >= least)
    return hits.groupBy("name").agg(F.max_by(F.struct("best", "score", "status"), F.struct("score", -F.col("ord"))).alias("s")).select("name", "s.best", "s.score", "s.status")


def reconcile(model: DataFrame, ocr: DataFrame, least: float = 0.7, by: list[str] | None = None, node: str = "id") -> DataFrame:
    """(by, id, ocr_text, score): each model reading's OCR word in the same patch: the same but for case, else the best place-by-place
    agreement of at least `least`, the first of several. by: what names a patch (default patch_id, with drawing_id where both have it).

    Texts meet by length: an agreement of `least` needs the shorter to have that share of the longer's characters, and each distinct
    pair of texts of a patch is compared once."""
    if by is None:
        by = [c for c in ("drawing_id", "patch_id") if c in model.columns and c in ocr.columns]
    a = model.select(*by, F.upper("tag_text").alias("a")).where(F.col("a").isNotNull()).distinct().withColumn("n", F.length("a"))
    ways = a.withColumn("m", F.explode(F.sequence(F.ceil(F.col("n") * least).cast("int"), F.floor(F.col("n") / least).cast("int"))))
    b = ocr.select(*by, "text", "ord", F.upper("text").alias("b")).where(F.col("b").isNotNull())
    words = b.groupBy(*by, "b").agg(F.min_by("text", "ord").alias("text"), F.min("ord").alias("ord")).withColumn("m", F.length("b"))
    scored = ways.join(words, [*by, "m"]).withColumn("same", F.col("a") == F.col("b")).withColumn("score", F.when(F.col("same"), 1.0).otherwise(t.prefix_agreement(F.col("a"), F.col("b")))).where(F.col("same") | (F.col("score") >= least))
    best = scored.groupBy(*by, "a").agg(F.max_by(F.struct("text", "score"), F.struct(F.col("same").cast("int"), "score", -F.col("ord"))).alias("s"))
    return model.select(*by, node, F.upper("tag_text").alias("a")).join(best, [*by, "a"]).select(*by, node, F.col("s.text").alias("ocr_text"), F.round("s.score", 6).alias("score"))


def recall(truth: DataFrame, found: DataFrame, most_extra: int = 2) -> DataFrame:
    """(tag, hit): each true tag with the first detection whose key is the same, or contains or is contained with lengths at most `most_extra` apart.

    Candidates meet on substrings: a longer key is cut to all its substrings of up to `most_extra` fewer characters, so both sides join by equality."""
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("k", t.eval_key(F.col("tag"))).where("k <> ''")

    def shorter(df: DataFrame) -> DataFrame:
        cuts = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(most_extra)), lambda d: F.when(F.length("k") > d, F.transform(F.sequence(F.lit(1), d + 1), lambda i: F.substr(F.col("k"), i, F.length("k") - d))).otherwise(F.array().cast("array<string>"))))
        return df.withColumn("cut", F.explode(F.array_distinct(cuts)))

    a, b = keyed(truth.select("tag")), keyed(found.select("tag", "ord")).select(F.col("tag").alias("hit"), "k", "ord")
    one = shorter(a).join(b.withColumnRenamed("k", "cut"), "cut").select("tag", "hit", "ord", (F.col("k") == F.col("cut")).alias("same"))
    two = a.withColumnRenamed("k", "cut").join(shorter(b), "cut").select("tag", "hit", "ord", (F.col("k") == F.col("cut")).alias("same"))
    best = one.unionAll(two).groupBy("tag").agg(F.min_by("hit", F.struct((~F.col("same")).cast("int"), "ord")).alias("hit"))
    return truth.select("tag").join(best, "tag", "left")


def missing(truth: DataFrame, found: DataFrame) -> DataFrame:
    a, b = (df.withColumn("k", t.eval_key(F.col("tag"))) for df in (truth, found))
    return a.join(b.select("k"), "k", "left_anti").drop("k")


def agreed(left: DataFrame, right: DataFrame) -> DataFrame:
    a, b = (df.withColumn("k", t.eval_key(F.col("tag"))) for df in (left, right))
    return a.join(b.select("k"), "k", "left_semi").drop("k")


def register_match(rows: DataFrame, register: DataFrame, most_lead: int = 3) -> DataFrame:
    """(tag, status, match): a register tag with the same key, or one that ends in it after at most `most_lead` further leading characters
    (digit fragments aside): one OK, several SUSPICIOUS with the shortest; none NOT_IN_REGISTER. Suffixes join by equality."""
    a = rows.select("tag").distinct().withColumn("k", t.eval_key(F.col("tag"))).where("k <> ''")
    b = register.select(F.col("tag").alias("reg")).distinct().withColumn("rk", t.eval_key(F.col("reg")))
    tails = b.withColumn("lead", F.explode(F.sequence(F.lit(0), F.lit(most_lead)))).where(F.length("rk") > F.col("lead")).withColumn("k", F.substr(F.col("rk"), F.col("lead") + 1))
    hits = a.join(tails, "k").where((F.col("lead") == 0) | ~F.left("rk", F.col("lead")).rlike("^[0-9]+$"))
    best = hits.groupBy("tag").agg(F.min("lead").alias("least"), F.countDistinct("reg").alias("n"), F.min_by("reg", F.struct("lead", F.length("rk"), "reg")).alias("match"))
    status = F.when(F.col("n").isNull(), "NOT_IN_REGISTER").when((F.col("least") == 0) | (F.col("n") == 1), "OK").otherwise("SUSPICIOUS")
    return a.select("tag").join(best, "tag", "left").select("tag", status.alias("status"), "match")


def tolerant_match(tags: DataFrame, known: DataFrame) -> DataFrame:
    """(tag, match): a known tag that is the same, else the same without area prefix, else one that ends in it (three characters or more); the first by name."""
    k = known.select(F.upper("tag").alias("m")).distinct().withColumn("bare", t.strip_area_prefix(F.col("m")))
    a = tags.select("tag").distinct().withColumn("u", F.upper("tag")).withColumn("bare", t.strip_area_prefix(F.col("u")))
    same = a.join(k.select("m"), F.col("u") == F.col("m")).select("tag", "m", F.lit(0).alias("rank"))
    bare = a.join(k.select("m", F.col("bare").alias("kb")), F.col("bare") == F.col("kb")).select("tag", "m", F.lit(1).alias("rank"))
    ends = k.select("m", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("m") - 2)), lambda i: F.substr(F.col("m"), i))).alias("end"))
    tail = a.where(F.length("bare") >= 3).join(ends, F.col("bare") == F.col("end")).select("tag", "m", F.lit(2).alias("rank"))
    best = same.unionAll(bare).unionAll(tail).groupBy("tag").agg(F.min(F.struct("rank", "m")).alias("s"))
    return tags.select("tag").distinct().join(best, "tag", "left").select("tag", F.col("s.m").alias("match"))


def prefix_twins(rows: DataFrame, prefix: str = "V-", by: list[str] | None = None) -> DataFrame:
    """(by, id, into): rows whose tag has a twin with the site prefix; the twin with the smallest id takes them."""
    by = by or ["drawing_id"]
    twins = rows.where(F.col("tag").startswith(prefix)).groupBy(*by, F.col("tag").alias("twin")).agg(F.min("id").alias("into"))
    return rows.where(~F.col("tag").startswith(prefix)).withColumn("twin", F.concat(F.lit(prefix), F.col("tag"))).join(twins, [*by, "twin"]).select(*by, "id", "into")


def enrich(rows: DataFrame, links: DataFrame, on: list[str], least: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(rows left-joined to links, one row: matched share and whether it is stale, under `least`)."""
    marked = rows.join(links.withColumn("__hit", F.lit(1)), on, "left")
    told = marked.agg(F.round(F.coalesce(F.avg(F.coalesce("__hit", F.lit(0))), F.lit(0.0)), 6).alias("matched"), (F.coalesce(F.avg(F.coalesce("__hit", F.lit(0))), F.lit(0.0)) < least).alias("stale"))
    return marked.drop("__hit"), told


def worklist(requests: DataFrame, cache: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(requests with the cached answer, those to be asked): by the SHA-256 of the fields."""
    keyed = requests.withColumn("key", F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]), 256))
    return keyed.join(cache, "key", "left"), keyed.join(cache.select("key"), "key", "left_anti").dropDuplicates(["key"])


def cost_gate(work: DataFrame, tokens: Column, price: float, most: float) -> DataFrame:
    """One row: calls, tokens, cost, and whether they may run."""
    return work.agg(F.count(F.lit(1)).alias("calls"), F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens")).withColumn("cost", F.round(F.col("tokens") * price, 6)).withColumn("allowed", F.col("cost") <= most)


def first_registry_entry(details: Column) -> Column:
    return F.get(F.filter(details, lambda d: (d["rule"] == "REGISTRY") & d["in_registry"] & d["registry_entry"].isNotNull()), F.lit(0))["registry_entry"]


def numbered(df: DataFrame, by: list[str], order: list, name: str = "n") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def _close(rows: DataFrame, truth: DataFrame, most_extra: int | None) -> DataFrame:
    """Distinct keys (k) of rows that equal, contain or are contained in a key of truth, with lengths at most most_extra apart (None: any).

    Keys meet by equality: each side's keys against the other's substrings of the lengths that the other side has."""
    a = rows.select("k").distinct().where("k <> ''")
    b = truth.select("k").distinct().where("k <> ''")

    def inside(short: DataFrame, long: DataFrame, of: str) -> DataFrame:
        low = F.greatest(F.lit(1), F.length("k") - most_extra) if most_extra is not None else F.lit(1)
        cuts = F.flatten(F.transform(F.sequence(low, F.length("k")), lambda n: F.transform(F.sequence(F.lit(1), F.length("k") - n + 1), lambda i: F.substr(F.col("k"), i, n))))
        met = long.select("k", F.explode(F.array_distinct(cuts)).alias("cut")).join(short.select(F.col("k").alias("cut")), "cut")
        return met.select(F.col(of).alias("k"))

    return inside(a, b, "cut").unionAll(inside(b, a, "k")).distinct()


def recall_precision(found: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: recall of the true tags (see `recall`), and precision, the share of detections (tag, ord) whose key equals, contains or is contained in a true one with at most two characters more or less."""
    hits = recall(truth.select("tag").distinct(), found)
    keyed = found.withColumn("k", t.eval_key(F.col("tag")))
    good = _close(keyed, truth.select(t.eval_key(F.col("tag")).alias("k")), 2).withColumn("__good", F.lit(1))
    one = hits.agg(F.count("hit").alias("found_count"), F.count(F.lit(1)).alias("gt_count"))
    two = keyed.join(good, "k", "left").agg(F.count("__good").alias("correct"), F.count(F.lit(1)).alias("detections"))
    both = one.withColumn("correct", two.select("correct").scalar()).withColumn("detections", two.select("detections").scalar())

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.round(F.try_divide(F.col(a), F.col(b)), 4), F.lit(0.0))

    return both.select(share("found_count", "gt_count").alias("recall"), share("correct", "detections").alias("precision"), "found_count", "gt_count", "correct", "detections")


def missing_in_both(truth: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """True tags that neither side has (see `recall`)."""
    tags = truth.select("tag").distinct()
    gone = [recall(tags, side).where("hit IS NULL").select("tag") for side in (left, right)]
    return gone[0].intersect(gone[1])


def extras(found: DataFrame, register: DataFrame) -> DataFrame:
    """Distinct detected tags (tag) whose key neither equals, contains nor is contained in a register tag's; blank keys are contained in any."""
    keyed = found.select("tag", t.eval_key(F.col("tag")).alias("k")).distinct().where("k <> ''")
    return keyed.join(_close(keyed, register.select(t.eval_key(F.col("tag")).alias("k")), None), "k", "left_anti").select("tag")


def prefix_discrepancies(full: DataFrame, other: DataFrame, reach: float = 150, by: list[str] | None = None) -> DataFrame:
    """(by, id, other, kind, full_tag, other_tag, distance): for each row of full (id, ord, box, tag) the row of other whose centre is nearest, by steps
    along the axes and up to reach, where the two tags differ in more than form: prefix if one key ends in the other, else mismatch."""
    from tagloom.functions import geometry as g
    from tagloom.operators.spatial import nearest

    by = by or ["drawing_id"]

    def spots(df: DataFrame) -> DataFrame:
        x, y = g.center(F.col("box"))
        return df.where("box IS NOT NULL").select(*by, "id", "ord", "tag", F.struct(x.alias("x1"), y.alias("y1"), x.alias("x2"), y.alias("y2")).alias("box"))

    def steps(l: Column, r: Column) -> Column:
        return F.abs(l["box"]["x1"] - r["box"]["x1"]) + F.abs(l["box"]["y1"] - r["box"]["y1"])

    near = nearest(spots(full), spots(other), reach, steps, inclusive=True, by=by)
    met = near.join(full.select(*by, "id", F.trim(F.coalesce("tag", F.lit(""))).alias("full_tag")), [*by, "id"]).withColumn("other_tag", F.trim(F.coalesce(F.col("nearest.tag"), F.lit(""))))
    a, b = t.eval_key(F.col("full_tag")), t.eval_key(F.col("other_tag"))
    kind = F.when((a != "") & (b != "") & (a.endswith(b) | b.endswith(a)), "prefix").otherwise("mismatch")
    return met.where(a != b).select(*by, "id", F.col("nearest.id").alias("other"), kind.alias("kind"), "full_tag", "other_tag", F.round("distance", 1).alias("distance"))
