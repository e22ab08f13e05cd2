"""Scope of work: what symbol descriptions imply, the scope's memory, and which tags it lets through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.lookup import scope_fuzzy
from tagloom.symbols import CATEGORIES, EXTRAS, SHAPES


def inferred(description: Column) -> Column:
    """struct(category, prefix): of the first row of CATEGORIES that has a word in the description; Unknown and an empty prefix without one."""
    up = F.upper(F.coalesce(description, F.lit("")))
    case = None
    for words, category, prefix in CATEGORIES:
        hit = None
        for w in words:
            hit = up.contains(w) if hit is None else hit | up.contains(w)
        out = F.struct(F.lit(category).alias("category"), F.lit(prefix).alias("prefix"))
        case = F.when(hit, out) if case is None else case.when(hit, out)
    return case.otherwise(F.struct(F.lit("Unknown").alias("category"), F.lit("").alias("prefix")))


def shape_features(description: Column, category: Column) -> Column:
    """What a symbol looks like: its category's shape, then what further words add."""
    up = F.upper(F.coalesce(description, F.lit("")))
    base = F.create_map(*[x for k, v in SHAPES.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))])
    more = []
    for words, told in EXTRAS:
        hit = F.lit(True)
        for w in words:
            hit = hit & up.contains(w)
        more.append(F.when(hit, told))
    return F.concat(F.coalesce(F.try_element_at(base, category), F.array(F.lit("unknown shape"))), F.array_compact(F.array(*more)))


def prefix_index(scope: DataFrame) -> DataFrame:
    """(prefix, names): a scope's (ord, name, prefix) symbol names for each upper-case prefix, in order."""
    return scope.where("prefix <> ''").groupBy(F.upper("prefix").alias("prefix")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"]).alias("names"))


def category_breakdown(scope: DataFrame) -> DataFrame:
    """(category, status, n): how many of a scope's symbols a category has for each status."""
    return scope.groupBy("category", "status").agg(F.count(F.lit(1)).alias("n"))


def scope_any(rows: DataFrame, scope: DataFrame, name: str = "symbol_name", least: float = 0.6) -> DataFrame:
    """rows with sow_status and sow_reason by word overlap: any blocked name of at least `least` comes first, then any allowed one, else UNSPECIFIED; the reason names the first match by name."""
    def words(c: str) -> Column:
        return F.array_distinct(F.split(F.upper(F.trim(F.col(c))), r"\s+"))

    a = rows.select(F.col(name).alias("__name")).where(F.col(name).isNotNull()).distinct().withColumn("w", words("__name"))
    b = scope.select(F.col("name").alias("other"), "status").distinct().withColumn("v", words("other"))
    met = a.select("__name", F.size("w").alias("n"), F.explode("w").alias("word")).join(b.select("other", "status", F.size("v").alias("m"), F.explode("v").alias("word")), "word")
    hits = met.groupBy("__name", "other", "status", "n", "m").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") / F.greatest("n", "m") >= least)
    best = hits.groupBy("__name").agg(F.min(F.struct((F.col("status") != "BLOCK").cast("int").alias("o"), "other")).alias("m"))
    out = rows.join(best, F.col(name) == F.col("__name"), "left")
    return out.withColumn("sow_status", F.when(F.col("m.o") == 0, "OUT_OF_SCOPE").when(F.col("m.o") == 1, "IN_SCOPE").otherwise("UNSPECIFIED")).withColumn("sow_reason", F.coalesce(F.col("m.other"), F.lit(""))).drop("__name", "m")


def filter_tags(tags: DataFrame, scope: DataFrame, tag: str = "tag", name: str = "symbol_name") -> DataFrame:
    """tags with symbol (the given name, or if it is blank or the tag itself the first symbol of the tag's letters in the scope, or "Tag prefix" and the letters) and sow_status.

    A symbol is in or out of scope by its exact name, else by the scope entry whose words overlap most. scope: (ord, name, status, prefix)."""
    letters = F.regexp_extract(F.upper(F.coalesce(F.col(tag), F.lit(""))), "^([A-Z]{1,5})", 1)
    index = prefix_index(scope).select(F.col("prefix").alias("__l"), F.get("names", F.lit(0)).alias("__first"))
    given = F.coalesce(F.col(name), F.lit(""))
    need = (given == "") | (given == F.coalesce(F.col(tag), F.lit("")))
    rows = tags.withColumn("__l", letters).join(index, "__l", "left")
    rows = rows.withColumn("symbol", F.when(~need, given).when(F.col("__l") == "", given).otherwise(F.coalesce("__first", F.concat(F.lit("Tag prefix "), F.col("__l"))))).drop("__l", "__first")
    exact = scope.groupBy(F.upper(F.trim("name")).alias("__u")).agg(F.max((F.col("status") == "BLOCK").cast("int")).alias("__b"))
    near = scope_fuzzy(rows.select(F.col("symbol").alias("symbol_name")), scope).select(F.col("name").alias("symbol"), F.col("status").alias("__s"))
    out = rows.withColumn("__u", F.upper(F.trim("symbol"))).join(exact, "__u", "left").join(near, "symbol", "left")
    blocked = F.coalesce(F.col("__b") == 1, F.col("__s") == "BLOCK")
    return out.withColumn("sow_status", F.when(blocked, "OUT_OF_SCOPE").when(F.col("__b").isNotNull() | F.col("__s").isNotNull(), "IN_SCOPE").otherwise("UNSPECIFIED")).drop("__u", "__b", "__s")


def filter_summary(filtered: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return filtered.agg(n.alias("total"), *[F.count_if(F.col("sow_status") == v).alias(k) for k, v in (("allowed", "IN_SCOPE"), ("blocked", "OUT_OF_SCOPE"), ("unspecified", "UNSPECIFIED"))])


def extractable(filtered: DataFrame) -> DataFrame:
    """What goes on to extraction: all that isn't out of scope."""
    return filtered.where("sow_status <> 'OUT_OF_SCOPE'")
