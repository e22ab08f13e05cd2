"""Reports on runs: figures of a hierarchy in one scan a table, answers by confidence, and what a run gained over another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DK = ["drawing_id"]


def evidence_kind(evidence: Column) -> Column:
    """What an equipment parent rests on: gemini, pipeline, mounted or other, the first that its evidence names."""
    e = F.lower(F.coalesce(evidence, F.lit("")))
    return F.when(F.contains(e, F.lit("gemini")), "gemini").when(F.contains(e, F.lit("pipeline")), "pipeline").when(F.contains(e, F.lit("mounted")) | F.contains(e, F.lit("from equipment")), "mounted").otherwise("other")


def hierarchy_metrics(nodes: DataFrame, edges: DataFrame, segments: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, metric, value): figures of each drawing with nodes (kind, equipment_parent, evidence, is_isolated), edges (rel) and segments (type, length, line).

    Nodes in all, by kind, with an equipment parent (also of instruments and valves alone, as shares in per cent of whole numbers, and by evidence), isolated, and instruments and valves with neither;
    edges in all and by relation; pipe segments over 150 long, and lines. Each table is aggregated once, by grouping sets where it is counted by a key as well."""
    has, lone = F.col("equipment_parent").isNotNull() & (F.col("equipment_parent") != ""), F.coalesce("is_isolated", F.lit(False))
    small = F.coalesce(F.col("kind").isin("instrument", "valve"), F.lit(False))
    one = nodes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("nodes"),
        F.count_if(F.col("kind") == "equipment").alias("equipment nodes"),
        F.count_if(has).alias("equipment parent"),
        F.count_if(small).alias("instruments and valves"),
        F.count_if(small & has).alias("instruments and valves with parent"),
        *[F.count_if(has & (evidence_kind(F.col("evidence")) == k)).alias(f"evidence: {k}") for k in ("gemini", "pipeline", "mounted", "other")],
        F.count_if(lone).alias("isolated"),
        F.count_if(small & ~has & ~lone).alias("no parent"),
    )
    share = lambda a, b: F.round(100 * F.try_divide(F.col(a), F.col(b)), 0).cast("long")
    one = one.withColumn("equipment parent %", share("equipment parent", "nodes")).withColumn("instruments and valves with parent %", share("instruments and valves with parent", "instruments and valves"))
    figures = [c for c in one.columns if c not in by]
    told = one.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").alias("value")) for c in figures])).alias("x")).select(*by, "x.metric", "x.value")
    sets = [[F.col(c) for c in [*by, "rel"]], [F.col(c) for c in by]]
    ties = edges.groupingSets(sets, *[F.col(c) for c in [*by, "rel"]]).agg(F.count(F.lit(1)).alias("value"), F.grouping("rel").alias("__all"))
    ties = ties.select(*by, F.when(F.col("__all") == 1, "edges").otherwise(F.concat(F.lit("edges: "), F.coalesce("rel", F.lit("none")))).alias("metric"), "value")
    pipe = F.col("type").isin("horizontal_pipe", "vertical_pipe") & (F.col("length") > 150)
    pipes = segments.groupBy(*by).agg(F.count_if(pipe).alias("pipe segments"), F.countDistinct("line").alias("lines"))
    pipes = pipes.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").alias("value")) for c in ("pipe segments", "lines")])).alias("x")).select(*by, "x.metric", "x.value")
    return told.unionAll(ties).unionAll(pipes)


def attachment_report(outcomes: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, section, name, n) of `attachment_edges`' outcomes (word, outcome): answers in all, by confidence and by what came of them, in one scan."""
    columns = [F.col(c) for c in [*by, "word", "outcome"]]
    sets = [[*columns[:-2], F.col("word")], [*columns[:-2], F.col("outcome")], columns[:-2]]
    n = outcomes.groupingSets(sets, *columns).agg(F.count(F.lit(1)).alias("n"), F.grouping("word").alias("__w"), F.grouping("outcome").alias("__o"))
    section = F.when(F.col("__w") == 0, "confidence").when(F.col("__o") == 0, "outcome").otherwise("total")
    return n.select(*by, section.alias("section"), F.coalesce(F.when(F.col("__w") == 0, F.col("word")), F.when(F.col("__o") == 0, F.col("outcome")), F.lit("answers")).alias("name"), "n")


def parents_gained(before: DataFrame, after: DataFrame, by: list[str] = DK) -> tuple[DataFrame, DataFrame]:
    """(coverage, gained) of instruments and valves (node, kind, equipment_parent) before and after a run.

    coverage: (by, before, after, total, gained, lost), total being those of the second run; gained: (by, node, equipment_parent), those that have a parent now and had none, or weren't there."""
    def held(df: DataFrame, name: str) -> DataFrame:
        p = F.nullif(F.col("equipment_parent"), F.lit(""))
        return df.where(F.col("kind").isin("instrument", "valve")).groupBy(*by, "node").agg(F.max(p).alias(name))

    both = held(before, "__b").join(held(after, "__a").withColumn("__now", F.lit(True)), [*by, "node"], "full")
    had, has = F.col("__b").isNotNull(), F.col("__a").isNotNull()
    coverage = both.groupBy(*by).agg(F.count_if(had).alias("before"), F.count_if(has).alias("after"), F.count_if("__now").alias("total"), F.count_if(has & ~had).alias("gained"), F.count_if(had & ~has).alias("lost"))
    return coverage, both.where(has & ~had).select(*by, "node", F.col("__a").alias("equipment_parent"))


def difference(before: DataFrame, after: DataFrame, on: list[str]) -> DataFrame:
    """(on, before, after, change): the values (value) of two runs side by side by key; what a run lacks is null, and the change counts it as 0."""
    a, b = before.select(*on, F.col("value").alias("before")), after.select(*on, F.col("value").alias("after"))
    return a.join(b, on, "full").withColumn("change", F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0)))
