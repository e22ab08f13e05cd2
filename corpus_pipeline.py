"""A corpus pipeline of five stages over documents; each reads what the one before it kept and wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.llm import crf, mixing, packing, simhash, toxicity
from tagloom.llm.common import fresh, new_folder, staged, table
from tagloom.llm.queries import quality_model, tokenizer_file, toxicity_model

#: SQL can't express the models, the fingerprints or the flow.
ORACLE_SQL = None


def _kept(docs: DataFrame, module, model, keep) -> DataFrame:
    """The rows of docs whose score passes; a row is judged by its own text alone, whatever its id."""
    name = fresh(docs, "score")
    return module.with_score(docs, model, name=name).where(keep(F.col(name))).select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier doesn't call toxic (a score of 0.5 is toxic).

    Null texts are scored as empty ones; rows without an id and repeated rows are scored like any other, equal texts
    equally; an empty table gives an empty one; further columns pass through.
    """
    return _kept(docs, toxicity, toxicity_model(spark, sf_dir), lambda score: score < 0.5)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-level random field calls good (a score of 0.5 is good). Odd rows as in `drop_toxic`."""
    return _kept(docs, crf, quality_model(spark, sf_dir), lambda score: score >= 0.5)


#: A Jaccard similarity of 0.8 on sets of five-word shingles, decided exactly. 512-bit fingerprints give the candidates: 0.8
#: of two equally large sets is a cosine of 0.889, an angle of 0.151 half-turns and so 78 differing bits on average, give or
#: take 8; the radius is three deviations above. Pairs at 0.8 share one of the 40 blocks of 12 bits all but surely
#: (1 - (1 - 0.849 ** 12) ** 40 = 0.998).
NEAR = {"least": 0.8, "shingle_words": 5, "longs": 8, "radius": 104, "bits": 12}


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates: the one with the smallest id, null ids last, then the smallest hash of the text.

    Rows that share an id but not a text are documents of their own. Of repeated rows (one id, one text) one stays. Null
    texts are empty ones, which are copies of each other. An empty table gives an empty one; further columns pass through.
    """
    found = staged(simhash.near_copies(docs, **NEAR), "near")
    name = fresh(docs, "digest")
    rows = docs.withColumn(name, F.xxhash64(F.coalesce("text", F.lit(""))))

    def of(keys: DataFrame, rows: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col("id").alias("__id"), F.col("digest").alias("__digest"))
        return rows.join(keys, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col(name) == F.col("__digest")), how)

    kept = of(found.where(~F.col("first")).select("id", "digest").distinct(), rows, "left_anti")
    again = found.where("first").groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "digest")
    if not again.isEmpty():  # whole rows are only compared where they repeat
        kept = of(again, kept, "left_anti").unionByName(of(again, kept, "left_semi").dropDuplicates(["doc_id", name]))
    return kept.select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each row as often as it takes that row, so that the stage's words are those of the mix.

    Rows meet their choice by id, text and source; of several alike in these, in the order of what else they hold, each gets one of their
    choices, the largest first. Documents without words have no size and aren't taken; a null source is a source; an empty table gives
    an empty one; further columns pass through.
    """
    chosen, _ = mixing.mix(docs)
    key = [fresh(docs, "__h"), fresh(docs, "__s")]
    chosen = staged(chosen.where("passes > 0 OR size > 0").select(F.col("h").alias(key[0]), F.to_json("pattern").alias(key[1]), "passes"), "mix-choice")
    rows = docs.withColumn(key[0], mixing.row_hash(F.col("doc_id"), F.col("text"))).withColumn(key[1], F.to_json(F.array(F.col("source").cast("string"))))
    times = chosen.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.max("passes").alias("__times"))
    several = staged(times.where("__n > 1").select(key), "mix-several")
    taken = rows.join(times.where("__n = 1 AND __times > 0").select(*key, "__times"), key)
    if not several.isEmpty():  # only rows that repeat are numbered
        each = Window.partitionBy(*key)
        own = rows.join(several, key, "left_semi").withColumn("__k", F.row_number().over(each.orderBy(F.to_json(F.struct(*docs.columns)))))
        told = chosen.join(several, key, "left_semi").select(*key, F.row_number().over(each.orderBy(F.desc("passes"))).alias("__k"), F.col("passes").alias("__times"))
        taken = taken.select(*docs.columns, "__times").unionByName(own.join(told.where("__times > 0"), [*key, "__k"]).select(*docs.columns, "__times"))
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1), "__times")).alias("__pass")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of the packed sequences. Null and empty texts have the end token alone; repeated rows and rows without an id are packed like any other; an empty table gives no rows; further columns aren't read."""
    pieces = packing.piece_table(docs, tokenizer_file())
    return packing.pack(pieces).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", one_of_each),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = new_folder(spark, f"stage{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
