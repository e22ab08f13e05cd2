"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import chat, crf, cws, fim, host_rules, html, mixing, packing, pii, simhash, toxicity, trie, warc
from tagloom.llm.common import crc_mod, table
from tagloom.llm.sql import FIM, HOST_RULES, TRIE


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text()


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, sources = mixing.mix(table(spark, sf_dir, "documents"))
    one = docs.withColumn("source", F.get("pattern", F.lit(0))).select(F.col("id").alias("doc_id"), "source", "size", "taken", "passes")
    few = sources.select(F.col("source").alias("of"), "source_size", "target")
    few = F.broadcast(few) if few.count() <= 10_000 else few
    return one.join(few, F.col("source").eqNullSafe(F.col("of"))).select("doc_id", "size", "source_size", "target", "taken", "passes")


def op2_cws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.with_next(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint("w0").alias("fingerprint"), F.col("component").alias("component_id"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.piece_table(table(spark, sf_dir, "documents"), tokenizer_file())
    return packing.pack(pieces).withColumnRenamed("id", "doc_id")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learnt from labelled documents whose crc32(doc_id) mod 5 isn't 0; a bounded sample of them (see labelled_sample)."""
    sample = toxicity.labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", lambda i: F.crc32(i.cast("string").cast("binary")) % 5 != 0)
    return toxicity.fit(*sample)


def quality_model(spark: SparkSession, sf_dir: str) -> crf.Model:
    """Learnt from labelled documents whose crc32(doc_id) mod 3 isn't 1; a bounded sample of them."""
    sample = toxicity.labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", lambda i: F.crc32(i.cast("string").cast("binary")) % 3 != 1)
    return crf.fit(*sample)


def _scored(found: DataFrame, by: int, rest: int) -> DataFrame:
    return found.select(F.col("id").alias("doc_id"), (crc_mod("id", by) == rest).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir)), 5, 0)


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("host", "host_rate", "host_strict")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op10_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(crf.score(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir)), 3, 1)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(table(spark, sf_dir, "documents"))

    def told(every):
        return F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def many(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("id").alias("doc_id"), *[many(k) for k in pii.BASE], F.sha2(told(F.filter("spans", lambda s: s["base"])).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.arrange(table(spark, sf_dir, "documents"))
    back = fim.restored(F.col("output"), F.col("form"))
    return made.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(trie.rebuilt(trie.pieces(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_cws": op2_cws,
    "op3_simhash": op3_simhash,
    "op4_html": op4_html,
    "op5_chat": op5_chat,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_host_rules": op8_host_rules,
    "op9_warc": op9_warc,
    "op10_crf": op10_crf,
    "op11_pii": op11_pii,
    "op12_fim": op12_fim,
    "op13_trie": op13_trie,
}

ORACLES: dict[str, str] = {"op8_host_rules": HOST_RULES, "op12_fim": FIM, "op13_trie": TRIE}
