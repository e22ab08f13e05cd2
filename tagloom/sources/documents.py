"""JSON documents: a header and arrays of records, read with declared schemas and written with their counts."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOX = T.StructType([T.StructField(c, T.IntegerType()) for c in ("x1", "y1", "x2", "y2")])
CANDIDATE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("candidate_id", "symbol_name", "symbol_category", "tag_text", "tag_text_gemini", "tag_text_ocr", "scope_type", "sow_status", "sow_reason", "tag_source", "functional_context")]
    + [T.StructField("patch_id", T.IntegerType()), T.StructField("symbol_bbox", BOX), T.StructField("tag_bbox", BOX)]
    + [T.StructField(c, T.DoubleType()) for c in ("ocr_confidence", "vision_confidence")]
)
#: Where records are, in the order of preference.
RECORD_KEYS = ("validated_candidates", "enriched_candidates", "candidates")


def read_records(spark: SparkSession, path: str, record: T.StructType = CANDIDATE, keys: tuple[str, ...] = RECORD_KEYS) -> DataFrame:
    """A row per record of the first array that a document has: drawing_id (its file's name), ord (place in the array) and the record's fields. A document with none gives none."""
    schema = T.StructType([T.StructField(k, T.ArrayType(record)) for k in keys])
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.json)?$", 1)
    return docs.select(name.alias("drawing_id"), F.posexplode(F.coalesce(*[F.col(k) for k in keys])).alias("ord", "r")).select("drawing_id", "ord", "r.*")


def write_records(rows: DataFrame, path: str, summary: dict[str, Column] | None = None) -> DataFrame:
    """Write rows as JSON lines, partitioned by drawing; returns one row of counts."""
    rows.write.mode("overwrite").partitionBy("drawing_id").json(path)
    return rows.agg(F.count(F.lit(1)).alias("count"), *[c.alias(k) for k, c in (summary or {}).items()])


def manifest(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, count) of several stages' rows, in the order given."""
    out = None
    for i, (name, df) in enumerate(stages.items()):
        one = df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(i).alias("ord"), F.lit(name).alias("stage"), "count")
        out = one if out is None else out.unionAll(one)
    return out


def detect_format(files: DataFrame) -> DataFrame:
    """files (path, font_count, text_len) with kind: vector PDFs have fonts and 50 characters of text; other PDFs and images are raster."""
    p = F.lower("path")
    kind = F.when(p.endswith(".pdf") & (F.col("font_count") > 0) & (F.col("text_len") >= 50), "vector").when(p.endswith(".pdf") | p.rlike(r"\.(jpg|jpeg|png|tif|tiff|bmp)$"), "raster").otherwise("unsupported")
    return files.withColumn("kind", kind)


def points_to_mm(points: Column) -> Column:
    return points * 0.352778


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    """The first of the paths that exists in its store."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return path
    return None


def json_documents(rows: DataFrame, key: str = "candidates", order: str = "ord", counts: dict[str, Column] | None = None, version: str = "1.0", by: tuple[str, ...] = ("drawing_id",)) -> DataFrame:
    """(by, document): a JSON text for each drawing: a version, the number of its records and further counts (aggregates), and its records under `key` in their order."""
    keep = [c for c in rows.columns if c not in (*by, order)]
    told = [c.alias(k) for k, c in (counts or {}).items()]
    one = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("count"), *told, F.array_sort(F.collect_list(F.struct(F.col(order).alias("__o"), F.struct(*keep).alias("r")))).alias("__rows"))
    document = F.struct(F.lit(version).alias("version"), F.col("count"), *[F.col(k) for k in (counts or {})], F.transform("__rows", lambda x: x["r"]).alias(key))
    return one.select(*by, F.to_json(document).alias("document"))


def registry_path(spark: SparkSession, folder: str, workbook: str | None = None) -> str | None:
    """The register of a run: the first of master_tags.json, tables_context.json and a workbook that the folder has. One that is there but empty is it all the same."""
    return first_existing(spark, [f"{folder}/{name}" for name in ("master_tags.json", "tables_context.json", workbook) if name])


def hierarchy_path(spark: SparkSession, folder: str, name: str = "hierarchy", given: str | None = None) -> str | None:
    """A given path, else the folder's <name>_full.json, else, with a warning that the hierarchy may lack parts of the sheet, its <name>.json; null if there is none."""
    if given:
        return first_existing(spark, [given])
    found = first_existing(spark, [f"{folder}/{name}_full.json", f"{folder}/{name}.json"])
    if found and not found.endswith("_full.json"):
        warnings.warn(f"{name}_full.json isn't in {folder}: {name}.json may lack parts of the sheet", stacklevel=2)
    return found
