"""Detection-like tables over the supplied ones: one SQL text that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CANDIDATES = """
SELECT p_partkey AS id, p_partkey % 40 AS drawing_id, p_partkey AS ord,
  CASE p_partkey % 12
    WHEN 0 THEN 'V-FIT-' || CAST(100 + p_partkey % 900 AS VARCHAR(10)) WHEN 1 THEN 'v fz-' || CAST(200 + p_partkey % 50 AS VARCHAR(10))
    WHEN 2 THEN '10"-GV-V' || CAST(p_partkey % 300 AS VARCHAR(10)) || '-11502X' WHEN 3 THEN 'V---BV-' || CAST(2000 + p_partkey % 500 AS VARCHAR(10))
    WHEN 4 THEN 'PSV—' || CAST(100 + p_partkey % 300 AS VARCHAR(10)) WHEN 5 THEN 'I-0' || CAST(10 + p_partkey % 90 AS VARCHAR(10))
    WHEN 6 THEN '4224-MGDV-6-50-2' || CAST(p_partkey % 1000 AS VARCHAR(10)) WHEN 7 THEN 'K-V-' || CAST(200 + p_partkey % 40 AS VARCHAR(10))
    WHEN 8 THEN ' lit_' || CAST(300 + p_partkey % 200 AS VARCHAR(10)) || ' ' WHEN 9 THEN ''
    WHEN 10 THEN 'TT.' || CAST(100 + p_partkey % 700 AS VARCHAR(10)) || 'a' ELSE 'XV-O' || CAST(p_partkey % 400 AS VARCHAR(10)) END AS tag,
  CASE p_partkey % 9
    WHEN 0 THEN 'Ball Valve' WHEN 1 THEN 'Flow Indicating Transmitter' WHEN 2 THEN 'Pressure Safety Relief Valve'
    WHEN 3 THEN 'Flow Control Valve' WHEN 4 THEN 'Temperature Element' WHEN 5 THEN 'Gas Compressor'
    WHEN 6 THEN 'Limit Switch Close' WHEN 7 THEN 'Pressure Transmitter' ELSE p_name END AS symbol_name,
  CASE p_partkey % 4 WHEN 0 THEN 'instrument' WHEN 1 THEN 'valve' WHEN 2 THEN 'equipment' ELSE 'piping' END AS category,
  CAST(p_partkey * 37 % 101 AS DOUBLE) / 101 AS det, CAST(p_partkey * 53 % 97 AS DOUBLE) / 96 AS ocr,
  CAST(p_partkey * 29 % 89 AS DOUBLE) / 88 AS geo, CAST(p_partkey % 3 AS DOUBLE) / 2 AS val, CAST(p_partkey % 2 AS DOUBLE) / 2 + 0.5 AS reg,
  p_partkey % 7 = 0 AS isolated, p_partkey % 2 = 1 AS in_registry
FROM part
"""

BOXES = """
SELECT l_orderkey * 10 + l_linenumber AS id, CAST(floor(l_orderkey / 400) AS BIGINT) AS drawing_id, l_orderkey * 10 + l_linenumber AS ord,
  (l_partkey * 7919 + l_linenumber * 131) % 9500 AS x1, (l_suppkey * 10477 + l_orderkey * 17) % 6900 AS y1,
  (l_partkey * 7919 + l_linenumber * 131) % 9500 + 20 + l_partkey % 120 AS x2, (l_suppkey * 10477 + l_orderkey * 17) % 6900 + 20 + l_suppkey % 90 AS y2,
  'T-' || CAST(l_partkey % 25 AS VARCHAR(10)) AS tag, CAST(l_quantity AS DOUBLE) / 50 AS conf
FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey, min(l_quantity) AS l_quantity FROM lineitem GROUP BY l_orderkey, l_linenumber) one
"""

SEGMENTS = """
SELECT o_orderkey AS id, CAST(floor(o_orderkey / 400) AS BIGINT) AS drawing_id, o_orderkey AS ord,
  (o_custkey * 613) % 9000 AS sx0, (o_orderkey * 389) % 6500 AS sy0,
  (o_custkey * 613) % 9000 + CASE WHEN o_orderkey % 3 = 1 THEN 0 ELSE 300 + o_custkey % 200 END AS sx1,
  (o_orderkey * 389) % 6500 + CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 250 + o_custkey % 100 END AS sy1
FROM orders
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(spark: SparkSession, sf_dir: str, text: str, name: str) -> DataFrame:
    return spark.sql(text.replace(f"FROM {name}", "FROM {t}").replace("VARCHAR(10)", "STRING"), t=table(spark, sf_dir, name))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, CANDIDATES, "part")


#: Rows of a table that a task gets at most, about, when they are dealt by key.
ROWS = 250_000


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """A supplied table's rows by key, in as many parts as its rows call for (Parquet's footers count them), so that a task's memory doesn't grow with the
    table: Spark joins parts of a shuffle until they have 64 MB, which may be millions of rows of a few well packed columns."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS))
    return df.repartition(parts, *keys)


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"), "l_orderkey", "l_linenumber")
    df = spark.sql(BOXES.replace("FROM lineitem", "FROM {t}").replace("VARCHAR(10)", "STRING"), t=lines)
    return df.select("id", "drawing_id", "ord", F.struct("x1", "y1", "x2", "y2").alias("box"), "tag", "conf")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _sql(spark, sf_dir, SEGMENTS, "orders")
    seg = F.struct(F.col("sx0").alias("x0"), F.col("sy0").alias("y0"), F.col("sx1").alias("x1"), F.col("sy1").alias("y1"))
    box = F.struct(F.col("sx0").alias("x1"), F.col("sy0").alias("y1"), F.col("sx1").alias("x2"), F.col("sy1").alias("y2"))
    return df.select("id", "drawing_id", "ord", seg.alias("seg"), box.alias("box"))
