"""ROI tables derived from the order tables: the same SQL for every engine.

A customer is an object, its orders by key are its slices, an order is a concave
polygon of eight lattice points; an order whose key is a multiple of eleven begins
after an empty slice, so objects have gaps.  Lines of an order are small diamonds
within it.  Vectors are rows of an image.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slices of an order: its place among the object's orders and one empty slice for each multiple of eleven up to it.
_SLICE = "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + sum(CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)"

VERTICES = """
SELECT concat('Position00', CAST(obj % 4 + 1 AS STRING)) AS name, concat('nucleus_', lpad(CAST(ok AS STRING), 9, '0')) AS roi,
       CAST(z AS INT) AS z, CAST(ok * 8 + i AS BIGINT) AS ord, cx + rad * dx AS x, cy + rad * dy AS y, st <> 'P' AS include
FROM (
    SELECT obj, ok, z, st, CAST(24 * (obj % 37) + (ok % 5) AS DOUBLE) AS cx, CAST(24 * ((obj - obj % 37) / 37) + (ok % 3) AS DOUBLE) AS cy, CAST(3 + (ok % 4) AS DOUBLE) AS rad
    FROM (SELECT o_custkey AS obj, o_orderkey AS ok, o_orderstatus AS st, {slice} AS z FROM {orders}) o
) r CROSS JOIN (VALUES (1, 2, 0), (2, 1, 1), (3, 0, 2), (4, -1, 1), (5, -2, 0), (6, -1, -1), (7, 0, -1), (8, 1, -2)) AS t(i, dx, dy)
""".replace("{slice}", _SLICE)

NUCLEOLI = """
SELECT concat('Position00', CAST(obj % 4 + 1 AS STRING)) AS name, concat('nucleolus_', lpad(CAST(ok AS STRING), 9, '0'), '_', CAST(ln AS STRING)) AS roi,
       CAST(z AS INT) AS z, CAST((ok * 256 + ln) * 4 + i AS BIGINT) AS ord,
       CAST(24 * (obj % 37) + (ok % 5) + 3 * (ln % 3) - 3 + dx AS DOUBLE) AS x, CAST(24 * ((obj - obj % 37) / 37) + (ok % 3) + (ln % 2) + dy AS DOUBLE) AS y
FROM (SELECT o_custkey AS obj, o_orderkey AS ok, {slice} AS z FROM {orders}) o
JOIN (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ln FROM {lineitem}) l ON l_orderkey = ok
CROSS JOIN (VALUES (1, 1, 0), (2, 0, 1), (3, -1, 0), (4, 0, -1)) AS t(i, dx, dy)
""".replace("{slice}", _SLICE)

MEASUREMENTS = """
SELECT concat('sample', CAST(o_custkey % 3 + 1 AS STRING), '.lif/Position00', CAST(o_custkey % 4 + 1 AS STRING), ':', lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0'), '-',
              lpad(CAST(o_custkey % 10000 AS STRING), 4, '0'), '-0001:c:', CAST(ch AS STRING), '/3 z:', CAST(o_orderkey % 72 + 1 AS STRING), '/72') AS label,
       concat('nucleus_', lpad(CAST(o_orderkey AS STRING), 9, '0')) AS roi_name, ch, o_totalprice / 1000 AS area, CAST(o_orderkey % 100 AS DOUBLE) / 100 AS circ
FROM {orders} CROSS JOIN (VALUES (1), (2), (3)) AS t(ch)
"""


def _run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "lineitem") if f"{{{t}}}" in sql}
    return spark.sql(sql, **tables)


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, VERTICES)


def nucleoli(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, NUCLEOLI)


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, MEASUREMENTS)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, ch, z, y, x and v: 64 rows of vectors make an image, a second channel holds the negative."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    at = vectors.select(F.concat(F.lit("Image"), F.floor(F.col("vec_id") / 64).cast("string")).alias("name"), F.lit(1).alias("z"), (F.col("vec_id") % 64).cast("int").alias("y"), F.posexplode("embedding").alias("x", "v"))
    both = at.withColumn("ch", F.explode(F.array(F.lit(1), F.lit(2))))
    return both.withColumn("v", F.floor(F.col("v").cast("double") * 1000) * (3 - 2 * F.col("ch"))).withColumn("v", F.col("v").cast("double"))


#: The same pixels in SQL.
PIXELS = """
SELECT concat('Image', CAST(CAST(floor(vec_id / 64) AS BIGINT) AS VARCHAR)) AS name, ch, 1 AS z, CAST(vec_id % 64 AS INT) AS y, x, CAST(floor(CAST(embedding[x + 1] AS DOUBLE) * 1000) * (3 - 2 * ch) AS DOUBLE) AS v
FROM (SELECT vec_id, embedding, CAST(unnest(range(0, len(embedding))) AS INT) AS x FROM embeddings) t CROSS JOIN (VALUES (1), (2)) AS c(ch)
"""
