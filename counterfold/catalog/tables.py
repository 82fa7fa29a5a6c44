"""Cohorts built from the test tables, once as DataFrames and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Treatment ``hi`` (discount above 0.05), binary outcome ``dear``."""
    return table(spark, sf_dir, "lineitem").withColumns(
        {
            "hi": F.col("l_discount") > 0.05,
            "dear": (F.col("l_extendedprice") > 50000).cast("int"),
        }
    )


LINEITEM_SQL = """
  SELECT *, l_discount > 0.05 AS hi, CAST(l_extendedprice > 50000 AS INTEGER) AS dear
  FROM lineitem"""


def orders_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer and nation: treatments ``urgent``, ``late``, ``rich``."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumns(
            {
                "urgent": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
                "late": F.year("o_orderdate") >= 1998,
                "rich": F.col("c_acctbal") > 4000,
                "dear": (F.col("o_totalprice") > 250000).cast("int"),
            }
        )
    )


ORDERS_SQL = """
  SELECT *, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent,
         year(o_orderdate) >= 1998 AS late, c_acctbal > 4000 AS rich,
         CAST(o_totalprice > 250000 AS INTEGER) AS dear
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey"""


def documents_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with labels where there are any: quality and toxic may be null."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn(
        "english", F.col("lang") == "en"
    ).withColumn("long", F.col("n_chars") > 500)


DOCUMENTS_SQL = """
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
         d.lang = 'en' AS english, d.n_chars > 500 AS long
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two genotype columns made from the part table, with nulls."""
    k, s = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(s % 10 == 0, F.lit(None).cast("string"))
        .when(s % 3 == 0, "AT").when(s % 3 == 1, "TT").otherwise("AA").alias("site_1"),
        F.when(k % 4 == 0, "GG").when(k % 4 == 1, "GT").otherwise("TT").alias("site_2"),
        "p_size",
    )


GENOTYPES_SQL = """
  SELECT p_partkey,
    CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 3 = 0 THEN 'AT'
         WHEN p_size % 3 = 1 THEN 'TT' ELSE 'AA' END AS site_1,
    CASE WHEN p_partkey % 4 = 0 THEN 'GG' WHEN p_partkey % 4 = 1 THEN 'GT' ELSE 'TT' END AS site_2,
    p_size
  FROM part"""
