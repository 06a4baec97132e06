"""``wide_facts``: nine measures with deterministic gaps, derived from lineitem.

The driver's tables have no null or NaN in the columns used, so this view
injects them by fixed rules; it runs over every lineitem row. The same
definition exists as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDE_KEYS = ("l_orderkey", "l_linenumber", "l_returnflag")
WIDE_MEASURES = ("f1", "f2", "f3", "f4", "f5", "f6", "f7", "f8", "f9")

# SQL text of the view; identical semantics in Spark SQL and DuckDB.
WIDE_FACTS_SQL = """
SELECT l_orderkey, l_linenumber, l_returnflag,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS f1,
  CASE WHEN l_orderkey % 11 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice END AS f2,
  CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS f3,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS f4,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice * (1 - l_discount) END AS f5,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_extendedprice * (1 - l_discount) * (1 + l_tax) END AS f6,
  CASE WHEN l_partkey % 3 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice / l_quantity END AS f7,
  CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS f8,
  CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE CAST(l_partkey % 100 AS DOUBLE) END AS f9
FROM lineitem
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wide_facts(lineitem: DataFrame) -> DataFrame:
    """The view above in the DataFrame API (one narrow projection)."""
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    price, disc, tax, qty = (F.col(c) for c in ("l_extendedprice", "l_discount", "l_tax", "l_quantity"))
    nan = F.lit(float("nan"))
    null = F.lit(None).cast("double")
    return lineitem.select(
        *WIDE_KEYS,
        F.when(ok % 7 == 0, null).otherwise(qty).alias("f1"),
        F.when(ok % 11 == 0, nan).otherwise(price).alias("f2"),
        F.when(disc == 0, null).otherwise(disc).alias("f3"),
        F.when(tax == 0, null).otherwise(tax).alias("f4"),
        F.when(ok % 7 == 0, null).otherwise(price * (1 - disc)).alias("f5"),
        F.when(pk % 5 == 0, null).otherwise(price * (1 - disc) * (1 + tax)).alias("f6"),
        F.when(pk % 3 == 0, nan).otherwise(price / qty).alias("f7"),
        F.when(ok % 5 == 0, null).otherwise(F.col("l_linenumber").cast("double")).alias("f8"),
        F.when(ok % 5 == 0, null).otherwise((pk % 100).cast("double")).alias("f9"),
    )


def load_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_facts(table(spark, sf_dir, "lineitem"))
