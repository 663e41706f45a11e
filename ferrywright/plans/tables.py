"""The given tables, and versions and catalogs that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later version of orders: some prices up, some keys gone, some new."""
    old = table(spark, sf_dir, "orders")
    kept = old.where("o_orderkey % 10 <> 3").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return kept.unionByName(old.where("o_orderkey % 50 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 10000000))


NEW_ORDERS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 <> 3
UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 50 = 0"""


def order_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus of code, a statement per order, in the dialect that its status names."""
    o = table(spark, sf_dir, "orders")
    text = F.concat(
        F.lit("BEGIN SELECT NVL(x, 0) || 'k' INTO v FROM t"), F.col("o_custkey").cast("string"), F.lit(" WHERE ROWNUM <= 5 AND a = b(+); "),
        F.when(F.col("o_orderkey") % 3 == 0, "DBMS_OUTPUT.put_line('x'); MERGE INTO z; ").otherwise(""), F.when(F.col("o_orderkey") % 4 == 0, "SAVEPOINT s; TRUNC(d); ").otherwise(""), F.when(F.col("o_orderkey") % 5 == 0, "a := b CONNECT BY c; ").otherwise(""), F.lit("END;"),
    )
    kind = F.when(F.col("o_orderstatus") == "F", "FUNCTION").when(F.col("o_orderstatus") == "O", "VIEW").otherwise("TRIGGER")
    return o.select(F.col("o_orderpriority").alias("db"), kind.alias("object_type"), F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("name"), text.alias("code"))


def order_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog of objects, one per order."""
    o = table(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "FUNCTION").when(F.col("o_orderstatus") == "O", "VIEW").otherwise("TRIGGER")
    return o.select(F.col("o_orderpriority").alias("db"), kind.alias("object_type"), F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("object_name"), F.when(F.col("o_orderkey") % 11 == 0, "INVALID").otherwise("VALID").alias("status"))


def boxes_of(spark: SparkSession, sf_dir: str, name: str, key: str, scale: float) -> DataFrame:
    """Boxes from two numbers of a table."""
    df = table(spark, sf_dir, name)
    return df.select(F.col(key).alias("id"), *[(F.pmod(F.col(key) * m, F.lit(1000)) / 10.0).alias(c) for c, m in (("x0", 7), ("y0", 13))]).withColumns({"x1": F.col("x0") + scale, "y1": F.col("y0") + scale * 2})
