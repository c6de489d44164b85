"""The driver's tables in the roles that the operators take: messages, texts, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as messages: the customer is the subject, every 50th answers the order before it."""
    o = table(spark, sf_dir, "orders")
    reply = F.when(F.col("o_orderkey") % 50 == 1, F.concat(F.lit("o"), (F.col("o_orderkey") - 1).cast("string")))
    return o.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("msgid"), reply.alias("in_reply_to"),
        F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("subject"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("date_iso"),
    )


#: The same rows for DuckDB.
ORDER_MESSAGES = """SELECT o_orderkey AS id, 'o' || o_orderkey AS msgid, CASE WHEN o_orderkey % 50 = 1 THEN 'o' || (o_orderkey - 1) END AS in_reply_to,
    'customer ' || o_custkey AS subject, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS date_iso, CAST(o_orderdate AS DATE) AS day FROM orders"""


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as messages; each answers the turn before it."""
    c = table(spark, sf_dir, "conversations")
    name = lambda t: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit(".t"), t.cast("string"))
    return c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), name(F.col("turn")).alias("msgid"), F.when(F.col("turn") > 0, name(F.col("turn") - 1)).alias("in_reply_to"),
        F.lit(None).cast("string").alias("subject"), F.lit(None).cast("string").alias("date_iso"), F.col("role").alias("from_name"), F.col("text").alias("body"),
    )
