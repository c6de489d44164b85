"""Activity statistics and choices by frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import month_label, month_sort_key


def per_month(rows: DataFrame, ts: Column) -> DataFrame:
    """month label, sort number (year * 100 + month) and count."""
    key = month_sort_key(F.col("month"))
    return rows.groupBy(month_label(ts).alias("month")).agg(F.count(F.lit(1)).alias("n")).select("month", (key["year"] * 100 + key["month"]).cast("long").alias("month_no"), "n")


def per_year(rows: DataFrame, ts: Column) -> DataFrame:
    """year and month counts of one pass (rollup): month_no is null in the year's row."""
    parts = rows.select(F.year(ts).alias("year"), F.month(ts).alias("month_no"))
    return parts.rollup("year", "month_no").agg(F.count(F.lit(1)).alias("n")).where("year is not null").select(F.col("year").cast("long"), F.col("month_no").cast("long"), "n")


def distinct_parents_per_month(rows: DataFrame, ts: Column, parent: str) -> DataFrame:
    return rows.groupBy(month_label(ts).alias("month")).agg(F.countDistinct(parent).alias("parents"))


def children_per_parent(children: DataFrame, parent: str) -> DataFrame:
    return children.groupBy(parent).agg(F.count(F.lit(1)).alias("n_children"))


def top_k(counts: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    """The k largest with their ranks; equal counts by ``tie``. The rank runs over k rows."""
    best = counts.orderBy(F.desc(by), tie).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(by), tie)).cast("long"))


def top_participants(rows: DataFrame, name: str, k: int = 15) -> DataFrame:
    """Most active names; blank names, addresses and "(unknown)" are left out."""
    fine = rows.where((F.coalesce(name, F.lit("")) != "") & ~F.col(name).contains("@") & (F.col(name) != "(unknown)"))
    return top_k(fine.groupBy(name).agg(F.count(F.lit(1)).alias("n")), "n", name, k)


def relative_to_peak(counts: DataFrame, n: str = "n") -> DataFrame:
    """Counts with their whole percentage of the largest, which is joined as one broadcast row."""
    peak = counts.agg(F.max(n).alias("_peak"))
    return counts.join(F.broadcast(peak)).withColumn("percent", F.bround(100 * F.col(n) / F.col("_peak")).cast("long")).drop("_peak")


def most_used(rows: DataFrame, key: str, value: str, seen: str, prefer: Column | None = None) -> DataFrame:
    """(key, value): the most frequent value of each key; preferred ones first, the first seen among equals."""
    votes = rows.where(F.col(key).isNotNull() & (F.coalesce(value, F.lit("")) != "")).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"), F.min(seen).alias("_first"))
    best = F.struct(F.coalesce(prefer, F.lit(False)).alias("p") if prefer is not None else F.lit(False).alias("p"), F.col("_n"), (-F.col("_first")).alias("f"))
    return votes.groupBy(key).agg(F.max_by(value, best).alias(value))


def backfill_names(rows: DataFrame, key: str, name: str, seen: str, masked_domain: str = "masked.invalid") -> DataFrame:
    """Most used usable name of each address."""
    return most_used(rows.where(~F.lower(name).endswith("@" + masked_domain)), key, name, seen)


def real_names(rows: DataFrame, key: str, name: str, seen: str) -> DataFrame:
    """As :func:`most_used`, names of two words and more preferred."""
    return most_used(rows, key, name, seen, F.size(F.split(F.trim(name), r"\s+")) >= 2)


def attachment_totals(attachments: DataFrame) -> DataFrame:
    return attachments.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
