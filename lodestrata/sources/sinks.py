"""Sinks: search index files, monthly mbox text, sitemaps, page paths, partitioned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import html_escape
from ..operators.incremental import numbered_parts


def index_json(index: DataFrame) -> DataFrame:
    """(id, row): the index as compact JSON arrays of seven fields."""
    fields = [F.to_json(F.struct(F.col(c).alias("v"))) for c in ("mid", "subject", "author", "sent", "att_count", "thread", "tid")]
    bare = [F.regexp_replace(f, r'^\{"v":|\}$', "") for f in fields]
    return index.select("id", F.concat(F.lit("["), F.concat_ws(",", *bare), F.lit("]")).alias("row"))


def write_lines(rows: DataFrame, column: str, path: str) -> None:
    rows.select(column).write.mode("overwrite").option("compression", "gzip").text(path)


def monthly_mbox(messages: DataFrame) -> DataFrame:
    """(month, mbox): raw entries in order of date, each ending in a line break. A month is one row."""
    entry = F.struct(F.col("date_iso").isNull().alias("u"), F.coalesce("date_iso", F.lit("")).alias("d"), F.col("id").alias("i"), F.col("raw").cast("string").alias("r"))
    ended = lambda e: F.when(e["r"].endswith("\n"), e["r"]).otherwise(F.concat(e["r"], F.lit("\n")))
    return messages.where("raw is not null").groupBy("month").agg(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), ended), "").alias("mbox"))


def sitemap_parts(paths: DataFrame, path: str = "path", order: str = "pos", size: int = 45000) -> DataFrame:
    """(part, n): the URLs of each sitemap file."""
    return numbered_parts(paths, [order], size).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def url_entry(base: str, path: Column) -> Column:
    return F.concat(F.lit("<url><loc>"), html_escape(F.concat(F.lit(base + "/"), path)), F.lit("</loc></url>"))


def site_paths(months: DataFrame, threads: DataFrame, messages: DataFrame, tabs: tuple[str, ...] = ("", "threads.html", "archive.html", "stats.html")) -> DataFrame:
    """(kind, path): tabs, months, threads and messages."""
    spark = months.sparkSession
    fixed = spark.createDataFrame([(0, t) for t in tabs], "kind int, path string")
    parts = [(1, months, "month", "", ""), (2, threads, "tid", "thread/", ".html"), (3, messages, "mid", "msg/", ".html")]
    for kind, rows, column, head, tail in parts:
        fixed = fixed.unionByName(rows.select(F.lit(kind).alias("kind"), F.concat(F.lit(head), F.col(column), F.lit(tail if kind > 1 else ".html")).alias("path")))
    return fixed


def write_partitioned(rows: DataFrame, path: str, by: tuple[str, ...] = ("month", "source")) -> None:
    """Replace only the partitions that ``rows`` holds."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
