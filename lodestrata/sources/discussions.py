"""Forum discussions as message rows, by exploding the tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import sanitize_html
from ..functions.text import MONTHS
from ..schema import DISCUSSION


def read_discussions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DISCUSSION).json(path, multiLine=True)


def flatten_discussions(discussions: DataFrame) -> DataFrame:
    """Root, comments and replies; a reply's parent is what it answers, else what it stands under."""
    names = F.create_map(*[x for i, m in enumerate(MONTHS) for x in (F.lit(f"{i + 1:02d}"), F.lit(m))])

    def row(node: Column, subject: Column, parent: Column) -> list[Column]:
        login = F.coalesce(F.when(node["author"]["login"] != "", node["author"]["login"]), F.lit("ghost"))
        created = F.coalesce(node["createdAt"], F.lit(""))
        label = F.concat(F.substring(created, 1, 4), F.lit("-"), F.coalesce(F.try_element_at(names, F.substring(created, 6, 2)), F.lit("unknown")))
        return [
            F.when(F.length(created) >= 7, label).otherwise("unknown").alias("month"), node["id"].alias("msgid"), parent.alias("in_reply_to"), subject.alias("subject"),
            login.alias("from_name"), F.concat(login, F.lit("@users.noreply.github.com")).alias("from_email"), F.when(created != "", created).alias("date_iso"), created.alias("date_raw"),
            F.coalesce(node["body"], F.lit("")).alias("body"), F.lit("github").alias("source"), node["bodyHTML"].alias("_html"),
        ]

    d = discussions.withColumn("title", F.coalesce("title", F.lit("")))
    answer = F.concat(F.lit("Re: "), F.col("title"))
    roots = d.select(*row(F.struct("id", "createdAt", "body", "bodyHTML", "author"), F.col("title"), F.lit(None).cast("string")))
    comments = d.select("id", "title", F.explode("comments.nodes").alias("c"))
    first = comments.select(*row(F.col("c"), answer, F.coalesce("c.replyTo.id", "id")))
    second = comments.select("title", "c", F.explode("c.replies.nodes").alias("r")).select(*row(F.col("r"), answer, F.coalesce("r.replyTo.id", "c.id")))
    out = roots.unionByName(first).unionByName(second)
    clean = sanitize_html(F.col("_html"))
    return out.withColumn("body_html", F.when(F.coalesce("_html", F.lit("")) != "", clean)).withColumn("body_html", F.when(F.col("body_html") != "", F.col("body_html"))).withColumn("raw", F.lit(None).cast("binary")).drop("_html")
