"""The full-text index: bodies without repeated passages, and all-terms search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse, dequote, message_name, short_date, snippets, stable_id, strip_footer, strip_scrub_notes
from .shingles import first_occurrence_dedup
from .threads import chronological


def flat_words(body: Column, list_names: tuple[str, ...] = ("list",)) -> Column:
    """Words of a body without footers, notes and quote marks."""
    lines = F.split(F.regexp_replace(F.coalesce(body, F.lit("")), "\r\n?", "\n"), "\n", -1)
    text = strip_footer(strip_scrub_notes(F.array_join(lines, "\n")), list_names)
    flat = collapse(F.array_join(F.transform(F.split(text, "\n", -1), dequote), " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def build_index(messages: DataFrame, threads: DataFrame, attachments: DataFrame | None = None, author: Column | None = None, list_names: tuple[str, ...] = ("list",)) -> DataFrame:
    """id, mid, subject, author, sent, att_count, thread, tid, body (its first occurrences only).

    ``threads``: (id, component). Messages are in order of date, undated last, then id.
    """
    rows = messages.join(threads, "id")
    if attachments is not None:
        rows = rows.join(attachments.groupBy("msgid").agg(F.count(F.lit(1)).alias("_att")), "msgid", "left")
    else:
        rows = rows.withColumn("_att", F.lit(0).cast("long"))
    anchors = rows.groupBy("component").agg(F.min_by(F.struct("msgid", "id"), chronological()).alias("_a"))
    named = F.when(F.coalesce("_a.msgid", F.lit("")) != "", stable_id(F.col("_a.msgid"))).otherwise(F.concat(F.lit("x"), F.col("_a.id").cast("string")))
    rows = rows.join(anchors.select("component", named.alias("tid")), "component")
    keyed = rows.select(F.col("date_iso").isNull().alias("undated"), F.coalesce("date_iso", F.lit("")).alias("date"), "id", flat_words(F.col("body"), list_names).alias("_words"))
    bodies = first_occurrence_dedup(keyed, F.col("_words"), ["undated", "date", "id"]).select("id", F.col("kept").alias("body"))
    facts = rows.select("id", message_name(F.col("msgid"), F.col("id")).alias("mid"), F.coalesce("subject", F.lit("")).alias("subject"), (F.col("from_name") if author is None else author).alias("author"), short_date(F.col("date_iso"), F.lit("")).alias("sent"), F.coalesce("_att", F.lit(0)).alias("att_count"), F.col("component").alias("thread"), "tid")
    return facts.join(bodies, "id")


def search(index: DataFrame, query: str, with_attachments: bool = False, limit: int = 300) -> DataFrame:
    """Hits of all terms of ``query`` in subject, author or body; newest first, at most ``limit``."""
    terms = query.lower().split()
    hay = F.lower(F.concat_ws(" ", "subject", "author", "body"))
    hits = index
    for t in terms:
        hits = hits.where(F.contains(hay, F.lit(t)))
    if with_attachments:
        hits = hits.where("att_count > 0")
    best = hits.orderBy(F.desc("sent"), F.desc("id")).limit(limit)
    rank = F.row_number().over(Window.orderBy(F.desc("sent"), F.desc("id"))).cast("long")  # over the limited rows only
    return best.withColumn("rank", rank).withColumn("snippets", snippets(F.col("body"), F.array(*[F.lit(t) for t in terms]) if terms else F.array().cast("array<string>")))
