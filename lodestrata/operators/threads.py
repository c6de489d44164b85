"""Conversation threads: reply links, subject chains within a time window, stable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import stable_id, subject_key
from .graph import connected_components
from .incremental import numbered_parts


def chronological(date_col: str = "date_iso", id_col: str = "id") -> Column:
    """The order of display and of anchors: dated first, by date, then id, as one comparable value."""
    return F.struct(F.col(date_col).isNull().alias("undated"), F.coalesce(F.col(date_col), F.lit("")).alias("date"), F.col(id_col).alias("id"))


def reply_edges(messages: DataFrame) -> DataFrame:
    """(src, dst): a message and the one it answers; of a repeated msgid the largest id is meant."""
    known = messages.where("msgid is not null and msgid <> ''").groupBy(F.col("msgid").alias("_m")).agg(F.max("id").alias("dst"))
    return messages.where("in_reply_to is not null").join(known, F.col("in_reply_to") == F.col("_m")).select(F.col("id").alias("src"), "dst")


def gap_chains(rows: DataFrame, keys: list[str], when: str, gap: Column, order: list[str]) -> DataFrame:
    """``rows`` with ``chain``: the id of the first row of a run in which no step exceeds ``gap``.

    ``gap`` is a condition over ``when`` and ``_prev`` (its value in the row before)
    that is true where a new run begins. One window over ``keys``; no self-join.
    """
    w = Window.partitionBy(*keys).orderBy(when, *order)
    starts = rows.withColumn("_prev", F.lag(when).over(w)).withColumn("_new", F.col("_prev").isNull() | gap)
    return starts.withColumn("chain", F.last(F.when(F.col("_new"), F.struct(*order)), ignorenulls=True).over(w)[order[0]]).drop("_prev", "_new")


def subject_chains(messages: DataFrame, days: int = 90) -> DataFrame:
    """(id, chain) of dated messages with a subject that is long enough to link."""
    rows = messages.select("id", subject_key(F.col("subject")).alias("_key"), F.substring("date_iso", 1, 10).try_cast("date").alias("_day")).where("_key is not null and _day is not null")
    return gap_chains(rows, ["_key"], "_day", F.datediff("_day", "_prev") > days, ["id"]).select("id", "chain")


def thread_components(messages: DataFrame, days: int = 90) -> DataFrame:
    """(id, component): the smallest id of each message's thread; single messages included.

    Subject chains are contracted to their first message before the graph step, so
    only reply links and one edge a message remain.
    """
    edges = reply_edges(messages).unionByName(subject_chains(messages, days).where("id <> chain").select(F.col("id").alias("src"), F.col("chain").alias("dst")))
    found = connected_components(edges)
    return messages.select("id").join(found.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def thread_ids(messages: DataFrame, prior: DataFrame | None = None, days: int = 90, length: int = 12) -> DataFrame:
    """(msgid, tid) of messages with a msgid.

    A thread keeps the prior id of its anchor, else the most frequent prior id of
    its members (the first seen in id order among equals), else the anchor's hash.
    """
    rows = messages.join(thread_components(messages, days), "id")
    if prior is None:
        prior = messages.sparkSession.createDataFrame([], "msgid string, tid string")
    rows = rows.join(prior.select("msgid", F.col("tid").alias("_prior")), "msgid", "left")
    anchors = rows.groupBy("component").agg(F.min_by(F.struct("msgid", "_prior"), chronological()).alias("anchor"))
    votes = rows.where("_prior is not null").groupBy("component", "_prior").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    dominant = votes.groupBy("component").agg(F.max_by("_prior", F.struct("n", -F.col("first"))).alias("dominant"))
    named = anchors.join(dominant, "component", "left").select("component", F.coalesce("anchor._prior", "dominant", stable_id(F.col("anchor.msgid"), length)).alias("tid"))
    return rows.where("msgid is not null and msgid <> ''").join(named, "component").select("msgid", "tid").distinct()


def thread_list(messages: DataFrame, days: int = 90) -> DataFrame:
    """component, tid, messages, head_id, first_date, last_date; one row a thread."""
    rows = messages.join(thread_components(messages, days), "id")
    threads = rows.groupBy("component").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min_by(F.struct("id", "msgid"), chronological()).alias("_head"),
        F.min("date_iso").alias("first_date"),
        F.max("date_iso").alias("last_date"),
    )
    ident = F.when(F.coalesce("_head.msgid", F.lit("")) != "", stable_id(F.col("_head.msgid"))).otherwise(F.concat(F.lit("x"), F.col("_head.id").cast("string")))
    return threads.select("component", ident.alias("tid"), "messages", F.col("_head.id").alias("head_id"), "first_date", "last_date")


def thread_pages(threads: DataFrame, page: int = 50) -> DataFrame:
    """Rows of :func:`thread_list` with ``part``, the page that shows them: newest first, undated last, then by component."""
    return numbered_parts(threads, [F.desc_nulls_last("last_date"), F.col("component")], page)
