"""Operator 6 [native]: mixing sources to target weights by hash-threshold histograms.

Only DataFrame functions. Sizes are summed by source and hash bucket; the bucket in
which a source's budget ends is found by a running sum over its (at most 4096)
buckets, and only that bucket's rows are summed again, by finer buckets. Three
rounds place the threshold within 36 bits of the hash. Documents are then kept by
comparing hash and threshold: nothing is sorted by document, and a rerun agrees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

WORD_GAPS = r"[\x20\x09-\x0D]+"
_BITS, _ROUNDS = 12, 3


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    parts = F.split(text, WORD_GAPS)
    edges = (F.element_at(parts, 1) == "").cast("long") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("long")
    return F.coalesce(F.size(parts).cast("long") - edges, F.lit(0).cast("long"))


def order_hash(*cols: str) -> Column:
    """36 bits that order the documents; from the id and the text, so copies under other ids differ."""
    return F.shiftrightunsigned(F.xxhash64(*[F.col(c) for c in cols]), 64 - _BITS * _ROUNDS)


def source_targets(sizes: DataFrame, cap: float = 3.0) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share the sum
    of all sizes. A target stops at ``cap`` times its source's size; the excess is
    shared again by weight. In closed form: by rising cap/weight, the first source
    that is not above its cap fixes the level that all later ones share.
    The windows run over one row a source.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.select("source", "source_size", (1 + (F.row_number().over(by_name) - 1) % 3).cast("double").alias("weight"))
    ranked = ranked.withColumn("ceiling", F.col("source_size") * F.lit(float(cap)))
    by_ratio = everything.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    ranked = ranked.withColumn("level", level)
    fits = F.when(F.col("ceiling") >= F.col("level") * F.col("weight"), F.struct((F.col("ceiling") / F.col("weight")).alias("r"), F.col("level").alias("level")))
    final = F.min(fits).over(everything)["level"]
    share = F.coalesce(final, F.lit(float("inf"))) * F.col("weight")
    return ranked.withColumn("target", F.least(F.col("ceiling"), share)).select("source", "source_size", "target")


def plan_mix(slim: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, _size, _hash) rows and targets to (source, source_size, target, passes, threshold).

    A document is taken ``passes`` times, and once more if its hash is below
    ``threshold``. The cell in which the budget ends is taken if that comes nearer.
    """
    plan = targets.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("budget", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size")))
    plan = plan.withColumn("prefix", F.lit(0).cast("long")).withColumn("left", F.col("budget"))
    for step in range(1, _ROUNDS + 1):
        shift = _BITS * (_ROUNDS - step)
        cell = F.shiftright("_hash", shift)
        inside = slim.withColumn("_cell", cell)
        if step > 1:  # only the boundary bucket of each source is looked at again
            edge = plan.select(F.col("source").alias("_s"), "prefix")
            inside = inside.join(edge, inside.source.eqNullSafe(edge._s) & (F.shiftright("_cell", _BITS) == edge.prefix)).select("source", "_cell", "_size")
        cells = inside.groupBy("source", "_cell").agg(F.sum("_size").alias("_sum")).where("_sum > 0")
        running = F.sum("_sum").over(Window.partitionBy("source").orderBy("_cell"))
        cells = cells.withColumn("_upto", running).withColumnRenamed("source", "_s")
        joined = plan.join(cells, plan.source.eqNullSafe(cells._s) & (cells._upto > plan.left), "left")
        first = F.min(F.when(F.col("_cell").isNotNull(), F.struct("_cell", "_upto", "_sum"))).alias("_first")
        keys = ["source", "source_size", "target", "passes", "prefix", "left"]
        joined = joined.groupBy(*keys).agg(first)
        # Without a cell beyond the budget (only by rounding), all of the bucket is taken.
        none = F.col("_first").isNull()
        last = F.shiftleft(F.col("prefix") + 1, _BITS) - 1 if step > 1 else F.lit((1 << _BITS) - 1)
        plan = joined.select(
            "source", "source_size", "target", "passes",
            F.when(none, last).otherwise(F.col("_first._cell")).cast("long").alias("prefix"),
            F.when(none, F.col("left")).otherwise(F.col("left") - F.col("_first._upto") + F.col("_first._sum")).alias("left"),
            F.when(none, F.lit(0)).otherwise(F.col("_first._sum")).cast("long").alias("_edge"),
        )
        plan = materialize(plan, f"mix-plan{step}")
    nearer = (F.col("left") * 2 >= F.col("_edge")) & (F.col("left") > 0)
    return plan.select("source", "source_size", "target", "passes", (F.col("prefix") + nearer.cast("long")).alias("threshold"))


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, cap: float) -> tuple[DataFrame, DataFrame]:
    slim = materialize(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("_size"), order_hash(id_col, text_col).alias("_hash")), "mix-sizes")
    totals = slim.groupBy("source").agg(F.sum("_size").alias("source_size"))
    return slim, plan_mix(slim, source_targets(totals, cap))


def _taken(plan: DataFrame) -> Column:
    return F.col("passes") + (F.col("_hash") < F.col("threshold")).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cap: float = 3.0) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken (words, repeats counted).

    Null texts have size 0; a null source is a source of its own; rows equal in id
    and text share a hash and are taken alike. An empty table gives no rows; a very
    long text is counted whole and taken or left whole; other columns are not read.
    """
    slim, plan = _planned(docs, id_col, text_col, source_col, cap)
    p = plan.withColumnRenamed("source", "_s")
    return slim.join(p, slim.source.eqNullSafe(p._s)).select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", (_taken(plan) * F.col("_size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cap: float = 3.0) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``.

    Documents without a word add nothing to any source; they are taken by the same
    hash threshold as all others. Nulls are as in :func:`mix`; extra columns may have
    any names; an empty table gives no rows.
    """
    _, plan = _planned(docs, id_col, text_col, source_col, cap)
    p = plan.select(F.col("source").alias("_s"), "passes", "threshold")
    # Whole rows travel as one struct, so no column of docs can clash with the plan's.
    rows = docs.select(F.struct("*").alias("_doc"), F.col(source_col).alias("_source"), order_hash(id_col, text_col).alias("_hash")).join(p, F.col("_source").eqNullSafe(F.col("_s")))
    return rows.select("_doc", F.explode(F.array_repeat(F.lit(1), _taken(plan).cast("int")))).select("_doc.*")
