"""Streaming forms: gap sessions, deduplicated ingest, incremental upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import first_wins
from ..session import materialize


def gap_sessions(events: DataFrame, ts: str, key: str, gap: str, watermark: str) -> DataFrame:
    """(key, start, end, n): runs of events no more than ``gap`` apart; for streams and tables alike."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    rows = rows.withWatermark(ts, watermark) if events.isStreaming else rows
    return rows.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def deduplicated(messages: DataFrame, ts: str, key: str = "msgid", watermark: str = "30 days") -> DataFrame:
    """Each key once, late repeats within the watermark dropped; state stays bounded.

    Rows with a null key are told apart by all their columns' hash, so none is lost to
    another; only whole repeats of such a row within the watermark are dropped.
    """
    names = [c for c, kind in messages.dtypes if "map<" not in kind]
    ident = F.when(F.col(key).isNotNull(), F.concat(F.lit("k"), F.col(key).cast("string"))).otherwise(F.concat(F.lit("n"), F.xxhash64(*names).cast("string")))
    marked = messages.withColumn("_ident", ident).withWatermark(ts, watermark)
    return marked.dropDuplicatesWithinWatermark(["_ident"]).drop("_ident")


def ingest(messages: DataFrame, target: str, checkpoint: str, key: str = "msgid", by: tuple[str, ...] = ("month",), order: tuple[str, ...] = ()) -> StreamingQuery:
    """Append what the target lacks, batch by batch.

    Of a key's rows in one batch the first by ``order`` (then by all columns) stays;
    rows with a null key are all kept. Keys are looked up only in the partitions that
    the batch touches, so a key is to stay in its partition. A batch that is run again
    replaces its own files: each batch writes below its own number.
    """

    def upsert(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        names = [c for c, kind in batch.dtypes if "map<" not in kind and c != key]
        new = materialize(first_wins(batch, key, [*order, *(c for c in names if c not in order)]), "ingest-batch")
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(path):
            old = spark.read.parquet(target).where(F.coalesce(F.col("_batch") != epoch, F.lit(True)))
            parts = new.select(*by).distinct()
            old = old.join(parts, list(by), "left_semi").select(key).where(F.col(key).isNotNull()).distinct()
            new = new.join(old, key, "left_anti")
        new.select(batch.columns).write.mode("overwrite").partitionBy(*by).parquet(f"{target}/_batch={epoch}")

    return messages.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
