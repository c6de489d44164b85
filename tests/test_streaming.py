"""Ingest keeps null keys and one row a key; partition refresh has a defined survivor; the shared folder fails closed."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from lodestrata import session
from lodestrata.operators import incremental
from lodestrata.streaming import sessions

SCHEMA = "msgid string, month string, n int"


def test_ingest_keeps_null_keys_and_first_of_each_key(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    read = lambda: sorted(((r.msgid or "", r.month, r.n) for r in spark.read.parquet(target).collect()))
    run = lambda: sessions.ingest(spark.readStream.schema(SCHEMA).parquet(source), target, str(tmp_path / "ck"), order=("n",)).awaitTermination()
    spark.createDataFrame([(None, "m1", 1), (None, "m1", 1), (None, "m1", 2), ("a", "m1", 5), ("a", "m1", 3)], SCHEMA).coalesce(1).write.parquet(source)
    run()
    assert read() == [("", "m1", 1), ("", "m1", 1), ("", "m1", 2), ("a", "m1", 3)]
    spark.createDataFrame([("a", "m1", 1), ("b", "m2", 1), (None, "m1", 1)], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    run()
    assert read() == [("", "m1", 1), ("", "m1", 1), ("", "m1", 1), ("", "m1", 2), ("a", "m1", 3), ("b", "m2", 1)]


def test_refresh_keeps_the_first_of_a_repeated_id(spark):
    schema = "msgid string, month string, source string, n int"
    target = spark.createDataFrame([("x", "m", "list", 0), ("y", "m", "other", 0)], schema)
    new = spark.createDataFrame([("z", "m", "list", 2), ("z", "m", "list", 1), ("y", "m", "list", 9)], schema)
    got = sorted((r.msgid, r.n) for r in incremental.refresh_partition(target, new, "m", order=("n",)).collect())
    assert got == [("y", 0), ("z", 1)]


def test_shared_folder_is_not_chosen_on_a_cluster():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        session.shared_dir(SimpleNamespace(conf={}, sparkContext=context))
