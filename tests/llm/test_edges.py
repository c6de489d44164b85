"""Hostile texts, clashing columns, rows that share an id, and measured recall."""

from __future__ import annotations

import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestrata.llm import ann, jaccard, mixing, pii, quality
from lodestrata.llm.bpe import Encoder


def test_hostile_texts_take_linear_time():
    start = time.time()
    assert pii.detect("0" * 5000 + ".1.2.3") == [(0, 1, 5006)]
    for text in (" " * 200_000 + "[", "[" + " " * 200_000, "a dot " * 50_000, "x at a dot " * 50_000, "one two " * 30_000, "+1(" * 50_000):
        pii.find(text)
    assert pii.find("jo" + " " * 100_000 + "at" + " " * 100_000 + "site dot org")[1] == [(0, 0, 200_016)]
    assert time.time() - start < 30
    assert pii.find("jo dot smith at site dot org x")[1] == [(0, 0, 28)] and pii.find("meet at the dot com") == ([], [])


def test_encoder_on_hostile_texts():
    enc = Encoder("byte_bpe_50k.json")
    for text in ("a" * 200_000, " " * 400_000, "x y " * 60_000 + "<|endoftext|>", "ab " * 50_000 + "  " + "\n" * 70_000 + " z"):
        assert enc.ids(text).tolist() == enc.slow(text)


def test_lists_hold_exactly_what_two_classes_share(spark):
    rng = random.Random(2)
    data = [(k, [rng.randrange(-50, 50) for _ in range(30)]) for k in range(40)] + [(7, [10**12, 5]), (100, [10**13])]
    df = spark.createDataFrame(data, "key long, sigs array<long>").repartition(3)
    holders = {}
    for k, sigs in data:
        for s in sigs:
            holders.setdefault(s, set()).add(k)
    got = [r.sig for r in jaccard._held_twice(df, per_flush=64).collect()]
    assert sorted(got) == sorted(s for s, ks in holders.items() if len(ks) > 1)


def test_scan_sees_whole_groups(spark, tmp_path):
    """Rows that a join has dealt by group must not be torn apart by the planner on their way to the scan."""
    spark.range(4000).selectExpr("id % 1000 as group", "false as two", "0L as block", "id as key").repartition(8).write.parquet(f"{tmp_path}/members")
    sketch = F.lit(jaccard.odd_sketch(np.arange(60, dtype=np.uint64)).tobytes())
    spark.range(4000).select(F.col("id").alias("key"), F.lit(60).cast("long").alias("n"), sketch.alias("sketch"), F.col("id").alias("comp")).write.parquet(f"{tmp_path}/labelled")
    members, labelled = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("members", "labelled"))
    found = jaccard._scan(jaccard._between(members, labelled), 80, 100, False)
    assert found.distinct().count() == 6000
    assert jaccard._scan(jaccard._between(members, labelled), 80, 100, True).count() == 3000


@pytest.mark.parametrize("stage", ["quality", "near", "personal", "mixing"])
def test_stages_take_any_extra_columns(spark, stage):
    text = "the old mill by the river and the people of the town number %d with some more words for every %d page"
    docs = spark.createDataFrame([(i, text % (i % 7, i % 7), "en", f"s{i % 2}", 1) for i in range(20)] + [(3, "another text altogether that shares an id with row three", "en", None, 1), (None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("predicted", "score", "_text", "passes", "threshold", "_hash", "_copy", "_doc", "_row", "row", "id", "best", "key"):
        docs = docs.withColumn(name, F.lit(1))
    docs = docs.withColumn("extra", F.create_map(F.lit("a"), F.lit(1)))
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    out = {
        "quality": lambda: quality.keep_good(docs, quality.fit(docs, labels)), "near": lambda: corpus_pipeline.keep_one_of_each_group(spark, docs, ""),
        "personal": lambda: pii.redact_documents(docs), "mixing": lambda: mixing.mixed_documents(docs),
    }[stage]()
    rows = out.collect()
    assert out.columns == docs.columns and rows
    if stage == "near":  # one row of each of the seven texts, the stranger under a known id, and the row without text
        assert sorted((r.doc_id, (r.text or "")[:7]) for r in rows if r.doc_id is not None) == sorted([*((i, "the old") for i in range(7)), (3, "another")]) and len(rows) == 9


def test_recall_over_embeddings(spark):
    path = Path("/root/testdata/sf0.1/embeddings.parquet")
    if not path.exists():
        pytest.skip("no test data")
    vectors = spark.read.parquet(str(path))
    got = {}
    for r in ann.nearest(vectors, every=8).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    table = vectors.toPandas()
    x, ids = np.stack(table["embedding"].to_numpy()), table["vec_id"].to_numpy()
    hits = 0
    for q, found in got.items():
        d = ((x - x[ids == q][0]) ** 2).sum(1)
        d[ids == q] = np.inf
        hits += len(found & set(ids[np.argsort(d, kind="stable")[:10]].tolist()))
    assert len(got) >= 200 and hits >= 0.9 * 10 * len(got)
