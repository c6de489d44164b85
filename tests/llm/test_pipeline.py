"""The pipeline: stage columns, decisions that take effect, and run() against its stages one by one."""

from __future__ import annotations

import random
from collections import Counter

import pytest

import corpus_pipeline
from lodestrata.llm import jaccard, mixing, pii, quality

GOOD = "The river ran past the old mill and the people of the town came down to watch it every evening in the summer number %d of many."
BAD = "BUY!! NOW!! CHEAP!! STUFF!! HERE!! NUMBER!! %d!! BUY!! NOW!! CHEAP!!"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sf")
    docs, labels = [], []
    for i in range(120):
        bad = i % 6 == 5
        text = (BAD if bad else GOOD + " Word%d goes on with line%d and page%d too." % (i, i, i)) % i
        if i % 10 == 0:
            text += f" Write to jo{i}@site.org or 10.0.0.{i}."
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(not bad), 0))
    docs += [(200, docs[1][1], "en", "s1", docs[1][4]), (201, docs[1][1].upper(), "en", None, docs[1][4]), (202, None, None, "s2", None), (203, "", "en", "s2", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_stages_and_run(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = (docs, after)
        if k < 4:
            assert after.columns == columns
        docs = after
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    before, after = seen["quality"]
    kept = ids(after)
    assert all(i in kept for i in range(120) if i % 6 != 5) and sum(i in kept for i in range(120) if i % 6 == 5) <= 2
    model = quality.fit(before, spark.read.parquet(f"{sf}/labels.parquet"))
    assert kept == ids(quality.score_documents(before, model).where("predicted = 1"))
    before, after = seen["near_duplicates"]
    assert ids(after) == Counter({r.component_id: 1 for r in jaccard.jaccard_components(before).collect()})
    assert 1 in ids(after) and 200 not in ids(after) and 201 not in ids(after)
    before, after = seen["personal_data"]
    text = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.text == (None if text[r.doc_id] is None else pii.redact(text[r.doc_id])) and (r.text is None or r.n_chars == len(r.text))
        assert r.text is None or "@site.org" not in r.text
    before, after = seen["mixing"]
    per = {r.doc_id: r.taken // r["size"] for r in mixing.mix(before).collect() if r["size"]}
    assert {i: n for i, n in ids(after).items() if i in per} == {i: n for i, n in per.items() if n}
    before, after = seen["packing"]
    assert {r.doc_id for r in after.collect()} == set(ids(before))
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, sf).select("doc_id", "start", "length", "ids_crc32").collect()) == Counter(tuple(r) for r in after.select("doc_id", "start", "length", "ids_crc32").collect())


def test_empty_table(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0
        docs = docs if "text" in docs.columns else spark.read.parquet(f"{sf}/documents.parquet").limit(0)


def test_near_copies_of_five_word_shingles_go(spark):
    """Brute force at 0.8 of five-word shingles, with copies that 0.9 of three-word shingles misses."""
    rng = random.Random(5)
    docs = []
    for i in range(0, 60, 3):
        words = ["w%d" % rng.randrange(10**6) for _ in range(rng.choice([30, 100, 100, 240]))]
        docs.append((i, words))
        for k in (1, 2):
            other = list(words)
            for c in range(rng.choice([1, 2, 2, 3, 5])):
                other[(7 + 23 * c) % len(other)] = "x%d" % rng.randrange(10**6)
            docs.append((i + k, other))
    docs.append((100, docs[3][1][:20] + ["y1"] + docs[3][1][21:]))
    hundred = ["h%d" % i for i in range(100)]
    docs += [(200, hundred), (201, [f"n{i}" if i in (30, 60) else w for i, w in enumerate(hundred)])]
    sets = {i: {tuple(w[a : a + 5]) for a in range(len(w) - 4)} for i, w in docs}
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    df = spark.createDataFrame([(i, " ".join(w), "en", "s", 1) for i, w in docs], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, df, "").collect())
    assert kept == sorted(i for i in root if find(i) == i)
    assert 201 not in kept and 201 in {r.doc_id for r in jaccard.keep_one(df).collect()}
