"""Operators 4, 5, 6, 7, 9 and the pipeline against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodestrata.llm import ann, jaccard, mixing, packing, substring
from lodestrata.llm.bpe import Encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return [tuple(r) for r in df.collect()]


def corpus(seed=1, n=60):
    """Copies, near copies, shared passages, short and empty texts."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    docs = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 9, 14, 19, 24, 40, 120, 300]))]
        if docs and rng.random() < 0.5:
            words = docs[rng.randrange(len(docs))][1].split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.25:
            at = rng.randrange(len(words) + 1)
            words = words[:at] + passage[: rng.choice([49, 50, 60, 70])] + words[at:]
        docs.append((i * 3 + 1, " ".join(words)))
    docs += [(900, None), (901, ""), (902, " \n "), (5, "Solo Words"), (5, "Solo Words"), (903, "SOLO words"), (904, "x " * 400)]
    rng.shuffle(docs)
    return docs


def components(docs, num=90, den=100):
    sets = []
    for _, t in docs:
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set()))
    root = list(range(len(docs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    names = {}
    for i, (d, _) in enumerate(docs):
        names[find(i)] = min(names.get(find(i), d), d)
    return Counter((d, len(sets[i]), names[find(i)]) for i, (d, _) in enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame([(i, t, "k") for i, t in docs], "doc_id long, text string, key string").repartition(3)
    assert Counter(rows(jaccard.jaccard_components(df))) == components(docs)


def test_jaccard_empty_and_keep_one(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert rows(jaccard.jaccard_components(df)) == []
    a = "one two three four five six seven eight nine ten eleven twelve"
    data = [(3, a, "x"), (1, a + " ", "y"), (1, a + " ", "y"), (7, None, "z"), (8, "", None), (9, a.upper(), None)]
    kept = rows(jaccard.keep_one(spark.createDataFrame(data, df.schema)))
    assert Counter(kept) == Counter([(1, a + " ", "y"), (7, None, "z"), (8, "", None)])


def jobs_of(spark, group, act):
    """The jobs that ``act`` runs and what it returns."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = act()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return spark.sparkContext.statusTracker().getJobIdsForGroup(group), out


def test_jaccard_small_graphs_take_few_jobs(spark):
    """Each job leaves plans and code with the driver; rounds for six small graphs were most of them."""
    docs = corpus(3)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    jobs, got = jobs_of(spark, "few-jobs", lambda: rows(jaccard.jaccard_components(df)))
    assert Counter(got) == components(docs)
    assert len(jobs) < 160


def test_jaccard_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_AT_ONCE", 2)
    docs = corpus(4, 30)
    assert Counter(rows(jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")))) == components(docs)


def test_jaccard_blocks_grow_slower_than_lists(spark, monkeypatch):
    counts, write = {}, jaccard.materialize

    def counting(df, name):
        out = write(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "materialize", counting)
    words = ["v%d" % i for i in range(120)]
    docs = [(i, " ".join([*words[: i % 120], "u%d" % i, *words[i % 120 + 1 :]])) for i in range(800)]
    got = rows(jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")))
    assert len(got) == 800 and {r[2] for r in got} == {0}
    assert counts["jaccard-members"] <= 2 * counts["jaccard-held"]


@pytest.mark.parametrize("forest", [True, False])
def test_jaccard_scan_thins_what_it_holds(spark, monkeypatch, forest):
    rng = random.Random(9)
    data = [(7, False, 0, k, k, 40, np.packbits(np.arange(128) % 40 == rng.randrange(40)).tobytes()) for k in range(60)]
    members = spark.createDataFrame(data, "group long, two boolean, block long, key long, comp long, n long, sketch binary")
    found = []
    for held in (1 << 18, 50):
        monkeypatch.setattr(jaccard, "_WAITING", held)
        found.append(Counter(rows(jaccard._scan(members, 80, 100, forest))))
    assert found[0] == found[1] and found[0].total() == (59 if forest else 60 * 59 // 2)


def test_keep_one_leaves_kept_texts_where_they_are(spark):
    rng = random.Random(5)
    docs = [(i, " ".join("%x" % rng.getrandbits(60) for _ in range(150))) for i in range(300)]
    docs += [(1000 + i, docs[i][1]) for i in range(5)]
    size = sum(len(t) for _, t in docs)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard.keep_one(spark.createDataFrame(docs, "doc_id long, text string"))
        jobs, got = jobs_of(spark, "kept-texts", lambda: sorted(r.doc_id for r in kept.select("doc_id", "text").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == list(range(300))
    info, store = spark.sparkContext.statusTracker().getJobInfo, spark.sparkContext._jsc.sc().statusStore()
    stages = {s for j in jobs for s in info(j).stageIds}
    assert sum(store.lastStageAttempt(s).shuffleWriteBytes() for s in stages) < size / 3


@pytest.mark.parametrize("num", [80, 90])
def test_signatures_lose_no_link(num):
    rng = np.random.default_rng(num)
    rule = jaccard.sizes(num, 100)
    for n in [*range(1, 45), 60, 90, 150, 400]:
        for _ in range(12):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            b = rng.permutation(a)[: max(1, n - int(rng.integers(0, n // 8 + 2)))]
            b = np.concatenate((b, rng.integers(0, 1 << 63, int(rng.integers(0, n // 8 + 2)), dtype=np.uint64)))
            a, b = np.unique(a), np.unique(b)
            common = len(np.intersect1d(a, b))
            union = len(a) + len(b) - common
            if union > common and 100 * common >= num * union:
                assert union - common <= rule.slack(len(a) + len(b))
                assert len(np.intersect1d(jaccard.signatures(a, num, 100), jaccard.signatures(b, num, 100)))
                w = min(len(jaccard.odd_sketch(a)), len(jaccard.odd_sketch(b)))
                x, y = (jaccard._folded(jaccard.odd_sketch(s).tobytes(), w) for s in (a, b))
                assert np.bitwise_count(x ^ y).sum() <= union - common


def test_large_family_in_blocks(spark):
    """More members than a block: chains of near copies must come out as one component."""
    rng = random.Random(8)
    words = ["v%d" % i for i in range(120)]
    docs = []
    for i in range(700):
        docs.append((i, " ".join(words)))
        if i % 3 == 2:
            words[rng.randrange(120)] = "u%d" % i
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r[0]: r[2] for r in rows(jaccard.jaccard_components(df))}
    assert set(got.values()) == {0}


def brute_repeats(docs, window):
    first = {}
    words = [(math.inf if i is None else i, WORD.findall(t or "")) for i, t in docs]
    for i, w in words:
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, i), i)
    out = Counter()
    for (i, w), (raw, _) in zip(words, docs, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        out[raw, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("seed", [1, 3])
def test_repeated_windows(spark, seed):
    docs = [*corpus(seed), (None, "y " * 200), (950, "y " * 120), (None, "y " * 200)]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, n_words int").repartition(3)
    assert Counter(rows(substring.remove_repeats(df))) == brute_repeats(docs, 50)
    assert rows(substring.remove_repeats(df.limit(0))) == []


def test_mix_meets_targets(spark):
    rng = random.Random(6)
    docs = [(i, "w " * rng.randint(1, 30), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(900)] + [(901, None, "a"), (902, "", "d"), (3, "w w", "a"), (3, "w w", "a")]
    df = spark.createDataFrame([(*d, "t") for d in docs], "doc_id long, text string, source string, target string")
    got = rows(mixing.mix(df))
    assert Counter((r[0], r[1]) for r in got) == Counter((i, len(WORD.findall(t or ""))) for i, t, _ in docs)
    size = defaultdict(int)
    for _, t, s in docs:
        size[s] += len(WORD.findall(t or ""))
    names = sorted(s for s in size if s is not None) + [None]
    weight, total, capped = {s: 1 + i % 3 for i, s in enumerate(names)}, sum(size.values()), {}
    while over := [s for s in names if s not in capped and (total - sum(capped.values())) * weight[s] / sum(weight[x] for x in names if x not in capped) > 3 * size[s]]:
        capped |= {s: 3 * size[s] for s in over}
    left, share = total - sum(capped.values()), sum(weight[x] for x in names if x not in capped)
    want = {s: capped[s] if s in capped else left * weight[s] / share for s in names}
    source_of = {i: s for i, _, s in docs}
    taken, target = defaultdict(int), {}
    for i, n, _, t, k in got:
        assert 0 <= k <= 3 * n
        taken[source_of[i]] += k
        target[source_of[i]] = t
    for s in names:
        assert abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - want[s]) <= 30
    assert sorted(got, key=str) == sorted(rows(mixing.mix(df.repartition(5))), key=str)
    mixed = Counter(r[0] for r in rows(mixing.mixed_documents(df)))
    per_row = Counter()
    for i, n, _, _, k in got:
        per_row[i] += k // n if n else 0
    assert all(mixed[i] == k for i, k in per_row.items() if k and i not in (901, 902))
    assert rows(mixing.mix(df.limit(0))) == []


def test_packing_is_gapless_and_whole(spark):
    rng = random.Random(7)
    docs = [(i, " ".join(rng.choice(["stone", "river", "cloud", "sand"]) for _ in range(rng.randint(0, 900)))) for i in range(80)] + [(80, None), (81, ""), (82, "long " * 9000), (None, "lone")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, length int").repartition(3)
    got, enc = rows(packing.pack(df)), Encoder("byte_bpe_50k.json")
    pieces, sequences = defaultdict(list), defaultdict(list)
    for i, start, length, crc, total, seq, off in got:
        pieces[i].append((start, length, crc, total))
        sequences[seq].append((off, length))
    for i, t in docs:
        ids, at = np.array([*(enc.slow(t) if t else []), 1], "<u4"), 0
        for start, length, crc, total in sorted(pieces[i]):
            assert start == at and total == len(ids) and crc == zlib.crc32(ids[at : at + length].tobytes())
            at += length
        assert at == len(ids)
    lengths = []
    for parts in sequences.values():
        at = 0
        for off, length in sorted(parts):
            assert off == at
            at += length
        lengths.append(at)
    assert max(lengths) <= 2048 and sum(n < 2048 for n in lengths) <= 2
    twice = rows(packing.pack(spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")))
    assert [r[0] for r in twice] == [1, 1] and rows(packing.pack(df.limit(0))) == []


def test_packing_prefers_lexical_neighbours():
    a, b = np.arange(100, 700, dtype=np.uint32), np.arange(5000, 5600, dtype=np.uint32)
    docs = [a, b, a.copy(), b.copy(), a.copy(), b.copy()]
    first = [p[0] for p in packing.pack_shard(docs, 1800) if p[3] == 0]
    assert sorted(first) == [0, 2, 4]


def test_packing_keeps_a_family_of_short_texts_together():
    """More neighbours than any shortlist, and one that shares only the seed's least telling term."""
    rng = np.random.default_rng(4)
    family = lambda k: np.concatenate((np.arange(1000 * k, 1000 * k + 20), rng.integers(10**5, 10**6, 5))).astype(np.uint32)
    docs = [family(1 + i % 3) for i in range(120)]
    sequence = defaultdict(set)
    for d, _, _, seq, _ in packing.pack_shard(docs, 40 * 25):
        sequence[seq].add(d % 3)
    assert all(len(kinds) == 1 for kinds in sequence.values()) and len(sequence) == 3
    common = np.array([7], np.uint32)
    seed = np.concatenate((common, np.repeat(np.arange(100, 160, dtype=np.uint32), 3)))
    docs = [seed, *(np.arange(200 + 9 * i, 209 + 9 * i, dtype=np.uint32) for i in range(30)), np.concatenate((common, np.arange(900, 920, dtype=np.uint32))), np.arange(100, 160, dtype=np.uint32)]
    index = packing.LexicalIndex(docs)
    assert index.take_first() == 0
    given = index.neighbours(0)
    assert [next(given), next(given), next(given)] == [32, 31, 1]


def test_packing_brings_copies_together_across_shards(spark):
    """Families of equal texts, far more shards than a family fills: members meet whatever their ids."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(4000)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(120)) for _ in range(60)]
    docs = [(rng.randrange(10**9), texts[i % 60]) for i in range(360)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    size = sum(len(t) + 64 for _, t in docs)
    got, text = rows(packing.pack(df, window=1024, shard_bytes=size // 12)), dict(docs)
    where, shards = defaultdict(set), defaultdict(set)
    for i, *_, seq, _ in got:
        where[text[i]].add(seq >> 32)
        shards[seq >> 32].add(i)
    assert len(shards) >= 8 and max(map(len, shards.values())) <= 120
    assert sum(map(len, where.values())) <= 60 + 12
    assert Counter(got) == Counter(rows(packing.pack(df.repartition(5), window=1024, shard_bytes=size // 12)))
    encoded = packing.encode(df, "doc_id", "text", "byte_bpe_50k.json", 1)
    corpus, enc = packing.corpus_of(encoded), Encoder("byte_bpe_50k.json")
    ids = [[*enc.slow(t), 1] for _, t in docs]
    assert corpus.n == 360 and abs(corpus.mean - sum(map(len, ids)) / 360) < 1e-9
    df_of = Counter(t for d in ids for t in set(d))
    assert {int(t): int(corpus.df[t]) for t in np.flatnonzero(corpus.df)} == df_of


def brute_nearest(data, every, k):
    ok = {i: np.array(v) for i, v in data if i is not None and v is not None and None not in v and len(v) == 16 and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in ok:
        if q % every == 0:
            best = sorted((float(np.sqrt(((ok[q] - v) ** 2).sum())), i) for i, v in ok.items() if i != q)[:k]
            out[q] = best
    return out


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    data = [(i, (centres[i % 12] + 0.4 * rng.normal(size=16)).tolist()) for i in range(1500)]
    same = data[40][1]
    data += [(2000 + i, same) for i in range(60)]
    data += [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [1.0] * 3), (5004, [None] + [1.0] * 15), (None, [1.0] * 16), (5100, [1e200] * 16)]
    df = spark.createDataFrame([(*d, 1) for d in data], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = defaultdict(list)
    for q, r, v, s in rows(ann.nearest(df, every=20)):
        got[q].append((r, v, s))
    with np.errstate(over="ignore"):
        want = brute_nearest(data, 20, 10)
    assert set(got) == set(want)
    hits = 0
    for q, best in want.items():
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, 11))
        hits += len({v for _, v, _ in found} & {i for _, i in best})
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
    assert hits >= 0.9 * 10 * len(want)
    assert [v for _, v, _ in sorted(got[40])] == [i for _, i in want[40]]


def test_nearest_with_few_candidates(spark):
    df = spark.createDataFrame([(100, [1.0, 0.0]), (7, [0.0, -1.0]), (8, [-1.0, 0.0]), (7, [0.0, -1.0])], "vec_id long, embedding array<float>")
    assert rows(ann.nearest(df).orderBy("rank")) == [(100, 1, 7, math.sqrt(2)), (100, 2, 8, 2.0)]
    assert rows(ann.nearest(df.limit(0))) == [] and rows(ann.nearest(df.where("vec_id = 100"))) == []
