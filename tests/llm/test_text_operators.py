"""Operators 1, 2, 3, 8, 10 against plain Python, with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from lodestrata.llm import fingerprints, licenses, pii, quality, token_counts
from lodestrata.llm.bpe import Encoder
from lodestrata.llm.words import hash_words

#: Nulls in every column, empty texts, repeats, a very long text, extra columns with clashing names.
ODD = [
    (1, "Alpha beta gamma delta epsilon zeta", "src", "x"), (2, None, None, None), (3, "", "src", "x"), (4, "Alpha beta gamma delta epsilon zeta", "src", None),
    (4, "Alpha beta gamma delta epsilon zeta", "src", None), (None, "lone words here", "b", "y"), (7, "word " * 60000, "src", "x"), (8, "été naïve 数据\x0bend", "c", "z"),
    (9, " \n\t ", "c", "z"),
]
SCHEMA = "doc_id long, text string, source string, _text string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_word_hashes_tell_words_apart():
    random.seed(3)
    texts = ["".join(random.choice("ab \n\t\x0bé") for _ in range(random.randint(0, 40))) for _ in range(300)] + ["x" * 5000 + " y"]
    hashes, at = hash_words([t.encode() for t in texts])
    seen: dict[bytes, int] = {}
    for t, a, b in zip(texts, at, at[1:], strict=False):
        words = t.encode().split()
        assert len(words) == b - a
        for w, h in zip(words, hashes[a:b].tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_encoder_agrees_with_the_library():
    enc = Encoder("byte_bpe_50k.json")
    assert enc.fast is not None
    random.seed(5)
    for _ in range(3000):
        t = "".join(random.choice("ab1'! \n\té数") for _ in range(random.randint(0, 16)))
        assert enc.ids(t).tolist() == enc.slow(t)
        assert enc.count(t) == len(enc.slow(t))
    assert enc.count("a <|endoftext|> b") == len(enc.slow("a <|endoftext|> b"))


def test_token_counts(spark, odd):
    enc = Encoder("byte_bpe_50k.json")
    got = Counter(rows(token_counts.token_counts(odd)))
    want = Counter((i, len((t or "").encode()), len(enc.slow(t or "")), len(enc.slow(t or "")) > 1024) for i, t, *_ in ODD)
    assert got == want
    assert rows(token_counts.token_counts(odd.limit(0))) == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_count(spark, name):
    df = spark.createDataFrame([(1, "Some plain words."), (2, None)], "doc_id long, text string")
    got = dict((r[0], r[2]) for r in rows(token_counts.token_counts(df, tokenizer=name)))
    assert got[1] == len(Encoder(name).slow("Some plain words.")) and got[2] == 0


def _bag(text):
    w = text.split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def test_fingerprints_estimate_generalised_jaccard():
    rng = random.Random(1)
    base = [rng.choice("abcdefgh") for _ in range(60)]
    for cut in (5, 20, 40):
        other = base[:cut] + [rng.choice("qrstuv") for _ in range(60 - cut)] + base[:cut]
        a, b = _bag(" ".join(base)), _bag(" ".join(other))
        want = sum((a & b).values()) / sum((a | b).values())
        x, y = fingerprints.fingerprints([" ".join(base).encode(), " ".join(other).encode()], 1024, 5)
        assert abs(fingerprints.likeness(x, y) - want) < 0.06


def test_weights_count():
    terms = np.array([11, 22, 33], np.uint64)
    heavy = np.concatenate([np.repeat(terms[:1], 6), terms[1:]])
    x, y = fingerprints.sample(terms, 4096), fingerprints.sample(heavy, 4096)
    assert abs(fingerprints.likeness(x, y) - 3 / 8) < 0.04


def test_edited_pairs(spark, odd):
    got = rows(fingerprints.edited_pairs(odd.repartition(3)))
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    texts = [r[1] or "" for r in order]
    want = [(r[0], len(t), hashlib.sha256(fingerprints.edit(t, n).encode()).hexdigest()) for r, t, n in zip(order, texts, texts[1:] + texts[:1], strict=True)]
    assert Counter(g[:3] for g in got) == Counter(want)
    same = {g[3] for g in got if g[0] in (1, 4)}
    assert len(same) == 1 and all(0 <= g[5] <= 1 and 0 <= g[6] <= 1 for g in got)
    assert rows(fingerprints.edited_pairs(odd.limit(0))) == []
    single = rows(fingerprints.edited_pairs(odd.where("doc_id = 1")))
    assert len(single) == 1 and single[0][6] == 1.0


def _base_spans(x):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    out = []
    for k, p in enumerate(patterns):
        for m in re.finditer(p, x):
            d = re.sub("[^0-9]", "", m[0])
            total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
            if [True, k == 1 and all(int(q) <= 255 for q in m[0].split(".")), 12 <= len(d) <= 19 and total % 10 == 0, 9 <= len(d) <= 15][k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    random.seed(2)
    for _ in range(8000):
        x = "".join(random.choice("+0123456789 .-@a(b%") for _ in range(random.randint(0, 40)))
        assert pii.detect(x) == _base_spans(x)
    pii.detect("1" * 200000 + " " + "a." * 100000)  # linear


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("mail jo [at] site [dot] org now", "email", "jo [at] site [dot] org"),
        ("jo dot smith at example dot com!", "email", "jo dot smith at example dot com"),
        ("plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
        ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("ｊｏ＠ｓｉｔｅ．ｏｒｇ", "email", "ｊｏ＠ｓｉｔｅ．ｏｒｇ"),
        ("192[.]168[.]0[.]1", "ip", "192[.]168[.]0[.]1"),
        ("four " + "one " * 14 + "one", "card", "four " + "one " * 14 + "one"),
    ],
)
def test_disguises_are_mapped_back(text, kind, span):
    base, added = pii.find(text)
    assert (kind, span) in [(pii.KINDS[k], text[a:b]) for a, k, b in added]
    assert all(s in base for s in pii.detect(text))


def test_plain_prose_is_left_alone():
    for text in ("we met at the dot net shop", "two or three people, four at most", "look at this", "a (at) b"):
        assert pii.find(text) == ([], []) and pii.redact(text) == text


def test_find_and_redact_over_a_table(spark, odd):
    df = spark.createDataFrame([(1, "a@b.co and 10.0.0.1", "s", 19, 5), (2, None, None, None, 6), (2, "", "s", 0, 6)], "doc_id long, text string, lang string, n_chars long, spans int")
    got = {(r[0], r[1], r[2], r[6]) for r in rows(pii.find_pii(df))}
    assert got == {(1, 1, 1, "email:0:6,ip:11:19"), (2, 0, 0, "")}
    red = rows(pii.redact_documents(df))
    assert (1, "[EMAIL] and [IP]", "s", 16, 5) in red and (2, None, None, None, 6) in red
    assert len(rows(pii.find_pii(odd))) == len(ODD) and rows(pii.find_pii(odd.limit(0))) == []


def test_licences_against_brute_force(spark, odd):
    texts = ["MIT License. And the mit\nLICENSE, cc-by CC BY", "gnu general public license", "apache licensed", None, "", "license mit", "mit " * 30000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: r for r in rows(licenses.scan_licenses(df))}
    for i, t in enumerate(texts):
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = sorted((k, label) for p, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split())
        assert got[i][1:6] == (len(words), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at})))
    assert len(rows(licenses.scan_licenses(odd))) == len(ODD) and rows(licenses.scan_licenses(odd.limit(0))) == []


def test_licence_templates_are_found_by_position(spark):
    data = [(i, "Intro words here. " + t.capitalize() + ".") for i, (t, _) in enumerate(licenses.TEMPLATES.values())]
    shuffled = [(100 + i, " ".join(sorted(t.split()))) for i, (t, _) in enumerate(licenses.TEMPLATES.values())]
    got = {r[0]: r for r in rows(licenses.scan_licenses(spark.createDataFrame(data + shuffled, "doc_id long, text string")))}
    for i, label in enumerate(licenses.TEMPLATES):
        assert label in got[i][6].split(",") and got[i][7] > 0.5
        assert label not in got[100 + i][6].split(",")


def test_quality_separates_and_never_learns_from_held_out(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["the", "tion", "er", "an", "re"]) for _ in range(rng.randint(1, 3)))
    docs, labels = [], []
    for i in range(500):
        good = i % 3 > 0
        text = " ".join(word() for _ in range(60))
        docs.append((i, text.capitalize() + "." if good else " ".join(w.upper() + "!!" for w in text.split()), "s"))
        labels.append((i, int(good)))
    docs += [(1000, None, None), (1001, "", "s"), (None, "plain words", "s")]
    d, y = spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int")
    got = {r[0]: r for r in rows(quality.classify(d, y))}
    assert len(got) == len(docs) and all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.3) for r in got.values())
    held = [i for i in range(500) if got[i][1]]
    assert 60 < len(held) < 140 and np.mean([got[i][3] == int(i % 3 > 0) for i in held]) > 0.97
    flipped = y.withColumn("quality", (1 - y.quality)).where(quality.held_out("doc_id")).unionByName(y.where(~quality.held_out("doc_id")))
    again = {r[0]: r for r in rows(quality.classify(d, flipped))}
    assert all(abs(again[i][2] - got[i][2]) < 1e-6 for i in got)
    assert rows(quality.classify(d.limit(0), y)) == []
    assert {r[2] for r in rows(quality.classify(d, y.limit(0)))} == {0.5}


def test_spelled_numbers_are_found_in_every_language_and_mix():
    for text in (
        "plus vier neun eins fünf eins acht sechs neun null fünf acht",
        "plus un zéro six huit neuf sept un huit neuf zéro sept",
        "plus seis uno nueve dos cero seis nueve uno dos cero",
        "plus 1 five 5 five 1 two 3 four 5 six 7",
    ):
        assert [(pii.KINDS[k], a, b) for a, k, b in pii.find("Call " + text + ", now")[1]] == [("phone", 5, 5 + len(text))]
    rng = random.Random(9)
    tokens = [*pii._DIGIT_WORDS, "Uno", "SEPT", "plus", "plus", "plus", *"0123456789", "42", "x", "one1", "unx", "ſix"]
    found = 0
    for n in range(6000):
        pool = rng.sample(tokens, rng.choice([2, 4, len(tokens)]))
        text = "".join(rng.choice(pool) + rng.choice([" ", " ", " ", ", ", "-", ".", "--", " - ", "\n" if n % 5 == 0 else " "]) for _ in range(rng.randint(1, 24))).rstrip()
        want = [(m.start(), m.end()) for m in pii._SPELLED.finditer(text)]
        edits = pii._spelled_edits(text)
        inside = [next((s for s in want if s[0] <= a and b <= s[1]), None) for a, b, _ in edits]
        assert None not in inside
        spelled = {s for s in want if any(w.lower() in pii._DIGIT_WORDS or w.lower() == "plus" for w in re.findall(r"[^ ,.-]+", text[s[0] : s[1]]))}
        assert set(inside) == spelled
        found += len(spelled)
        got, full = pii.deobfuscate(text), pii.Mapped(text).rewrite(edits)
        assert (got.text if got else text) == full.text
    assert found > 1000
    pii.find("plus " * 60000 + "x")  # linear
