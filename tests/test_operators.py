"""Table operators on small inputs, and every registered query against DuckDB at sf0.001."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestrata import registry
from lodestrata.operators import fingerprint, fold, graph, incremental, search, shingles, stats, threads
from lodestrata.sources import sinks
from lodestrata.streaming import sessions

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not Path(DATA).exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    rel = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(rel.columns) == cols
    want = rel.select(", ".join(f'"{c}"' for c in cols)).fetchall()
    assert Counter(tuple(r) for r in df.select(*cols).collect()) == Counter(want)


def messages(spark, rows):
    return spark.createDataFrame(rows, "id long, msgid string, in_reply_to string, subject string, date_iso string")


def groups(spark, rows):
    out = {}
    for r in threads.thread_components(messages(spark, rows)).collect():
        out.setdefault(r.component, set()).add(r.id)
    return sorted(map(sorted, out.values()))


def test_threads(spark):
    long = "a long subject line"
    assert groups(spark, [(1, "a", None, long, "2020-01-01"), (2, "b", "a", "other", "2024-01-01"), (3, "c", None, long, "2020-02-01"), (4, "d", None, long, "2021-02-01"), (5, None, "zz", "short", None)]) == [[1, 2, 3], [4], [5]]
    chain = [(i, f"m{i}", None, long, f"2020-{1 + 2 * i:02d}-01") for i in range(5)]
    assert groups(spark, chain) == [[0, 1, 2, 3, 4]]
    assert groups(spark, [(1, "a", None, "short", "2020-01-01"), (2, "b", None, "short", "2020-01-01")]) == [[1], [2]]
    assert groups(spark, []) == []


def test_thread_ids_freeze_and_merge(spark):
    rows = [(1, "a", None, "s", "2020-01-02"), (2, "b", "a", "s", "2020-01-03"), (3, "c", "b", "s", None)]
    h = hashlib.sha1(b"a").hexdigest()[:12]
    prior = lambda *p: spark.createDataFrame(list(p), "msgid string, tid string")
    ids = lambda p=None: {r.msgid: r.tid for r in threads.thread_ids(messages(spark, rows), p).collect()}
    assert set(ids().values()) == {h}
    assert set(ids(prior(("a", "T1"), ("b", "T2"))).values()) == {"T1"}
    assert set(ids(prior(("b", "T2"), ("c", "T3"))).values()) == {"T2"}


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (7000, 7000)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert all(got[i] == 0 for i in range(301)) and all(got[1000 + i] == 1000 for i in range(50)) and got[7000] == 7000 and len(got) == 352
    assert graph.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_components_in_one_task_as_in_rounds(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(350)] + [(i, i + 1) for i in range(1000, 1300)] + [(9000, 9000), (9001, None), (None, None)]
    df = spark.createDataFrame(edges, "src long, dst long")
    found = [{tuple(r) for r in graph.connected_components(df, at_once=k).collect()} for k in (0, 100, 10_000)]
    assert found[0] == found[1] == found[2] and (9000, 9000) in found[0] and (1300, 1000) in found[0]
    assert graph.connected_components(df.where("src > 10000"), at_once=10).count() == 0


def test_first_occurrence_dedup(spark):
    texts = [(1, "a b c d e f g h i j"), (2, "x a b c d e f g h y"), (3, "short"), (4, "q q q q q q q q q q"), (5, "")]
    df = spark.createDataFrame(texts, "k int, t string").withColumn("w", F.when(F.col("t") == "", F.array().cast("array<string>")).otherwise(F.split("t", " ")))
    seen, want = set(), {}
    for k, t in texts:
        words = t.split()
        keep = [True] * len(words)
        for i in range(len(words) - 7):
            run = tuple(words[i : i + 8])
            if run in seen:
                keep[i : i + 8] = [False] * 8
            seen.add(run)
        want[k] = " ".join(w for w, y in zip(words, keep, strict=True) if y)
    assert {r.k: r.kept for r in shingles.first_occurrence_dedup(df, F.col("w"), ["k"]).collect()} == want


def fold_of(spark, bodies):
    df = spark.createDataFrame([("t", i, a, b) for i, (a, b) in enumerate(bodies)], "thread string, idx int, author string, body string")
    return sorted((r.idx, r.line_from, r.line_to, r.source, r.kind) for r in fold.fold_ranges(df).collect())


PARAGRAPH = "the quick brown fox jumps over the lazy dog near the old mill today"
SECOND = "another long line of words that nobody has written before in this list"


def test_fold_quotes(spark):
    quoted = f"My answer is written here above.\nOn Monday Ann Lee wrote:\n> {PARAGRAPH}\n> {SECOND}"
    assert fold_of(spark, [("Ann Lee", f"{PARAGRAPH}\n{SECOND}"), ("Bob", quoted)]) == [(1, 1, 3, 0, "q")]
    inline = f"> {PARAGRAPH}\nno\n> {SECOND}\nthanks for all the help"
    assert fold_of(spark, [("Ann Lee", f"{PARAGRAPH}\n{SECOND}"), ("Bob", inline)]) == []
    changed = f"Some words of my own here.\n> {PARAGRAPH.replace('lazy', 'busy')}"
    assert fold_of(spark, [("Ann", PARAGRAPH), ("Bob", changed)]) == []


def test_fold_keeps_enough_visible_and_names_the_author(spark):
    assert fold_of(spark, [("Ann", f"{PARAGRAPH}\n{SECOND}"), ("Bob", f"{PARAGRAPH}\n{SECOND}")]) == []
    bodies = [("Ann Lee", f"{PARAGRAPH}\n{SECOND}"), ("Cy", f"Cy adds three words.\n> {PARAGRAPH}\n> {SECOND}"), ("Bob", f"Bob answers with words.\nOn Friday Ann Lee wrote:\n> {PARAGRAPH}\n> {SECOND}")]
    got = fold_of(spark, bodies)
    assert (2, 1, 3, 0, "q") in got and (1, 1, 2, 0, "q") in got
    header = f"Visible answer of mine.\nFrom: Ann Lee\nSubject: about it\n\n{PARAGRAPH}\n{SECOND}"
    assert (1, 1, 5, 0, "q") in fold_of(spark, [bodies[0], ("Bob", header)])


def test_furniture(spark):
    lines = ["On Mon, Jo wrote:", "-----Original Message-----", ">", "[snip]", ":-)", "~~~|||", "Warning: do not deploy", "plain words here", "<3"]
    got = [r.o for r in spark.createDataFrame(list(enumerate(lines)), "i int, t string").orderBy("i").select(fold.is_furniture(F.col("t")).alias("o")).collect()]
    assert got == [True, True, True, True, False, True, False, False, False]


def test_fingerprint(spark):
    rows = [("a", "bc", None), ("ab", "c", "None"), ("x", "y", "z")]
    fp = lambda r: fingerprint.content_fingerprint(spark.createDataFrame(r, "a string, b string, c string"), ["a", "b", "c", "absent"]).first()[0]

    def digest(r):
        parts = b"".join(b"N\0" if v is None else b"S" + len(v.encode()).to_bytes(8, "big") + v.encode() for v in r)
        return int.from_bytes(hashlib.sha256(parts).digest(), "big")

    assert fp(rows) == f"{sum(map(digest, rows)) % (1 << 256):064x}" == fp(rows[::-1])
    assert fp(rows[:1] * 2) != fp([]) == "0" * 64 and fp([("a", "bc", "None")]) != fp(rows[:1])
    assert fp(rows * 50) == f"{50 * sum(map(digest, rows)) % (1 << 256):064x}"


def test_vault_and_not_in(spark):
    build = spark.createDataFrame([(1, "u1", "x"), (2, "u2", "y")], "id int, url string, data string")
    vault = spark.createDataFrame([(9, "u2", "old"), (8, "u3", "z")], "id int, url string, data string")
    restored = {(r.url, r.data) for r in incremental.vault_restore(build, vault, "url").collect()}
    assert restored == {("u1", "x"), ("u2", "y"), ("u3", "z")}
    new, n = incremental.vault_sync(build, vault, "url")
    assert n == 1 and new.first().url == "u1" and incremental.vault_sync(vault, vault, "url")[1] == 0
    nulls = spark.createDataFrame([("u9",), (None,)], "url string")
    assert incremental.not_in(build, nulls, "url").count() == 0
    assert incremental.not_in(nulls, vault.limit(0), "url").count() == 2 and incremental.not_in(nulls, vault, "url").count() == 1


def test_incremental(spark):
    res = spark.createDataFrame([("f", 1, True), ("f", 2, False), ("f", 3, True), ("g", 5, False), ("h", 4, True)], "folder string, uid int, ok boolean")
    got = {r.folder: (r.seen, r.added, r.checkpoint) for r in incremental.contiguous_checkpoint(res, "folder", "uid", "ok").collect()}
    assert got == {"f": (3, 2, 1), "g": (1, 0, 0), "h": (1, 1, 4)}
    rows = spark.createDataFrame([("m", 2, "b"), ("m", 1, "a"), (None, 3, "c"), (None, 4, "c")], "msgid string, seq int, v string")
    assert sorted(r.v for r in incremental.first_wins(rows, "msgid", ["seq"]).collect()) == ["a", "c", "c"]
    assert incremental.insert_or_ignore(spark.createDataFrame([("m",)], "msgid string"), rows, "msgid", ["seq"]).count() == 2
    state = spark.createDataFrame([("f", 7, 1, "h", "a"), ("g", 9, 1, "h", "a")], "folder string, last_uid int, uidvalidity int, host string, account string")
    now = spark.createDataFrame([("f", 1, "h", "a"), ("g", 2, "h", "a"), ("n", 1, "h", "a")], "folder string, uidvalidity int, host string, account string")
    assert {r.folder: r.last_uid for r in incremental.reset_checkpoint(state, now).collect()} == {"f": 7, "g": 0, "n": 0}
    target = spark.createDataFrame([("2024-May", "list", "a"), ("2024-May", "inbox", "b"), ("2024-June", "list", "c")], "month string, source string, msgid string")
    new = spark.createDataFrame([("2024-May", "list", "d"), ("2024-May", "list", "b")], "month string, source string, msgid string")
    assert sorted(r.msgid for r in incremental.refresh_partition(target, new, "2024-May").collect()) == ["b", "c", "d"]
    assert incremental.pending(spark.createDataFrame([(1, 1), (2, None), (3, 0)], "id int, obfuscated int")).count() == 2
    assert incremental.changed_rows(target, target.withColumn("source", F.when(F.col("msgid") == "a", None).otherwise(F.col("source"))), "msgid", ["source"]).count() == 1


def test_names_and_bars(spark):
    rows = spark.createDataFrame([("a@x", "Jo", 1), ("a@x", "Jo Smith", 2), ("a@x", "Jo", 3), ("b@x", "user-1@masked.invalid", 4)], "email string, name string, seq int")
    assert {r.email: r.name for r in stats.backfill_names(rows, "email", "name", "seq").collect()} == {"a@x": "Jo"}
    assert {r.email: r.name for r in stats.real_names(rows, "email", "name", "seq").collect()}["a@x"] == "Jo Smith"


def test_search(spark):
    rows = [(1, "m1", None, "Disk full", "2024-01-01T00:00", "Ann", "the disk is full of logs and we must clean it now"), (2, "m2", "m1", "Re: Disk", "2024-01-02T00:00", "Bob", "> the disk is full of logs and we must clean it now\nagreed"), (3, "m3", None, "Other", None, "Cy", None)]
    m = spark.createDataFrame(rows, "id long, msgid string, in_reply_to string, subject string, date_iso string, from_name string, body string")
    index = search.build_index(m, threads.thread_components(m), spark.createDataFrame([("m1",)], "msgid string"))
    bodies = {r.id: r.body for r in index.collect()}
    assert bodies[2] == "agreed" and bodies[3] == ""
    assert [r.id for r in search.search(index, "disk").orderBy("rank").collect()] == [2, 1]
    assert [r.id for r in search.search(index, "logs clean").collect()] == [1] and [r.id for r in search.search(index, "disk", True).collect()] == [1]


def test_sinks(spark, tmp_path):
    m = spark.createDataFrame([(2, "2024-May", "2024-05-02", bytearray(b"B")), (1, "2024-May", "2024-05-01", bytearray(b"A\n")), (3, "2024-May", None, bytearray(b"C"))], "id long, month string, date_iso string, raw binary")
    assert sinks.monthly_mbox(m).first().mbox == "A\nB\nC\n"
    index = spark.createDataFrame([(1, "m", 'a "q"', "é", "2024", 2, 5, "t")], "id long, mid string, subject string, author string, sent string, att_count long, thread long, tid string")
    assert sinks.index_json(index).first().row == '["m","a \\"q\\"","é","2024",2,5,"t"]'
    path = str(tmp_path / "t")
    sinks.write_partitioned(spark.createDataFrame([(1, "a", "list"), (2, "b", "list")], "id int, month string, source string"), path)
    sinks.write_partitioned(spark.createDataFrame([(3, "a", "list")], "id int, month string, source string"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3]


def test_streams(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "msgid string, month string, at timestamp"
    spark.sql("SELECT 'a' msgid, 'm' month, timestamp'2024-01-01' at UNION ALL SELECT 'a', 'm', timestamp'2024-01-01' UNION ALL SELECT 'b', 'm', timestamp'2024-01-02'").write.json(source)
    for _ in range(2):
        sessions.ingest(spark.readStream.schema(schema).json(source), target, str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(target).count() == 2
    stream = sessions.deduplicated(spark.readStream.schema(schema).json(source), "at")
    q = stream.writeStream.format("memory").queryName("dedup").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dedup").count() == 2


def test_thread_pages(spark):
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-03-01"), (3, None), (4, "2024-03-01")], "component long, last_date string")
    assert {r.component: r.part for r in threads.thread_pages(rows, 2).collect()} == {2: 1, 4: 1, 1: 2, 3: 2}
    assert threads.thread_pages(rows.limit(0), 2).count() == 0
