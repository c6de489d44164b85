"""Operator 5: n-gram Jaccard join, size-aware, heavy and light.

Documents with equal shingle sets form a class; only classes are joined. Sets link
when num/den <= |A & B| / |A | B|, that is when their difference has at most
(|A| + |B|) (den - num) / (den + num) shingles.

* Light (small) sets enumerate subsets of the fixed size c that an overlap with a
  partner needs: two sets share c shingles exactly if they share a c-subset.
* Heavy (large) sets would have too many. They are cut by hash into m parts, m
  greater than any difference allowed between the sizes at hand, so that linked sets
  have equal parts; each part is one inverted list. Lists of whole parts, not of
  single shingles, keep a passage that a third of all documents share from being a
  list of a third of all documents.
* The boundary is where enumerating costs more than the lists.

Lists are scanned in blocks; a block grows with the root of its list, so the rows that
meet grow by a power of 1.5 of the list, not by its square. Inside a block an odd sketch of each set (its parity
bits) bounds the difference from below, so no link is lost; a spanning forest of
what passes is verified on the sets themselves. A part of the lists is scanned first,
as the lists of one family say much the same; then those of the rest that still hold
several components. Where verification splits what the pairs had joined, longer
sketches give another forest and then, where that is split too, every pair that
passes and still lies between two components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations
from math import comb, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import discard, materialize, partitions
from .keyset import collect_keys
from .words import U, hash_words, mix, shingles, text_chunks

_LIST_COST = 4  # scanning an inverted list costs so many emitted signatures
_BLOCK = 256  # the longest list that is one block
_WAITING = 1 << 18  # pairs of a group that are held before they are thinned to a forest or sent
_SHARP = 8  # bits a member, at least, of the sketches of later scans
_FIRST = 8  # one list in so many is scanned before the others
_AT_ONCE = 1 << 20  # pairs whose components one task finds (16 MB); more take rounds
_NULL_ID = (1 << 63) - 1


class Sizes:
    """What sets of each size emit, for the threshold num/den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.bounds = [1]
        self.light_below = 1
        self.light_below = self._boundary()

    def partner(self, n: int) -> int:
        """The largest size that can link with size n."""
        return n * self.den // self.num

    def slack(self, total: int) -> int:
        """The largest difference of linked sets whose sizes sum to ``total``."""
        return total * (self.den - self.num) // (self.den + self.num)

    def subset_sizes(self, n: int, below: int) -> set[int]:
        """Sizes of common subsets with partners of sizes under ``below``, equal sets aside."""
        out = set()
        for b in range(-(-n * self.num // self.den), min(self.partner(n), below - 1) + 1):
            c = -(-(n + b) * self.num // (self.num + self.den))
            if not (c == n == b):
                out.add(c)
        return out

    def light_cost(self, n: int) -> int:
        return sum(comb(n, c) for c in self.subset_sizes(n, self.partner(n) + 1))

    def heavy_cost(self, n: int) -> int:
        return _LIST_COST * sum(m for _, m, _ in self.windows(n))

    def _boundary(self) -> int:
        n = 1
        while n < 64 and self.light_cost(n) <= self.heavy_cost(n):
            n += 1
        return n

    def windows(self, n: int) -> list[tuple[int, int, int]]:
        """(size window, its number of parts, how many of them are spare) that size n takes part in.

        Bound k + 1 is the first size that cannot link with bound k, so partners are
        in the same size class or the next; window k joins class k with both. Parts
        beyond the differences allowed are spare: a set with no more empty parts than
        that needs no list of empty parts, which strangers share. There are so many
        that few sets have more.
        """
        while self.bounds[-1] <= n:
            self.bounds.append(self.partner(self.bounds[-1]) + 1)
        k = int(np.searchsorted(self.bounds, n, "right")) - 1
        out = []
        for w in (k, k - 1):
            if w >= 0:
                a = (self.bounds[w + 1] if w + 1 < len(self.bounds) else self.partner(self.bounds[w]) + 1) - 1
                m = self.slack(a + self.partner(a)) + 1
                empty = m * exp(-self.bounds[w] / m)
                spare = 1 + int(empty + 3 * sqrt(empty))
                out.append((w, m + spare, spare))
        return out


@lru_cache(maxsize=8)
def sizes(num: int, den: int) -> Sizes:
    return Sizes(num, den)


@lru_cache(maxsize=256)
def _dropped(n: int, c: int) -> np.ndarray:
    return np.array(list(combinations(range(n), n - c)), np.int64).reshape(comb(n, c), n - c)


def signatures(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """Equal for at least one entry of any two linked, different sets. ``s``: distinct hashes."""
    n, rule, out = len(s), sizes(num, den), []
    if n == 0:
        return np.zeros(0, U)
    weight = mix(s ^ U(0xA24BAED4963EE407))
    if n < rule.light_below:
        total = weight.sum(dtype=U)
        for c in sorted(rule.subset_sizes(n, rule.light_below)):
            gone = weight[_dropped(n, c)].sum(1, dtype=U) if c < n else np.zeros(1, U)
            out.append(mix(mix(total - gone) + U(c)))
    if rule.partner(n) >= rule.light_below:
        for w, m, spare in rule.windows(n):
            part = (s % U(m)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            at = part[order]
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            sums = np.add.reduceat(weight[order], first)
            where = at[first]
            if m - len(where) > spare:
                empty = np.setdiff1d(np.arange(m), where)
                where, sums = np.concatenate((where, empty)), np.concatenate((sums, np.zeros(len(empty), U)))
            out.append(mix(sums + mix(where.astype(U) + U((w + 1) << 32))))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, U)


def odd_sketch(s: np.ndarray, least: int = 2) -> np.ndarray:
    """Parity bits of the set, ``least`` to twice as many a member; folding halves keeps it a sketch.

    With half as many bits, families of somewhat similar texts pass by the square of their size.
    """
    bits = max(128, 1 << (least * len(s) - 1).bit_length())
    odd = np.bincount((mix(s) % U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(U)


def _folded(sketch: bytes, words: int) -> np.ndarray:
    x = np.frombuffer(sketch, U)
    while len(x) > words:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def _set_key(s: np.ndarray) -> int:
    x = mix(s.sum(dtype=U) ^ mix(np.array([len(s)], U)) * U(3) + np.bitwise_xor.reduce(mix(s)))
    return int(x.view(np.int64)[0])


def _sets(texts: pa.Array, width: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(i, j, shingle sets of rows i to j), a bounded number of bytes at a time."""
    for i, j, raw in text_chunks(texts):
        words, at = hash_words(raw, lower=True)
        yield i, j, [np.unique(shingles(words[a:b], width)) for a, b in zip(at, at[1:], strict=False)]


def _candidates(n: np.ndarray, block: np.ndarray, sketches: list[bytes], two: bool, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, distance by allowance) of the pairs of a scanned list whose sketches may be close enough."""
    words = min(map(len, sketches)) // 8
    x = np.stack([_folded(s, words) for s in sketches])
    for i in range(len(n) - 1):
        far = np.bitwise_count(x[i + 1 :] ^ x[i]).sum(1)
        allowed = (n[i + 1 :] + n[i]) * (den - num) // (den + num)
        ok = far <= allowed
        if two:  # pairs inside one block are another group's
            ok &= block[i + 1 :] != block[i]
        j = np.flatnonzero(ok)
        if len(j):
            yield np.full(len(j), i), j + i + 1, far[j] / np.maximum(1, allowed[j])


def _forest(m: int, i: np.ndarray, j: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Places of a least spanning forest of the pairs."""
    root, out = list(range(m)), []
    i, j = i.tolist(), j.tolist()
    for e in np.argsort(cost, kind="stable").tolist():
        a, b = i[e], j[e]
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        if a != b:
            root[a] = b
            out.append(e)
    return np.array(out, np.int64)


def _scan(members: DataFrame, num: int, den: int, forest: bool) -> DataFrame:
    """Pairs (a, b), a < b, of class keys from (group, two, block, key, comp, n, sketch).

    forest: pairs that with the components span each group; else all pairs between components.
    """

    def pairs_of(rows: dict) -> Iterator[pa.RecordBatch]:
        key, comp = rows["key"].to_numpy(), rows["comp"].to_numpy()
        if len(key) < 2 or (comp == comp[0]).all():
            return
        n, block = rows["n"].to_numpy(), rows["block"].to_numpy()
        _, of = np.unique(comp, return_inverse=True)

        def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
            """A least spanning forest of what is held and of what comes later is one of all pairs."""
            i, j, cost = (np.concatenate(x) for x in zip(*parts, strict=True))
            keep = _forest(len(key), of[i], of[j], cost) if forest else slice(None)
            return i[keep], j[keep], cost[keep]

        def sent(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            i, j, _ = merged(parts)
            a, b = key[i], key[j]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        parts, waiting = [], 0
        for i, j, cost in _candidates(n, block, rows["sketch"].to_pylist(), bool(rows["two"][0].as_py()), num, den):
            keep = of[i] != of[j]
            parts.append((i[keep], j[keep], cost[keep]))
            waiting += int(keep.sum())
            if waiting >= _WAITING:
                if forest:
                    parts, waiting = [merged(parts)], 0
                else:
                    yield sent(parts)
                    parts, waiting = [], 0
        if parts:
            yield sent(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            group = table.column("group").to_numpy()
            starts = np.concatenate(([0], np.flatnonzero(group[1:] != group[:-1]) + 1)) if len(group) else np.zeros(0, int)
            for a, b in zip(starts, starts[1:], strict=False):
                yield from pairs_of(_columns(table, int(a), int(b)))
            held = table.slice(int(starts[-1])).combine_chunks() if len(starts) else None
        if held is not None and held.num_rows:
            yield from pairs_of(_columns(held, 0, held.num_rows))

    def _columns(table: pa.Table, a: int, b: int) -> dict:
        part = table.slice(a, b - a)
        return {c: part.column(c) for c in part.column_names}

    # By a hash of the group: where a join has left rows dealt by the group itself, Spark drops this exchange and
    # may then read the join's shuffle map by map, which would tear groups apart.
    rows = members.repartition(partitions(members.sparkSession), F.xxhash64("group")).sortWithinPartitions("group", "n", "key")
    return rows.mapInArrow(run, "a long, b long")


def _held_twice(sets: DataFrame, per_flush: int = 1 << 19, read: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = iter) -> DataFrame:
    """sig: the signatures that two classes at least hold, from (key, sigs), which ``read`` makes of the rows.

    ``read`` runs in the sending function: a function of its own would need a worker of its own.

    Signatures travel as sorted byte planes, bucket by bucket, each with 48 bits of its
    class; of a signature's classes in one flush only the least and the greatest.
    """
    spark = sets.sparkSession
    buckets = 4 * partitions(spark)

    def ends(sig: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct signatures by value with their least and greatest tags."""
        order = np.argsort(sig)
        sig, tag = sig[order], tag[order]
        first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        return sig[first], np.minimum.reduceat(tag, first), np.maximum.reduceat(tag, first)

    def packed(sigs: list[np.ndarray], tags: list[np.ndarray]) -> pa.RecordBatch:
        sig, low, high = ends(np.concatenate(sigs), np.concatenate(tags))
        more = low != high
        sig, tag = np.concatenate((sig, sig[more])), np.concatenate((low, high[more]))
        order = np.argsort(sig)
        sig, tag = sig[order], tag[order]
        bucket = ((sig >> U(32)) * U(buckets)) >> U(32)
        at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        blobs = [sig[x:y].view(np.uint8).reshape(-1, 8).T.tobytes() + tag[x:y].view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for x, y in zip(at, at[1:], strict=False)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[at[:-1]].view(np.int64)), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, tags, n = [], [], 0
        for batch in read(batches):
            of = mix(batch.column(0).to_numpy().view(U)) >> U(16)
            sigs.append(batch.column(1).flatten().to_numpy().view(U).copy())
            tags.append(np.repeat(of, np.diff(batch.column(1).offsets.to_numpy())))
            n += len(sigs[-1])
            if n >= per_flush:
                yield packed(sigs, tags)
                sigs, tags, n = [], [], 0
        if n:
            yield packed(sigs, tags)

    def found(blobs: list[bytes]) -> pa.RecordBatch:
        sigs, tags = [], []
        for blob in blobs:
            raw = np.frombuffer(blob, np.uint8)
            n = len(raw) // 14
            sigs.append(np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(U).reshape(-1))
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :6] = raw[8 * n :].reshape(n, 6)
            tags.append(wide.view(U).reshape(-1))
        sig, low, high = ends(np.concatenate(sigs), np.concatenate(tags))
        return pa.RecordBatch.from_arrays([pa.array(sig[low != high].view(np.int64))], names=["sig"])

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != now and blobs:
                    yield found(blobs)
                    blobs = []
                now = bucket
                blobs.append(blob)
        if blobs:
            yield found(blobs)

    rows = sets.mapInArrow(send, "bucket long, blob binary").repartition(partitions(spark), "bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(receive, "sig long")


def _postings(described: DataFrame, hot: Broadcast | None = None) -> DataFrame:
    """Distinct (key, sig), dealt by sig, of (key, sigs); with ``hot``, of the signatures that it may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Copies have the same signatures, so one of them is enough.
            batch = batch.take(pa.array(np.unique(batch.column(0).to_numpy(), return_index=True)[1]))
            key, sig = np.repeat(batch.column(0).to_numpy(), np.diff(batch.column(1).offsets.to_numpy())), batch.column(1).flatten().to_numpy()
            ok = slice(None) if hot is None else hot.value.may_hold(sig.view(U))
            yield pa.RecordBatch.from_arrays([pa.array(key[ok]), pa.array(sig[ok])], names=["key", "sig"])

    rows = described.where("key is not null").select("key", "sigs").mapInArrow(run, "key long, sig long")
    return rows.repartition(partitions(described.sparkSession), "sig").distinct()


def _labelled(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, comp) of each class; one that no link touches is its own component."""
    return facts.select("key").join(labels.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("component", "key").alias("comp"))


def _between(members: DataFrame, labelled: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """The rows that :func:`_scan` reads, of groups with more than one component; n and sketch are those of ``facts``, else of ``labelled``."""
    comps = members.join(labelled.select("key", "comp"), "key").groupBy("group").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
    live = members.join(comps.where("x <> y").select("group"), "group", "left_semi")
    known = live.join(labelled, "key")
    return (known if facts is None else known.join(facts, "key")).select("group", "two", "block", "key", "comp", "n", "sketch")


def _joined(pairs: DataFrame) -> DataFrame:
    """(node, component) over pairs (a, b)."""
    return connected_components(pairs, "a", "b", at_once=_AT_ONCE)


def _split_groups(members: DataFrame, joined: DataFrame, labelled: DataFrame) -> DataFrame:
    """group: those that hold two components of ``labelled`` in one component of ``joined``.

    Where ``joined`` is over all pairs found, any link not yet known lies in such a group.
    """
    both = joined.withColumnRenamed("node", "key").join(labelled, "key")
    broken = both.groupBy("component").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("component")
    inside = members.select("group", "key").join(both.join(broken, "component"), "key").groupBy("group", "component")
    return inside.agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("group").distinct()


def _close(stars: DataFrame, facts: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b), a < b: the pairs (key, least) whose sketches may be close enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m, x, y = (c.to_pylist() for c in batch.columns)
            ok = []
            for p, q, s, t in zip(n, m, x, y, strict=True):
                words = min(len(s), len(t)) // 8
                far = int(np.bitwise_count(_folded(s, words) ^ _folded(t, words)).sum())
                ok.append(far <= (p + q) * (den - num) // (den + num))
            a, b, ok = np.array(a, np.int64), np.array(b, np.int64), np.array(ok, bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[ok]), pa.array(np.maximum(a, b)[ok])], names=["a", "b"])

    left = facts.select("key", F.col("n").alias("n1"), F.col("sketch").alias("s1"))
    right = facts.select(F.col("key").alias("least"), F.col("n").alias("n2"), F.col("sketch").alias("s2"))
    return stars.join(left, "key").join(right, "least").select("key", "least", "n1", "n2", "s1", "s2").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, linked) of distinct pairs, a < b, by exact intersection of the sets."""
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("key")).join(sets.select("key", "members", "n"), "key")
    both = ends.groupBy("a", "b").agg(F.collect_list("members").alias("_two"), F.sum("n").alias("_n"))

    @F.pandas_udf("long")
    def common(x, y):  # noqa: ANN001
        return x.__class__([len(np.intersect1d(np.frombuffer(p, U), np.frombuffer(q, U), assume_unique=True)) for p, q in zip(x, y, strict=True)], dtype="int64")

    both = both.withColumn("_i", common(F.col("_two")[0], F.col("_two")[1]))
    return both.select("a", "b", (F.col("_i") * (num + den) >= F.col("_n") * num).alias("linked"))


def _release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files that nothing refers to; else they stay until the driver's heap is full."""
    spark.sparkContext._jvm.System.gc()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """id, n_shingles, component_id of every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text with fewer words
    than ``width`` counts as one shingle. A null or empty text has no shingles and
    links with nothing: its component is its own id. Rows with equal sets are
    linked; repeated rows stay repeated. A null id is never a component's name
    while another id is there. Ids are integers.
    """
    return _components(docs, id_col, text_col, width, num, den).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("best.id", "id").alias("component_id"))


def _components(docs: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int) -> DataFrame:
    """(id, row, n, best): ``row`` hashes id and text; ``best`` is the (no_id, id, row) of the component's first row, or null."""
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    rows = rows.withColumn("_row", F.xxhash64("_id", "_text"))
    spark = docs.sparkSession

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, sigs) of each set."""
        for batch in batches:
            for _, _, found in _sets(batch.column(0), width):
                found = [x for x in found if len(x)]
                sigs = [signatures(x, num, den).view(np.int64) for x in found]
                ends = np.cumsum([0, *map(len, sigs)])
                flat = np.concatenate([np.zeros(0, np.int64), *sigs])
                yield pa.RecordBatch.from_arrays([pa.array([_set_key(x) for x in found], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["key", "sigs"])

    lists = materialize(_held_twice(rows.select("_text"), read=signed), "jaccard-lists")
    hot = spark.sparkContext.broadcast(collect_keys(lists, "sig"))
    _release(spark)
    discard(lists)  # each table goes as soon as nothing reads it: the rounds below need the disk

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with those of its set's signatures that another class may hold.

        All signatures are many times the text's shingles on disk; they are made again instead.
        """
        for batch in batches:
            for i, j, found in _sets(batch.column(1), width):
                sigs = [x[hot.value.may_hold(x)].view(np.int64) for x in (signatures(x, num, den) for x in found)]
                ends = np.cumsum([0, *map(len, sigs)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array([len(s) for s in found], pa.int64()), pa.array([_set_key(s) if len(s) else None for s in found], pa.int64()),
                    pa.array([odd_sketch(s).tobytes() if len(s) else None for s in found], pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sigs))),
                ], names=["id", "row", "n", "key", "sketch", "sigs"])

    all_docs = materialize(rows.mapInArrow(describe, "id long, row long, n long, key long, sketch binary, sigs array<long>"), "jaccard-docs")
    hot.unpersist()
    # Lists with the same members are scanned once. Bare postings are shuffled, as sums by signature are twice as wide.
    counted = _postings(all_docs).groupBy("sig").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("key")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("h2"), F.min("key").alias("least")).where("size > 1")
    kept = materialize(counted.groupBy("size", "h1", "h2", "least").agg(F.min("sig").alias("sig")).select("sig", "size", "least"), "jaccard-kept")
    hot = spark.sparkContext.broadcast(collect_keys(kept, "sig"))
    held = materialize(_postings(all_docs, hot).join(kept, "sig"), "jaccard-held")
    hot.unpersist()
    described, all_docs = all_docs, materialize(all_docs.drop("sigs"), "jaccard-classes")
    discard(described)
    blocks = F.ceil(F.sqrt(F.col("size") / _BLOCK)).cast("long")
    stars = held.where("key <> least").groupBy("key", "least").agg(F.count(F.lit(1)).alias("shared"))
    stars = stars.groupBy("key").agg(F.max(F.struct("shared", "least"))["least"].alias("least"))
    stars = materialize(stars, "jaccard-stars")
    members = held.withColumn("nb", blocks).withColumn("block", F.pmod(F.xxhash64("key"), F.col("nb")))
    members = members.select("sig", "key", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("other"))
    group = F.xxhash64("sig", F.least("block", "other"), F.greatest("block", "other"))
    members = materialize(members.select(group.alias("group"), (F.col("block") != F.col("other")).alias("two"), "block", "key"), "jaccard-members")
    discard(held)
    discard(kept)
    _release(spark)
    # In a group of two blocks, rows of both carry the same flag: the pair's, not the row's.
    listed = members.select("key").distinct()
    facts = all_docs.where("key is not null").groupBy("key").agg(F.min(F.coalesce("id", F.lit(_NULL_ID))).alias("rid"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    facts = materialize(facts.join(listed, "key", "left_semi"), "jaccard-facts")

    # Each class and the head with which it shares most lists: most families of near copies are found
    # by these few pairs, and their lists need no scan.
    near = materialize(_close(stars, facts, num, den), "jaccard-near")
    pairs, spent = near, []
    for chosen in (F.pmod("group", F.lit(_FIRST)) == 0, F.pmod("group", F.lit(_FIRST)) != 0):
        guess = materialize(_labelled(facts, _joined(pairs)), "jaccard-guess")
        forest = materialize(_scan(_between(members.where(chosen), guess, facts.select("key", "n", "sketch")), num, den, True), "jaccard-forest")
        pairs = materialize(pairs.unionByName(forest).distinct(), "jaccard-pairs")
        spent += [guess, forest, pairs]
    joined = materialize(_joined(pairs), "jaccard-joined")
    # These pairs touch every class that has any pair to verify: their sets are enough for both rounds.
    touched = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    touched = materialize(facts.select("key", "rid").join(touched, "key", "left_semi"), "jaccard-touched")
    mixed = F.pandas_udf(lambda s: s.__class__(mix(s.to_numpy().astype(np.int64).view(U)).view(np.int64)), "long")
    wanted = spark.sparkContext.broadcast(collect_keys(touched.select(mixed("rid").alias("h")), "h"))

    def read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(rid, key, members) of the documents that may stand for a class to verify."""
        for batch in batches:
            rid = np.array([_NULL_ID if i is None else i for i in batch.column(0).to_pylist()], np.int64)
            at = np.flatnonzero(wanted.value.may_hold(mix(rid.view(U))))
            for i, j, found in _sets(batch.column(1).take(pa.array(at)), width):
                yield pa.RecordBatch.from_arrays([
                    pa.array(rid[at[i:j]]), pa.array([_set_key(s) if len(s) else None for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary()),
                    pa.array([odd_sketch(s, _SHARP).tobytes() for s in found], pa.binary()),
                ], names=["rid", "key", "members", "sharp"])

    sets = rows.mapInArrow(read_sets, "rid long, key long, members binary, sharp binary").join(touched, ["rid", "key"])
    sets = materialize(sets.groupBy("key").agg(F.first("members").alias("members"), F.first("sharp").alias("sharp")).withColumn("n", F.length("members") / F.lit(8)).withColumn("n", F.col("n").cast("long")), "jaccard-sets")
    wanted.unpersist()
    discard(touched)
    _release(spark)
    tested = materialize(_verified(pairs, sets, num, den), "jaccard-tested")
    labels = materialize(_joined(tested.where("linked")), "jaccard-labels")
    labelled = materialize(_labelled(facts, labels), "jaccard-labelled")
    # Where verification splits what the pairs join, longer sketches are scanned: for a forest between the
    # components now known and, where it is split as well, for all pairs between them.
    known = tested
    for spanning in (True, False):
        loose = _split_groups(members, joined, labelled)
        sharp = sets.select("key", "n", F.col("sharp").alias("sketch"))
        known_comps = labelled.join(sets.select("key"), "key", "left_semi")
        found = materialize(_scan(_between(members.join(loose, "group", "left_semi"), known_comps, sharp), num, den, spanning).distinct(), "jaccard-found")
        fresh = materialize(_verified(found.join(known.select("a", "b"), ["a", "b"], "left_anti"), sets, num, den), "jaccard-retested")
        spent += [joined, labels, labelled, found, fresh]
        if spanning:
            joined = materialize(_joined(known.where("linked").select("a", "b").unionByName(found)), "jaccard-joined")
        known = known.unionByName(fresh)
        if fresh.where("linked").limit(1).count():
            labels = materialize(_joined(known.where("linked")), "jaccard-labels")
            labelled = materialize(_labelled(facts, labels), "jaccard-labelled")

    # Names of components: the smallest id over their classes, and the row that has it.
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    smallest = all_docs.where("key is not null").groupBy("key").agg(first.alias("first"))
    named = smallest.join(labels.select(F.col("node").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    roots = named.groupBy("component").agg(F.min("first").alias("best"))
    names = materialize(named.join(roots, "component").select("key", "best"), "jaccard-names")
    for table in (stars, members, facts, near, sets, tested, labelled, labels, *spent):
        discard(table)
    return all_docs.select("id", "row", "n", "key").join(names, "key", "left").select("id", "row", "n", "best")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, null ids last.

    Rows are judged each for itself, so rows that share an id but not a component
    stay. Of rows equal in id and text the least by its JSON stays. Rows without
    text stay, as nothing links them. Extra columns may have any names and types.
    """
    found = materialize(_components(docs, id_col, text_col, width, num, den), "jaccard-components")
    chosen = F.col("best").isNull() | ((F.col("row") == F.col("best.row")) & F.col("id").eqNullSafe(F.col("best.id")))
    gone = materialize(found.where(~chosen).select("id", "row").distinct(), "jaccard-gone")
    twice = found.where(chosen & F.col("best").isNotNull()).groupBy("id", "row").count().where("count > 1").select("id", "row")
    twice = materialize(twice, "jaccard-twice")
    # Whole rows travel as one struct, so none of their columns can clash with these.
    rows = docs.select(F.struct("*").alias("_doc"), F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("_row"))
    # Only rows that a bitmap takes for judged ones travel to the exact joins; the others stay where they are.
    judged = docs.sparkSession.sparkContext.broadcast(collect_keys(gone.unionByName(twice), "row"))
    seen = F.pandas_udf(lambda s: s.__class__(judged.value.may_hold(s.to_numpy().astype(np.int64).view(U))), "boolean")
    rows = rows.withColumn("_seen", seen("_row"))

    def among(table: DataFrame):
        return F.col("_id").eqNullSafe(table.id) & (F.col("_row") == table.row)

    left = rows.where("_seen").join(gone, among(gone), "left_anti")
    once = left.join(twice, among(twice), "left_anti").select("_doc")
    again = left.join(twice, among(twice), "left_semi").groupBy("_id", "_row").agg(F.min_by("_doc", F.to_json("_doc")).alias("_doc")).select("_doc")
    return rows.where("not _seen").select("_doc").unionByName(once).unionByName(again).select("_doc.*")
