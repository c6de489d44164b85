"""Runs of words that earlier rows hold, found in bounded blocks of hashes.

A word is not a row here. A task hashes the runs of some million words at once and sends
each bucket one packed block: 64 bits a run beside its place; the bucket comes of a second,
independent hash, so both together tell runs apart. A bucket sorts its runs in memory; the
number of buckets grows with the texts, so a bucket does not. What repeats goes back in
blocks by row. All occurrences are looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U = np.uint64
#: Words hashed at once, and characters of text a bucket.
CHUNK, BUCKET_CHARS = 1 << 20, 1 << 24
_MUL_A, _MUL_B = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
_BLOCK = "bucket int, n_rows int, n int, rows binary, groups binary, counts binary, pos binary, a binary, b binary"
_NAMES = [f.split()[0] for f in _BLOCK.split(", ")]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _spread(h: np.ndarray, n: int) -> np.ndarray:
    """Numbers below ``n`` of mixed hashes."""
    return ((h >> U(32)) * U(n) >> U(32)).astype(np.int32)


def _squeeze(a: np.ndarray) -> bytes:
    """Bytes of one significance beside each other, packed."""
    flat = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return pa.Codec("zstd", 1).compress(flat, asbytes=True)


def _spring(raw: bytes, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = pa.Codec("zstd", 1).decompress(raw, n * size, asbytes=True)
    return np.frombuffer(flat, np.uint8).reshape(size, n).T.copy().view(dtype).ravel()


def _blocks(bucket: np.ndarray, row: np.ndarray, group: np.ndarray, pos: np.ndarray, a: np.ndarray | None, b: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """One block a bucket of entries that are in order of bucket and, inside, of runs of rows."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    out = []
    for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)], strict=True):
        if i == j:
            continue
        r, g = row[i:j], group[i:j]
        heads = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (g[1:] != g[:-1])])
        counts = np.diff(np.r_[heads, j - i]).astype(np.uint32)
        rows = np.diff(r[heads], prepend=np.int64(0))
        rest = [None if x is None else _squeeze(x[i:j]) for x in (a, b)]
        out.append((int(bucket[i]), len(heads), j - i, _squeeze(rows), _squeeze(g[heads]), _squeeze(counts), _squeeze(pos[i:j]), *rest))
        if len(out) == 64:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] * 3 + [pa.binary()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_NAMES)


def _by_bucket(batches: Iterator[pa.RecordBatch], kind_a, kind_b) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, group, pos, a, b) of each bucket of a partition, one bucket unpacked at a time."""
    held = defaultdict(list)
    for batch in batches:
        for x in batch.to_pylist():
            held[x["bucket"]].append(x)
    for key in sorted(held):
        parts = []
        for x in held.pop(key):
            counts = _spring(x["counts"], x["n_rows"], np.uint32)
            row = np.repeat(np.cumsum(_spring(x["rows"], x["n_rows"], np.int64)), counts)
            more = [None if k is None else _spring(x[c], x["n"], k) for c, k in (("a", kind_a), ("b", kind_b))]
            parts.append((row, np.repeat(_spring(x["groups"], x["n_rows"], np.int64), counts), _spring(x["pos"], x["n"], np.uint32), *more))
        yield tuple(None if c[0] is None else np.concatenate(c) for c in zip(*parts, strict=True))


def _hash_runs(words: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the run from each word on, the last ``size - 1`` words left out; case is ignored."""
    coded = words.dictionary_encode()
    digests = b"".join(blake2b((w or "").lower().encode("utf-8", "surrogatepass"), digest_size=16).digest() for w in coded.dictionary.to_pylist())
    table = np.frombuffer(digests + bytes(16), U).reshape(-1, 2)
    codes = coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)
    n = len(codes) - size + 1
    wa, wb = table[codes, 0], table[codes, 1]
    a, b = wa[:n].copy(), wb[:n].copy()
    for j in range(1, size):
        a, b = a * _MUL_A + wa[j : j + n], b * _MUL_B + wb[j : j + n]
    return _mix(a), _mix(b)


def earlier_runs(rows: DataFrame, size: int, chars: int, within: bool) -> DataFrame:
    """(group, row, starts, words, latest, first): the places of a row where a run begins that an earlier row of its group holds.

    ``rows`` is (group long, row long, words array<string>); rows of null group have no
    earlier ones. ``words`` counts those that a run is the first to cover; ``latest`` and
    ``first`` are the earlier rows. With ``within`` a row's own earlier places count
    too, and these two are null. ``chars`` is the size of the texts, to choose the number of buckets.
    """
    n = max(rows.sparkSession.sparkContext.defaultParallelism, -(-chars // BUCKET_CHARS))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, row, lists = batch.column(0), batch.column(1).to_numpy(), batch.column(2)
            lists = lists.fill_null(pa.scalar([], lists.type)) if lists.null_count else lists
            at = lists.offsets.to_numpy().astype(np.int64)
            known, group = group.is_valid().to_numpy(zero_copy_only=False), group.fill_null(0).to_numpy()
            i = 0
            while i < len(row):
                j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK, "right")) - 1)
                if at[j] - at[i] >= size:
                    yield from chunk(row[i:j], group[i:j], known[i:j], at[i : j + 1] - at[i], lists.values.slice(at[i], at[j] - at[i]))
                i = j

    def chunk(row, group, known, at, words) -> Iterator[pa.RecordBatch]:
        a, b = _hash_runs(words, size)
        of = np.repeat(np.arange(len(row)), np.diff(at))[: len(a)]
        start = np.flatnonzero((np.arange(len(a)) + size <= at[of + 1]) & known[of])
        of, pos = of[start], (start - at[of[start]]).astype(np.uint32)
        salt = _mix(group.view(U) + _MUL_A)[of]
        a, bucket = _mix(a[start] ^ salt), _spread(_mix(b[start] ^ salt), n)
        o = np.argsort(bucket, kind="stable")
        yield from _blocks(bucket[o], row[of[o]], group[of[o]], pos[o], a[o], None)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, group, pos, h, _ in _by_bucket(batches, U, None):
            o = np.argsort(h)
            same = h[o][1:] == h[o][:-1]
            o = o[np.r_[False, same] | np.r_[same, False]]
            if not len(o):
                continue
            o = o[np.lexsort((pos[o], row[o], h[o]))]
            h, row, group, pos = h[o], row[o], group[o], pos[o]
            i, new = np.arange(len(h)), np.r_[True, h[1:] != h[:-1]]
            g = np.maximum.accumulate(np.where(new, i, 0))
            own = np.maximum.accumulate(np.where(new | np.r_[True, row[1:] != row[:-1]], i, 0))
            keep = np.flatnonzero(i > g if within else own > g)
            latest, first = row[own[keep] - 1], row[g[keep]]
            row, group, pos = row[keep], group[keep], pos[keep]
            bucket = _spread(_mix(row.view(U) ^ _mix(group.view(U))), n)
            o = np.lexsort((pos, row, group, bucket))
            more = (None, None) if within else (latest[o], first[o])
            yield from _blocks(bucket[o], row[o], group[o], pos[o], *more)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None if within else np.int64
        for row, group, pos, latest, first in _by_bucket(batches, kind, kind):
            o = np.lexsort((pos, row, group))
            row, group, pos = row[o], group[o], pos[o].astype(np.int32)
            new = np.r_[True, (row[1:] != row[:-1]) | (group[1:] != group[:-1])]
            words = np.where(new, size, np.minimum(size, np.diff(pos, prepend=np.int32(0)))).astype(np.int32)
            heads = np.flatnonzero(new)
            for i in range(0, len(heads), 4096):
                at = np.r_[heads[i : i + 4096], heads[i + 4096] if i + 4096 < len(heads) else len(row)]
                of, cut = pa.array((at - at[0]).astype(np.int32)), slice(at[0], at[-1])
                lists = [pa.ListArray.from_arrays(of, pa.array(x[cut])) for x in (pos, words)]
                lists += [pa.nulls(len(at) - 1, pa.list_(pa.int64())) if x is None else pa.ListArray.from_arrays(of, pa.array(x[o][cut])) for x in (latest, first)]
                yield pa.RecordBatch.from_arrays([pa.array(group[at[:-1]]), pa.array(row[at[:-1]]), *lists], names=["group", "row", "starts", "words", "latest", "first"])

    # A bucket goes to the partition of its number.
    sent = rows.select("group", "row", "words").mapInArrow(hashed, _BLOCK).repartitionById(n, F.col("bucket"))
    back = sent.mapInArrow(matched, _BLOCK).repartitionById(n, F.col("bucket"))
    return back.mapInArrow(gathered, "group long, row long, starts array<int>, words array<int>, latest array<long>, first array<long>")


def text_size(rows: DataFrame, text: Column) -> int:
    """Characters of all texts."""
    return rows.agg(F.coalesce(F.sum(F.length(text).cast("long")), F.lit(0))).first()[0]
