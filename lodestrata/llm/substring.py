"""Operator 7: removal of word sequences that repeat across documents.

A sampled De Bruijn graph of the corpus: its edges are word k-mers, chosen so that
every window of ``window`` words holds at least one (the least hash among the k-mers
inside). Equal windows choose equal edges, so only windows whose edge occurs in two
documents can repeat. Edges and, inside repeated edges, whole windows are counted
through Spark aggregations; each document's repeated windows are then compacted into
maximal paths by their source coordinates, and the words they cover are removed.

Bitmaps of bounded size (:mod:`.keyset`) keep windows that cannot repeat out of the
shuffles; exact joins decide. Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize
from .keyset import KeySet, collect_keys
from .words import U, hash_words, mix, text_chunks

_BASE = U(0xC2B2AE3D27D4EB4F)
_NULL_ID = (1 << 63) - 1


def runs_of(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, by doubling: log2(width) passes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    out, covered, block, size, shift = None, 0, words, 1, width
    while shift:
        if shift & 1:
            part = block[covered : covered + n]
            out = part.copy() if out is None else mix(out * _BASE + part)
            covered += size
        shift >>= 1
        if shift:
            block = mix(block[:-size] * _BASE + block[size:])
            size *= 2
    return mix(out ^ U(width))


def least_of(edges: np.ndarray, span: int) -> np.ndarray:
    """The least of each run of ``span`` consecutive edges, by doubling: log2(span) passes."""
    n, out, size = len(edges) - span + 1, edges, 1
    while 2 * size <= span:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:n], out[span - size : span - size + n])


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(id, word hashes) of the rows of a batch; null ids count as the largest."""
    ids = batch.column(0).to_pylist()
    for i, j, raw in text_chunks(batch.column(1)):
        words, at = hash_words(raw)
        for row in range(i, j):
            yield (_NULL_ID if ids[row] is None else ids[row]), words[at[row - i] : at[row - i + 1]]


class _Pairs:
    """Collects (hash, id) rows and gives them out in batches."""

    def __init__(self, limit: int = 1 << 17):
        self.keys, self.ids, self.n, self.limit = [], [], 0, limit

    def add(self, keys: np.ndarray, ident: int) -> Iterator[pa.RecordBatch]:
        if len(keys):
            self.keys.append(keys)
            self.ids.append(np.full(len(keys), ident, np.int64))
            self.n += len(keys)
            if self.n >= self.limit:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(self.keys).view(np.int64)), pa.array(np.concatenate(self.ids))], names=["h", "id"])
        self.keys, self.ids, self.n = [], [], 0


def _emit(rows: DataFrame, pick) -> DataFrame:
    """(h, id): what ``pick`` gives of each document's words, once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Pairs()
        for batch in batches:
            for ident, words in _each(batch):
                yield from out.add(np.unique(pick(words)), ident)
        yield from out.flush()

    return rows.mapInArrow(run, "h long, id long")


def _shared_by_documents(pairs: DataFrame, name: str) -> DataFrame:
    """(h, first): hashes that more than one document holds, and the smallest of their ids."""
    found = pairs.groupBy("h").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    return materialize(found.where("first < last").select("h", "first"), name)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, k: int = 25, keep_text: bool = False) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 of each row; with ``keep_text`` also the kept text.

    A word goes if a window of ``window`` words that covers it starts in a document
    with a smaller id as well; all windows are judged on the input. Null texts have
    no words. Rows of one id do not remove each other; a null id counts as larger
    than all others. Repeated rows stay repeated.
    """
    if not window <= 2 * k <= 2 * window:
        raise ValueError("k must be from half the window to the window")
    spark, span = docs.sparkSession, window - k + 1
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))

    def edges_of(words: np.ndarray) -> np.ndarray:
        if len(words) < window:
            return np.zeros(0, U)
        return least_of(runs_of(words, k), span)

    edges = _shared_by_documents(_emit(rows, edges_of), "substring-edges")
    known = spark.sparkContext.broadcast(collect_keys(edges, "h"))
    discard(edges)

    def windows_of(words: np.ndarray, edge_set: KeySet, also: KeySet | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows that may repeat."""
        none = np.zeros(0, np.int64), np.zeros(0, U)
        if len(words) < window:
            return none
        e = runs_of(words, k)
        starts = np.flatnonzero(edge_set.may_hold(least_of(e, span)))
        if not len(starts):
            return none
        # First, middle and last k-mer of a window cover all of its words.
        h = mix((e[starts] * _BASE + e[starts + span // 2]) * _BASE + e[starts + span - 1])
        if also is not None:
            keep = also.may_hold(h)
            starts, h = starts[keep], h[keep]
        return starts, h

    windows = _shared_by_documents(_emit(rows, lambda w: windows_of(w, known.value)[1]), "substring-windows")
    repeated = spark.sparkContext.broadcast(collect_keys(windows, "h"))
    mine = _emit(rows, lambda w: windows_of(w, known.value, repeated.value)[1])
    removable = mine.join(windows, "h").where("id > first")
    removable = materialize(removable.groupBy(F.col("id").alias("_key")).agg(F.collect_list("h").alias("_gone")), "substring-removable")
    repeated.unpersist()
    discard(windows)
    mixed = F.pandas_udf(lambda s: s.__class__(mix(s.to_numpy().astype(np.int64).view(U)).view(np.int64)), "long")
    touched = spark.sparkContext.broadcast(collect_keys(removable.select(mixed("_key").alias("h")), "h"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts and digest of the whole text, and the text only where words may go."""
        hit = touched.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            keys = np.array([_NULL_ID if i is None else i for i in ids], np.int64)
            maybe = hit.may_hold(mix(keys.view(U))).tolist()
            for i, j, raw in text_chunks(batch.column(1)):
                words = [t.split() for t in raw]
                plain = [b" ".join(w) for w in words]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(keys[i:j]), pa.array([len(w) for w in words], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in plain]), pa.array([p if keep_text or m else None for p, m in zip(plain, maybe[i:j], strict=True)], pa.binary()).cast(pa.string()),
                ], names=["_id", "_key", "n_words", "_sha", "_plain"])

    base = rows.mapInArrow(whole, "_id long, _key long, n_words long, _sha string, _plain string")
    joined = base.join(removable, "_key", "left").select("_id", "n_words", "_sha", "_plain", "_gone")
    names = [id_col, "n_words", "n_removed", "kept_sha256", *(["kept_text"] if keep_text else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_removed, shas, kept_texts = [], [], []
            gone_column = batch.column(4)
            for row, (sha, plain) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                gone, kept, removed = gone_column[row], plain, 0
                if gone.is_valid:
                    data = (plain or "").encode()
                    words = data.split()
                    hashes, _ = hash_words([data])
                    starts, h = windows_of(hashes, known.value)
                    starts = starts[np.isin(h, gone.values.to_numpy().view(U))]
                    # Overlapping windows are compacted into paths: +1 where one opens, -1 where it closes.
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, starts, 1)
                    np.add.at(depth, starts + window, -1)
                    covered = np.cumsum(depth[:-1]) > 0
                    removed = int(covered.sum())
                    if removed:
                        left = b" ".join(w for w, c in zip(words, covered.tolist(), strict=True) if not c)
                        sha, kept = hashlib.sha256(left).hexdigest(), left.decode()
                n_removed.append(removed)
                shas.append(sha)
                kept_texts.append(kept)
            columns = [batch.column(0), batch.column(1), pa.array(n_removed, pa.int64()), pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(kept_texts, pa.string())] if keep_text else [])], names=names)

    schema = f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if keep_text else "")
    return joined.mapInArrow(cut, schema)
