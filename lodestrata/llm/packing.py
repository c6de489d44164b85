"""Operator 9: lexical retrieval packing.

Texts are encoded once. Document frequencies, count and mean length for BM25 are of
the whole corpus. Documents are put in the order of three telling terms (weighted
minima, by idf, so documents meet the more likely the more telling terms they share)
and cut into shards of about ``shard_bytes`` of text; equal texts lie together
whatever their ids. Each shard is one inverted index over token ids. A window begins
with a seed document; its unused neighbours, best BM25 score first, fill the window,
and the one that does not fit is cut: its rest begins the next window. So all windows
of a shard but the last are full, and memory depends on the shard, never on the table (a
shard that one repeated row swells is packed in parts).
Neighbours in other shards are not searched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, partitions
from .bpe import encoder
from .words import U, mix, text_chunks

_K1, _B = 1.2, 0.75
_FIELDS = (("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("doc_tokens", "long"), ("sequence_id", "long"), ("offset", "long"))
_DENSE, _SQUARE = 1 << 21, 2048  # cells of a shard's dense matrix; documents up to which all products are kept
_SAMPLES, _MOST_SAMPLES = 32, 1 << 21  # keys read to place the bounds: a shard, and at most


@dataclass
class Corpus:
    """What BM25 takes from all documents: their count, mean length and each term's frequency."""

    n: int
    mean: float
    df: np.ndarray  # by term id

    def idf(self, terms: np.ndarray) -> np.ndarray:
        df = self.df[terms]
        return np.log1p((self.n - df + 0.5) / (df + 0.5)).astype(np.float32)


class ShardKeys:
    """64 bits that order documents: three telling terms, then a hash that parts equal texts' families."""

    def __init__(self, corpus: Corpus):
        terms = np.arange(len(corpus.df))
        # A term of a single document brings no neighbour.
        idf = np.where(corpus.df > 1, corpus.idf(terms).astype(float), 1e-9)
        self.ranks, self.places = [], []
        for k in range(3):
            h = mix(terms.astype(U) + U((k + 1) << 40))
            order = np.argsort(-np.log(((h >> U(11)).astype(float) + 1) * 2.0**-53) / idf, kind="stable")
            rank = np.empty(len(terms), np.int32)
            rank[order] = np.arange(len(terms))
            self.ranks.append(rank)
            self.places.append((mix(h) >> U(48)).astype(np.int64)[order])

    def __call__(self, docs: list[np.ndarray], row_hashes: np.ndarray) -> np.ndarray:
        """The keys of documents, none of which is without ids."""
        ids, starts = np.concatenate(docs), np.cumsum([0, *map(len, docs[:-1])])
        key = np.zeros(len(docs), np.int64)
        for rank, place in zip(self.ranks, self.places, strict=True):
            key = key << 16 | place[np.minimum.reduceat(rank[ids], starts)]
        return (key << 16 | row_hashes & 0xFFFF) ^ np.int64(-1 << 63)


class LexicalIndex:
    """BM25 postings over the documents of a shard, and which of them are unused.

    Terms that many documents of the shard hold are rows of a dense matrix, whose
    products give their part of a score; the others are inverted lists. Without a
    corpus the shard's own documents are the corpus.
    """

    def __init__(self, docs: list[np.ndarray], corpus: Corpus | None = None):
        n = len(docs)
        self.unused, self.n, self.first = np.ones(n, bool), n, 0
        found = [np.unique(d, return_counts=True) for d in docs]
        terms = np.concatenate([t for t, _ in found]) if n else np.zeros(0, np.uint32)
        tf = np.concatenate([c for _, c in found]).astype(np.float32) if n else np.zeros(0, np.float32)
        doc = np.repeat(np.arange(n, dtype=np.int32), [len(t) for t, _ in found])
        vocabulary, dense = np.unique(terms, return_inverse=True)
        df = np.bincount(dense, minlength=len(vocabulary))
        length = np.array([len(d) for d in docs], np.float32)
        if corpus is None:
            idf, mean = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32), float(length.mean()) if n else 1.0
        else:
            idf, mean = corpus.idf(vocabulary), corpus.mean
        norm = _K1 * (1 - _B + _B * length / max(1.0, mean))
        weight = idf[dense] * tf * (_K1 + 1) / (tf + norm[doc])
        by_df = np.argsort(-df, kind="stable")
        common = by_df[: min(_DENSE // max(1, n), np.count_nonzero(df * 32 >= n))]
        row = np.full(len(vocabulary), -1, np.int64)
        row[common] = np.arange(len(common))
        is_common = row[dense] >= 0
        self.matrix = np.zeros((len(common), n), np.float32)
        self.matrix[row[dense[is_common]], doc[is_common]] = weight[is_common]
        self.scores = None
        if n <= _SQUARE:  # all products at once; they do not depend on what is used
            self.scores = (self.matrix > 0).astype(np.float32).T @ self.matrix
        rare = ~is_common
        by_term = np.argsort(dense[rare], kind="stable")
        self.doc, self.weight = doc[rare][by_term], weight[rare][by_term]
        self.at = np.concatenate(([0], np.cumsum(np.where(row < 0, df, 0))))
        # All terms of a document are its query.
        rare_terms, rare_doc = dense[rare], doc[rare]
        bounds = np.searchsorted(rare_doc, np.arange(n + 1))
        self.query = [rare_terms[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def take_first(self) -> int | None:
        """The unused document that comes first, now used."""
        while self.first < self.n and not self.unused[self.first]:
            self.first += 1
        if self.first == self.n:
            return None
        self.unused[self.first] = False
        return self.first

    def score(self, seed: int) -> np.ndarray:
        """BM25 of every document for all terms of the seed."""
        common = self.scores[seed] if self.scores is not None else (self.matrix[:, seed] > 0).astype(np.float32) @ self.matrix
        begin, end = self.at[self.query[seed]], self.at[self.query[seed] + 1]
        n = end - begin
        if not n.sum():
            return common.copy()
        at = np.arange(n.sum()) + np.repeat(begin - np.cumsum(n) + n, n)
        return common + np.bincount(self.doc[at], self.weight[at], self.n).astype(np.float32)

    def neighbours(self, seed: int) -> Iterator[int]:
        """All unused documents of a positive score, best first, each used as it is given; then the rest in order."""
        score = self.score(seed)
        score[~self.unused] = 0
        left = int(np.count_nonzero(score > 0))
        for size in (64, left):  # most windows are full before the whole order is needed
            if size < left:
                least = np.partition(score, self.n - size)[self.n - size]
                best = np.flatnonzero(score >= least)
            else:
                best = np.flatnonzero(score > 0)
            # Ties keep the documents' order.
            for d in best[np.argsort(-score[best], kind="stable")].tolist():
                if self.unused[d]:
                    self.unused[d] = False
                    yield d
            if size >= left:
                break
        while (d := self.take_first()) is not None:
            yield d


def pack_shard(docs: list[np.ndarray], window: int, corpus: Corpus | None = None) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard."""
    index, pieces, sequence = LexicalIndex(docs, corpus), [], 0
    seed, at = index.take_first(), 0
    while seed is not None:
        offset, doc, source = 0, seed, None
        rest = None
        while True:
            n = min(len(docs[doc]) - at, window - offset)
            pieces.append((doc, at, n, sequence, offset))
            offset, at = offset + n, at + n
            if at < len(docs[doc]):
                rest = doc
                break
            at = 0
            if offset == window:
                break
            source = source or index.neighbours(seed)
            doc = next(source, None)
            if doc is None:
                break
        sequence += 1
        if rest is None:
            seed, at = index.take_first(), 0
        else:
            seed = rest
    return pieces


def _stored(ids: np.ndarray) -> bytes:
    """Two bytes an id where that is enough, told by an odd length; else four."""
    return ids.astype("<u2").tobytes() + b"\0" if ids.max() < 1 << 16 else ids.astype("<u4").tobytes()


def _read(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2", len(raw) // 2).astype("<u4") if len(raw) % 2 else np.frombuffer(raw, "<u4")


def encode(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int) -> DataFrame:
    """_id, _bytes, _hash and _ids (see _stored) of every row; and rows with _stats: what a task adds to :func:`corpus_of`."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 64).alias("_bytes"), F.xxhash64(id_col, text_col).alias("_hash"))
    names = ["_id", "_bytes", "_hash", "_ids", "_stats"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tail = encoder(tokenizer), np.array([end_id], "<u4")
        df, n, tokens, id_type = np.zeros(1 << 16, np.int64), 0, 0, None
        for batch in batches:
            id_type = batch.column(0).type
            for i, j, raw in text_chunks(batch.column(1)):
                found = [np.concatenate((ids, tail)) for ids in enc.batch([t.decode() for t in raw])]
                for ids in found:
                    terms = np.unique(ids)
                    if terms[-1] >= len(df):
                        df = np.concatenate((df, np.zeros(int(terms[-1]) + 1, np.int64)))
                    df[terms] += 1
                n, tokens = n + len(found), tokens + sum(map(len, found))
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, j - i) for c in (0, 2, 3)] + [pa.array(map(_stored, found), pa.binary()), pa.nulls(j - i, pa.binary())], names=names)
        if n:
            seen = np.flatnonzero(df)
            stats = np.concatenate((seen, [-1, -2], df[seen], [n, tokens])).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([stats], pa.binary())], names=names)

    return rows.mapInArrow(run, f"_id {kind}, _bytes long, _hash long, _ids binary, _stats binary")


def corpus_of(encoded: DataFrame) -> Corpus:
    """One row a term of the vocabulary comes to the driver; -1 stands for documents, -2 for tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                terms, n = np.frombuffer(raw, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n)], names=["term", "n"])

    counts = encoded.where("_stats is not null").select("_stats").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    of = dict(zip(counts.column("term").to_pylist(), counts.column("n").to_pylist(), strict=True))
    n, tokens = of.pop(-1, 0), of.pop(-2, 0)
    df = np.zeros(max(of, default=0) + 1, np.int64)
    df[list(of)] = list(of.values())
    return Corpus(n, tokens / max(1, n), df)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json", window: int = 2048, end_id: int = 1, shard_bytes: int = 3 << 20) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text counts as empty: the end id alone. Rows that repeat are packed each
    for itself; a null id is kept. An empty table gives no rows. A long text is cut
    into as many windows as it needs. Equal scores go by id, then by a hash of id and
    text, so reruns agree. Other columns, whatever their names, are not read.
    """
    kind, spark = docs.schema[id_col].dataType.simpleString(), docs.sparkSession
    names = [id_col, *(n for n, _ in _FIELDS)]
    table = materialize(encode(docs, id_col, text_col, tokenizer, end_id), "packing-ids")
    known = spark.sparkContext.broadcast(corpus_of(table))
    encoded = table.where("_stats is null").select("_id", "_bytes", "_hash", "_ids")
    total = encoded.agg(F.sum("_bytes")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ShardKeys(known.value)
        for batch in batches:
            raw = batch.column(3).to_pylist()
            if raw:
                keys = key([_read(r) for r in raw], batch.column(2).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(keys), *batch.columns], names=["_key", "_id", "_bytes", "_hash", "_ids"])

    def keys_of(rows: DataFrame) -> DataFrame:
        return rows.mapInArrow(keyed, f"_key long, _id {kind}, _bytes long, _hash long, _ids binary")

    bounds = np.zeros(0, np.int64)
    if shards > 1:  # shares of a sample's bytes; which rows it has depends on their hashes alone
        every = max(1, known.value.n // min(_SAMPLES * shards, _MOST_SAMPLES))
        sample = keys_of(encoded.where(F.pmod(F.xxhash64("_hash"), F.lit(every)) == 0)).select("_key", "_bytes").toArrow().sort_by("_key")
        keys, upto = sample.column("_key").to_numpy(), np.cumsum(sample.column("_bytes").to_numpy())
        if len(keys):
            bounds = np.unique(keys[np.searchsorted(upto, upto[-1] * np.arange(1, shards) / shards)])
    cuts = spark.sparkContext.broadcast(bounds)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in keyed(batches):
            shard = np.searchsorted(cuts.value, batch.column(0).to_numpy(), "right")
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), *(batch.column(c) for c in (1, 3, 4))], names=["_shard", "_id", "_hash", "_ids"])

    rows = encoded.mapInArrow(dealt, f"_shard long, _id {kind}, _hash long, _ids binary")
    # Shards have like sizes and are dealt in turn, so partitions have, too.
    count = max(1, partitions(spark))
    rows = rows.repartitionById(count, (F.col("_shard") % count).cast("int")).sortWithinPartitions("_shard", "_id", "_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, tokens, held, sequence = None, [], [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal sequence
            pieces = pack_shard(tokens, window, known.value)
            base, sequence = (int(now) << 32) + sequence, sequence + pieces[-1][3] + 1
            columns = [
                pa.array([ids[p[0]] for p in pieces], id_type), pa.array([p[1] for p in pieces], pa.int64()), pa.array([p[2] for p in pieces], pa.int64()),
                pa.array([zlib.crc32(tokens[d][a : a + n]) for d, a, n, _, _ in pieces], pa.int64()), pa.array([len(tokens[p[0]]) for p in pieces], pa.int64()),
                pa.array([base + p[3] for p in pieces], pa.int64()), pa.array([p[4] for p in pieces], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            id_type = batch.column(1).type
            for shard, ident, raw in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                # Rows equal in id and text have one place in the order, however many they are: a shard that they swell is packed in parts.
                if tokens and (shard != now or held > 4 * shard_bytes):
                    yield close()
                    ids, tokens, held = [], [], 0
                if shard != now:
                    now, sequence = shard, 0
                ids.append(ident)
                tokens.append(_read(raw))
                held += len(raw) + 64
        if tokens:
            yield close()

    return rows.mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"`{n}` {t}" for n, t in _FIELDS))
