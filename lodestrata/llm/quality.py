"""Operator 2: quality by nearest-neighbour voting over latent-semantic vectors.

A bounded sample of labelled documents is turned into TF-IDF vectors over hashed
terms, reduced by a truncated SVD, and broadcast (at most ``max_labelled`` vectors
of ``dims`` floats, and one projection matrix: a few MB whatever the corpus).
Every document is projected the same way; exact cosine products with all labelled
vectors are computed block by block, and the ``neighbours`` most similar vote with
their similarity as weight.

Terms are hashed byte trigrams of the lower-cased text, four-grams of character
classes, and bins of how often words and lines repeat. Only the text is used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .words import _LOWER, byte_chunks, text_chunks

_LEX, _BINS, _BIN_KINDS = 2048, 16, 5
#: Character classes: space, line break, lower, upper, digit, stop, other mark, non-ASCII.
_CLASSES = bytes(0 if b == 32 else 1 if b in (9, 10, 11, 12, 13) else 2 if 97 <= b <= 122 else 3 if 65 <= b <= 90 else 4 if 48 <= b <= 57 else 5 if b in (33, 44, 46, 63) else 6 if b < 128 else 7 for b in range(256))
_SHAPE = 8**4
WIDTH = _LEX + _SHAPE + _BINS * _BIN_KINDS
#: Weights of the three blocks of terms, each of unit length before.
_BLOCKS = ((0, _LEX, 0.5), (_LEX, _LEX + _SHAPE, 1.0), (_LEX + _SHAPE, WIDTH, 1.6))


def _bin(x: float) -> int:
    return min(_BINS - 1, max(0, int(x * _BINS)))


def features(text: bytes) -> np.ndarray:
    """Term frequencies, damped by log(1 + tf), of one whole text."""
    out = np.zeros(WIDTH, np.float32)
    if not text:
        return out
    raw = np.frombuffer(text.translate(_LOWER), np.uint8)
    if len(raw) >= 3:
        b = raw.astype(np.uint32)
        h = ((b[:-2] << 16) | (b[1:-1] << 8) | b[2:]) * np.uint32(0x9E3779B1)
        out[:_LEX] = np.bincount(h >> np.uint32(21), minlength=_LEX)
    if len(raw) >= 4:
        c = np.frombuffer(text.translate(_CLASSES), np.uint8).astype(np.uint16)
        out[_LEX : _LEX + _SHAPE] = np.bincount((c[:-3] << 9) | (c[1:-2] << 6) | (c[2:-1] << 3) | c[3:], minlength=_SHAPE)
    words, lines = text.split(), text.split(b"\n")
    n = len(words)
    same = sum(map(bytes.__eq__, words, words[1:])) / max(1, n - 1)
    base = _LEX + _SHAPE
    # Shares of distinct words (against the root of n, as texts reuse words), equal neighbours, repeated lines; length; word length.
    for kind, x in enumerate((len(set(words)) / max(1.0, n**0.9) / 1.25, same, 1 - len(set(lines)) / len(lines), np.log1p(n) / 10, len(text) / max(1, n) / 16)):
        out[base + kind * _BINS + _bin(x)] = 1
    return np.log1p(out)


def _normalise(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """IDF weights, then unit length by block of terms; in place, some rows at a time."""
    for i in range(0, len(x), 256):
        part = x[i : i + 256]
        part *= idf
        for a, b, w in _BLOCKS:
            norm = np.linalg.norm(part[:, a:b], axis=1, keepdims=True)
            part[:, a:b] *= w / np.maximum(norm, 1e-12)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Model:
    """IDF, projection, and the labelled vectors with their labels."""

    def __init__(self, x: np.ndarray, y: np.ndarray, dims: int, neighbours: int):
        """``x``: term frequencies in single precision, overwritten here, as the driver has no room for copies."""
        n = len(x)
        self.idf = np.log((1 + n) / (1 + np.count_nonzero(x, axis=0))).astype(np.float32) + 1 if n else np.ones(WIDTH, np.float32)
        self.labels, self.neighbours = y.astype(np.float32), max(1, min(neighbours, n))
        self.prior = float(y.mean()) if n else 0.5
        x = _normalise(x, self.idf)
        dims = min(dims, max(1, n))
        # Randomised subspace iteration with a fixed seed: the same sample gives the same model.
        q = np.random.default_rng(7).standard_normal((WIDTH, min(WIDTH, dims + 16))).astype(np.float32)
        for _ in range(4):
            q, _r = np.linalg.qr(x.T @ (x @ q)) if n else (q, None)
        if n:
            _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
            q = q @ vt.T[:, :dims]
        self.projection = np.ascontiguousarray(q, np.float32)
        self.vectors = _unit(x @ self.projection)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by similarity."""
        if not len(self.labels):
            return np.full(len(x), self.prior)
        sims = _unit(_normalise(x.copy(), self.idf) @ self.projection) @ self.vectors.T
        k = self.neighbours
        # The k nearest; of those as near as the last one, the first in the sample's order.
        last = -np.partition(-sims, k - 1, axis=1)[:, k - 1 : k]
        near, level = sims > last, sims == last
        level &= np.cumsum(level, 1) <= k - near.sum(1, keepdims=True)
        top = np.nonzero(near | level)[1].reshape(len(sims), k)
        w = np.maximum(np.take_along_axis(sims, top, 1), 0).astype(np.float64) ** 4
        total = w.sum(1)
        return np.where(total > 0, (w * self.labels[top]).sum(1) / np.maximum(total, 1e-300), self.prior).clip(0, 1)


def held_out(id_col: str):
    """Rows kept from learning: crc32 of the id's text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = 4000, dims: int = 64, neighbours: int = 15) -> Model:
    """Learn from at most ``max_labelled`` labelled rows that are not held out.

    The sample is the rows with the smallest hashes of their ids, so reruns
    agree. Its texts, not the corpus, reach the driver, as sparse features.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).alias("_y"))
    sample = known.orderBy(F.xxhash64(id_col), id_col).limit(max_labelled)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t or b"") for t in batch.column(0).cast(pa.binary()).to_pylist()]
            at = [np.flatnonzero(r).astype(np.uint16) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes() for a in at], pa.binary()), pa.array([r[a].tobytes() for r, a in zip(rows, at, strict=True)], pa.binary()), batch.column(1).cast(pa.int32()), batch.column(2)], names=["at", "value", "y", "k"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(id_col, text_col).join(F.broadcast(sample), id_col).select(text_col, "_y", id_col).mapInArrow(featurise, f"at binary, value binary, y int, k {kind}")
    # Of rows that share an id one is learnt from, so the driver gets max_labelled rows at most.
    rows = found.groupBy("k").agg(F.min(F.struct("at", "value", "y")).alias("r")).select("k", "r.*").collect()
    rows.sort(key=lambda r: r.k)
    x, y = np.zeros((len(rows), WIDTH), np.float32), np.array([1 if r.y > 0 else 0 for r in rows])
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r.at, np.uint16)] = np.frombuffer(r.value, np.float32)
    del rows
    return Model(x, y, dims, neighbours)


def _scored(docs: DataFrame, model: Model, carried, text_col: str, threshold: float, only_good: bool) -> DataFrame:
    """(row, score, predicted): ``carried`` is a column that goes along as it is."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(carried.alias("row"), F.col(text_col).alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for a, _, raw in text_chunks(batch.column(1)):
                for i, j in byte_chunks([len(t) + 4000 for t in raw]):
                    s = m.score(np.stack([features(t) for t in raw[i:j]]))
                    out = pa.RecordBatch.from_arrays([batch.column(0).slice(a + i, j - i), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["row", "score", "predicted"])
                    yield out.filter(pa.array(s >= threshold)) if only_good else out

    schema = StructType([StructField("row", rows.schema["row"].dataType), StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return rows.mapInArrow(apply, schema)


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of docs, then score double and predicted int (score >= threshold).

    A null or empty text has no terms; it gets the share of label 1 in the
    sample. Without any labelled row every score is 0.5. Long texts are scored
    whole; an empty table gives no rows.
    """
    found = _scored(docs, model, F.struct(*columns), text_col, threshold, False)
    return found.select("row.*", "score", "predicted")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is at least the threshold, with all their columns.

    Nulls, repeats and empty tables as in :func:`score_documents`; extra columns may
    have any names and types.
    """
    return _scored(docs, model, F.struct("*"), text_col, threshold, True).select("row.*")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """id, held_out, score, predicted for every row of ``docs``.

    Repeated rows stay repeated and score alike; equally similar neighbours beyond
    the last place are left out by their order in the sample, which is by id; a null
    id was never learnt from and counts as held out. Other columns are not read. Votes
    weigh the fourth power of the similarity.
    """
    model = fit(docs, labels, id_col, text_col, **options)
    return score_documents(docs, model, text_col, threshold, (id_col,)).select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")
