"""Operator 1: document fingerprints by consistent weighted sampling.

A document is a set of word shingles weighted by how often they occur. For each of
``samples`` draws every term gets r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1), fixed by
the term and the draw; the term with the smallest a = c / (y e^r), where
y = exp(r (floor(ln w / r + b) - b)), is the sample, together with that floor. Two
documents agree in a sample with a chance equal to their generalised Jaccard
similarity, sum of minima over sum of maxima (Ioffe's improved scheme).

The variates come from a pool that is a fixed function of a seed: a term reads entry
``hash(term, draw)``. What is stored of a sample is a hash of term and floor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import partitions
from .words import byte_chunks, hash_words, mix, shingles

_POOL_BITS = 16
U = np.uint64


@lru_cache(maxsize=2)
def _pool(samples: int) -> tuple[np.ndarray, ...]:
    rng = np.random.default_rng(20240117)
    n = 1 << _POOL_BITS
    r, c, b = rng.gamma(2.0, 1.0, n), rng.gamma(2.0, 1.0, n), rng.random(n)
    ln_c = np.log(c)
    # For weight 1 the floor is 0, so ln a is a constant of the entry.
    unit = ln_c + r * b - r
    odd = mix(np.arange(1, samples + 1, dtype=U)) | U(1)
    return unit.astype(np.float32), r, ln_c, b, odd


def sample(terms: np.ndarray, samples: int) -> np.ndarray:
    """The signature of a bag of term hashes: ``samples`` 32-bit values; none for an empty bag."""
    if not len(terms):
        return np.zeros(0, np.uint32)
    unit, r, ln_c, b, odd = _pool(samples)
    terms = np.sort(terms)
    first = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1])))
    weights = np.diff(np.concatenate((first, [len(terms)])))
    terms = terms[first]
    shift = U(64 - _POOL_BITS)
    many = np.flatnonzero(weights > 1)
    ln_w = np.log(weights[many])[None, :]
    out = np.empty(samples, np.uint32)
    step = max(1, (1 << 18) // len(terms))
    for k in range(0, samples, step):
        at = (terms[None, :] * odd[k : k + step, None]) >> shift
        a = unit[at]
        floor = None
        if len(many):
            m = at[:, many]
            floor = np.floor(ln_w / r[m] + b[m])
            a[:, many] = ln_c[m] - r[m] * (floor - b[m]) - r[m]
        best = a.argmin(1)
        chosen = terms[best]
        if floor is not None:
            t = np.zeros(a.shape, np.int16)
            t[:, many] = floor
            chosen = chosen ^ mix(t[np.arange(len(best)), best].astype(np.int64).astype(U) * U(0x9E3779B97F4A7C15))
        out[k : k + step] = mix(chosen + odd[k : k + step]) >> U(32)
    return out


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Share of equal samples; two empty bags are alike (1), an empty and another are not (0)."""
    if len(x) == 0 or len(y) == 0:
        return float(len(x) == len(y))
    return float((x == y).mean())


def fingerprints(texts: list[bytes], samples: int, width: int) -> list[np.ndarray]:
    words, offsets = hash_words(texts)
    return [sample(shingles(words[a:b], width), samples) for a, b in zip(offsets, offsets[1:], strict=False)]


def _hex(x: np.ndarray) -> str:
    return x.astype(">u4").tobytes().hex()


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = 128, width: int = 5) -> DataFrame:
    """All columns of ``docs`` and ``fingerprint`` (hex; "" for a text without words). Map only."""
    at = docs.columns.index(text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(at).cast(pa.binary()).to_pylist()]
            for i, j in byte_chunks([len(t) for t in texts]):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([_hex(f) for f in fingerprints(texts[i:j], samples, width)], pa.string())], names=[*part.schema.names, "fingerprint"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(apply, schema + ", fingerprint string")


def _with_successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(bucket, id, text, own) by ascending bucket, id, text within partitions.

    Ids are cut into ranges of about equal counts. The first row of each range is
    also sent, as a row that is not its own, to the range before it (the first of
    all to the last), so every row finds its successor in its own range. The texts
    are shuffled once. Only the bounds, one pair a range, pass through the driver.
    Ids are integers.
    """
    n = max(2, partitions(docs.sparkSession))
    ids = docs.select(F.col(id_col).alias("_id"))
    parts = 4 * n  # several ranges a partition, so that partitions even out
    cuts = np.unique(ids.where("_id is not null").approxQuantile("_id", [i / parts for i in range(1, parts)], 0.2 / parts)).astype(np.int64)

    def range_of(values: pd.Series) -> np.ndarray:
        known = values.notna().to_numpy()
        # Null ids come first, in the first range; a cut is the first id of its range.
        return np.where(known, np.searchsorted(cuts, values.fillna(0).to_numpy().astype(np.int64), "right"), 0).astype(np.int32)

    bucket = F.pandas_udf(lambda values: pd.Series(range_of(values)), "int")
    least = F.min(F.struct(F.col("_id").isNotNull().alias("known"), F.col("_id").alias("id")))
    firsts = sorted((r.b, r.v.id) for r in ids.withColumn("b", bucket("_id")).groupBy("b").agg(least.alias("v")).collect())
    before = {b: (first, firsts[i - 1][0]) for i, (b, first) in enumerate(firsts)}

    @F.pandas_udf("array<int>")
    def ranges(values: pd.Series) -> pd.Series:
        """A row's own range; then, for the first id of it, the range before as well."""
        out = []
        for value, b in zip(values, range_of(values).tolist(), strict=True):
            first, previous = before[b]
            out.append([b, previous] if (pd.isna(value) if first is None else value == first) else [b])
        return pd.Series(out)

    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), ranges(F.col(id_col)).alias("_to"))
    # Several rows may share the first id; the reader keeps the first that it gets.
    rows = rows.select("_id", "_text", F.posexplode("_to").alias("_copy", "_bucket")).withColumn("_own", F.col("_copy") == 0)
    # A row sent back follows all rows of its new range, whatever its id.
    return rows.repartition(n, "_bucket").sortWithinPartitions("_bucket", F.col("_own").desc(), F.col("_id").asc_nulls_first(), F.sha2("_text", 256))


def edit(text: str, after: str) -> str:
    """The last quarter of ``text`` replaced by as many of the first code points of ``after``."""
    k = len(text) // 4
    return text[: len(text) - k] + after[:k]


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = 128, width: int = 5) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness to it and to its successor.

    Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. A null text counts as empty. Rows that share an id
    follow each other by the digest of their texts; null ids come first. A single
    row is its own successor; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def emit(rows: list[tuple], prints: list[np.ndarray]) -> pa.RecordBatch:
        """rows: (id, text, text of the successor); prints: of the texts, then one more of the last successor."""
        edited = [edit(t, s) for _, t, s in rows]
        data = [e.encode() for e in edited]
        other = fingerprints(data, samples, width)
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], id_type), pa.array([len(r[1]) for r in rows], pa.int64()),
            pa.array([hashlib.sha256(d).hexdigest() for d in data]), pa.array([_hex(p) for p in prints[:-1]]), pa.array([_hex(p) for p in other]),
            pa.array([likeness(p, q) for p, q in zip(prints, other, strict=False)], pa.float64()), pa.array([likeness(p, q) for p, q in zip(prints, prints[1:], strict=False)], pa.float64()),
        ], names=names)

    id_type = {"bigint": pa.int64(), "int": pa.int32()}[kind]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows whose successors are not all known yet
        size, now, closed = 0, None, False

        def flush(keep_last: bool):
            nonlocal held, size
            rows = [(i, t, s) for (i, t), (_, s) in zip(held, held[1:], strict=False)]
            prints = fingerprints([t.encode() for _, t in held], samples, width)
            held = held[-1:] if keep_last else []
            size = 0
            return emit(rows, prints)

        for batch in batches:
            for bucket, ident, text, own in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if bucket != now:
                    now, closed, held, size = bucket, False, [], 0
                if closed:
                    continue
                held.append((ident, text))
                size += len(text)
                if not own:  # the successor of the range's last row
                    yield flush(False)
                    closed = True
                elif size > 1 << 20 and len(held) > 1:
                    yield flush(True)

    return _with_successors(docs, id_col, text_col).select("_bucket", "_id", "_text", "_own").mapInArrow(walk, f"`{id_col}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
