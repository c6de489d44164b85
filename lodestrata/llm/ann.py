"""Operator 4: approximate nearest neighbours by cross-polytope hashing.

A table rotates unit vectors by three rounds of random signs and a fast Hadamard
transform; a vector's bucket is the nearest signed axis of one polytope or, the more
vectors there are, of several (a partial one last), so that buckets hold about
``bucket`` vectors at any size. A query looks into its nearest buckets of each table;
their number grows with the root of the number of buckets, so the share of vectors
that a query meets falls as the table grows.

Buckets hold ids and vectors of one byte a component; each gives its nearest few a
query, and the best of all are compared exactly on the original vectors. Equal vectors
are indexed once and carry their smallest ids, so copies fill no bucket; buckets that
near copies overfill are cut into blocks after counting. Queries that find fewer than
``k`` are compared with all vectors, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, materialize, partitions

_ROUNDS, _SEED = 3, 11
_RERANK = 3  # exact comparisons a query and neighbour asked for


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotate(unit: np.ndarray, table: int) -> np.ndarray:
    """The pseudo-rotation of a table; rows are padded to a power of two."""
    n = 1 << max(1, (unit.shape[1] - 1).bit_length())
    x = np.zeros((len(unit), n))
    x[:, : unit.shape[1]] = unit
    signs = np.random.default_rng([_SEED, table]).choice([-1.0, 1.0], (_ROUNDS, n))
    for s in signs:
        x = hadamard(x * s)
    return x


def polytopes(n: int, dims: int, bucket: int) -> list[int]:
    """Numbers of axes of a table's polytopes, the last one partial, for n vectors of (padded) ``dims``."""
    out, left = [dims], n / (2 * dims * bucket)
    while left >= 2:
        out.append(min(dims, 1 << int(np.log2(left / 2))))
        left /= 2 * out[-1]
    return out


def nearest_buckets(unit: np.ndarray, table: int, shape: list[int], probes: int) -> np.ndarray:
    """The ``probes`` nearest buckets of each unit vector, nearest first."""
    cells, losses = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
    for k, axes in enumerate(shape):
        rotated = rotate(unit, table + (k << 16))[:, :axes]
        both = np.concatenate((rotated, -rotated), 1)
        near = np.argsort(-both, 1, kind="stable")[:, :probes]
        value = np.take_along_axis(both, near, 1)
        loss = (losses[:, :, None] + ((value[:, :1] - value) ** 2)[:, None, :]).reshape(len(unit), -1)
        cell = (cells[:, :, None] * (2 * axes) + near[:, None, :]).reshape(len(unit), -1)
        best = np.argsort(loss, 1, kind="stable")[:, :probes]
        cells, losses = np.take_along_axis(cell, best, 1), np.take_along_axis(loss, best, 1)
    return cells


def _units(x: np.ndarray) -> np.ndarray:
    # Scaled first: squares of very large or small components stay finite and positive.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v double[]) of the rows that take part: an id, finite components, not all zero.

    All vectors are to have one length; others than the most common one are left out.
    """
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.where(F.coalesce(fine, F.lit(False)))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (usual.d if usual else 0))


def _distinct(rows: DataFrame, copies: int) -> DataFrame:
    """(rep, ids, v): each vector once, as bytes, with its ``copies`` smallest ids."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list[int]] = {}
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault((np.array(v) + 0.0).tobytes(), []).append(i)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array([sorted(set(x))[:copies] for x in found.values()], pa.list_(pa.int64()))], names=["v", "ids"])

    some = rows.select("id", "v").mapInArrow(local, "v binary, ids array<long>")
    merged = some.groupBy("v").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, copies).alias("ids"))
    return merged.select(F.element_at("ids", 1).alias("rep"), "ids", "v")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(b, np.float64) for b in column.to_pylist()])


def _coded(x: np.ndarray) -> list[bytes]:
    """A scale, then one byte a component."""
    scale = np.abs(x).max(1, keepdims=True) / 127
    codes = np.rint(x / scale).astype(np.int8)
    return [s.tobytes() + c.tobytes() for s, c in zip(scale, codes, strict=True)]


def _decoded(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    raw = np.stack([np.frombuffer(b, np.uint8) for b in column.to_pylist()])
    return raw[:, 8:].view(np.int8) * np.ascontiguousarray(raw[:, :8]).view(np.float64)


def _candidates(index: DataFrame, queries: DataFrame, n: int, k: int, tables: int, probes: int, bucket: int, block: int, everything: bool) -> DataFrame:
    """(query_id, rep): the nearest few of what each query meets, in its buckets or in all blocks."""
    spark = index.sparkSession
    blocks = max(1, -(-n // block))

    def cells(x: np.ndarray, ids: np.ndarray, asks: bool) -> Iterator[np.ndarray]:
        """Groups of each vector, table by table; their last 16 bits tell the table."""
        if everything:
            every = np.broadcast_to(np.arange(blocks), (len(x), blocks))
            yield every if asks else (ids * 2654435761 % 4294967296 // 64 % blocks)[:, None]
            return
        unit = _units(x)
        shape = polytopes(n, 1 << max(1, (x.shape[1] - 1).bit_length()), bucket)
        looks = round(probes * np.sqrt(np.prod([2.0 * a for a in shape[1:]]))) if asks else 1
        for t in range(tables):
            yield nearest_buckets(unit, t, shape, looks) * 65536 + t

    def dealt(asks: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    part = batch.slice(start, 512)
                    x, ids = _matrix(part.column(1)), part.column(0).to_numpy()
                    codes = pa.array(_coded(x), pa.binary())
                    for group in cells(x, ids, asks):
                        rows = np.repeat(np.arange(len(x)), group.shape[1])
                        yield pa.RecordBatch.from_arrays([pa.array(group.reshape(-1)), pa.array(ids[rows]), codes.take(pa.array(rows))], names=["group", "id", "code"])

        return run

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ids = _matrix(batch.column(1)), batch.column(0).to_numpy()
            for group in cells(x, ids, False):
                of, number = np.unique(group, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(number)], names=["group", "n"])

    have, ask = index.select("rep", "v"), queries.select("id", "v")
    placed = have.mapInArrow(dealt(False), "group long, id long, code binary")
    asked = ask.mapInArrow(dealt(True), "group long, id long, code binary")
    # Buckets that near copies overfill are cut into blocks; a query goes to each of them.
    sizes = have.mapInArrow(counted, "group long, n long").groupBy("group").agg(F.sum("n").alias("n")).where(F.col("n") > 2 * block)
    hot = materialize(sizes.select("group", F.ceil(F.col("n") / block).cast("long").alias("parts")), "ann-hot")
    if hot.limit(1).count():
        placed = placed.join(hot, "group", "left").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1)))).drop("parts")
        asked = asked.join(hot, "group", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    else:
        placed, asked = placed.withColumn("part", F.lit(0).cast("long")), asked.withColumn("part", F.lit(0).cast("long"))
    rows = placed.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))
    rows = rows.repartition(partitions(spark), "group", "part").sortWithinPartitions("group", "part", "asks", "id").select("group", "part", "asks", "id", "code")

    def answer(rows: pa.Table) -> pa.RecordBatch | None:
        asks = rows.column("asks").to_numpy(zero_copy_only=False)
        m = int(asks.argmax()) if asks.any() else len(asks)  # vectors come first
        if m in (0, len(asks)):
            return None
        x, q = _decoded(rows.column("code").slice(0, m)), _decoded(rows.column("code").slice(m))
        ids = rows.column("id").to_numpy()
        near, far = [], []
        for a in range(0, len(q), 256):
            d = np.nan_to_num((x**2).sum(1) - 2 * (q[a : a + 256] @ x.T), nan=np.inf)
            keep = min(m, k + 1)
            best = np.argpartition(d, keep - 1, 1)[:, :keep]
            near.append(best.reshape(-1))
            far.append((np.take_along_axis(d, best, 1) + (q[a : a + 256] ** 2).sum(1, keepdims=True)).reshape(-1))
        asking = np.repeat(ids[m:], min(m, k + 1))
        return pa.RecordBatch.from_arrays([pa.array(asking), pa.array(ids[np.concatenate(near)]), pa.array(np.concatenate(far).astype(np.float32))], names=["query_id", "rep", "rough"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            group, part = table.column("group").to_numpy(), table.column("part").to_numpy()
            starts = np.concatenate(([0], np.flatnonzero((group[1:] != group[:-1]) | (part[1:] != part[:-1])) + 1)) if len(group) else np.zeros(0, int)
            for a, b in zip(starts, starts[1:], strict=False):
                if (out := answer(table.slice(int(a), int(b - a)))) is not None:
                    yield out
            held = table.slice(int(starts[-1])).combine_chunks() if len(starts) else None
        if held is not None and held.num_rows and (out := answer(held)) is not None:
            yield out

    found = rows.mapInArrow(run, "query_id long, rep long, rough float").groupBy("query_id", "rep").agg(F.min("rough").alias("rough"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("rough", "rep"))
    return found.withColumn("_r", best).where(F.col("_r") <= _RERANK * (k + 1)).select("query_id", "rep")


def _search(index: DataFrame, queries: DataFrame, n: int, k: int, tables: int, probes: int, bucket: int, block: int, everything: bool = False) -> DataFrame:
    """(query_id, rep, ids, score): candidates with their exact distances."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = np.sqrt(((_matrix(batch.column(3)) - _matrix(batch.column(4))) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score)], names=["query_id", "rep", "ids", "score"])

    found = _candidates(index, queries, n, k, tables, probes, bucket, block, everything)
    both = found.join(index.select("rep", "ids", "v"), "rep").join(queries.select(F.col("id").alias("query_id"), F.col("v").alias("_q")), "query_id")
    return both.select("query_id", "rep", "ids", "v", "_q").mapInArrow(exact, "query_id long, rep long, ids array<long>, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "rep"))
    # The k + 1 nearest distinct vectors hold the k nearest ids besides the query's own.
    ids = found.withColumn("_r", best).where(F.col("_r") <= k + 1).select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    ids = ids.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return ids.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = 10, tables: int = 12, probes: int = 8, bucket: int = 100, block: int = 2000) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean) of the k nearest found of each query.

    Queries are the rows whose id is divisible by ``every``. Rows with a null id,
    and vectors that are null, zero, of an unusual length or with null or non-finite
    components take no part. Ties go to the smaller id; a row that repeats whole
    counts once. Of an id with several vectors the first by its bytes asks, and its
    nearest one counts as a neighbour. With fewer than k candidates, all are given;
    without any, none. Other columns, whatever their names, are not read.
    """
    rows = usable(vectors, id_col, vector_col)
    index = materialize(_distinct(rows, k + 1), "ann-index")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([(np.array(v) + 0.0).tobytes() for v in batch.column(1).to_pylist()], pa.binary())], names=["id", "v"])

    queries = rows.where(F.col("id") % every == 0).select("id", "v").mapInArrow(packed, "id long, v binary")
    queries = materialize(queries.groupBy("id").agg(F.min("v").alias("v")), "ann-queries")
    n = index.count()
    first = materialize(_ranked(_search(index, queries, n, k, tables, probes, bucket, block), k), "ann-first")
    count = first.groupBy(F.col("query_id").alias("id")).count()
    # Candidates: all ids but the query's own.
    others = rows.select("id").distinct().count() - 1
    short = queries.join(count, "id", "left").where(F.coalesce("count", F.lit(0)) < min(k, others)).select("id", "v")
    short = materialize(short, "ann-short")
    if not short.limit(1).count():
        for table in (index, queries, short):
            discard(table)
        return first
    rest = _ranked(_search(index, short, n, k, 1, probes, bucket, block, everything=True), k)
    return first.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(rest)
