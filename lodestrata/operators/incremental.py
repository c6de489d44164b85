"""Incremental tables: first writer wins, vaults, manifests, checkpoints, partition refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def first_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key, the first by ``order``; rows with a null key are all kept.

    The first row is found by an aggregation with map-side combining, so a key that
    holds much of the table is no hot group.
    """
    rest = [c for c in rows.columns if c != key]
    place = F.struct(*order)
    best = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rest), place).alias("_r"))
    kept = best.select(*[F.col(c) if c == key else F.col("_r")[c].alias(c) for c in rows.columns])
    return kept.unionByName(rows.where(F.col(key).isNull()))


def insert_or_ignore(target: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows of ``new`` that would be added: first of their key, and the key not in the target."""
    fresh = first_wins(new, key, order)
    return fresh.join(target.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti").select(new.columns)


def common_columns(a: DataFrame, b: DataFrame, but: tuple[str, ...] = ("id",)) -> list[str]:
    return [c for c in a.columns if c in b.columns and c not in but]


def vault_restore(build: DataFrame, vault: DataFrame | None, key: str) -> DataFrame:
    """The build table with the vault's rows whose key it lacks; itself without a vault."""
    if vault is None:
        return build
    cols = common_columns(build, vault)
    missing = vault.select(cols).join(build.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return build.unionByName(missing.select(cols), allowMissingColumns=True)


def not_in(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is NOT IN the known keys, with SQL's nulls.

    A null among the known keys lets nothing through; a null key of a row passes only
    an empty list. That question is one aggregate row; the rest is an ordinary anti
    join on the key, so nothing is compared pair by pair.
    """
    facts = known.agg(F.count(F.lit(1)).alias("_n"), F.count(key).alias("_k"))
    rest = rows.join(known.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    allowed = (F.col("_n") == 0) | ((F.col("_n") == F.col("_k")) & F.col(key).isNotNull())
    return rest.join(F.broadcast(facts)).where(allowed).select(rows.columns)


def vault_sync(build: DataFrame, vault: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(rows to append, their number); nothing to write when the number is 0."""
    new = materialize(not_in(build.select(common_columns(build, vault)), vault, key), "vault-new")
    return new, new.count()


def manifest_diff(old: DataFrame, new: DataFrame, key: str, sig: str) -> DataFrame:
    """(key, status): new, gone, changed or unchanged."""
    o, n = old.select(key, F.col(sig).alias("_o"), F.lit(True).alias("_in_o")), new.select(key, F.col(sig).alias("_n"), F.lit(True).alias("_in_n"))
    status = F.when(F.col("_in_o").isNull(), "new").when(F.col("_in_n").isNull(), "gone").when(F.col("_o").eqNullSafe(F.col("_n")), "unchanged").otherwise("changed")
    return o.join(n, key, "full_outer").select(key, status.alias("status"))


def orphans(present: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """What is there but not expected."""
    return present.join(expected.select(key).distinct(), key, "left_anti")


def contiguous_checkpoint(results: DataFrame, group: str, seq: str, ok: str, last: Column | int = 0) -> DataFrame:
    """(group, seen, added, checkpoint): the last number before the first failure above ``last``.

    Without a failure it is the largest number seen; with one at the start, ``last``.
    """
    rows = results.where(F.col(seq) > last)
    facts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("seen"), F.count(F.when(F.col(ok), 1)).alias("added"), F.min(F.when(~F.col(ok), F.col(seq))).alias("_bad"))
    good = rows.join(facts, group).where(F.col("_bad").isNull() | (F.col(seq) < F.col("_bad"))).groupBy(group).agg(F.max(seq).alias("checkpoint"))
    return facts.join(good, group, "left").select(group, "seen", "added", F.coalesce("checkpoint", F.lit(last) if isinstance(last, int) else last).alias("checkpoint"))


def reset_checkpoint(state: DataFrame, current: DataFrame, folder: str = "folder") -> DataFrame:
    """last_uid of each folder; 0 where validity, host or account have changed, or nothing is known."""
    s = state.select(folder, F.struct("uidvalidity", "host", "account").alias("_s"), "last_uid")
    c = current.select(folder, F.struct("uidvalidity", "host", "account").alias("_c"))
    return c.join(s, folder, "left").select(folder, F.when(F.col("_s") == F.col("_c"), F.col("last_uid")).otherwise(0).alias("last_uid"))


def refresh_partition(target: DataFrame, new: DataFrame, month: str, source: str = "list", order: tuple[str, ...] = ()) -> DataFrame:
    """The target with the (month, source) part replaced; other sources stay, known ids are ignored.

    Of new rows that share an id the first in the order of ingest stays; without
    ``order`` that is the order of all their columns, so reruns agree.
    """
    order = order or tuple(c for c, kind in new.dtypes if "map<" not in kind and c != "msgid")
    mine = F.coalesce((F.col("month") == month) & (F.col("source") == source), F.lit(False))
    rest = target.where(~mine)
    return rest.unionByName(insert_or_ignore(rest, new, "msgid", list(order)), allowMissingColumns=True)


def pending(rows: DataFrame, marker: str = "obfuscated") -> DataFrame:
    """Rows that a pass has not marked yet; all of them where the marker column is missing."""
    return rows.where(F.coalesce(F.col(marker), F.lit(0)) == 0) if marker in rows.columns else rows


def changed_rows(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of ``after`` in which any of the columns differs, nulls compared as values."""
    b = before.select(key, *[F.col(c).alias(f"_b_{c}") for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    return after.join(b, key).where(~same).select(after.columns)


def numbered_parts(rows: DataFrame, order: list[str] | list[Column], size: int) -> DataFrame:
    """``rows`` with ``part`` from 1, ``size`` rows a part in order.

    Ranks come from counts of sorted partitions, not from one window over all rows.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    ranged = materialize(ranged, "parts")
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    before = counts.select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) + F.col("_before")
    return ranged.join(F.broadcast(before), "_p").withColumn("part", F.ceil(rank / size).cast("long")).select(*rows.columns, "part")
