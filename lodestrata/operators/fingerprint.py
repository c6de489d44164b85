"""Content fingerprints: a sum of row digests that no order of rows changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LIMBS, _MASK = 8, 0xFFFFFFFF


def _field(c: Column, kind: str) -> Column:
    """Type tag, length of eight bytes, bytes; a null is a tag of its own."""
    data = c if kind == "binary" else c.cast("string").cast("binary")
    size = F.unhex(F.lpad(F.hex(F.octet_length(data)), 16, "0"))
    tagged = F.concat(F.lit(b"B" if kind == "binary" else b"S"), size, data)
    return F.when(c.isNull(), F.lit(b"N\x00")).otherwise(tagged)


def row_digest(rows: DataFrame, columns: list[str]) -> Column:
    """SHA-256 in hex of the columns that the table has, unambiguous in order and type."""
    kinds = dict(rows.dtypes)
    return F.sha2(F.concat(*[_field(F.col(c), kinds[c]) for c in columns if c in kinds]), 256)


def content_fingerprint(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the sum of all row digests modulo 2**256, as 64 hex digits.

    Eight limbs of 32 bits are summed as longs (exact for 2**31 rows and, with the
    carries, beyond through decimals) and carried once in the end.
    """
    digests = rows.select(row_digest(rows, columns).alias("d"))
    limbs = [F.coalesce(F.sum(F.conv(F.substring("d", 57 - 8 * i, 8), 16, 10).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"l{i}") for i in range(_LIMBS)]
    out = digests.agg(*limbs)
    carry, words = F.lit(0).cast("decimal(38,0)"), []
    for i in range(_LIMBS):
        total = F.col(f"l{i}") + carry
        name = f"w{i}"
        out = out.withColumn(f"t{i}", total.cast("decimal(38,0)"))
        out = out.withColumn(name, F.lpad(F.lower(F.hex((F.col(f"t{i}") % (_MASK + 1)).cast("long"))), 8, "0"))
        carry = ((F.col(f"t{i}") - F.col(f"t{i}") % (_MASK + 1)) / F.lit(_MASK + 1)).cast("decimal(38,0)")
        words.insert(0, name)
    return out.select(reduce(lambda a, b: F.concat(a, b), [F.col(w) for w in words]).alias("fingerprint"))


def attachment_fingerprint_rows(attachments: DataFrame) -> DataFrame:
    """Attachments with the digest of their content in place of it."""
    cid = F.col("cid") if "cid" in attachments.columns else F.lit(None).cast("string")
    return attachments.select("url", "filename", "content_type", F.sha2("content", 256).alias("content_sha"), cid.alias("cid"))


def ordered_signature(rows: DataFrame, group: str, order: list[str], fields: list[str], version: str = "1") -> DataFrame:
    """(group, sig): digest of a group's fields in order; any change of content or order changes it.

    Row digests are combined per group; rows of a group are bounded by a thread's length.
    """
    digest = row_digest(rows, fields)
    parts = rows.select(group, F.struct(*order, digest.alias("_d")).alias("_o"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("_o")), lambda o: o["_d"]), "\x1f")
    return parts.groupBy(group).agg(F.sha2(F.concat(F.lit(version + "\x00"), joined), 256).alias("sig"))
