"""The masking pass over messages, and the summary of what a scan found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import name_from_address
from ..functions.privacy import MASKED_DOMAIN, leak_scan, mask_addresses, mask_name, pseudonym, redact_contact
from .incremental import pending
from .stats import real_names

TEXTS = ("msgid", "in_reply_to", "subject", "body", "body_html")


def override_key(c: Column) -> Column:
    """Keys of the override table: lower case, " at " as "@"."""
    return F.regexp_replace(F.lower(F.trim(c)), " at ", "@")


def read_overrides(spark, path: str) -> DataFrame:
    """(key, override) of a JSON object of names; keys that begin with "_" are notes."""
    text = spark.read.text(path, wholetext=True)
    pairs = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "override"))
    return pairs.where(~F.col("key").startswith("_")).select(override_key(F.col("key")).alias("key"), "override")


def resolve_names(messages: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """``messages`` with from_name: an override, else the sender's best-known real name, else one from the address."""
    rows = messages.withColumn("_key", override_key(F.coalesce("from_email", F.lit(""))))
    known = real_names(rows.where(~F.col("from_name").contains("@")), "_key", "from_name", "id").withColumnRenamed("from_name", "_known")
    rows = rows.join(known, "_key", "left")
    if overrides is not None:
        rows = rows.join(overrides.select(F.col("key").alias("_key"), F.col("override").alias("_over")), "_key", "left")
    else:
        rows = rows.withColumn("_over", F.lit(None).cast("string"))
    own = F.when((F.coalesce("from_name", F.lit("")) != "") & ~F.col("from_name").contains("@"), F.col("from_name"))
    derived = F.when(F.col("_key") != "", name_from_address(F.col("_key")))
    return rows.withColumn("from_name", F.coalesce("_over", own, "_known", derived, "from_name")).select(messages.columns)


def obfuscate(messages: DataFrame, salt: str, overrides: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pending rows with names resolved, addresses masked, contact details redacted, and marked as done.

    Ids go through the same mask, so reply links still join. Marked rows stay as they are.
    """
    done = messages.where(F.coalesce("obfuscated", F.lit(0)) != 0) if "obfuscated" in messages.columns else messages.limit(0)
    rows = resolve_names(pending(messages), overrides)
    for c in TEXTS:
        if c in rows.columns:
            masked = mask_addresses(F.col(c), salt, keep)
            rows = rows.withColumn(c, redact_contact(masked) if c in ("body", "body_html") else masked)
    key = override_key(F.col("from_email"))
    masked_email = F.when(key.endswith("@" + MASKED_DOMAIN) | key.isin(*keep, ""), F.col("from_email")).otherwise(pseudonym(key, salt))
    rows = rows.withColumn("from_email", masked_email).withColumn("from_name", mask_name(F.col("from_name"), salt, keep)).withColumn("obfuscated", F.lit(1))
    return rows.unionByName(done.withColumn("obfuscated", F.lit(1)) if "obfuscated" not in done.columns else done.withColumn("obfuscated", F.col("obfuscated").cast("int")))


def leak_summary(rows: DataFrame, key: str, columns: list[str], keep: tuple[str, ...] = (), examples: int = 20) -> DataFrame:
    """(severity, n, n_distinct, examples): how much a scan found, with the first few distinct matches."""
    found = leak_scan(rows, key, columns, keep)
    counts = found.groupBy("severity").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("match").alias("n_distinct"))
    first = found.where("severity = 'leak'").select("severity", "match").distinct().orderBy("match").limit(examples)
    first = first.unionByName(found.where("severity = 'prose'").select("severity", "match").distinct().orderBy("match").limit(examples))
    return counts.join(first.groupBy("severity").agg(F.array_sort(F.collect_list("match")).alias("examples")), "severity", "left")
