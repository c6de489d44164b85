"""The corpus pipeline: quality, near duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir), is written as Parquet below the shared
folder, and is read again as the next one's ``docs``. All but the last return the
columns of ``documents``.

In every stage null and empty texts are defined (see each operator), texts are taken
whole, repeated rows are judged alike, an empty table gives no rows, and extra columns
go along whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm import jaccard, mixing, packing, pii, quality
from lodestrata.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3; labels come from sf_dir, texts to learn from docs."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of their five-word shingles."""
    return jaccard.keep_one(docs, width=5, num=80, den=100)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` follows."""
    return pii.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each_group),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: A trained classifier and BPE encoding have no SQL; the tests hold run() against plain Python.
ORACLE_SQL: str | None = None
