"""The registered queries of this package: one ``opN_<name>`` for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann as _ann
from . import fingerprints as _fingerprints
from . import jaccard as _jaccard
from . import licenses as _licenses
from . import mixing as _mixing
from . import oracles as _oracles
from . import packing as _packing
from . import pii as _pii
from . import quality as _quality
from . import substring as _substring
from . import token_counts as _token_counts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fingerprints.edited_pairs(_table(spark, sf_dir, "documents"))


def op2_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_pii_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pii.find_pii(_table(spark, sf_dir, "documents"))


def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ann.nearest(_table(spark, sf_dir, "embeddings"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixing.mix(_table(spark, sf_dir, "documents"))


def op7_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _substring.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op9_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packing.pack(_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_counts.token_counts(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_weighted_fingerprints": op1_weighted_fingerprints,
    "op2_quality_neighbours": op2_quality_neighbours,
    "op3_pii_offsets": op3_pii_offsets,
    "op4_cross_polytope": op4_cross_polytope,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_source_mix": op6_source_mix,
    "op7_repeated_windows": op7_repeated_windows,
    "op8_license_scan": op8_license_scan,
    "op9_retrieval_packing": op9_retrieval_packing,
    "op10_token_counts": op10_token_counts,
}

#: The others hold trained models, BPE, hash order or the method's own spans, which SQL cannot give.
ORACLE_SQL: dict[str, str] = {
    "op5_ngram_jaccard": _oracles.NGRAM_JACCARD,
    "op7_repeated_windows": _oracles.REPEATED_WINDOWS,
}
