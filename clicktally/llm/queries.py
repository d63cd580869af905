"""The registered queries of this package: operators at production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.llm import (
    alignment,
    decontaminate,
    filter_audit,
    fingerprints,
    html_extract,
    language,
    license_scan,
    mixing,
    ngram_join,
    packing,
    quality,
    secret_scan,
    sql,
    url_filter,
)
from clicktally.llm.store import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component it is linked into by similar shingle sets."""
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score."""
    measured = stored(quality.statistics(_table(spark, sf_dir, "documents")), "statistics")
    return quality.score(measured, quality.fit(measured, _table(spark, sf_dir, "labels")))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the secrets in it."""
    return secret_scan.report(_table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside that of its edited text and of the next document, and its class
    of near-duplicates."""
    docs = _table(spark, sf_dir, "documents")
    classes = fingerprints.near_duplicates(docs).where("class_id <> doc_id").distinct()
    return fingerprints.edits(docs, classes)


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licences it names."""
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its leading language."""
    docs = _table(spark, sf_dir, "documents")
    return language.predict(docs, language.learn(docs))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the mixture of sources."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that occur in it."""
    found = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters does at every place of every order, per language."""
    return filter_audit.interactions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of 1024 tokens."""
    packed = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two tokenizers, aligned."""
    return alignment.align(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_quality": op2_quality,
    "op3_secret_scan": op3_secret_scan,
    "op4_fingerprints": op4_fingerprints,
    "op5_html_extract": op5_html_extract,
    "op6_url_filter": op6_url_filter,
    "op7_license_scan": op7_license_scan,
    "op8_language": op8_language,
    "op9_mixing": op9_mixing,
    "op10_decontaminate": op10_decontaminate,
    "op11_filter_audit": op11_filter_audit,
    "op12_packing": op12_packing,
    "op13_alignment": op13_alignment,
}

ORACLE: dict[str, str] = dict(sql.ORACLE)
