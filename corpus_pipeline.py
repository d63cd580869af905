"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next.

Defined results of all stages: a null text is handled as an empty one and stays null; whole texts are
read, however long; rows without id are documents like any other; repeated rows all stay, but for those
that the second stage drops; all other columns, whatever their names, come through unchanged, but for
``n_chars``, which follows the text; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.llm import decontaminate, mixing, ngram_join, quality, secret_scan
from clicktally.llm.store import stored


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go: a score under ``quality.THRESHOLD``.

    Labels are learnt as in ``quality.fit``; without any, every score is 0.5 and all documents go. Equal
    texts have equal scores, so ties and repeated rows go or stay together.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(quality.statistics(docs), labels))


def _numbered(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """A number of its own for each different text of the ``ids`` that several rows have.

    The numbers lie beyond all ids, and are stored: a task that runs again can't change them.
    """
    texts = docs.join(ids, "doc_id", "left_semi").select("doc_id", _mark().alias("mark")).distinct()
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    beyond = F.monotonically_increasing_id()
    number = F.lit(high) + 1 + beyond if high < 1 << 62 else F.lit(low) - 1 - beyond
    return stored(texts.select("doc_id", "mark", number.cast("bigint").alias("number")), "numbers")


def _mark() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar word sequences the one with the smallest id stays.

    Documents without words are linked with nothing and stay, and so do rows without id. Rows of one id
    are documents of their own, by their texts: a row goes only if a row with a similar text stays. Of
    rows with the same id and text one stays, the first by all its columns.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1 AND doc_id IS NOT NULL").select("doc_id")
    ids = stored(ids, "repeated-ids")
    if ids.isEmpty():
        gone = ngram_join.jaccard_components(docs).where("doc_id <> component_id").select("doc_id")
        return docs.join(gone.distinct(), "doc_id", "left_anti").select(docs.columns)
    numbers = _numbered(docs, ids)
    single = docs.join(ids, "doc_id", "left_anti").select("doc_id", "text")
    several = docs.join(ids, "doc_id", "left_semi").select("doc_id", _mark().alias("mark"), "text")
    named = several.join(numbers, ["doc_id", "mark"]).select(F.col("number").alias("doc_id"), "text")
    found = ngram_join.jaccard_components(single.unionByName(named)).select(F.col("doc_id").alias("number"), "component_id").distinct()
    # of a component the smallest id stays, and of that the smallest mark
    found = found.join(numbers, "number", "left").select(
        "number", "component_id", F.coalesce("doc_id", "number").alias("doc_id"), F.coalesce("mark", F.lit("")).alias("mark")
    )
    found = stored(found.where("number IS NOT NULL"), "components")
    first = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
    gone = found.join(first, "component_id").where("first <> struct(doc_id, mark)").select("doc_id", "mark")
    rest = docs.join(ids, "doc_id", "left_anti").join(gone.where("mark = ''").select("doc_id"), "doc_id", "left_anti")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    texts = docs.join(ids, "doc_id", "left_semi").select("doc_id", _mark().alias("mark"), row.alias("row"))
    texts = texts.join(gone, ["doc_id", "mark"], "left_anti")
    one = texts.groupBy("doc_id", "mark").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
    return rest.select(docs.columns).unionByName(one)


def _counted(docs: DataFrame) -> DataFrame:
    """Texts may have changed: count their characters again."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; what is left of a document stays, if it is empty too.

    An item without words or id is no item; an empty benchmark changes nothing.
    """
    return _counted(decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; all documents stay. Spans that overlap are replaced as one."""
    return _counted(secret_scan.redact(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's slot in the mixture of sources, a row each, with the text and all other columns.

    A null source is the empty one; equal ids are placed one after the other. A column that has the name
    of one of the mixture comes through as ``given_`` and that name.
    """
    return mixing.mix(docs, carry=True)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
]

#: The stages learn, search and schedule: no SQL of their own. The tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
