"""MinHash fingerprints of documents and near-duplicates by signature bands.

A signature holds, for each of ``HASHES`` universal hash functions, the smallest value over the
word shingles of the whole text. Two signatures agree in about the share of values that is the
Jaccard similarity of the shingle sets. Bands of signature values are joined in Spark, and what they
bring together is verified on the texts.

Defined results: null is an empty text; texts without words share one fingerprint (all values at
their maximum); repeated rows are handled one by one; rows without id come first in order of ids,
equal ids are in order of their texts; the next document of an only one is itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.ngram_join import close_lists, fingerprint
from clicktally.llm.store import stored
from clicktally.llm.words import BLANK_SEPARATED, mix, runs, shingles, slices
from clicktally.operators.joins import filtered_join

HASHES = 64
#: Values in a band: 16 bands of 4 find a pair of similarity 0.8 with a chance of 0.9998.
BAND = 4
SHINGLE = 5
#: Members of a band's list that are compared pair by pair; those of larger lists are ordered anew.
LIST_ACROSS = 64

_random = np.random.default_rng(41)
_A = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def signatures(column: pa.Array) -> np.ndarray:
    """A row of ``HASHES`` 32-bit values for every text."""
    return _signed(column)[0]


def _signed(column: pa.Array) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Signatures, and size and 128-bit hash of every shingle set."""
    parts, marks = [np.zeros((0, HASHES), dtype=np.uint32)], []
    for run in runs(column, BLANK_SEPARATED):
        sets = [found for _, found in shingles(run, SHINGLE)]
        marks += [(len(found), *fingerprint(found)) for found in sets]
        out = np.full((len(sets), HASHES), 0xFFFFFFFF, dtype=np.uint32)
        sizes = np.array([len(s) for s in sets])
        full = np.flatnonzero(sizes)
        if len(full):
            values = np.concatenate(sets)
            starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            for i in range(HASHES):
                out[full, i] = np.minimum.reduceat(((values * _A[i] + _B[i]) >> np.uint64(32)).astype(np.uint32), starts)
        parts.append(out)
    return np.concatenate(parts), marks


def _hex(table: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes().hex() for row in table.astype(">u4")], pa.string())


def _likeness(a: np.ndarray, b: np.ndarray) -> pa.Array:
    return pa.array((a == b).mean(axis=1))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the ``fingerprint`` of every document, in hexadecimal."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _hex(signatures(batch.column("text")))], ["doc_id", "fingerprint"]
            )

    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    return docs.mapInArrow(sign, "doc_id bigint, fingerprint string")


def _with_next(docs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Documents in ranges of ids, each sorted and followed by the first document of the next range.

    The rows of ``classes`` come before the documents of their id. Texts are moved once. The limits of the ranges, one per shuffle partition, are all that the driver sees.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lowest = -(1 << 63)
    docs = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(lowest)).alias("place"),
        F.col("doc_id").cast("bigint"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    shares = [i / n for i in range(1, n)] or [0.5]
    cuts = np.unique(np.array(docs.agg(F.percentile_approx("place", shares, 100 * n)).first()[0] or [], dtype=np.int64))

    def ranges(places: np.ndarray) -> np.ndarray:
        return np.searchsorted(cuts, places, "right").astype(np.int64)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.sort(batch.column("place").to_numpy())
            owner, first = np.unique(ranges(places), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(places[first])], ["range", "place"])

    lows = docs.select("place").mapInArrow(least, "range bigint, place bigint").groupBy("range").agg(F.min("place").alias("place"))
    lows = lows.toArrow().sort_by("range")  # a row per range
    firsts, owners = lows["place"].to_numpy(), lows["range"].to_numpy()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            places = batch.column("place").to_numpy()
            at = np.searchsorted(firsts, places)
            lead = (at < len(firsts)) & (firsts[np.minimum(at, len(firsts) - 1)] == places)
            guests = batch.filter(pa.array(lead))
            for rows, owner, guest in ((batch, ranges(places), False), (guests, owners[at[lead] - 1], True)):
                names = ["range", "guest", *batch.schema.names]
                columns = [pa.array(owner), pa.array(np.full(rows.num_rows, guest)), *rows.columns]
                yield pa.RecordBatch.from_arrays(columns, names)

    def deal_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner = pa.array(ranges(batch.column("place").to_numpy()))
            yield pa.RecordBatch.from_arrays([owner, *batch.columns], ["range", *batch.schema.names])

    dealt = docs.mapInArrow(deal, "range bigint, guest boolean, place bigint, doc_id bigint, text string")
    dealt = dealt.withColumn("class_id", F.lit(None).cast("bigint"))
    if classes is not None:
        named = classes.select(F.col("doc_id").alias("place"), "class_id").where("place IS NOT NULL")
        named = named.mapInArrow(deal_classes, "range bigint, place bigint, class_id bigint")
        dealt = dealt.unionByName(named.withColumn("guest", F.lit(False)), allowMissingColumns=True)
    return dealt.repartition(n, "range").sortWithinPartitions("range", "guest", "place", F.asc_nulls_last("class_id"), "text")


def edits(docs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Fingerprints of every document, of its text with the last quarter taken from the next document,
    and how alike it is to both.

    With ``classes``, one row of ``doc_id, class_id`` for each document whose class has another id, every
    document has its ``class_id`` too. They travel with the texts.
    """

    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """All rows but the last, which only serves as the next one."""
        own = rows.column("text").to_pylist()
        texts, edited = own[:-1], []
        for text, following in zip(texts, own[1:], strict=True):
            keep = len(text) - len(text) // 4
            edited.append(text[:keep] + following[: len(text) - keep])
        sign, after = signatures(rows.column("text")), signatures(pa.array(edited, pa.large_string()))
        mine = ~rows.column("guest").to_numpy(zero_copy_only=False)[:-1]
        batch = pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id").slice(0, len(texts)).combine_chunks(),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                _hex(sign[:-1]),
                _hex(after),
                _likeness(sign[:-1], after),
                _likeness(sign[:-1], sign[1:]),
                rows.column("class_id").slice(0, len(texts)).combine_chunks(),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id"],
        )
        yield batch.filter(pa.array(mine))

    def classed(batch: pa.RecordBatch, last: list) -> pa.RecordBatch:
        """The documents of a batch with the class that came last before them, if it is their id's."""
        known = batch.column("class_id").is_valid().to_numpy(zero_copy_only=False)
        place = np.concatenate([[last[0]], batch.column("place").to_numpy()])
        value = np.concatenate([[last[1]], batch.column("class_id").fill_null(0).to_numpy()])
        at = np.maximum.accumulate(np.concatenate([[0], np.where(known, np.arange(1, len(known) + 1), 0)]))
        last[:] = place[at[-1]], value[at[-1]]
        docs = batch.filter(pa.array(~known))
        own, at = docs.column("doc_id"), at[1:][~known]
        same = (place[at] == docs.column("place").to_numpy()) & own.is_valid().to_numpy(zero_copy_only=False)
        found = pa.array(np.where(same, value[at], own.fill_null(0).to_numpy()), mask=own.is_null().to_numpy(zero_copy_only=False))
        return docs.set_column(docs.schema.get_field_index("class_id"), "class_id", found)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, [-(1 << 63), -(1 << 63)]
        for batch in slices(batches, "text", 1 << 21):
            batch = classed(batch, last)
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            if table.num_rows > 1:
                yield from compare(table)
            held = table.slice(table.num_rows - 1)  # the last row of a range is a guest

    found = _with_next(docs, classes).mapInArrow(
        walk,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double, class_id bigint",
    )
    return found.drop("class_id") if classes is None else found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``class_id``, the smallest id that is reached by verified pairs of a band.

    Equal texts form a class first. A band that many share gives the pairs of one member with the
    others, then those between what is not yet together, so a large group costs its size. A common
    passage can bring a band to many texts that are not similar: of these only those are compared that
    share a rare shingle too, see ``ngram_join.close_lists``. Rows without
    id are kept, without a class; texts without words are in a class of their own.
    """
    every = docs.select(F.col("doc_id").cast("bigint"))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc"), "text").where("doc IS NOT NULL")

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Size and hash of every shingle set, and the keys of its signature's bands."""
        for batch in slices(batches, "text", 1 << 21):
            table, marks = _signed(batch.column("text"))
            keys = np.zeros((len(table), HASHES // BAND), dtype=np.uint64)
            for i in range(BAND):
                keys = mix(keys + table[:, i::BAND].astype(np.uint64) * _A[i])
            keys = mix(keys + _B[: HASHES // BAND])
            ends = np.arange(0, keys.size + 1, HASHES // BAND, dtype=np.int32)
            columns = [pa.array(x, pa.int64()) for x in zip(*marks, strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns, lists], ["doc", "n", "h1", "h2", "keys"])

    kind = "doc bigint, n bigint, h1 bigint, h2 bigint, keys array<bigint>"
    sets = stored(docs.mapInArrow(summarise, kind).where("n > 0"), "sets", compression="zstd")
    # equal sets have equal keys
    classes = stored(sets.groupBy("n", "h1", "h2").agg(F.min("doc").alias("rep"), F.first("keys").alias("keys")), "classes", compression="zstd")
    names = classes.select("n", "h1", "h2", "rep")
    member = stored(sets.select("doc", "n", "h1", "h2").join(names, ["n", "h1", "h2"]).select("doc", "rep").distinct(), "members")
    entries = classes.select(F.col("rep").alias("doc"), "n", F.explode("keys").alias("key")).distinct()
    shared = entries.groupBy("key").agg(F.count("*").alias("docs")).where("docs > 1")
    lists = stored(entries.join(shared.select("key"), "key", "left_semi").select("key", "doc", "n", F.col("n").alias("rest")), "bands")
    texts = stored(filtered_join(docs, lists.select("doc").distinct(), ["doc"], "left_semi", salts=1), "texts", compression="zstd")
    joined = close_lists(lists, texts, SHINGLE, rounds=1, most_across=LIST_ACROSS)
    found = member.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    classed = found.groupBy("doc").agg(F.min(F.coalesce("component", "rep")).alias("class_id"))
    return every.join(classed.withColumnRenamed("doc", "doc_id"), "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id")
    )
