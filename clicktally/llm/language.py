"""Languages of documents as mixtures: expectation-maximisation over hashed n-gram likelihoods.

Each language is a distribution over ``BUCKETS`` hashed byte trigrams of letters, counted over all
documents that have a language and are not held out. A document is a mixture of languages: EM
estimates its proportions, and of the sets of its leading languages the one with the best penalised
likelihood is taken. The prediction is the language with the largest share in that set, and the score
is its share.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text
if nothing can be learnt; null and empty languages are not learnt; a row without id is not held out;
repeated rows count and are predicted one by one; ties go to the first language in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.quality import fold
from clicktally.llm.words import _LOWER, mix, raw, slices

BUCKETS = 2048
#: EM steps for each set of languages.
STEPS = 10
#: Price of one more language, in units of the log of the number of trigrams. Trigrams overlap, so
#: it is above the half that independent ones would ask for.
PENALTY = 3.0

_BLOCK_DOCS, _BLOCK_BYTES = 256, 1 << 20
_LETTER = np.zeros(256, dtype=np.uint64)  # one number per letter byte, 0 for all that parts words
_LETTER[list(range(97, 123)) + list(range(0x80, 0x100))] = np.arange(1, 155)
_LETTER = _LETTER[_LOWER]


def _trigrams(column: pa.Array) -> Iterator[np.ndarray]:
    """Counts of hashed trigrams, a row per document, for some documents at a time."""
    data, offsets = raw(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + _BLOCK_BYTES, "left"))
        stop = max(row + 1, min(rows, stop, row + _BLOCK_DOCS))
        low, high = offsets[row], offsets[stop]
        letters = _LETTER[data[low:high]]
        letters = np.concatenate([[0], letters, [0]]).astype(np.uint64)
        middle = letters[1:-1] > 0
        left, right, cuts = letters[:-2].copy(), letters[2:].copy(), offsets[row : stop + 1] - low
        left[cuts[cuts < high - low]] = 0
        right[cuts[cuts > 0] - 1] = 0
        gram = (left << np.uint64(16)) | (letters[1:-1] << np.uint64(8)) | right
        doc = np.repeat(np.arange(stop - row), np.diff(offsets[row : stop + 1]))
        bucket = (mix(gram[middle]) & np.uint64(BUCKETS - 1)).astype(np.int64)
        counts = np.bincount(doc[middle] * BUCKETS + bucket, minlength=(stop - row) * BUCKETS)
        yield counts.reshape(stop - row, BUCKETS).astype(np.float32)
        row = stop


class Languages:
    """Learnt names and their trigram probabilities."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        smooth = counts + 0.5
        self.likely = (smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)

    def _mixture(self, counts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM: proportions over the allowed languages, and the log-likelihood."""
        share = allowed / allowed.sum(axis=1, keepdims=True)
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        for _ in range(STEPS):
            share = share * ((counts / (share @ self.likely)) @ self.likely.T) / total
        expected = share @ self.likely
        return share, (counts * np.log(np.maximum(expected, 1e-30))).sum(axis=1)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each document: the leading language, its share, and the shares of the chosen set."""
        everything = np.ones((len(counts), len(self.names)), dtype=np.float32)
        share, _ = self._mixture(counts, everything)
        rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1)
        price = PENALTY * np.log(np.maximum(counts.sum(axis=1), 2))
        best = np.full(len(counts), -np.inf)
        chosen = np.zeros_like(share)
        # no mixture fits better than this: the likelihood is concave in the shares
        expected = share @ self.likely
        fit = (counts * np.log(np.maximum(expected, 1e-30))).sum(axis=1, dtype=np.float64)
        slope = ((counts / expected) @ self.likely.T).max(axis=1)
        bound = fit + np.maximum(slope - counts.sum(axis=1), 0) + 1e-5 * np.abs(fit)
        for size in range(1, len(self.names) + 1):
            rows = np.flatnonzero(bound - size * price > best)
            if not len(rows):
                break
            share, fit = self._mixture(counts[rows], (rank[rows] < size).astype(np.float32))
            worth = fit - size * price[rows]
            better = worth > best[rows]
            best[rows[better]] = worth[better]
            chosen[rows[better]] = share[better]
        return chosen.argmax(axis=1), chosen.max(axis=1), chosen


def learn(docs: DataFrame) -> Languages | None:
    """From ``text`` and ``lang`` of documents outside fold 2; one row of counts per language comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            names, row = batch.column("lang").to_pylist(), 0
            for counts in _trigrams(batch.column("text")):
                for name in set(names[row : row + len(counts)]):
                    own = [x == name for x in names[row : row + len(counts)]]
                    total[name] = total.get(name, 0) + counts[own].sum(axis=0, dtype=np.float64)
                row += len(counts)
        for name, counts in total.items():
            bucket = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(bucket), pa.string()), pa.array(bucket), pa.array(counts[bucket])],
                ["lang", "bucket", "n"],
            )

    known = docs.where("text IS NOT NULL AND lang IS NOT NULL AND lang <> ''")
    known = known.where(F.coalesce(fold(F.col("doc_id")), F.lit(0)) != 2).select("lang", "text")
    cells = known.mapInArrow(count, "lang string, bucket bigint, n double")
    table = cells.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(table["lang"].to_pylist()))
    if not names:
        return None
    counts = np.zeros((len(names), BUCKETS))
    at = np.searchsorted(names, table["lang"].to_pylist())
    counts[at, table["bucket"].to_numpy()] = table["n"].to_numpy()
    return Languages(names, counts)


def predict(docs: DataFrame, languages: Languages | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and the ``mixture`` of every document."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            names, scores, mixtures = [], [], []
            for counts in _trigrams(batch.column("text")):
                first, share, chosen = languages.predict(counts)
                names += [languages.names[i] for i in first]
                scores.append(np.clip(share, 0, 1).astype(np.float64))
                mixtures += [
                    [(languages.names[i], float(row[i])) for i in np.flatnonzero(row > 0)] for row in chosen
                ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("letters"),
                    pa.array(names, pa.string()),
                    pa.array(np.concatenate(scores)),
                    pa.array(mixtures, pa.map_(pa.string(), pa.float64())),
                ],
                ["doc_id", "letters", "lang_pred", "score", "mixture"],
            )

    docs = docs.select(
        F.col("doc_id").cast("bigint"), "text", F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("letters")
    )
    schema = "doc_id bigint, letters boolean, lang_pred string, score double, mixture map<string,double>"
    if languages is None:
        none = F.lit(None).cast("map<string,double>").alias("mixture")
        found = docs.select("doc_id", F.lit(False).alias("letters"), F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), none)
    else:
        found = docs.mapInArrow(apply, schema)
    return found.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        F.when(F.col("letters"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"),
        F.when(F.col("letters"), F.col("mixture")).alias("mixture"),
    )
