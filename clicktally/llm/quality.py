"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of whole texts (lengths, shares of kinds of characters, repetition) are standardised and
mapped to ``FEATURES`` random cosines, which approximate a Gaussian kernel. Each task sums its part of
the normal equations, Spark adds the parts, and the driver solves one small system. Labelled rows
that the regression has not seen calibrate its output by isotonic regression.

Rows are told apart by ``crc32(doc_id as text) mod 4``: 0 and 1 fit the regression, 3 the calibration,
2 is held out. All labelled rows are used. Labels, ids and other columns never enter a score.

Defined results: null texts are scored like empty ones; a row without id is not held out and has no
label; repeated rows are scored one by one; an id with several labels has their mean; null labels are
ignored; without any label to fit on, every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktally.llm.store import stored
from clicktally.llm.words import BLANK_SEPARATED, Run, runs, shingles, slices

#: Random cosines.
FEATURES = 200
#: Width of the kernel, in standard deviations of the statistics.
WIDTH = 4.0
RIDGE = 1.0
THRESHOLD = 0.7
#: The normal equations are summed over at most so many tasks, as long as these have few rows.
PARTS = 64
#: Labelled rows whose sums one task forms, beyond that.
ROWS_PER_SUM = 100_000

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "line": b"\n",
    "blank": b" \t",
    "stop": b".,;:",
    "mark": b"!?",
    "bar": b"|<>{}[]\\/",
    "symbol": b"#$%&*+=@^_~",
    "beyond": bytes(range(0x80, 0x100)),
}
_KIND = np.zeros(256, dtype=np.int64)
for _i, _bytes in enumerate(_KINDS.values(), 1):
    _KIND[list(_bytes)] = _i

STATISTICS = (*_KINDS, "chars", "words", "word_length", "longest_word", "distinct_words", "distinct_shingles", "line_length")


def _statistics(run: Run) -> np.ndarray:
    docs, kinds = len(run), len(_KINDS) + 1
    doc = np.repeat(np.arange(docs), np.diff(run.offsets))
    counts = np.bincount(doc * kinds + _KIND[run.data], minlength=docs * kinds).reshape(docs, kinds)
    size = np.maximum(np.diff(run.offsets), 1)
    n_words = np.diff(run.bounds)
    lengths = run.ends - run.starts
    out = np.zeros((docs, len(STATISTICS)))
    out[:, : kinds - 1] = np.sqrt(counts[:, 1:] / size[:, None])
    at = kinds - 1
    total = np.concatenate([[0], np.cumsum(lengths)])
    out[:, at] = np.log1p(np.diff(run.offsets))
    out[:, at + 1] = np.log1p(n_words)
    out[:, at + 2] = (total[run.bounds[1:]] - total[run.bounds[:-1]]) / np.maximum(n_words, 1)
    for i, (_, found) in enumerate(shingles(run)):
        if n := n_words[i]:
            words = np.sort(run.hashes[run.bounds[i] : run.bounds[i + 1]])
            out[i, at + 3] = np.log1p(lengths[run.bounds[i] : run.bounds[i + 1]].max())
            out[i, at + 4] = (1 + np.count_nonzero(words[1:] != words[:-1])) / n
            out[i, at + 5] = len(found) / max(1, n - 4)
    out[:, at + 6] = np.log1p(size / (1 + counts[:, 1 + list(_KINDS).index("line")]))
    return out


def _statistics_of(column: pa.Array) -> np.ndarray:
    parts = [_statistics(run) for run in runs(column, BLANK_SEPARATED)]
    return np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))


def _rows(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every document, in the order of ``STATISTICS``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _rows(_statistics_of(batch.column("text")))], ["doc_id", "x"]
            )

    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    return docs.mapInArrow(measure, "doc_id bigint, x array<double>")


def fold(doc_id: Column) -> Column:
    """0 to 3; documents in fold 2 are never learnt from."""
    return (F.crc32(doc_id.cast("string")) % 4).cast("int")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the cosines, then the constant
    knots: np.ndarray  # the calibration: raw values and the labels expected there
    levels: np.ndarray

    def cosines(self, x: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(7)
        turns = random.normal(0, 1 / WIDTH, (x.shape[1], FEATURES))
        shift = random.uniform(0, 2 * np.pi, FEATURES)
        z = np.cos((x - self.mean) / self.scale @ turns + shift) * np.sqrt(2 / FEATURES)
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.cosines(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(x), 0.5)
        raw = self.raw(x)
        # a thousandth of the raw value keeps the order of what the calibration puts level
        score = 0.999 * np.interp(raw, self.knots, self.levels) + 0.001 * np.clip(raw, 0, 1)
        return np.round(np.clip(score, 0, 1), 9)  # the last bits of a product depend on the rows beside it


def isotonic(x: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: means that never fall along sorted ``x``, at the mean x of each pool."""
    pools: list[list[float]] = []
    for at, t, w in zip(x, total, weight, strict=True):
        pools.append([t, w, at * w])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    table = np.array(pools).reshape(-1, 3)
    return table[:, 2] / table[:, 1], table[:, 0] / table[:, 1]


def _normal_equations(model: Model, rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over all ``n`` rows, summed in each task and then by Spark."""
    width = FEATURES + 2

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                z = np.hstack([model.cosines(_matrix(part.column("x"))), part.column("y").to_numpy()[:, None]])
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), _rows(total)], ["i", "v"])

    parts = rows.select("x", "y").coalesce(max(PARTS, -(-n // ROWS_PER_SUM))).mapInArrow(sums, "i bigint, v array<double>")
    cells = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    table = cells.toArrow()
    total = np.zeros((width, width))
    total[table["i"].to_numpy(), table["j"].to_numpy()] = table["v"].to_numpy()
    return total[:-1, :-1], total[:-1, -1]


def fit(measured: DataFrame, labels: DataFrame) -> Model:
    """Learn ``labels.quality`` from the statistics of documents outside fold 2."""
    y = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    known = measured.join(y, "doc_id").withColumn("fold", fold(F.col("doc_id"))).where("fold <> 2")
    known = stored(known.select("x", F.col("y").cast("double"), "fold"), "labelled")
    n = len(STATISTICS)
    moments = known.where("fold < 2").agg(
        F.count("*"), *(f(F.get("x", F.lit(i))) for f in (F.avg, F.stddev_pop) for i in range(n))
    ).first()
    empty = Model(np.zeros(n), np.ones(n), np.zeros(FEATURES + 1), np.zeros(0), np.zeros(0))
    if not moments[0]:
        return empty
    scale = np.array(moments[1 + n :])
    scale = np.where(scale > 1e-9, scale, 1.0)
    model = Model(np.array(moments[1 : 1 + n]), scale, empty.weights, empty.knots, empty.levels)
    gram, right = _normal_equations(model, known.where("fold < 2"), moments[0])
    penalty = RIDGE * np.eye(FEATURES + 1)
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(gram + penalty, right)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.rint(np.clip(model.raw(_matrix(batch.column("x"))), -1, 2) * 1e4).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("y")], ["bin", "y"])

    calibrating = known.where("fold = 3")
    calibrating = known if calibrating.isEmpty() else calibrating
    bins = (
        calibrating.select("x", "y")
        .mapInArrow(raw, "bin bigint, y double")
        .groupBy("bin")
        .agg(F.sum("y").alias("y"), F.count("*").alias("n"))
        .toArrow()
        .sort_by("bin")
    )  # 30,001 at most
    model.knots, model.levels = isotonic(
        bins["bin"].to_numpy() / 1e4, bins["y"].to_numpy(), bins["n"].to_numpy().astype(float)
    )
    return model


def score(measured: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of measured documents."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(_matrix(batch.column("x"))))], ["doc_id", "score"]
            )

    return measured.mapInArrow(apply, "doc_id bigint, score double").select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(model.score(_statistics_of(batch.column("text"))) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
