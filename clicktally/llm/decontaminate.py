"""Benchmark passages in documents, found with an FM-index per shard of training text.

A window is ten consecutive words of a benchmark item (all of its words, if it has fewer). Each
task cuts its documents into shards of whole documents, indexes each shard, searches all windows
backwards through the ranks of a wavelet matrix, locates the occurrences by sampled positions and
merges them to spans. Words that occur in no window are breaks in the indexed text: no occurrence
can hold one. There is no shuffle of documents.

A shard is indexed once, over the words of all items. The windows go to the tasks in blocks of items of
about ``BLOCK_WORDS`` words, whatever the size of the benchmark, and a task holds one block at a time; of
the benchmark as a whole it holds the hashes of its different words, 8 bytes each.

Defined results: a null or empty text has no words and is not contaminated; an item without words
or without id is no item; items that repeat an id count once; repeated documents are handled one by
one; an empty benchmark finds nothing. Other columns of the inputs are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.fm_index import BREAK, FMIndex
from clicktally.llm.words import ALPHANUMERIC, Run, runs, slices

WINDOW = 10
BLOCK_WORDS = 200_000
SHARD_BYTES = 1 << 21


@dataclass
class Phrases:
    """The windows of a block of items, as numbers of the sorted word hashes of all items (from 1)."""

    windows: np.ndarray  # filled from the right
    lengths: np.ndarray
    item_bounds: np.ndarray  # window w is in items item_of[item_bounds[w]:item_bounds[w + 1]]
    item_of: np.ndarray
    items: list[str]


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        hashed = [
            run.hashes[run.bounds[i] : run.bounds[i + 1]].tobytes()
            for run in runs(batch.column("text"), ALPHANUMERIC)
            for i in range(len(run))
        ]
        yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(hashed, pa.binary())], ["item", "hashes"])


def _phrases(rows: list, size: int, vocabulary: np.ndarray) -> Phrases:
    items = sorted({r.item for r in rows})
    number = {item: i for i, item in enumerate(items)}
    cut, of = [], []
    for r in rows:
        words = np.frombuffer(bytes(r.hashes), np.uint64)
        n = min(size, len(words))
        view = np.lib.stride_tricks.sliding_window_view(words, n)
        table = np.zeros((len(view), size + 1), dtype=np.uint64)
        table[:, size - n : size] = view
        table[:, size] = n
        cut.append(table)
        of.append(np.full(len(view), number[r.item]))
    table, window = np.unique(np.concatenate(cut), axis=0, return_inverse=True)
    lengths = table[:, size].astype(np.int64)
    used = np.arange(size) >= size - lengths[:, None]
    numbers = np.where(used, np.searchsorted(vocabulary, table[:, :size]) + 1, 0)
    pairs = np.unique(np.stack([window.ravel(), np.concatenate(of)], axis=1), axis=0)
    return Phrases(
        numbers, lengths, np.searchsorted(pairs[:, 0], np.arange(len(table) + 1)), pairs[:, 1], items
    )


@dataclass
class Benchmark:
    """Broadcasts: the sorted hashes of all words, and the windows in blocks."""

    vocabulary: Broadcast
    blocks: list[Broadcast]


def _different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = np.frombuffer(b"".join(batch.column("hashes").to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(words))], ["word"])


def _benchmark(bench: DataFrame, size: int, block_words: int) -> Benchmark:
    """The benchmark's windows, each block from about ``block_words`` words."""
    spark = bench.sparkSession
    words = (
        bench.select(F.col("item_id").cast("string").alias("item"), "text")
        .where("item IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(_item_words, "item string, hashes binary")
        .where("length(hashes) > 0")
    )
    total = words.agg(F.sum(F.expr("length(hashes) div 8"))).first()[0] or 0
    n = -(-total // block_words)
    # as many as the benchmark has different words
    known = words.select("hashes").mapInArrow(_different, "word bigint").distinct().toArrow()
    vocabulary = np.sort(known["word"].to_numpy().view(np.uint64))
    found = []
    for i in range(n):
        rows = words.where(F.pmod(F.xxhash64("item"), F.lit(n)) == i).collect()
        if rows:
            found.append(spark.sparkContext.broadcast(_phrases(rows, size, vocabulary)))
    return Benchmark(spark.sparkContext.broadcast(vocabulary), found)


class _Shard:
    """A run of documents indexed by the words that items have."""

    def __init__(self, run: Run, vocabulary: np.ndarray):
        at = np.minimum(np.searchsorted(vocabulary, run.hashes), len(vocabulary) - 1)
        symbol = np.where(vocabulary[at] == run.hashes, at + 1, BREAK)
        # a break before each document, and a single one for each stretch of other words
        begins = np.unique(run.bounds[:-1])
        text = np.insert(symbol, begins, BREAK)
        origin = np.insert(np.arange(len(symbol)), begins, -1)
        keep = np.concatenate([[True], (text[1:] != BREAK) | (text[:-1] != BREAK)])
        self.origin = np.append(origin[keep], -1)
        self.index = FMIndex(np.append(text[keep], BREAK), len(vocabulary))

    def places(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Window and first word (counted in the run) of all occurrences."""
        window, low, high = self.index.search(phrases.windows, phrases.lengths)
        counts = high - low
        rows = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        return np.repeat(window, counts), self.origin[self.index.locate(rows)]


def _search(run: Run, bench: Benchmark) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Which words of a run are hit, and the items found by document."""
    n = len(run.hashes)
    change = np.zeros(n + 1, dtype=np.int64)
    items: dict[int, set[str]] = {}
    blocks = bench.blocks if n else []
    shard = _Shard(run, bench.vocabulary.value) if blocks else None
    for block in blocks:
        phrases = block.value
        window, first = shard.places(phrases)
        np.add.at(change, first, 1)
        np.add.at(change, first + phrases.lengths[window], -1)
        doc = np.searchsorted(run.bounds, first, "right") - 1
        for d, w in np.unique(np.stack([doc, window], axis=1), axis=0).tolist():
            of = phrases.item_of[phrases.item_bounds[w] : phrases.item_bounds[w + 1]]
            items.setdefault(d, set()).update(phrases.items[i] for i in of)
        if len(blocks) > 1:
            vars(block).pop("_value", None)  # the next block takes its place in this worker
    return np.cumsum(change[:n]) > 0, items


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _leaks(bench: Benchmark, shard_bytes: int) -> Callable:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n_words, n_hit, items, spans = [], [], [], []
            for run in runs(batch.column("text"), ALPHANUMERIC, shard_bytes):
                hit, found = _search(run, bench)
                point = np.concatenate([[0], np.cumsum((run.data & 0xC0) != 0x80)])  # code points before a byte
                for d in range(len(run)):
                    low, high = int(run.bounds[d]), int(run.bounds[d + 1])
                    n_words.append(high - low)
                    n_hit.append(int(hit[low:high].sum()))
                    items.append(sorted(found.get(d, ())))
                    base = int(point[run.offsets[d]])
                    spans.append(
                        [
                            {
                                "start": int(point[run.starts[low + a]]) - base,
                                "end": int(point[run.ends[low + b - 1]]) - base,
                            }
                            for a, b in (_spans(hit[low:high]) if n_hit[-1] else ())
                        ]
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(spans, kind),
                ],
                ["doc_id", "n_words", "n_hit", "items", "spans"],
            )

    return find


def find_leaks(
    docs: DataFrame,
    bench: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per document: its words, its words within any occurrence, the ids of the items that
    occur (as text, sorted) and the merged spans in code points."""
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    return docs.mapInArrow(
        _leaks(_benchmark(bench, window, block_words), shard_bytes),
        "doc_id bigint, n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>",
    )


def _without(bench: Benchmark, shard_bytes: int) -> Callable:
    def cut(texts: pa.Array) -> tuple[list[bytes | None], list[int]]:
        """Texts without hit words, and which rows changed."""
        out, changed = [], []
        for run in runs(texts, ALPHANUMERIC, shard_bytes):
            hit, _ = _search(run, bench)
            for d in range(len(run)):
                low, high = int(run.bounds[d]), int(run.bounds[d + 1])
                at, parts = int(run.offsets[d]), []
                for a, b in _spans(hit[low:high]) if hit[low:high].any() else ():
                    parts.append(run.data[at : run.starts[low + a]].tobytes())
                    at = int(run.ends[low + b - 1])
                if parts:
                    changed.append(run.first + d)
                out.append(b"".join([*parts, run.data[at : run.offsets[d + 1]].tobytes()]))
        return out, changed

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            column = batch.column("text")
            texts, changed = cut(column)
            todo = changed
            while todo:  # what a cut brings together may be a window again
                again, still = cut(pa.array([texts[i].decode() for i in todo], pa.string()))
                for i, text in zip(todo, again, strict=True):
                    texts[i] = text
                todo = [todo[i] for i in still]
            if changed:
                known = column.is_valid().to_pylist()
                column = pa.array(
                    [t.decode() if ok else None for t, ok in zip(texts, known, strict=True)], column.type
                )
                batch = batch.set_column(batch.schema.get_field_index("text"), batch.schema.field("text"), column)
            yield batch

    return clean


def remove_leaks(
    docs: DataFrame,
    bench: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The same rows and columns, with all spans cut out of ``text``. Other texts stay as they are."""
    return docs.mapInArrow(_without(_benchmark(bench, window, block_words), shard_bytes), docs.schema)
