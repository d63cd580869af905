"""Documents packed into sequences of a fixed number of tokens, with lower bounds as certificates.

A document is its tokens and an end token. Only longer ones are cut: the first piece takes what is
over, all others are full and are sequences of their own. The rest is packed like this:

1. Pieces are dealt to groups of bounded size by a hash. A group is packed by best-fit decreasing:
   the longest piece first, each into the fullest sequence that has room.
2. Dual-feasible functions bound the number of sequences that the lengths of a group need. A group
   that needs no more than its bound is certified: it keeps all but its emptiest sequence, which can
   only be of use to others. A group with a gap keeps most of its full sequences and gives all
   others up.
3. What was given up is dealt again, to fewer and larger groups, and packed again, for a fixed number
   of turns or until one group holds it all. So a turn moves only what may still be improved.

Any number of documents costs a few turns, no group grows with the data, and what a table needs at
least is known from its counts by length (``lower_bound``).

Defined results: a null text is empty, and an empty text is its end token; rows with the same id, or
without one, are packed each on its own; equal lengths go by the order the rows came in; no documents
give no rows; special tokens in a text are plain text. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.store import stored
from clicktally.llm.tokens import byte_level, shared_file
from clicktally.llm.words import slices

CAPACITY = 1024
END = 2
#: Pieces in a group at first; later turns have groups four times larger each, up to MOST_ITEMS.
ITEMS = 1 << 13
MOST_ITEMS = 1 << 16
#: Times that pieces are dealt out.
TURNS = 4
#: Of so many full sequences a group with a gap gives up one.
GIVE_UP = 4
#: The largest k of the functions that round x to multiples of 1 / k.
LARGEST_K = 12

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PACKED = f"{_PIECE}, row bigint, group bigint, sequence_id bigint, offset bigint, kept boolean, sequences bigint, bound bigint"


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY, enough: int | None = None) -> int:
    """Sequences that are needed at least; ``counts[x]`` pieces have the length ``x``.

    With ``enough``, no larger bound than that is looked for.

    The largest sum of a dual-feasible function over the lengths: for every e up to half a sequence,
    lengths over ``capacity - e`` count as full and those under e as nothing, and what that gives is
    taken as it is or rounded, for k from 1, to multiples of 1 / k of a sequence.
    """
    counts = np.asarray(counts, dtype=object if int(np.sum(counts)) > 1 << 40 else np.int64)
    x = np.arange(capacity + 1)
    used = np.flatnonzero(counts[: capacity + 1])
    if not len(used):
        return 0
    x, counts = x[used], counts[used]
    edges = np.unique(np.concatenate([[0], x[x <= capacity // 2], capacity + 1 - x[x > capacity // 2]]))
    edges = edges[edges <= capacity // 2]
    cut = np.where(x > capacity - edges[:, None], capacity, np.where(x < edges[:, None], 0, x))
    best = -(-int((cut * counts).sum(axis=1).max()) // capacity)
    for k in range(1, LARGEST_K + 1):
        if enough is not None and best >= enough:
            break
        whole, rest = np.divmod(cut * (k + 1), capacity)
        scaled = np.where(rest == 0, cut * k, whole * capacity)  # times k * capacity
        best = max(best, -(-int((scaled * counts).sum(axis=1).max()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of every piece, and the number of sequences.

    Sequences stand in lists by the room they have; the bits of a number say which lists have any.
    """
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled, n = 0, 0
    size = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = size[i]
        fits = filled >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                filled ^= 1 << room
        else:
            at, room, n = n, capacity, n + 1
        sequence[i], offset[i] = at, capacity - room
        if room > need:
            rooms[room - need].append(at)
            filled |= 1 << (room - need)
    return np.array(sequence, dtype=np.int64), np.array(offset, dtype=np.int64), n


def _cut(file: Broadcast, capacity: int, end: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = byte_level(file.value)
        for batch in slices(batches, "text"):
            columns: list[list[int | None]] = [[], [], [], [], []]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = tokenizer.encode(text or "")
                ids.append(end)
                raw = np.array(ids, dtype="<u4").tobytes()
                n = -(-len(ids) // capacity)
                edges = [0, *range(len(ids) - (n - 1) * capacity, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    for column, value in zip(columns, (doc, piece, a, b - a, zlib.crc32(raw[4 * a : 4 * b])), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Every document's pieces: ``doc_id, piece, start, length, ids_crc32``."""
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    return docs.mapInArrow(_cut(shared_file(docs.sparkSession, tokenizer), capacity, end), _PIECE)


def _packed(turn: int, capacity: int, last: bool) -> Callable:
    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        lengths = rows.column("length").to_numpy()
        sequence, offset, n = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(sequence, lengths, n)
        need = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity, n)
        if last:
            kept = np.ones(n, dtype=bool)
        elif n == need:
            kept = np.arange(n) != np.argmin(fill)
        else:
            kept = (fill == capacity) & (np.arange(n) % GIVE_UP > 0)
        ids = (np.int64(turn) << 56) + (np.int64(key[0].as_py()) << 20) + sequence
        more = {"sequence_id": ids, "offset": offset, "kept": kept[sequence], "sequences": np.full(len(ids), n), "bound": np.full(len(ids), need)}
        for name, values in more.items():
            rows = rows.append_column(name, pa.array(values))
        return rows

    return pack


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, items: int = ITEMS, turns: int = TURNS, most: int = MOST_ITEMS
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``sequences`` and ``bound`` are those of the group that
    a piece was packed in last."""
    rows = stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    one = F.lit(1).cast("bigint")
    full = rows.where(F.col("length") >= capacity)
    done = full.withColumns({"sequence_id": -F.col("row") - 1, "offset": one - 1, "sequences": one, "bound": one})
    columns = done.columns
    left = rows.where(F.col("length") < capacity)
    for turn in range(turns):
        n = left.count()
        if not n:
            break
        groups = -(-n // items)
        last = groups == 1 or turn == turns - 1
        dealt = left.withColumn("group", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)))
        packed = stored(dealt.groupBy("group").applyInArrow(_packed(turn, capacity, last), _PACKED), "packed")
        done = done.unionByName(packed.where("kept").select(columns))
        if last:
            break
        left = packed.where("NOT kept").select(left.columns)
        items = min(4 * items, most)
    return done.drop("row")


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """How many sequences there are, and how many are needed at least; from counts by length."""
    rows = packed.groupBy("length").agg(F.count("*").alias("n")).collect()  # a row per length
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in rows:
        counts[r.length] = r.n
    return packed.select("sequence_id").distinct().count(), lower_bound(counts, capacity)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack_pieces(token_pieces(docs, tokenizer, capacity, end), capacity)
