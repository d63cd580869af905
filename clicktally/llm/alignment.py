"""Two tokenizers' tokens of the same texts aligned by bytes, and how often their ids meet.

Both tokenizers cut the bytes of a space and the text. Where a token of each ends, a group ends; an id
of one is linked with an id of the other where their bytes overlap.

A stretch of bytes of any kind, of a document's start, middle or end, is a ``Fragment``: an open prefix
(all tokens up to the first common end: their group may have begun before), closed groups, and an open
suffix (the tokens after the last common end). Fragments of neighbours compose, and the order in which
that happens doesn't matter: the suffix of one and the prefix of the next are a group. So

1. Documents of ordinary length are one fragment, closed at both ends, where they are read.
2. Very long ones become byte ranges, cut anywhere, also inside a token. A task takes the text from the
   last safe place before its range to the first one after it, where both tokenizers certainly cut, and
   keeps the tokens that end in its range. Closed groups are described where they are; only the open
   ends go up a tree, ``FAN`` neighbours at a time, until one fragment of a document is left.
3. Documents per pair of ids are counted within tasks first. The ``HEAVY`` most frequent pairs, a fixed
   number, and the highest count of each id go to the tasks; all other pairs meet their count in a join,
   in which no key is hot as they are the rare ones.

Memory follows the longest group and the longest stretch without a safe place. Defined results: a text
that is null or empty, or whose tokens don't join to its bytes again, has no tokens; equal rows, or rows
of one id or none, are documents of their own; special tokens in a text are plain text; no documents
give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.store import stored
from clicktally.llm.tokens import byte_level, pieces, shared_file
from clicktally.llm.words import slices

#: Documents of more bytes are cut into ranges of RANGE bytes.
LONG = 1 << 16
RANGE = 1 << 15
#: A range ends at a safe place if there is none within so many bytes around its end.
GAP = 1 << 12
#: Fragments that are composed at once.
FAN = 16
#: Pairs whose counts every task knows.
HEAVY = 1 << 18

_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())


@dataclass
class Streams:
    """Ids of both tokenizers and the bytes of the document that each ends at."""

    a: np.ndarray
    ends_a: np.ndarray
    b: np.ndarray
    ends_b: np.ndarray

    def between(self, low: int, high: int) -> Streams:
        """The tokens that end after ``low`` and not after ``high``."""
        a = slice(*np.searchsorted(self.ends_a, (low, high), "right"))
        b = slice(*np.searchsorted(self.ends_b, (low, high), "right"))
        return Streams(self.a[a], self.ends_a[a], self.b[b], self.ends_b[b])

    def __add__(self, other: Streams) -> Streams:
        return Streams(
            *(np.concatenate([x, y]) for x, y in zip(self.parts(), other.parts(), strict=True))
        )

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.ends_a, self.b, self.ends_b


NOTHING = Streams(*(np.zeros(0, np.int64) for _ in range(4)))


@dataclass
class Groups:
    """Closed groups: their number, text, and pairs of ids with how often they are linked."""

    n: int
    text: bytes
    pairs: np.ndarray
    times: np.ndarray


@dataclass
class Fragment:
    """What neighbours have to know of a stretch: ``closed`` if both tokenizers end a token together."""

    first: Streams
    closed: bool
    last: Streams


def fragment(tokens: Streams) -> tuple[Fragment, Streams]:
    """The open ends of a stretch, and the tokens of its closed groups."""
    common = np.intersect1d(tokens.ends_a, tokens.ends_b, assume_unique=True)
    if not len(common):
        return Fragment(tokens, False, NOTHING), NOTHING
    low, high = int(common[0]), int(common[-1])
    end = np.iinfo(np.int64).max
    return Fragment(tokens.between(-1, low), True, tokens.between(high, end)), tokens.between(low, high)


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, Streams]:
    """Two neighbours as one, and the tokens of the group that closes between them."""
    if not x.closed:
        return Fragment(x.first + y.first, y.closed, y.last), NOTHING
    if not y.closed:
        return Fragment(x.first, True, x.last + y.first), NOTHING
    return Fragment(x.first, True, y.last), x.last + y.first


class Aligner:
    """Both tokenizers, and what they make of a text."""

    def __init__(self, bytes_file: bytes, pieces_file: bytes):
        self.a, self.b = byte_level(bytes_file), pieces(pieces_file)
        n = max(len(self.a.vocabulary), len(self.b.vocabulary))
        self._spelled = [b"%c%d" % (mark, i) for i in range(n) for mark in b",;|"]

    def tokens(self, text: str, base: int = 0) -> Streams | None:
        """Tokens of a text that begins with a space at byte ``base``; None if they don't join to it."""
        raw = np.frombuffer(text.encode(), np.uint8)
        found = []
        for ids, vocabulary in ((self.a.encode(text), self.a.vocabulary), (self.b.encode(text[1:]), self.b.vocabulary)):
            ids = np.array(ids, dtype=np.int64)
            ends = np.cumsum(vocabulary.lengths[ids])
            if not len(ids) or ends[-1] != len(raw) or not np.array_equal(vocabulary.joined(ids), raw):
                return None
            found += [ids, ends + base]
        return Streams(*found)

    def groups(self, tokens: Streams) -> Groups:
        """Tokens of whole groups, as they are described."""
        a, ends_a, b, ends_b = tokens.parts()
        if not len(a):
            return Groups(0, b"", a, a)
        start = int(min(ends_a[0], ends_b[0]))
        marks = np.zeros(int(ends_a[-1]) - start + 1, dtype=np.uint8)
        marks[ends_a - start] = 1
        marks[ends_b - start] += 2
        at = marks[np.flatnonzero(marks)]  # the ends of all overlaps
        in_a, in_b, both = (at & 1).astype(np.int64), (at >> 1).astype(np.int64), at == 3
        pairs = a[np.cumsum(in_a) - in_a] * len(self.b.vocabulary) + b[np.cumsum(in_b) - in_b]
        pairs, times = np.unique(pairs, return_counts=True)
        group = np.cumsum(both) - both
        group_a, group_b = group[in_a == 1], group[in_b == 1]
        spelled = np.empty(len(a) + len(b), dtype=np.int64)
        new = np.concatenate([[True], group_a[1:] != group_a[:-1]])
        spelled[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 3 * a + new  # , or ;
        new = np.concatenate([[True], group_b[1:] != group_b[:-1]])
        spelled[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = 3 * b + 2 * new  # , or |
        text = b"".join(map(self._spelled.__getitem__, spelled.tolist()))
        return Groups(int(both.sum()), text[1:], pairs, times)


_aligners: dict[tuple[bytes, bytes], Aligner] = {}


def _aligner(files: tuple) -> Aligner:
    key = files[0].value, files[1].value
    if key not in _aligners:
        _aligners[key] = Aligner(*key)
    return _aligners[key]


def safe_places(raw: np.ndarray) -> np.ndarray:
    """Bytes of single spaces between characters that are no white space.

    White space beyond ASCII begins with the bytes C2, E1, E2 or E3, so these are left out.
    """
    space = np.flatnonzero(raw == 0x20)
    space = space[(space > 3) & (space < len(raw) - 1)]

    def plain(x: np.ndarray) -> np.ndarray:
        return (x > 0x20) & (x < 0x7F)

    def lead(x: np.ndarray) -> np.ndarray:
        return ((x >= 0xC3) & (x <= 0xDF)) | (x >= 0xE4)

    two, three, four = raw[space - 2], raw[space - 3], raw[space - 4]
    before = plain(raw[space - 1]) | ((two >= 0xC3) & (two <= 0xDF)) | ((three >= 0xE4) & (three <= 0xEF)) | (four >= 0xF0)
    return space[before & (plain(raw[space + 1]) | lead(raw[space + 1]))]


def ranges(text: str, size: int, gap: int) -> Iterator[tuple[int, int, int, str]]:
    """Byte ranges of a text: low, high, and the place and text of the stretch that tells their tokens."""
    raw = text.encode()
    cuts = np.concatenate([[0], safe_places(np.frombuffer(raw, np.uint8)), [len(raw)]])
    edges = np.arange(size, len(raw), size)
    near = np.searchsorted(cuts, edges)  # the first at or after
    wide = cuts[near] - cuts[near - 1] > gap
    edges = np.unique(np.concatenate([[0], np.where(wide, cuts[near], edges), [len(raw)]]))
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        start = int(cuts[np.searchsorted(cuts, low, "right") - 1])
        stop = int(cuts[np.searchsorted(cuts, high)])
        yield low, high, start, raw[start:stop].decode()


_READ = (
    "key bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string,"
    " pairs array<bigint>, times array<int>, node int, low bigint, high bigint, base bigint, stretch string"
)
_READ_KINDS = [pa.int64()] * 5 + [pa.string(), _LONGS, _INTS, pa.int32()] + [pa.int64()] * 3 + [pa.string()]
_READ_NAMES = [part.split()[0] for part in _READ.split(", ")]


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _read(files: tuple, long: int, size: int, gap: int) -> Callable:
    """Documents aligned, or the ranges of very long ones; ``node`` is null for the former."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(files)
        key = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text", 1 << 20):
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                key += 1
                whole = " " + (text or "")
                if aligner.b.breaks and len(whole.encode()) > long:
                    for node, (low, high, base, stretch) in enumerate(ranges(whole, size, gap)):
                        rows.append((key, doc, *[None] * 6, node, low, high, base, stretch))
                    continue
                tokens = aligner.tokens(whole) if text else None
                found = aligner.groups(tokens if tokens is not None else NOTHING)
                sha = hashlib.sha256(found.text).hexdigest() if found.n else ""
                n_a, n_b = (len(tokens.a), len(tokens.b)) if tokens is not None else (0, 0)
                rows.append((key, doc, n_a, n_b, found.n, sha, found.pairs, found.times, *[None] * 5))
            yield _rows(rows, _READ_NAMES, _READ_KINDS)

    return read


_OPEN = "struct<a:array<bigint>,ends_a:array<bigint>,b:array<bigint>,ends_b:array<bigint>>"
_MADE = "array<struct<start:bigint,n_groups:bigint,text:string,pairs:array<bigint>,times:array<int>>>"
_NODE = f"key bigint, node int, first {_OPEN}, closed boolean, last {_OPEN}, made {_MADE}"
_NODE_NAMES = ["key", "node", "first", "closed", "last", "made"]
_OPEN_KIND = pa.struct([(name, _LONGS) for name in ("a", "ends_a", "b", "ends_b")])
_MADE_KIND = pa.list_(
    pa.struct([("start", pa.int64()), ("n_groups", pa.int64()), ("text", pa.string()), ("pairs", _LONGS), ("times", _INTS)])
)
_NODE_KINDS = [pa.int64(), pa.int32(), _OPEN_KIND, pa.bool_(), _OPEN_KIND, _MADE_KIND]


def _open(tokens: Streams) -> dict:
    return dict(zip(("a", "ends_a", "b", "ends_b"), tokens.parts(), strict=True))


def _opened(row: dict) -> Streams:
    return Streams(*(np.array(row[name], dtype=np.int64) for name in ("a", "ends_a", "b", "ends_b")))


def _made(aligner: Aligner, *closed: Streams) -> list[dict]:
    out = []
    for tokens in closed:
        if len(tokens.a):
            found = aligner.groups(tokens)
            start = int(min(tokens.ends_a[0], tokens.ends_b[0]))
            out.append({"start": start, "n_groups": found.n, "text": found.text.decode(), "pairs": found.pairs, "times": found.times})
    return out


def _cut(files: tuple) -> Callable:
    """Ranges as fragments; a range whose tokens don't join to its text has no ``closed``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(files)
        for batch in slices(batches, "stretch", 1 << 20):
            rows: list[tuple] = []
            for r in batch.to_pylist():
                tokens = aligner.tokens(r["stretch"], r["base"])
                n_a, n_b, closed = 0, 0, None
                if tokens is not None:
                    tokens = tokens.between(r["low"], r["high"])
                    n_a, n_b = len(tokens.a), len(tokens.b)
                own, whole = fragment(tokens if tokens is not None else NOTHING)
                closed = own.closed if tokens is not None else None
                rows.append((r["key"], r["node"], _open(own.first), closed, _open(own.last), _made(aligner, whole), n_a, n_b))
            yield _rows(rows, [*_NODE_NAMES, "n_a", "n_b"], [*_NODE_KINDS, pa.int64(), pa.int64()])

    return cut


def _composed(files: tuple) -> Callable:
    def reduce(key: tuple, rows: pa.Table) -> pa.Table:
        aligner = _aligner(files)
        total, made = None, []
        for r in rows.sort_by("node").to_pylist():
            own = Fragment(_opened(r["first"]), r["closed"], _opened(r["last"]))
            total, closed = (own, NOTHING) if total is None else compose(total, own)
            made += _made(aligner, closed)
        row = (key[0].as_py(), key[1].as_py(), _open(total.first), total.closed, _open(total.last), made)
        return pa.Table.from_batches([_rows([row], _NODE_NAMES, _NODE_KINDS)])

    return reduce


def _first_group(files: tuple) -> Callable:
    """The prefix of a whole document begins at its start, so it is a group."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["key"], _made(_aligner(files), _opened(r["first"]))) for r in batch.to_pylist()]
            yield _rows(rows, ["key", "made"], [pa.int64(), _MADE_KIND])

    return close


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each document's groups, from texts in order; only the digest's state is held."""
    key, digest = None, hashlib.sha256()
    for batch in batches:
        rows = []
        for now, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if now != key:
                if key is not None:
                    rows.append((key, digest.hexdigest()))
                key, digest = now, hashlib.sha256(text.encode())
            else:
                digest.update(b";" + text.encode())
        yield _rows(rows, ["key", "groups_sha256"], [pa.int64(), pa.string()])
    if key is not None:
        yield _rows([(key, digest.hexdigest())], ["key", "groups_sha256"], [pa.int64(), pa.string()])


def _long_documents(read: DataFrame, files: tuple, fan: int) -> tuple[DataFrame, DataFrame]:
    """Documents that came as ranges, like the others, and their pairs (several rows a document)."""
    chunks = read.where("node IS NOT NULL")
    ranged = chunks.select("key", "node", "low", "high", "base", "stretch").repartition("key", "node")
    cut = stored(ranged.mapInArrow(_cut(files), f"{_NODE}, n_a bigint, n_b bigint"), "fragments")
    sizes = cut.groupBy("key").agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.min(F.col("closed").isNotNull()).alias("good"))
    good = sizes.where("good").select("key")
    cut = cut.join(good, "key", "left_semi")
    nodes, made = cut.select("key", "node", "first", "closed", "last"), [cut.select("key", F.inline("made"))]
    while (nodes.agg(F.max("node")).first()[0] or 0) > 0:
        parents = nodes.withColumn("parent", F.expr(f"node div {fan}").cast("int")).groupBy("key", "parent")
        level = stored(parents.applyInArrow(_composed(files), _NODE), "fragments")
        made.append(level.select("key", F.inline("made")))
        nodes = level.drop("made")
    roots = nodes.mapInArrow(_first_group(files), f"key bigint, made {_MADE}")
    made.append(roots.select("key", F.inline("made")))
    parts = made[0]
    for more in made[1:]:
        parts = parts.unionByName(more)
    parts = stored(parts, "groups")
    texts = parts.select("key", "start", "text").repartition("key").sortWithinPartitions("key", "start")
    digests = texts.select("key", "text").mapInArrow(_digests, "key bigint, groups_sha256 string")
    counts = parts.groupBy("key").agg(F.sum("n_groups").alias("n_groups")).join(digests, "key").join(sizes.drop("good"), "key")
    zero = F.lit(0).cast("bigint")
    found = chunks.where("node = 0").select("key", "doc_id").join(counts, "key", "left")
    found = found.withColumns({c: F.coalesce(c, zero) for c in ("n_a", "n_b", "n_groups")}).withColumn(
        "groups_sha256", F.coalesce("groups_sha256", F.lit(""))
    )
    return stored(found, "long"), parts.select("key", "pairs", "times")


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per pair, over all of a batch; every row is a document."""
    for batch in batches:
        pairs, n = np.unique(batch.column("pairs").flatten().to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])


def _scored(known, size: int) -> Callable:
    """Sums over the pairs whose counts are known, and the other pairs."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, counts, best = known.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            pairs = lists.flatten().to_numpy()
            at = np.minimum(np.searchsorted(heavy, pairs), max(0, len(heavy) - 1))
            seen = heavy[at] == pairs if len(heavy) else np.zeros(len(pairs), dtype=bool)
            n = np.where(seen, counts[at] if len(heavy) else 0, 0)
            total, top = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, row, n * times)
            np.add.at(top, row, np.where(seen & (n == best[pairs // size]), times, 0))
            rest = np.concatenate([[0], np.cumsum(np.bincount(row[~seen], minlength=batch.num_rows))]).astype(np.int32)
            others = [pa.ListArray.from_arrays(pa.array(rest), pa.array(x[~seen])) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(total), pa.array(top), *others], ["key", "count_sum", "n_best", "pairs", "times"]
            )

    return score


def align(
    docs: DataFrame,
    byte_tokenizer: str,
    piece_tokenizer: str,
    long: int = LONG,
    size: int = RANGE,
    gap: int = GAP,
    fan: int = FAN,
    heavy: int = HEAVY,
) -> DataFrame:
    """Per document its tokens, groups and links; ``n_best`` are links whose pair is in as many documents
    as any pair of the first id, ``count_sum`` sums over links in how many documents their pair is."""
    spark = docs.sparkSession
    files = shared_file(spark, byte_tokenizer), shared_file(spark, piece_tokenizer)
    ids = len(_aligner(files).b.vocabulary)
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    read = stored(docs.mapInArrow(_read(files, long, size, gap), _READ), "aligned", compression="zstd")
    whole = read.where("node IS NULL")
    found = whole.select("key", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
    lists = whole.select("key", "pairs", "times")
    counts = lists.select("pairs").mapInArrow(_repeats, "pair bigint, n bigint")
    if not read.where("node IS NOT NULL").isEmpty():
        more, more_lists = _long_documents(read, files, fan)
        found, lists = found.unionByName(more.select(found.columns)), lists.unionByName(more_lists)
        each = more_lists.select("key", F.explode("pairs").alias("pair")).distinct()
        counts = counts.unionByName(each.groupBy("pair").agg(F.count("*").alias("n")))
    counts = stored(counts.groupBy("pair").agg(F.sum("n").alias("n")), "counts")

    first = F.expr(f"pair div {ids}")
    highest = counts.groupBy(first.alias("a")).agg(F.max("n").alias("best"))
    most = highest.toArrow()  # a row per id of the first tokenizer
    best = np.zeros(len(_aligner(files).a.vocabulary), dtype=np.int64)
    best[most["a"].to_numpy()] = most["best"].to_numpy()
    top = counts.orderBy(F.desc("n"), "pair").limit(heavy).toArrow().sort_by("pair")
    known = spark.sparkContext.broadcast((top["pair"].to_numpy(), top["n"].to_numpy(), best))

    sums = "key bigint, count_sum bigint, n_best bigint, pairs array<bigint>, times array<bigint>"
    scored = stored(lists.mapInArrow(_scored(known, ids), sums), "scored", compression="zstd")
    rare = scored.select("key", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    ranked = counts.withColumn("a", first).join(highest, "a").select("pair", "n", (F.col("n") == F.col("best")).alias("is_best"))
    rare = rare.join(ranked, "pair").select(
        "key", (F.col("times") * F.col("n")).alias("count_sum"), F.when(F.col("is_best"), F.col("times")).otherwise(0).alias("n_best")
    )
    sums = scored.select("key", "count_sum", "n_best").unionByName(rare).groupBy("key").agg(
        F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best")
    )
    zero = F.lit(0).cast("bigint")
    return found.join(sums, "key", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        (F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links"),
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
