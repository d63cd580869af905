"""Documents linked by the Jaccard similarity of their word shingles: a size-aware heavy-light join.

Links are pairs of shingle sets with ``100 * |A and B| >= 80 * |A or B|``. The join goes like this:

1. Documents with equal sets form a class; its smallest id stands for it.
2. Shingles are put in one global order, rare ones first. Two linked sets share a shingle among the
   first ``n - ceil(0.8 n) + 1`` of each, and two shingles among the first ``n - ceil(0.8 n) + 2``.
   An entry at place i of such a prefix says that at most the n - i shingles from there on are shared,
   if it is the first shared one; a pair of entries that leaves less than 4/9 of both sizes is none.
3. Light sets, up to a boundary size, are joined on the two-element subsets of that longer prefix;
   heavy sets are found by scanning the inverted lists of single shingles. The boundary is the one
   with the least cost: subsets written against list entries written and scanned.
4. A list gives all its pairs if it is short. A long one (copies by the thousand, for example) gives
   the pairs of its first member with the others, and is kept. Candidates are verified on the texts.
5. Kept lists whose members are in one component by now are done: more links inside it change
   nothing. The others get further first members, and at last all pairs between components, if their
   members are few. Members of larger lists are put in an order of their own, with weights counted over
   them alone: what they have in common comes last, so only those meet that share more.

So a group of copies costs its size and not its square, and no link between components is missed.
The order of step 2 only steers the cost: the weights come from all documents (how often shingles
repeat within a task), and of them the ``ORDERED`` heaviest, a fixed number, go to the tasks.

Defined results: a null or empty text, or one without words, has no shingles and is linked with
nothing; rows with the same id are one document with several sets; a row without id has no
component. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.components import components
from clicktally.llm.store import stored
from clicktally.llm.words import BLANK_SEPARATED, mix, runs, shingles, slices
from clicktally.operators.joins import filtered_join, may_be_in

SHINGLE = 5
#: Shingles whose weight is known to every task.
ORDERED = 1 << 18
#: A list of up to so many members gives all its pairs at once.
SHORT_LIST = 12
#: A candidate costs so many times what a list entry costs.
VERIFY_COST = 20
#: Times that a long list gets another first member before all pairs between components are taken.
ROUNDS = 2
#: Of a list with more members its members are ordered anew instead.
MOST_ACROSS = 512
#: Pairs of one document that meet its text in one task.
PAIRS = 256
BOUNDARIES = (3, 6, 9, 12, 16, 20, 25, 32, 40, 50, 64, 80, 100, 128)

_CHUNK = 1 << 21
_FIRST, _SECOND, _SUBSET = (np.uint64(x) for x in (0x9AE16A3B2F90404F, 0xC3A5C85C97CB3127, 0xB492B66FBE98F273))


def _prefix(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1


def fingerprint(found: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of hashes."""
    low = np.add.reduce(mix(found ^ _FIRST)) if len(found) else 0
    high = np.add.reduce(mix(found ^ _SECOND)) if len(found) else 0
    return int(np.uint64(low).view(np.int64)), int(np.uint64(high).view(np.int64))


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int | None, np.ndarray]]:
    for batch in slices(batches, "text"):
        ids = batch.column("doc_id").to_pylist()
        for run in runs(batch.column("text"), BLANK_SEPARATED):
            for row, found in shingles(run, size):
                yield ids[row], found


def _new_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each set once per task, with an id, if it can be linked with a different one."""
    seen = set()
    for doc, found in _sets(batches, size):
        if doc is not None and len(found) > 3:
            mark = fingerprint(found)
            if mark not in seen:
                seen.add(mark)
                yield doc, found


def _table(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))


def summaries(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Size and 128-bit fingerprint of every document's shingle set."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [(len(s), *fingerprint(s)) for _, s in _sets(iter([batch]), size)]
            columns = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n", "h1", "h2"])

    return docs.mapInArrow(summarise, "doc_id bigint, n bigint, h1 bigint, h2 bigint")


def _repeats(docs: DataFrame, size: int) -> DataFrame:
    """Shingles that several sets of one task have, with how many in all such tasks together.

    Every shingle that is in more sets than there are chunks of tasks is among them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def counted() -> pa.RecordBatch:
            token, times = np.unique(np.concatenate(held), return_counts=True)
            again = times > 1
            return _table({"token": token[again].view(np.int64), "weight": times[again]})

        for _, found in _new_sets(batches, size):
            held.append(found)
            n += len(found)
            if n >= _CHUNK:
                yield counted()
                held, n = [], 0
        if held:
            yield counted()

    return docs.mapInArrow(count, "token bigint, weight bigint").groupBy("token").agg(F.sum("weight").alias("weight"))


def _boundary(classes: DataFrame, scan: float) -> int:
    """The largest light size, by the cost of subsets and of list entries written and scanned.

    ``scan`` is the cost of scanning behind one entry, as a multiple of writing it.
    """
    n = F.col("n")
    prefix = n - F.floor((4 * n + 4) / 5) + 1
    costs = [
        F.sum(F.when(n <= x, prefix * (prefix + 1) / 2).otherwise(0) + F.when(5 * n > 4 * x, prefix * (1 + scan)).otherwise(0))
        for x in BOUNDARIES
    ]
    row = classes.where("n > 3").agg(*costs).first()
    return min(zip(row, BOUNDARIES, strict=True))[1] if row[0] is not None else BOUNDARIES[0]


def _entries(order, boundary: int, size: int) -> Callable:
    """List entries ``key, n, rest, doc`` of a task's sets; ``rest`` bounds what can be shared."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, ranks = order.value
        keys, rests, sizes, ids, held = [], [], [], [], 0

        def entries() -> pa.RecordBatch:
            lengths = [len(k) for k in keys]
            return _table(
                {
                    "key": np.concatenate(keys).view(np.int64),
                    "n": np.repeat(np.array(sizes, dtype=np.int64), lengths),
                    "rest": np.concatenate(rests),
                    "doc": np.repeat(np.array(ids, dtype=np.int64), lengths),
                }
            )

        for doc, found in _new_sets(batches, size):
            n = len(found)
            if len(tokens):
                place = np.minimum(np.searchsorted(tokens, found), len(tokens) - 1)
                heavy = tokens[place] == found
                last = found[heavy][np.argsort(ranks[place[heavy]], kind="stable")]
                found = np.concatenate([found[~heavy], last])
            prefix = _prefix(n)
            own, rest = [], []
            if 5 * n > 4 * boundary:
                own.append(found[:prefix])
                rest.append(np.arange(n, n - prefix, -1))
            if n <= boundary:
                i, j = np.triu_indices(prefix + 1, 1)
                own.append(mix(found[i] * _FIRST + mix(found[j]) + _SUBSET))
                rest.append(n - j + 1)
            keys.append(np.concatenate(own))
            rests.append(np.concatenate(rest))
            sizes.append(n)
            ids.append(doc)
            held += len(keys[-1])
            if held > 200_000:
                yield entries()
                keys, rests, sizes, ids, held = [], [], [], [], 0
        if keys:
            yield entries()

    return write


def _candidates(short: int) -> Callable:
    """From entries sorted by key and size: pairs (kind 0) and the entries of long lists (kind 1)."""

    def lists(key: np.ndarray, n: np.ndarray, rest: np.ndarray, doc: np.ndarray, goes_on: bool) -> pa.RecordBatch | None:
        first = np.concatenate([[True], key[1:] != key[:-1]])
        smallest = n[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
        if goes_on:  # smaller members came before
            smallest[key == key[0]] = 0
        useful = 9 * rest >= 4 * (n + np.maximum((4 * n + 4) // 5, smallest))
        key, n, rest, doc = key[useful], n[useful], rest[useful], doc[useful]
        if not len(key):
            return None
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        length = np.diff(np.append(start, len(key)))
        is_long = length > short
        is_long[0] |= goes_on
        pairs = []
        for step in range(1, min(short, int(length.max()))):  # of members that are `step` apart in a short list
            within = np.repeat(np.where(is_long, 0, start + length - step), length) > np.arange(len(key))
            i = np.flatnonzero(within)
            pairs.append((i, i + step))
        long = np.flatnonzero(np.repeat(is_long, length))
        for s in np.flatnonzero(is_long):
            low, high = start[s], start[s] + length[s]
            while low < high:  # sizes grow: a first member reaches up to 5/4 of its own
                stop = low + int(np.searchsorted(4 * n[low:high], 5 * n[low], "right"))
                head = low + int(np.argmax(rest[low:stop]))
                pairs.append((np.full(stop - low, head), np.arange(low, stop)))
                low = stop
        i, j = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
        fits = (4 * np.maximum(n[i], n[j]) <= 5 * np.minimum(n[i], n[j])) & (doc[i] != doc[j])
        fits &= 9 * np.minimum(rest[i], rest[j]) >= 4 * (n[i] + n[j])
        a, b = doc[i[fits]], doc[j[fits]]
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        if not len(both) and not len(long):
            return None
        return _table(
            {
                "kind": np.repeat(np.array([0, 1], dtype=np.int8), [len(both), len(long)]),
                "a": np.concatenate([both[:, 0], key[long]]),
                "b": np.concatenate([both[:, 1], doc[long]]),
                "n": np.concatenate([np.zeros(len(both), dtype=np.int64), n[long]]),
                "rest": np.concatenate([np.zeros(len(both), dtype=np.int64), rest[long]]),
            }
        )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("key", "n", "rest", "doc")
        held, goes_on = [np.zeros(0, np.int64)] * 4, False
        for batch in batches:
            held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, columns, strict=True)]
            key = held[0]
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1], "left"))
            if not cut and len(key) < 200_000:
                continue
            # a very long list is taken in parts, and the last member of one leads on to the next
            out, held = [h[: cut or None] for h in held], [h[cut or -1 :] for h in held]
            if (found := lists(*out, goes_on)) is not None:
                yield found
            goes_on = not cut
        if len(held[0]) and (found := lists(*held, goes_on)) is not None:
            yield found

    return find


def _verify(pairs: DataFrame, texts: DataFrame, size: int, merge: bool = False) -> DataFrame:
    """The pairs ``(a, b)`` whose sets are linked, counted on the whole texts.

    With ``merge`` texts move the same way at every size, also where the pairs are few.
    """

    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        for run in runs(column, BLANK_SEPARATED):
            yield from (found for _, found in shingles(run, size))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in slices(batches, "text_b"):
            for batch in slices(iter([whole]), "text_a"):
                good = []
                for x, y in zip(sets(batch.column("text_a")), sets(batch.column("text_b")), strict=True):
                    both = np.sort(np.concatenate([x, y]))
                    shared = int((both[1:] == both[:-1]).sum())
                    good.append(100 * shared >= 80 * (len(x) + len(y) - shared))
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    side = F.inline(F.array(*(F.struct(F.lit(c).alias("side"), F.col(c).alias("doc")) for c in ("a", "b"))))
    ends = pairs.select(side).groupBy("side", "doc").agg(F.ceil(F.count("*") / PAIRS).alias("salts"))
    ends = stored(ends, "ends")
    named = texts.select("doc", "text", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("side"))
    named = may_be_in(named, ends, ["side", "doc"], "_maybe").where("_maybe").drop("_maybe")
    busy = ends.where("salts > 1")
    if salted := not busy.isEmpty():
        for c, other in (("a", "b"), ("b", "a")):
            salt = F.pmod(F.xxhash64(other), F.coalesce("salts", F.lit(1)))
            own = busy.where(F.col("side") == c).select(F.col("doc").alias(c), "salts")
            pairs = pairs.join(own, c, "left").withColumn(f"salt_{c}", salt).drop("salts")
    for c in ("b", "a"):
        pairs = _with_texts(pairs, named, c, busy if salted else None, merge)
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(check, "a bigint, b bigint")


def _found(entries: DataFrame, short: int) -> DataFrame:
    dealt = entries.repartition("key").sortWithinPartitions("key", "n", "doc")
    kinds = "kind tinyint, a bigint, b bigint, n bigint, rest bigint"
    return stored(dealt.mapInArrow(_candidates(short), kinds), "candidates")


def _with_texts(pairs: DataFrame, texts: DataFrame, side: str, busy: DataFrame | None, merge: bool) -> DataFrame:
    """The pairs with the ``texts`` of one side; only these are moved, and once.

    ``busy`` documents, the head of a long list for example, have many pairs: these are spread over
    salts, and the text is sent to each.
    """
    named = texts.where(F.col("side") == side).select(F.col("doc").alias(side), F.col("text").alias(f"text_{side}"))
    if busy is None:
        return pairs.join(named.hint("merge") if merge else named, side)
    busy = busy.where(F.col("side") == side).select(F.col("doc").alias(side), "salts")
    salts = F.coalesce("salts", F.lit(1).cast("bigint"))
    salt = F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias(f"salt_{side}")
    sent = named.join(busy, side, "left").select(side, f"text_{side}", salt)
    return pairs.join(sent.hint("merge") if merge else sent, [side, f"salt_{side}"]).drop(f"salt_{side}")


def _open_lists(lists: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of the lists that have members in several components, with these."""
    entries = lists.join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc")
    )
    several = entries.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    return entries.join(several.select("key"), "key", "left_semi")


def _star(lists: DataFrame, turn: int) -> DataFrame:
    """Pairs of a list's first member, another one in each turn, with those of other components."""
    first = F.min(F.struct(F.xxhash64("doc", F.lit(turn)).alias("h"), "doc", "n", "rest", "component"))
    heads = lists.groupBy("key").agg(first.alias("head"))
    return lists.join(heads, "key").where(
        "component <> head.component AND 4 * greatest(n, head.n) <= 5 * least(n, head.n)"
        " AND 9 * least(rest, head.rest) >= 4 * (n + head.n)"
    ).select(F.least("doc", "head.doc").alias("a"), F.greatest("doc", "head.doc").alias("b")).distinct()


def _across(lists: DataFrame) -> DataFrame:
    """All pairs of a list's members in different components."""
    other = lists.select("key", *(F.col(c).alias(f"{c}2") for c in ("doc", "n", "rest", "component")))
    return lists.join(other, "key").where(
        "component < component2 AND 4 * greatest(n, n2) <= 5 * least(n, n2)"
        " AND 9 * least(rest, rest2) >= 4 * (n + n2)"
    ).select(F.least("doc", "doc2").alias("a"), F.greatest("doc", "doc2").alias("b")).distinct()


def _order(docs: DataFrame, size: int, ordered: int) -> tuple[Broadcast, float]:
    """The heaviest shingles of the documents with their weights, and what all repeated ones weigh."""
    repeats = stored(_repeats(docs, size), "repeats")
    heaviest = repeats.orderBy(F.desc("weight"), "token").limit(ordered).toArrow()
    tokens, weights = heaviest["token"].to_numpy().view(np.uint64), heaviest["weight"].to_numpy()
    by_token = np.argsort(tokens)
    order = docs.sparkSession.sparkContext.broadcast((tokens[by_token], weights[by_token]))
    return order, repeats.agg(F.sum("weight")).first()[0] or 0


_ENTRY = "key bigint, n bigint, rest bigint, doc bigint"


def _reordered(lists: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """New list entries of the documents in ``lists``, in an order by their own shingles.

    What the members of a list have in common comes last in it, so members that share no more than that
    meet no longer; linked ones still share a shingle of both prefixes.
    """
    docs = texts.join(lists.select("doc").distinct().hint("merge"), "doc", "left_semi")
    docs = stored(docs.select(F.col("doc").alias("doc_id"), "text"), "open-texts", compression="zstd")
    order, _ = _order(docs, size, ORDERED)
    return docs.mapInArrow(_entries(order, 0, size), _ENTRY)


def close_lists(
    lists: DataFrame,
    texts: DataFrame,
    size: int,
    tried: DataFrame | None = None,
    links: DataFrame | None = None,
    short: int = SHORT_LIST,
    rounds: int = ROUNDS,
    most_across: int | None = None,
    merge: bool = False,
) -> DataFrame:
    """Components of all links between members of a list, each ``node`` with its ``component``.

    ``lists`` has ``key, doc, n, rest``; pairs that were ``tried`` before and the ``links`` among them
    are taken over. Only pairs between what is not yet together are verified. Of lists that are still
    open after ``rounds`` turns, those of up to ``most_across`` members give their pairs, and the members
    of larger ones are ordered anew; what that leaves open goes the same way, and gives its pairs last.
    """
    spark = lists.sparkSession
    nothing = spark.createDataFrame([], "a bigint, b bigint")
    joined = components(links) if links is not None else nothing.toDF("node", "component")
    tried = tried if tried is not None else nothing
    most_across = MOST_ACROSS if most_across is None else most_across
    for turn in range(rounds + 2):
        lists = stored(_open_lists(lists, joined), "open")
        if lists.isEmpty():
            break
        if turn < rounds:
            more, lists = _star(lists, turn), lists.select("key", "doc", "n", "rest")
        elif turn > rounds:
            more = _across(lists)
        else:
            sizes = lists.groupBy("key").agg(F.count("*").alias("members"))
            large = stored(sizes.where(F.col("members") > most_across), "large")
            more = _across(lists.join(large, "key", "left_anti"))
            lists = lists.join(large, "key", "left_semi").select("key", "doc", "n", "rest")
            if not large.isEmpty():
                found = _found(_reordered(lists, texts, size), short)
                more = more.unionByName(found.where("kind = 0").select("a", "b")).distinct()
                lists = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("doc"), "n", "rest")
        more = stored(more.join(tried, ["a", "b"], "left_anti"), "pairs")
        if more.isEmpty():
            continue
        tried = tried.unionByName(more)
        links = stored(_verify(more, texts, size, merge), "links")
        if not links.isEmpty():  # what is together stays together: its stars stand for its links
            links = links.unionByName(joined.select(F.col("node").alias("a"), F.col("component").alias("b")))
            joined = stored(components(links), "components")
    return joined


def jaccard_components(docs: DataFrame, size: int = SHINGLE, ordered: int = ORDERED, short: int = SHORT_LIST) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    summary = stored(summaries(docs, size), "sets")
    # stored, so that the join moves both sides and Spark can split a large class
    classes = stored(summary.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep")), "sets")
    member = stored(
        summary.where("n > 0 AND doc_id IS NOT NULL")
        .join(classes, ["n", "h1", "h2"])
        .select(F.col("doc_id").alias("doc"), "rep")
        .distinct(),
        "classes",
    )

    order, shared = _order(docs, size, ordered)
    total = classes.agg(F.sum("n")).first()[0] or 1
    boundary = _boundary(classes, VERIFY_COST * shared / total)

    entries = docs.mapInArrow(_entries(order, boundary, size), _ENTRY)
    found = _found(entries, short)

    def representatives(df: DataFrame, name: str) -> DataFrame:
        names = member.select(F.col("doc").alias(name), F.col("rep").alias(f"{name}_rep"))
        return df.join(names, name).drop(name).withColumnRenamed(f"{name}_rep", name)

    pairs = found.where("kind = 0").select("a", "b").distinct()
    pairs = representatives(representatives(pairs, "a"), "b").where("a <> b")
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    lists = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("doc"), "n", "rest")
    lists = stored(representatives(lists, "doc").select("key", "doc", "n", "rest").distinct(), "lists")

    wanted = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc")))
    wanted = stored(wanted.unionByName(lists.select("doc")).distinct(), "wanted")
    texts = filtered_join(docs.withColumnRenamed("doc_id", "doc"), wanted.hint("merge"), ["doc"], "left_semi", salts=1)
    texts = stored(texts, "texts", compression="zstd")

    # an id that comes with several sets links their classes
    several = member.groupBy("doc").agg(F.count("*").alias("sets")).where("sets > 1").select("doc")
    same = member.join(several, "doc", "left_semi").where("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b"))
    links = stored(_verify(pairs, texts, size, True).unionByName(same), "links")
    joined = close_lists(lists, texts, size, pairs, links, short, merge=True)

    top = member.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    of_set = top.groupBy("doc").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    return (
        summary.select("doc_id", F.col("n").alias("n_shingles"))
        .join(of_set.withColumnRenamed("doc", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    )
