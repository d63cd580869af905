"""Operators on pairs and on passages of documents, against plain Python."""

from __future__ import annotations

import hashlib
import random

import pytest

from clicktally.llm import decontaminate, fingerprints, ngram_join
from clicktally.llm.components import components
from tests.llm.helpers import (
    HARD_TEXTS,
    changed,
    documents,
    lower,
    plain_words,
    sentence,
    shingle_set,
)


def linked_components(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """Smallest reachable id, by comparing all pairs."""
    parent = {doc: doc for doc, _ in rows}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(doc, shingle_set(text)) for doc, text in rows]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {doc: root(doc) for doc in parent}


def near_copies() -> list[tuple[int, str | None]]:
    rng = random.Random(5)
    texts: list[str | None] = list(HARD_TEXTS)
    common = sentence(rng, 30)
    for n in (4, 5, 6, 8, 9, 10, 13, 14, 20, 25, 30, 60, 150):
        base = sentence(rng, n)
        texts += [base, base, base.upper(), base + " end", "start " + base, base + " one more at the end"]
        texts += [changed(rng, base, k) for k in (1, 1, 2, 3, 5)]
        texts += [f"{common} {sentence(rng, n)}", f"{base}\n{common}"]
    big = sentence(rng, 120)
    texts += [changed(rng, big, rng.choice((0, 1, 1, 2, 2, 3, 4, 5))) for _ in range(60)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("short", [2, 12])
def test_jaccard_components(spark, short, monkeypatch):
    monkeypatch.setattr(ngram_join, "PAIRS", 4 * short)
    monkeypatch.setattr(ngram_join, "MOST_ACROSS", short)
    rows = near_copies()
    want = linked_components(rows)
    found = ngram_join.jaccard_components(documents(spark, rows, extra=True), short=short).collect()
    text = dict(rows)
    assert len(found) == len(rows)
    for r in found:
        assert r.n_shingles == len(shingle_set(text[r.doc_id])), r
        assert r.component_id == want[r.doc_id], r


def test_few_stages(spark):
    """Each stage costs the driver memory: the join keeps to a number of them, also where copies form long lists."""
    rng = random.Random(8)
    opening, base = sentence(rng, 14), sentence(rng, 60, 10**6)
    texts = [f"{opening} {sentence(rng, 25, 10**6)}" for _ in range(700)] + [changed(rng, base, 1) for _ in range(300)]
    scheduler = spark.sparkContext._jsc.sc().dagScheduler()
    before = scheduler.nextStageId()
    found = ngram_join.jaccard_components(documents(spark, texts)).collect()
    assert len({r.component_id for r in found}) == len(set(linked_components(list(enumerate(texts))).values()))
    assert scheduler.nextStageId() - before < 130


def test_jaccard_components_of_odd_rows(spark):
    a, b = sentence(random.Random(1), 50), sentence(random.Random(2), 50)
    rows = [(7, a), (3, b), (7, b), (9, a), (9, a), (None, a), (None, None), (12, None)]
    found = ngram_join.jaccard_components(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found if r.doc_id is not None) == [(3, 3), (7, 3), (7, 3), (9, 3), (9, 3), (12, 12)]
    assert [r.component_id for r in found if r.doc_id is None] == [None, None]
    assert ngram_join.jaccard_components(documents(spark, [])).collect() == []


def test_a_common_opening_gives_few_pairs(spark, monkeypatch):
    """Documents that share no more than their opening are not compared with each other."""
    rng = random.Random(6)
    opening = sentence(rng, 14)
    texts = [f"{opening} {sentence(rng, rng.randrange(20, 40), 10**6)}" for _ in range(1500)]
    texts += [changed(rng, texts[i], 1) + " w" for i in range(0, 200, 4)]
    compared, verify = [], ngram_join._verify

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(ngram_join, "_verify", counted)
    monkeypatch.setattr(ngram_join, "PAIRS", 50)
    monkeypatch.setattr(ngram_join, "MOST_ACROSS", 60)
    found = ngram_join.jaccard_components(documents(spark, texts), ordered=0).collect()
    sets = [shingle_set(t) for t in texts]
    want = {i: i for i in range(len(texts))}
    for k, i in enumerate(range(0, 200, 4)):
        if 100 * len(sets[i] & sets[1500 + k]) >= 80 * len(sets[i] | sets[1500 + k]):
            want[1500 + k] = i
    assert {r.doc_id: r.component_id for r in found} == want
    assert sum(compared) < 40 * len(texts)


def test_candidates_of_a_very_long_list_go_on():
    """A list that is taken in parts keeps its members and gives pairs across the parts."""
    import numpy as np
    import pyarrow as pa

    n = 450_000
    columns = {"key": np.zeros(n, int), "n": np.full(n, 100), "rest": np.full(n, 100), "doc": np.arange(n)}
    whole = pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))
    found = pa.Table.from_batches(ngram_join._candidates(12)(whole.slice(i, 90_000) for i in range(0, n, 90_000)))
    kinds, b = found["kind"].to_numpy(), found["b"].to_numpy()
    assert set(b[kinds == 1]) == set(range(n))
    parent = dict(zip(b[kinds == 0].tolist(), found["a"].to_numpy()[kinds == 0].tolist(), strict=True))

    def root(x: int) -> int:
        while x in parent:
            x = parent[x]
        return x

    assert {root(x) for x in range(0, n, 1000)} == {0}


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(1, 70)] + [(100, 200), (200, 300), (300, 100)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(1, 71), 1), **dict.fromkeys((100, 200, 300), 100)}


def test_components_of_odd_edges(spark):
    edges = [(1, 2, "x"), (2, 1, "y"), (1, 2, "x"), (5, 5, "z"), (None, 7, "z"), (7, None, "z"), (None, None, "z"), (9, 8, None)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint, component string"))
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1), (2, 1), (8, 8), (9, 8)]
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def leaks(text: str | None, items: list[tuple[object, str | None]]) -> tuple[int, int, list[str]]:
    words, hit, names = plain_words(text), set(), set()
    for name, item in items:
        own = plain_words(item)
        n = min(10, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own and name is not None else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


def leaky() -> tuple[list[str | None], list[tuple[object, str | None]]]:
    rng = random.Random(11)
    items: list[tuple[object, str | None]] = [(i, sentence(rng, n, 60)) for i, n in enumerate((40, 12, 10, 9, 3, 1, 25, 25))]
    items += [(20, items[0][1]), (21, "aa aa aa aa aa aa aa aa aa aa aa"), (22, None), (23, " .. "), (None, "lost item"), (3, "twice here")]
    texts: list[str | None] = list(HARD_TEXTS)
    for _ in range(60):
        text = sentence(rng, rng.randrange(5, 60), 60)
        part = rng.choice(items)[1] or ""
        texts += [text, f"{text} {part.upper()} {text}", f"{part[5:]} {text}", f"{part}, {part}"]
    texts += ["aa " * 50, "twice, HERE? twice here", "lost item"]
    return texts, items


@pytest.mark.parametrize(("block_words", "shard_bytes"), [(200_000, 1 << 21), (40, 3000)])
def test_find_leaks(spark, block_words, shard_bytes):
    texts, items = leaky()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find_leaks(documents(spark, texts, extra=True), bench, block_words=block_words, shard_bytes=shard_bytes)
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id]
        assert (r.n_words, r.n_hit, r["items"]) == leaks(text, items), (r, text)
        assert sum(len(plain_words(text[s.start : s.end])) for s in r.spans) == r.n_hit


def test_remove_leaks_leaves_none(spark):
    texts, items = leaky()
    docs = documents(spark, texts, extra=True)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    clean = decontaminate.remove_leaks(docs, bench)
    assert clean.schema == docs.schema
    rows = {r.doc_id: r for r in clean.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert leaks(rows[i].text, items)[1] == 0
        if not leaks(text, items)[1]:
            assert rows[i].text == text
    assert rows[len(HARD_TEXTS) + 1].score == "x"
    nothing = bench.limit(0)
    assert decontaminate.find_leaks(docs, nothing).where("n_hit > 0").count() == 0
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0


def test_fingerprints_and_edits(spark):
    rng = random.Random(3)
    texts = [*HARD_TEXTS, *(sentence(rng, rng.randrange(1, 80)) for _ in range(60))]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    found = {r.doc_id: r for r in fingerprints.edits(documents(spark, rows, extra=True).repartition(5)).collect()}
    alone = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(documents(spark, rows)).collect()}
    text, order = {d: t or "" for d, t in rows}, sorted(ids)
    assert len(found) == len(rows)
    errors = []
    for doc, following in zip(order, order[1:] + order[:1], strict=True):
        own, cut = text[doc], len(text[doc]) // 4
        edited = own[: len(own) - cut] + text[following][:cut]
        r = found[doc]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == alone[doc]
        a, b = shingle_set(own), shingle_set(edited)
        errors.append(r.near_edited - (len(a & b) / len(a | b) if a | b else 1))
        assert (r.near_next == 1) == (shingle_set(own) == shingle_set(text[following]))
    assert abs(sum(errors) / len(errors)) < 0.03 and max(map(abs, errors)) < 0.3
    assert len(set(alone.values())) == len({shingle_set(t) for t in texts})


def test_edits_of_odd_tables(spark):
    one = fingerprints.edits(documents(spark, [(5, "abcdefgh")])).collect()
    assert [(r.near_next, r.edited_sha256) for r in one] == [(1.0, hashlib.sha256(b"abcdefab").hexdigest())]
    rows = [(2, "aaaa"), (2, "bbbb"), (2, "aaaa"), (None, "cccc")]
    found = fingerprints.edits(documents(spark, rows)).collect()
    want = ["aaaa", "aaab", "bbbc", "ccca"]
    assert sorted(r.edited_sha256 for r in found) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in want)
    assert fingerprints.edits(documents(spark, [])).collect() == []


def test_edits_carry_the_classes(spark):
    rng = random.Random(8)
    texts = [sentence(rng, 40) for _ in range(30)]
    rows = [(i * 7 % 211, changed(rng, texts[i % 30], i % 2)) for i in range(200)] + [(5, "x"), (5, texts[0]), (None, texts[1]), (None, None), (-1, "")]
    docs = documents(spark, rows).repartition(6)
    classes = fingerprints.near_duplicates(docs)
    assert classes.count() == len(rows)
    want = {(r.doc_id, r.class_id) for r in classes.collect()}
    found = fingerprints.edits(docs, classes.where("class_id <> doc_id").distinct())
    plain = fingerprints.edits(docs)
    assert found.drop("class_id").exceptAll(plain).count() == 0 == plain.exceptAll(found.drop("class_id")).count()
    assert {(r.doc_id, r.class_id) for r in found.collect()} == want
    assert (None, None) in want and sum(a != b for a, b in want) > 50


def test_recall_of_the_bands(spark):
    """Against all pairs of the given documents: at least 0.9 of the links, and no wrong one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = linked_components(rows)
    found = {r.doc_id: r.class_id for r in fingerprints.near_duplicates(docs).collect()}
    together = [(a, b) for a, b in want.items() if a != b]
    assert len(together) > 20 and sum(found[a] == found[b] for a, b in together) >= 0.9 * len(together)
    assert all(want[a] == want[b] for a, b in found.items())


def test_near_duplicates(spark):
    rows = near_copies()
    rows = [(d, t) for d, t in rows if t is None or len(t) < 50_000]
    want = linked_components(rows)
    found = {r.doc_id: r.class_id for r in fingerprints.near_duplicates(documents(spark, rows)).collect()}
    assert set(found) == set(want)
    together = [(a, b) for a, b in want.items() if a != b]
    assert sum(found[a] == found[b] for a, b in together) >= 0.97 * len(together)
    assert all(want[a] == want[b] for a, b in found.items())


def test_words_are_lower_cased_as_asked():
    assert lower("ÀB Kelvin \u212a") == "Àb kelvin \u212a"
