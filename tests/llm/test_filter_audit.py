"""The filter audit against filters applied one after the other in plain Python."""

from __future__ import annotations

import random
import re
from itertools import permutations

import pytest

from clicktally.llm import filter_audit
from tests.llm.helpers import HARD_TEXTS, SCHEMA, documents

LABELS = "doc_id bigint, quality int, toxic int"


def failures(rows: list[tuple]) -> list[set[str]]:
    found = []
    for doc, text, *_ in rows:
        t = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t):
            fails.add("C")
        if any(c in "#$%&*|" for c in t):
            fails.add("D")
        if doc is not None and any(d is not None and d < doc and (s or "") == t for d, s, *_ in rows):
            fails.add("E")
        found.append(fails)
    return found


def brute_force(rows: list[tuple], labels: list[tuple]) -> set[tuple]:
    good = {d for d, q, _ in labels if q == 1} - {None}
    toxic = {d for d, _, t in labels if t == 1} - {None}
    out = {}
    fails = failures(rows)
    for part in {r[2] or "" for r in rows}:
        own = [(r, f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                lost = [x for x in left if letter in x[1]]
                before = sum(letter in f for _, f in own)
                left = [x for x in left if letter not in x[1]]
                total[letter] += len(lost)
                out[part, "".join(order), step] = [
                    len(left),
                    len(lost),
                    before - len(lost),
                    sum(f == {letter} for _, f in own),
                    sum(r[0] in good for r, _ in lost),
                    sum(r[0] in toxic for r, _ in lost),
                    letter,
                ]
        for (p, order, step), counts in out.items():
            if p == part:
                out[p, order, step] = [*counts[:6], total[order[step - 1]]]
    return {(*k, *v) for k, v in out.items()}


def hard_rows(rng: random.Random) -> list[tuple]:
    texts = [t for t in HARD_TEXTS if t is None or len(t) < 1000]
    texts += [" ".join(rng.choice("abcdefg") + str(rng.randrange(k)) for _ in range(n)) for n in (199, 200, 201, 400) for k in (5, 30, 900)]
    texts += [f"{t} {extra}" for t in texts[-12:] for extra in ("100 %", "ABCDEF" * 20, "x\x0by\x1cz")]
    texts += ["A" * 3 + "b" * 97, "A" * 4 + "b" * 96, "Ä" * 50]
    rows = []
    for i in range(400):
        doc = rng.choice([None, i, i, i, i, i, rng.randrange(50)])
        text = rng.choice(texts)
        rows.append((doc, text, rng.choice(["en", "de", None, ""]), "s", 0))
    return rows + rows[:20]


def test_audit_equals_filters_one_after_the_other(spark):
    rng = random.Random(11)
    rows = hard_rows(rng)
    labels = [(rng.randrange(420), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(300)] + [(None, 1, 1)]
    marks = spark.createDataFrame(labels, LABELS).selectExpr("*", "'x' AS part", "1 AS good", "2 AS mask", "3 AS salt")
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "'x' AS part", "1 AS mask", "'d' AS digest", "2 AS good", "0 AS n")
    found = filter_audit.interactions(docs, marks)
    assert found.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    ]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == 3 * 600 == len(set(got))
    assert set(got) == brute_force(rows, labels)


def test_what_a_filter_removes_adds_up(spark):
    rows = hard_rows(random.Random(12))
    found = filter_audit.interactions(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], LABELS))
    sums = found.groupBy("part", "filter_order").agg({"removed": "sum", "kept": "min", "good_lost": "max"}).collect()
    sizes = {p: sum((r[2] or "") == p for r in rows) for p in ("en", "de", "")}
    assert len(sums) == 360
    assert all(r["sum(removed)"] + r["min(kept)"] == sizes[r.part] and r["max(good_lost)"] == 0 for r in sums)


def test_other_filters_and_no_documents(spark):
    cells = spark.createDataFrame([("p", 3, 5, 1, 0), ("p", 2, 7, 0, 2), ("p", 0, 1, 0, 0)], "part string, mask int, n bigint, good bigint, toxic bigint")
    got = {tuple(r) for r in filter_audit.audit(cells, ["x", "y"]).collect()}
    assert got == {
        ("p", "xy", 1, 8, 5, 0, 0, 1, 0, 5),
        ("p", "xy", 2, 1, 7, 5, 7, 0, 2, 19),
        ("p", "yx", 1, 1, 12, 0, 7, 1, 2, 19),
        ("p", "yx", 2, 1, 0, 5, 0, 0, 0, 5),
    }
    assert filter_audit.interactions(documents(spark, []), spark.createDataFrame([], LABELS)).count() == 0


@pytest.mark.parametrize("copies", [1, 500])
def test_a_group_of_copies(spark, copies):
    rows = [(i, "the same", "en", "s", 0) for i in range(copies)]
    found = filter_audit.interactions(spark.createDataFrame(rows, SCHEMA).repartition(8), spark.createDataFrame([], LABELS))
    first = found.where("filter_order = 'EABCD' AND step = 1").first()
    assert (first.kept, first.removed, first.unique_fails) == (1, copies - 1, 0)
