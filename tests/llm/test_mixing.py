"""Mixing: every block in its window, and the places of documents."""

from __future__ import annotations

import random
from fractions import Fraction

from clicktally.llm import mixing
from tests.llm.helpers import documents


def test_a_cycle_meets_all_deadlines():
    rng = random.Random(2)
    for _ in range(30):
        parts = {f"s{i}": rng.randrange(1, 40) for i in range(rng.randrange(1, 12))}
        length, taken = sum(parts.values()), dict.fromkeys(parts, 0)
        slots = mixing.one_cycle(parts)
        assert [s for *_, s in slots] == list(range(length))
        for name, block, slot in slots:
            assert block == taken[name] and block * length // parts[name] <= slot
            taken[name] += 1
            for other, part in parts.items():
                assert abs(taken[other] - Fraction((slot + 1) * part, length)) < 1
        assert taken == parts
    assert mixing.one_cycle({}) == []


def test_documents_get_their_place(spark):
    rows = [(i, f"text {i}") for i in range(3000)] + [(7, "again"), (7, "again"), (None, "x"), (None, None)]
    docs = documents(spark, rows, extra=True)
    found = mixing.mix(docs, {"a": 3, "b": 1, "": 4}, block=5, range_rows=200).collect()
    assert len(found) == docs.count()
    for name, part in (("a", 3), ("b", 1), ("", 4)):
        own = [r for r in found if (r.source or "") == name]
        assert sorted(r.block * 5 + r.place for r in own) == list(range(len(own)))
        assert all(r.release <= r.slot < r.deadline for r in own)
        assert all(r.release == r.block * 8 // part for r in own)
    slots = {}
    for r in found:
        assert slots.setdefault(r.slot, (r.source or "", r.block)) == (r.source or "", r.block)
    other = mixing.mix(docs.repartition(7), {"a": 3, "b": 1, "": 4}, block=5, range_rows=10**6).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, other))


def test_targets(spark):
    docs = documents(spark, [f"t{i}" for i in range(400)])
    parts = mixing.tempered_parts(docs)
    assert set(parts) == {"", "a", "b"} and parts[""] > parts["a"] == parts["b"] > 0
    rows = mixing.mix(docs, {"a": 1}).collect()
    assert len(rows) == 400 and all((r.slot is None) == (r.source != "a") for r in rows)
    assert mixing.mix(docs.limit(0)).count() == 0
