"""Packing: token ids against the tokenizer itself, places without gaps, bounds by brute force."""

from __future__ import annotations

import random
import zlib
from functools import lru_cache
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clicktally.llm import packing
from clicktally.llm.tokens import byte_level
from tests.llm.helpers import HARD_TEXTS, documents, sentence

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_are_those_of_the_tokenizer():
    own = Tokenizer.from_file(BYTES)
    own.encode_special_tokens = True
    texts = [t or "" for t in HARD_TEXTS]
    texts += ["<|endoftext|> a", "a b　c  d\n\n e\r\n", "don't we'LL 1²³ ⅷ", "x" * 5000, " " * 3000, "漢字" * 400]
    texts += ["".join(chr(c) for c in range(low, low + 997) if not 0xD800 <= c < 0xE000) for low in range(0, 0x20000, 997)]
    tokenizer = byte_level(open(BYTES, "rb").read())
    for text in texts:
        ids = tokenizer.encode(text)
        assert ids == own.encode(text, add_special_tokens=False).ids
        assert tokenizer.vocabulary.joined(np.array(ids, dtype=np.int64)).tobytes() == text.encode()


@lru_cache(None)
def fewest(lengths: tuple[int, ...], capacity: int) -> int:
    """By trying every sequence that holds the longest piece."""
    if not lengths:
        return 0
    first, rest = lengths[-1], lengths[:-1]
    best = 1 + fewest(rest, capacity)
    for mask in range(1, 1 << len(rest)):
        own = [x for i, x in enumerate(rest) if mask >> i & 1]
        if sum(own) + first <= capacity:
            best = min(best, 1 + fewest(tuple(x for i, x in enumerate(rest) if not mask >> i & 1), capacity))
    return best


def test_bounds_hold_and_best_fit_packs():
    tight = 0
    for capacity in (7, 10):
        for lengths in combinations_with_replacement(range(1, capacity), 5):
            counts = np.bincount(lengths, minlength=capacity + 1)
            bound, exact = packing.lower_bound(counts, capacity), fewest(lengths, capacity)
            assert -(-sum(lengths) // capacity) <= bound <= exact
            sequence, offset, n = packing.best_fit_decreasing(np.array(lengths), capacity)
            check_places(sequence, offset, lengths, capacity)
            assert n == len(set(sequence.tolist())) >= exact
            tight += bound == n
    assert tight > 1400
    assert packing.lower_bound(np.zeros(1025)) == 0
    assert packing.lower_bound(np.bincount([600] * 9 + [400] * 3, minlength=1025)) == 9
    assert packing.lower_bound(np.bincount([342] * 9, minlength=1025)) == 5  # by thirds
    assert packing.lower_bound(np.eye(1, 1025, 513)[0] * 2.0**42) == 2**42


def check_places(sequence, offset, lengths, capacity):
    held: dict[int, list[tuple[int, int]]] = {}
    for s, o, n in zip(sequence, offset, lengths, strict=True):
        held.setdefault(s, []).append((o, n))
    for places in held.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= capacity


def test_packing_documents(spark):
    rng = random.Random(3)
    texts = [*HARD_TEXTS, *(sentence(rng, rng.choice((3, 40, 200, 700, 3000))) for _ in range(150))]
    rows = [*enumerate(texts), (5, texts[20]), (5, texts[20]), (None, "no id"), (None, None)]
    found = packing.pack(documents(spark, rows, extra=True).repartition(6), BYTES, 256).collect()
    tokenizer = byte_level(open(BYTES, "rb").read())
    want = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or ""), 2]
        first = len(ids) % 256 or 256
        edges = [0, *range(first, len(ids) + 1, 256)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want.append((doc, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(map(repr, (tuple(r)[:5] for r in found))) == sorted(map(repr, want))
    check_places([r.sequence_id for r in found], [r.offset for r in found], [r.length for r in found], 256)
    assert packing.pack(documents(spark, []), BYTES).count() == 0


@pytest.mark.parametrize("kind", ["mixed", "halves", "thirds"])
def test_groups_exchange_what_can_be_improved(spark, kind):
    rng = random.Random(4)
    draw = {
        "mixed": lambda: min(1023, int(rng.lognormvariate(6, 0.7)) + 1),
        "halves": lambda: rng.randrange(500, 560),
        "thirds": lambda: rng.randrange(330, 360),
    }[kind]
    rows = [(i, 0, 0, draw(), 7) for i in range(6000)]
    pieces = spark.createDataFrame(rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint").repartition(7)
    packed = packing.pack_pieces(pieces, items=400, turns=4, most=2000)
    found = packed.collect()
    assert sorted(tuple(r)[:5] for r in found) == rows
    check_places([r.sequence_id for r in found], [r.offset for r in found], [r.length for r in found], 1024)
    sequences, bound = packing.certificate(packed)
    assert sequences == len({r.sequence_id for r in found}) >= bound
    assert kind != "mixed" or sequences <= bound * 1.003
    alone = packing.certificate(packing.pack_pieces(pieces, items=400, turns=1))[0]
    assert sequences < alone if kind == "mixed" else sequences <= alone
