"""Alignment against all pairs of tokens in plain Python, and fragments in any order of composition."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clicktally.llm import alignment
from clicktally.llm.alignment import NOTHING, Aligner, compose, fragment, ranges, safe_places
from tests.llm.helpers import HARD_TEXTS, documents, sentence

BYTES, PIECES = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))

_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE = {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}


@pytest.fixture(scope="module")
def aligner():
    return Aligner(open(BYTES, "rb").read(), open(PIECES, "rb").read())


def plain_tokens(text: str | None):
    """Ids and byte ranges of both tokenizers, by their own libraries."""
    own = Tokenizer.from_file(BYTES)
    own.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    if not text:
        return [], []
    whole, sides = (" " + text).encode(), []
    encoded = own.encode(" " + text, add_special_tokens=False)
    pairs = [(i, bytes(_BYTE[c] for c in name)) for i, name in zip(encoded.ids, encoded.tokens, strict=True)]
    sides.append(pairs)
    pairs = []
    for i in model.encode(text):
        name = model.id_to_piece(i)
        pairs.append((i, bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()))
    sides.append(pairs)
    out = []
    for pairs in sides:
        if b"".join(b for _, b in pairs) != whole:
            return [], []
        at, side = 0, []
        for i, b in pairs:
            side.append((i, at, at + len(b)))
            at += len(b)
        out.append(side)
    return out


def brute_force(rows):
    tokens = [plain_tokens(text) for _, text in rows]
    links = [[(i, j) for i, s, e in a for j, t, f in b if s < f and t < e] for a, b in tokens]
    count: dict = {}
    for found in links:
        for pair in set(found):
            count[pair] = count.get(pair, 0) + 1
    best: dict = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for (doc, _), (a, b), found in zip(rows, tokens, links, strict=True):
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [
            ",".join(str(i) for i, _, e in a if low < e <= high) + "|" + ",".join(str(j) for j, _, e in b if low < e <= high)
            for low, high in zip([0, *ends], ends, strict=False)
        ]
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        top = sum(count[p] == best[p[0]] for p in found)
        out.append((doc, len(a), len(b), len(groups), len(found), top, sum(count[p] for p in found), sha))
    return out


def texts(rng: random.Random) -> list:
    found = [t for t in HARD_TEXTS if t is None or len(t) < 1000]
    found += ["<|endoftext|> and </s> <s>", "a▁b", " leading", "trailing ", "two  spaces\n\tand\r\nmore", "ﬁ ½ ｆｕｌｌ", "é   　 x", "\x00 zero", "<0x41> A"]
    found += [sentence(rng, 60), "Größe straße 漢字かな交じり文 словарь данных 🙂🙂 naïve", "x" * 300, "unbelievably internationalization antidisestablishmentarianism"]
    return found


@pytest.mark.parametrize("kind", ["whole", "ranges"])
def test_align_equals_all_pairs(spark, kind):
    rng = random.Random(13)
    given = texts(rng)
    rows = [*enumerate(given), (3, given[-1]), (3, given[-1]), (None, given[-3]), (None, None)]
    options = {"whole": {"heavy": 20}, "ranges": {"long": 40, "size": 17, "gap": 24, "fan": 2, "heavy": 0}}[kind]
    docs = documents(spark, rows, extra=True).repartition(5)
    found = alignment.align(docs, BYTES, PIECES, **options)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, brute_force(rows)))


def test_production_parameters_and_no_documents(spark):
    rng = random.Random(14)
    long = " ".join(rng.choice(["über", "straße", "window", "3.14", "don't", "漢字", "...", "\n\n", "x" * 40]) for _ in range(24_000))
    rows = [(1, long), (2, sentence(rng, 50)), (3, long + "▁"), (4, "z" * 70_000)]
    whole = alignment.align(documents(spark, rows), BYTES, PIECES, long=1 << 40)
    found = alignment.align(documents(spark, rows), BYTES, PIECES)
    assert len(long.encode()) > 3 * alignment.LONG
    assert sorted(whole.collect()) == sorted(found.collect())
    assert [r.n_a for r in found.orderBy("doc_id").collect()][2] == 0
    assert alignment.align(documents(spark, []), BYTES, PIECES).count() == 0


def test_fragments_compose_in_any_order(aligner):
    rng = random.Random(15)
    text = " " + " ".join(t for t in texts(rng) if t and "▁" not in t and "\x00" not in t and "<" not in t)
    tokens = aligner.tokens(text)
    want = aligner.groups(tokens)
    end = int(tokens.ends_a[-1])
    for _ in range(40):
        edges = sorted({0, end, *(rng.randrange(1, end) for _ in range(rng.choice((0, 1, 5, 40))))})
        parts, closed = [], []
        for low, high in zip(edges, edges[1:], strict=False):
            own, whole = fragment(tokens.between(low, high))
            parts.append(own)
            closed.append(whole)
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2], group = [(made := compose(parts[i], parts[i + 1]))[0]], made[1]
            closed.append(group)
        assert parts[0].closed and not len(parts[0].last.a)
        closed = sorted((c for c in (*closed, parts[0].first) if len(c.a)), key=lambda c: c.ends_a[0])
        found = [aligner.groups(c) for c in closed]
        assert b";".join(f.text for f in found) == want.text and sum(f.n for f in found) == want.n
        pairs = np.concatenate([np.repeat(f.pairs, f.times) for f in found])
        assert np.array_equal(np.sort(pairs), np.repeat(want.pairs, want.times))
    assert aligner.groups(NOTHING).n == 0


def test_stretches_tell_the_tokens_of_their_range(aligner):
    rng = random.Random(16)
    words = ["a", "über", "漢字", "x y", "...", "don't", "\n", "  ", "ж", "🙂", "　", "1,000", "internationalization"]
    for _ in range(60):
        text = " " + " ".join(rng.choice(words) for _ in range(rng.randrange(1, 120)))
        tokens = aligner.tokens(text)
        last = 0
        for low, high, base, stretch in ranges(text, rng.choice((5, 20, 64)), rng.choice((0, 16, 1000))):
            assert low == last and text.encode()[base : base + len(stretch.encode())].decode() == stretch
            own, want = aligner.tokens(stretch, base).between(low, high), tokens.between(low, high)
            assert all(np.array_equal(x, y) for x, y in zip(own.parts(), want.parts(), strict=True))
            last = high
        assert last == len(text.encode())
        raw = text.encode()
        for p in safe_places(np.frombuffer(raw, np.uint8)).tolist():
            assert raw[p] == 32 and not raw[:p].decode()[-1].isspace() and not raw[p + 1 :].decode()[0].isspace()
