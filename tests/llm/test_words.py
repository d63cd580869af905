"""Words, shingles and the index, against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from clicktally.llm import words
from clicktally.llm.fm_index import BREAK, FMIndex, suffix_array
from tests.llm.helpers import HARD_TEXTS, blank_words, plain_words, sentence, shingle_set


@pytest.mark.parametrize(("inside", "split"), [(words.BLANK_SEPARATED, blank_words), (words.ALPHANUMERIC, plain_words)])
@pytest.mark.parametrize("size", [1, 300, 1 << 20])
def test_words_and_shingles(inside, split, size):
    rng = random.Random(8)
    texts = [*HARD_TEXTS, *("".join(rng.choice("aB é\n.9_\t漢") for _ in range(rng.randrange(60))) for _ in range(200))]
    known: dict[str, int] = {}
    row = 0
    for run in words.runs(pa.array(texts), inside, size):
        assert run.first == row
        for i in range(len(run)):
            own = slice(run.bounds[i], run.bounds[i + 1])
            want = split(texts[row])
            assert len(run.hashes[own]) == len(want)
            assert all(known.setdefault(w, h) == h for w, h in zip(want, run.hashes[own].tolist(), strict=True))
            row += 1
        if inside is words.BLANK_SEPARATED:
            for at, found in words.shingles(run):
                assert len(found) == len(shingle_set(texts[at])) and np.all(found[1:] > found[:-1])
    assert row == len(texts) and len(set(known.values())) == len(known)


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": [sentence(random.Random(i), i) for i in range(50)], "i": list(range(50))})
    parts = list(words.slices(iter([batch, batch.slice(0, 0), batch.slice(7, 9)]), "text", 200))
    assert [i for p in parts for i in p["i"].to_pylist()] == [*range(50), *range(7, 16)] and len(parts) > 10


@pytest.mark.parametrize("seed", range(12))
def test_index_finds_all_places(seed):
    rng = np.random.default_rng(seed)
    sigma = int(rng.integers(1, 9))
    text = rng.integers(0, sigma + 1, int(rng.integers(1, 400)))
    text = np.append(np.tile(text, 1 + seed % 3), BREAK)
    order = suffix_array(text)
    # breaks differ by place, so a suffix is its symbols up to the break, and then that break's place
    ends = [i + int(np.argmax(text[i:] == BREAK)) for i in range(len(text))]
    keys = [(*((1, int(x)) for x in text[i : ends[i]]), (0, ends[i])) for i in range(len(text))]
    assert order.tolist() == sorted(range(len(text)), key=keys.__getitem__)
    index = FMIndex(text, sigma, sample=int(rng.integers(1, 20)))
    lengths = rng.integers(1, 6, 60)
    patterns = np.where(np.arange(5) >= 5 - lengths[:, None], rng.integers(1, sigma + 1, (60, 5)), 0)
    found, low, high = index.search(patterns, lengths)
    places = {int(f): sorted(index.locate(np.arange(a, b)).tolist()) for f, a, b in zip(found, low, high, strict=True)}
    for i in range(60):
        own = patterns[i, 5 - lengths[i] :]
        want = [p for p in range(len(text) - len(own)) if np.array_equal(text[p : p + len(own)], own)]
        assert places.get(i, []) == want
