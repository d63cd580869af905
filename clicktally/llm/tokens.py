"""Token ids, and the bytes of tokens, of tokenizer files.

A file is read on the driver, a few MB whatever the data, and travels to the tasks by broadcast, so
executors need no copy of it. Each Python worker builds its tokenizer once.
"""

from __future__ import annotations

import json
from functools import lru_cache
from pathlib import Path

import numpy as np
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

# Fixed value: the pattern by which byte-level BPE splits a text before it merges bytes.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The bytes that byte-level BPE writes as the character of the same number.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
# Fixed value: how a sentencepiece vocabulary writes a space.
_SPACE = "▁"


def shared_file(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a tokenizer file, for the tasks."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def _ragged(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum(lengths)])


class Vocabulary:
    """The bytes of every token: ``data[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, parts: list[bytes]):
        self.data, self.offsets = _ragged(parts)
        self.lengths = np.diff(self.offsets)

    def __len__(self) -> int:
        return len(self.lengths)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a row of tokens."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.offsets[ids] - (ends - lengths), lengths)
        return self.data[shift + np.arange(len(shift))]


class ByteLevel:
    """Byte-level BPE from a ``tokenizers`` file; special tokens in a text are plain text.

    Where merges come in the order of their ids, byte pairs merge by rank, so tiktoken gives the ids of
    ``tokenizers`` several times faster. Any other file is run by ``tokenizers`` itself.
    """

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model, special = spec["model"], {t["id"] for t in spec.get("added_tokens", ()) if t["special"]}
        byte_of = {chr(b): b for b in _PLAIN}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
        names = sorted(model["vocab"].items(), key=lambda item: item[1])
        size = max([i for _, i in names] + list(special)) + 1
        parts = [b""] * size
        for name, i in names:
            parts[i] = name.encode() if i in special else bytes(byte_of[c] for c in name)
        self.vocabulary = Vocabulary(parts)
        merged = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
        split = spec["pre_tokenizer"] or {}
        self._fast = self._slow = None
        if (
            merged == list(range(256, 256 + len(merged)))
            and spec["normalizer"] is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex")
            and not split.get("add_prefix_space")
            and not model.get("ignore_merges")
            and not model.get("dropout")
        ):
            ranks = {parts[i]: i for _, i in names if i not in special}
            self._fast = tiktoken.Encoding("byte-level", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        else:
            self._slow = Tokenizer.from_buffer(file)
            self._slow.encode_special_tokens = True

    def encode(self, text: str) -> list[int]:
        if self._fast is not None:
            return self._fast.encode_ordinary(text)
        return self._slow.encode(text, add_special_tokens=False).ids


class Pieces:
    """Sentencepiece; ``breaks`` says that no piece goes from another character into a space, so that a
    text falls apart before each of its spaces that follow one."""

    def __init__(self, file: bytes):
        self._model = sentencepiece.SentencePieceProcessor(model_proto=file)
        n = self._model.get_piece_size()
        names = [self._model.id_to_piece(i) for i in range(n)]
        self.breaks = not any(_SPACE in name.lstrip(_SPACE) for name in names)
        self.vocabulary = Vocabulary(
            [
                bytes([int(name[3:-1], 16)]) if self._model.is_byte(i) else name.replace(_SPACE, " ").encode()
                for i, name in enumerate(names)
            ]
        )

    def encode(self, text: str) -> list[int]:
        """Ids of the text with a space before it."""
        return self._model.encode(text)


@lru_cache(4)
def byte_level(file: bytes) -> ByteLevel:
    return ByteLevel(file)


@lru_cache(4)
def pieces(file: bytes) -> Pieces:
    return Pieces(file)
