"""Small tables with hard rows, and plain Python forms of what the operators compute."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def lower(text: str) -> str:
    return text.translate(_LOWER)


def blank_words(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", lower(text or ""))


def plain_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def shingle_set(text: str | None) -> frozenset:
    words = blank_words(text)
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def documents(spark: SparkSession, texts: list, extra: bool = False) -> DataFrame:
    """``texts`` are texts, or pairs of id and text; sources and languages follow from the place."""
    rows = []
    for i, item in enumerate(texts):
        doc, text = item if isinstance(item, tuple) else (i, item)
        rows.append((doc, text, ("en", "de", None)[i % 3], ("a", "b", None, "")[i % 4], len(text or "")))
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:  # names that the operators use themselves
        for name in ("score", "key", "n", "spans", "mark", "items", "row", "host", "component_id", "rank"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def sentence(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def changed(rng: random.Random, text: str, n: int) -> str:
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


HARD_TEXTS = [None, "", "   \n\t ", "one", "é ß 漢字 \U0001f600 x", "!!! ... ###", "a b c d", "a b c d e", "A B C d e", "x " * 40_000]
