"""Joins of a huge left side: balanced if one key holds much of it, and moving only what may match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16


def hot_key_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, salts: int = SALTS) -> DataFrame:
    """Join ``left`` to a narrow ``right``, for ``inner``, ``left``, ``left_semi`` or ``left_anti``.

    The right side is repeated once per salt, and the left rows of one key are spread over the salts
    by a hash of their other columns, whatever layout they come in. Each left row still meets every
    right row of its key. Rows that are equal in all columns share a salt. A right side that Spark
    knows to be small is broadcast by it, and the left side is then not moved.

    A task gets about a ``salts``-th of a hot key: choose them by its size.
    """
    others = [F.col(f"`{c}`") for c in left.columns if c not in on]
    salted_left = left.withColumn("_salt", F.pmod(F.xxhash64(*others), F.lit(salts)) if others else F.lit(0).cast("bigint"))
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


# A filter's block: so many words of 64 bits. A key has its bits in one block.
_WORDS = 64
_HASHES = 4
#: Bits of the filter for each key, as long as there are fewer than MOST_BLOCKS (8 MB).
BITS_PER_KEY = 16
MOST_BLOCKS = 1 << 14


def _bits(keys: Sequence[Column], blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key, and its places there."""
    place = F.xxhash64(*keys, F.lit(2))
    size = 64 * _WORDS
    width = size.bit_length() - 1
    places = [F.shiftrightunsigned(place, i * width).bitwiseAND(F.lit(size - 1)).cast("int") for i in range(_HASHES)]
    return F.pmod(F.xxhash64(*keys, F.lit(1)), F.lit(blocks)), places


def may_be_in(rows: DataFrame, listed: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """``rows`` with a boolean column ``flag``: false for those that are certainly not ``listed``.

    A Bloom filter of the list, in blocks, is sent to the rows; it never grows beyond 8 MB, and with a
    list that is too long for that it lets more through. Rows without a key are not listed.
    """
    keys = listed.select(*(F.col(c).cast(rows.schema[c].dataType).alias(c) for c in on))
    blocks = max(1, min(MOST_BLOCKS, -(-keys.count() * BITS_PER_KEY // (64 * _WORDS))))
    block, places = _bits([F.col(c) for c in on], blocks)
    set_bits = keys.select(block.alias("_block"), F.explode(F.array(*places)).alias("_at"))
    words = set_bits.groupBy("_block", F.shiftright("_at", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, _at & 63)")).alias("_bits")
    )
    entries = F.map_from_entries(F.collect_list(F.struct("_word", "_bits")))  # 64 at most
    filled = words.groupBy("_block").agg(entries.alias("_map")).select(
        "_block",
        F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda i: F.coalesce(F.try_element_at("_map", i), F.lit(0).cast("bigint"))).alias("_words"),
    )
    tested = rows.withColumn("_block", block).join(F.broadcast(filled), "_block", "left")
    hit = F.col("_words").isNotNull()
    for c in on:
        hit = hit & F.col(c).isNotNull()
    for at in places:
        hit = hit & (F.getbit(F.get("_words", F.shiftright(at, 6)), at.bitwiseAND(F.lit(63))) == 1)
    return tested.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("_block", "_words")


def filtered_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, salts: int = SALTS) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of a huge ``left`` to a long list ``right``.

    Rows that a filter of the list excludes never move; only those that may be listed go to the join,
    which is exact. The left side is read twice: store it if it is costly.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"a filtered join is left_semi or left_anti, not {how!r}")
    tested = may_be_in(left, right, on, "_maybe")
    moved = hot_key_join(tested.filter("_maybe").drop("_maybe"), right, on, how, salts)
    if how == "left_semi":
        return moved
    return tested.filter("NOT _maybe").drop("_maybe").unionByName(moved)
