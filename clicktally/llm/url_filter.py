"""Verdicts on URLs: host rules, and a bit-parallel automaton over wildcard patterns.

All glob patterns are packed into one multiword Shift-And automaton: a bit for every literal of every
pattern, with a loop where a ``*`` stands. One step over a byte moves all patterns of all URLs of a
batch. Host rules are globs too (the host itself, or any subdomain, then the start of the path), so
one walk over each canonical URL, its host and path, finds everything. A mark between the two, which
neither can hold, ends the host for the rules; the patterns do not see it.

The longest host rule that fits gives the verdict; without one, the longest pattern does; without
that, the URL is allowed. Defined results: a null URL or one without ``://`` has an empty host and
path, fits no host rule and is allowed; repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.words import raw

ALLOW, BLOCK = "allow", "block"
MARK = "#"  # between host and path

# Verdict, host and path of the host rules.
HOST_RULES = (
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
)
#: Verdict and glob over host and path. ``*`` stands for any text, all else for itself.
PATTERNS = (
    *((BLOCK, f"*{word}*") for word in (
        "casino", "cheap-pills", "spam-farm", "viagra", "pharmacy-online", "free-money", "payday-loan",
        "adult-video", "xxx-", "torrent-", "warez", "keygen", "clickbait-", "link-farm", "seo-spam",
    )),
    *((BLOCK, f"ads.*{end}") for end in ("/*", "")),
    *((BLOCK, f"*.{name}.*/*") for name in ("doubleclick", "adserver", "popads", "trackers")),
    *((BLOCK, f"*/{part}/*") for part in ("wp-admin", "cgi-bin", "cart", "checkout", "login", "tag-cloud")),
    *((BLOCK, f"*.{end}") for end in ("exe", "zip", "iso", "apk", "mp4", "mp3", "jpg", "png", "gif", "css", "js")),
    (ALLOW, "*.casino-history.example.org/*"),
)


@dataclass
class Automaton:
    """Shift-And masks of globs; bit 0 of each glob is its start.

    If ``parted`` is given, texts hold one ``MARK``. The first ``parted`` globs hold it too, and no ``*``
    passes it; to the others it is no part of the text.
    """

    starts: np.ndarray  # words of the state before the first byte
    loops: np.ndarray
    accept: np.ndarray  # word and bit of each glob's end
    masks: np.ndarray  # 256 rows
    holds: np.ndarray | None  # bits of the globs to which a mark is nothing

    @classmethod
    def of(cls, globs: Sequence[str], parted: int | None = None) -> Automaton:
        literals = [glob.replace("*", "").encode() for glob in globs]
        size = sum(len(x) + 1 for x in literals)
        words = -(-size // 64)
        starts, loops = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
        masks, accept, at = np.zeros((256, words), np.uint64), [], 0
        holds = None if parted is None else np.zeros(words, np.uint64)

        def bit(place: int) -> tuple[int, np.uint64]:
            return place // 64, np.uint64(1 << (place % 64))

        for i, (glob, literal) in enumerate(zip(globs, literals, strict=True)):
            word, one = bit(at)
            starts[word] |= one
            if parted is not None and i >= parted:
                for place in range(at, at + len(literal) + 1):
                    word, one = bit(place)
                    holds[word] |= one
            for byte in glob.encode():
                word, one = bit(at)
                if byte == ord("*"):
                    loops[word] |= one
                    continue
                at += 1
                word, one = bit(at)
                masks[byte, word] |= one
            accept.append(bit(at))
            at += 1
        return cls(starts, loops, np.array([(w, int(b).bit_length() - 1) for w, b in accept], dtype=np.int64).reshape(-1, 2), masks, holds)

    def matches(self, texts: pa.Array) -> np.ndarray:
        """Which texts (rows) match which globs (columns), as a whole."""
        data, offsets = raw(texts)
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")  # the texts that go on stay in front
        begin, sizes = offsets[:-1][order], sizes[order]
        state = np.repeat(self.starts[None], len(order), axis=0)
        for step in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -step, "left"))
            now = state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            byte = data[begin[:n] + step]
            moved &= self.masks[byte]
            if self.holds is not None and len(ends := np.flatnonzero(byte == ord(MARK))):
                held = (now[ends] & self.holds) | (moved[ends] & ~self.holds)
            else:
                ends = None
            now &= self.loops
            now |= moved
            if ends is not None:
                now[ends] = held
        found = np.empty((len(order), len(self.accept)), dtype=bool)
        found[order] = (state[:, self.accept[:, 0]] >> self.accept[:, 1].astype(np.uint64)) & np.uint64(1)
        return found


def _longest(found: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The column of the longest glob that matches, the first of equal ones, or -1."""
    best = np.where(found, lengths, -1)
    return np.where(found.any(axis=1), best.argmax(axis=1), -1) if found.shape[1] else np.full(len(found), -1)


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = HOST_RULES,
    patterns: Sequence[tuple[str, str]] = PATTERNS,
) -> DataFrame:
    """``page_id, host, path``, the ``rule`` and ``pattern`` that fit (or null) and the ``verdict``."""
    rules, patterns = list(rules), list(patterns)
    globs = [g for _, host, path in rules for g in (f"{host}{MARK}{path}*", f"*.{host}{MARK}{path}*")]
    automaton = Automaton.of(globs + [g for _, g in patterns], len(globs))
    rule_names = np.array([host + path for _, host, path in rules] + [None], dtype=object)
    glob_names = np.array([g for _, g in patterns] + [None], dtype=object)
    rule_says = np.array([v for v, *_ in rules] + [None], dtype=object)
    glob_says = np.array([v for v, _ in patterns] + [ALLOW], dtype=object)
    rule_sizes = np.array([len(x) for x in rule_names[:-1]])
    glob_sizes = np.array([len(x) for x in glob_names[:-1]])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                found = automaton.matches(part.column("canonical"))
                of_rules = found[:, : len(globs)].reshape(len(found), len(rules), 2).any(axis=2)
                rule = _longest(of_rules, rule_sizes)
                glob = _longest(found[:, len(globs) :], glob_sizes)
                verdict = np.where(rule >= 0, rule_says[rule], glob_says[glob])
                columns = [pa.array(x, pa.string()) for x in (rule_names[rule], glob_names[glob], verdict)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("page_id", "host", "path")), *columns],
                    ["page_id", "host", "path", "rule", "pattern", "verdict"],
                )

    split = "(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce("url", F.lit(""))
    host = F.translate(F.regexp_extract(url, split, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = pages.select(F.col("page_id").cast("bigint"), host.alias("host"), F.regexp_extract(url, split, 2).alias("path"))
    return parts.withColumn("canonical", F.concat("host", F.lit(MARK), "path")).mapInArrow(
        walk, "page_id bigint, host string, path string, rule string, pattern string, verdict string"
    )


def verdict_sql(table: str = "pages") -> str:
    """The same in SQL (DuckDB), for the rules and patterns of this module."""
    split = "(?s)^.*?://([^/?#]*)([^?#]*)"

    def like(glob: str) -> str:
        return glob.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%")

    rules = sorted(HOST_RULES, key=lambda r: -len(r[1] + r[2]))
    fits = "".join(
        f" WHEN (host = '{h}' OR host LIKE '%.{h}') AND path LIKE '{like(p)}%' ESCAPE '\\' THEN '{h}{p}'" for _, h, p in rules
    )
    globs = sorted(PATTERNS, key=lambda p: -len(p[1]))
    found = "".join(f" WHEN host || path LIKE '{like(g)}' ESCAPE '\\' THEN '{g}'" for _, g in globs)
    says = "".join(f" WHEN rule = '{h}{p}' THEN '{v}'" for v, h, p in rules)
    says += "".join(f" WHEN pattern = '{g}' THEN '{v}'" for v, g in globs)
    return f"""
        WITH parts AS (
            SELECT page_id,
                translate(regexp_extract(coalesce(url, ''), '{split}', 1),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '{split}', 2) AS path
            FROM {table}
        ), fitted AS (
            SELECT *, CASE{fits} END AS rule, CASE{found} END AS pattern FROM parts
        )
        SELECT page_id, host, path, rule, pattern, CASE{says} ELSE 'allow' END AS verdict FROM fitted
    """
