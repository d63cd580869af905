"""Secrets in documents: patterns, and parts of credentials that are only reported together.

Strong matches (an assignment to a secret's name, an access key, a long hexadecimal number) stand by
themselves. Weak ones (a user name, an address, a token that looks random) are parts of a credential:
an identifier or an address is reported if a secret lies within ``SCOPE`` code points, and a random
token if an identifier or an address does. The parts are linked by an interval join: an equality join
on document and stretch of text, with the distance as a condition.

Everything is made of built-in functions. Positions come from the lengths of the pieces between
matches, summed along the document by a window over its matches; only numbers are moved, not texts.
The matches, a small part of the texts, are stored once, so no pattern runs twice over a text.

Defined results: null is an empty text, which has no spans; whole texts are scanned, however long;
rows with the same id and text have the same spans, each of them is returned; a row without id is
treated like any other; equal places go by the order of ``KINDS``; spans count code points, and their
end is exclusive; no documents give no rows. Other columns, whatever their names, are kept by
``redact`` and not looked at otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktally.llm.store import stored

SCOPE = 200
IDENTIFIER, SECRET, ADDRESS = "identifier", "secret", "address"


@dataclass(frozen=True)
class Kind:
    name: str
    role: str
    strong: bool
    pattern: str
    value: int = 0  # the group that must be long enough, counted with the whole match as 1
    least: int = 0
    words: tuple[str, ...] = ()  # lower-case texts, one of which every match contains


# Fixed patterns; the first three and their order are given.
KINDS = (
    Kind(
        "assign",
        SECRET,
        True,
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        3,
        6,
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
    ),
    # of a run that is too short, no later part is long enough: the length can stand in the pattern
    Kind("access", IDENTIFIER, True, r"AKIA[A-Z0-9]{16,}", words=("akia",)),
    Kind("hex", SECRET, True, r"[0-9a-f]{24,}"),
    Kind(
        "ident",
        IDENTIFIER,
        False,
        r"""(?i)\b(?:user(?:name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{3,}""",
        words=("user", "login", "account", "client", "access"),
    ),
    Kind(
        "address",
        ADDRESS,
        False,
        r"""(?i)\b(?:(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]{3,}"""
        r"""|(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}(?::[0-9]+)?)""",
        words=("://", "host", "endpoint", "server"),
    ),
    Kind(
        "random",
        SECRET,
        False,
        r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}",
    ),
)
_WEAK_WORDS = tuple(w for k in KINDS if k.role != SECRET for w in k.words)


def _any_of(text: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return found


def _may_have(kind: Kind, text: Column, lower: Column) -> Column:
    """A cheap condition that every text with a match fulfils."""
    if kind.words:
        return _any_of(lower, kind.words)
    if kind.strong:
        return text.rlike(kind.pattern)
    return _any_of(lower, _WEAK_WORDS)  # useless without an identifier or an address


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint"), text.alias("text"), F.xxhash64(text).alias("mark"))


def parts(docs: DataFrame) -> DataFrame:
    """All matches of all kinds, once for rows with equal id and text: ``doc_id, mark, kind, start, end``."""
    text, lower = F.col("text"), F.col("lower")

    def matches(i: int, kind: Kind) -> Column:
        whole = F.lit(f"({kind.pattern})")
        sizes = F.transform(F.regexp_extract_all(text, whole, F.lit(1)), F.length)
        good = F.regexp_extract_all(text, whole, F.lit(kind.value or 1))
        fields = F.arrays_zip(
            F.transform(F.split(text, kind.pattern, -1), F.length).alias("before"),
            sizes.alias("size"),
            F.transform(good, lambda v: F.length(v) >= kind.least).alias("good"),
        )
        none = F.array().cast("array<struct<before:int,size:int,good:boolean>>")
        return F.struct(F.lit(i).alias("kind"), F.when(_may_have(kind, text, lower), fields).otherwise(none).alias("found"))

    per_kind = (
        _keyed(docs)
        .withColumn("lower", F.lower("text"))
        .select("doc_id", "mark", F.explode(F.array(*(matches(i, k) for i, k in enumerate(KINDS)))).alias("k"))
        .where(F.size("k.found") > 1)
    )
    pieces = per_kind.select("doc_id", "mark", "k.kind", F.posexplode("k.found").alias("at", "f")).where("f.size IS NOT NULL")
    pieces = pieces.select("doc_id", "mark", "kind", "at", "f.*").distinct()
    along = Window.partitionBy("doc_id", "mark", "kind").orderBy("at")
    end = F.sum(F.col("before").cast("bigint") + F.col("size")).over(along)
    return (
        pieces.withColumn("end", end)
        .where("good")
        .select("doc_id", "mark", "kind", (F.col("end") - F.col("size")).alias("start"), "end")
    )


def _of(kinds: DataFrame, *wanted: int) -> DataFrame:
    return kinds.where(F.col("kind").isin(*wanted))


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The parts to report: strong ones, and weak ones with a complementary part within the scope."""
    strong = [i for i, k in enumerate(KINDS) if k.strong]
    weak = [i for i, k in enumerate(KINDS) if not k.strong]
    role = F.element_at(F.array(*(F.lit(k.role) for k in KINDS)), F.col("kind") + 1)
    roles = found.withColumn("role", role).withColumn("is_strong", F.col("kind").isin(*strong))
    # an interval may lie in several stretches, and so does all that is within the scope of it
    width = F.lit(scope)
    near = roles.select(
        *(F.col(c).alias(f"o_{c}") for c in ("doc_id", "mark", "start", "end", "role", "is_strong")),
        F.explode(
            F.sequence(F.floor((F.col("start") - width - 1) / width), F.floor((F.col("end") + width) / width))
        ).alias("o_stretch"),
    )
    own = roles.where(~F.col("is_strong")).withColumn(
        "stretch", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width)))
    )
    pairs = own.join(
        near,
        F.col("doc_id").eqNullSafe(F.col("o_doc_id"))
        & (F.col("mark") == F.col("o_mark"))
        & (F.col("stretch") == F.col("o_stretch"))
        & (F.col("start") - F.col("o_end") <= width)
        & (F.col("o_start") - F.col("end") <= width),
    )
    overlaps = (F.col("start") < F.col("o_end")) & (F.col("o_start") < F.col("end"))
    complements = ~overlaps & ((F.col("role") == SECRET) != (F.col("o_role") == SECRET))
    linked = (
        pairs.groupBy("doc_id", "mark", "kind", "start", "end")
        .agg(F.max(complements).alias("linked"), F.max(overlaps & F.col("o_is_strong")).alias("covered"))
        .where("linked AND NOT covered")
    )
    return _of(found, *strong).unionByName(linked.select(*found.columns)) if weak else found


def _text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    names = F.array(*(F.lit(k.name) for k in KINDS))
    written = F.transform(
        spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.concat_ws(",", written)


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: ``doc_id``, and ``spans``: structs ``start, kind, end`` in order, with the
    kind as its place in ``KINDS``."""
    spans = (
        link(stored(parts(docs), "parts"), scope)
        .groupBy("doc_id", "mark")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    )
    keyed = _keyed(docs).drop("text")
    spans = spans.select(F.col("doc_id").alias("o_doc_id"), F.col("mark").alias("o_mark"), "spans")
    joined = keyed.join(
        spans, keyed.doc_id.eqNullSafe(spans.o_doc_id) & (keyed.mark == spans.o_mark), "left"
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return joined.select("doc_id", "mark", F.coalesce("spans", none).alias("spans"))


def report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``scan`` with counts per strong kind and the spans as text."""
    spans = F.col("spans")

    def number(i: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == i)).cast("bigint")

    strong = F.filter(spans, lambda s: s["kind"].isin([i for i, k in enumerate(KINDS) if k.strong]))
    return scan(docs, scope).select(
        "doc_id",
        *(number(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS) if k.strong),
        F.sha2(_text(strong), 256).alias("base_sha256"),
        _text(spans).alias("spans"),
    )


def redact(docs: DataFrame, scope: int = SCOPE, mark: str = "[removed]") -> DataFrame:
    """The same rows and columns, with every span in ``text`` replaced by ``mark``."""
    spans = (
        link(stored(parts(docs), "parts"), scope)
        .groupBy("doc_id", "mark")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
        .select(F.col("doc_id").alias("span_doc"), F.col("mark").alias("span_mark"), F.col("spans").alias("span_list"))
    )
    names = docs.columns
    row = docs.select(F.struct(*names).alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    joined = row.join(
        spans,
        F.col("row.doc_id").cast("bigint").eqNullSafe(F.col("span_doc")) & (F.xxhash64(text) == F.col("span_mark")),
        "left",
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        between = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        return F.when(span["end"] <= state["at"], state).otherwise(
            F.struct(
                span["end"].alias("at"),
                F.when(span["start"] < state["at"], state["out"])
                .otherwise(F.concat(state["out"], between, F.lit(mark)))
                .alias("out"),
            )
        )

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))

    clean = F.when(F.col("span_list").isNull(), F.col("row.text")).otherwise(
        F.aggregate("span_list", start, step, finish)
    )
    return joined.select(*(clean.alias("text") if n == "text" else F.col(f"row.`{n}`").alias(n) for n in names))
