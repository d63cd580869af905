"""Kept result tables as partitioned parquet.

A table keeps every batch in a folder of its own, ``run=R/batch=B``, below that by ``date``. A
write replaces exactly the folder of its batch, so a batch that is delivered again gives the same
table, whatever was lost half-way, and no write has to read or rewrite earlier data. How batches
meet (latest count, sum, newest group, or all rows) is decided on reading, in one aggregation by
the table's key; a filter on ``date`` reaches the partitions.

:func:`fold` brings the batches of closed dates together while a job goes on writing: it writes their
merged rows to ``_folds/rows`` and then, in one file, which dates and versions they stand for. Readers
take the rows of a fold and leave out what it stands for; a fold without that file is not there.
:func:`remove_folded` deletes what no reader takes any more. :func:`compact` copies a whole table.

A delete writes rows that are marked as such and take away what was before them, see
:func:`delete_keys`.

``batch`` numbers grow within a ``run``; use a higher run for each new checkpoint. One writer per
table, and one that folds.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from clicktally.config import if_exists
from clicktally.operators.stored import split_by_key
from clicktally.schemas import TableSpec

# Batches per run; a run and a batch make one BIGINT version.
_BATCHES = 10**12
# Where a table and a checkpoint keep the id that ties them; hidden from Spark's readers.
_OWNER = "_stream"
# Compacted rows come before every run.
_COMPACTED_RUN = -1
# What else lies beside the batches, hidden from Spark's readers of the whole folder.
_FOLDS, _AFFECTED, _COPY = "_folds", "_affected", "_copy"
# Marks a row that takes away what was stored for its key.
_DELETED = "_deleted"


_SETTING = threading.RLock()


@dataclass(frozen=True)
class ResultTable:
    """A table of a given kind at a path."""

    spec: TableSpec
    path: str


@dataclass(frozen=True)
class Fold:
    """Rows of the dates ``first`` to ``last`` (all rows, without dates) up to a version, in one place."""

    number: int
    first: str | None
    last: str | None
    upto: int

    def stands_for(self, dated: bool) -> Column:
        """Which dates a fold covers; never null."""
        if not dated or self.first is None:
            return F.lit(True)
        return F.coalesce(F.col("date").between(self.first, self.last), F.lit(False))


_FOLD = "fold int, first string, last string, upto bigint"


def _version() -> Column:
    return F.col("run") * F.lit(_BATCHES) + F.col("batch")


def folds(spark: SparkSession, table: ResultTable) -> list[Fold]:
    """The folds of a table, oldest first; a row each, and those that a later one covers are left out."""
    found = if_exists(lambda: spark.read.schema(_FOLD).parquet(f"{table.path}/{_FOLDS}/done"))
    every = [Fold(r.fold, r.first, r.last, r.upto) for r in found.orderBy("fold").collect()] if found is not None else []
    return [
        f for f in every
        if not any(g.number > f.number and (g.first is None or (f.first is not None and g.first <= f.first and f.last <= g.last)) for g in every)
    ]


def _log(spark: SparkSession, table: ResultTable, done: Sequence[Fold] | None = None) -> DataFrame:
    """The rows that count: of the batches what no fold stands for, and of each fold what no later one does.

    Versions and dates are folders, so what is left out is not read.
    """
    done = folds(spark, table) if done is None else done
    dated = bool(table.spec.partition_columns)
    own = [*table.spec.schema.fields, StructField(_DELETED, BooleanType())]
    versions = [StructField("run", LongType()), StructField("batch", LongType())]
    schema = StructType([*own, *versions])
    rows = if_exists(lambda: spark.read.schema(schema).parquet(table.path))
    rows = spark.createDataFrame([], schema) if rows is None else rows.select(*schema.names)
    for f in done:
        rows = rows.filter(~(f.stands_for(dated) & (_version() <= F.lit(f.upto))))
    if not done:
        return rows
    folded = spark.read.schema(StructType([*schema.fields, StructField("fold", LongType())])).parquet(f"{table.path}/{_FOLDS}/rows")
    folded = folded.filter(F.col("fold").isin([f.number for f in done]))
    for f in done:
        folded = folded.filter(~(f.stands_for(dated) & (F.col("fold") < f.number)))
    return rows.unionByName(folded.select(*schema.names))


def change_log(spark: SparkSession, table: ResultTable) -> DataFrame:
    """All rows of all batches, with ``run`` and ``batch``; of what was folded the merged rows."""
    return _log(spark, table).filter(~F.coalesce(F.col(_DELETED), F.lit(False))).drop(_DELETED)


def _merged(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """What the rows of a log come to, with the ``version`` that each row stands at.

    One aggregation by the key, or one ranking: Spark limits it before the shuffle to the newest rows.
    """
    names = spec.schema.names
    gone = F.coalesce(F.col(_DELETED), F.lit(False))
    rows = rows.withColumn("version", _version())
    if spec.merge == "append":
        return rows.select(*names, "version")
    if spec.merge == "sum":
        found = rows.groupBy(*spec.keys).agg(
            F.sum("clickCount").alias("clickCount"),
            F.max(F.when(~gone, F.col("version"))).alias("version"),
            F.max(F.when(gone, F.col("version"))).alias("_gone"),
        )
        return found.filter("version > coalesce(_gone, version - 1)").select(*names, "version")
    if spec.merge == "sketch":
        united = F.hll_union_agg("visitors").alias("visitors")
        found = rows.groupBy(*spec.keys).agg(F.sum("clickCount").alias("clickCount"), united, F.max("version").alias("version"))
        return found.select(*names, "version")
    if spec.merge == "latest":
        # single values: a struct would need a sort
        newest = [F.max_by(c, "version").alias(name) for c, name in ((F.col("clickCount"), "clickCount"), (gone, "_gone"))]
        found = rows.groupBy(*spec.keys).agg(*newest, F.max("version").alias("version")).filter("NOT _gone")
        return found.select(*names, "version")
    place = F.rank().over(Window.partitionBy(*spec.keys).orderBy(F.desc("version")))
    return rows.withColumn("_place", place).filter("_place = 1").filter(~gone).select(*names, "version")


def read_table(
    spark: SparkSession, table: ResultTable, before: tuple[int, int] | None = None
) -> DataFrame:
    """The rows of a table, or those it had ``before`` a (run, batch) was written.

    What a table was before a version that is folded is not kept.
    """
    done = folds(spark, table)
    rows = _log(spark, table, done)
    if before is not None:
        run, batch = before
        if any(f.upto >= run * _BATCHES + batch for f in done):
            raise ValueError(f"{table.path}: run {run} batch {batch} is folded")
        rows = rows.filter((F.col("run") < run) | ((F.col("run") == run) & (F.col("batch") < batch)))
    return _merged(rows, table.spec).drop("version")


def read_keys(spark: SparkSession, table: ResultTable, column: str, values: Sequence[object]) -> DataFrame:
    """The rows of a few values of a key column.

    The filter goes below the merge and into the files. Folded ones are sorted by key and have Bloom
    filters on ``userid``, so that row groups without these users are not read; up to
    ``spark.sql.parquet.pushdown.inFilterThreshold`` values are looked for one by one.
    """
    if column not in table.spec.keys:
        raise ValueError(f"{column} is no part of the key of {table.spec.name}")
    return read_table(spark, table).filter(F.col(column).isin(list(values)))


def is_empty(spark: SparkSession, table: ResultTable) -> bool:
    return _log(spark, table).isEmpty()


def batch_rows(spark: SparkSession, table: ResultTable, batch: int, run: int = 0) -> int:
    """How many rows a batch wrote that is not folded; answered from the file footers."""
    log = change_log(spark, table)
    return log.filter((F.col("run") == run) & (F.col("batch") == batch)).count()


def _mark(spark: SparkSession, path: str) -> str | None:
    """The id that a stream has left in a folder."""
    found = if_exists(lambda: spark.read.text(path))
    row = found.first() if found is not None else None
    return row[0] if row is not None else None


def _leave_mark(spark: SparkSession, path: str, mark: str) -> None:
    spark.range(1).select(F.lit(mark).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def bind(spark: SparkSession, table: ResultTable, checkpoint: str) -> None:
    """Tie a table to the checkpoint of the stream that fills it; refuse any other pair.

    A new checkpoint would count from zero over stored counts, and an old one with a new table would
    leave out what it has counted before. Both folders keep the same id, and a compacted table takes
    it along. An empty table and a new checkpoint are tied at the first start.
    """
    own, other = f"{table.path}/{_OWNER}", f"{checkpoint}/{_OWNER}"
    in_table, in_checkpoint = _mark(spark, own), _mark(spark, other)
    if in_table is not None and in_table == in_checkpoint:
        return
    started = in_checkpoint or if_exists(lambda: spark.read.text(f"{checkpoint}/metadata")) is not None
    if started:
        raise ValueError(f"{checkpoint} has counted into another table than {table.path}")
    if not is_empty(spark, table):
        raise ValueError(
            f"{table.path} holds rows but {checkpoint} is new: give a new table path and read the "
            "feed from its earliest position"
        )
    mark = uuid.uuid4().hex
    _leave_mark(spark, own, mark)
    _leave_mark(spark, other, mark)


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for one write. Spark turns it off for streams with state, and with it the
    rebalance of what their batches write, which would leave a file per shuffle partition and date.
    """
    name = "spark.sql.adaptive.enabled"
    with _SETTING:  # writes of one session take turns, so that none leaves it changed
        before = spark.conf.get(name)
        spark.conf.set(name, "true")
        try:
            yield
        finally:
            spark.conf.set(name, before)


def _save(
    rows: DataFrame,
    path: str,
    parts: Sequence[str],
    then: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace one folder.

    One date may hold most rows: the rebalance splits it into files of normal size and brings small
    dates together in one task each. It is a hint, which counts if adaptive execution is on when it is
    given. What is to be done ``then`` comes after the last shuffle.
    """
    with _adaptive(rows.sparkSession):
        if parts:
            rows = rows.hint("rebalance", *parts)
        writer = then(rows).write.mode("overwrite").options(**(options or {})).option("partitionOverwriteMode", "static")
        if parts:
            writer = writer.partitionBy(*parts)
        writer.parquet(path)


def _write(rows: DataFrame, table: ResultTable, run: int, batch: int, counts: Sequence[str] = ()) -> dict[str, int]:
    """Replace the folder of one batch; how many rows have each of the ``counts`` as their ``action``.

    They are counted by the tasks that write, after the last shuffle, so in no task twice.
    """
    parts = table.spec.partition_columns
    path = f"{table.path}/run={run}/batch={batch}"
    if not counts:
        _save(rows, path, parts)
        return {}
    seen = Observation()
    of = [F.coalesce(F.count_if(F.col("action") == c), F.lit(0)).alias(c) for c in counts]
    _save(rows, path, parts, lambda found: found.observe(seen, *of).drop("action"))
    return {c: seen.get[c] for c in counts}


def _require_merge(table: ResultTable, merge: str) -> None:
    if table.spec.merge != merge:
        raise ValueError(f"{table.spec.name} is kept by '{table.spec.merge}', not by '{merge}'")


def _require_number(run: int, batch: int) -> None:
    if run < 0 or not 0 <= batch < _BATCHES:
        raise ValueError(f"run and batch must not be negative: {run}, {batch}")


def _no_key(keys: tuple[str, ...]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    if "date" in keys:
        missing = missing | (F.col("date") == "")
    return missing


def _checked(rows: DataFrame, failure: Column, text: str) -> DataFrame:
    """Fail the write where ``failure`` holds, in the pass that writes."""
    guarded = F.when(failure, F.raise_error(F.lit(text))).otherwise(F.col("clickCount"))
    return rows.withColumn("clickCount", guarded)


def append(new: DataFrame, table: ResultTable, batch: int, run: int = 0) -> None:
    """Add rows as they are. A repeated delivery of a batch does not add them again.

    Key parts may be null; an empty date is refused, as a partition it would come back as null.
    """
    _require_merge(table, "append")
    _require_number(run, batch)
    rows = new.select(*table.spec.schema.names)
    if table.spec.partition_columns:
        rows = _checked(rows, F.col("date") == "", f"{table.spec.name}: empty date")
    _write(rows, table, run, batch)


def _near(new: DataFrame, table: ResultTable, before: tuple[int, int]) -> DataFrame:
    """The stored rows that (cached) new ones may meet: their range of dates and their keys only."""
    spec = table.spec
    stored = read_table(new.sparkSession, table, before)
    if spec.partition_columns:
        first, last = new.agg(F.min("date"), F.max("date")).first()
        stored = stored.filter(F.col("date").between(first, last))
    # With few new rows Spark broadcasts their keys and filters before the table is merged.
    return stored.join(new.select(*spec.keys), list(spec.keys), "left_semi")


def _upsert(rows: DataFrame, table: ResultTable, run: int, batch: int, counted: bool) -> dict[str, int]:
    """Write merged rows of a batch; if ``counted``, with how many keys were stored before and how many not.

    The counts lie beside the table, see :func:`affected_rows`. The look at the table leaves out this
    very batch, so a batch that is delivered again has the same counts.
    """
    names = table.spec.schema.names
    if not counted:
        return _write(rows.select(*names), table, run, batch)
    spark = rows.sparkSession
    cached = rows.select(*names).persist()
    try:
        marked = split_by_key(cached, _near(cached, table, (run, batch)), table.spec.keys)
        found = _write(marked, table, run, batch, ("update", "insert"))
    finally:
        cached.unpersist()
    row = spark.range(1).select(*(F.lit(n).cast("bigint").alias(c) for c, n in found.items()))
    row.coalesce(1).write.mode("overwrite").parquet(f"{table.path}/{_AFFECTED}/run={run}/batch={batch}")
    return found


def affected_rows(spark: SparkSession, table: ResultTable) -> DataFrame:
    """``run, batch, update, insert``: how many stored keys each counted batch met, and how many new ones."""
    kind = "run bigint, batch bigint, `update` bigint, `insert` bigint"
    found = if_exists(lambda: spark.read.schema(kind).parquet(f"{table.path}/{_AFFECTED}"))
    names = ("run", "batch", "update", "insert")
    return spark.createDataFrame([], kind) if found is None else found.select(*names)


def upsert_overwrite(
    new: DataFrame, table: ResultTable, batch: int, run: int = 0, unique: bool = False, counted: bool = False
) -> dict[str, int]:
    """Set the count of each key, whether the key is stored or not.

    Fails on a missing key part or a key given twice; ``unique=True`` says that the rows come from
    a grouping by the key, which saves the check for the latter. With ``counted``, how many keys were
    an ``update`` and how many an ``insert`` is returned and kept.
    """
    spec = table.spec
    _require_merge(table, "latest")
    _require_number(run, batch)
    rows = new.select(*spec.schema.names)
    failure = _no_key(spec.keys)
    if not unique:
        rows = rows.groupBy(*spec.keys).agg(
            F.max("clickCount").alias("clickCount"), F.count(F.lit(1)).alias("_rows")
        )
        failure = failure | (F.col("_rows") > 1)
    rows = _checked(rows, failure, f"{spec.name}: a key has a missing part or comes twice")
    return _upsert(rows, table, run, batch, counted)


def upsert_accumulate(
    new: DataFrame, table: ResultTable, batch: int, run: int = 0, counted: bool = False
) -> dict[str, int]:
    """Add counts to those stored; rows of one key in a batch are summed first. ``counted`` as above."""
    spec = table.spec
    _require_merge(table, "sum")
    _require_number(run, batch)
    rows = new.groupBy(*spec.keys).agg(F.sum("clickCount").alias("clickCount"))
    rows = _checked(rows, _no_key(spec.keys), f"{spec.name}: a key has a missing part")
    return _upsert(rows, table, run, batch, counted)


def add_visitors(new: DataFrame, table: ResultTable, batch: int, run: int = 0) -> None:
    """Add page views and sketches of visitors, a row per key; a visitor who is known already adds nothing."""
    spec = table.spec
    _require_merge(table, "sketch")
    _require_number(run, batch)
    rows = _checked(new.select(*spec.schema.names), _no_key(spec.keys), f"{spec.name}: a key has a missing part")
    _write(rows, table, run, batch)


def replace_groups(new: DataFrame, table: ResultTable, batch: int, run: int = 0) -> None:
    """Replace all rows of every key group in ``new``; other groups stay. Keeps repeated rows."""
    spec = table.spec
    _require_merge(table, "group")
    _require_number(run, batch)
    rows = new.select(*spec.schema.names)
    rows = _checked(rows, _no_key(spec.keys), f"{spec.name}: a group has a missing part")
    _write(rows, table, run, batch)


def _deletions(gone: DataFrame, table: ResultTable, run: int, batch: int) -> DataFrame:
    """Rows that take the keys in ``gone`` away; in a table of sums with what they come to, turned round."""
    spec = table.spec
    empty = {f.name: F.lit(None).cast(f.dataType) for f in spec.schema.fields if f.name not in spec.keys}
    if spec.merge == "sum":
        stored = read_table(gone.sparkSession, table, before=(run, batch))
        rows = stored.join(gone.select(*spec.keys).distinct(), list(spec.keys), "left_semi")
        rows = rows.withColumn("clickCount", -F.col("clickCount"))
    else:
        rows = gone.select(*spec.keys).distinct().withColumns(empty)
    return rows.select(*spec.schema.names, F.lit(True).alias(_DELETED))


def delete_keys(gone: DataFrame, table: ResultTable, batch: int, run: int = 0) -> None:
    """Delete the rows of all keys in ``gone`` (key groups, in a table kept by groups), as a batch.

    A key that is not stored is no error, and one that comes in a later batch is there again. A batch
    that is delivered again deletes the same.
    """
    if table.spec.merge in ("append", "sketch"):
        raise ValueError(f"{table.spec.name} is kept by {table.spec.merge!r}: it has no keys, or visitors that can't be taken out")
    _require_number(run, batch)
    rows = _deletions(gone.filter(~_no_key(table.spec.keys)), table, run, batch)
    _write(rows, table, run, batch)


def _by_date(rows: DataFrame, name: str) -> DataFrame:
    """Rows and a sum of hashes per date, as one struct."""
    mark = F.sum(F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns)).cast("decimal(38,0)"))
    return rows.groupBy("date").agg(F.struct(F.count("*").alias("n"), mark.alias("mark")).alias(name))


def repair(recount: DataFrame, table: ResultTable, batch: int, first: str, last: str, run: int = 0) -> dict[str, int]:
    """Make the stored counts of the dates ``first`` to ``last`` those of ``recount``, as a batch.

    ``recount`` has the counts of these dates, taken anew from the feed. Both sides are compared by a sum
    of hashes per date, and by key only in dates that differ. Returns how many keys were ``altered``,
    ``lost`` and ``extra``; only these are written. No state is needed, and other dates are not read.
    """
    spec = table.spec
    if spec.merge not in ("latest", "sum") or "date" not in spec.keys:
        raise ValueError(f"{spec.name} is kept by {spec.merge!r}: only counts per date are repaired")
    _require_number(run, batch)
    spark, names, keys = recount.sparkSession, spec.schema.names, list(spec.keys)
    inside = F.col("date").between(first, last)
    new = recount.select(*names).filter(inside).persist()
    try:
        stored = read_table(spark, table, before=(run, batch)).filter(inside).select(*names)
        both = _by_date(new, "new").join(_by_date(stored, "old"), "date", "full")
        dates = [r.date for r in both.filter("NOT new <=> old").select("date").collect()]  # a row per date
        if not dates:
            return dict.fromkeys(("altered", "lost", "extra"), 0)
        named = [
            rows.filter(F.col("date").isin(dates)).select(*keys, F.col("clickCount").alias(name), F.lit(True).alias(f"in_{name}"))
            for rows, name in ((new, "new"), (stored, "old"))
        ]
        action = (
            F.when(F.col("in_old").isNull(), "lost").when(F.col("in_new").isNull(), "extra")
            .when(~F.col("new").eqNullSafe(F.col("old")), "altered").alias("action")
        )
        differ = named[0].join(named[1], keys, "full").select(*keys, "new", "old", action).filter("action IS NOT NULL")
        extra = F.col("action") == "extra"
        zero = F.lit(0).cast("bigint")
        if spec.merge == "sum":  # what has to be added
            count = F.coalesce("new", zero) - F.coalesce("old", zero)
        else:
            count = F.when(~extra, F.col("new"))
        rows = differ.withColumns({"clickCount": count, _DELETED: extra}).select(*names, _DELETED, "action")
        rows = _checked(rows, _no_key(spec.keys), f"{spec.name}: a key has a missing part")
        return _write(rows, table, run, batch, ("altered", "lost", "extra"))
    finally:
        new.unpersist()


def fold(spark: SparkSession, table: ResultTable, first: str | None = None, last: str | None = None) -> Fold | None:
    """Bring the batches of the dates ``first`` to ``last`` together, beside a job that goes on writing.

    The newest batch, which may still be written or come again, is left as it is. The rows come first
    and the file that makes them count comes last, so a stop at any point leaves the table as it was;
    the next call then writes anew. Late rows of a folded date count on top of it. Without dates, all
    rows of the table are folded.
    """
    if (first is None) != (last is None) or (first is not None and not table.spec.partition_columns):
        raise ValueError("a first and a last date, or none of them")
    done = folds(spark, table)
    log = _log(spark, table, done)
    version = _version()
    newest = log.agg(F.max(version)).first()[0]
    upto = log.filter(version < F.lit(newest)).agg(F.max(version)).first()[0] if newest is not None else None
    if upto is None or upto <= max((f.upto for f in done if (f.first, f.last) == (first, last)), default=-1 - _BATCHES):
        return None
    written = if_exists(lambda: spark.read.schema(_FOLD).parquet(f"{table.path}/{_FOLDS}/done"))
    number = 1 + ((written.agg(F.max("fold")).first()[0] or 0) if written is not None else 0)
    own = Fold(number, first, last, upto)
    dated = bool(table.spec.partition_columns)
    rows = _merged(log.filter(own.stands_for(dated) & (version <= F.lit(upto))), table.spec)
    low = F.floor(F.col("version") / F.lit(_BATCHES)).cast("bigint")
    rows = rows.withColumns({"run": low, "batch": F.col("version") - low * F.lit(_BATCHES)}).drop("version")
    # sorted, so that a look for few users skips most row groups by their ranges and Bloom filters
    by = table.spec.keys or table.spec.schema.names
    options = {"parquet.bloom.filter.enabled#userid": "true"} if "userid" in table.spec.schema.names else {}
    path = f"{table.path}/{_FOLDS}/rows/fold={number}"
    _save(rows, path, table.spec.partition_columns, lambda found: found.sortWithinPartitions(*by), options)
    row = spark.createDataFrame([(number, first, last, upto)], _FOLD)
    row.coalesce(1).write.mode("append").parquet(f"{table.path}/{_FOLDS}/done")
    return own


def remove_folded(spark: SparkSession, table: ResultTable) -> int:
    """Delete the folders that no reader takes any more, and return how many.

    A reader that started before the fold may still read them: wait until those have ended.
    """
    done, dated = folds(spark, table), bool(table.spec.partition_columns)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(table.path).getFileSystem(spark._jsc.hadoopConfiguration())
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName

    def covered(date: str | None, version: int, after: int) -> bool:
        return any(
            f.number > after and version <= f.upto and (f.first is None or (date is not None and f.first <= date <= f.last)) for f in done
        )

    def found(pattern: str) -> list:
        return list(files.globStatus(path(f"{table.path}/{pattern}")) or ())

    gone = []
    for status in found("run=*/batch=*/date=*" if dated else "run=*/batch=*"):
        parts = dict(part.split("=", 1) for part in status.getPath().toString().split("/") if part.startswith(("run=", "batch=", "date=")))
        date = unescape(parts["date"]) if dated else None
        if covered(date, int(parts["run"]) * _BATCHES + int(parts["batch"]), 0):
            gone.append(status.getPath())
    newest = max((f.number for f in done), default=0)
    for status in found(f"{_FOLDS}/rows/fold=*/date=*" if dated else f"{_FOLDS}/rows/fold=*"):
        parts = dict(part.split("=", 1) for part in status.getPath().toString().split("/") if part.startswith(("fold=", "date=")))
        date, number = unescape(parts["date"]) if dated else None, int(parts["fold"])
        if number <= newest and (covered(date, -_BATCHES, number) or number not in {f.number for f in done}):
            gone.append(status.getPath())
    for folder in gone:
        files.delete(folder, True)
    for status in found("run=*/batch=*") if dated else ():
        if not [x for x in files.listStatus(status.getPath()) if x.isDirectory()]:
            files.delete(status.getPath(), True)
    return len(gone)


def compact(spark: SparkSession, table: ResultTable, target_path: str) -> ResultTable:
    """Copy a table to a new path with its merged rows in one batch folder.

    The newest batch, which a restarted stream may deliver again, stays a batch of its own. The
    source is not touched; switch the writer over while it is stopped. The tie to the writer's
    checkpoint goes along. A copy that was stopped half-way is made anew by the next call.
    """
    target = ResultTable(table.spec, target_path)
    begun, ended = f"{target_path}/{_COPY}/begun", f"{target_path}/{_COPY}/ended"
    half = _mark(spark, begun) is not None and _mark(spark, begun) != _mark(spark, ended)
    if not half and not is_empty(spark, target):
        raise ValueError(f"{target_path} holds a table already")
    log = _log(spark, table)
    newest = log.agg(F.max(_version())).first()[0]
    if newest is None:
        return target
    copy = uuid.uuid4().hex
    _leave_mark(spark, begun, copy)
    run, batch = divmod(newest, _BATCHES)
    if run > _COMPACTED_RUN:
        _write(read_table(spark, table, before=(run, batch)), target, _COMPACTED_RUN, 0)
    last = log.filter((F.col("run") == run) & (F.col("batch") == batch))
    _write(last.select(*table.spec.schema.names, _DELETED), target, run, batch)
    owner = _mark(spark, f"{table.path}/{_OWNER}")
    if owner is not None:
        _leave_mark(spark, f"{target_path}/{_OWNER}", owner)
    _leave_mark(spark, ended, copy)
    return target


def export(
    df: DataFrame, fmt: str, mode: str = "overwrite", partition_by: Sequence[str] = (), **options: str
) -> None:
    """Hand a result on by one of Spark's writers: plain files, or ``jdbc`` with ``batchsize``."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).options(**options).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save()
