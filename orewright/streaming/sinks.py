"""Streaming sources and sinks. Every sink can be replayed: a batch writes its own folder once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orewright.operators.dedupe import dedupe_latest
from orewright.sources import folders
from orewright.streaming.levels import Levels, same

BATCH = "_batch"


def read_files(spark: SparkSession, path: str, schema: T.StructType, per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder (or one file) as a stream."""
    reader = spark.readStream.schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(path)


def raw_sink(stream: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append the stream unchanged to a Parquet folder."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _each_batch(
    stream: DataFrame, mode: str, checkpoint: str, write: Callable[[DataFrame, int], None], once: bool
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def update_sink(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], once: bool = False) -> StreamingQuery:
    """Rows of an aggregate as they change, in folders that keep the newest state of each key when they merge.

    Unlike append mode this also shows windows that are still open. A batch that runs
    again after a failure overwrites its own folder.
    """
    held = _updates(stream.sparkSession, path, stream.schema, keys)

    def write(rows: DataFrame, batch: int) -> None:
        held.append(rows.withColumn(BATCH, F.lit(batch).cast("long")), batch)

    return _each_batch(stream, "update", checkpoint, write, once)


def _updates(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> Levels:
    wide = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return Levels(spark, path, wide, lambda rows: dedupe_latest(rows, keys, BATCH))


def read_updates(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The newest state of each key from the folders of ``update_sink``."""
    return _updates(spark, path, schema, keys).merged().drop(BATCH)


def partial_sink(
    stream: DataFrame, partial: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, once: bool = False,
    merge: Callable[[DataFrame], DataFrame] = same, clock: str | None = None, keep: str | None = None,
) -> StreamingQuery:
    """Partial aggregates of each batch, in folders whose partial rows ``merge`` adds up.

    No state is held and no watermark closes a window, so a row that is late by any time
    still reaches its window: readers merge the partial rows. A repeated batch overwrites itself. With ``keep``, rows
    whose ``clock`` is that far behind the newest are dropped.
    """
    spark = stream.sparkSession

    def write(rows: DataFrame, batch: int) -> None:
        made = partial(rows)
        Levels(spark, path, made.schema, merge, clock, keep).append(made, batch)

    return _each_batch(stream, "append", checkpoint, write, once)


def read_partials(
    spark: SparkSession, path: str, schema: T.StructType, clock: str | None = None, keep: str | None = None
) -> DataFrame:
    """All partial rows of ``partial_sink`` within the limit; none before the first batch."""
    return Levels(spark, path, schema, clock=clock, keep=keep).read()


def route(
    stream: DataFrame,
    partial: Callable[[DataFrame], DataFrame],
    raw_path: str,
    agg_path: str,
    checkpoint: str,
    once: bool = False,
    merge: Callable[[DataFrame], DataFrame] = same,
    clock: str | None = None,
    keep: str | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """One stream to two sinks: everything to the raw folder, partial aggregates to their own.

    Two queries with separate checkpoints, so either can lag, fail or restart alone.
    """
    raw = raw_sink(stream, raw_path, f"{checkpoint}/raw", once)
    agg = partial_sink(stream, partial, agg_path, f"{checkpoint}/agg", once, merge, clock, keep)
    return raw, agg


# --- a table that follows its source ------------------------------------------------------------------------


def start_mirror(target: DataFrame, path: str, keys: Sequence[str], buckets: int = 64) -> None:
    """Store the table a change stream will be applied to, in as many folders by a hash of the key."""
    _write_fold(target.withColumn(BUCKET, _bucket(keys, buckets)), path, Fold(0, 0, buckets))


def follow_changes(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order_by: Sequence[str],
    once: bool = False, fold_every: int | None = None,
) -> StreamingQuery:
    """Log a change stream beside the table it belongs to; one checkpoint for the life of the table, as batches are numbered by it.

    A batch writes the last change of each key it saw, and never touches the table: its cost follows the
    changes, not the table. A repeated batch overwrites itself. With ``fold_every``, every so many batches
    the log is folded into the table.
    """
    spark, feed = stream.sparkSession, stream.schema
    log = _log(spark, path, feed, keys, order_by)

    def write(rows: DataFrame, batch: int) -> None:
        log.append(rows.withColumn(BATCH, F.lit(batch).cast("long")), batch)
        if fold_every and (batch + 1) % fold_every == 0:
            fold_mirror(spark, path, feed, keys, order_by)

    return _each_batch(stream, "append", checkpoint, write, once)


def read_mirror(
    spark: SparkSession, path: str, table: T.StructType, feed: T.StructType,
    keys: Sequence[str], order_by: Sequence[str], op: str = "_op",
) -> DataFrame:
    """The table with all logged changes applied, the last change of a key winning.

    Only the folders that hold a changed key are shuffled; the others are read as they are.
    """
    untouched, last = _mirror(spark, path, feed, keys, order_by)
    rows = untouched if last is None else untouched.unionByName(last)
    return rows.filter(F.coalesce(F.col(op), F.lit("")) != "delete").select(*table.names)


def fold_mirror(
    spark: SparkSession, path: str, feed: T.StructType, keys: Sequence[str], order_by: Sequence[str]
) -> int:
    """Write anew those folders of the table that hold a key of the log, and start the log over; how many.

    The table keeps each row's order columns and the deletes, so that a change that comes late is still told from a
    newer one. A fold that breaks off is not seen, and one that has run does nothing again.
    """
    folds = _folds(spark, path)
    through = max((s.last + 1 for s in _log(spark, path, feed, keys, order_by).spans()), default=0)
    if through <= folds[-1].through:
        return 0
    _, last = _mirror(spark, path, feed, keys, order_by)
    fold = Fold(folds[-1].number + 1, through, folds[-1].buckets)
    if last is None:
        return 0
    _write_fold(last, path, fold)
    current = _current(spark, path)
    for old in folds[:-1]:  # the last one may have readers still
        if not any(f == old for f, _ in current):
            folders.remove(spark, f"{path}/base/{old.name}")
    return sum(f == fold for f, _ in current)


BUCKET = "_bucket"


@dataclass(frozen=True, order=True)
class Fold:
    """One write of the table's folders: its number, the batches of the log it holds, the table's buckets."""

    number: int
    through: int
    buckets: int

    @property
    def name(self) -> str:
        return f"fold-{self.number}-{self.through}-{self.buckets}"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _write_fold(rows: DataFrame, path: str, fold: Fold) -> None:
    rows.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/base/{fold.name}")


def _folds(spark: SparkSession, path: str) -> list[Fold]:
    """All folds that ended well, in order."""
    found = [Fold(*map(int, n.split("-")[1:])) for n in folders.names(spark, f"{path}/base")]
    return sorted(f for f in found if folders.complete(spark, f"{path}/base/{f.name}"))


def _current(spark: SparkSession, path: str) -> list[tuple[Fold, int]]:
    """Each bucket with the last fold that wrote it."""
    held: dict[int, Fold] = {}
    for fold in _folds(spark, path):
        for name in folders.names(spark, f"{path}/base/{fold.name}"):
            if name.startswith(f"{BUCKET}="):
                held[int(name.partition("=")[2])] = fold
    return [(fold, bucket) for bucket, fold in sorted(held.items())]


def _log(spark: SparkSession, path: str, feed: T.StructType, keys: Sequence[str], order_by: Sequence[str]) -> Levels:
    wide = T.StructType([*feed.fields, T.StructField(BATCH, T.LongType())])
    return Levels(spark, f"{path}/log", wide, lambda rows: dedupe_latest(rows, keys, order_by))


def _mirror(
    spark: SparkSession, path: str, feed: T.StructType, keys: Sequence[str], order_by: Sequence[str]
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the folders no logged change touches, and per key of the others the last of its row and its changes.

    A row that was never folded has no order columns and is older than any change.
    """
    folds, held = _folds(spark, path), _current(spark, path)
    wide = T.StructType([*feed.fields, T.StructField(BUCKET, T.IntegerType())])

    def base(parts: list[tuple[Fold, int]]) -> DataFrame:
        rows = spark.createDataFrame([], wide)
        for fold in sorted({f for f, _ in parts}):
            to = f"{path}/base/{fold.name}"
            mine = [f"{to}/{BUCKET}={b}" for f, b in parts if f == fold]
            # Read with the feed's columns: those that a first table lacks are NULL there, and sort last.
            rows = rows.unionByName(spark.read.schema(wide).option("basePath", to).parquet(*mine).select(*wide.names))
        return rows

    log = _log(spark, path, feed, keys, order_by)
    fresh = [s for s in log.spans() if s.last >= folds[-1].through]
    if not fresh:
        return base(held), None
    # A folder may also hold changes that were folded before it was merged.
    changes = log.rows_of(fresh).filter(F.col(BATCH) >= folds[-1].through).drop(BATCH)
    changes = changes.withColumn(BUCKET, _bucket(keys, folds[-1].buckets))
    changed = {r[0] for r in changes.select(BUCKET).distinct().collect()}  # at most as many as there are buckets
    touched = base([(f, b) for f, b in held if b in changed]).unionByName(changes)
    return base([(f, b) for f, b in held if b not in changed]), dedupe_latest(touched, keys, order_by)


def finish(*queries: StreamingQuery) -> None:
    """Wait for bounded queries to read all there is."""
    for q in queries:
        q.awaitTermination()
