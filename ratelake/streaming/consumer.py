"""Structured Streaming consumer of the topic: parse, then three queries.

* raw audit: every parsed row, append (parquet audit log by default;
  ``console`` as in an interactive session),
* filter: ``is_gluten_free = 1 AND avg_rating >= 4.5``, append to CSV,
* running count by country, ``complete`` (or ``update``) mode.

Every query gets its own checkpoint, so a restart resumes each of them where
it stopped instead of replaying the topic from the start. The count keeps one
state entry per country (a few hundred at most), never evicted, in a few state
partitions (``COUNT_PARTITIONS``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ratelake.contract import CONTRACT_SCHEMA, LABEL_COLUMN, NICHE_FLAG, NICHE_MIN_RATING
from ratelake.functions.wire import parse_json
from ratelake.sources.topic import TopicSpec, stream_topic


def niche_filter() -> Column:
    """The append query's predicate."""
    return (F.col(NICHE_FLAG) == 1) & (F.col(LABEL_COLUMN) >= NICHE_MIN_RATING)


def parsed_stream(
    spark: SparkSession,
    spec: TopicSpec,
    schema: StructType = CONTRACT_SCHEMA,
    max_per_trigger: int | None = None,
) -> DataFrame:
    return parse_json(stream_topic(spark, spec, max_per_trigger=max_per_trigger), schema)


def drain(query: StreamingQuery, timeout_s: float | None = None, what: str = "streaming query") -> StreamingQuery:
    """Wait until ``query`` has taken all there is. Without ``timeout_s`` the
    wait has no limit; a reached limit stops the query and raises, so a
    partial result is never taken for a whole one."""
    ended = query.awaitTermination() is None if timeout_s is None else query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise RuntimeError(f"{what} failed: {query.exception()}")
    if not ended:
        query.stop()
        raise TimeoutError(f"{what} had not ended after {timeout_s} s; it was stopped")
    return query


def with_trigger(writer, trigger: str | None):
    """``availableNow`` (drain what is there, then stop), ``once``, a
    processing-time interval such as ``"30 seconds"``, or None (run
    micro-batches back to back)."""
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer


def start_raw_audit(
    parsed: DataFrame,
    path: str | None,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: str | None = "availableNow",
    name: str | None = None,
) -> StreamingQuery:
    w = parsed.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if path and fmt not in ("console", "memory"):
        w = w.option("path", path)
    if name:
        w = w.queryName(name)
    return with_trigger(w, trigger).start()


def start_filter_append(
    parsed: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "csv",
    trigger: str | None = "availableNow",
    name: str | None = None,
) -> StreamingQuery:
    w = (
        parsed.filter(niche_filter())
        .writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if name:
        w = w.queryName(name)
    return with_trigger(w, trigger).start()


_SHUFFLE = "spark.sql.shuffle.partitions"
#: state partitions of a running count, if the session has no fewer
COUNT_PARTITIONS = 8


@contextmanager
def state_in(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Streams first started inside keep their state in so many partitions; a
    later start takes the number from the checkpoint. Every micro-batch runs
    a task per state partition, whatever its size, and each of them reports
    figures of all state partitions to the driver: with the session's number,
    which follows the largest batch job, a count of a few keys sends its
    square with every micro-batch."""
    before = spark.conf.get(_SHUFFLE)
    spark.conf.set(_SHUFFLE, str(int(partitions)))
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE, before)


def running_count(parsed: DataFrame, key: str = "country") -> DataFrame:
    return parsed.groupBy(key).count()


def start_count(
    parsed: DataFrame,
    checkpoint: str,
    key: str = "country",
    mode: str = "complete",
    snapshot_path: str | None = None,
    fmt: str = "console",
    trigger: str | None = "availableNow",
    name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Running count by ``key`` in ``complete`` or ``update`` mode.

    With ``snapshot_path`` every micro-batch writes a full count table as
    version ``<snapshot_path>/batch_id=N``: in complete mode the batch *is*
    the table; in update mode the batch holds only the changed keys (with
    their new running totals), merged over version N-1. Readers take the
    newest version (``latest_snapshot``), so they never see a half-written
    table, and a replayed batch rewrites its own version. Versions older than
    N-1 are deleted. Without a path, ``fmt`` (console / memory) is used.

    Rows are counted before they are shuffled, so the state partitions have to
    suit the number of keys, not of rows: ``COUNT_PARTITIONS`` at most unless
    ``state_partitions`` is given (for keys of many millions of values)."""
    spark = parsed.sparkSession
    if state_partitions is None:
        state_partitions = min(COUNT_PARTITIONS, int(spark.conf.get(_SHUFFLE)))
    counts = running_count(parsed, key)
    w = counts.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if snapshot_path:

        def write_snapshot(batch: DataFrame, batch_id: int) -> None:
            from ratelake.session import delete_path, require_version
            from ratelake.sources.lake import batch_path

            table = batch
            prev = batch_path(snapshot_path, batch_id - 1)
            if mode == "update" and batch_id > 0:
                require_version(spark, prev)
                # one pass over the batch: another one would run the state's tasks again
                old = spark.read.parquet(prev).withColumn("_new", F.lit(False))
                both = old.unionByName(batch.withColumn("_new", F.lit(True)))
                table = both.groupBy(key).agg(F.max_by("count", "_new").alias("count"))
            table.write.mode("overwrite").parquet(batch_path(snapshot_path, batch_id))
            if batch_id >= 2:
                delete_path(spark, batch_path(snapshot_path, batch_id - 2))

        w = w.foreachBatch(write_snapshot)
    else:
        w = w.format(fmt)
    with state_in(spark, state_partitions):
        return with_trigger(w, trigger).start()


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete count table written by ``start_count``: versions
    still being written (no ``_SUCCESS`` yet) are passed over."""
    from ratelake.session import complete_batch_ids

    ids = complete_batch_ids(spark, path)
    if not ids:
        raise FileNotFoundError(f"no snapshot written under {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/batch_id={ids[-1]}")


@dataclass
class ConsumerPaths:
    root: str

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"

    @property
    def niche(self) -> str:
        return f"{self.root}/niche_csv"

    @property
    def counts(self) -> str:
        return f"{self.root}/counts"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


def run_consumer(
    spark: SparkSession,
    spec: TopicSpec,
    root: str,
    trigger: str | None = "availableNow",
    max_per_trigger: int | None = None,
    timeout_s: float | None = None,
) -> list[StreamingQuery]:
    """Start the three queries on one topic. ``availableNow`` drains what is
    there and stops (waited for here); other triggers keep running until one
    query ends (``awaitAnyTermination``)."""
    paths = ConsumerPaths(root)
    parsed = parsed_stream(spark, spec, max_per_trigger=max_per_trigger)
    qs = [
        start_raw_audit(parsed, paths.audit, paths.checkpoint("raw"), trigger=trigger),
        start_filter_append(parsed, paths.niche, paths.checkpoint("niche"), trigger=trigger),
        start_count(parsed, paths.checkpoint("count"), snapshot_path=paths.counts, trigger=trigger),
    ]
    try:
        if trigger == "availableNow":
            for q in qs:
                drain(q, timeout_s)
        else:
            spark.streams.awaitAnyTermination(timeout_s) if timeout_s else spark.streams.awaitAnyTermination()
            for q in qs:
                if q.exception() is not None:
                    raise RuntimeError(f"streaming query failed: {q.exception()}")
    except Exception:
        for q in qs:
            q.stop()
        raise
    return qs


def dedup(parsed: DataFrame, keys: list[str], event_time: str | None = None,
          delay: str | None = None) -> DataFrame:
    """Drop redelivered messages (the topic is at-least-once).

    With ``event_time`` and ``delay`` the state is bounded by the watermark
    (``dropDuplicatesWithinWatermark``); rows later than ``delay`` are dropped,
    as any watermark does. Without them the state holds every key seen and
    grows with the distinct keys: that form has to be asked for by choosing
    the RocksDB state store (``rocksdb_state``), and raises otherwise."""
    if event_time and delay:
        from pyspark.sql.types import TimestampNTZType

        if isinstance(parsed.schema[event_time].dataType, TimestampNTZType):
            # watermarks need TIMESTAMP: watermark a cast copy (session time
            # zone), keep the original column as it is
            marked = parsed.withColumn("_event_time", F.col(event_time).cast("timestamp"))
            return (
                marked.withWatermark("_event_time", delay)
                .dropDuplicatesWithinWatermark(keys)
                .drop("_event_time")
            )
        return parsed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    if parsed.isStreaming and "RocksDB" not in parsed.sparkSession.conf.get(_STATE_STORE):
        raise ValueError("dedup keeps every key without event_time and delay: give both, or use rocksdb_state")
    return parsed.dropDuplicates(keys)


_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, off the JVM heap."""
    before = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_STATE_STORE, before)


def run_consumer_fused(
    spark: SparkSession,
    spec: TopicSpec,
    root: str,
    key: str = "country",
    trigger: str | None = "availableNow",
    max_per_trigger: int | None = None,
    timeout_s: float | None = None,
    after_audit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """The three consumer outputs from **one** read of the topic.

    A single ``foreachBatch`` query parses each micro-batch once (persisted)
    and writes, per batch id ``N``:

    * ``audit/batch_id=N`` - every parsed row (Parquet),
    * ``niche_csv/batch_id=N`` - the filtered rows (CSV, no header),
    * ``counts/batch_id=N`` - running counts by ``key``: the batch's counts
      merged with ``counts/batch_id=N-1`` (one row per key); versions older
      than N-1 are deleted, so two versions exist at any time.

    Every write overwrites its own batch folder, so a replayed batch leaves
    no duplicates; the latest ``counts`` folder is the complete-mode table.
    Compared with three queries, the source is read once instead of three
    times and there is one checkpoint instead of three. ``after_audit`` is
    a hook between the first and the other writes (tests inject failures).
    """
    from pyspark import StorageLevel

    from ratelake.session import delete_path, require_version
    from ratelake.sources.lake import batch_path

    paths = ConsumerPaths(root)
    parsed = parsed_stream(spark, spec, max_per_trigger=max_per_trigger)

    def body(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            batch.write.mode("overwrite").parquet(batch_path(paths.audit, batch_id))
            if after_audit is not None:
                after_audit(batch_id)
            batch.filter(niche_filter()).write.mode("overwrite").csv(batch_path(paths.niche, batch_id))
            counts = batch.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            prev = batch_path(paths.counts, batch_id - 1)
            if batch_id > 0:
                require_version(spark, prev)
                counts = (
                    counts.unionByName(spark.read.parquet(prev))
                    .groupBy(key)
                    .agg(F.sum("count").alias("count"))
                )
            counts.write.mode("overwrite").parquet(batch_path(paths.counts, batch_id))
            # a replay of this batch needs only version N-1: older ones can go
            if batch_id >= 2:
                delete_path(spark, batch_path(paths.counts, batch_id - 2))
        finally:
            batch.unpersist()

    w = parsed.writeStream.foreachBatch(body).option("checkpointLocation", paths.checkpoint("fused"))
    q = with_trigger(w, trigger).start()
    if trigger == "availableNow":
        drain(q, timeout_s)
    return q


def latest_counts(spark: SparkSession, root: str) -> DataFrame:
    """The newest running-count table written by ``run_consumer_fused``
    (found by one folder listing; only that version is read)."""
    from ratelake.session import complete_batch_ids

    counts_root = ConsumerPaths(root).counts
    ids = complete_batch_ids(spark, counts_root)
    if not ids:
        raise FileNotFoundError(f"no counts written under {counts_root}")
    return spark.read.parquet(f"{counts_root}/batch_id={ids[-1]}")
