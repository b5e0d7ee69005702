"""Streaming state as a table, state that ends, and progress reports.

* ``state_table`` / ``state_operators``: what a checkpoint's state store
  holds after any committed micro-batch, read with the state data source,
  without running the query.
* ``stop_after``: stop a running query once it has taken some micro-batches.
* ``idle_totals``: running totals per key whose state ends: a key silent for
  longer than ``ttl`` of event time leaves the state and its total goes to the
  output.
* ``ProgressReport``: the metrics that a stream observes, one row per
  micro-batch, without a pass of its own.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from ratelake.session import delete_path, list_markers, write_marker

# --------------------------------------------------------------------------
# the state store as a table
# --------------------------------------------------------------------------


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint: ``operatorId, operatorName,
    stateStoreName, numPartitions, minBatchId, maxBatchId``."""
    names = ["operatorId", "operatorName", "stateStoreName", "numPartitions", "minBatchId", "maxBatchId"]
    return spark.read.format("state-metadata").load(checkpoint).select(*names)


def state_table(
    spark: SparkSession,
    checkpoint: str,
    operator: int = 0,
    batch_id: int | None = None,
    variable: str | None = None,
) -> DataFrame:
    """One row per key in the state of ``operator`` after micro-batch
    ``batch_id`` (the last committed one by default): the key's columns, then
    the value's. ``variable`` names a state variable of an operator that has
    several. One task per state partition reads its own files."""
    r = spark.read.format("statestore").option("operatorId", str(operator))
    if batch_id is not None:
        r = r.option("batchId", str(batch_id))
    if variable is not None:
        r = r.option("stateVarName", variable)
    return r.load(checkpoint).select("key.*", "value.*")


def data_batches(query: StreamingQuery) -> int:
    """Micro-batches with rows among the query's recent ones."""
    return sum(1 for p in query.recentProgress if p["numInputRows"] > 0)


def stop_after(query: StreamingQuery, batches: int, timeout_s: float = 600) -> int:
    """Stop a running query once it has reported so many micro-batches with
    rows. One that is under way is broken off and taken again by the next
    start. Returns how many there were; raises if the query failed or the time
    is over."""
    end = time.monotonic() + timeout_s
    try:
        while (seen := data_batches(query)) < batches:
            if query.exception() is not None:
                raise RuntimeError(f"streaming query failed: {query.exception()}")
            if not query.isActive:
                raise RuntimeError(f"the query ended after {seen} of {batches} micro-batches")
            if time.monotonic() > end:
                raise TimeoutError(f"{seen} of {batches} micro-batches in {timeout_s} s")
            time.sleep(0.05)
    finally:
        query.stop()
    return seen


# --------------------------------------------------------------------------
# state that ends
# --------------------------------------------------------------------------


class _IdleTotals(StatefulProcessor):
    """Rows and last event time (milliseconds) per key, and one timer at the
    last event plus the time to live."""

    def __init__(self, key: str, time_column: str, ttl_ms: int) -> None:
        self.key, self.time_column, self.ttl_ms = key, time_column, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState(STATE, "count long, last_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        before = self.total.get() if self.total.exists() else None
        count, last = before or (0, None)
        for part in rows:  # a hot key's rows come in several parts
            count += len(part)
            newest = int(part[self.time_column].max().value // 1_000_000)
            last = newest if last is None else max(last, newest)
        if before is None or last != before[1]:
            if before is not None:
                self.handle.deleteTimer(before[1] + self.ttl_ms)
            self.handle.registerTimer(last + self.ttl_ms)
        self.total.update((count, last))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        count, last = self.total.get()
        self.total.clear()
        yield pd.DataFrame({self.key: [key[0]], "count": [count], "last_ms": [last]})

    def close(self) -> None:
        pass


#: the state variable of ``idle_totals``
STATE = "total"


def idle_totals(stream: DataFrame, key: str, event_time: str, ttl_ms: int, delay: str = "0 seconds") -> DataFrame:
    """``key, count, last_ms`` of every key that was silent for ``ttl_ms``:
    its state ends and its total is put out, once the watermark (the newest
    event less ``delay``) is past its last event plus ``ttl_ms``. A key that
    comes back starts anew, so a key may be put out several times and its
    total is the sum. Totals that have not ended are in the state
    (``state_table(..., variable=STATE)``).

    Needs the RocksDB state store (``rocksdb_state``). Rows later than the
    watermark are dropped, as by any watermark; rows without key form a key of
    their own, rows without time are left out."""
    if stream.isStreaming and "RocksDB" not in stream.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass"):
        raise ValueError("idle_totals keeps its state in RocksDB: use rocksdb_state")
    rows = stream.where(F.col(event_time).isNotNull()).select(F.col(key), F.col(event_time).cast("timestamp").alias(event_time))
    out = StructType([StructField(key, stream.schema[key].dataType), StructField("count", LongType()), StructField("last_ms", LongType())])
    marked = rows.withWatermark(event_time, delay).groupBy(key)
    return marked.transformWithStateInPandas(_IdleTotals(key, event_time, int(ttl_ms)), out, "Append", "EventTime")


# --------------------------------------------------------------------------
# reports of the progress
# --------------------------------------------------------------------------


class ProgressReport(StreamingQueryListener):
    """Writes what a stream observed under ``name`` (``observed``), one small
    file per micro-batch under ``root``, replaced if the micro-batch is taken
    again. ``table`` reads them back."""

    def __init__(self, spark: SparkSession, root: str, name: str) -> None:
        self.spark, self.root, self.name = spark, root.rstrip("/"), name
        self.ended: set[str] = set()
        self.failed: BaseException | None = None
        self.news = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        if row is None or progress.numInputRows == 0:
            return
        try:
            path = f"{self.root}/{progress.batchId:020d}.json"
            delete_path(self.spark, path)
            write_marker(self.spark, path, json.dumps({"batch_id": progress.batchId} | row.asDict()))
        except Exception as ex:  # noqa: BLE001 - raised by ``wait``
            self.failed = ex

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()

    def wait(self, query: StreamingQuery, timeout_s: float = 60) -> None:
        """Until all events of an ended query have been seen; raises if a
        report could not be written."""
        with self.news:
            if not self.news.wait_for(lambda: str(query.runId) in self.ended, timeout_s):
                raise TimeoutError(f"the end of query {query.runId} was not reported in {timeout_s} s")
        if self.failed is not None:
            raise RuntimeError("a progress report could not be written") from self.failed

    def table(self) -> DataFrame:
        """One row per micro-batch: ``batch_id`` and the observed metrics."""
        if not list_markers(self.spark, self.root):
            raise FileNotFoundError(f"no report under {self.root}")
        return self.spark.read.json(self.root)


def observed(stream: DataFrame, name: str, metrics: Sequence[Column]) -> DataFrame:
    """``stream``, with ``metrics`` counted as its rows pass. Exact for a
    query that writes the rows without a shuffle."""
    return stream.observe(name, *metrics)
