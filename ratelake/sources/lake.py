"""Parquet lake partitioned by batch and country, and the per-batch DLQ.

Layout: ``<lake>/batch_id=<N>/country=<value>/part-*.parquet`` (Hive style,
so a plain ``spark.read.parquet(lake)`` rebuilds both columns).

* A batch is written to an attempt folder of its own (``<lake>/_attempts``,
  which readers pass over) and **swapped in as a whole subtree**
  ``<lake>/batch_id=<N>`` once the write has ended. A failed retry leaves the
  earlier attempt readable; a finished one replaces it in *every* country, so
  a retry that covers fewer countries leaves no orphan files. (Dynamic
  partition overwrite on ``partitionBy("batch_id","country")`` would keep the
  orphans, and a static overwrite deletes before it writes.)
* Before a write the rows are rebalanced on the partition column (Spark's
  ``REBALANCE`` hint): rows of one country meet in few tasks, so each task
  writes few files instead of one per input task and country; AQE then
  splits a hot country into advisory-size tasks
  (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) and coalesces small
  ones, so files stay near the advisory size at any scale and one country
  holding a third of the rows is written by many tasks. ``max_records_per_file``
  bounds file size as well.
* Spark writes an empty-string partition value as null; the lake stores it
  as a sentinel and maps it back on read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ratelake.contract import (
    CONTRACT_SCHEMA,
    EMPTY_PARTITION_SENTINEL,
    PARTITION_COLUMN,
    require_columns,
)
from ratelake.session import delete_path, list_folders, make_folder, swap_path

BATCH_COLUMN = "batch_id"


def _encode_partition(c: str) -> Column:
    return F.when(F.col(c) == F.lit(""), F.lit(EMPTY_PARTITION_SENTINEL)).otherwise(F.col(c))


def _decode_partition(c: str) -> Column:
    return F.when(F.col(c) == F.lit(EMPTY_PARTITION_SENTINEL), F.lit("")).otherwise(F.col(c))


def batch_path(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{BATCH_COLUMN}={int(batch_id)}"


def rebalance_for_write(df: DataFrame, *by: str) -> DataFrame:
    """Rebalance rows on ``by`` (or evenly, with no columns) before a write."""
    return df.hint("rebalance", *by)


@contextmanager
def _attempt(spark: SparkSession, root: str) -> Iterator[str]:
    """A fresh folder for one write; what is left of it in the end goes."""
    path = f"{root.rstrip('/')}/_attempts/{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        delete_path(spark, path)


def write_batch(
    df: DataFrame,
    root: str,
    batch_id: int,
    by: str | None = PARTITION_COLUMN,
    cluster: bool = True,
    max_records_per_file: int = 0,
) -> str:
    """Write one batch under ``<root>/batch_id=<N>``, replacing any earlier
    attempt of the same batch once the write has ended. Returns the batch
    path."""
    path = batch_path(root, batch_id)
    out = df
    if by is not None:
        require_columns(df, [by])
        out = df.withColumn(by, _encode_partition(by))
    if cluster:
        out = rebalance_for_write(out, *([by] if by else []))
    w = out.write
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(int(max_records_per_file)))
    if by is not None:
        w = w.partitionBy(by)
    with _attempt(df.sparkSession, root) as attempt:
        w.parquet(attempt)
        swap_path(df.sparkSession, attempt, path)
    return path


def _write_folders(df: DataFrame, root: str, parts: Sequence[str], retried: Sequence[int]) -> None:
    """Write all batches of ``df`` in one job, then swap each one in; batches
    that are only named go."""
    spark, root = df.sparkSession, root.rstrip("/")
    make_folder(spark, root)
    with _attempt(spark, root) as attempt:
        rebalance_for_write(df, *parts).write.partitionBy(*parts).parquet(attempt)
        written = list_folders(spark, attempt, f"{BATCH_COLUMN}=")
        for name in written:
            swap_path(spark, f"{attempt}/{name}", f"{root}/{name}")
    for n in retried:
        if f"{BATCH_COLUMN}={int(n)}" not in written:
            delete_path(spark, batch_path(root, n))


def write_batches(
    df: DataFrame,
    root: str,
    by: str | None = PARTITION_COLUMN,
    retried: Sequence[int] = (),
) -> None:
    """Bulk backfill: many batches in one job (``batch_id`` column present)
    into ``<root>/batch_id=<N>/<by>=<v>``. Every batch in ``df`` is replaced
    as a whole, countries of an earlier attempt included; other batches are
    untouched. ``retried`` names batches to replace that may have no row in
    ``df``."""
    require_columns(df, [BATCH_COLUMN])
    out = df
    if by is not None:
        require_columns(df, [by])
        out = df.withColumn(by, _encode_partition(by))
    _write_folders(out, root, [BATCH_COLUMN] + ([by] if by else []), retried)


def lake_schema(schema: StructType = CONTRACT_SCHEMA, by: str | None = PARTITION_COLUMN) -> StructType:
    """Data columns plus the declared (not inferred) partition columns."""
    fields = [f for f in schema.fields if f.name != by]
    fields.append(StructField(BATCH_COLUMN, LongType(), True))
    if by is not None:
        fields.append(StructField(by, StringType(), True))
    return StructType(fields)


def read_lake(
    spark: SparkSession,
    root: str,
    schema: StructType = CONTRACT_SCHEMA,
    by: str | None = PARTITION_COLUMN,
    batch_id: int | None = None,
) -> DataFrame:
    """Read the lake with declared partition types; ``batch_id`` selects one
    batch by partition pruning. Columns come back in ``schema`` order, then
    ``batch_id``."""
    df = spark.read.schema(lake_schema(schema, by)).option("basePath", root).parquet(root)
    if batch_id is not None:
        df = df.filter(F.col(BATCH_COLUMN) == F.lit(int(batch_id)))
    if by is not None:
        require_columns(df, [by])
        df = df.withColumn(by, _decode_partition(by))
    return df.select(*[f.name for f in schema.fields], BATCH_COLUMN)


def write_dlq(bad: DataFrame, root: str, batch_id: int) -> str:
    """Bad rows of one batch to ``<root>/batch_id=<N>`` (a retry replaces its
    own rows once written; an empty retry leaves the batch empty)."""
    return write_batch(bad, root, batch_id, by=None)


def write_dlq_batches(bad: DataFrame, root: str, retried: Sequence[int] = ()) -> None:
    """Bad rows of many batches at once (``batch_id`` column present): each
    batch's folder is replaced, other batches are untouched. A batch that is
    run again and has no bad row any more is not in ``bad``: name it in
    ``retried`` and its old rows go."""
    require_columns(bad, [BATCH_COLUMN])
    _write_folders(bad, root, [BATCH_COLUMN], retried)


def read_dlq(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """Every dead-lettered row since the first run, with its ``batch_id``."""
    r = spark.read.option("basePath", root)
    if schema is not None:
        r = r.schema(StructType([*schema.fields, StructField(BATCH_COLUMN, LongType(), True)]))
    return r.parquet(root)
