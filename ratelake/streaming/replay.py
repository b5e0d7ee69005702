"""Replay of dead-lettered rows: repaired rows enter the lake once.

A ledger remembers every replayed row by its fingerprint (SHA-256 of all its
columns) and the batch that dead-lettered it, with the number of equal rows. A
replay takes the rows that the ledger does not have, repairs them, writes those
that are good now as a lake batch of its own and only then enters them in the
ledger. A replay that fails is repeated under the same number, with the same
rows, and replaces what it left; one without anything new writes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.contract import CRITICAL_COLUMNS
from ratelake.operators.quality import REASON, split
from ratelake.plans.venue import transform_good
from ratelake.session import list_batch_ids, list_folders, materialize
from ratelake.sources.lake import BATCH_COLUMN, read_dlq, write_batch

#: lake batches of replays are numbered from here
REPLAY_BASE = 1_000_000_000
FINGERPRINT = "fingerprint"
_LEDGER = f"{FINGERPRINT} string, dlq_batch long, copies long"


def fingerprinted(dead: DataFrame) -> DataFrame:
    """``fingerprint, dlq_batch, copies`` and one row (``row``) for each set of
    equal rows of a batch; the reason does not count."""
    names = sorted(c for c in dead.columns if c not in (BATCH_COLUMN, REASON))
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    print_ = F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)
    each = dead.select(print_.alias(FINGERPRINT), F.col(BATCH_COLUMN).cast("long").alias("dlq_batch"), row.alias("row"))
    return each.groupBy(FINGERPRINT, "dlq_batch").agg(F.count(F.lit(1)).alias("copies"), F.first("row").alias("row"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All rows replayed so far."""
    if not list_batch_ids(spark, ledger, BATCH_COLUMN):
        return spark.createDataFrame([], f"{_LEDGER}, {BATCH_COLUMN} long")
    return spark.read.schema(f"{_LEDGER}, {BATCH_COLUMN} long").option("basePath", ledger).parquet(ledger)


def replay(
    spark: SparkSession,
    dlq: str,
    lake: str,
    ledger: str,
    repair: Callable[[DataFrame], DataFrame],
    critical: Sequence[str] = CRITICAL_COLUMNS,
    transform: Callable[[DataFrame], DataFrame] = transform_good,
    after_lake_write: Callable[[int], None] | None = None,
) -> int | None:
    """One replay; returns the number of its lake batch, None if no row is
    good after ``repair`` that was not replayed before. ``repair`` maps the
    raw rows (without batch and reason) to rows of the same columns, one for
    one, whatever helper columns it keeps being ignored. Rows still bad stay
    in the DLQ and are tried again by the next replay."""
    if not list_folders(spark, dlq, f"{BATCH_COLUMN}="):
        return None
    entries = fingerprinted(read_dlq(spark, dlq))
    pending = entries.join(read_ledger(spark, ledger).drop(BATCH_COLUMN, "copies"), [FINGERPRINT, "dlq_batch"], "left_anti")
    ids = [f"_{FINGERPRINT}", "_dlq_batch", "_copies"]
    named = pending.select("row.*", *[F.col(c[1:]).alias(c) for c in ids])
    good, _ = split(repair(named), critical)
    good = materialize(good, "replay")
    if good.isEmpty():
        return None
    number = REPLAY_BASE + len(list_batch_ids(spark, ledger, BATCH_COLUMN))
    # equal rows were dead-lettered that often and enter that often
    rows = good.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    write_batch(transform(rows), lake, number)
    if after_lake_write is not None:
        after_lake_write(number)
    done = good.select(F.col(ids[0]).alias(FINGERPRINT), F.col(ids[1]).alias("dlq_batch"), F.col(ids[2]).alias("copies"))
    write_batch(done, ledger, number, by=None)
    return number
