"""Registered source/sink queries: CSV scan, slices, lake, DLQ.

Each query materialises its files under the shared checkpoint folder (a
fresh sub-folder per call) and returns a DataFrame read back from them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ratelake.contract import CONTRACT_COLUMNS, CRITICAL_COLUMNS
from ratelake.operators.quality import split
from ratelake.plans.registry import PIPELINE_CTE, VENUE_CTE, _CONTRACT_ROUNDED_SQL, register, round_contract
from ratelake.plans.venue import venue_pipeline, venue_rows
from ratelake.session import shared_path
from ratelake.sources.ingest import CORRUPT_COLUMN, read_csv_tolerant, slice_walk
from ratelake.sources.lake import (
    BATCH_COLUMN,
    read_dlq,
    read_lake,
    write_batch,
    write_batches,
    write_dlq_batches,
)
from ratelake.sources.tables import table
from ratelake.sources.types import KINDS, discover_csv, drift

# --------------------------------------------------------------------------
# tolerant CSV scan: `part` written as CSV with some p_size cells replaced by
# text (fixed rule on the key), read back with the declared schema
# --------------------------------------------------------------------------

PART_SCHEMA = StructType(
    [
        StructField("p_partkey", LongType(), True),
        StructField("p_name", StringType(), True),
        StructField("p_brand", StringType(), True),
        StructField("p_type", StringType(), True),
        StructField("p_size", IntegerType(), True),
        StructField("p_retailprice", DoubleType(), True),
    ]
)


@register(
    "csv_tolerant_scan",
    """SELECT p_partkey, p_name, p_brand, p_type,
      TRY_CAST(CASE WHEN p_partkey % 17 = 5 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS INTEGER)
        AS p_size,
      p_retailprice, (p_partkey % 17 = 5) AS is_malformed
    FROM part""",
)
def q_csv_tolerant_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "csv_scan")
    part = table(spark, sf_dir, "part")
    dirty = part.withColumn(
        "p_size",
        F.when(F.col("p_partkey") % 17 == 5, F.lit("n/a")).otherwise(F.col("p_size").cast("string")),
    )
    dirty.write.mode("overwrite").option("header", "true").csv(path)
    scanned = read_csv_tolerant(spark, path, PART_SCHEMA)
    return scanned.select(
        *[f.name for f in PART_SCHEMA.fields],
        F.col(CORRUPT_COLUMN).isNotNull().alias("is_malformed"),
    )


# --------------------------------------------------------------------------
# incremental slices: the full walk over `events`, 2000 rows per slice
# --------------------------------------------------------------------------

SLICE_CAP = 2000


@register(
    "incremental_slice",
    f"""SELECT event_id, ts, user_id, event_type, value,
      CAST((ROW_NUMBER() OVER (ORDER BY event_id) - 1) // {SLICE_CAP} AS BIGINT) AS slice_no
    FROM events""",
)
def q_incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return slice_walk(ev, "event_id", SLICE_CAP)


# --------------------------------------------------------------------------
# lake: contract rows partitioned by country, whole-lake and per-batch reads
# --------------------------------------------------------------------------


@register("lake_roundtrip", f"WITH {PIPELINE_CTE} SELECT {_CONTRACT_ROUNDED_SQL} FROM pipeline")
def q_lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = shared_path(spark, "lake")
    write_batch(venue_pipeline(venue_rows(spark, sf_dir)), lake, 0)
    return round_contract(read_lake(spark, lake).select(*CONTRACT_COLUMNS))


# rows per batch (the ETL's max records per run), sized as a fixed share of
# the source so the number of batch folders does not grow with the data
LAKE_BATCHES = 4


def _batch_cap(df: DataFrame) -> int:
    return max(1, -(-df.count() // LAKE_BATCHES))  # ceiling division


_SQL_BATCH = (
    "(ROW_NUMBER() OVER (ORDER BY venue_id) - 1) // "
    f"CAST(CEIL(COUNT(*) OVER () / {float(LAKE_BATCHES)!r}) AS BIGINT)"
)


@register(
    "lake_batch_read",
    f"""WITH {PIPELINE_CTE},
    b AS (SELECT *, {_SQL_BATCH} AS batch_id FROM pipeline)
    SELECT CAST(batch_id AS BIGINT) AS batch_id, country, CAST(COUNT(*) AS BIGINT) AS n_rows,
      CAST(SUM(total_reviews_count) AS BIGINT) AS sum_reviews,
      CAST(SUM(is_gluten_free) AS BIGINT) AS n_gluten_free
    FROM b GROUP BY 1, 2""",
)
def q_lake_batch_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = shared_path(spark, "lake_batches")
    rows = venue_pipeline(venue_rows(spark, sf_dir), keep=("venue_id",))
    batched = slice_walk(rows, "venue_id", _batch_cap(rows), out=BATCH_COLUMN).drop("venue_id")
    write_batches(batched, lake)
    # one pruned read per batch; batch_id and country are rebuilt from the path
    back = reduce(DataFrame.unionAll, [read_lake(spark, lake, batch_id=b) for b in range(LAKE_BATCHES)])
    return back.groupBy(BATCH_COLUMN, "country").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("total_reviews_count").cast("long").alias("sum_reviews"),
        F.sum("is_gluten_free").cast("long").alias("n_gluten_free"),
    )


@register("lake_retry", f"WITH {PIPELINE_CTE} SELECT {_CONTRACT_ROUNDED_SQL} FROM pipeline")
def q_lake_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A failed first attempt of batch 0 wrote other country folders than
    the retry will; the retry's subtree overwrite must leave no orphan."""
    lake = shared_path(spark, "lake_retry")
    rows = venue_pipeline(venue_rows(spark, sf_dir))
    stale = rows.withColumn("country", F.concat(F.col("country"), F.lit("_attempt1")))
    write_batch(stale, lake, 0)
    write_batch(rows, lake, 0)
    return round_contract(read_lake(spark, lake).select(*CONTRACT_COLUMNS))


@register(
    "dlq_by_batch",
    f"""WITH {VENUE_CTE},
    b AS (SELECT *, {_SQL_BATCH} AS batch_id FROM venue)
    SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(COUNT(*) AS BIGINT) AS n_bad,
    """
    + ",\n    ".join(
        f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null_{c}" for c in CRITICAL_COLUMNS
    )
    + "\n    FROM b WHERE "
    + " OR ".join(f"{c} IS NULL" for c in CRITICAL_COLUMNS)
    + " GROUP BY 1",
)
def q_dlq_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    dlq = shared_path(spark, "dlq")
    venues = venue_rows(spark, sf_dir)
    raw = slice_walk(venues, "venue_id", _batch_cap(venues), out=BATCH_COLUMN)
    _, bad = split(raw, CRITICAL_COLUMNS, with_reason=True)
    write_dlq_batches(bad, dlq)
    back = read_dlq(spark, dlq)
    return back.groupBy(BATCH_COLUMN).agg(
        F.count(F.lit(1)).alias("n_bad"),
        *[
            F.count_if(F.array_contains("dlq_reason", c)).alias(f"n_null_{c}")
            for c in CRITICAL_COLUMNS
        ],
    )


# --------------------------------------------------------------------------
# type discovery: three loads of events, of which the last widens two columns
# --------------------------------------------------------------------------

_LOADS = 3
_HALF = "event_id % 3 = 2 AND user_id % 4 = 1"

_TYPES_SQL = f"""WITH e AS (
  SELECT event_id, event_id % {_LOADS} AS f, ts, event_type, {_HALF} AS half, event_type = 'click' AND event_id % 3 = 2 AS gone FROM events),
c AS (
  SELECT f, 'event_id' AS "column", 'bigint' AS kind FROM e
  UNION ALL SELECT f, 'amount', CASE WHEN half THEN 'double' ELSE 'bigint' END FROM e
  UNION ALL SELECT f, 'day', CASE WHEN ts IS NULL THEN 'empty' WHEN f = 2 THEN 'timestamp' ELSE 'date' END FROM e
  UNION ALL SELECT f, 'event_type', CASE WHEN event_type IS NULL THEN 'empty' ELSE 'string' END FROM e
  UNION ALL SELECT f, 'flag', CASE WHEN gone THEN 'empty' ELSE 'boolean' END FROM e),
n AS (SELECT f, "column", kind, count(*) AS n FROM c GROUP BY ALL),
own AS (SELECT f, "column", CASE WHEN bool_or(kind = 'string') THEN 'string' WHEN bool_or(kind = 'double') THEN 'double' WHEN bool_or(kind = 'bigint') THEN 'bigint'
  WHEN bool_or(kind = 'timestamp') THEN 'timestamp' WHEN bool_or(kind = 'date') THEN 'date' WHEN bool_or(kind = 'boolean') THEN 'boolean' ELSE 'void' END AS type FROM n GROUP BY f, "column"),
whole AS (SELECT "column", CASE WHEN bool_or(kind = 'string') THEN 'string' WHEN bool_or(kind = 'double') THEN 'double' WHEN bool_or(kind = 'bigint') THEN 'bigint'
  WHEN bool_or(kind = 'timestamp') THEN 'timestamp' WHEN bool_or(kind = 'date') THEN 'date' WHEN bool_or(kind = 'boolean') THEN 'boolean' ELSE 'void' END AS type, {", ".join(f"CAST(coalesce(sum(n) FILTER (WHERE kind = '{k}'), 0) AS BIGINT) AS n_{k}" for k in KINDS)} FROM n GROUP BY "column")
SELECT w.*, CAST(count(DISTINCT o.f) FILTER (WHERE o.type <> w.type) AS BIGINT) AS n_narrower
FROM whole w JOIN own o ON o."column" = w."column" GROUP BY ALL"""


@register("csv_type_discovery", _TYPES_SQL)
def q_csv_type_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of all columns from all cells, and where a column widened: the
    last load turns integers into decimals and dates into times."""
    path = shared_path(spark, "typed_csv")
    ev = table(spark, sf_dir, "events")
    part = F.col("event_id") % _LOADS
    day, at = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    cells = ev.select(
        "event_id",
        F.when(F.expr(_HALF), F.concat(F.col("event_id").cast("string"), F.lit(".5"))).otherwise(F.col("event_id").cast("string")).alias("amount"),
        F.when(part == 2, at).otherwise(day).alias("day"), "event_type",
        F.when((F.col("event_type") != "click") | (part != 2) | F.col("event_type").isNull(), F.lit("true")).alias("flag"),
        part.alias("f"),
    )
    for k in range(_LOADS):
        cells.where(F.col("f") == k).drop("f").write.option("header", "true").csv(f"{path}/load={k}")
    return drift(discover_csv(spark, path, unit="folder")).drop("n_units")
