"""Raw venue rows and the batch venue pipeline.

``venue_rows`` stands in for the raw CSV row: it derives one venue per
customer from the test tables with fixed rules on the key (the test tables
contain no nulls). ``venue_pipeline`` is the ETL transform: DLQ split,
encoding, per-city context and the contract projection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.contract import CRITICAL_COLUMNS, NUMERIC_COLUMNS, to_contract
from ratelake.functions.encode import encode_features
from ratelake.operators.context import group_context
from ratelake.operators.quality import split
from ratelake.sources.tables import table

# The same view as SQL text; it runs unchanged in Spark SQL and DuckDB.
VENUE_SQL = """
WITH o AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey)
SELECT c_custkey AS venue_id, c_name AS restaurant_name, r_name AS country, n_name AS city,
  CASE WHEN c_custkey % 50 = 7 THEN NULL
       ELSE CAST(c_custkey % 180 - 90 AS DOUBLE) END AS latitude,
  CAST(c_custkey % 360 - 180 AS DOUBLE) AS longitude,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal / 2000 END AS avg_rating,
  CAST(CASE WHEN c_custkey % 40 = 3 THEN NULL ELSE o.n END AS INT) AS total_reviews_count,
  CASE WHEN c_acctbal < 2500 THEN ' $ ' WHEN c_acctbal < 5000 THEN '$$ - $$$'
       WHEN c_acctbal < 7500 THEN '$$$$' END AS price_level,
  CASE WHEN c_custkey % 3 = 0 THEN 'Claimed' ELSE 'Unclaimed' END AS claimed,
  CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING') THEN 'Y' ELSE 'N' END
    AS vegetarian_friendly,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Y' WHEN c_mktsegment = 'FURNITURE' THEN NULL
       ELSE 'N' END AS gluten_free
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN o ON o_custkey = c_custkey
"""


def venue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw venue rows (the ingestion input), DataFrame form of ``VENUE_SQL``.

    Review counts are a partial+final aggregate of ``orders`` by customer,
    joined to ``customer`` on the same key; ``nation`` / ``region`` are
    dimension files small enough for Spark's size-checked automatic
    broadcast (their plan size comes from the file listing).
    """
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    orders = table(spark, sf_dir, "orders")
    reviews = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("_n"))
    key = F.col("c_custkey")
    bal = F.col("c_acctbal")
    seg = F.col("c_mktsegment")
    j = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
        .join(reviews, customer.c_custkey == reviews.o_custkey, "left")
    )
    return j.select(
        key.alias("venue_id"),
        F.col("c_name").alias("restaurant_name"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("city"),
        F.when(key % 50 == 7, F.lit(None)).otherwise((key % 180 - 90).cast("double")).alias("latitude"),
        (key % 360 - 180).cast("double").alias("longitude"),
        F.when(bal < 0, F.lit(None)).otherwise(bal / 2000).alias("avg_rating"),
        F.when(key % 40 == 3, F.lit(None)).otherwise(F.col("_n")).cast("int").alias("total_reviews_count"),
        F.when(bal < 2500, " $ ").when(bal < 5000, "$$ - $$$").when(bal < 7500, "$$$$").alias("price_level"),
        F.when(key % 3 == 0, "Claimed").otherwise("Unclaimed").alias("claimed"),
        F.when(seg.isin("HOUSEHOLD", "BUILDING"), "Y").otherwise("N").alias("vegetarian_friendly"),
        F.when(seg == "MACHINERY", "Y").when(seg == "FURNITURE", F.lit(None)).otherwise("N").alias("gluten_free"),
    )


def transform_good(
    good: DataFrame,
    numeric_columns: Sequence[str] = NUMERIC_COLUMNS,
    context_keys: Sequence[str] = ("city",),
    context_strategy: str = "aggregate",
    keep: Sequence[str] = (),
    context_stats: Callable[[DataFrame], DataFrame] | None = None,
    exclude_imputed: bool = False,
) -> DataFrame:
    """Encoding, then the group mean (computed after imputation, so an
    imputed 0 rating counts, unless ``exclude_imputed``), then the contract
    projection. ``keep`` names extra columns (e.g. a row key) carried in
    front of the contract. ``context_stats`` maps the encoded rows to the
    group statistics to use (default: the rows' own)."""
    src = good.withColumn("_rated", F.col("avg_rating")) if exclude_imputed else good
    enc = encode_features(src, numeric_columns)
    stats = context_stats(enc) if context_stats is not None else None
    ctx = group_context(
        enc, "avg_rating", context_keys, strategy=context_strategy, stats=stats,
        mean_of="_rated" if exclude_imputed else None,
    )
    return to_contract(ctx, keep=keep)


def venue_pipeline(
    raw: DataFrame,
    critical: Sequence[str] = CRITICAL_COLUMNS,
    numeric_columns: Sequence[str] = NUMERIC_COLUMNS,
    context_keys: Sequence[str] = ("city",),
    context_strategy: str = "aggregate",
    keep: Sequence[str] = (),
    exclude_imputed: bool = False,
) -> DataFrame:
    """Raw rows -> good rows -> 13 contract columns (``keep``: extra leading
    columns such as a row key; ``exclude_imputed``: unrated venues do not
    pull their city's mean towards 0)."""
    good, _ = split(raw, critical)
    return transform_good(
        good, numeric_columns, context_keys, context_strategy, keep, exclude_imputed=exclude_imputed
    )
