"""Readers for the given test tables (one Parquet file or folder each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_CACHE: dict[tuple[int, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet(<sf_dir>/<name>.parquet)``; column pruning and
    filter pushdown reach the scan because the plan is built lazily on it.

    The given tables are read-only, so the DataFrame (its inferred schema and
    file listing, not any data) is kept per session: later queries over the
    same table skip the schema-inference job."""
    key = (id(spark), sf_dir.rstrip("/"), name)
    df = _CACHE.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _CACHE[key] = df
    return df
