"""Column profiles kept up batch by batch.

The state of a batch is small and mergeable: per column its rows, nulls, mean,
sum of squared deviations, smallest and largest value; per pair of columns the
rows without a null in any profiled column, both means and the sum of products
of deviations. States of different batches add up to the state of all their
rows (the deviations are moved to the common mean), so a whole-lake describe
or correlation needs the states only, and a new batch costs one pass over that
batch.

States are stored under ``<root>/batch_id=<N>``, with the time at which the
batch's folder was put in its place: a batch that was replaced is profiled
again, and one that is gone is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.session import delete_path, list_batch_ids, modified
from ratelake.sources.lake import BATCH_COLUMN, batch_path, write_batch

#: (a, b, n, nulls, mean_a, mean_b, products, lo, hi); a = b in a column's
#: own state, which counts the column's values; other rows are of pairs
STATE = "a string, b string, listwise boolean, n long, nulls long, mean_a double, mean_b double, products double, lo double, hi double"


def _one(a: str, b: str, listwise: bool, there: Column) -> Column:
    """The state of a pair over the rows where ``there`` holds."""
    x, y = (F.when(there, F.col(c).cast("double")) for c in (a, b))
    n = F.count_if(there)
    return F.struct(
        F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(listwise).alias("listwise"), n.alias("n"), (F.count(F.lit(1)) - n).alias("nulls"),
        F.avg(x).alias("mean_a"), F.avg(y).alias("mean_b"), (F.covar_pop(x, y) * n).alias("products"), F.min(x).alias("lo"), F.max(x).alias("hi"),
    )


def batch_state(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The state of ``df``: one aggregate, a row per column and per pair."""
    columns = list(columns)
    every = reduce(lambda p, q: p & q, [F.col(c).isNotNull() for c in columns])
    states = [_one(c, c, False, F.col(c).isNotNull()) for c in columns]
    states += [_one(a, b, True, every) for a, b in combinations_with_replacement(columns, 2)]
    return df.agg(F.array(*states).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def merged(states: DataFrame) -> DataFrame:
    """The state of all rows of several states' batches, from the states
    alone: deviations of a batch's rows from the common mean are those from
    its own mean plus those of its mean."""
    key = ["a", "b", "listwise"]
    n = F.col("n").cast("double")
    share = F.when(F.col("n") > 0, n)
    means = states.groupBy(*key).agg(
        F.try_divide(F.sum(share * F.col("mean_a")), F.sum(share)).alias("whole_a"), F.try_divide(F.sum(share * F.col("mean_b")), F.sum(share)).alias("whole_b")
    )
    # one row per pair of columns, whatever the number of batches
    met = states.join(F.broadcast(means), key)
    moved = F.col("products") + n * (F.col("mean_a") - F.col("whole_a")) * (F.col("mean_b") - F.col("whole_b"))
    return met.groupBy(*key).agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.max("whole_a").alias("mean_a"), F.max("whole_b").alias("mean_b"),
        F.sum(F.when(F.col("n") > 0, moved)).alias("products"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )


def update_states(
    spark: SparkSession,
    lake: str,
    root: str,
    columns: Sequence[str],
    read: Callable[[int], DataFrame],
) -> list[int]:
    """Bring the states under ``root`` up to the batches under ``lake``:
    ``read(N)`` is called for new and replaced batches only. Returns those."""
    done = []
    there = list_batch_ids(spark, lake, BATCH_COLUMN)
    for n in set(list_batch_ids(spark, root, BATCH_COLUMN)) - set(there):
        delete_path(spark, batch_path(root, n))
    known = {}
    if list_batch_ids(spark, root, BATCH_COLUMN):
        stamps = _states(spark, root).select(BATCH_COLUMN, "stamp", "columns").distinct()
        known = {r[BATCH_COLUMN]: (r["stamp"], r["columns"]) for r in stamps.collect()}  # one row per batch
    for n in there:
        stamp = modified(spark, batch_path(lake, n))
        if known.get(n) == (stamp, list(columns)):
            continue
        state = batch_state(read(n), columns).withColumn("stamp", F.lit(stamp)).withColumn("columns", F.array(*map(F.lit, columns)))
        write_batch(state.coalesce(1), root, n, by=None, cluster=False)
        done.append(n)
    return done


def _states(spark: SparkSession, root: str) -> DataFrame:
    schema = f"{STATE}, stamp long, columns array<string>, {BATCH_COLUMN} long"
    return spark.read.schema(schema).option("basePath", root).parquet(root)


def whole_describe(spark: SparkSession, root: str) -> DataFrame:
    """``column, count, null_count, mean, std, min, max`` of all batches."""
    own = merged(_states(spark, root).where("NOT listwise"))
    std = F.when(F.col("n") > 1, F.sqrt(F.col("products") / (F.col("n") - 1)))
    return own.select(
        F.col("a").alias("column"), F.col("n").alias("count"), F.col("nulls").alias("null_count"), F.col("mean_a").alias("mean"), std.alias("std"),
        F.col("lo").alias("min"), F.col("hi").alias("max"),
    )


def whole_corr(spark: SparkSession, root: str) -> DataFrame:
    """``col_a, col_b, corr`` over the rows of all batches without a null in
    any profiled column; null for a constant column."""
    pairs = merged(_states(spark, root).where("listwise"))
    own = pairs.where("a = b").select(F.col("a").alias("c"), F.col("products").alias("own"))
    with_a = pairs.join(F.broadcast(own.select(F.col("c").alias("a"), F.col("own").alias("own_a"))), "a")
    both = with_a.join(F.broadcast(own.select(F.col("c").alias("b"), F.col("own").alias("own_b"))), "b")
    corr = F.try_divide(F.col("products"), F.sqrt("own_a") * F.sqrt("own_b"))
    half = both.select(F.col("a").alias("col_a"), F.col("b").alias("col_b"), corr.alias("corr"))
    return half.unionByName(half.where("col_a <> col_b").select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr"))
