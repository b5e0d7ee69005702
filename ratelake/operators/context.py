"""Per-group context: each row against the mean of its group.

``value_mean = avg(value) over (partition by keys)`` and
``value_diff = value - value_mean``. Null keys form one group, like a window.

Two physical strategies:

* ``"aggregate"`` (default): partial ``groupBy(keys).agg(sum, count)`` with
  map-side combine, so only one small record per key and task crosses the
  shuffle; the group table is then written once to the shared checkpoint
  folder (lineage cut, reused by the size check and the join) and joined back
  null-safely. It is broadcast only when its measured row count is under
  ``max_broadcast_rows``; otherwise a shuffle join is planned and AQE's skew
  handling splits a hot key on the big side. No task ever holds a whole
  group, so one city holding a third of all rows costs nothing extra.
* ``"window"``: ``avg().over(Window.partitionBy(keys))`` - one exchange by
  key and a whole group per task. It is used only when a partial-aggregated
  pass shows that no group exceeds ``max_window_group_rows``; otherwise the
  exact aggregate strategy runs instead, so no task ever receives an
  unbounded group. Both average the same values; a mean of doubles may differ
  in its last digits, as it may between two runs of either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, join_on_keys
from ratelake.session import materialize

DEFAULT_MAX_WINDOW_GROUP_ROWS = 5_000_000


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the biggest group (map-side combined count, one scalar
    to the driver)."""
    top = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c")).first()[0]
    return int(top or 0)


def group_stats(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """``keys..., _sum, _n``: exact sum and count of non-null ``value``."""
    return df.groupBy(*keys).agg(
        F.sum(F.col(value)).alias("_sum"), F.count(F.col(value)).alias("_n")
    )


def group_context(
    df: DataFrame,
    value: str = "avg_rating",
    keys: Sequence[str] = ("city",),
    mean_col: str = "city_avg_rating",
    diff_col: str = "rating_diff_city",
    strategy: str = "aggregate",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    stats: DataFrame | None = None,
    max_window_group_rows: int = DEFAULT_MAX_WINDOW_GROUP_ROWS,
    mean_of: str | None = None,
) -> DataFrame:
    """Add ``mean_col`` (group mean of ``value``) and ``diff_col``.

    ``stats`` (``keys..., _sum, _n``) replaces the statistics of ``df`` itself,
    e.g. cumulative statistics over everything ingested so far. ``mean_of``
    names another column to average (nulls ignored), e.g. the value with
    imputed rows blanked; the difference is still taken from ``value``."""
    keys = list(keys)
    src_col = mean_of or value
    if stats is not None:
        strategy = "aggregate"
    if strategy == "window" and largest_group(df, keys) > max_window_group_rows:
        strategy = "aggregate"  # a group too big for one task: exact fallback
    if strategy == "window":
        w = Window.partitionBy(*[F.col(k) for k in keys])
        out = df.withColumn(mean_col, F.avg(F.col(src_col)).over(w))
        return out.withColumn(diff_col, F.col(value) - F.col(mean_col))
    if strategy != "aggregate":
        raise ValueError(f"unknown strategy {strategy!r}")

    src = stats if stats is not None else group_stats(df, src_col, keys)
    means = src.select(*keys, F.try_divide(F.col("_sum"), F.col("_n")).alias(mean_col))
    out = join_on_keys(df, means, keys, how="left", max_broadcast_rows=max_broadcast_rows)
    return out.withColumn(diff_col, F.col(value) - F.col(mean_col))


def merge_stats(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Combine two ``keys..., _sum, _n`` tables (null keys stay one group)."""
    return a.unionByName(b).groupBy(*keys).agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))


def leave_one_out_context(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    mean_col: str,
    diff_col: str,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Leak-free variant: each row against the mean of the *other* rows of its
    group - the group's sum and count without the row's own value - so a
    row's own label never enters its feature. Null when no other row has a
    value; a row with a null value is compared with the whole group."""
    keys = list(keys)
    stats = group_stats(df, value, keys)
    j = join_on_keys(df, stats, keys, how="left", max_broadcast_rows=max_broadcast_rows)
    x = F.col(value)
    others_sum = F.col("_sum") - F.coalesce(x, F.lit(0))
    others_n = F.col("_n") - F.when(x.isNull(), F.lit(0)).otherwise(F.lit(1))
    out = j.withColumn(mean_col, F.try_divide(others_sum, others_n.cast("double"))).drop("_sum", "_n")
    return out.withColumn(diff_col, x - F.col(mean_col))


def train_only_context(
    df: DataFrame,
    train: DataFrame,
    value: str,
    keys: Sequence[str],
    mean_col: str,
    diff_col: str,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Leak-free variant for a split: group means from the training rows
    only, joined onto every row (a group absent from training gets null)."""
    keys = list(keys)
    stats = group_stats(train, value, keys).select(
        *keys, F.try_divide(F.col("_sum"), F.col("_n")).alias(mean_col)
    )
    out = join_on_keys(df, stats, keys, how="left", max_broadcast_rows=max_broadcast_rows)
    return out.withColumn(diff_col, F.col(value) - F.col(mean_col))


def out_of_fold_context(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    fold: Column,
    mean_col: str,
    shrinkage: float = 0.0,
    fold_col: str = "fold",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Cross-fitted group mean: each row gets the mean of its group over the
    rows of the *other* folds, so neither its own value nor any of its fold
    enters the feature a model is trained on.

    ``fold`` numbers the folds (a hash of the row key, say); it is added as
    ``fold_col``. ``shrinkage`` (m) pulls small groups towards the mean of all
    rows of the other folds: ``(sum + m * mean) / (n + m)``; a group that is
    in no other fold gets that mean, or null if m is 0. Null values count
    nowhere, null keys form one group, a null fold is a fold of its own.

    One aggregate per group and fold reads the rows; sums of the other folds
    come by subtraction from the group's and the table's totals, which are
    taken from that small table."""
    keys = list(keys)
    rows = df.withColumn(fold_col, fold)
    by_fold = group_stats(rows, value, [*keys, fold_col])
    by_fold = materialize(by_fold.withColumn("_sum", F.col("_sum").cast("double")), "fold-stats")
    group = by_fold.groupBy(*keys).agg(F.sum("_sum").alias("_gs"), F.sum("_n").alias("_gn"))
    folds = by_fold.groupBy(fold_col).agg(F.sum("_sum").alias("_fs"), F.sum("_n").alias("_fn"))
    total, count = by_fold.agg(F.sum("_sum"), F.sum("_n")).first()
    met = join_on_keys(by_fold, group, keys, how="inner", max_broadcast_rows=max_broadcast_rows)
    met = join_on_keys(met, folds, [fold_col], how="inner", max_broadcast_rows=max_broadcast_rows)
    none = F.lit(0.0)
    # differences of sums: a group with no value elsewhere has exactly none
    n = F.col("_gn") - F.col("_n")
    s = F.when(n > 0, F.coalesce("_gs", none) - F.coalesce("_sum", none)).otherwise(none)
    rest_n = F.lit(count or 0) - F.col("_fn")
    rest = F.when(rest_n > 0, (F.lit(total or 0.0) - F.coalesce("_fs", none)) / rest_n)
    m = F.lit(float(shrinkage))
    mean = F.try_divide(s + F.when(m > 0, m * rest).otherwise(none), n + m)
    stats = met.select(*keys, fold_col, mean.alias(mean_col))
    return join_on_keys(rows, stats, [*keys, fold_col], how="left", max_broadcast_rows=max_broadcast_rows)
