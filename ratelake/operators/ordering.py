"""Distributed running sums over a total order, without a single-task window.

``prefix_sums(df, order, weight, groups)`` adds ``_cum``: the inclusive running
sum of ``weight`` in ``order``, restarting at each change of ``groups``.
``global_position`` is the special case weight 1, no groups (0-based row
position). Both are what ``sum() over (partition by g order by o rows
unbounded preceding)`` / ``row_number() over (order by o)`` compute, but those
put a whole group (or the whole table) into one task.

Plan:

1. ``repartitionByRange(*groups, *order)`` + ``sortWithinPartitions``:
   sampled range bounds spread even a hot group over many tasks (AQE may
   coalesce adjacent small ranges, which keeps them ordered).
2. ``mapInArrow`` computes the running sum inside each sorted partition
   (numpy over the weight of each Arrow batch, state carried across batches;
   all other columns pass through as they are, whatever their type).
   The built-in equivalent, a window partitioned by the partition id, needs
   its own hash exchange on that id, which is a second full shuffle; the
   in-task cumsum keeps the range partitioning it runs on.
3. The result is written once as Parquet to the shared folder, so the
   summary pass and the final pass read the very same rows (lineage cut,
   retry-safe, compressed and columnar).
4. One summary row per partition (first / last group, running sum at the last
   row) - a table bounded by the partition count, not by the data - gives
   each partition the carry of a group that began in an earlier partition.
   Only a partition's first group can carry, so the offset table has at most
   one row per partition and is broadcast under that proven bound.

Order keys must be unique within a group (add a tie-breaker otherwise), or
tied rows get an arbitrary but consistent order.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ratelake.session import materialize

PID = "_pid"
CUM = "_cum"


def _same_as_before(col: pa.Array) -> np.ndarray:
    """Whether each value but the first equals the one before it (nulls, and
    NaNs, equal each other)."""
    prev, cur = col.slice(0, len(col) - 1), col.slice(1)
    same = pc.fill_null(pc.equal(prev, cur), False)
    same = pc.or_(same, pc.and_(pc.is_null(prev), pc.is_null(cur)))
    if pa.types.is_floating(col.type):
        nan = pc.and_(pc.fill_null(pc.is_nan(prev), False), pc.fill_null(pc.is_nan(cur), False))
        same = pc.or_(same, nan)
    return same.to_numpy(zero_copy_only=False)


def _running_sum_fn(group_cols: list[str], weight_col: str | None):
    """Arrow in, Arrow out: the columns of the table pass through unchanged,
    whatever their type; only the weight is read as numbers."""

    def fn(batches):
        last: pa.RecordBatch | None = None  # last row of the previous batch
        carry = 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            if weight_col:
                w = pc.fill_null(batch.column(weight_col), 0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            else:
                w = np.ones(n, dtype="int64")
            cum = np.cumsum(w)
            if group_cols:
                change = np.zeros(n, dtype=bool)
                change[0] = last is None
                for c in group_cols:
                    col = batch.column(c)
                    if last is not None:
                        change |= ~_same_as_before(pa.concat_arrays([last.column(c), col]))
                    else:
                        change[1:] |= ~_same_as_before(col)
                # what the running sum was before each segment of the batch
                start = np.flatnonzero(change)
                base, number = (cum - w)[start], np.cumsum(change) - 1
                if not change[0]:  # the batch goes on with the last segment
                    base, number = np.concatenate([[-carry], base]), number + 1
                cum = cum - base[number]
            else:
                cum = cum + carry
            carry = int(cum[-1])
            last = batch.slice(n - 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cum, pa.int64())], names=[*batch.schema.names, CUM]
            )

    return fn


def prefix_sums(
    df: DataFrame,
    order: Sequence[str],
    weight: str | None = None,
    groups: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """``df`` plus ``_cum`` (inclusive running sum of ``weight``, 1 when None,
    over ``order`` within ``groups``)."""
    return prefix_sums_total(df, order, weight, groups, num_partitions)[0]


def prefix_sums_total(
    df: DataFrame,
    order: Sequence[str],
    weight: str | None = None,
    groups: Sequence[str] = (),
    num_partitions: int | None = None,
) -> tuple[DataFrame, int | None]:
    """``prefix_sums`` plus the grand total of ``weight`` when ungrouped
    (known from the partition summary, so it costs no extra job)."""
    groups, order = list(groups), list(order)
    keys = [*groups, *order]
    # without an explicit count AQE may coalesce adjacent ranges to the
    # advisory size: partitions stay contiguous and ordered, so the result is
    # the same and the task count follows the data size
    ranged = (
        df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    )
    ranged = (
        ranged.sortWithinPartitions(*keys)
        .withColumn(PID, F.spark_partition_id())
    )
    out_schema = StructType([*ranged.schema.fields, StructField(CUM, LongType(), False)])
    local = materialize(ranged.mapInArrow(_running_sum_fn(groups, weight), out_schema), "prefix_sums")

    # per-partition summary: bounded by the partition count
    if groups:
        gstruct = F.struct(*[F.col(c) for c in groups])
        summary = local.groupBy(PID).agg(
            F.min(gstruct).alias("first_g"),
            F.max(gstruct).alias("last_g"),
            F.max_by(F.col(CUM), F.struct(*[F.col(c) for c in keys])).alias("last_cum"),
        )
    else:
        summary = local.groupBy(PID).agg(F.max(F.col(CUM)).alias("last_cum"))
    rows = sorted(summary.collect(), key=lambda r: r[PID])

    offsets = []  # (pid, first group key..., offset) where the first group carries
    carry_key, carry = None, 0
    for r in rows:
        if groups:
            first_g, last_g = tuple(r["first_g"]), tuple(r["last_g"])
            off = carry if (carry_key is not None and first_g == carry_key) else 0
            if off:
                offsets.append((r[PID], *first_g, off))
            carry = (off if last_g == first_g else 0) + r["last_cum"]
            carry_key = last_g
        else:
            if carry:
                offsets.append((r[PID], carry))
            carry += r["last_cum"]
    total = None if groups else carry
    if not offsets:
        return local.drop(PID), total

    fg = [f"_fg{i}" for i in range(len(groups))]
    off_schema = StructType(
        [
            StructField(PID, IntegerType(), False),
            *[StructField(f, local.schema[g].dataType, True) for f, g in zip(fg, groups)],
            StructField("_off", LongType(), False),
        ]
    )
    off_df = df.sparkSession.createDataFrame(offsets, off_schema)
    joined = local.join(F.broadcast(off_df), PID, "left")
    hit = F.col("_off").isNotNull()
    for f, g in zip(fg, groups):
        hit = hit & F.col(g).eqNullSafe(F.col(f))
    add = F.when(hit, F.col("_off")).otherwise(F.lit(0))
    cols = [c for c in local.columns if c not in (PID, CUM)]
    return joined.select(*cols, (F.col(CUM) + add).alias(CUM)), total


def global_position(df: DataFrame, order: Sequence[str], out: str = "_pos",
                    num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (keys must be unique)."""
    r = prefix_sums(df, order, None, (), num_partitions)
    return r.withColumn(out, F.col(CUM) - 1).drop(CUM)
