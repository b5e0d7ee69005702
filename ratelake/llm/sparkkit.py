"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.session import delete_path, materialize, shared_path

__all__ = ["components", "delete_path", "key_runs", "materialize", "no_id", "shared_path", "shuffle_partitions", "table"]

#: stands for a null doc_id inside joins; such rows keep a null id in results
no_id = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_column(name: str = "doc_id") -> Column:
    """The id as a long that never is null."""
    return F.coalesce(F.col(name).cast("long"), F.lit(no_id))


def key_runs(batches: Iterator[pa.RecordBatch], key: str, min_rows: int) -> Iterator[pa.Table]:
    """Regroup a partition sorted by ``key`` into tables that never cut a key
    and hold ``min_rows`` rows or more (the last one may hold fewer)."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        k = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        if held and rows >= min_rows:
            last = held[-1]
            before = last.column(last.schema.get_field_index(key))[last.num_rows - 1].as_py()
            if before != k[0]:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows = [], 0
        held.append(batch)
        rows += batch.num_rows
        if rows >= min_rows:
            change = np.flatnonzero(k[1:] != k[:-1])
            if change.size:
                cut = int(change[-1]) + 1
                held[-1] = batch.slice(0, cut)
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows = [batch.slice(cut)], batch.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the undirected ``edges (u long, v long)``.

    Alternating large-star and small-star steps; every step is two grouped
    shuffles over the edges, written to the shared folder. Returns
    ``(id, root)`` with the smallest id of the component for every id that is
    on an edge; ids on self-loops only are their own root.
    """
    spark = edges.sparkSession
    current = materialize(edges.select("u", "v").where("u <> v").distinct(), name)
    nodes = materialize(edges.select(F.explode(F.array("u", "v")).alias("id")).distinct(), f"{name}-ids")
    seen = None
    while True:
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = materialize(large.where("u <> v").distinct(), name)
        # small star: every node links its smaller neighbours and itself to the smallest
        down = stars.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        current = materialize(small.where("u <> v").distinct(), name)
    roots = current.groupBy(F.greatest("u", "v").alias("id")).agg(F.min(F.least("u", "v")).alias("root"))
    return nodes.join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
