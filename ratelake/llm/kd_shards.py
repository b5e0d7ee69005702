"""Sharding by a k-d tree over document metadata (built-in functions only).

The root cell holds every document. A cell that is due more than one shard is
cut along its widest metadata dimension (extent relative to the whole corpus)
at the weighted median of the bytes, until each leaf is due one shard of
``target_bytes``. An odd count of shards is split as evenly as it goes and the
cut moves from the median to that share.

Medians are found without moving rows: rounds of grouped histograms, 16 bits
of the key at a time, narrow the cut of all cells at once. Rows alike in the
dimension are ordered by a hash of id, text, source, language and a number
among rows alike in all of these, so any number of equal texts, of equal or
missing ids, or a source with a third of all rows, still splits anywhere. Equal
rows are numbered by the stretches they were read in, never as one group. The
driver sees one row per cell, never a document.

Dimensions: log of the size, hash of the source, hash of the language, the id
(where the table has them; a missing column is no dimension, nulls come first).
Nulls: a null text has no bytes and CRC 0; null ids are ordinary rows. Repeated
rows are dealt like others; which of them goes where makes no difference to the
result. An empty table gives an empty result; with fewer rows than shards some
shards stay empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.sparkkit import materialize

_BITS = 31
_ROUND = 16


def _text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _hash31(*cols: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 64 - _BITS)


def described(docs: DataFrame) -> DataFrame:
    """Per row: id, size, CRC-32, hash of all that tells rows apart (``alike``)
    and the raw dimensions d0, d1, ..."""
    dims = [F.log(F.octet_length(_text()) + F.lit(1)).alias("d0")]
    for name in ("source", "lang"):
        if name in docs.columns:
            known = _hash31(F.col(name).cast("string")).cast("double")
            dims.append(F.when(F.col(name).isNotNull(), known).otherwise(-1.0).alias(f"d{len(dims)}"))
    dims.append(F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.0)).alias(f"d{len(dims)}"))
    return docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(_text()) + 1).cast("long").alias("size"),
        F.crc32(_text().cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id", _text(), *dims[1:]).alias("alike"),
        *dims,
    )


def _ordered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with their order hash ``tie``: equal rows are numbered inside
    each stretch, from the count of those in earlier stretches."""
    counts = rows.groupBy("alike", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("alike").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    # of rows that are alone the number is 0 already
    before = counts.withColumn("before", F.sum("n").over(earlier)).where("before > 0").select("alike", "stretch", "before")
    inside = Window.partitionBy("alike", "stretch").orderBy("size")
    met = rows.withColumn("nth", F.row_number().over(inside)).join(materialize(before, f"{name}-before"), ["alike", "stretch"], "left")
    tie = _hash31("alike", F.coalesce("before", F.lit(0)) + F.col("nth"))
    return materialize(met.withColumn("tie", tie).drop("alike", "stretch", "nth", "before"), f"{name}-ordered")


def kd_shards(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, name: str = "kd") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every document; shards
    number the leaves from left to right, slots count from 0 in each."""
    spark = docs.sparkSession
    # the root cell is a stored column, so that cells join by equality from the first level on
    rows = described(docs).withColumn("first", F.lit(0).cast("long")).withColumn("stretch", F.spark_partition_id())
    rows = _ordered(materialize(rows, f"{name}-rows"), name)
    n_dims = sum(c[0] == "d" and c[1:].isdigit() for c in rows.columns)
    span = rows.agg(F.count("*").alias("n"), F.sum("size").alias("w"), *(f(f"d{i}") for i in range(n_dims) for f in (F.min, F.max))).first()
    if not span["n"]:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    if n_shards is None:
        n_shards = max(1, math.ceil(span["w"] / target_bytes))
    # integer coordinates relative to the whole corpus, then the order hash
    scale = (1 << _BITS) - 1
    coords = []
    for i in range(n_dims):
        lo, hi = span[2 + 2 * i], span[3 + 2 * i]
        unit = F.lit(0.0) if hi <= lo else (F.col(f"d{i}") - F.lit(lo)) / F.lit(hi - lo)
        coords.append(F.floor(unit * scale).alias(f"c{i}"))
    cells = rows.select("doc_id", "size", "text_crc32", "tie", *coords, "first", F.lit(n_shards).cast("long").alias("due"))
    level = 0
    while n_shards > 1 and level < math.ceil(math.log2(n_shards)):
        cells = _split(cells, n_dims)
        level += 1
        cells = materialize(cells, f"{name}-level{level}")
    return _numbered(cells.withColumnRenamed("first", "shard"), span["n"])


def _split(cells: DataFrame, n_dims: int) -> DataFrame:
    """Cut every cell that is due several shards; ``first`` is its first shard."""
    spark = cells.sparkSession
    extent = cells.where("due > 1").groupBy("first", "due").agg(
        F.sum("size").alias("w"), *(F.max(f"c{i}").alias(f"hi{i}") for i in range(n_dims)), *(F.min(f"c{i}").alias(f"lo{i}") for i in range(n_dims))
    )
    plans = []
    for c in extent.collect():  # one row per cell
        wide = [c[f"hi{i}"] - c[f"lo{i}"] for i in range(n_dims)]
        axis = wide.index(max(wide))
        share = c["w"] * (c["due"] // 2) / c["due"]
        plans.append([c["first"], axis, c[f"lo{axis}"] << _BITS, ((c[f"hi{axis}"] + 1) << _BITS) - 1, 0, share])
    if not plans:
        return cells
    fields = "cell long, axis int, lo long, hi long, before long, share double"
    key = F.shiftleft(F.element_at(F.array(*(f"c{i}" for i in range(n_dims))), F.col("axis") + 1), _BITS) + F.col("tie")
    while any(p[3] > p[2] for p in plans):
        bounds = F.broadcast(spark.createDataFrame([tuple(p) for p in plans], fields))  # one row per cell
        inside = cells.where("due > 1").join(bounds, F.col("first") == F.col("cell")).withColumn("key", key).where("key between lo and hi")
        binned = inside.withColumn("bin", F.expr(f"(key - lo) div (shiftright(hi - lo, {_ROUND}) + 1)"))
        bins = binned.groupBy("cell", "bin", "lo", "hi", "before", "share").agg(F.sum("size").alias("w"), F.min("key").alias("least"), F.max("key").alias("most"))
        order = Window.partitionBy("cell").orderBy("bin")
        bins = bins.withColumn("upto", F.col("before") + F.sum("w").over(order))
        # the bin in which the cell's share is reached
        hit = bins.where("upto >= share").groupBy("cell").agg(F.min_by(F.struct("least", "most", "upto", "w"), "bin").alias("hit"))
        found = {r["cell"]: r["hit"] for r in hit.collect()}
        for p in plans:
            if p[3] > p[2]:
                h = found[p[0]]
                p[2], p[3], p[4] = h["least"], h["most"], h["upto"] - h["w"]
                if p[2] == p[3]:
                    # the row at the share goes to the side that leaves the sizes nearer
                    near = (p[5] - p[4]) > (h["upto"] - p[5])
                    p[2] = p[3] = h["most"] if near else h["most"] - 1
    bounds = F.broadcast(spark.createDataFrame([tuple(p) for p in plans], fields))
    met = cells.join(bounds, F.col("first") == F.col("cell"), "left").withColumn("key", key)
    half = F.expr("due div 2")
    right = F.col("key") > F.col("hi")
    return met.select(
        "doc_id", "size", "text_crc32", "tie", *(f"c{i}" for i in range(n_dims)),
        F.when(F.col("cell").isNull() | ~right, F.col("first")).otherwise(F.col("first") + half).alias("first"),
        F.when(F.col("cell").isNull(), F.col("due")).when(right, F.col("due") - half).otherwise(half).alias("due"),
    )


def _numbered(rows: DataFrame, n: int) -> DataFrame:
    """Gapless numbers inside each shard, by stretches of about sqrt(n) rows."""
    parts = max(1, int(n**0.5))
    rows = rows.withColumn("part", F.floor(F.col("tie") * F.lit(parts) / F.lit(float(1 << _BITS))))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "part").orderBy("tie", "doc_id", "text_crc32")
    met = rows.withColumn("rank", F.row_number().over(inside)).join(counts, ["shard", "part"])
    return met.select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int"), (F.col("before") + F.col("rank") - 1).cast("long").alias("slot")
    )
