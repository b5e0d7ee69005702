"""Duplicates that come after any watermark: a stream against its own lake.

Each micro-batch is compared with every key the lake holds. A Bloom filter of
those keys answers for almost all rows; only rows whose key may be known are
checked exactly, by an anti-join with the lake's key columns, so a wrong
"maybe" costs a look and never a row.

The filter is a table of 64-bit words: a key sets four bits of one word. Each
lake batch has its own words under ``<root>/_keys/batch_id=N``, so a replayed
batch replaces its own; they are merged with ``bit_or``. The table has at most
``words`` rows whatever the lake holds, which bounds what is broadcast. Beyond
some eight keys a word most keys are "maybe" and the exact join does the work.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratelake.session import list_batch_ids, materialize
from ratelake.sources.lake import BATCH_COLUMN, batch_path, write_batch
from ratelake.streaming.consumer import drain, with_trigger

#: words of the filter: 16 bytes each in a broadcast of 16 MB at most
WORDS = 1 << 20
_BITS = 4


def _word_and_bits(keys: Sequence[str], words: int) -> tuple[Column, Column]:
    """The word of a key and the bits it sets there."""
    where = F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(words))
    bits = F.xxhash64(F.lit(2), *keys)
    one = F.lit(1).cast("long")
    marks = [F.call_function("shiftleft", one, F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(_BITS)]
    return where, reduce(lambda a, b: a.bitwiseOR(b), marks)


def key_words(rows: DataFrame, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """``word, bits`` of the keys of ``rows``: one aggregate, combined in the
    tasks."""
    word, bits = _word_and_bits(keys, words)
    return rows.select(word.alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def maybe_known(rows: DataFrame, known: DataFrame, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """``rows`` with the boolean ``_maybe``: false proves that the key is none
    of those in ``known``."""
    word, bits = _word_and_bits(keys, words)
    merged = known.groupBy("word").agg(F.bit_or("bits").alias("_set"))
    marked = rows.withColumn("_word", word).withColumn("_bits", bits)
    met = marked.join(F.broadcast(merged), F.col("_word") == F.col("word"), "left")
    return met.withColumn("_maybe", F.coalesce(F.col("_bits").bitwiseAND(F.col("_set")) == F.col("_bits"), F.lit(False))).drop("_word", "_bits", "word", "_set")


def new_rows(rows: DataFrame, lake: str, keys: Sequence[str], batch_id: int, words: int = WORDS) -> DataFrame:
    """One row for each key of ``rows`` that no earlier batch of ``lake``
    holds. Of rows that share a new key the first in the order of all columns'
    hash stays. Null keys equal each other."""
    spark, keys = rows.sparkSession, list(keys)
    once = rows.withColumn("_o", F.xxhash64(*rows.columns)).groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), "_o").alias("_r")).select("_r.*")
    earlier = [n for n in list_batch_ids(spark, f"{lake}/_keys", BATCH_COLUMN) if n < batch_id]
    if not earlier:
        return once
    known = spark.read.schema("word long, bits long").parquet(*[batch_path(f"{lake}/_keys", n) for n in earlier])
    judged = materialize(maybe_known(once, known, keys, words), "judged-keys")
    fresh = judged.where(~F.col("_maybe")).drop("_maybe")
    maybe = judged.where("_maybe").drop("_maybe")
    if maybe.isEmpty():
        return fresh
    held = spark.read.parquet(*[batch_path(lake, n) for n in earlier]).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return fresh.unionByName(maybe.join(held, same, "left_anti"))


def run_dedup_lake(
    parsed: DataFrame,
    lake: str,
    keys: Sequence[str],
    checkpoint: str,
    trigger: str | None = "availableNow",
    timeout_s: float | None = None,
    words: int = WORDS,
    after_write: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Write each message of ``parsed`` to ``lake`` once, however late it is
    delivered again. A micro-batch that is taken again replaces its own folder
    and its own part of the filter, and is compared with earlier ones only.
    ``after_write`` is called between the two writes (tests fail there)."""

    def body(batch: DataFrame, batch_id: int) -> None:
        write_batch(new_rows(batch, lake, keys, batch_id, words), lake, batch_id, by=None)
        if after_write is not None:
            after_write(batch_id)
        written = batch.sparkSession.read.schema(batch.schema).parquet(batch_path(lake, batch_id))
        write_batch(key_words(written, keys, words), f"{lake}/_keys", batch_id, by=None)

    q = with_trigger(parsed.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint), trigger).start()
    return drain(q, timeout_s, "deduplicating consumer") if trigger == "availableNow" else q
