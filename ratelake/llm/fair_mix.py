"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order (by a hash of the
id), gone through up to ``MAX_EPOCHS`` times. A document's virtual finish time
is the number of words its source has queued up to and with it, divided by the
source's target. All queued entries are put in order of finish time, and the
mix takes them until the total budget is spent.

Targets: the sources in code point order (null last) weigh 5, 2, 1, repeating,
and share the budget, which is the total size. No target exceeds three times
its source's size; what is over goes to the others by weight until all fit.

Running sums never need a source in one task: a source's shuffle order is cut
into about sqrt(rows) stretches; sums of whole stretches and sums inside one
stretch are added. The global cut likewise looks at sums of about sqrt(rows)
stretches of finish time, then at the one stretch where the budget ends. Only
the sources' totals and the cut go through the driver.

Nulls: a null text has size 0; null sources form one source, the last. Null
ids are shuffled first. Repeated rows queue one by one; rows alike in id, size
and source are interchangeable. Documents of size 0 take no words. An empty
table gives an empty result. Other columns are carried along.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.llm.sparkkit import materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: sources whose totals the driver holds at most; more are refused, not dropped
MAX_SOURCES = 1_000_000
_SPREAD = 1 << 28
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> list[tuple[str | None, int, float]]:
    """Target words of each source, in code point order with null last."""
    ranked = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    weight = [weights[i % len(weights)] for i in range(len(ranked))]
    left, shares = sum(n for _, n in ranked), sum(weight)
    out: dict[int, float] = {}
    # in order of how early a rising share level reaches the source's bound
    order = sorted(range(len(ranked)), key=lambda i: most * ranked[i][1] / weight[i])
    for k, i in enumerate(order):
        if most * ranked[i][1] * shares < left * weight[i]:
            out[i] = float(most * ranked[i][1])
            left -= most * ranked[i][1]
            shares -= weight[i]
        else:
            out |= {j: weight[j] * left / shares for j in order[k:]}
            break
    return [(name, size, out[i]) for i, (name, size) in enumerate(ranked)]


class Mix(NamedTuple):
    """``docs`` with the queue columns, and the key of the last entry taken."""

    queued: DataFrame
    last: tuple | None
    stretch: int


def _order(epoch: int) -> list[Column]:
    # a source without words has target 0 and no finish time
    finish = F.try_divide(F.lit(epoch) * F.col("source_size") + F.col("upto"), F.col("target"))
    return [finish, F.col("source_rank"), F.lit(epoch), F.col("shuffle"), F.col("doc_id"), F.col("upto")]


def queue(docs: DataFrame, name: str = "mix") -> Mix:
    """``docs`` must hold doc_id, source and size; adds ``source_size``,
    ``target``, ``source_rank``, ``shuffle`` and ``upto`` (words queued up to
    and with the document in its source's first pass)."""
    spark = docs.sparkSession
    shuffle = F.coalesce(F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 7), 16, 10).cast("long"), F.lit(0))
    held = materialize(docs.withColumn("shuffle", shuffle), name)
    totals = held.groupBy("source").agg(F.sum("size"), F.count("*")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if not totals:
        empty = held.select("*", *(F.lit(None).cast(t).alias(c) for c, t in (("source_size", "long"), ("target", "double"), ("source_rank", "int"), ("upto", "long"))))
        return Mix(empty, None, 1)
    rows = {s: n for s, _, n in totals}
    goal = [
        (s, size, float(target), rank, max(1, int(rows[s] ** 0.5)))
        for rank, (s, size, target) in enumerate(targets([(s, int(n)) for s, n, _ in totals]))
    ]
    schema = T.StructType([
        T.StructField("source_of", held.schema["source"].dataType), T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()), T.StructField("source_rank", T.IntegerType()), T.StructField("stretches", T.LongType()),
    ])
    goals = spark.createDataFrame(goal, schema)
    met = held.join(goals, held["source"].eqNullSafe(goals["source_of"]))
    met = met.withColumn("part", F.floor(F.col("shuffle") * F.col("stretches") / F.lit(_SPREAD)))
    sums = met.groupBy("source_rank", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("source_rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_rank", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source_rank", "part").orderBy("shuffle", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = met.withColumn("own", F.sum("size").over(inside)).join(sums, ["source_rank", "part"])
    queued = queued.withColumn("upto", F.col("before") + F.col("own")).drop("own", "before", "part", "source_of", "stretches")
    queued = materialize(queued, f"{name}-queue")
    stretch = max(1, int(sum(rows.values()) ** 0.5))
    budget = sum(g[1] for g in goal)
    # entries of documents without words have nothing to take
    entries = queued.where("size > 0").select(
        "size",
        F.explode(F.array(*(F.struct(*(c.alias(f"k{i}") for i, c in enumerate(_order(e)))) for e in range(MAX_EPOCHS)))).alias("key"),
    )
    entries = entries.withColumn("bin", F.floor(F.least(F.col("key.k0"), F.lit(4.0)) * stretch))
    bins = entries.groupBy("bin").agg(F.sum("size").alias("words"))
    upto = bins.select("bin", F.sum("words").over(Window.orderBy("bin")).alias("end"), "words")
    cut = upto.where(F.col("end") > budget).orderBy("bin").first()
    if cut is None:
        return Mix(queued, (float("inf"),), stretch)
    start = cut["end"] - cut["words"]
    running = entries.where(F.col("bin") == cut["bin"]).select("key", F.sum("size").over(Window.orderBy("key")).alias("end"))
    last = running.where(F.col("end") + start <= budget).orderBy(F.desc("key")).select("key").first()
    if last is None:  # the cut falls before the stretch's first entry
        return Mix(queued, (cut["bin"] / stretch,), stretch)
    return Mix(queued, tuple(last["key"]), stretch)


def _taken(mix: Mix, epoch: int) -> Column:
    """Whether the mix takes the document's entry of this pass."""
    key = _order(epoch)
    if mix.last is None:
        return F.lit(False)
    if len(mix.last) == 1:
        return (F.col("size") > 0) & (key[0] < F.lit(mix.last[0]))
    at = F.struct(*(c.cast("double" if i == 0 else "long").alias(f"k{i}") for i, c in enumerate(key)))
    bound = F.struct(*(F.lit(v).cast("double" if i == 0 else "long").alias(f"k{i}") for i, v in enumerate(mix.last)))
    return (F.col("size") > 0) & (at <= bound)


def copies(mix: Mix) -> Column:
    """How often the mix takes the document."""
    return sum((F.when(_taken(mix, e), 1).otherwise(0) for e in range(MAX_EPOCHS)), F.lit(0))


def mixed(mix: Mix) -> DataFrame:
    """The mix itself: one row per entry taken, range-sorted by finish time."""
    passes = F.array_compact(F.array(*(F.when(_taken(mix, e), F.struct(*(c.alias(f"k{i}") for i, c in enumerate(_order(e))))) for e in range(MAX_EPOCHS))))
    out = mix.queued.withColumn("entry", F.explode(passes))
    return out.withColumn("finish", F.col("entry.k0")).orderBy("entry").drop("entry")
