"""Prefix trie of conversations, screened with a count-min sketch.

Every conversation is a sequence of turns; each distinct sequence of its first
d turns is a node. Turns are reduced to a SHA-256 key and a byte count when
they are read, so no text is shuffled. The turns of a conversation are ordered
by range partitioning, so a very long one spreads over many tasks; prefix
digests are running polynomial sums (two lanes of 64 bits) that carry over the
partitions' borders.

A count-min sketch over all prefix digests never counts too low: where it
estimates one, the prefix belongs to a single conversation, and its node is
finished where it is. Only prefixes that may be shared are shuffled and grouped
exactly. The sketch has a fixed size (``SLOTS`` x ``ROWS`` counters that stop
at two), which only decides how many prefixes take the exact way, never the
result.

What a node needs of its subtree comes from its members alone. The nodes whose
smallest member is c form the lower end of c's path, from depth a(c) on. Hence
summed over the members c of a node at depth d: c is the smallest member of
the child node (children); c stands for the childless node it ends in
(leaves); the bytes of c's turns d to a(c) - 1 (saved bytes: in every node all
members but the smallest count).

Rules: rows without conv_id are left out; turns in ascending order, null
first, ties by the SHA-256 of role and text; rows that repeat are turns that
repeat; null role or text is empty; an empty table has no nodes; other columns
are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.sparkkit import materialize
from ratelake.llm.textkit import _BASE, _BLOCK, _MASK, _POW, _POW_INV, mix, seed
from ratelake.operators.ordering import CUM, prefix_sums

#: conversations c - c % FAMILY .. share the head of the first of them
FAMILY = 5
#: heads have fewer turns than this
HEADS = 9
#: counters in a row of the sketch, and rows
SLOTS = 1 << 22
ROWS = 2
_CELL = 1 << 16
#: nodes with this share of all prefixes or more: at most so many exist
HOT = 1024
#: ids in one piece of a node's list
PIECE = 512

NODE = ["depth", "d1", "d2"]
_U = np.uint64


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, key, n_bytes``: the ordered turns of every
    conversation, from 1."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), key.alias("key"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    return prefix_sums(rows, ["turn", "key"], None, ["conv_id"]).select("conv_id", F.col(CUM).alias("pos"), "key", "n_bytes")


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt(placed: DataFrame) -> DataFrame:
    """Each conversation with the head of its family's first one before its
    own turns, as ``conv_id, part, pos, key, n_bytes``: in the order of part
    and pos, with one textless row (part 0) for the root."""
    conv = F.col("conv_id")
    convs = materialize(placed.select("conv_id").distinct(), "trie-conversations")
    first = conv % FAMILY == 0
    own = placed.where(first | (F.col("pos") > head_length(conv))).select("conv_id", F.lit(2).alias("part"), "pos", "key", "n_bytes")
    heads = placed.where(first & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "base")
    later = convs.where(~first).select("conv_id", (conv - conv % FAMILY).alias("base"), head_length(conv).alias("h"))
    taken = later.join(heads, "base").where("pos <= h").select("conv_id", F.lit(1).alias("part"), "pos", "key", "n_bytes")
    roots = convs.select("conv_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit(bytes(32)).alias("key"), F.lit(0).cast("long").alias("n_bytes"))
    return own.unionByName(taken).unionByName(roots)


# --- prefix digests ---------------------------------------------------------


class _Carry(NamedTuple):
    """State after the last row seen of a conversation: rows, both lanes of
    the digest, bytes."""

    conv: int | None
    rows: int
    d1: int
    d2: int
    upto: int


_PREFIX = "conv_id long, pid int, depth long, d1 long, d2 long, p1 long, p2 long, n_bytes long, upto long, last boolean"
_NAMES = [f.split()[0] for f in _PREFIX.split(", ")]


def _segments(conv: np.ndarray, carry: _Carry) -> tuple[np.ndarray, np.ndarray]:
    """For every row the index where its conversation starts, and whether the
    conversation began before the first row."""
    at = np.arange(conv.size)
    fresh = np.ones(conv.size, bool)
    fresh[1:] = conv[1:] != conv[:-1]
    goes_on = np.zeros(conv.size, bool)
    if carry.conv is not None and conv[0] == carry.conv:
        goes_on = np.cumsum(fresh) == 1
    return np.maximum.accumulate(np.where(fresh, at, 0)), goes_on


def _running(conv, lanes, n_bytes, carry: _Carry) -> tuple[dict[str, np.ndarray], _Carry]:
    start, goes_on = _segments(conv, carry)
    at = np.arange(conv.size)
    local = at - start
    out = {"depth": local + np.where(goes_on, carry.rows, 0)}
    shift = _U(pow(_BASE, carry.rows, 1 << 64))
    for lane, before in ((1, carry.d1), (2, carry.d2)):
        h = lanes[lane - 1]
        total = np.concatenate([np.zeros(1, _U), np.cumsum(h * _POW[at], dtype=_U)])
        inverse = _POW_INV[start]
        here, prior = (total[at + 1] - total[start]) * inverse, (total[at] - total[start]) * inverse
        for name, d in (("d", here), ("p", prior)):
            out[f"{name}{lane}"] = np.where(goes_on, _U(before) + shift * d, d)
    bytes_upto = np.concatenate([[0], np.cumsum(n_bytes)])
    out["upto"] = bytes_upto[at + 1] - bytes_upto[start] + np.where(goes_on, carry.upto, 0)
    return out, _Carry(int(conv[-1]), int(out["depth"][-1]) + 1, int(out["d1"][-1]), int(out["d2"][-1]), int(out["upto"][-1]))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums inside a sorted partition; the last row waits for the next
    one to show whether its conversation goes on."""
    carry, held = _Carry(None, 0, 0, 0, 0), None
    for batch in batches:
        for lo in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(lo, _BLOCK)
            conv = part.column("conv_id").to_numpy(zero_copy_only=False)
            key = part.column("key")
            data = np.frombuffer(key.buffers()[2], np.uint8)[32 * key.offset :][: 32 * len(key)]
            words = data.reshape(-1, 32)[:, :16].copy().view(_U)
            n_bytes = part.column("n_bytes").to_numpy(zero_copy_only=False)
            out, carry = _running(conv, (words[:, 0], words[:, 1]), n_bytes, carry)
            out |= {"conv_id": conv, "pid": part.column("pid").to_numpy(zero_copy_only=False), "n_bytes": n_bytes}
            out = {c: x.view(np.int64) if x.dtype == _U else x for c, x in out.items()}
            if held is not None:
                out = {c: np.concatenate([held[c], x]) for c, x in out.items()}
            conv = out["conv_id"]
            held = {c: x[-1:] for c, x in out.items()}
            ready = {c: x[:-1] for c, x in out.items()} | {"last": conv[1:] != conv[:-1]}
            if conv.size > 1:
                yield _rows(ready)
    if held is not None:
        yield _rows(held | {"last": np.ones(1, bool)})


_ARROW = {"pid": pa.int32(), "last": pa.bool_()}


def _rows(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], _ARROW.get(c, pa.int64())) for c in _NAMES], names=_NAMES)


def _carries(table: DataFrame) -> tuple[dict[int, _Carry], set[int]]:
    """What each partition's first conversation brings from the partitions
    before, and the partitions whose last conversation goes on in the next
    one; one row per partition reaches the driver."""
    summary = table.groupBy("pid").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "depth", "d1", "d2", "upto")).alias("end"))
    carries: dict[int, _Carry] = {}
    going_on: set[int] = set()
    state, before = _Carry(None, 0, 0, 0, 0), None
    for r in sorted(summary.collect(), key=lambda r: r["pid"]):
        end = r["end"]
        own = _Carry(end["conv_id"], end["depth"] + 1, end["d1"] & _MASK, end["d2"] & _MASK, end["upto"])
        if state.conv == r["first"]:
            carries[r["pid"]] = state
            going_on.add(before)
            if own.conv == state.conv:
                shift = pow(_BASE, state.rows, 1 << 64)
                own = _Carry(own.conv, state.rows + own.rows, (state.d1 + shift * own.d1) & _MASK, (state.d2 + shift * own.d2) & _MASK, state.upto + own.upto)
        state, before = own, r["pid"]
    return carries, going_on


def _finished(batch: pa.RecordBatch, carries: dict[int, _Carry], going_on: dict[int, tuple[int, int]]) -> dict[str, np.ndarray]:
    """The columns of a batch with what earlier partitions bring."""
    cols = {c: batch.column(c).to_numpy(zero_copy_only=False).copy() for c in _NAMES}
    for pid in np.unique(cols["pid"]).tolist():
        mine = cols["pid"] == pid
        if pid in going_on:
            conv, depth = going_on[pid]
            cols["last"][mine & (cols["conv_id"] == conv) & (cols["depth"] == depth)] = False
        if pid in carries:
            c = carries[pid]
            rows = mine & (cols["conv_id"] == c.conv)
            shift = _U(pow(_BASE, c.rows, 1 << 64))
            cols["depth"][rows] += c.rows
            cols["upto"][rows] += c.upto
            for lane, d in ((1, c.d1), (2, c.d2)):
                for name in ("d", "p"):
                    x = cols[f"{name}{lane}"].view(_U)
                    x[rows] = _U(d) + shift * x[rows]
    return cols


# --- count-min sketch -------------------------------------------------------


def _slots(d1: np.ndarray, depth: np.ndarray, slots: int) -> np.ndarray:
    """The counters of each prefix, one per row of the sketch."""
    x = mix(d1.view(_U) ^ mix(depth.astype(_U) + seed(7)))
    return np.stack([(mix(x + seed(r)) & _U(slots - 1)).astype(np.int64) + r * slots for r in range(ROWS)])


_CELLS = "cell int, ones binary, twos binary"


def _emit(cell: int, counts: np.ndarray) -> pa.RecordBatch:
    ones, twos = (np.flatnonzero(counts == n).astype(np.uint16).tobytes() for n in (1, 2))
    return pa.RecordBatch.from_pydict({"cell": pa.array([cell], pa.int32()), "ones": pa.array([ones], pa.binary()), "twos": pa.array([twos], pa.binary())})


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells: dict[int, np.ndarray] = {}
    for batch in batches:
        for cell, ones, twos in zip(*(c.to_pylist() for c in batch.columns)):
            counts = cells.setdefault(cell, np.zeros(_CELL, np.uint8))
            at = np.frombuffer(ones, np.uint16)
            counts[at] = np.minimum(counts[at] + 1, 2)
            counts[np.frombuffer(twos, np.uint16)] = 2
    for cell, counts in cells.items():
        yield _emit(cell, counts)


def _sketch(table: DataFrame, carries, going_on, slots: int) -> np.ndarray:
    """Counters that stop at two, over the prefixes of all conversations."""

    def count(batches):
        counts = np.zeros(ROWS * slots, np.uint8)
        for batch in batches:
            cols = _finished(batch, carries, going_on)
            at, n = np.unique(_slots(cols["d1"], cols["depth"], slots), return_counts=True)
            counts[at] = np.minimum(counts[at] + np.minimum(n, 2), 2)
        for cell, part in enumerate(counts.reshape(-1, _CELL)):
            if part.any():
                yield _emit(cell, part)

    whole = np.zeros((ROWS * slots // _CELL, _CELL), np.uint8)
    merged = table.mapInArrow(count, _CELLS).repartition("cell").mapInArrow(_merge, _CELLS)
    for r in merged.collect():  # the sketch: ROWS x slots bytes, whatever the input
        whole[r["cell"], np.frombuffer(r["ones"], np.uint16)] = 1
        whole[r["cell"], np.frombuffer(r["twos"], np.uint16)] = 2
    return whole.reshape(-1)


def screened(sequences: DataFrame, slots: int = SLOTS) -> DataFrame:
    """A row per prefix of each conversation: ``conv_id, depth, d1, d2,
    n_bytes`` (of the last turn), ``upto`` (of all turns), ``last`` (the whole
    conversation), ``single`` (proven to belong to this conversation only) and
    ``border`` (single, but the prefix before it may be shared)."""
    spark: SparkSession = sequences.sparkSession
    order = ["conv_id", "part", "pos"]
    ranged = sequences.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id())
    table = materialize(ranged.select("conv_id", "pid", "key", "n_bytes").mapInArrow(_digests, _PREFIX), "trie-prefixes")
    carries, open_ends = _carries(table)
    ends = table.where(F.col("pid").isin(sorted(open_ends))).groupBy("pid").agg(F.max(F.struct("conv_id", "depth")).alias("e")).collect() if open_ends else []
    going_on = {r["pid"]: (r["e"]["conv_id"], r["e"]["depth"]) for r in ends}
    held = spark.sparkContext.broadcast(_sketch(table, carries, going_on, slots))
    names = ["conv_id", "depth", "d1", "d2", "n_bytes", "upto", "last", "single", "border"]

    def screen(batches):
        counts = held.value
        for batch in batches:
            cols = _finished(batch, carries, going_on)

            def proven(d1, depth):
                return (counts[_slots(d1, depth, slots)] < 2).any(axis=0)

            cols["single"] = proven(cols["d1"], cols["depth"])
            cols["border"] = cols["single"] & (cols["depth"] > 0) & ~proven(cols["p1"], np.maximum(cols["depth"] - 1, 0))
            yield pa.RecordBatch.from_arrays([pa.array(cols[c]) for c in names], names=names)

    kinds = "conv_id long, depth long, d1 long, d2 long, n_bytes long, upto long, last boolean, single boolean, border boolean"
    return materialize(table.mapInArrow(screen, kinds), "trie-screened")


# --- nodes ------------------------------------------------------------------


def _with_node(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members joined with their node. Nodes that hold one prefix in ``HOT``
    or more, ``HOT`` at most, are broadcast; the others meet by key."""
    total = nodes.agg(F.sum("n")).first()[0] or 0
    hot = nodes.where(F.col("n") * HOT >= total)
    rest = rows.join(F.broadcast(hot.select(*NODE)), NODE, "left_anti").join(nodes.where(F.col("n") * HOT < total), NODE)
    return rows.join(F.broadcast(hot), NODE).unionByName(rest)


def _pieces(piece: int):
    """Sorted members to comma-joined pieces of at most so many ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in NODE]
            conv = batch.column("conv_id").to_numpy(zero_copy_only=False)
            if not conv.size:
                continue
            fresh = np.ones(conv.size, bool)
            fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
            start = np.maximum.accumulate(np.where(fresh, np.arange(conv.size), 0))
            cut = np.flatnonzero((np.arange(conv.size) - start) % piece == 0)
            ends = [*cut[1:].tolist(), conv.size]
            texts = [",".join(map(str, conv[a:z].tolist())) for a, z in zip(cut.tolist(), ends)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c[cut]) for c in cols), pa.array(conv[cut]), pa.array(texts)], names=[*NODE, "first", "ids"])

    return run


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one digest per node; only a digest's state is held."""
    node, digest = None, None

    def done():
        return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in node), pa.array([digest.hexdigest()])], names=[*NODE, "ends_sha256"])

    for batch in batches:
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in [*NODE, "ids"])):
            if key == node:
                digest.update(b"," + ids.encode())
                continue
            if node is not None:
                yield done()
            node, digest = key, hashlib.sha256(ids.encode())
    if node is not None:
        yield done()


def _ends(rows: DataFrame, piece: int) -> DataFrame:
    """Per node the digest of the ascending ids that end in it."""
    ids = [*NODE, "conv_id"]
    sorted_ids = rows.where("last").select(*ids).repartitionByRange(*ids).sortWithinPartitions(*ids)
    pieces = sorted_ids.mapInArrow(_pieces(piece), "depth long, d1 long, d2 long, first long, ids string")
    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return dealt.mapInArrow(_hash_lists, "depth long, d1 long, d2 long, ends_sha256 string")


def trie(sequences: DataFrame, slots: int = SLOTS, piece: int = PIECE) -> DataFrame:
    """The nodes of ``sequences`` (as ``rebuilt`` returns them): ``conv_id``
    (the smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``. ``slots`` (a power of two from
    65536) is the width of the sketch, ``piece`` the ids in one piece of a
    node's list."""
    rows = screened(sequences, slots)
    nothing = F.sha2(F.lit(""), 256)
    shared = rows.where(~F.col("single")).drop("single", "border")
    nodes = materialize(shared.groupBy(*NODE).agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.bool_and("last").alias("childless")), "trie-nodes")
    led = F.col("least") != F.col("conv_id")
    top = F.max(F.when(led, F.struct("depth", "least", "upto")))
    paths = _with_node(shared, nodes).groupBy("conv_id").agg(
        top.alias("top"),
        # a conversation that ends in a prefix of its own stands for that leaf
        F.coalesce(F.bool_or(F.when(F.col("last"), ~led & F.col("childless"))), F.lit(True)).alias("leaf"),
    )
    paths = materialize(
        paths.select("conv_id", F.coalesce(F.col("top.depth") + 1, F.lit(0)).alias("own_from"), F.col("top.least").alias("up"), F.coalesce("top.upto", F.lit(0)).alias("led_bytes"), "leaf"),
        "trie-paths",
    )
    member = shared.join(paths, "conv_id")
    child = ~F.col("last") & (F.col("own_from") <= F.col("depth") + 1)
    saved = F.when(F.col("own_from") > F.col("depth"), F.col("led_bytes") - F.col("upto") + F.col("n_bytes")).otherwise(0)
    grouped = member.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(child.cast("long")).alias("n_children"),
        F.sum(F.col("leaf").cast("long")).alias("n_leaves"), F.sum(saved).cast("long").alias("saved_tokens"),
    )
    parent = F.when(F.col("depth") == 0, None).when(F.col("depth") > F.col("own_from"), F.col("conv_id")).otherwise(F.col("up")).alias("parent_conv_id")
    exact = grouped.join(_ends(shared, piece), NODE, "left").join(paths.select("conv_id", "own_from", "up"), "conv_id")
    exact = exact.select("conv_id", "depth", parent, "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))

    def tail(some: DataFrame, parent: Column) -> DataFrame:
        one = F.lit(1).cast("long")
        return some.select(
            "conv_id", "depth", parent, one.alias("n_convs"), (~F.col("last")).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
            F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(nothing).alias("ends_sha256"),
        )

    single = rows.where("single")
    inner = tail(single.where(~F.col("border")), F.when(F.col("depth") > 0, F.col("conv_id")).alias("parent_conv_id"))
    border = tail(single.where("border").join(paths, "conv_id"), parent)
    return exact.unionByName(inner).unionByName(border)
