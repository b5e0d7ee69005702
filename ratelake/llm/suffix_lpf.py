"""Suffix-array dedup: drop every byte that an earlier document already has.

A byte goes when some ``span``-byte string over it also starts in a document
with a smaller id. The suffixes (cut after ``span`` bytes) are put into suffix
order, the previous and next smaller ids in that order give the longest
previous factor of each, and factors of ``span`` bytes mark what is removed.

To order suffixes on many machines without shipping ``span`` bytes for each of
them, each ``span``-byte window is assigned to the place of the smallest hash
among its 24-byte strings (its anchor). Equal windows have equal anchors at
equal offsets, so windows can only match inside one anchor value:

1. Each task sends (anchor, hash of the stretch of windows around it) packed
   per hash bucket, in packets of at most ``PACKET`` entries and one slice's.
   Repeats inside a packet are settled there, so an anchor that a third of the
   documents hold is sent once per packet.
2. A bucket tells documents which stretches an earlier document holds whole,
   and which share only their anchor with another text.
3. Of the latter, and only of their first holders, the bytes are shipped, and
   the suffix order with the previous/next smaller ids decides each window.
4. Marked byte ranges meet the texts again; what is left is hashed.

Nulls: a null text is empty; a row with a null id is kept whole and removes
nothing. Rows that repeat an id are judged one by one and never remove bytes
of each other. Texts under ``span`` bytes are kept. An empty table gives an
empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm import textkit as tk
from ratelake.llm.sparkkit import id_column, key_runs, materialize, no_id, shuffle_partitions

SPAN = 50
_GRAM = 24
#: window starts that share one shipped piece; pieces are grouped by their common bytes
_PIECE = 8
#: documents' texts handled at once in the anchor step
_SLICE = 1 << 16
#: entries gathered before they are sent, whatever the size of a batch
PACKET = 1 << 18
#: window starts handled at once inside one long document
_STRIDE = 1 << 20
#: pieces of one group beyond which the group's windows are dealt out one by one
HOT_PIECES = 200_000
_U = np.uint64
_C1, _C2, _C3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _words(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position as an integer (zero bytes after the end)."""
    padded = np.zeros(buf.size + 8, np.uint8)
    padded[: buf.size] = buf
    return np.ndarray((buf.size,), "<u8", padded, strides=(1,))


def _hash_at(x: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each position in ``at`` (size >= 8)."""
    acc = np.full(at.size, size, _U)
    for o in [*range(0, size - 8, 8), size - 8]:
        acc ^= acc >> _U(31)
        acc *= _C2
        acc += x[at + o]
    return tk.mix(acc)


def anchors(buf: np.ndarray, off: np.ndarray, span: int = SPAN):
    """Stretches of window starts with one anchor.

    Returns first and last start, anchor position, anchor hash, stretch hash
    and row of each stretch. Depends on each row's bytes alone.
    """
    empty = np.zeros(0, np.int64)
    out: list[tuple] = []
    rows = [(0, off.size - 1)] if off.size and off[-1] - off[0] <= _STRIDE else [(r, r + 1) for r in range(off.size - 1)]
    for lo, hi in rows:
        a, b = int(off[lo]), int(off[hi])
        for p in range(a, max(b, a + 1), _STRIDE):
            part = buf[p : min(b, p + _STRIDE + span - 1)]
            if part.size >= span:
                local = np.clip(off[lo : hi + 1] - p, 0, part.size)
                first, last, pos, key, whole, row = _anchors(part, local, span)
                out.append((first + p, last + p, pos + p, key, whole, row + lo))
    if not out:
        return empty, empty, empty, np.zeros(0, _U), np.zeros(0, _U), empty
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _anchors(buf: np.ndarray, off: np.ndarray, span: int):
    n, width = buf.size, span - _GRAM + 1
    x = _words(buf)
    m = n - _GRAM + 1
    h = x[:m] * _C1
    for o in range(8, _GRAM, 8):
        h ^= h >> _U(29)
        h += x[o : o + m]
        h *= _C2
    h ^= h >> _U(32)
    h *= _C3
    # smallest hash of each window, leftmost on ties: the position is in the low bits
    low = (h & _U(0xFFFFFFFFFF000000)) | np.arange(m, dtype=_U)
    size = 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[: -(width - size)], low[width - size :])
    pos = (low & _U(0xFFFFFF)).astype(np.int64)
    length = np.diff(off)
    ok = np.arange(pos.size) <= np.repeat(off[1:] - span, length)[: pos.size]
    start = np.flatnonzero(ok)
    if start.size == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, _U), np.zeros(0, _U), z
    at = pos[start]
    new = np.flatnonzero((np.diff(at) != 0) | (np.diff(start) != 1)) + 1
    begin = np.concatenate([[0], new])
    end = np.concatenate([new, [start.size]]) - 1
    first, last, place = start[begin], start[end], at[begin]
    whole = tk.mix(_hash_at(x, first, span) * _C1 + _hash_at(x, last, span) * _C2 + (last - first).astype(_U))
    return first, last, place, h[place], whole, np.searchsorted(off, first, side="right") - 1


# --- 1: packed (anchor, stretch) entries per bucket --------------------------

_SENT = "bucket int, kind int, ids binary, counts binary, keys binary, wholes binary"
_SENT_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary()), ("keys", pa.binary()), ("wholes", pa.binary())])
#: kinds of packed rows: entries to settle, stretches an earlier document holds, stretches to look into
_OPEN, _GONE, _ASK = 0, 1, 2


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    return (tk.mix(x.astype(_U)) % _U(buckets)).astype(np.int64)


def _packed(bucket: np.ndarray, kind: int, ids: np.ndarray, whole: np.ndarray, key: np.ndarray | None = None) -> pa.RecordBatch:
    """One row per bucket; entries are grouped by document inside it."""
    order = np.lexsort((ids, bucket))
    bucket, ids, whole = bucket[order], ids[order], whole[order]
    cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [bucket.size]])
    rows: dict = {n: [] for n in _SENT_ARROW.names}
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if a == b:
            continue
        step = np.concatenate([[0], np.flatnonzero(np.diff(ids[a:b])) + 1, [b - a]])
        rows["bucket"].append(int(bucket[a]))
        rows["kind"].append(kind)
        rows["ids"].append(ids[a:b][step[:-1]].astype("<i8").tobytes())
        rows["counts"].append(np.diff(step).astype("<u4").tobytes())
        rows["keys"].append(b"" if key is None else _six(key[order[a:b]]))
        rows["wholes"].append(_six(whole[a:b]))
    return pa.RecordBatch.from_pydict(rows, _SENT_ARROW)


def _six(x: np.ndarray) -> bytes:
    """48 bits of each hash."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unsix(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _unpacked(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, stretches and anchors of packed rows."""
    ids = [np.repeat(np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["counts"], "<u4")) for r in rows]
    return np.concatenate(ids), np.concatenate([_unsix(r["wholes"]) for r in rows]), np.concatenate([_unsix(r["keys"]) for r in rows])


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for part in key_runs(batches, "bucket", 1):
        bucket = part["bucket"].to_numpy()
        for b in np.unique(bucket):
            yield part.filter(pa.array(bucket == b)).to_pylist()


def _packet(got: list[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries of some slices; repeats among them are settled here."""
    key, whole, doc = (np.concatenate(c) for c in zip(*got, strict=True))
    if key.size == 0:
        return
    order = np.argsort(whole)
    key, whole, doc = key[order], whole[order], doc[order]
    begin = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]]))
    group = np.repeat(np.arange(begin.size), np.diff(np.append(begin, whole.size)))
    least = np.minimum.reduceat(doc, begin)
    later = np.flatnonzero(doc > least[group])
    if later.size:  # the packet itself holds an earlier copy
        yield _packed(_bucket(doc[later], buckets), _GONE, doc[later], whole[later])
    yield _packed(_bucket(key[begin], buckets), _OPEN, least, whole[begin], key[begin])


def _send(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple] = []
        held = 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for s in tk.slices(batch.column(1), _SLICE):
                _, _, _, key, whole, row = anchors(s.buf, s.off)
                got.append((key, whole, ids[s.lo + row]))
                held += key.size
                if held >= PACKET:
                    yield from _packet(got, buckets)
                    got, held = [], 0
        if got:
            yield from _packet(got, buckets)

    return run


# --- 2: what each document is told ------------------------------------------


def _settle(buckets: int):
    """Answers to the entries, packed by bucket of the document; answers that
    came along are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bucket(batches):
            for r in rows:
                if r["kind"] != _OPEN:
                    yield pa.RecordBatch.from_pylist([r], _SENT_ARROW)
            rows = [r for r in rows if r["kind"] == _OPEN]
            if not rows:
                continue
            doc, whole, key = _unpacked(rows)
            order = np.argsort(key, kind="stable")
            key, whole, doc = key[order], whole[order], doc[order]
            # anchors of one document only take part in nothing
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(begin, key.size))
            several = np.repeat(np.minimum.reduceat(doc, begin) < np.maximum.reduceat(doc, begin), size)
            key, whole, doc = key[several], whole[several], doc[several]
            if key.size == 0:
                continue
            order = np.lexsort((doc, whole, key))
            key, whole, doc = key[order], whole[order], doc[order]
            other = np.concatenate([[True], key[1:] != key[:-1]])
            fresh = other | np.concatenate([[True], whole[1:] != whole[:-1]])
            begin = np.flatnonzero(fresh)
            gone = doc > doc[begin][np.cumsum(fresh) - 1]
            # stretches that share their anchor with another one
            anchor = np.cumsum(other) - 1
            texts = np.bincount(anchor[begin])
            ask = (texts > 1)[anchor] & ~gone & np.concatenate([[True], (doc[1:] != doc[:-1]) | fresh[1:]])
            for kind, use in ((_GONE, gone), (_ASK, ask)):
                if use.any():
                    yield _packed(_bucket(doc[use], buckets), kind, doc[use], whole[use])

    return run


_TOLD = "doc_id long, gone binary, ask binary"


def _tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document out of the packed answers."""
    for rows in _by_bucket(batches):
        parts = [(_unpacked(own)[:2], kind) for kind in (_ASK, _GONE) if (own := [r for r in rows if r["kind"] == kind])]
        doc = np.concatenate([p[0] for p, _ in parts])
        gone = np.concatenate([np.full(p[0].size, kind == _GONE) for p, kind in parts])
        order = np.lexsort((gone, doc))
        doc, gone = doc[order], gone[order]
        raw = np.concatenate([p[1] for p, _ in parts])[order].astype("<u8").tobytes()
        cut = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1, [doc.size]])
        asked = np.searchsorted(np.flatnonzero(gone), cut)  # gone entries before each cut
        mids = cut[1:] - np.diff(asked)  # within a document those to look into come first
        for a in range(0, cut.size - 1, 5_000):
            z = min(a + 5_000, cut.size - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[cut[a:z]], pa.int64()),
                    pa.array([raw[8 * m : 8 * e] or None for m, e in zip(mids[a:z], cut[a + 1 : z + 1], strict=True)], pa.binary()),
                    pa.array([raw[8 * b : 8 * m] or None for b, m in zip(cut[a:z], mids[a:z], strict=True)], pa.binary()),
                ],
                ["doc_id", "gone", "ask"],
            )


# --- 3: byte ranges that are settled, and pieces that the suffix order decides

_MARKED = "doc_id long, tkey long, lo int, hi int, core long, piece binary"


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("core", pa.int64()), ("piece", pa.binary())])

    def told(column: pa.Array, s: tk.Slice) -> np.ndarray:
        """Stretch hashes of the slice's rows, salted with the row."""
        got = [(r, v) for r, v in enumerate(column.slice(s.lo, s.hi - s.lo).to_pylist()) if v]
        if not got:
            return np.zeros(0, _U)
        row = np.repeat(np.array([r for r, _ in got]), [len(v) // 8 for _, v in got])
        return np.unique(np.frombuffer(b"".join(v for _, v in got), "<u8") + tk.mix(row))

    def among(x: np.ndarray, pool: np.ndarray) -> np.ndarray:
        if pool.size == 0:
            return np.zeros(x.size, bool)
        return pool[np.minimum(np.searchsorted(pool, x), pool.size - 1)] == x

    for batch in batches:
        ids, tkey = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for s in tk.slices(batch.column(2), _SLICE):
            gone, ask = told(batch.column(3), s), told(batch.column(4), s)
            if gone.size + ask.size == 0:
                continue
            first, last, pos, _, whole, row = anchors(s.buf, s.off)
            salted = (whole & _U((1 << 48) - 1)) + tk.mix(row)
            out = among(salted, gone)
            if out.any():
                a, z, r = first[out], last[out] + SPAN, row[out]
                # merge touching ranges of a row
                new = np.concatenate([[True], (a[1:] > np.maximum.accumulate(z)[:-1]) | (r[1:] != r[:-1])])
                begin = np.flatnonzero(new)
                r = r[begin]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[s.lo + r]), pa.array(tkey[s.lo + r]),
                        pa.array(a[begin] - s.off[r], pa.int32()), pa.array(np.maximum.reduceat(z, begin) - s.off[r], pa.int32()),
                        pa.nulls(begin.size, pa.int64()), pa.nulls(begin.size, pa.binary()),
                    ],
                    schema=schema,
                )
            todo = among(salted, ask) & ~out
            if todo.any():
                a, z, p, r = first[todo], last[todo], pos[todo], row[todo]
                low, high = (p - z) // _PIECE, (p - a) // _PIECE
                count = high - low + 1
                q = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                a, z, p, r = (np.repeat(v, count) for v in (a, z, p, r))
                a, z = np.maximum(a, p - _PIECE * q - _PIECE + 1), np.minimum(z, p - _PIECE * q)
                # every window of the piece covers these bytes
                core = _hash_at(_words(s.buf), p - _PIECE * q, SPAN - _PIECE + 1) + tk.mix(q)
                size = z - a + SPAN
                end = np.cumsum(size)
                data = s.buf[np.arange(end[-1]) + np.repeat(a - (end - size), size)]
                offsets = np.concatenate([[0], end]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[s.lo + r]), pa.array(tkey[s.lo + r]),
                        pa.array(a - s.off[r], pa.int32()), pa.array(z - s.off[r], pa.int32()), pa.array(core.view(np.int64)),
                        pa.BinaryArray.from_buffers(pa.binary(), r.size, [None, pa.py_buffer(offsets), pa.py_buffer(data)]),
                    ],
                    schema=schema,
                )


def _windows(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the pieces: bytes (n x SPAN), piece number, start in the text."""
    s = next(tk.slices(part["piece"].chunk(0), 1 << 62))
    count = np.diff(s.off) - SPAN + 1
    piece = np.repeat(np.arange(count.size), count)
    inside = np.arange(piece.size) - np.repeat(np.cumsum(count) - count, count)
    at = s.off[piece] + inside
    return s.buf[at[:, None] + np.arange(SPAN)], piece, part["lo"].to_numpy()[piece] + inside


def _factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Longest previous factors by the previous and next smaller ids in suffix order."""
    for part in key_runs(batches, "core", 20_000):
        text, piece, start = _windows(part)
        doc = part["doc_id"].to_numpy()[piece]
        padded = np.zeros((text.shape[0], 56), np.uint8)
        padded[:, :SPAN] = text
        columns = padded.view(">u8").astype(_U)
        order = np.lexsort(columns.T[::-1])
        columns, doc, piece, start = columns[order], doc[order], piece[order], start[order]
        # common prefixes of SPAN bytes join neighbours; a shorter one ends every factor that could matter
        apart = np.concatenate([[True], (columns[1:] != columns[:-1]).any(axis=1)])
        _, rank = np.unique(doc, return_inverse=True)
        size = int(rank.max()) + 1
        run = np.cumsum(apart)
        before = np.minimum.accumulate(rank - run * size) + run * size  # smallest id so far in the run
        back = run[::-1].max() - run[::-1]
        after = (np.minimum.accumulate(rank[::-1] - back * size) + back * size)[::-1]
        found = np.flatnonzero((before < rank) | (after < rank))  # a previous or next smaller id exists
        if found.size == 0:
            continue
        piece, start = piece[found], start[found]
        order = np.lexsort((start, piece))
        piece, start = piece[order], start[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(piece) != 0) | (np.diff(start) != 1)]))
        end = np.append(new[1:], piece.size) - 1
        yield pa.RecordBatch.from_arrays(
            [
                part["doc_id"].take(pa.array(piece[new])).combine_chunks(), part["tkey"].take(pa.array(piece[new])).combine_chunks(),
                pa.array(start[new], pa.int32()), pa.array(start[end] + SPAN, pa.int32()),
            ],
            ["doc_id", "tkey", "lo", "hi"],
        )


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        part = pa.Table.from_batches([batch]).combine_chunks()
        if part.num_rows == 0:
            continue
        text, piece, start = _windows(part)
        yield pa.RecordBatch.from_arrays(
            [
                part["doc_id"].take(pa.array(piece)).combine_chunks(), part["tkey"].take(pa.array(piece)).combine_chunks(),
                pa.array(start, pa.int32()), pa.array([bytes(t) for t in text], pa.binary()),
            ],
            ["doc_id", "tkey", "lo", "win"],
        )


def repeated_ranges(docs: DataFrame, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """Byte ranges ``(doc_id, tkey, lo, hi)`` of the texts that earlier
    documents hold; ranges of one text may overlap. ``tkey`` is the text's hash."""
    spark = docs.sparkSession
    texts = docs.select(id_column().alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    named = texts.where(F.col("doc_id") != no_id)
    buckets = shuffle_partitions(spark)
    sent = named.mapInArrow(_send(buckets), _SENT)
    settled = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_settle(buckets), _SENT)
    told = settled.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_tell, _TOLD)
    met = named.join(told, "doc_id").select("doc_id", F.xxhash64("text").alias("tkey"), "text", "gone", "ask")
    marked = materialize(met.mapInArrow(_mark, _MARKED), "lpf-marked")
    pieces = marked.where("core is not null")
    size = F.count("*")
    hot = materialize(pieces.groupBy("core").agg(size.alias("n")).where(F.col("n") > hot_pieces).select("core"), "lpf-hot")
    ranges = "doc_id long, tkey long, lo int, hi int"
    cool = pieces.join(hot, "core", "left_anti")
    cool = cool.repartition(buckets, "core").sortWithinPartitions("core")
    out = marked.where("core is null").select("doc_id", "tkey", "lo", "hi").union(
        cool.select("core", "doc_id", "tkey", "lo", "piece").mapInArrow(_factors, ranges)
    )
    if not hot.isEmpty():
        # the windows of a crowded group one by one; equal ones meet pre-aggregated
        each = pieces.join(hot, "core", "left_semi").select("doc_id", "tkey", "lo", "piece")
        each = materialize(each.mapInArrow(_single_windows, "doc_id long, tkey long, lo int, win binary"), "lpf-windows")
        least = each.groupBy("win").agg(F.min("doc_id").alias("least"))
        late = each.join(least, "win").where("doc_id > least")
        out = out.union(late.select("doc_id", "tkey", "lo", (F.col("lo") + SPAN).alias("hi")))
    return out


_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(texts: bool):
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + [("kept", pa.binary())] * texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for s in tk.slices(batch.column(1), 1 << 22):
                rows = []
                ranges = batch.column(2).slice(s.lo, s.hi - s.lo)
                for r, marks in enumerate(ranges.to_pylist()):
                    own = s.buf[s.off[r] : s.off[r + 1]]
                    removed = spans = 0
                    if marks:
                        edge = np.zeros(own.size + 1, np.int32)
                        np.add.at(edge, [m["lo"] for m in marks], 1)
                        np.add.at(edge, [m["hi"] for m in marks], -1)
                        cover = np.cumsum(edge[:-1]) > 0
                        removed = int(cover.sum())
                        spans = int(cover[0]) + int((cover[1:] & ~cover[:-1]).sum())
                        own = own[~cover]
                    kept = own.tobytes()
                    doc = ids[s.lo + r]
                    row = (None if doc == no_id else doc, int(s.off[r + 1] - s.off[r]), removed, spans, hashlib.sha256(kept).hexdigest())
                    rows.append((*row, kept) if texts else row)
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def drop_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per document: sizes, number of maximal removed runs, and the
    SHA-256 of the remaining bytes (``with_text``: also the bytes)."""
    ranges = repeated_ranges(docs).groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("lo", "hi")).alias("marks"))
    texts = docs.select(id_column().alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tkey", F.xxhash64("text"))
    met = texts.join(ranges, ["doc_id", "tkey"], "left").select("doc_id", "text", "marks")
    return met.mapInArrow(_cut(with_text), _KEPT + ", kept binary" * with_text)
