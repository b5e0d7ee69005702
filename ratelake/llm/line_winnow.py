"""Line dedup by winnowing over line hashes.

Lines with a word are hashed; blank lines take no part. A window is a stretch
of ``RUN`` lines, or a shorter one that holds ``WORDS`` words or more. Of each
window the line with the smallest hash is selected (leftmost on ties), and only
selected lines are written, each place once: two places that share a window
select the same line of it, so every repeated run has a selected fingerprint in
both. Selected lines whose hash stands at one place only are dropped. The others
are extended to both sides over the windows that selected them, the windows are
joined to the earliest place of the same lines, and overlapping matches merge
into the whole repeated run. Lines of a run that started earlier (in a document
with a smaller id, or further up in the same one) are deleted; the first stays.

Fingerprints and windows are grouped with partial aggregation, so a run that
a third of the documents hold is one row per task before the shuffle. Windows
are equal if all their line hashes (64 bits each) are and, for a single line, a
second hash of its bytes.

Nulls: a null text has no lines; rows with a null id are kept whole. Rows that
repeat an id count as the same document, so they do not delete each other's
lines at the same place. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm import textkit as tk
from ratelake.llm.sparkkit import id_column, materialize, no_id

#: lines of a repeated run, at least
RUN = 3
#: words of a shorter repeated run, at least
WORDS = 50
_NEWLINE = tk.byte_class((0x0A, 0x0A))


def _lines(s: tk.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, hashes and word counts of the lines with a word, and the
    rows' first offsets."""
    a, z, _ = tk.spans(s, _NEWLINE)
    w, _, _ = tk.spans(s, tk.SPACE)
    words = np.searchsorted(w, z) - np.searchsorted(w, a)
    worded = words > 0
    h = tk.span_hash(s.buf, a, z)[worded]
    a, z = a[worded], z[worded]
    return a, z, h, words[worded], np.searchsorted(a, s.off)


def windows(h: np.ndarray, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line and size of every window, and the line it selects, ordered by
    the selected line."""
    starts, sizes, places = [], [], []
    for size in range(1, RUN + 1):
        at, _ = tk.ngram_rows(first, size)
        if size < RUN:
            at = at[sum(words[at + k] for k in range(size)) >= WORDS]
        starts.append(at)
        sizes.append(np.full(at.size, size))
        places.append(at + np.stack([h[at + k] for k in range(size)]).argmin(axis=0))
    start, size, place = (np.concatenate(x) for x in (starts, sizes, places))
    order = np.lexsort((size, start, place))
    return start[order], size[order], place[order]


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, tkey = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for s in tk.slices(batch.column(2)):
            a, z, h, words, first = _lines(s)
            start, size, place = windows(h, words, first)
            if place.size == 0:
                continue
            place, begin = np.unique(place, return_index=True)
            row = np.searchsorted(first, place, side="right") - 1
            of_place = pa.array(np.append(begin, start.size), pa.int32())
            start = start - np.repeat(first[row], np.diff(np.append(begin, start.size)))
            # the lines that a window around the place can reach
            lo, hi = np.maximum(first[row], place - RUN + 1), np.minimum(first[row + 1], place + RUN)
            reach = np.append(0, np.cumsum(hi - lo))
            around = h[np.arange(reach[-1]) + np.repeat(lo - reach[:-1], hi - lo)]
            check = np.zeros(place.size, np.int64)
            for k in np.flatnonzero(words[place] >= WORDS):
                line = s.buf[a[place[k]] : z[place[k]]].tobytes()
                check[k] = int.from_bytes(hashlib.blake2b(line, digest_size=8).digest(), "little", signed=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[s.lo + row]), pa.array(tkey[s.lo + row]), pa.array(h[place].view(np.int64)),
                    pa.array(place - first[row]), pa.array(check), pa.array(lo - first[row]),
                    pa.ListArray.from_arrays(pa.array(reach, pa.int32()), pa.array(around.view(np.int64))),
                    pa.ListArray.from_arrays(of_place, pa.array(start)), pa.ListArray.from_arrays(of_place, pa.array(size)),
                ],
                ["id", "tkey", "print", "place", "check", "lo", "around", "starts", "sizes"],
            )


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row for each selected line: its hash, its place, the lines around it
    from line ``lo`` on, and first lines and sizes of the windows that selected it."""
    texts = docs.select(id_column().alias("id"), F.coalesce("text", F.lit("")).alias("text")).where(F.col("id") != no_id)
    keyed = texts.select("id", F.xxhash64("text").alias("tkey"), "text")
    lists = "around array<long>, starts array<long>, sizes array<long>"
    return keyed.mapInArrow(_fingerprints, f"id long, tkey long, print long, place long, check long, lo long, {lists}")


def repeated_lines(docs: DataFrame, name: str = "winnow") -> DataFrame:
    """``id, tkey, line, size``: every window (by its first line) that an
    earlier place already has."""
    found = materialize(fingerprints(docs), f"{name}-prints")
    where = F.struct("id", "place")
    shared = found.groupBy("print").agg(F.min(where).alias("a"), F.max(where).alias("z")).where("a <> z").select("print")
    around = found.join(materialize(shared, f"{name}-shared"), "print", "left_semi")
    around = around.select("id", "tkey", "check", "lo", "around", F.explode(F.arrays_zip("starts", "sizes")).alias("w"))
    lines = F.expr("concat(slice(around, int(w.starts - lo + 1), int(w.sizes)), array(check))")
    around = materialize(
        around.select("id", "tkey", F.col("w.starts").alias("line"), F.col("w.sizes").alias("size"), lines.alias("lines")), f"{name}-around"
    )
    earliest = around.groupBy("lines").agg(F.min(F.struct("id", "line")).alias("earliest"))
    earliest = materialize(earliest, f"{name}-earliest")
    late = around.join(earliest, "lines").where(F.struct("id", "line") > F.col("earliest"))
    return late.select("id", "tkey", "line", "size").distinct()


def _delete(texts: bool):
    fields = [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_removed", pa.int64()), ("n_runs", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + [("kept", pa.string())] * texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for s in tk.slices(batch.column(1), 1 << 22):
                a, z, _, _, first = _lines(s)
                rows = []
                for r, runs in enumerate(batch.column(2).slice(s.lo, s.hi - s.lo).to_pylist()):
                    own = s.buf[s.off[r] : s.off[r + 1]].tobytes()
                    n, removed, parts = int(first[r + 1] - first[r]), 0, 0
                    if runs:
                        gone = np.zeros(n + 1, bool)
                        runs = np.asarray(runs)
                        for k in range(RUN):
                            gone[runs[runs[:, 1] > k, 0] + k] = True
                        gone = gone[:n]
                        removed, parts = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                        cut = set((a[first[r] : first[r + 1]][gone] - s.off[r]).tolist())
                        at, left = 0, []
                        for line in own.split(b"\n"):
                            if at not in cut or not line:
                                left.append(line)
                            at += len(line) + 1
                        own = b"\n".join(left)
                    doc = ids[s.lo + r]
                    row = (None if doc == no_id else doc, n, removed, parts, hashlib.sha256(own).hexdigest())
                    rows.append((*row, own.decode("utf-8", "replace")) if texts else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def drop_repeated_lines(docs: DataFrame, with_text: bool = False, name: str = "winnow") -> DataFrame:
    """One row per document: lines with a word, how many were deleted, in how
    many runs, and the SHA-256 of the remaining text (``with_text``: the text)."""
    runs = repeated_lines(docs, name).groupBy("id", "tkey").agg(F.collect_list(F.array("line", "size")).alias("runs"))
    texts = docs.select(id_column().alias("id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tkey", F.xxhash64("text"))
    met = texts.join(runs, ["id", "tkey"], "left").select("id", "text", "runs")
    schema = "doc_id long, n_lines long, n_removed long, n_runs long, kept_sha256 string" + ", kept string" * with_text
    return met.mapInArrow(_delete(with_text), schema)
