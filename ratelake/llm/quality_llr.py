"""Quality rules: word and line counts per document, and a hashed n-gram
log-likelihood ratio between a trusted target and the raw corpus.

Both sides are multinomials over ``BUCKETS`` hashes of the texts' byte
n-grams. One is added to every raw count, and the target gets the raw
distribution as a prior of the same mass, so that n-grams a small target has
not seen count as rarer by a bounded factor only. A document's score is the mean over
its n-grams of ``log p_target - log p_raw``; documents under ``MIN_SCORE`` are
rejected, and so are those that fail the base rules (under 50 words, or more
than half of the words inside repeated three-word windows).

The raw side counts every n-gram of every document. The target side is fitted
on at most ``TRUSTED_ROWS`` labelled rows of quality 1, those with the lowest
hash of their id (a bounded sample, documented parameter). Only the two count
vectors, whose length is fixed, reach the driver.

Nulls: a null text has no words; ids may be null or repeat, every row gets its
own result. A text without an n-gram scores 0. Without trusted rows every
score is 0 and only the base rules reject. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm import textkit as tk

BUCKETS = 1 << 16
GRAM = 4
TRUSTED_ROWS = 20_000
MIN_SCORE = -0.6
MIN_WORDS = 50
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_NEWLINE = tk.byte_class((0x0A, 0x0A))
_U = np.uint64
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept")


def _grams(s: tk.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte n-gram inside a row, and the rows' first offsets."""
    pos, first = tk.ngram_rows(s.off, GRAM)
    b = s.buf.astype(np.uint32)
    m = max(b.size - GRAM + 1, 0)
    packed = np.zeros(m, np.uint32)
    for k in range(GRAM):
        packed = (packed << np.uint32(8)) | b[k : k + m]
    packed ^= packed >> np.uint32(15)
    packed *= np.uint32(0x2C1B3C6D)
    packed ^= packed >> np.uint32(12)
    packed *= np.uint32(0x297A2D39)
    return (packed >> np.uint32(16))[pos], first


def _repeats(first: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Per row: words that lie in a three-word window found twice or more in it."""
    pos, _ = tk.ngram_rows(first, 3)
    if pos.size == 0:
        return np.zeros(first.size - 1, np.int64)
    row = tk.owners(first)[pos]
    key = tk.ngrams(h, 3)[pos] + tk.mix(row)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(key.size, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    word = np.zeros(h.size, bool)
    for k in range(3):
        word[pos[twice] + k] = True
    return tk.count_in(np.flatnonzero(word), first)


def _dup_lines(s: tk.Slice, starts: np.ndarray) -> np.ndarray:
    """Per row: lines with a word that equal an earlier line of the row."""
    a, z, first = tk.spans(s, _NEWLINE)
    worded = np.searchsorted(starts, a) < np.searchsorted(starts, z)
    row = tk.owners(first)[worded]
    key = tk.span_hash(s.buf, a, z)[worded] + tk.mix(row)
    unique = np.unique(key, return_index=True)[1]
    rows = s.off.size - 1
    return np.bincount(row, minlength=rows) - np.bincount(row[unique], minlength=rows)


def measures(s: tk.Slice) -> dict[str, np.ndarray]:
    """The base counts of each row of a slice."""
    a, z, first = tk.spans(s, tk.SPACE)
    n_words = np.diff(first)
    letters = np.concatenate([[0], np.cumsum(z - a)])[first]
    tails = np.flatnonzero((s.buf & 0xC0) == 0x80)
    return {
        "n_words": n_words,
        "word_chars": np.diff(letters) - tk.count_in(tails, s.off),
        "n_symbols": tk.count_in(np.flatnonzero(SYMBOLS[s.buf]), s.off),
        "n_dup_lines": _dup_lines(s, a),
        "n_repeat_words": _repeats(first, tk.span_hash(s.buf, a, z)),
    }


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        trusted = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), dtype=bool)
        for s in tk.slices(batch.column(0), 1 << 18):
            gram, first = _grams(s)
            total[0] += np.bincount(gram, minlength=BUCKETS)
            own = trusted[s.lo : s.hi]
            if own.any():
                total[1] += np.bincount(gram[np.repeat(own, np.diff(first))], minlength=BUCKETS)
    held = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[0][held]), pa.array(total[1][held])], ["bucket", "raw", "target"])


def log_ratios(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each bucket. ``trusted`` holds the ids of the
    bounded target sample, small enough for a broadcast by its row limit."""
    ids = trusted.select(F.col("doc_id").alias("trusted_id")).where("trusted_id is not null").distinct()
    flagged = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("trusted_id"), "left")
    counts = flagged.select("text", F.col("trusted_id").isNotNull().alias("trusted")).mapInArrow(_count, "bucket int, raw long, target long")
    out = np.zeros((2, BUCKETS))
    for row in counts.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():  # at most BUCKETS rows
        out[0, row[0]] += row[1]
        out[1, row[0]] += row[2]
    raw = (out[0] + 1) / (out[0].sum() + BUCKETS)
    target = (out[1] + BUCKETS * raw) / (out[1].sum() + BUCKETS)
    return np.log(target) - np.log(raw)


def trusted_sample(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """Ids of at most ``rows`` labelled documents of quality 1, by id hash."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def row_sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each row's values, by themselves: no row's sum depends on the
    rows beside it."""
    out = np.zeros(first.size - 1)
    some = np.flatnonzero(np.diff(first))
    if some.size:
        out[some] = np.add.reduceat(x, first[some])
    return out


def _judge(ratios: np.ndarray, min_score: float):
    def run(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        parts = []
        for s in tk.slices(batch.column(batch.schema.get_field_index("text")), 1 << 18):
            m = measures(s)
            gram, first = _grams(s)
            m["llr"] = row_sums(ratios[gram], first) / np.maximum(np.diff(first), 1)
            m["base_failed"] = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
            m["kept"] = ~m["base_failed"] & (m["llr"] >= min_score)
            parts.append(m)
        return {k: np.concatenate([p[k] for p in parts]) for k in METRICS}

    return run


def judged(docs: DataFrame, trusted: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id`` and the measures of every document, with ``kept``."""
    judge = _judge(log_ratios(docs, trusted), min_score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = judge(batch)
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(m[k]) for k in METRICS)], ["doc_id", *METRICS])

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, llr double, base_failed boolean, kept boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def keep_good(docs: DataFrame, trusted: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    judge = _judge(log_ratios(docs, trusted), min_score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(judge(batch)["kept"]))

    return docs.mapInArrow(run, docs.schema)
