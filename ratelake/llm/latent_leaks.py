"""Benchmark decontamination by latent semantic retrieval.

Texts are lower-cased words; a passage is a stretch of words. Over the words
of the benchmark, passages are TF-IDF vectors (words in more than ``STOP`` of
the passages carry no weight, unless a benchmark passage has little else).

1. Documents are reduced to the benchmark's word numbers, once (written table).
2. Document frequencies over all passages of ``BLOCK`` words.
3. Randomised SVD: with a random matrix R, every task adds up ``A'(A R)`` of
   its passages; the sum is a matrix of fixed size, from which the Nystrom
   form of ``A'A`` gives singular vectors and values on the driver.
4. Search: all overlapping windows of all documents and all benchmark passages
   are projected on the whitened singular vectors; pairs of cosine ``COSINE``
   or more are candidates.
5. Candidates are judged by the longest common subsequence of the benchmark
   passage and the window with its surroundings: a share of ``COPIED`` is a
   leak; from ``PARAPHRASED`` on it is one when the answer (the last sentence)
   is there too and the common words carry most of the passage's IDF.

The benchmark is read in blocks of ``ITEMS`` rows, each searched against all
documents, so that what tasks and the driver hold of it is bounded. Items of
fewer than ``MIN_WORDS`` words are no passage: they are leaks where all their
words stand consecutively. Only matrices of the size of
the benchmark's vocabulary reach the driver.

Nulls: null texts are empty and null ids have no result; a null item id is
reported as null. Repeated rows give one result per id and item. Empty tables
give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm import textkit as tk
from ratelake.llm.sparkkit import materialize

ITEMS = 2048
MIN_WORDS = 8
#: words of a benchmark passage at most; longer items are several passages
PASSAGE = 48
#: words of a block; windows are two blocks long for short passages and four for others
BLOCK = 16
SHORT = 32
STOP = 0.05
RANK, SKETCH = 64, 96
COSINE = 0.3
COPIED, PARAPHRASED = 0.75, 0.55
ANSWER = 0.8
_U = np.uint64


class Benchmark(NamedTuple):
    """Passages of one block of items, as vocabulary numbers (1 and up)."""

    vocabulary: np.ndarray
    items: list
    words: list
    answers: list


def _tokens(s: tk.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = tk.ASCII_LOWER[s.buf]
    a, z, first = tk.spans(s._replace(buf=low), tk.NON_ALNUM)
    return tk.span_hash(low, a, z), first, a


def benchmark_passages(rows: list) -> Benchmark:
    """From (item_id, text) rows."""
    items, words, answers = [], [], []
    for item, text in rows:
        s = next(tk.slices(pa.array([text or ""])))
        h, _, at = _tokens(s)
        if h.size < MIN_WORDS:
            continue
        body = s.buf.tobytes().rstrip(b" \t\r\n.!?")
        stop = max(body.rfind(c) for c in (b". ", b"! ", b"? ", b"\n"))
        answer = at > stop
        if not 2 <= answer.sum() <= h.size // 2:  # no sentence of its own: the last words
            answer = np.arange(h.size) >= h.size - max(2, h.size // 4)
        n = -(-h.size // PASSAGE)
        for part in np.array_split(np.arange(h.size), n):
            items.append(item)
            words.append(h[part])
            answers.append(h[part[answer[part]]] if answer[part].any() else h[part[-max(2, part.size // 4) :]])
    vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, _U)
    number = lambda w: np.searchsorted(vocabulary, w) + 1
    return Benchmark(vocabulary, items, [number(w) for w in words], [number(w) for w in answers])


def short_items(rows: list) -> list:
    """Item and word hashes of the (item_id, text) rows too short for a passage."""
    out = []
    for item, text in rows:
        h = _tokens(next(tk.slices(pa.array([text or ""]))))[0]
        if 0 < h.size < MIN_WORDS:
            out.append((item, h))
    return out


def _numbers(vocabulary: np.ndarray):
    """Documents as vocabulary numbers; 0 is any other word."""
    kind = "<u2" if vocabulary.size < (1 << 16) - 1 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # direct addressing by the low bits; shared slots go through a search
        mask = _U((1 << 20) - 1)
        slot = np.zeros(1 << 20, np.int32)
        low = (vocabulary & mask).astype(np.int64)
        slot[low] = np.arange(1, vocabulary.size + 1)
        several = np.bincount(low, minlength=1 << 20) > 1
        padded = np.concatenate([[_U(0)], vocabulary])
        for batch in batches:
            for s in tk.slices(batch.column(1)):
                h, first, _ = _tokens(s)
                at = (h & mask).astype(np.int64)
                n = slot[at]
                n[padded[n] != h] = 0
                again = np.flatnonzero(several[at] & (n == 0))
                if again.size:
                    p = np.minimum(np.searchsorted(vocabulary, h[again]), vocabulary.size - 1)
                    n[again] = np.where(vocabulary[p] == h[again], p + 1, 0)
                raw = n.astype(kind).tobytes()
                size = int(kind[2])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(s.lo, s.hi - s.lo),
                        pa.array([raw[size * a : size * z] for a, z in zip(first[:-1], first[1:], strict=True)], pa.binary()),
                    ],
                    ["doc_id", "words"],
                )

    return run, kind


def _blocks(column: pa.Array, kind: str, size: int):
    """Words of some rows at a time, with block starts that begin anew in each
    row: words, first block of each row, block starts."""
    for s in tk.slices(column, 1 << 18):
        words = s.buf.view(kind).astype(np.int64)
        off = s.off // int(kind[2])
        count = -(-np.diff(off) // size)
        first = np.concatenate([[0], np.cumsum(count)])
        start = np.repeat(off[:-1], count) + size * (np.arange(first[-1]) - np.repeat(first[:-1], count))
        yield s, words, off, first, start


def _frequencies(kind: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for _, words, _, _, start in _blocks(batch.column(0), kind, 2 * BLOCK):
                total[0] += start.size
                if words.size:
                    block = np.repeat(np.arange(start.size), np.diff(np.append(start, words.size)))
                    pair = np.sort(block * (size + 1) + words)
                    pair = pair[np.concatenate([[True], pair[1:] != pair[:-1]])] % (size + 1)
                    total += np.bincount(pair[pair > 0], minlength=size + 1)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["word", "n"])

    return run


def _random_matrix(size: int) -> np.ndarray:
    """The same normal deviates in every task: row w belongs to word w."""
    return np.random.Generator(np.random.PCG64(20_240_607)).standard_normal((size + 1, SKETCH)).astype(np.float32)


def _sum_products(kind: str, weight: np.ndarray):
    """Each task's part of A'(A R), in chunks of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = weight.size - 1
        scaled = _random_matrix(size) * weight[:, None]
        total = np.zeros((size + 1, SKETCH), np.float32)
        for batch in batches:
            for _, words, _, _, start in _blocks(batch.column(0), kind, 2 * BLOCK):
                block = np.repeat(np.arange(start.size), np.diff(np.append(start, words.size)))
                use = weight[words] > 0
                words, block = words[use], block[use]
                if words.size == 0:
                    continue
                begin = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
                y = np.add.reduceat(scaled[words], begin, axis=0)
                of = np.repeat(np.arange(begin.size), np.diff(np.append(begin, words.size)))
                order = np.argsort(words, kind="stable")
                words, of = words[order], of[order]
                begin = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
                total[words[begin]] += np.add.reduceat(y[of], begin, axis=0)
        total *= weight[:, None]
        for a in range(0, size + 1, 256):
            yield pa.RecordBatch.from_arrays([pa.array([a // 256], pa.int32()), pa.array([total[a : a + 256].tobytes()], pa.binary())], ["chunk", "part"])

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(part, np.float32).astype(np.float64)
            held[chunk] = held[chunk] + x if chunk in held else x
    for chunk, x in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["chunk", "part"])


def latent_basis(numbers: DataFrame, kind: str, weight: np.ndarray) -> np.ndarray:
    """Whitened right singular vectors of the TF-IDF passages, scaled by IDF:
    a passage's latent vector is the sum of its words' rows."""
    size = weight.size - 1
    parts = numbers.select("words").mapInArrow(_sum_products(kind, weight), "chunk int, part binary")
    sums = parts.repartition(max(1, min(64, size // 256 + 1)), "chunk").mapInArrow(_add_up, "chunk int, part binary").collect()  # size x SKETCH numbers
    w = np.zeros((size + 1, SKETCH))
    for chunk, part in sums:
        x = np.frombuffer(part, np.float64).reshape(-1, SKETCH)
        w[256 * chunk : 256 * chunk + x.shape[0]] = x
    r = _random_matrix(size).astype(np.float64)
    # Nystrom: A'A ~ W (R'W)^-1 W'
    core = r.T @ w
    value, vector = np.linalg.eigh((core + core.T) / 2)
    keep = value > max(value.max(initial=0), 1e-12) * 1e-9
    if not keep.any():
        return np.zeros((size + 1, RANK), np.float32)
    u, s, _ = np.linalg.svd(w @ (vector[:, keep] / np.sqrt(value[keep])), full_matrices=False)
    u, s = u[:, :RANK], s[:RANK]
    good = s > s[0] * 1e-6
    basis = np.zeros((size + 1, RANK), np.float32)
    basis[:, : good.sum()] = u[:, good] / s[good]
    return basis * weight[:, None].astype(np.float32)


def _common(text: np.ndarray, masks: dict[int, int], n: int) -> int:
    """Length of the longest common subsequence; ``masks`` has the places of
    each word in the passage of n words as bits."""
    full = (1 << n) - 1
    row = full
    for w in text:
        m = masks.get(w)
        if m:
            hit = row & m
            row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


def _masks(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << i
    return out


def _search(kind: str, b: Benchmark, basis: np.ndarray, idf: np.ndarray):
    groups = []
    for blocks, chosen in ((2, [i for i, w in enumerate(b.words) if w.size <= SHORT]), (4, [i for i, w in enumerate(b.words) if w.size > SHORT])):
        if chosen:
            q = np.stack([basis[b.words[i]].sum(axis=0) for i in chosen])
            q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-30)
            groups.append((blocks, chosen, q.astype(np.float32)))
    schema = pa.schema([("doc_id", pa.int64()), ("passage", pa.int32()), ("lcs", pa.float64()), ("answer", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [_masks(w) for w in b.words]
        answers = [_masks(w) for w in b.answers]
        alive = basis.any(axis=1)
        places = {}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for s, words, off, first, start in _blocks(batch.column(1), kind, BLOCK):
                if words.size == 0:
                    continue
                # latent sums of blocks, over the words that carry weight
                own = np.flatnonzero(alive[words])
                block = np.repeat(np.arange(start.size), np.diff(np.append(start, words.size)))[own]
                begin = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if own.size else own
                sums = np.zeros((start.size, basis.shape[1]), np.float32)
                if own.size:
                    sums[block[begin]] = np.add.reduceat(basis[words[own]], begin, axis=0)
                row = tk.owners(first)
                found: dict[tuple, tuple] = {}
                for blocks, chosen, q in groups:
                    step = blocks // 2
                    inside = np.arange(start.size) - first[row]
                    left = first[row + 1] - np.arange(start.size)
                    # windows begin at every step-th block; the last ones may be cut short
                    at = np.flatnonzero((inside % step == 0) & ((left >= blocks) | (inside == 0) | (left > blocks - step)))
                    y = sums[at].copy()
                    for k in range(1, blocks):
                        more = left[at] > k
                        y[more] += sums[at[more] + k]
                    norm = np.linalg.norm(y, axis=1)
                    some = norm > 0
                    at, y = at[some], y[some] / norm[some, None]
                    for p in range(0, at.size, 16384):
                        which, near = np.nonzero(q @ y[p : p + 16384].T >= COSINE)
                        cut = np.searchsorted(which, np.arange(len(chosen) + 1))
                        for j in np.flatnonzero(np.diff(cut)):
                            i = chosen[j]
                            own = at[p + near[cut[j] : cut[j + 1]]]
                            r = row[own]
                            a = np.maximum(start[own] - 2 * BLOCK, off[r])
                            z = np.minimum(start[own] + (blocks + 2) * BLOCK, off[r + 1])
                            # words of the passage that occur at all bound the subsequence
                            if i not in places:
                                places[i] = np.zeros(basis.shape[0], _U)
                                for w, m in masks[i].items():
                                    places[i][w] = m
                            n = b.words[i].size
                            need = PARAPHRASED * n
                            span = np.arange((blocks + 4) * BLOCK)
                            grid = np.minimum(a[:, None] + span, z[:, None] - 1)
                            held = np.bitwise_or.reduce(places[i][words[grid]], axis=1)
                            seen = np.bitwise_count(held)
                            maybe = seen >= COPIED * n
                            # a paraphrase needs most of the passage's IDF among the words that occur
                            rest = np.flatnonzero((seen >= need) & ~maybe)
                            bits = (held[rest, None] >> np.arange(n, dtype=_U)) & _U(1)
                            maybe[rest] = bits @ idf[b.words[i]] >= COPIED * idf[b.words[i]].sum()
                            for k in np.flatnonzero(maybe):
                                text = words[a[k] : z[k]].tolist()
                                common = _common(text, masks[i], n)
                                if common < need:
                                    continue
                                answer = _common(text, answers[i], b.answers[i].size) / b.answers[i].size
                                share = common / n
                                if share < COPIED:
                                    there = np.isin(b.words[i], text)
                                    weight = idf[b.words[i]]
                                    if answer < ANSWER or weight[there].sum() < COPIED * weight.sum():
                                        continue
                                key = (ids[s.lo + r[k]], i)
                                found[key] = max(found.get(key, (0.0, 0.0)), (share, answer))
                got = [(d, i, *v) for (d, i), v in found.items()]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got, strict=True), schema, strict=True)], schema=schema)

    return run


def _leaks_of(docs: DataFrame, b: Benchmark, name: str) -> DataFrame:
    spark = docs.sparkSession
    size = b.vocabulary.size
    reduce, kind = _numbers(b.vocabulary)
    numbers = materialize(docs.mapInArrow(reduce, "doc_id long, words binary"), f"{name}-numbers")
    counts = numbers.select("words").mapInArrow(_frequencies(kind, size), "word long, n long").groupBy("word").agg(F.sum("n"))
    df = np.zeros(size + 1)
    for w, n in counts.collect():  # one row per word of the benchmark
        df[w] = n
    total = max(df[0], 1.0)
    idf = np.log((total + 1) / (df + 0.5))
    idf[0] = 0
    weight = np.where(df > STOP * total, 0.0, idf)
    for w in b.words:
        if (weight[w] > 0).sum() < 4:
            weight[w] = idf[w]
    weight = np.maximum(weight, 0)
    weight[0] = 0
    basis = latent_basis(numbers, kind, weight.astype(np.float32))
    found = numbers.mapInArrow(_search(kind, b, basis, idf), "doc_id long, passage int, lcs double, answer double")
    item = spark.createDataFrame([(i, None if v is None else str(v)) for i, v in enumerate(b.items)], "passage int, item string")
    return found.join(F.broadcast(item), "passage").select("doc_id", "item", "lcs", "answer")


def _whole_items(texts: list[tuple]):
    """Documents that hold all words of a short item consecutively."""
    sizes = []
    for n in sorted({len(t) for t in texts}):
        own = np.array([i for i, t in enumerate(texts) if len(t) == n], np.int32)
        gram = np.array([tk.ngrams(np.array(texts[i], _U), n)[0] for i in own], _U)
        order = np.argsort(gram)
        sizes.append((n, gram[order], own[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for s in tk.slices(batch.column(1)):
                h, first, _ = _tokens(s)
                for n, gram, own in sizes:
                    at, runs = tk.ngram_rows(first, n)
                    if at.size == 0:
                        continue
                    g = tk.ngrams(h, n)[at]
                    p = np.minimum(np.searchsorted(gram, g), gram.size - 1)
                    hit = np.flatnonzero(gram[p] == g)
                    pair = np.unique(np.stack([tk.owners(runs)[hit], own[p[hit]]], axis=1), axis=0)
                    one = pa.array(np.ones(pair.shape[0]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[s.lo + pair[:, 0]]), pa.array(pair[:, 1].astype(np.int32)), one, one], ["doc_id", "passage", "lcs", "answer"]
                    )

    return run


def _whole_of(docs: DataFrame, short: list) -> DataFrame:
    texts: dict[tuple, list] = {}
    for item, h in short:
        texts.setdefault(tuple(h.tolist()), []).append(item)
    found = docs.mapInArrow(_whole_items(list(texts)), "doc_id long, passage int, lcs double, answer double")
    rows = [(i, None if v is None else str(v)) for i, items in enumerate(texts.values()) for v in items]
    item = docs.sparkSession.createDataFrame(rows, "passage int, item string")
    return found.join(F.broadcast(item), "passage").select("doc_id", "item", "lcs", "answer")


def leaks(docs: DataFrame, benchmark: DataFrame, name: str = "leaks") -> DataFrame:
    """One row per document and benchmark item that it leaks: ``doc_id,
    item_id``, share of the longest common subsequence, share of the answer."""
    spark = docs.sparkSession
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    kind = benchmark.schema["item_id"].dataType
    out, block = None, []

    def search(rows: list) -> None:
        nonlocal out
        b, short = benchmark_passages(rows), short_items(rows)
        found = [_leaks_of(texts, b, name)] if b.items else []
        found += [_whole_of(texts, short)] if short else []
        for one in found:
            out = one if out is None else out.union(one)

    for row in benchmark.select("item_id", "text").toLocalIterator():
        block.append(tuple(row))
        if len(block) == ITEMS:
            search(block)
            block = []
    search(block)
    if out is None:
        out = spark.createDataFrame([], "doc_id long, item string, lcs double, answer double")
    best = out.groupBy("doc_id", "item").agg(F.max(F.struct("lcs", "answer")).alias("best"))
    return best.select("doc_id", F.col("item").cast(kind).alias("item_id"), F.col("best.lcs").alias("lcs_share"), F.col("best.answer").alias("answer_share"))
