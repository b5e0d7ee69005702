"""N-gram Jaccard join by chosen paths.

Sets are the hashed five-word shingles of a text (a text of one to four words
has one shingle, all its words). Two documents are linked when the Jaccard
similarity of their sets is ``THRESHOLD`` or more. Documents with equal sets
form a class first; one member of each class takes part in the join.

Chosen paths (one run): every set is embedded as ``COORDS`` min-hash tokens.
Starting from a root, a bucket is split by sampled tokens: token j of a set is
chosen when a hash of (path, j) falls under 1 / (THRESHOLD * COORDS), and each
set goes to the child buckets of its chosen tokens. Similar sets choose shared
tokens together. Buckets of up to ``SMALL`` sets are compared by brute force
on compact sketches; larger ones are split again, ``DEPTH`` times at most, and
what then still is large is compared block by block. ``runs`` independent runs
bring the chance to find a pair at the threshold to the target recall.

The sketches only pick candidates (estimate over ``LOOSE``). Sets connected by
candidates are brought together and compared exactly by their full shingle
sets, in blocks of bounded size; a group of any size is spread over pairs of
blocks. The comparison counts links per set and keeps a spanning forest, so
the pairs inside a group are never emitted.

Nulls: a null text, and one without words, has no shingles: it is its own
class and has no links. A null id keeps its row (class id null if the whole
class has null ids). Repeated rows are members of one class. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm import textkit as tk
from ratelake.llm.sparkkit import components, key_runs, materialize, shuffle_partitions

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
COORDS = 128
DEPTH = 3
SMALL = 256
#: buckets that reach the last level are compared in blocks of so many sets
BLOCK = 512
#: sketch estimate from which a pair is a candidate: five deviations under the threshold
LOOSE = THRESHOLD - 5 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / COORDS)
#: exact comparison: rows and bytes of text of one block
EXACT_ROWS, EXACT_BYTES = 256, 4 << 20
NO_ID = (1 << 63) - 1
_U = np.uint64
_A = (tk.mix(np.arange(1, COORDS + 1)) >> _U(32)).astype(np.uint32) | np.uint32(1)
_B = (tk.mix(np.arange(1001, COORDS + 1001)) >> _U(32)).astype(np.uint32)


def runs_needed(recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold is found with this chance: a pair
    survives a level as a branching process with one expected child."""
    found = 1.0
    for _ in range(depth):
        found = 1 - math.exp(-found)
    return math.ceil(math.log(1 - recall) / math.log(1 - found))


def shingle_sets(s: tk.Slice) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a slice."""
    a, z, first = tk.spans(s, tk.SPACE)
    h = tk.span_hash(s.buf, a, z)
    grams = tk.ngrams(h, WORDS)
    out = []
    for b, e in zip(first[:-1], first[1:], strict=True):
        out.append(np.unique(grams[b : e - WORDS + 1]) if e - b >= WORDS else tk.ngrams(h[b:e], int(e - b)) if e > b else h[:0])
    return out


def _sketch(u: np.ndarray) -> np.ndarray:
    x = (u >> _U(32)).astype(np.uint32)
    least = np.full(COORDS, 0xFFFFFFFF, np.uint32)
    for p in range(0, x.size, 512):
        np.minimum(least, (x[p : p + 512, None] * _A + _B).min(axis=0), out=least)
    return least


def _print(u: np.ndarray) -> int:
    """Fingerprint of a set."""
    return int(tk.mix(np.array([tk.mix(u).sum(dtype=_U) + _U(u.size)], dtype=_U)).view(np.int64)[0])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in tk.slices(batch.column(1)):
            sets = shingle_sets(s)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(s.lo, s.hi - s.lo),
                    batch.column(2).slice(s.lo, s.hi - s.lo),
                    pa.array([_print(u) if u.size else None for u in sets], pa.int64()),
                    pa.array([u.size for u in sets], pa.int32()),
                    pa.array([_sketch(u).tobytes() if u.size else None for u in sets], pa.binary()),
                ],
                ["id", "tkey", "fp", "n", "sketch"],
            )


# --- the tree of chosen paths ------------------------------------------------


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _roots(runs: int):
    """(path, fp) of the first level of every run."""
    limit = _U(int((1 << 64) / (THRESHOLD * COORDS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in range(0, batch.num_rows, 512):
                part = batch.slice(p, 512)
                fp, m = part.column(0).to_numpy(), _matrix(part.column(1), "<u4").astype(_U)
                token = tk.mix(m + (np.arange(COORDS, dtype=_U) << _U(32)))
                paths, owner = [], []
                for r in range(runs):
                    h = tk.mix(token ^ tk.seed(r))
                    i, j = np.nonzero(h < limit)
                    paths.append(tk.mix(token[i, j] ^ tk.seed(r + 4096)))
                    owner.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(paths).view(np.int64)), pa.array(fp[np.concatenate(owner)])], ["path", "fp"])

    return run


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, fp) one level further down."""
    limit = _U(int((1 << 64) / (THRESHOLD * COORDS)))
    for batch in batches:
        for p in range(0, batch.num_rows, 4096):
            part = batch.slice(p, 4096)
            path, m = part.column(0).to_numpy().view(_U), _matrix(part.column(2), "<u4").astype(_U)
            token = tk.mix(m + (np.arange(COORDS, dtype=_U) << _U(32)))
            i, j = np.nonzero(tk.mix(token ^ tk.mix(path)[:, None]) < limit)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tk.mix(token[i, j] + path[i] * _U(3)).view(np.int64)), pa.array(part.column(1).to_numpy()[i])], ["path", "fp"]
            )


def _joined(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest reachable row of each of n rows over the given pairs."""
    label = np.arange(n)
    while left.size:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate edges inside buckets (columns: bucket, part, fp, sketch). Rows
    of part 0 are compared with each other, or with those of part 1 if the
    bucket is a pair of different blocks."""
    need = math.ceil(LOOSE * COORDS)
    for table in key_runs(batches, "bucket", 8192):
        order = np.lexsort((table["fp"].to_numpy(), table["bucket"].to_numpy()))
        table = table.take(pa.array(order))
        bucket, part, fp = (table[c].to_numpy() for c in ("bucket", "part", "fp"))
        sketch = _matrix(table["sketch"].combine_chunks(), np.uint8)
        crossed = np.flatnonzero(part)
        cross = np.isin(bucket, bucket[crossed]) if crossed.size else np.zeros(bucket.size, bool)
        left, right = [], []
        step = 1
        k = np.arange(bucket.size)
        while True:
            k = k[k + step < bucket.size]
            k = k[bucket[k] == bucket[k + step]]
            if k.size == 0:
                break
            use = k[(fp[k] != fp[k + step]) & (~cross[k] | (part[k] != part[k + step]))]
            for p in range(0, use.size, 16384):
                u = use[p : p + 16384]
                near = u[(sketch[u] == sketch[u + step]).sum(axis=1) >= need]
                left.append(near)
                right.append(near + step)
            step += 1
        a, b = (np.concatenate(x) if x else np.zeros(0, int) for x in (left, right))
        label = _joined(bucket.size, a, b)
        moved = np.flatnonzero(label != np.arange(bucket.size))
        yield pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[label[moved]])], ["u", "v"])


def candidates(sets: DataFrame, runs: int, name: str) -> DataFrame:
    """Spanning edges ``(u, v)`` between sets (columns fp, sketch) that the
    sketches take for similar."""
    spark = sets.sparkSession
    parts = shuffle_partitions(spark)
    small = sets.select("fp", F.col("sketch"))
    paths = materialize(small.mapInArrow(_roots(runs), "path long, fp long"), f"{name}-paths")
    out = None
    for level in range(1, DEPTH + 1):
        sizes = materialize(paths.groupBy("path").agg(F.count("*").alias("size")).where("size > 1"), f"{name}-sizes")
        last = level == DEPTH
        if last:
            near = paths.join(sizes, "path").select("path", "fp", "size")
        else:
            near = paths.join(sizes.where(F.col("size") <= SMALL), "path").select("path", "fp", "size")
        # one byte of each token is enough to compare buckets
        bytes_ = small.select("fp", "sketch").mapInArrow(_narrow, "fp long, sketch binary")
        rows = near.join(bytes_, "fp")
        blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
        own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(o, own).alias("i"), F.greatest(o, own).alias("j")))
        rows = rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("pair", F.explode(pairs))
        rows = rows.select(
            F.when(F.col("blocks") == 1, F.col("path")).otherwise(F.xxhash64("path", "pair.i", "pair.j")).alias("bucket"),
            ((F.col("own") == F.col("pair.j")) & (F.col("pair.i") != F.col("pair.j"))).cast("int").alias("part"),
            "fp", "sketch",
        )
        edges = rows.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_brute, "u long, v long")
        edges = materialize(edges.distinct(), f"{name}-edges")
        out = edges if out is None else out.union(edges)
        large = sizes.where(F.col("size") > SMALL).select("path")
        if last or large.isEmpty():
            break
        deeper = paths.join(large, "path").join(small, "fp").select("path", "fp", "sketch")
        paths = materialize(deeper.mapInArrow(_children, "path long, fp long"), f"{name}-paths")
    return out


def _narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            m = (tk.mix(_matrix(batch.column(1), "<u4")) & _U(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in m], pa.binary())], ["fp", "sketch"])


# --- exact comparison --------------------------------------------------------


def _similar(sets: list[np.ndarray], part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets with Jaccard similarity THRESHOLD or more; with
    rows of part 1, only pairs between the parts."""
    n = len(sets)
    crossed = part.any()
    if n <= 6:
        pairs = [(i, j) for j in range(n) for i in range(j) if not crossed or part[i] != part[j]]
        pairs = [(i, j) for i, j in pairs if _jaccard(sets[i].size, sets[j].size, np.intersect1d(sets[i], sets[j], assume_unique=True).size)]
        return (np.array([p[k] for p in pairs], int) for k in (0, 1))
    size = np.array([u.size for u in sets])
    owner = np.repeat(np.arange(n), size)
    value, place = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(place, kind="stable")
    holders = owner[order]
    begin = np.searchsorted(place[order], np.arange(value.size + 1))
    at = np.concatenate([[0], np.cumsum(size)])
    left, right = [], []
    for i in range(n):
        own = place[at[i] : at[i + 1]]
        count = begin[own + 1] - begin[own]
        total = int(count.sum())
        pos = np.arange(total) + np.repeat(begin[own] - (np.cumsum(count) - count), count)
        shared = np.bincount(holders[pos], minlength=n)[:i]
        ok = shared >= THRESHOLD * (size[i] + size[:i] - shared) - 1e-9
        if crossed:
            ok &= part[:i] != part[i]
        near = np.flatnonzero(ok)
        left.append(near)
        right.append(np.full(near.size, i))
    return np.concatenate(left), np.concatenate(right)


def _jaccard(a: int, b: int, shared: int) -> bool:
    return shared >= THRESHOLD * (a + b - shared) - 1e-9


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links per set and a spanning forest, per group (columns: bucket, part,
    fp, copies, text)."""
    for table in key_runs(batches, "bucket", 64):
        table = table.sort_by([("bucket", "ascending"), ("fp", "ascending"), ("part", "ascending")]).combine_chunks()
        bucket, part, fp, copies = (table[c].to_numpy() for c in ("bucket", "part", "fp", "copies"))
        text = table["text"].chunk(0) if table["text"].num_chunks else pa.array([], pa.string())
        sets = [u for s in tk.slices(text) for u in shingle_sets(s)]
        cut = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [bucket.size]])
        for a, z in zip(cut[:-1], cut[1:], strict=True):
            left, right = _similar(sets[a:z], part[a:z])
            if left.size == 0:
                continue
            left, right = left + a, right + a
            texts = np.bincount(left, minlength=bucket.size) + np.bincount(right, minlength=bucket.size)
            docs = np.bincount(left, copies[right], bucket.size) + np.bincount(right, copies[left], bucket.size)
            label = _joined(z - a, left - a, right - a) + a
            held = np.flatnonzero(texts[a:z]) + a
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp[held]), pa.array(texts[held]), pa.array(docs[held].astype(np.int64)), pa.array(fp[label[held - a]])],
                ["fp", "n_texts", "n_docs", "root"],
            )


def jaccard_join(docs: DataFrame, recall: float = RECALL, name: str = "cps") -> DataFrame:
    """One row per document: ``doc_id``; ``class_id``, the smallest id that
    links connect it with; ``n_links``, other documents linked to it;
    ``n_link_texts``, different shingle sets linked to its own; ``copy_id`` and
    ``n_copies``, smallest id and size of its class of equal sets."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    # a null id counts as the largest, so that it names a class only if all ids are null
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text", F.xxhash64("text").alias("tkey"))
    rows = materialize(texts.mapInArrow(_sets, "id long, tkey long, fp long, n int, sketch binary"), f"{name}-sets")
    known = rows.where("fp is not null")
    classes = known.groupBy("fp").agg(F.min(F.struct("id", "tkey")).alias("first"), F.count("*").alias("copies"), F.max("sketch").alias("sketch"))
    # a class is found again by id and text: many texts may share an id, or have none
    classes = classes.select("fp", F.col("first.id").alias("copy_id"), F.col("first.tkey").alias("copy_key"), "copies", "sketch")
    classes = materialize(classes, f"{name}-classes")
    loose = candidates(classes, runs_needed(recall), name)
    groups = materialize(components(loose, f"{name}-cc"), f"{name}-groups")
    members = groups.join(classes, groups["id"] == classes["fp"]).select("fp", "root", "copy_id", "copy_key", "copies")
    # one text per class
    met = texts.where(F.col("text").isNotNull()).join(members, (F.col("id") == F.col("copy_id")) & (F.col("tkey") == F.col("copy_key")))
    met = met.select("root", "fp", "copies", "text").mapInArrow(_own_sets, "root long, fp long, copies long, text string")
    met = materialize(met.dropDuplicates(["fp"]), f"{name}-met")
    weight = met.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / F.lit(EXACT_ROWS)), F.ceil(F.sum(F.octet_length("text")) / F.lit(EXACT_BYTES))).cast("int").alias("blocks")
    )
    wide = met.join(materialize(weight, f"{name}-weights"), "root").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    wide = wide.withColumn("pair", F.explode(pairs)).select(
        F.xxhash64("root", "pair.i", "pair.j").alias("bucket"),
        ((F.col("own") == F.col("pair.j")) & (F.col("pair.i") != F.col("pair.j"))).cast("int").alias("part"),
        "fp", "copies", "text",
    )
    links = wide.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_exact, "fp long, n_texts long, n_docs long, root long")
    links = materialize(links, f"{name}-links")
    degree = links.groupBy("fp").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_docs").alias("n_docs"))
    roots = components(links.select(F.col("fp").alias("u"), F.col("root").alias("v")), f"{name}-final")
    placed = classes.select("fp", "copy_id", "copies").join(roots, F.col("fp") == F.col("id"), "left").select("fp", "copy_id", "copies", F.coalesce("root", "fp").alias("root"))
    placed = materialize(placed, f"{name}-placed")
    first = materialize(placed.groupBy("root").agg(F.min("copy_id").alias("class_id")), f"{name}-first")
    done = materialize(placed.join(first, "root").join(degree, "fp", "left").drop("root"), f"{name}-done")
    out = rows.select("id", "fp").join(done, "fp", "left")

    def real(c: str):
        c = F.coalesce(F.col(c), F.col("id"))
        return F.when(c != NO_ID, c)

    zero = F.lit(0).cast("long")
    return out.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        real("class_id").alias("class_id"),
        (F.coalesce("n_docs", zero) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("n_texts", zero).alias("n_link_texts"),
        real("copy_id").alias("copy_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def _own_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text has the class's set (ids may repeat with other texts)."""
    for batch in batches:
        fp, keep = batch.column(1).to_numpy(), np.zeros(batch.num_rows, bool)
        for s in tk.slices(batch.column(3)):
            for r, u in enumerate(shingle_sets(s)):
                keep[s.lo + r] = u.size > 0 and _print(u) == fp[s.lo + r]
        yield batch.filter(pa.array(keep))
