"""Centroid clustering over dictionary-encoded subvectors.

Vectors become integers (``floor(SCALE * x)``), are cut into blocks of
``WIDTH`` dimensions, and every block of a batch of vectors is replaced by a
code into the batch's dictionary of distinct subvectors: lossless, since the
dictionary holds each of them. The encoded batches are written once. A round
reads them, computes the exact squared distance of every dictionary entry to
every centroid once, and a vector's distance is the sum of its codes' partial
distances. New centroids come from the counts of the codes in each cluster,
weighted with the dictionary's entries. All sums are integers, so the result
does not depend on how the rows are laid out.

Only the centroids (``k`` vectors) and their sums travel between rounds; the
vectors are never shuffled and a dictionary never outgrows its batch.

Rules: a vector is kept if it has exactly ``dims`` components, none null, NaN
or infinite; others give no row. Repeated rows are clustered each. A null
``vec_id`` is clustered and stays null but never starts a centroid; rows alike
in ``vec_id`` start centroids in the order of their components. Fewer than
``k`` such rows make as many centroids; none make no rows. Integers beyond
``+-LIMIT`` count as ``+-LIMIT`` so that distances fit a long. All other
columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.llm.sparkkit import materialize

SCALE = 64
#: dimensions of a block
WIDTH = 2
#: 64 squares of up to twice this fit a long
LIMIT = 1 << 27
#: vectors encoded with one dictionary (a code has 16 bits)
CHUNK = 8192

_ENCODED = "ids array<long>, n int, codes binary, starts array<int>, entries binary, firsts array<struct<h: string, v: array<long>>>"


def seed_hash(vec_id: Column) -> Column:
    """Order of the vectors that start centroids."""
    return F.sha2(F.concat(F.lit("1:"), vec_id.cast("string")), 256)


def whole_vectors(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that are kept, and their components as integers."""
    values = column.flatten() if len(column) else column.values
    sizes = np.array(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    # null rows own no values in a flattened column
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    rows = np.flatnonzero(sizes == dims)
    bad = values.is_null().to_numpy(zero_copy_only=False)
    x = values.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
    at = starts[rows][:, None] + np.arange(dims)
    if not rows.size:
        return rows, np.zeros((0, dims), np.int64)
    good = np.isfinite(x[at]).all(axis=1) & ~bad[at].any(axis=1)
    whole = np.floor(SCALE * x[at[good]])
    return rows[good], np.clip(whole, -LIMIT, LIMIT).astype(np.int64)


def encode_blocks(v: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Codes (vectors x blocks) and each block's distinct subvectors."""
    codes, books = [], []
    for lo in range(0, v.shape[1], WIDTH):
        book, code = np.unique(v[:, lo : lo + WIDTH], axis=0, return_inverse=True)
        books.append(book)
        codes.append(code.reshape(-1).astype(np.uint16))
    return np.stack(codes, axis=1), books


def _encoder(dims: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                part = batch.slice(lo, CHUNK)
                rows, v = whole_vectors(part.column("v"), dims)
                if not rows.size:
                    continue
                ids = part.column("vec_id").take(pa.array(rows))
                codes, books = encode_blocks(v)
                hashes = [(None if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest()) for i in ids.to_pylist()]
                first = sorted((h, tuple(v[j].tolist())) for j, h in _least(hashes, k))
                padded = [np.pad(b, ((0, 0), (0, WIDTH - b.shape[1]))) for b in books]
                starts = np.concatenate([[0], np.cumsum([b.shape[0] for b in books])])
                yield pa.RecordBatch.from_pylist([{
                    "ids": ids.to_pylist(), "n": rows.size, "codes": codes.tobytes(), "starts": starts.tolist(),
                    "entries": np.concatenate(padded).tobytes(), "firsts": [{"h": h, "v": list(w)} for h, w in first[:k]],
                }], schema=_SCHEMA)

    return run


_SCHEMA = pa.schema([
    ("ids", pa.list_(pa.int64())), ("n", pa.int32()), ("codes", pa.binary()), ("starts", pa.list_(pa.int32())), ("entries", pa.binary()),
    ("firsts", pa.list_(pa.struct([("h", pa.string()), ("v", pa.list_(pa.int64()))]))),
])


def _least(hashes: list[str | None], k: int) -> list[tuple[int, str]]:
    """Rows with the k smallest hashes, and all that tie with the last one."""
    known = sorted(h for h in hashes if h is not None)[:k]
    return [(j, h) for j, h in enumerate(hashes) if h is not None and h <= known[-1]]


class Chunk:
    """One encoded batch."""

    def __init__(self, row: dict, dims: int) -> None:
        self.ids, self.n = row["ids"], row["n"]
        blocks = -(-dims // WIDTH)
        self.dims = dims
        self.codes = np.frombuffer(row["codes"], np.uint16).reshape(self.n, blocks)
        entries, s = np.frombuffer(row["entries"], np.int64).reshape(-1, WIDTH), row["starts"]
        self.books = [entries[s[j] : s[j + 1]] for j in range(blocks)]

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster (the smaller number on ties) and exact squared distance."""
        total = np.zeros((self.n, centroids.shape[0]), np.int64)
        wide = np.pad(centroids, ((0, 0), (0, len(self.books) * WIDTH - self.dims)))
        for j, book in enumerate(self.books):
            diff = book[:, None, :] - wide[None, :, j * WIDTH : (j + 1) * WIDTH]
            partial = (diff * diff).sum(axis=2)
            total += partial[self.codes[:, j]]
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(self.n), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Sum of the vectors of every cluster, through the codes' counts."""
        out = np.zeros((k, len(self.books) * WIDTH), np.int64)
        for j, book in enumerate(self.books):
            size = book.shape[0]
            counts = np.bincount(cluster * size + self.codes[:, j].astype(np.int64), minlength=k * size).reshape(k, size)
            out[:, j * WIDTH : (j + 1) * WIDTH] = counts @ book
        return out[:, : self.dims]


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk(batch.slice(i, 1).to_pylist()[0], dims)


def encoded(vectors: DataFrame, dims: int, k: int, vec_column: str = "embedding", name: str = "subvectors") -> DataFrame:
    """The dictionary-encoded batches of ``vectors``, written once."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vec_column).cast("array<double>").alias("v"))
    return materialize(rows.mapInArrow(_encoder(dims, k), _ENCODED), name)


def start_centroids(table: DataFrame, k: int) -> np.ndarray:
    """The vectors with the k smallest hashes; k rows reach the driver."""
    first = table.select(F.explode("firsts").alias("f")).select("f.h", "f.v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in first], dtype=np.int64)


def refine(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: assign every vector, then move each non-empty centroid to
    the floor of its vectors' mean."""
    k, dims = centroids.shape

    def run(batches):
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for chunk in _chunks(batches, dims):
            cluster, _ = chunk.nearest(centroids)
            n += np.bincount(cluster, minlength=k)
            total += chunk.sums(cluster, k)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(np.repeat(used, dims).astype(np.int32)), "dim": pa.array(np.tile(np.arange(dims), used.size).astype(np.int32)),
            "n": pa.array(np.repeat(n[used], dims)), "total": pa.array(total[used].reshape(-1)),
        })

    parts = table.select("ids", "n", "codes", "starts", "entries").mapInArrow(run, "cluster int, dim int, n long, total long")
    sums = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    moved = centroids.copy()
    for r in sums.collect():  # k x dims rows
        moved[r["cluster"], r["dim"]] = int(r["total"]) // int(r["n"])
    return moved


def assign(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    dims = centroids.shape[1]

    def run(batches):
        for chunk in _chunks(batches, dims):
            cluster, distance = chunk.nearest(centroids)
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array(chunk.ids, pa.int64()), "cluster": pa.array(cluster.astype(np.int32)), "distance": pa.array(distance),
            })

    return table.select("ids", "n", "codes", "starts", "entries").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 16, dims: int = 64, rounds: int = 3, vec_column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Assigned vectors (``vec_id, cluster, distance``) and the centroids."""
    table = encoded(vectors, dims, k, vec_column)
    centroids = start_centroids(table, k)
    if not centroids.size:
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dims), np.int64)
    for _ in range(rounds):
        centroids = refine(table, centroids)
    return materialize(assign(table, centroids), "assigned"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    at = F.col("cluster") + 1

    def per_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*(F.lit(v).cast(kind) for v in values)), at) if values else F.lit(None).cast(kind)

    return assigned.select(
        "vec_id", "cluster", "distance",
        per_cluster([sums.get(c, 0) for c in range(len(digests))], "long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        per_cluster(digests, "string").alias("centroid_sha256"),
    )
