"""Toxicity by a classifier chain.

Categories are predicted one after the other; each linear model sees the
document's words and the probabilities of the categories before it. While
training, those are out-of-fold predictions, so that a later model learns from
probabilities as noisy as the ones it gets when scoring.

The models are logistic regressions over the presence of hashed words and of
hashed word beginnings (``PREFIX`` bytes of longer words), fitted on at most ``SAMPLE`` labelled documents (those with the lowest hash of their
id; a bounded sample, documented parameter). A word is a feature of a category
when the Chernoff bound for its count among the category's documents stays
under chance for the whole vocabulary; every such word is one. Every document is scored on its whole
text.

Categories from the labels ``toxic`` and ``quality``: ``toxic``, then
``toxic_prose`` (toxic text of good quality), then ``toxic_junk`` (toxic text
of bad quality).

Nulls: a null text has no words and gets the words' base rate; null ids keep
their row; labels with a null are not used, of several labels for an id the
largest count. Without labelled rows every probability is 0. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm import textkit as tk

SAMPLE = 12_000
FOLDS = 3
FEATURES = 1 << 18
#: words of a model up to which Newton steps are solved with the whole matrix
DENSE = 1024
PREFIX = 6
RIDGE = 0.3
CATEGORIES = ("toxic", "toxic_prose", "toxic_junk")
_U = np.uint64


def _present(s: tk.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hashed lower-case words of each row, and the beginnings of the longer
    ones: feature numbers and row numbers."""
    low = s._replace(buf=tk.ASCII_LOWER[s.buf])
    a, z, first = tk.spans(low, tk.NON_ALNUM)
    row = tk.owners(first)
    longer = z - a > PREFIX
    begin = tk.span_hash(low.buf, a[longer], a[longer] + PREFIX) ^ tk.seed(1)
    both = np.concatenate([tk.span_hash(low.buf, a, z), begin])
    return (both & _U(FEATURES - 1)).astype(np.int64), np.concatenate([row, row[longer]])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in tk.slices(batch.column(3)):
            word, row = _present(s)
            pair = np.unique(row * FEATURES + word)
            cut = np.searchsorted(pair, np.arange(s.hi - s.lo + 1) * FEATURES)
            word = (pair % FEATURES).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(s.lo, s.hi - s.lo) for c in range(3)]
                + [pa.array([word[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
                ["doc_id", "toxic", "quality", "words"],
            )


class Linear(NamedTuple):
    """Words of a model, their weights, and weights of (1, earlier logits)."""

    words: np.ndarray
    weights: np.ndarray
    rest: np.ndarray


def _logit(p: np.ndarray) -> np.ndarray:
    return np.log((p + 1e-4) / (1 - p + 1e-4))


def _choose(word: np.ndarray, row: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All words whose count among the positives is beyond chance."""
    n = np.bincount(word, minlength=FEATURES)
    k = np.bincount(word, weights=y[row], minlength=FEATURES)
    base, seen = y.mean(), np.flatnonzero(n)
    if not 0 < base < 1:
        return np.zeros(0, np.int64)
    p = np.clip(k[seen] / n[seen], 1e-12, 1 - 1e-12)
    bound = n[seen] * (p * np.log(p / base) + (1 - p) * np.log((1 - p) / (1 - base)))
    strong = bound > np.log(seen.size / 0.05)
    return seen[strong]


def _solve(product, diagonal: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Conjugate gradients for a positive definite matrix known by its product
    and its diagonal."""
    x, r = np.zeros(right.size), right.copy()
    z = r / diagonal
    d, rz = z, r @ z
    for _ in range(10 * right.size):
        if np.linalg.norm(r) <= 1e-10 * np.linalg.norm(right):
            break
        hd = product(d)
        a = rz / (d @ hd)
        x, r = x + a * d, r - a * hd
        z = r / diagonal
        d, rz = z + (r @ z) / rz * d, r @ z
    return x


def _fit_sparse(at: np.ndarray, row: np.ndarray, n: int, y: np.ndarray, dense: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """The Newton steps of ``_fit`` without a matrix of rows by words: word
    ``at`` of n is present in ``row``; ``dense`` has the other columns."""
    times = lambda v: np.bincount(row, weights=v[at], minlength=y.size) + dense @ v[n:]
    back = lambda u: np.concatenate([np.bincount(at, weights=u[row], minlength=n), dense.T @ u])
    w = np.zeros(penalty.size)
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(times(w), -30, 30)))
        v = p * (1 - p)
        diagonal = np.concatenate([np.bincount(at, weights=v[row], minlength=n), (dense * dense).T @ v]) + penalty
        step = _solve(lambda d, v=v: back(v * times(d)) + penalty * d, diagonal, back(p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _fit(word: np.ndarray, row: np.ndarray, y: np.ndarray, earlier: np.ndarray) -> Linear:
    """Ridge logistic regression by Newton steps; rows are 0..len(y)-1."""
    words = _choose(word, row, y)
    at = np.searchsorted(words, word)
    own = np.zeros(word.size, bool) if words.size == 0 else words[np.minimum(at, words.size - 1)] == word
    penalty = np.full(words.size + 1 + earlier.shape[1], RIDGE)
    penalty[words.size] = 1e-3
    if words.size > DENSE:
        w = _fit_sparse(at[own], row[own], words.size, y, np.column_stack([np.ones(y.size), earlier]), penalty)
        return Linear(words, w[: words.size], w[words.size :])
    x = np.zeros((y.size, penalty.size))
    x[row[own], at[own]] = 1
    x[:, words.size] = 1
    x[:, words.size + 1 :] = earlier
    w = np.zeros(x.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), grad)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return Linear(words, w[: words.size], w[words.size :])


def _predict(m: Linear, word: np.ndarray, row: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    z = m.rest[0] + earlier @ m.rest[1:]
    if m.words.size and word.size:
        at = np.minimum(np.searchsorted(m.words, word), m.words.size - 1)
        own = m.words[at] == word
        z = z + np.bincount(row[own], weights=m.weights[at[own]], minlength=earlier.shape[0])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(word: np.ndarray, row: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> list[Linear]:
    """One model per column of ``labels``; (word, row) are the present words."""
    chain, earlier = [], np.zeros((labels.shape[0], 0))
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(float)
        chain.append(_fit(word, row, y, earlier))
        out = np.zeros(y.size)
        for f in np.unique(fold):
            inside = fold != f
            number = np.cumsum(inside) - 1
            use = inside[row]
            model = _fit(word[use], number[row[use]], y[inside], earlier[inside]) if inside.any() else chain[-1]
            out = np.where(inside, out, _predict(model, word, row, earlier))
        earlier = np.column_stack([earlier, _logit(out)])
    return chain


def fit_chain(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> list[Linear] | None:
    """The chain from the bounded sample of labelled documents."""
    known = labels.where("doc_id is not null and toxic is not null and quality is not null").groupBy("doc_id")
    known = known.agg(F.max("toxic").cast("int").alias("toxic"), F.max("quality").cast("int").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # bounded by the parameter
    met = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # one text for each labelled id: rows that repeat an id do not add to the sample
    one = F.min_by("text", F.struct(F.col("text").isNull(), F.xxhash64("text"), "text"))
    met = met.groupBy("doc_id", "toxic", "quality").agg(one.alias("text"))
    got = met.mapInArrow(_features, "doc_id long, toxic int, quality int, words binary").toArrow()
    if got.num_rows == 0:
        return None
    got = got.sort_by([("doc_id", "ascending"), ("words", "ascending")])
    words = [np.frombuffer(w, "<u4") for w in got["words"].to_pylist()]
    row = np.repeat(np.arange(len(words)), [w.size for w in words])
    toxic, good = got["toxic"].to_numpy() > 0, got["quality"].to_numpy() > 0
    fold = (tk.mix(got["doc_id"].to_numpy().astype(_U)) % _U(FOLDS)).astype(int)
    return train(np.concatenate(words).astype(np.int64), row, np.column_stack([toxic, toxic & good, toxic & ~good]), fold)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, a probability per category, and ``toxic`` (the first
    category's probability reaches ``threshold``)."""
    chain = fit_chain(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(FEATURES, bool)
        for m in chain or ():
            wanted[m.words] = True
        for batch in batches:
            for s in tk.slices(batch.column(1)):
                rows = s.hi - s.lo
                p = np.zeros((rows, len(CATEGORIES)))
                if chain:
                    word, row = _present(s)
                    use = wanted[word]
                    pair = np.unique(row[use] * FEATURES + word[use])
                    word, row = pair % FEATURES, pair // FEATURES
                    earlier = np.zeros((rows, 0))
                    for c, m in enumerate(chain):
                        p[:, c] = _predict(m, word, row, earlier)
                        earlier = np.column_stack([earlier, _logit(p[:, c])])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.lo, rows), *(pa.array(p[:, c]) for c in range(p.shape[1])), pa.array(p[:, 0] >= threshold)],
                    ["doc_id", *(f"p_{c}" for c in CATEGORIES), "toxic"],
                )

    schema = "doc_id long, " + ", ".join(f"p_{c} double" for c in CATEGORIES) + ", toxic boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
