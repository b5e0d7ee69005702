"""Rows without id, ids that repeat, and results that must not depend on how
rows are laid out."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from ratelake.llm import chosen_path, kd_shards, quality_llr, toxic_chain


def _near(n):
    base = [f"w{i}" for i in range(120)]
    return [" ".join([*base[:i], f"x{i}", *base[i + 1 :]]) for i in range(n)]


def test_jaccard_join_of_rows_without_id(spark):
    texts = [*_near(60), _near(1)[0], "other words that stand alone here"]
    ids = [None] * 40 + [7] * 15 + list(range(100, 107))
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(3)
    out = chosen_path.jaccard_join(df).collect()
    near = [r for r in out if r["n_links"]]
    # every near copy differs from the others in two of 120 words: all are linked
    assert len(out) == len(texts) and len(near) == 61
    assert {r["n_links"] for r in near} == {60} and {r["class_id"] for r in near} == {7}
    alone = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    out = chosen_path.jaccard_join(alone).collect()
    assert sorted(r["n_links"] for r in out) == [0] + [60] * 61 and {r["doc_id"] for r in out} == {r["class_id"] for r in out} == {None}


def test_quality_scores_do_not_depend_on_the_layout(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice("alpha beta gamma delta eps zeta".split()) + str(rnd.randint(0, 9)) for _ in range(rnd.randint(0, 300)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 400, 3)], "doc_id long, quality int")
    trusted = quality_llr.trusted_sample(labels)
    one, many = ({r["doc_id"]: r["llr"] for r in quality_llr.judged(d, trusted).collect()} for d in (docs.coalesce(1), docs.repartition(37)))
    assert one == many  # bit by bit


def test_row_sums():
    x = np.arange(10.0)
    assert quality_llr.row_sums(x, np.array([0, 0, 3, 3, 10, 10])).tolist() == [0.0, 3.0, 0.0, 42.0, 0.0]
    assert quality_llr.row_sums(x[:0], np.array([0, 0])).tolist() == [0.0]


def test_a_labelled_id_that_repeats_adds_one_row_to_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxic_chain, "train", lambda word, row, labels, fold: seen.append(labels.shape[0]) or [])
    rows = [(i, f"text {i}") for i in range(20)] + [(3, f"again {k}") for k in range(500)] + [(4, None), (5, "text 5"), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    toxic_chain.fit_chain(docs, labels)
    assert seen == [20]


def test_shards_of_equal_rows(spark):
    rows = [(None, "one text of all these rows", "a")] * 300 + [(i, f"text {i} of this row alone", "b") for i in range(70)] + [(7, "x", None)] * 30
    for parts in (1, 9):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        out = kd_shards.kd_shards(docs, n_shards=8).collect()
        sizes, slots = {}, {}
        for r in out:
            sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert len(out) == 400 and len(sizes) == 8 and max(sizes.values()) < 1.1 * min(sizes.values())
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_do_not_depend_on_the_layout(spark):
    rows = [(i % 90 if i % 3 else None, f"text {i % 40}" * (i % 13), "abc"[i % 3]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, many = (sorted(kd_shards.kd_shards(d, n_shards=5).drop("slot").collect(), key=str) for d in (docs.coalesce(1), docs.repartition(23)))
    assert one == many


def test_shards_against_a_tree_of_sorted_rows(spark):
    """Every cut is where the sorted rows of the cell reach its share."""
    rnd = random.Random(3)
    rows = [(i if rnd.random() < 0.9 else None, "w" * int(rnd.paretovariate(0.8)), rnd.choice(["a", "b", "c", None])) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    scale = (1 << 31) - 1
    raw = kd_shards._ordered(kd_shards.described(docs).withColumn("stretch", F.lit(0)), "kd-test").collect()
    dims = [f"d{i}" for i in range(3)]
    lo, hi = ({d: f(r[d] for r in raw) for d in dims} for f in (min, max))
    at = [tuple(int((r[d] - lo[d]) / (hi[d] - lo[d]) * scale // 1) for d in dims) for r in raw]
    cells = [(list(range(len(raw))), 6)]
    while any(due > 1 for _, due in cells):
        after = []
        for cell, due in cells:
            if due == 1:
                after.append((cell, due))
                continue
            wide = [max(at[i][d] for i in cell) - min(at[i][d] for i in cell) for d in range(3)]
            axis = wide.index(max(wide))
            order = sorted(cell, key=lambda i: (at[i][axis], raw[i]["tie"]))
            share, upto, cut = sum(raw[i]["size"] for i in cell) * (due // 2) / due, 0, 0
            while upto + raw[order[cut]]["size"] < share:
                upto += raw[order[cut]]["size"]
                cut += 1
            cut += share - upto > upto + raw[order[cut]]["size"] - share
            after += [(order[:cut], due // 2), (order[cut:], due - due // 2)]
        cells = after
    want = sorted((str(raw[i]["doc_id"]), raw[i]["size"], k) for k, (cell, _) in enumerate(cells) for i in cell)
    got = sorted((str(r["doc_id"]), r["size"], r["shard"]) for r in kd_shards.kd_shards(docs, n_shards=6).collect())
    assert got == want
