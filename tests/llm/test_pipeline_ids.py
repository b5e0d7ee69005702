"""Pipeline stages on rows that share an id, or have none."""

from __future__ import annotations

import corpus_pipeline

SCHEMA = "doc_id long, text string, uid string, class_id int"


def _words(tag, n=80):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_near_duplicates_of_rows_that_share_an_id(spark, tmp_shared):
    near = _words("a") + " more"
    rows = [
        (1, _words("a"), "x", 1),
        (2, _words("b"), "x", 2),
        (1, _words("b") + " more", "x", 3),  # a near copy of id 2, under an id that leads another class
        (3, near, "x", 4),
        (None, near, "x", 5),
        (None, _words("c"), "x", 6),
        (None, _words("c"), "y", 7),
        (4, _words("d"), "x", 8),
        (4, _words("d"), "x", 9),
    ]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), tmp_shared)
    kept = [(r.doc_id, r.text.split()[0][0]) for r in out.collect()]
    assert out.columns == ["doc_id", "text", "uid", "class_id"]
    assert sorted(kept, key=str) == sorted([(1, "a"), (1, "b"), (None, "c"), (4, "d")], key=str)


def test_decontamination_judges_each_text(spark, tmp_shared):
    item = _words("q", 40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_shared}/benchmark.parquet")
    rows = [(7, _words("a") + " " + item, "x", 1), (7, _words("a"), "x", 2), (None, item, "x", 3), (None, _words("b"), "x", 4), (8, _words("c"), "x", 5)]
    out = corpus_pipeline.decontaminate(spark, spark.createDataFrame(rows, SCHEMA), tmp_shared)
    assert sorted(r.class_id for r in out.collect()) == [2, 4, 5]
