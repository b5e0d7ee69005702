"""Smoke test of the job entry points: ETL -> consumer -> training."""

from __future__ import annotations

from conftest import SF001
from ratelake import jobs
from ratelake.plans.venue import venue_rows
from ratelake.sources.lake import read_lake
from ratelake.streaming.consumer import latest_counts


def test_jobs_end_to_end(spark, tmp_shared, capsys):
    raw = venue_rows(spark, SF001)
    raw.write.mode("overwrite").option("header", "true").csv(f"{tmp_shared}/landing")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in raw.schema)
    jobs.main([
        "etl", "--landing", f"{tmp_shared}/landing", "--format", "csv", "--schema", ddl,
        "--lake", f"{tmp_shared}/lake", "--dlq", f"{tmp_shared}/dlq",
        "--checkpoint", f"{tmp_shared}/ck", "--topic", f"{tmp_shared}/topic",
    ])
    assert read_lake(spark, f"{tmp_shared}/lake").count() == 147
    jobs.main(["consume", "--topic", f"{tmp_shared}/topic", "--out", f"{tmp_shared}/out",
               "--fused", "--trigger", "availableNow"])
    assert sum(r["count"] for r in latest_counts(spark, f"{tmp_shared}/out").collect()) == 147
    # the three separate queries, as the reference runs them
    jobs.main(["consume", "--topic", f"{tmp_shared}/topic", "--out", f"{tmp_shared}/out3",
               "--trigger", "availableNow"])
    from ratelake.streaming.consumer import ConsumerPaths, latest_snapshot

    snap = latest_snapshot(spark, ConsumerPaths(f"{tmp_shared}/out3").counts)
    assert sum(r["count"] for r in snap.collect()) == 147
    jobs.main(["train", "--lake", f"{tmp_shared}/lake", "--save", f"{tmp_shared}/models", "--partitions", "4"])
    out = capsys.readouterr().out
    assert "linear_regression" in out and "random_forest" in out and "is_best" in out


def test_profile_job(spark, tmp_shared, capsys):
    raw = venue_rows(spark, SF001)
    raw.write.mode("overwrite").parquet(f"{tmp_shared}/raw")
    jobs.main(["profile", "--input", f"{tmp_shared}/raw", "--format", "parquet"])
    out = capsys.readouterr().out
    for word in ("null_count", "bin_lo", "whisker_lo", "col_a"):
        assert word in out
