"""One staged slice for work and count, late rows, and batches that are
swapped in only once they are written."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ratelake.contract import CRITICAL_COLUMNS
from ratelake.operators.quality import batch_audit
from ratelake.plans.venue import venue_pipeline, venue_rows
from ratelake.session import list_folders, list_markers, path_exists, read_marker
from ratelake.sources.lake import batch_path, read_dlq, read_lake, write_batch, write_batches, write_dlq, write_dlq_batches
from ratelake.sources.topic import TopicSpec
from ratelake.streaming.etl import run_etl_increment


def _args(spark, source, root):
    return (spark, source, "venue_id", f"{root}/lake", f"{root}/dlq", TopicSpec(kind="files", path=f"{root}/topic"), f"{root}/state")


def _fresh(spark, root):
    return spark.read.parquet(f"{root}/source")


@pytest.mark.parametrize("ingested", [None, "_metadata.file_modification_time", "load_no"])
def test_rows_that_arrive_during_a_run_raise_in_the_next(spark, tmp_shared, ingested):
    raw = venue_rows(spark, SF001).withColumn("load_no", F.lit(1))
    ids = [r[0] for r in raw.select("venue_id").orderBy("venue_id").collect()]
    raw.where(F.col("venue_id") > ids[14]).write.parquet(f"{tmp_shared}/source")

    def arrive(batch_id):  # fifteen rows with smaller keys, after the slice was taken
        late = raw.where(F.col("venue_id") <= ids[14]).withColumn("load_no", F.lit(2))
        late.write.mode("append").parquet(f"{tmp_shared}/source")
        spark.catalog.refreshByPath(f"{tmp_shared}/source")

    args = _args(spark, _fresh(spark, tmp_shared), tmp_shared)
    assert run_etl_increment(*args, ingested=ingested, after_lake_write=arrive) == 0
    name = list_markers(spark, f"{tmp_shared}/state/commits")[-1]
    taken = len(ids) - 15
    assert json.loads(read_marker(spark, f"{tmp_shared}/state/commits/{name}"))["rows"] == taken
    assert read_lake(spark, f"{tmp_shared}/lake").count() + read_dlq(spark, f"{tmp_shared}/dlq").count() == taken
    with pytest.raises(ValueError, match="15 rows of the source came late"):
        run_etl_increment(*_args(spark, _fresh(spark, tmp_shared), tmp_shared), ingested=ingested)


def test_late_rows_are_looked_for_in_new_files_only(spark, tmp_shared):
    raw = venue_rows(spark, SF001)
    raw.write.parquet(f"{tmp_shared}/source")
    args = _args(spark, _fresh(spark, tmp_shared), tmp_shared)
    kw = {"cap": 60, "ingested": "_metadata.file_modification_time"}
    done = []
    while (n := run_etl_increment(*args, **kw)) is not None:
        done.append(n)
    assert done == [0, 1, 2]
    more = raw.withColumn("venue_id", F.col("venue_id") + 10_000)
    more.write.mode("append").parquet(f"{tmp_shared}/source")
    args = _args(spark, _fresh(spark, tmp_shared), tmp_shared)
    while (n := run_etl_increment(*args, **kw)) is not None:
        done.append(n)
    assert done == [0, 1, 2, 3, 4, 5]
    rows = read_lake(spark, f"{tmp_shared}/lake").count() + read_dlq(spark, f"{tmp_shared}/dlq").count()
    assert rows == 2 * raw.count()


def test_the_report_is_that_of_the_staged_rows(spark, tmp_shared):
    raw = venue_rows(spark, SF001)
    raw.write.parquet(f"{tmp_shared}/source")
    run_etl_increment(*_args(spark, _fresh(spark, tmp_shared), tmp_shared), audit=f"{tmp_shared}/audit")
    got = spark.read.parquet(f"{tmp_shared}/audit/batch_id=0").first().asDict()
    assert got == batch_audit(raw, CRITICAL_COLUMNS).first().asDict()
    # nothing staged is left
    assert list_folders(spark, f"{tmp_shared}/lake/_staging", "batch_id=") == []


def _failing(df):
    """Writes some rows, then fails."""
    boom = F.when(F.col("total_reviews_count") == F.lit(-1), F.lit(0)).otherwise(F.raise_error(F.lit("injected")).cast("int"))
    return df.withColumn("is_claimed", boom)


def test_a_failed_retry_leaves_the_first_attempt(spark, tmp_shared):
    rows = venue_pipeline(venue_rows(spark, SF001))
    lake, dlq = f"{tmp_shared}/lake", f"{tmp_shared}/dlq"
    write_batch(rows, lake, 0)
    write_dlq(rows, dlq, 0)
    n = rows.count()
    for write, root in ((write_batch, lake), (write_dlq, dlq)):
        with pytest.raises(Exception):
            write(_failing(rows), root, 0)
    assert read_lake(spark, lake).count() == read_dlq(spark, dlq).count() == n
    with pytest.raises(Exception):
        write_batches(_failing(rows).withColumn("batch_id", F.lit(0)), lake)
    with pytest.raises(Exception):
        write_dlq_batches(_failing(rows).withColumn("batch_id", F.lit(0)), dlq)
    assert read_lake(spark, lake).count() == read_dlq(spark, dlq).count() == n
    # a retry that ends replaces the batch in every country
    write_batch(rows.limit(3), lake, 0)
    assert read_lake(spark, lake).count() == 3
    assert list_folders(spark, f"{lake}/_attempts", "") == []


def test_many_batches_swap_one_by_one(spark, tmp_shared):
    rows = venue_pipeline(venue_rows(spark, SF001)).withColumn("batch_id", F.pmod(F.hash("restaurant_name"), F.lit(3)))
    lake = f"{tmp_shared}/lake"
    write_batches(rows, lake)
    whole = read_lake(spark, lake).count()
    second = rows.where("batch_id = 2")
    write_batches(second.limit(2), lake, retried=[1])
    assert not path_exists(spark, batch_path(lake, 1))
    assert read_lake(spark, lake).count() == rows.where("batch_id = 0").count() + 2 < whole
    # no row at all: only the batches named go
    write_batches(rows.where("false"), lake, retried=[2])
    assert read_lake(spark, lake).count() == rows.where("batch_id = 0").count()
    write_batches(rows.where("false"), f"{tmp_shared}/empty")
    assert read_lake(spark, f"{tmp_shared}/empty").count() == 0
