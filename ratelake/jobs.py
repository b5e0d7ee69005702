"""Job entry points (``spark-submit -m``-style): ETL, consumer, training.

    python -m ratelake.jobs etl --landing L --lake K --dlq D --topic T --checkpoint C
    python -m ratelake.jobs consume --topic T --out O [--fused]
    python -m ratelake.jobs train --lake K [--models lr rf]
    python -m ratelake.jobs profile --input RAW [--column avg_rating --by price_level]

Paths are Hadoop paths (``file:``, ``hdfs:``, object stores). The session is
taken from ``spark-submit`` (master, memory, ``spark.checkpoint.dir``); only
the settings this library relies on are added.
"""

from __future__ import annotations

import argparse
import sys

from ratelake.contract import CONTRACT_COLUMNS, HISTOGRAM_BINS
from ratelake.session import build_session
from ratelake.sources.topic import TopicSpec


def _topic(a) -> TopicSpec:
    if a.kafka_servers:
        return TopicSpec(kind="kafka", bootstrap_servers=a.kafka_servers, topic=a.topic)
    return TopicSpec(kind="files", path=a.topic)


def _add_topic(p: argparse.ArgumentParser) -> None:
    p.add_argument("--topic", required=True, help="topic name (Kafka) or JSON-lines folder")
    p.add_argument("--kafka-servers", default=None, help="bootstrap servers; omit for the folder topic")


def _landing_schema(spark, a):
    """Declared schema (``--schema`` DDL) first; Parquet carries its own;
    for CSV without one, infer once from a sample (discovery only)."""
    from pyspark.sql.types import StructType

    from ratelake.sources.ingest import infer_csv_schema

    if a.schema:
        return StructType.fromDDL(a.schema)
    if a.format == "parquet":
        return spark.read.parquet(a.landing).schema
    return infer_csv_schema(spark, a.landing)


def cmd_etl(spark, a) -> None:
    from ratelake.streaming.etl import run_etl_stream

    run_etl_stream(
        spark, a.landing, _landing_schema(spark, a), a.lake, a.dlq, _topic(a), a.checkpoint,
        source_format=a.format, max_files_per_trigger=a.max_files_per_trigger,
        max_bytes_per_trigger=a.max_bytes_per_trigger,
        trigger=a.trigger, context_scope=a.context_scope, malformed_to_dlq=a.malformed_to_dlq,
        audit=a.audit,
    )


def cmd_consume(spark, a) -> None:
    from ratelake.streaming.consumer import run_consumer, run_consumer_fused

    if a.fused:
        run_consumer_fused(spark, _topic(a), a.out, trigger=a.trigger)
    else:
        run_consumer(spark, _topic(a), a.out, trigger=a.trigger)


def cmd_train(spark, a) -> None:
    from ratelake.contract import FEATURE_COLUMNS
    from ratelake.operators.model import forest_importances, linear_coefficients, train_and_compare
    from ratelake.sources.lake import read_lake

    lake = read_lake(spark, a.lake).select(*CONTRACT_COLUMNS)
    res = train_and_compare(spark, lake, models=a.models, num_partitions=a.partitions)
    for name, model in res["models"].items():
        if name == "linear_regression":
            linear_coefficients(spark, model, FEATURE_COLUMNS).show(truncate=False)
        else:
            forest_importances(spark, model, FEATURE_COLUMNS).show(truncate=False)
        if a.save:
            model.write().overwrite().save(f"{a.save.rstrip('/')}/{name}")
    res["comparison"].show(truncate=False)


def cmd_profile(spark, a) -> None:
    from ratelake.operators.profile import boxplot_stats, corr_matrix, describe_column, histogram
    from ratelake.plans.q_profile import EDA_COLUMNS, eda_frame

    r = spark.read.option("header", "true")
    if a.schema:
        from pyspark.sql.types import StructType

        r = r.schema(StructType.fromDDL(a.schema))
    elif a.format == "csv":
        r = r.option("inferSchema", "true")
    raw = r.format(a.format).load(a.input)
    describe_column(raw, a.column, approx_accuracy=a.approx_accuracy).show(truncate=False)
    histogram(raw, a.column, a.bins).show(truncate=False)
    boxplot_stats(raw, a.column, a.by, approx_accuracy=a.approx_accuracy).show(truncate=False)
    corr_matrix(eda_frame(raw), EDA_COLUMNS).show(50, truncate=False)


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="ratelake.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)

    e = sub.add_parser("etl", help="landing files -> DLQ + lake + topic (one stream)")
    e.add_argument("--landing", required=True)
    e.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    e.add_argument("--schema", default=None, help="DDL of the landing rows (CSV: inferred once if omitted)")
    e.add_argument("--lake", required=True)
    e.add_argument("--dlq", required=True)
    e.add_argument("--checkpoint", required=True)
    e.add_argument("--max-files-per-trigger", type=int, default=None)
    e.add_argument("--max-bytes-per-trigger", type=int, default=None,
                   help="bound each micro-batch by input bytes (at least one file)")
    e.add_argument("--trigger", default="availableNow")
    e.add_argument("--context-scope", default="batch", choices=["batch", "lake"])
    e.add_argument("--malformed-to-dlq", action="store_true")
    e.add_argument("--audit", default=None, help="folder for per-batch row counts")
    _add_topic(e)

    c = sub.add_parser("consume", help="topic -> audit, filtered CSV, running counts")
    c.add_argument("--out", required=True)
    c.add_argument("--fused", action="store_true", help="one topic read for all three outputs")
    c.add_argument("--trigger", default=None, help="availableNow, or a processing-time interval")
    _add_topic(c)

    t = sub.add_parser("train", help="lake -> LR / RF, metrics, comparison")
    t.add_argument("--lake", required=True)
    t.add_argument("--models", nargs="+", default=["lr", "rf"], choices=["lr", "rf"])
    t.add_argument("--save", default=None, help="folder to save the fitted models")
    t.add_argument("--partitions", type=int, default=None,
                   help="fixed training layout (reproducible forests across session settings)")

    f = sub.add_parser("profile", help="raw rows -> describe, histogram, box plot, correlation")
    f.add_argument("--input", required=True)
    f.add_argument("--format", default="csv", choices=["parquet", "csv"])
    f.add_argument("--schema", default=None, help="DDL of the rows (CSV: inferred if omitted)")
    f.add_argument("--column", default="avg_rating")
    f.add_argument("--by", default="price_level")
    f.add_argument("--bins", type=int, default=HISTOGRAM_BINS)
    f.add_argument("--approx-accuracy", type=int, default=None,
                   help="percentile_approx quartiles (one pass) instead of exact ones")
    return ap


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = build_session(app_name=f"ratelake-{a.cmd}")
    {"etl": cmd_etl, "consume": cmd_consume, "train": cmd_train, "profile": cmd_profile}[a.cmd](spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
