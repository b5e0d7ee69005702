"""The ETL as one Structured Streaming query with ``foreachBatch``.

Source: a landing folder of raw files (file source; its offset log is the
"watermark" of processed input, fixed before a micro-batch runs, so a retry
replays exactly the same files). Per micro-batch ``N``:

1. stage the batch: one read of the source writes it to
   ``<lake>/_staging``, and the run report is observed on that write; all that
   follows works on the staged rows, so what is counted is what is processed,
2. split on critical nulls; bad rows (with the reason) -> ``dlq/batch_id=N``,
3. encode, per-group context (over the batch, or cumulative over the lake
   with ``context_scope="lake"``), contract projection,
4. lake write: static overwrite of ``lake/batch_id=N`` (retry-safe),
5. read this batch back from the lake (``country`` rebuilt from the path,
   partition-pruned to batch N) and publish it as JSON to the topic,
6. delete the staged rows and return: only now does Spark write the commit
   log entry for ``N``.

A failure anywhere before 6 re-runs batch N on restart: the DLQ and lake
folders of N are replaced, the topic may receive N again (at-least-once).
With ``max_files_per_trigger`` unset, everything pending is one batch and
the group means are over all of it; with a cap they are per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    DateType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from ratelake.contract import CONTRACT_COLUMNS, CONTRACT_SCHEMA, CRITICAL_COLUMNS, NUMERIC_COLUMNS, require_columns
from ratelake.functions.wire import encode_json
from ratelake.operators.context import group_stats, merge_stats
from ratelake.operators.quality import audit_metrics, split
from ratelake.plans.venue import transform_good
from ratelake.session import delete_path, require_version
from ratelake.sources.ingest import CORRUPT_COLUMN, header_fields
from ratelake.sources.lake import batch_path, read_lake, write_batch, write_dlq
from ratelake.sources.topic import TopicSpec, publish
from ratelake.streaming.consumer import drain, with_trigger


def stage(batch: DataFrame, path: str, metrics: Sequence[Column], drop: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    """Write ``batch`` (without the columns ``drop``) to ``path``: the one
    read of its source. Returns the written rows and the ``metrics`` observed
    on the way; the write has no shuffle, so every row counts once, lost
    executors or not."""
    seen = Observation()
    out = batch.observe(seen, *metrics).drop(*drop)
    out.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema(out.schema).parquet(path), seen.get


def make_batch_processor(
    spark: SparkSession,
    lake: str,
    dlq: str,
    topic: TopicSpec,
    critical: Sequence[str] = CRITICAL_COLUMNS,
    numeric: Sequence[str] = NUMERIC_COLUMNS,
    context_keys: Sequence[str] = ("city",),
    context_strategy: str = "aggregate",
    context_scope: str = "batch",
    corrupt_column: str | None = None,
    after_lake_write: Callable[[int], None] | None = None,
    audit: str | None = None,
) -> Callable[..., dict]:
    """The ``foreachBatch`` body. ``after_lake_write`` is a hook called
    between the lake write and the publish (tests inject failures there).

    ``context_scope="batch"``: group means over the micro-batch (the
    reference's behaviour with a per-run cap). ``"lake"``: means over every
    row ingested so far, from a cumulative ``(keys, sum, n)`` table kept under
    ``<lake>/_group_stats/batch_id=N`` (a retry of N rebuilds it from N-1).
    Rows written by earlier batches keep the mean of their time.

    ``audit`` (a folder) receives ``batch_id=N`` with the batch's row counts
    (total, good, bad, nulls per critical column), observed while the batch
    is staged: the run report as a table. The body returns the observed
    counts, ``metrics`` included."""
    keys = list(context_keys)
    stats_root = f"{lake.rstrip('/')}/_group_stats"

    def cumulative_stats(batch_id: int):
        def build(enc: DataFrame) -> DataFrame:
            cur = group_stats(enc, "avg_rating", keys)
            prev_path = batch_path(stats_root, batch_id - 1)
            if batch_id > 0:
                require_version(spark, prev_path)
                cur = merge_stats(cur, spark.read.parquet(prev_path), keys)
            cur.write.mode("overwrite").parquet(batch_path(stats_root, batch_id))
            # a retry of this batch needs only version N-1: older ones can go
            if batch_id >= 2:
                delete_path(spark, batch_path(stats_root, batch_id - 2))
            return spark.read.parquet(batch_path(stats_root, batch_id))

        return build

    def process(batch: DataFrame, batch_id: int, metrics: Sequence[Column] = (), drop: Sequence[str] = ()) -> dict:
        staging = batch_path(f"{lake.rstrip('/')}/_staging", batch_id)
        report = audit_metrics(critical)
        rows, seen = stage(batch, staging, [*report, *metrics], drop)
        if audit:
            names = [n for n in seen if n.startswith("n_")]
            line = spark.createDataFrame([tuple(seen[n] for n in names)], ", ".join(f"`{n}` long" for n in names))
            line.coalesce(1).write.mode("overwrite").parquet(batch_path(audit, batch_id))
        # values the contract's int columns cannot hold are bad rows, not nulls
        ints = [f.name for f in CONTRACT_SCHEMA.fields if isinstance(f.dataType, IntegerType) and f.name in rows.columns]
        good, bad = split(
            rows, critical, with_reason=True, corrupt_column=corrupt_column, integers=ints
        )
        write_dlq(bad, dlq, batch_id)
        stats_fn = cumulative_stats(batch_id) if context_scope == "lake" else None
        out = transform_good(
            good, numeric, keys, context_strategy, context_stats=stats_fn
        )
        write_batch(out, lake, batch_id)
        if after_lake_write is not None:
            after_lake_write(batch_id)
        back = read_lake(spark, lake, batch_id=batch_id)
        require_columns(back, ["country"])
        publish(encode_json(back.select(*CONTRACT_COLUMNS)), topic)
        # a failed run leaves its staged rows; the retry writes them anew
        delete_path(spark, staging)
        return seen

    return process


def run_etl_stream(
    spark: SparkSession,
    source_path: str,
    source_schema: StructType,
    lake: str,
    dlq: str,
    topic: TopicSpec,
    checkpoint: str,
    source_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    trigger: str = "availableNow",
    timeout_s: float | None = None,
    malformed_to_dlq: bool = False,
    max_bytes_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
    multi_line: bool = False,
    **processor_options,
) -> StreamingQuery:
    """Start (and for ``availableNow`` wait for) the ETL query.

    ``source_format="csv"`` reads the landing files with the declared schema
    in PERMISSIVE mode (a bad cell reads as null, the run goes on); with
    ``malformed_to_dlq`` the raw line is kept and such rows go to the DLQ.
    Columns are found by header name as in ``read_csv_tolerant``: in any order
    and among others, as the files present at the start have them (without
    files, as declared); a missing
    column raises, and so does a file with another header. ``multi_line``
    allows line breaks in quoted cells.

    ``clean_source`` (``"archive"`` with ``archive_dir``, or ``"delete"``)
    moves landing files out once their batch is committed, so the listing
    the file source does on every trigger stays small on a long-running
    ingestion."""
    schema = source_schema
    names = [f.name for f in source_schema.fields]
    r = spark.readStream.format(source_format)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        # size-bounded micro-batches (at least one file each)
        r = r.option("maxBytesPerTrigger", str(int(max_bytes_per_trigger)))
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    if source_format == "csv":
        r = r.option("header", "true").option("mode", "PERMISSIVE").option("escape", '"')
        r = r.option("enforceSchema", "false").option("multiLine", str(multi_line).lower())
        try:
            schema = StructType(header_fields(spark, source_path, source_schema, multi_line))
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # no files yet: the declared columns
                raise
        if malformed_to_dlq:
            schema = StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType(), True)])
            names.append(CORRUPT_COLUMN)
            r = r.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            processor_options.setdefault("corrupt_column", CORRUPT_COLUMN)
    stream = r.schema(schema).load(source_path).select(*[F.col(f"`{c}`") for c in names])
    body = make_batch_processor(spark, lake, dlq, topic, **processor_options)
    w = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    q = with_trigger(w, trigger).start()
    if trigger == "availableNow":
        drain(q, timeout_s, "ETL stream")
    return q


#: DLQ batch of the rows without a key
NULL_KEY_BATCH = -1


def run_etl_increment(
    spark: SparkSession,
    source: DataFrame,
    key: str,
    lake: str,
    dlq: str,
    topic: TopicSpec,
    state: str,
    cap: int = 0,
    ingested: str | None = None,
    **processor_options,
) -> int | None:
    """One run of the ETL as a scheduled batch job (the streaming form's
    twin for sources that are tables rather than landing files).

    The committed progress is ``<state>/commits/<N>.json`` (the last key of
    batch N), created after the batch's writes and never replaced, like a
    streaming offset log. A run takes the next slice - rows with ``key``
    greater than the last committed key, in key order, at most ``cap`` rows
    (``cap = 0``: everything pending) - processes it as batch N+1 with the
    same body as the stream (DLQ, lake, publish) and only then commits. A
    failed run leaves no commit, so the next run repeats the same slice
    under the same batch id and replaces its lake and DLQ folders. Returns
    the batch id, or None when there was nothing new. The slice is read once,
    and the committed count is that of the rows staged for the writes.

    ``key`` must be unique and grow with new data (an id or an ingestion
    time). Times are compared and stored as integers (microseconds or days),
    computed inside Spark, so no time zone of a driver takes part. Rows with a
    null key have no place in the order: all of them are in the DLQ under
    ``batch_id = NULL_KEY_BATCH`` with reason ``null_key``, renewed by every
    run. A row that arrives late, with a key at or below the committed one,
    raises: it would never be taken.

    ``ingested`` names a column that grows with every load of the source (a
    load time or number, or ``_metadata.file_modification_time`` of a source of
    files that are never rewritten): late rows are then looked for only among
    what was loaded after the committed rows, whose files alone are read.
    Without it the rows up to the committed key are counted again.
    """
    import json

    from ratelake.operators.quality import REASON
    from ratelake.session import list_markers, read_marker, write_marker
    from ratelake.sources.ingest import order_value, slice_boundary

    place = order_value(source, key)
    kind = source.select(place).schema[0].dataType
    if source.schema[key].nullable:
        lost = source.filter(F.col(key).isNull()).withColumn(REASON, F.array(F.lit("null_key")))
        if not lost.isEmpty():
            write_dlq(lost, dlq, NULL_KEY_BATCH)
    metrics, drop = [], []
    if ingested:
        source = source.select("*", F.col(ingested).alias(_LOADED))
        loaded = order_value(source, _LOADED)
        metrics, drop = [F.max(loaded).alias(_LOADED)], [_LOADED]
    commits = f"{state.rstrip('/')}/commits"
    done = list_markers(spark, commits)
    after, batch_id, before, mark = None, 0, 0, None
    if done:
        commit = json.loads(read_marker(spark, f"{commits}/{done[-1]}"))
        after = F.lit(commit["last_key"]).cast(kind)
        batch_id, before, mark = int(commit["batch_id"]) + 1, commit.get("rows"), commit.get("ingested")
        late = 0
        if ingested and mark is not None:
            late = source.filter((place <= after) & (F.col(_LOADED) > _as_loaded(source, mark))).count()
        elif before is not None:
            late = source.filter(place <= after).count() - before
        if late > 0:
            raise ValueError(f"{late} rows of the source came late, with keys up to the committed {commit['last_key']}")

    pending = source if after is None else source.filter(place > after)
    keys = pending.select(place.alias("key"))
    last = slice_boundary(keys, "key", None, cap) if cap and cap > 0 else keys.agg(F.max("key")).first()[0]
    if last is None:
        return None  # no new data: nothing written, nothing committed
    text = last if isinstance(last, (int, float, str)) else str(last)
    batch = pending.filter(place <= F.lit(text).cast(kind))
    seen = make_batch_processor(spark, lake, dlq, topic, **processor_options)(batch, batch_id, metrics, drop)
    newest = max((m for m in (mark, seen.get(_LOADED)) if m is not None), default=None)
    marker = {"batch_id": batch_id, "last_key": text, "rows": None if before is None else before + seen["n_rows"], "ingested": newest}
    write_marker(spark, f"{commits}/{batch_id:020d}.json", json.dumps(marker))
    return batch_id


#: the load time or number of a row while its slice is staged
_LOADED = "_loaded"


def _as_loaded(source: DataFrame, mark: int | float | str) -> Column:
    """A committed load mark in the type of the column, so that the filter
    reaches the scan."""
    kind = source.schema[_LOADED].dataType
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(F.lit(mark))
    if isinstance(kind, TimestampNTZType):
        return F.timestamp_micros(F.lit(mark)).cast("timestamp_ntz")
    if isinstance(kind, DateType):
        return F.date_from_unix_date(F.lit(mark))
    return F.lit(mark).cast(kind)
