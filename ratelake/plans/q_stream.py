"""Registered wire and streaming queries.

Streaming queries run with ``availableNow`` over a topic folder written from
the test tables, wait for completion and return the sink's files read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from ratelake.contract import CONTRACT_COLUMNS, CONTRACT_SCHEMA, CRITICAL_COLUMNS
from ratelake.functions.wire import encode_json, parse_json, to_json_value
from ratelake.plans.registry import (
    PIPELINE_CTE,
    VENUE_CTE,
    batches_cte,
    pipeline_cte,
    _CONTRACT_ROUNDED_SQL,
    register,
    rnd,
    round_contract,
    sql_rnd,
)
from ratelake.operators.model import VENUE_KEY, fit_linear, hash_split, training_rows
from ratelake.plans.venue import venue_pipeline, venue_rows
from ratelake.session import materialize, shared_path
from ratelake.sources.lake import read_dlq, read_lake
from ratelake.sources.tables import table
from ratelake.sources.topic import TopicSpec, publish, read_topic
from ratelake.streaming.consumer import (
    ConsumerPaths,
    dedup,
    drain,
    latest_counts,
    latest_snapshot,
    parsed_stream,
    rocksdb_state,
    run_consumer,
    run_consumer_fused,
    start_count,
    start_filter_append,
    start_raw_audit,
)
from ratelake.streaming.etl import run_etl_increment, run_etl_stream
from ratelake.streaming.inference import score_stream, start_scoring
from ratelake.streaming.known_keys import run_dedup_lake
from ratelake.streaming.replay import replay
from ratelake.streaming.state import STATE, ProgressReport, idle_totals, observed, state_table, stop_after
from ratelake.operators.quality import audit_metrics

EVENTS_SCHEMA = StructType(
    [
        StructField("event_id", LongType(), True),
        StructField("ts", TimestampNTZType(), True),
        StructField("user_id", LongType(), True),
        StructField("event_type", StringType(), True),
        StructField("value", DoubleType(), True),
        StructField("props", StringType(), True),
    ]
)
PROPS_SCHEMA = StructType([StructField("k", LongType(), True)])

_PIPELINE_SQL = f"WITH {PIPELINE_CTE} SELECT {_CONTRACT_ROUNDED_SQL} FROM pipeline"
TOPIC_WRITES = 4  # the topic is published in several goes -> several micro-batches


def _contract_topic(spark: SparkSession, sf_dir: str, name: str) -> TopicSpec:
    spec = TopicSpec(kind="files", path=shared_path(spark, name))
    rows = materialize(encode_json(venue_pipeline(venue_rows(spark, sf_dir))), f"{name}-rows")
    for k in range(TOPIC_WRITES):  # each go writes as many files as its size asks for
        publish(rows.filter(F.pmod(F.xxhash64("value"), F.lit(TOPIC_WRITES)) == k), spec)
    return spec


def _await(q) -> None:
    drain(q)


# --------------------------------------------------------------------------
# wire
# --------------------------------------------------------------------------


@register(
    "json_encode",
    f"""WITH {PIPELINE_CTE}, j AS (SELECT to_json(pipeline) AS v FROM pipeline)
    SELECT CAST(json_extract_string(v, '$.restaurant_name') AS VARCHAR) AS restaurant_name,
      json_extract_string(v, '$.country') AS country,
      CAST(json_extract(v, '$.total_reviews_count') AS INTEGER) AS total_reviews_count,
      CAST(json_extract(v, '$.is_gluten_free') AS INTEGER) AS is_gluten_free,
      CAST(json_extract(v, '$.avg_rating') AS DOUBLE) AS avg_rating
    FROM j""",
)
def q_json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode contract rows as JSON text, then read fields back out of the
    text with path extraction (compares parsed fields, not JSON layout)."""
    enc = encode_json(venue_pipeline(venue_rows(spark, sf_dir)))
    v = F.col("value")
    return enc.select(
        F.get_json_object(v, "$.restaurant_name").alias("restaurant_name"),
        F.get_json_object(v, "$.country").alias("country"),
        F.get_json_object(v, "$.total_reviews_count").cast("int").alias("total_reviews_count"),
        F.get_json_object(v, "$.is_gluten_free").cast("int").alias("is_gluten_free"),
        F.get_json_object(v, "$.avg_rating").cast("double").alias("avg_rating"),
    )


@register(
    "json_parse",
    """SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def q_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return ev.select(
        "event_id", "event_type", F.from_json("props", PROPS_SCHEMA).getField("k").alias("k")
    )


@register("publish_topic", _PIPELINE_SQL)
def q_publish_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _contract_topic(spark, sf_dir, "topic_publish")
    return round_contract(parse_json(read_topic(spark, spec)))


# --------------------------------------------------------------------------
# streaming consumer
# --------------------------------------------------------------------------


@register(
    "stream_parse",
    "SELECT event_id, ts, user_id, event_type, value, props FROM events",
)
def q_stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_path(spark, "stream_parse")
    spec = TopicSpec(kind="files", path=f"{root}/topic")
    ev = table(spark, sf_dir, "events")
    publish(ev.select(to_json_value(ev.columns).alias("value")), spec)
    parsed = parsed_stream(spark, spec, EVENTS_SCHEMA, max_per_trigger=1)
    _await(start_raw_audit(parsed, f"{root}/out", f"{root}/_ckpt"))
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{root}/out")


@register("stream_raw_audit", _PIPELINE_SQL)
def q_stream_raw_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _contract_topic(spark, sf_dir, "topic_audit")
    root = shared_path(spark, "stream_audit")
    parsed = parsed_stream(spark, spec, max_per_trigger=1)
    _await(start_raw_audit(parsed, f"{root}/out", f"{root}/_ckpt"))
    return round_contract(spark.read.schema(CONTRACT_SCHEMA).parquet(f"{root}/out"))


@register(
    "stream_filter_append",
    f"WITH {PIPELINE_CTE} SELECT {_CONTRACT_ROUNDED_SQL} FROM pipeline "
    "WHERE is_gluten_free = 1 AND avg_rating >= 4.5",
)
def q_stream_filter_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _contract_topic(spark, sf_dir, "topic_niche")
    root = shared_path(spark, "stream_niche")
    parsed = parsed_stream(spark, spec, max_per_trigger=1)
    _await(start_filter_append(parsed, f"{root}/out", f"{root}/_ckpt"))
    return round_contract(spark.read.schema(CONTRACT_SCHEMA).csv(f"{root}/out"))


@register(
    "stream_count_complete",
    f"WITH {PIPELINE_CTE} SELECT country, CAST(COUNT(*) AS BIGINT) AS count FROM pipeline GROUP BY country",
)
def q_stream_count_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _contract_topic(spark, sf_dir, "topic_count")
    root = shared_path(spark, "stream_count")
    parsed = parsed_stream(spark, spec, max_per_trigger=1)
    _await(start_count(parsed, f"{root}/_ckpt", snapshot_path=f"{root}/snapshot"))
    return latest_snapshot(spark, f"{root}/snapshot")


@register(
    "stream_consumer_fused",
    f"WITH {PIPELINE_CTE} SELECT country, CAST(COUNT(*) AS BIGINT) AS count FROM pipeline GROUP BY country",
)
def q_stream_consumer_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts from the single-pass consumer (one topic read for the
    audit, filter and count outputs)."""
    spec = _contract_topic(spark, sf_dir, "topic_fused")
    root = shared_path(spark, "stream_fused")
    run_consumer_fused(spark, spec, root, max_per_trigger=1)
    return latest_counts(spark, root)


@register(
    "stream_count_update",
    f"WITH {PIPELINE_CTE} SELECT country, CAST(COUNT(*) AS BIGINT) AS count FROM pipeline GROUP BY country",
)
def q_stream_count_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running count in update mode: each micro-batch emits only the
    countries it changed, merged over the previous snapshot version."""
    spec = _contract_topic(spark, sf_dir, "topic_count_update")
    root = shared_path(spark, "stream_count_update")
    parsed = parsed_stream(spark, spec, max_per_trigger=1)
    _await(start_count(parsed, f"{root}/_ckpt", mode="update", snapshot_path=f"{root}/snapshot"))
    return latest_snapshot(spark, f"{root}/snapshot")


@register(
    "stream_consumer",
    f"WITH {PIPELINE_CTE} SELECT country, CAST(COUNT(*) AS BIGINT) AS count FROM pipeline GROUP BY country",
)
def q_stream_consumer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three consumer queries started together on one topic in one
    session (raw audit, filtered CSV, running count); the count table."""
    spec = _contract_topic(spark, sf_dir, "topic_consumer")
    root = shared_path(spark, "stream_consumer")
    run_consumer(spark, spec, root, max_per_trigger=1)
    return latest_snapshot(spark, ConsumerPaths(root).counts)


@register(
    "stream_consumer_fused_niche",
    f"WITH {PIPELINE_CTE} SELECT {_CONTRACT_ROUNDED_SQL} FROM pipeline "
    "WHERE is_gluten_free = 1 AND avg_rating >= 4.5",
)
def q_stream_consumer_fused_niche(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filtered (append) output of the single-pass consumer."""
    spec = _contract_topic(spark, sf_dir, "topic_fused_niche")
    root = shared_path(spark, "stream_fused_niche")
    run_consumer_fused(spark, spec, root, max_per_trigger=1)
    # batch_id=N folders: partition discovery, then the contract columns
    niche = spark.read.schema(CONTRACT_SCHEMA).csv(ConsumerPaths(root).niche)
    return round_contract(niche.select(*CONTRACT_COLUMNS))


# --------------------------------------------------------------------------
# ETL stream (foreachBatch): landing folder -> DLQ + lake + topic
# --------------------------------------------------------------------------


def _run_etl(spark: SparkSession, sf_dir: str, name: str, fmt: str = "parquet") -> tuple[str, TopicSpec]:
    root = shared_path(spark, name)
    raw = venue_rows(spark, sf_dir)
    if fmt == "csv":
        # the raw export as CSV text files; the ETL reads them back with the
        # declared schema (an empty cell is null, as in the source)
        (
            raw.write.mode("overwrite").option("header", "true")
            .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
            .csv(f"{root}/landing")
        )
    else:
        raw.write.mode("overwrite").parquet(f"{root}/landing")
    topic = TopicSpec(kind="files", path=f"{root}/topic")
    run_etl_stream(
        spark, f"{root}/landing", raw.schema, f"{root}/lake", f"{root}/dlq", topic,
        f"{root}/_ckpt", source_format=fmt,
    )
    return root, topic


@register("etl_stream", _PIPELINE_SQL)
def q_etl_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _run_etl(spark, sf_dir, "etl_lake")
    return round_contract(read_lake(spark, f"{root}/lake").select(*CONTRACT_COLUMNS))


@register("etl_stream_csv", _PIPELINE_SQL)
def q_etl_stream_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _run_etl(spark, sf_dir, "etl_csv", fmt="csv")
    return round_contract(read_lake(spark, f"{root}/lake").select(*CONTRACT_COLUMNS))


@register(
    "etl_stream_dlq",
    f"""WITH {VENUE_CTE}
    SELECT venue_id, restaurant_name, country, latitude, longitude,
      concat_ws(',', """
    + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in CRITICAL_COLUMNS)
    + """) AS dlq_reason
    FROM venue WHERE """
    + " OR ".join(f"{c} IS NULL" for c in CRITICAL_COLUMNS),
)
def q_etl_stream_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows the streaming ETL dead-lettered, with their reasons."""
    root, _ = _run_etl(spark, sf_dir, "etl_dlq")
    dlq = read_dlq(spark, f"{root}/dlq")
    return dlq.select(
        "venue_id", "restaurant_name", "country", "latitude", "longitude",
        F.array_join("dlq_reason", ",").alias("dlq_reason"),
    )


@register("etl_stream_published", _PIPELINE_SQL)
def q_etl_stream_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, topic = _run_etl(spark, sf_dir, "etl_topic")
    return round_contract(parse_json(read_topic(spark, topic)))



# --------------------------------------------------------------------------
# extensions: dedup on consume, streaming inference
# --------------------------------------------------------------------------


@register("stream_dedup", _PIPELINE_SQL)
def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic carries every row twice (a republished batch); the
    deduplicating consumer must emit each venue once."""
    spec = TopicSpec(kind="files", path=shared_path(spark, "topic_dup"))
    rows = venue_pipeline(venue_rows(spark, sf_dir))
    publish(encode_json(rows), spec)
    publish(encode_json(rows), spec)
    root = shared_path(spark, "stream_dedup")
    with rocksdb_state(spark):
        parsed = dedup(parsed_stream(spark, spec, max_per_trigger=2), VENUE_KEY)
        _await(start_raw_audit(parsed, f"{root}/out", f"{root}/_ckpt"))
    return round_contract(spark.read.schema(CONTRACT_SCHEMA).parquet(f"{root}/out"))


@register("stream_dedup_events", "SELECT event_id, ts, user_id, event_type, value FROM events")
def q_stream_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is delivered twice; state is bounded by the event time. The
    delay is the span of the table, so that no order of files makes a row late."""
    events = table(spark, sf_dir, "events")
    span = events.select(F.timestamp_diff("SECOND", F.min(F.col("ts").cast("timestamp")), F.max(F.col("ts").cast("timestamp")))).first()[0]
    spec = TopicSpec(kind="files", path=shared_path(spark, "topic_dup_events"))
    messages = events.select(to_json_value(events.columns).alias("value"))
    publish(messages, spec)
    publish(messages, spec)
    root = shared_path(spark, "stream_dedup_events")
    parsed = parsed_stream(spark, spec, EVENTS_SCHEMA, max_per_trigger=2)
    once = dedup(parsed, ["event_id"], event_time="ts", delay=f"{(span or 0) + 3600} seconds")
    _await(start_raw_audit(once, f"{root}/out", f"{root}/_ckpt"))
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{root}/out").select("event_id", "ts", "user_id", "event_type", "value")


_TRAIN_SQL = (
    "('0x' || substr(md5('42:' || concat_ws(':', restaurant_name, country, city, "
    "CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR))), 1, 8))::BIGINT % 100 < 80"
)


@register(
    "stream_inference",
    f"""WITH {PIPELINE_CTE},
    fit AS (SELECT regr_slope(avg_rating, city_avg_rating) AS b,
                   regr_intercept(avg_rating, city_avg_rating) AS a
            FROM pipeline WHERE avg_rating > 0 AND {_TRAIN_SQL})
    SELECT restaurant_name, country, city,
      {sql_rnd("a + b * city_avg_rating")} AS prediction
    FROM pipeline, fit""",
)
def q_stream_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the batch side, save, load in the stream and score every
    arriving venue (one feature here so SQL can check the predictions)."""
    root = shared_path(spark, "stream_inference")
    lake = venue_pipeline(venue_rows(spark, sf_dir))
    train, _ = hash_split(training_rows(lake), VENUE_KEY)
    fit_linear(train, ["city_avg_rating"]).write().overwrite().save(f"{root}/model")
    spec = _contract_topic(spark, sf_dir, "topic_inference")
    scored = score_stream(
        parsed_stream(spark, spec, max_per_trigger=1), f"{root}/model", ["city_avg_rating"],
        keep=["restaurant_name", "country", "city"],
    )
    _await(start_scoring(scored, f"{root}/out", f"{root}/_ckpt"))
    return spark.read.parquet(f"{root}/out").withColumn("prediction", rnd("prediction"))


# --------------------------------------------------------------------------
# the ETL as a scheduled batch job: capped key-ordered slices, committed
# watermark; city means are per batch, as with a capped run
# --------------------------------------------------------------------------

INCREMENT_RUNS = 3  # the cap is a third of the source, whatever its size

_INCREMENT_SQL = pipeline_cte(batches=INCREMENT_RUNS)


@register("etl_increment", f"WITH {_INCREMENT_SQL} SELECT batch_id, {_CONTRACT_ROUNDED_SQL} FROM pipeline")
def q_etl_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_path(spark, "etl_increment")
    # the source table the scheduled job reads (as the reference reads its
    # exported file): each run's key filter is pushed into this scan
    venue_rows(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/source")
    raw = spark.read.parquet(f"{root}/source")
    cap = max(1, -(-raw.count() // INCREMENT_RUNS))  # ceiling division
    topic = TopicSpec(kind="files", path=f"{root}/topic")
    args = (spark, raw, "venue_id", f"{root}/lake", f"{root}/dlq", topic, f"{root}/state")
    while run_etl_increment(*args, cap=cap, ingested="_metadata.file_modification_time") is not None:
        pass
    lake = read_lake(spark, f"{root}/lake")
    return round_contract(lake.select("batch_id", *CONTRACT_COLUMNS))


# --------------------------------------------------------------------------
# the streaming ETL with lake-scope means: batch b's rows carry the city mean
# over batches 0..b. Each third of the source (in key order) lands in its own
# go and the stream is run after it, so batch b is slice b.
# --------------------------------------------------------------------------

_LAKE_SCOPE_SQL = f"""WITH {VENUE_CTE},
{batches_cte(INCREMENT_RUNS)},
good AS (
  SELECT batch_id, restaurant_name, country, city, latitude, longitude,
    COALESCE(avg_rating, 0) AS avg_rating,
    COALESCE(total_reviews_count, 0) AS total_reviews_count,
    CASE trim(price_level) WHEN '$' THEN 1 WHEN '$$ - $$$' THEN 2 WHEN '$$$$' THEN 3 ELSE 0 END
      AS price_level_num,
    CASE WHEN claimed = 'Claimed' THEN 1 ELSE 0 END AS is_claimed,
    CASE WHEN vegetarian_friendly = 'Y' THEN 1 ELSE 0 END AS is_veg_friendly,
    CASE WHEN gluten_free = 'Y' THEN 1 ELSE 0 END AS is_gluten_free
  FROM b WHERE {" AND ".join(f"{c} IS NOT NULL" for c in CRITICAL_COLUMNS)}
),
s AS (SELECT batch_id, city, SUM(avg_rating) AS s, COUNT(avg_rating) AS c FROM good GROUP BY batch_id, city),
cum AS (SELECT batch_id, city,
          SUM(s) OVER (PARTITION BY city ORDER BY batch_id) / SUM(c) OVER (PARTITION BY city ORDER BY batch_id)
            AS m
        FROM s)
SELECT g.batch_id, restaurant_name, country, g.city, latitude, longitude, avg_rating,
  {sql_rnd("cum.m")} AS city_avg_rating, {sql_rnd("avg_rating - cum.m")} AS rating_diff_city,
  CAST(total_reviews_count AS INT) AS total_reviews_count, CAST(price_level_num AS INT) AS price_level_num,
  CAST(is_claimed AS INT) AS is_claimed, CAST(is_veg_friendly AS INT) AS is_veg_friendly,
  CAST(is_gluten_free AS INT) AS is_gluten_free
FROM good g JOIN cum ON g.batch_id = cum.batch_id AND g.city IS NOT DISTINCT FROM cum.city"""


@register("etl_stream_lake_scope", _LAKE_SCOPE_SQL)
def q_etl_stream_lake_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.sources.ingest import slice_walk

    root = shared_path(spark, "etl_lake_scope")
    raw = venue_rows(spark, sf_dir)
    cap = max(1, -(-raw.count() // INCREMENT_RUNS))
    walked = slice_walk(raw, "venue_id", cap, out="_slice")  # materialised once
    topic = TopicSpec(kind="files", path=f"{root}/topic")
    for b in range(INCREMENT_RUNS):
        part = walked.filter(F.col("_slice") == b).drop("_slice").hint("rebalance")
        part.write.mode("append").parquet(f"{root}/landing")
        run_etl_stream(
            spark, f"{root}/landing", raw.schema, f"{root}/lake", f"{root}/dlq", topic, f"{root}/_ckpt",
            context_scope="lake",
        )
    return round_contract(read_lake(spark, f"{root}/lake").select("batch_id", *CONTRACT_COLUMNS))


# --------------------------------------------------------------------------
# restart, state that ends, reports
# --------------------------------------------------------------------------


@register(
    "stream_count_restart",
    f"WITH {PIPELINE_CTE} SELECT country, CAST(COUNT(*) AS BIGINT) AS count FROM pipeline GROUP BY country",
)
def q_stream_count_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running count is stopped after two micro-batches, started again
    from its checkpoint, and its counts are read out of the state store."""
    spec = _contract_topic(spark, sf_dir, "topic_restart")
    root = shared_path(spark, "stream_restart")
    start = dict(checkpoint=f"{root}/_ckpt", mode="update", snapshot_path=f"{root}/snapshot")
    stop_after(start_count(parsed_stream(spark, spec, max_per_trigger=1), trigger=None, **start), 2)
    _await(start_count(parsed_stream(spark, spec, max_per_trigger=1), **start))
    return state_table(spark, f"{root}/_ckpt").select("country", "count")


TTL_SHARE = 8  # a key is silent too long after this part of the table's span

_TTL_SQL = f"""WITH e AS (SELECT user_id, epoch_us(ts) // 1000 AS ms FROM events WHERE ts IS NOT NULL),
s AS (SELECT max(ms) AS newest, (max(ms) - min(ms)) // {TTL_SHARE} AS ttl FROM e)
SELECT user_id, CAST(count(*) AS BIGINT) AS count, CAST(max(ms) AS BIGINT) AS last_ms, max(ms) + any_value(ttl) >= any_value(newest) AS live
FROM e, s GROUP BY user_id"""


@register("stream_idle_totals", _TTL_SQL)
def q_stream_idle_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per user with state that ends: the totals put out for silent
    users and those still in the state add up to all events, and the state
    holds the users that were not silent too long."""
    root = shared_path(spark, "stream_idle")
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    lo, hi = events.agg(F.unix_millis(F.min("ts")), F.unix_millis(F.max("ts"))).first()
    ttl = ((hi or 0) - (lo or 0)) // TTL_SHARE
    # the stream arrives in the order of time, in as many goes as the topic's
    step = max(1, -(-((hi or 0) - (lo or 0) + 1) // TOPIC_WRITES))
    for k in range(TOPIC_WRITES):
        at = F.unix_millis("ts") - F.lit(lo or 0)
        part = events.where((at >= k * step) & (at < (k + 1) * step))
        part.write.mode("append").parquet(f"{root}/in")
        with rocksdb_state(spark):
            stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
            ended = idle_totals(stream, "user_id", "ts", ttl)
            w = ended.writeStream.format("parquet").option("path", f"{root}/ended").option("checkpointLocation", f"{root}/_ckpt")
            _await(w.trigger(availableNow=True).start())
    ended = spark.read.schema("user_id long, count long, last_ms long").parquet(f"{root}/ended").withColumn("live", F.lit(False))
    live = state_table(spark, f"{root}/_ckpt", variable=STATE).select("user_id", "count", "last_ms").withColumn("live", F.lit(True))
    return ended.unionByName(live).groupBy("user_id").agg(F.sum("count").alias("count"), F.max("last_ms").alias("last_ms"), F.bool_or("live").alias("live"))


_REPORT = ["n_rows", "n_good", "n_bad", *(f"n_null_{c}" for c in CRITICAL_COLUMNS)]
_BAD_SQL = " OR ".join(f"{c} IS NULL" for c in CRITICAL_COLUMNS)


@register(
    "stream_report",
    f"""WITH {VENUE_CTE} SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE NOT ({_BAD_SQL})) AS BIGINT) AS n_good,
      CAST(count(*) FILTER (WHERE {_BAD_SQL}) AS BIGINT) AS n_bad, """
    + ", ".join(f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null_{c}" for c in CRITICAL_COLUMNS)
    + f", CAST({TOPIC_WRITES} AS BIGINT) AS n_batches FROM venue",
)
def q_stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw venues arrive in micro-batches and are written as they come; total,
    good, bad and nulls per column of each are observed on the way and come
    out as a table, here summed over the micro-batches."""
    root = shared_path(spark, "stream_report")
    raw = materialize(venue_rows(spark, sf_dir), "stream-report-rows")
    report = ProgressReport(spark, f"{root}/report", "venues")
    spark.streams.addListener(report)
    try:
        for k in range(TOPIC_WRITES):  # one micro-batch a go: the files of a go are all pending
            raw.where(F.pmod(F.xxhash64("venue_id"), F.lit(TOPIC_WRITES)) == k).write.mode("append").parquet(f"{root}/in")
            stream = observed(spark.readStream.schema(raw.schema).parquet(f"{root}/in"), "venues", audit_metrics(CRITICAL_COLUMNS))
            query = start_raw_audit(stream, f"{root}/out", f"{root}/_ckpt")
            _await(query)
            report.wait(query)
    finally:
        spark.streams.removeListener(report)
    return report.table().agg(*(F.sum(c).alias(c) for c in _REPORT), F.count("*").alias("n_batches"))


@register("stream_dedup_late", "SELECT event_id, ts, user_id, event_type, value FROM events")
def q_stream_dedup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is delivered again after all others, behind any watermark;
    the consumer knows the keys its lake holds and keeps each event once."""
    root = shared_path(spark, "stream_dedup_late")
    spec = TopicSpec(kind="files", path=f"{root}/topic")
    events = table(spark, sf_dir, "events")
    messages = events.select("event_id", to_json_value(events.columns).alias("value"))
    for k in (0, 1, 0, 1):
        publish(messages.where(F.pmod("event_id", F.lit(2)) == k), spec)
        run_dedup_lake(parsed_stream(spark, spec, EVENTS_SCHEMA), f"{root}/lake", ["event_id"], f"{root}/_ckpt")
    lake = spark.read.schema(EVENTS_SCHEMA).parquet(f"{root}/lake")
    return lake.select("event_id", "ts", "user_id", "event_type", "value")


_REPLAY_SQL = f"""WITH {VENUE_CTE} SELECT restaurant_name, country, city, COALESCE(latitude, 0) AS latitude, longitude, COALESCE(avg_rating, 0) AS avg_rating
    FROM venue WHERE restaurant_name IS NOT NULL AND country IS NOT NULL AND city IS NOT NULL AND longitude IS NOT NULL"""


@register("dlq_replay", _REPLAY_SQL)
def q_dlq_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues without latitude were dead-lettered; a repair sets it to 0 and
    they enter the lake, once, though the replay is run twice."""
    root, _ = _run_etl(spark, sf_dir, "dlq_replay")
    fix = lambda rows: rows.withColumn("latitude", F.coalesce("latitude", F.lit(0.0)))
    args = (spark, f"{root}/dlq", f"{root}/lake", f"{root}/ledger", fix)
    first, second = replay(*args), replay(*args)
    if second is not None:
        raise RuntimeError(f"replay {second} entered rows of replay {first} again")
    return read_lake(spark, f"{root}/lake").select("restaurant_name", "country", "city", "latitude", "longitude", "avg_rating")
