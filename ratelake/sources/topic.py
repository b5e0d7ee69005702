"""The topic: keyless JSON messages, on Kafka or as a JSON-lines folder.

``TopicSpec(kind="kafka", ...)`` maps to Spark's Kafka source / sink (needs
the ``spark-sql-kafka`` connector on the classpath; untested here, no broker
is available). ``TopicSpec(kind="files", path=...)`` is the broker-less twin:
each publish appends text files of one JSON object per line, and the stream
side reads the folder with the text file source. Both are at-least-once: a
republished batch is delivered again, consumers must tolerate duplicates.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TopicSpec:
    kind: str = "files"  # "files" or "kafka"
    path: str | None = None  # folder for kind="files"
    bootstrap_servers: str | None = None
    topic: str | None = None
    acks: str = "all"
    idempotent: bool = True
    extra: dict[str, str] = field(default_factory=dict)

    def kafka_source_options(self) -> dict[str, str]:
        """Client options shared by readers and writers (servers plus
        ``extra``, e.g. ``kafka.security.protocol``)."""
        return {"kafka.bootstrap.servers": self.bootstrap_servers or "", **self.extra}

    def kafka_options(self) -> dict[str, str]:
        """Sink options: the shared ones plus acknowledgement settings."""
        return {
            **self.kafka_source_options(),
            "kafka.acks": self.acks,
            "kafka.enable.idempotence": str(self.idempotent).lower(),
        }


def publish(encoded: DataFrame, spec: TopicSpec, files: int | None = None) -> None:
    """Publish a ``value`` column of JSON text. The job fails unless every
    record was written (Kafka: acknowledged under ``acks``), so a caller that
    commits progress only after ``publish`` returns never skips a record.
    For the folder topic ``files`` fixes the number of files written (e.g. to
    drive several micro-batches downstream); by default AQE sizes them."""
    values = encoded.select("value")
    if spec.kind == "kafka":
        w = values.write.format("kafka").option("topic", spec.topic)
        for k, v in spec.kafka_options().items():
            w = w.option(k, v)
        w.save()
    elif spec.kind == "files":
        # advisory-size files (AQE rebalance), not one small file per task
        out = values.repartition(int(files)) if files else values.hint("rebalance")
        out.write.mode("append").text(spec.path)
    else:
        raise ValueError(f"unknown topic kind {spec.kind!r}")


def read_topic(spark: SparkSession, spec: TopicSpec) -> DataFrame:
    """Batch read of everything published so far (``value`` as text)."""
    if spec.kind == "kafka":
        r = spark.read.format("kafka").option("subscribe", spec.topic)
        r = r.option("startingOffsets", "earliest")
        for k, v in spec.kafka_source_options().items():
            r = r.option(k, v)
        return r.load().selectExpr("CAST(value AS STRING) AS value")
    return spark.read.text(spec.path)


def stream_topic(
    spark: SparkSession,
    spec: TopicSpec,
    starting_offsets: str = "earliest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming read of the topic; one ``value`` text column. The start
    position applies to the first start only; later starts resume from the
    query's checkpoint."""
    if spec.kind == "kafka":
        r = (
            spark.readStream.format("kafka")
            .option("subscribe", spec.topic)
            .option("startingOffsets", starting_offsets)
        )
        for k, v in spec.kafka_source_options().items():
            r = r.option(k, v)
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return r.load().selectExpr("CAST(value AS STRING) AS value")
    r = spark.readStream.format("text")
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    return r.load(spec.path)
