"""A training-corpus pipeline out of the operators of ``ratelake.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before kept; its result is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``docs``.

Near duplicates and leaks are judged by id and text, so rows that share an id
with other texts, or have none, are judged each by its own text; of rows alike
in both, one stays. A null text fails the base rules of the first stage. Further
columns of ``docs`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.llm import chosen_path, fair_mix, kd_shards, latent_leaks, quality_llr
from ratelake.llm.sparkkit import materialize, table

SHARDS = 8

#: no SQL: hashed likelihood ratios and latent retrieval; the stages are tested
#: against brute-force versions
ORACLE_SQL = None


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name in docs.columns:
        name = "_" + name
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality_llr.keep_good(docs, quality_llr.trusted_sample(table(spark, sf_dir, "labels")))


def _named(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of its id and text, and that column's name."""
    uid = _fresh(docs, "uid")
    return docs.withColumn(uid, F.xxhash64(F.col("doc_id").cast("long"), F.lit(0), F.col("text"))), uid


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one with the smallest id (of rows
    that share it, the one with the smallest hash)."""
    named, uid = _named(docs)
    classes = chosen_path.jaccard_join(named.select(F.col(uid).alias("doc_id"), "text")).select(F.col("doc_id").alias(uid), "class_id")
    ids = named.select(uid, F.col("doc_id").cast("long").alias("id")).distinct()
    order = F.struct(F.col("id").isNull(), "id", uid)
    first = classes.distinct().join(ids, uid).groupBy("class_id").agg(F.min(order).getField(uid).alias(uid))
    return named.join(first.select(uid), uid, "left_semi").dropDuplicates([uid]).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    named, uid = _named(docs)
    hits = latent_leaks.leaks(named.select(F.col(uid).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return named.join(hits.select(F.col("doc_id").alias(uid)).distinct(), uid, "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. The queue works on ids and
    sizes; of rows alike in id, text and source each gets its share."""
    key = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"), F.col("source").alias("source")]
    queue = fair_mix.queue(docs.select(*key, fair_mix.n_words().alias("size")))
    taken = queue.queued.withColumn("copies", fair_mix.copies(queue)).groupBy("doc_id", "tkey", "source")
    taken = taken.agg(F.sum("copies").alias("copies")).where("copies > 0")
    taken = materialize(taken.select(F.struct("doc_id", "tkey", "source").alias("of"), "copies"), "mix-taken")
    each = docs.select(F.struct(*docs.columns).alias("doc"), F.struct(*key).alias("key"))
    met = each.join(taken, F.col("key").eqNullSafe(F.col("of")))
    same = Window.partitionBy("key")
    share = F.expr("copies div alike + if(nth <= copies % alike, 1, 0)")
    met = met.withColumn("alike", F.count("*").over(same)).withColumn("nth", F.row_number().over(same.orderBy("copies")))
    return met.withColumn("again", F.explode(F.sequence(F.lit(0), share))).where("again > 0").select("doc.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place in it of every document."""
    return kd_shards.kd_shards(docs, n_shards=SHARDS)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
