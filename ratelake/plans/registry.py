"""Registered queries: one Spark callable per operator and, where SQL can
express it, the equivalent DuckDB text over the same tables.

Every query reads the given tables (or data Spark derives from them) in full.
Columns are aliased identically on both sides; float results are rounded on
both sides so the value hashes compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.contract import CRITICAL_COLUMNS, NUMERIC_COLUMNS
from ratelake.functions.encode import FLAG_RULES, binary_flags, impute_zero, ordinal_encode
from ratelake.operators.context import group_context, leave_one_out_context, out_of_fold_context
from ratelake.operators.joins import join_on_keys
from ratelake.operators.quality import batch_audit, split
from ratelake.plans.venue import VENUE_SQL, venue_pipeline, venue_rows
from ratelake.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql.strip()
        return fn

    return deco


def queries() -> dict[str, Query]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


def _load_all() -> None:
    # query modules register themselves on import
    from ratelake.plans import (  # noqa: F401
        q_io,
        q_model,
        q_profile,
        q_stream,
    )


# SQL building blocks shared by several oracle texts
VENUE_CTE = f"venue AS ({VENUE_SQL.strip()})"
_GOOD_WHERE = " AND ".join(f"{c} IS NOT NULL" for c in CRITICAL_COLUMNS)
_BAD_WHERE = " OR ".join(f"{c} IS NULL" for c in CRITICAL_COLUMNS)


def batches_cte(batches: int) -> str:
    """``b``: the venues in key order, cut into so many batches."""
    return f"""b AS (SELECT *, CAST((ROW_NUMBER() OVER (ORDER BY venue_id) - 1)
                // CAST(CEIL(COUNT(*) OVER () / {float(batches)!r}) AS BIGINT) AS BIGINT) AS batch_id
      FROM venue)"""


def pipeline_cte(rated_mean: bool = False, batches: int = 0) -> str:
    """``venue``, ``good`` and ``pipeline``. With ``rated_mean`` imputed rows
    do not count in the city's mean; with ``batches`` the means are per batch."""
    batch = "batch_id, " if batches else ""
    raw = "avg_rating AS raw_rating, " if rated_mean else ""
    mean = f"AVG({'raw_rating' if rated_mean else 'avg_rating'}) OVER (PARTITION BY {batch}city)"
    return f"""{VENUE_CTE},
{batches_cte(batches) + "," if batches else ""}
good AS (
  SELECT {batch}venue_id, restaurant_name, country, city, latitude, longitude,
    {raw}COALESCE(avg_rating, 0) AS avg_rating,
    COALESCE(total_reviews_count, 0) AS total_reviews_count,
    CASE trim(price_level) WHEN '$' THEN 1 WHEN '$$ - $$$' THEN 2 WHEN '$$$$' THEN 3 ELSE 0 END
      AS price_level_num,
    CASE WHEN claimed = 'Claimed' THEN 1 ELSE 0 END AS is_claimed,
    CASE WHEN vegetarian_friendly = 'Y' THEN 1 ELSE 0 END AS is_veg_friendly,
    CASE WHEN gluten_free = 'Y' THEN 1 ELSE 0 END AS is_gluten_free
  FROM {"b" if batches else "venue"} WHERE {_GOOD_WHERE}
),
pipeline AS (
  SELECT {batch}venue_id, restaurant_name, country, city, latitude, longitude, avg_rating,
    {mean} AS city_avg_rating, avg_rating - {mean} AS rating_diff_city,
    CAST(total_reviews_count AS INT) AS total_reviews_count,
    CAST(price_level_num AS INT) AS price_level_num, CAST(is_claimed AS INT) AS is_claimed,
    CAST(is_veg_friendly AS INT) AS is_veg_friendly, CAST(is_gluten_free AS INT) AS is_gluten_free
  FROM good
)"""


PIPELINE_CTE = pipeline_cte()

# Half-up rounding with a guard band, written as plain double arithmetic so
# Spark and DuckDB give identical digits. Data built from 2-decimal amounts
# often puts a mean exactly on a half unit of the last kept digit, where the
# engines' last-ulp summation noise would break the tie differently; moving
# the cut off the half point by a non-decimal fraction removes those ties.
_GUARD = 0.0123456789


def rnd(c, d: int = 6):
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(col * float(10**d) + (0.5 + _GUARD)) / float(10**d)


def sql_rnd(expr: str, d: int = 6) -> str:
    return f"(FLOOR(({expr}) * {float(10**d)!r} + {0.5 + _GUARD!r}) / {float(10**d)!r})"


_CONTRACT_ROUNDED_SQL = f"""restaurant_name, country, city, latitude, longitude, avg_rating,
  {sql_rnd("city_avg_rating")} AS city_avg_rating, {sql_rnd("rating_diff_city")} AS rating_diff_city,
  total_reviews_count, price_level_num, is_claimed, is_veg_friendly, is_gluten_free"""


def round_contract(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"city_avg_rating": rnd("city_avg_rating"), "rating_diff_city": rnd("rating_diff_city")}
    )


# --------------------------------------------------------------------------
# ETL core: DLQ split, encoders, group context, pipeline
# --------------------------------------------------------------------------


@register("venue_pipeline", f"WITH {PIPELINE_CTE} SELECT {_CONTRACT_ROUNDED_SQL} FROM pipeline")
def q_venue_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_contract(venue_pipeline(venue_rows(spark, sf_dir)))


@register(
    "venue_pipeline_window",
    f"WITH {PIPELINE_CTE} SELECT {_CONTRACT_ROUNDED_SQL} FROM pipeline",
)
def q_venue_pipeline_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_contract(venue_pipeline(venue_rows(spark, sf_dir), context_strategy="window"))


@register("venue_pipeline_rated_mean", f"WITH {pipeline_cte(rated_mean=True)} SELECT {_CONTRACT_ROUNDED_SQL} FROM pipeline")
def q_venue_pipeline_rated_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline with ``exclude_imputed``: unrated venues keep their
    imputed 0 but do not count in their city's mean."""
    return round_contract(venue_pipeline(venue_rows(spark, sf_dir), exclude_imputed=True))


_DOC_LABELS = """documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def _doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents (texts included, as a DLQ stores whole rows) with
    their labels. The label table joins through the size-checked broadcast,
    so the documents - and their texts - are not shuffled when it fits."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return join_on_keys(docs, labels, ["doc_id"], how="left")


_LABEL_CRITICAL = ["quality", "toxic"]


@register(
    "dlq_good",
    f"""SELECT d.doc_id, d.text, lang, source, n_chars, quality, toxic FROM {_DOC_LABELS}
    WHERE quality IS NOT NULL AND toxic IS NOT NULL""",
)
def q_dlq_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split(_doc_labels(spark, sf_dir), _LABEL_CRITICAL)
    return good


@register(
    "dlq_bad",
    f"""SELECT d.doc_id, d.text, lang, source, n_chars, quality, toxic,
      concat_ws(',', CASE WHEN quality IS NULL THEN 'quality' END,
                     CASE WHEN toxic IS NULL THEN 'toxic' END) AS dlq_reason
    FROM {_DOC_LABELS} WHERE quality IS NULL OR toxic IS NULL""",
)
def q_dlq_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split(_doc_labels(spark, sf_dir), _LABEL_CRITICAL, with_reason=True)
    return bad.withColumn("dlq_reason", F.array_join("dlq_reason", ","))


@register(
    "batch_audit",
    f"""WITH {VENUE_CTE} SELECT CAST(COUNT(*) AS BIGINT) AS n_rows,
      CAST(COUNT(*) FILTER (WHERE NOT ({_BAD_WHERE})) AS BIGINT) AS n_good,
      CAST(COUNT(*) FILTER (WHERE {_BAD_WHERE}) AS BIGINT) AS n_bad,
      """
    + ",\n      ".join(
        f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null_{c}" for c in CRITICAL_COLUMNS
    )
    + " FROM venue",
)
def q_batch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_audit(venue_rows(spark, sf_dir), CRITICAL_COLUMNS)


@register(
    "impute_zero",
    f"""WITH {VENUE_CTE} SELECT venue_id, COALESCE(avg_rating, 0) AS avg_rating,
      COALESCE(total_reviews_count, 0) AS total_reviews_count FROM venue""",
)
def q_impute_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = venue_rows(spark, sf_dir).select("venue_id", *NUMERIC_COLUMNS)
    return impute_zero(v, NUMERIC_COLUMNS)


@register(
    "ordinal_encode",
    f"""WITH {VENUE_CTE} SELECT venue_id, price_level,
      CAST(CASE trim(price_level) WHEN '$' THEN 1 WHEN '$$ - $$$' THEN 2 WHEN '$$$$' THEN 3
           ELSE 0 END AS INT) AS price_level_num,
      CAST(CASE price_level WHEN '$' THEN 1 WHEN '$$ - $$$' THEN 2 WHEN '$$$$' THEN 3
           ELSE 0 END AS INT) AS price_level_num_unstripped
    FROM venue""",
)
def q_ordinal_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = venue_rows(spark, sf_dir)
    return v.select(
        "venue_id",
        "price_level",
        ordinal_encode("price_level").alias("price_level_num"),
        ordinal_encode("price_level", strip=False).alias("price_level_num_unstripped"),
    )


@register(
    "binary_flags",
    f"""WITH {VENUE_CTE} SELECT venue_id, claimed, vegetarian_friendly, gluten_free,
      CAST(CASE WHEN claimed = 'Claimed' THEN 1 ELSE 0 END AS INT) AS is_claimed,
      CAST(CASE WHEN vegetarian_friendly = 'Y' THEN 1 ELSE 0 END AS INT) AS is_veg_friendly,
      CAST(CASE WHEN gluten_free = 'Y' THEN 1 ELSE 0 END AS INT) AS is_gluten_free
    FROM venue""",
)
def q_binary_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = venue_rows(spark, sf_dir).select(
        "venue_id", *[src for src, _ in FLAG_RULES.values()]
    )
    return binary_flags(v)


_LINE_CONTEXT_SQL = f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity,
      {sql_rnd("AVG(l_quantity) OVER (PARTITION BY l_suppkey)")} AS supp_avg_quantity,
      {sql_rnd("l_quantity - AVG(l_quantity) OVER (PARTITION BY l_suppkey)")} AS quantity_diff_supp
    FROM lineitem"""


def _line_context(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    out = group_context(
        li, "l_quantity", ["l_suppkey"], "supp_avg_quantity", "quantity_diff_supp", strategy=strategy
    )
    return out.withColumns(
        {
            "supp_avg_quantity": rnd("supp_avg_quantity"),
            "quantity_diff_supp": rnd("quantity_diff_supp"),
        }
    )


@register("group_context", _LINE_CONTEXT_SQL)
def q_group_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_context(spark, sf_dir, "aggregate")


@register("group_context_window", _LINE_CONTEXT_SQL)
def q_group_context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_context(spark, sf_dir, "window")


# mean of the other rows: the group's sum and count without the row's own value
_LOO = (
    "(SUM(l_quantity) OVER w - COALESCE(l_quantity, 0)) / "
    "NULLIF(COUNT(l_quantity) OVER w - CASE WHEN l_quantity IS NULL THEN 0 ELSE 1 END, 0)"
)


@register(
    "group_context_loo",
    f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity,
      {sql_rnd(_LOO)} AS supp_loo_quantity,
      {sql_rnd(f"l_quantity - {_LOO}")} AS quantity_diff_loo
    FROM lineitem WINDOW w AS (PARTITION BY l_suppkey)""",
)
def q_group_context_loo(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    out = leave_one_out_context(li, "l_quantity", ["l_suppkey"], "supp_loo_quantity", "quantity_diff_loo")
    return out.withColumns(
        {"supp_loo_quantity": rnd("supp_loo_quantity"), "quantity_diff_loo": rnd("quantity_diff_loo")}
    )


@register(
    "count_by_group",
    f"WITH {PIPELINE_CTE} SELECT country, CAST(COUNT(*) AS BIGINT) AS count FROM pipeline GROUP BY country",
)
def q_count_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the pipeline keeps one row per good venue, so the good rows suffice
    good, _ = split(venue_rows(spark, sf_dir), CRITICAL_COLUMNS)
    return good.groupBy("country").count()


FOLDS = 5
SHRINKAGE = 10.0


@register(
    "group_context_out_of_fold",
    f"""WITH f AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity AS DOUBLE) AS q, CAST((l_orderkey * 7 + l_linenumber) % {FOLDS} AS BIGINT) AS fold FROM lineitem),
    other AS (SELECT x.fold, avg(f.q) AS mean FROM (SELECT DISTINCT fold FROM f) x JOIN f ON f.fold <> x.fold GROUP BY x.fold),
    s AS (SELECT l_suppkey, fold, sum(q) AS s, count(q) AS n FROM f GROUP BY ALL),
    g AS (SELECT l_suppkey, sum(s) AS s, sum(n) AS n FROM s GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, f.l_suppkey, f.fold,
      {sql_rnd(f"(g.s - s.s + {SHRINKAGE!r} * o.mean) / (g.n - s.n + {SHRINKAGE!r})")} AS supp_quantity
    FROM f JOIN s ON s.l_suppkey = f.l_suppkey AND s.fold = f.fold JOIN g ON g.l_suppkey = f.l_suppkey JOIN other o ON o.fold = f.fold""",
)
def q_group_context_out_of_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean quantity of a line's supplier over the other folds' lines."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    fold = ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % FOLDS).cast("long")
    out = out_of_fold_context(li, "l_quantity", ["l_suppkey"], fold, "supp_quantity", SHRINKAGE)
    return out.drop("l_quantity").withColumn("supp_quantity", rnd("supp_quantity"))
