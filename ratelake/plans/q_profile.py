"""Registered profiling queries: describe, histogram, box plot, correlation."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.contract import EDA_COLUMNS
from ratelake.functions.encode import binary_flags, ordinal_encode
from ratelake.operators.moments import update_states, whole_corr, whole_describe
from ratelake.operators.profile import boxplot_stats, corr_matrix, describe_column, histogram
from ratelake.plans.registry import VENUE_CTE, register, rnd, sql_rnd
from ratelake.plans.venue import venue_rows
from ratelake.session import shared_path
from ratelake.sources.lake import read_lake, write_batch
from ratelake.sources.tables import table

def eda_frame(raw: DataFrame) -> DataFrame:
    """The exploratory frame of the reference: price text compared unstripped,
    no imputation, so rows with a null rating or count drop out listwise."""
    enc = raw.withColumn("price_level_num", ordinal_encode("price_level", strip=False))
    return binary_flags(enc)


_EDA_SQL = f"""{VENUE_CTE},
eda AS (
  SELECT avg_rating, total_reviews_count, price_level,
    CASE price_level WHEN '$' THEN 1 WHEN '$$ - $$$' THEN 2 WHEN '$$$$' THEN 3 ELSE 0 END
      AS price_level_num,
    CASE WHEN claimed = 'Claimed' THEN 1 ELSE 0 END AS is_claimed,
    CASE WHEN vegetarian_friendly = 'Y' THEN 1 ELSE 0 END AS is_veg_friendly,
    CASE WHEN gluten_free = 'Y' THEN 1 ELSE 0 END AS is_gluten_free
  FROM venue
)"""


def _describe_sql(src: str, col: str, with_clause: str = "") -> str:
    return f"""{with_clause} SELECT '{col}' AS "column", CAST(COUNT({col}) AS BIGINT) AS count,
      CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS null_count,
      {sql_rnd(f"AVG({col})")} AS mean, {sql_rnd(f"STDDEV_SAMP({col})")} AS std,
      MIN({col}) AS min, {sql_rnd(f"quantile_cont({col}, 0.25)")} AS p25,
      {sql_rnd(f"quantile_cont({col}, 0.5)")} AS median,
      {sql_rnd(f"quantile_cont({col}, 0.75)")} AS p75, MAX({col}) AS max FROM {src}"""


def _round_describe(df: DataFrame) -> DataFrame:
    return df.withColumns({c: rnd(c) for c in ("mean", "std", "p25", "median", "p75")})


@register("describe_column", _describe_sql("events", "value"))
def q_describe_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_describe(describe_column(table(spark, sf_dir, "events"), "value"))


@register("describe_rating", _describe_sql("venue", "avg_rating", f"WITH {VENUE_CTE}"))
def q_describe_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_describe(describe_column(venue_rows(spark, sf_dir), "avg_rating"))


def _histogram_sql(src: str, col: str, bins: int = 10, with_clause: str = "") -> str:
    return f"""{with_clause}{"," if with_clause else "WITH"}
    x AS (SELECT {col} AS v FROM {src} WHERE {col} IS NOT NULL AND NOT isnan({col})),
    b AS (SELECT MIN(v) AS lo, MAX(v) AS hi FROM x),
    c AS (
      SELECT CASE WHEN hi - lo = 0 THEN 1
             ELSE LEAST(CAST(FLOOR((v - lo) / (hi - lo) * {float(bins)!r}) AS BIGINT) + 1, {bins}) END
             AS bin, COUNT(*) AS n
      FROM x, b GROUP BY 1)
    SELECT CAST(s.bin AS BIGINT) AS bin,
      {sql_rnd(f"lo + (s.bin - 1) * ((hi - lo) / {bins})")} AS bin_lo,
      {sql_rnd(f"lo + s.bin * ((hi - lo) / {bins})")} AS bin_hi,
      CAST(COALESCE(c.n, 0) AS BIGINT) AS count
    FROM generate_series(1, {bins}) AS s(bin) CROSS JOIN b LEFT JOIN c ON c.bin = s.bin"""


def _round_hist(df: DataFrame) -> DataFrame:
    return df.withColumns({"bin_lo": rnd("bin_lo"), "bin_hi": rnd("bin_hi")})


@register("histogram", _histogram_sql("events", "value"))
def q_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_hist(histogram(table(spark, sf_dir, "events"), "value", 10))


@register("histogram_rating", _histogram_sql("venue", "avg_rating", 10, f"WITH {VENUE_CTE}"))
def q_histogram_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_hist(histogram(venue_rows(spark, sf_dir), "avg_rating", 10))


def _boxplot_sql(src: str, g: str, v: str, with_clause: str = "") -> str:
    inside = f"{v} >= lower_fence AND {v} <= upper_fence"
    return f"""{with_clause}{"," if with_clause else "WITH"}
    d AS (SELECT {g}, {v} FROM {src} WHERE {g} IS NOT NULL AND {v} IS NOT NULL),
    q AS (SELECT {g}, quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS median,
                 quantile_cont({v}, 0.75) AS q3 FROM d GROUP BY {g}),
    f AS (SELECT *, q3 - q1 AS iqr, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lower_fence,
                 q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS upper_fence FROM q)
    SELECT f.{g}, CAST(COUNT(*) AS BIGINT) AS n, {sql_rnd("f.q1")} AS q1,
      {sql_rnd("f.median")} AS median, {sql_rnd("f.q3")} AS q3, {sql_rnd("f.iqr")} AS iqr,
      {sql_rnd("f.lower_fence")} AS lower_fence, {sql_rnd("f.upper_fence")} AS upper_fence,
      MIN({v}) FILTER (WHERE {inside}) AS whisker_lo,
      MAX({v}) FILTER (WHERE {inside}) AS whisker_hi,
      CAST(COUNT(*) FILTER (WHERE NOT ({inside})) AS BIGINT) AS n_outliers,
      MIN({v}) AS min, MAX({v}) AS max
    FROM d JOIN f ON d.{g} = f.{g}
    GROUP BY f.{g}, f.q1, f.median, f.q3, f.iqr, f.lower_fence, f.upper_fence"""


def _round_box(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: rnd(c) for c in ("q1", "median", "q3", "iqr", "lower_fence", "upper_fence")}
    )


@register("boxplot_stats", _boxplot_sql("events", "event_type", "value"))
def q_boxplot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_box(boxplot_stats(table(spark, sf_dir, "events"), "value", "event_type"))


@register(
    "boxplot_rating_by_price",
    _boxplot_sql("venue", "price_level", "avg_rating", f"WITH {VENUE_CTE}"),
)
def q_boxplot_rating_by_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_box(boxplot_stats(venue_rows(spark, sf_dir), "avg_rating", "price_level"))


def _corr_sql(src: str, cols: list[str], with_clause: str = "") -> str:
    pairs = list(combinations_with_replacement(range(len(cols)), 2))
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    ms = ",\n      ".join(
        f"covar_pop(CAST({cols[i]} AS DOUBLE), CAST({cols[j]} AS DOUBLE)) / "
        f"(stddev_pop(CAST({cols[i]} AS DOUBLE)) * stddev_pop(CAST({cols[j]} AS DOUBLE))) AS r_{i}_{j}"
        for i, j in pairs
    )
    sel = []
    for i, j in pairs:
        for a, b in {(i, j), (j, i)}:
            sel.append(f"SELECT '{cols[a]}' AS col_a, '{cols[b]}' AS col_b, {sql_rnd(f'r_{i}_{j}')} AS corr FROM m")
    return f"""{with_clause}{"," if with_clause else "WITH"}
    d AS (SELECT {", ".join(cols)} FROM {src} WHERE {notnull}),
    m AS (SELECT {ms} FROM d)
    """ + "\nUNION ALL ".join(sel)


def _round_corr(df: DataFrame) -> DataFrame:
    return df.withColumn("corr", rnd("corr"))


@register("corr_matrix", _corr_sql("eda", EDA_COLUMNS, "WITH " + _EDA_SQL))
def q_corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_corr(corr_matrix(eda_frame(venue_rows(spark, sf_dir)), EDA_COLUMNS))


LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@register("corr_matrix_lineitem", _corr_sql("lineitem", LINEITEM_NUMERIC))
def q_corr_matrix_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_corr(corr_matrix(table(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC))




# --------------------------------------------------------------------------
# profiles kept up batch by batch: the second update reads new batches only
# --------------------------------------------------------------------------

PROFILE_BATCHES = 3
_EVENT_COLUMNS = ["value", "user_id"]


def _event_profile(spark: SparkSession, sf_dir: str) -> str:
    """Events land in a lake batch by batch; after each batch the profile is
    brought up to date. Returns where the states are."""
    lake, states = shared_path(spark, "profile_lake"), shared_path(spark, "profile_states")
    events = table(spark, sf_dir, "events").select("event_id", *_EVENT_COLUMNS)
    read = lambda n: read_lake(spark, lake, events.schema, by=None, batch_id=n)
    for k in range(PROFILE_BATCHES):
        write_batch(events.where(F.pmod("event_id", F.lit(PROFILE_BATCHES)) == k), lake, k, by=None)
        if update_states(spark, lake, states, _EVENT_COLUMNS, read) != [k]:
            raise RuntimeError("an update of the profile must read the new batch and no other")
    return states


@register(
    "profile_lake_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(COUNT({c}) AS BIGINT) AS count, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count,
      {sql_rnd(f"AVG({c})")} AS mean, {sql_rnd(f"STDDEV_SAMP({c})")} AS std, CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max FROM events"""
        for c in _EVENT_COLUMNS
    ),
)
def q_profile_lake_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole_describe(spark, _event_profile(spark, sf_dir)).withColumns({c: rnd(c) for c in ("mean", "std")})


@register("profile_lake_corr", _corr_sql("events", _EVENT_COLUMNS))
def q_profile_lake_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_corr(whole_corr(spark, _event_profile(spark, sf_dir)))
