"""Regression on the lake with MLlib: split, fit, score, evaluate, compare.

* The train/test split is a **key hash**, not ``randomSplit``: a row's side
  depends only on its key and the seed, so it is the same for any file
  layout, partition count or executor loss (``randomSplit`` draws per
  partition and changes with the layout). ``random_split`` stays available.
* Random forest bootstrap samples and binning also depend on row layout;
  ``canonical_layout`` fixes it (hash-partition on the key into a given
  number of partitions, sort within partitions), so a fit is reproducible
  for any input file layout at a fixed partition count (the session's
  ``spark.sql.shuffle.partitions`` unless ``num_partitions`` is passed).
* Metrics are one aggregate over the predictions (RMSE, MSE, MAE and R2 in a
  single pass); R2 uses ``try_divide`` so a constant label gives null rather
  than an ANSI error.
* Models, coefficients and importances are small driver-side objects; the
  data only ever moves as MLlib's distributed aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.contract import (
    FEATURE_COLUMNS,
    FOREST_DEPTH,
    FOREST_SEED,
    FOREST_TREES,
    LABEL_COLUMN,
    SPLIT_SEED,
    TRAIN_FRACTION,
)

# the identity of a venue in the contract (no surrogate key travels)
VENUE_KEY = ["restaurant_name", "country", "city", "latitude", "longitude"]
SPLIT_COLUMN = "split"


def hash_bucket(
    keys: Sequence[str], seed: int = SPLIT_SEED, buckets: int = 100, method: str = "md5"
) -> Column:
    """``0 .. buckets-1`` from a hash of ``seed:key...``.

    ``md5`` (default): the first 32 bits of md5 - reproducible in any engine
    (the SQL oracle recomputes it). ``xxhash64``: Spark's native 64-bit hash
    of the seed and the typed key columns - several times cheaper per row,
    for very large training sets where portability does not matter."""
    if method == "xxhash64":
        return F.pmod(F.xxhash64(F.lit(int(seed)), *[F.col(k) for k in keys]), F.lit(buckets))
    if method != "md5":
        raise ValueError(f"unknown hash method {method!r}")
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(buckets)


def with_split(
    df: DataFrame,
    keys: Sequence[str],
    train_fraction: float = TRAIN_FRACTION,
    seed: int = SPLIT_SEED,
    method: str = "md5",
) -> DataFrame:
    """Add ``split`` = 'train' / 'test' by key hash."""
    cut = int(round(train_fraction * 100))
    return df.withColumn(
        SPLIT_COLUMN,
        F.when(hash_bucket(keys, seed, method=method) < F.lit(cut), F.lit("train")).otherwise(F.lit("test")),
    )


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    train_fraction: float = TRAIN_FRACTION,
    seed: int = SPLIT_SEED,
    method: str = "md5",
) -> tuple[DataFrame, DataFrame]:
    s = with_split(df, keys, train_fraction, seed, method)
    return (
        s.filter(F.col(SPLIT_COLUMN) == "train").drop(SPLIT_COLUMN),
        s.filter(F.col(SPLIT_COLUMN) == "test").drop(SPLIT_COLUMN),
    )


def random_split(df: DataFrame, train_fraction: float = TRAIN_FRACTION, seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """MLlib-style split; reproducible only for an unchanged layout."""
    tr, te = df.randomSplit([train_fraction, 1 - train_fraction], seed=seed)
    return tr, te


def canonical_layout(df: DataFrame, keys: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """Fixed partitioning and in-partition order, for layout-sensitive fits.
    The order is over the keys and then all other columns, so rows with tied
    keys stand in the same order whatever the input's layout."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in df.columns if c not in keys]
    return df.repartition(n, *keys).sortWithinPartitions(*keys, *rest)


def training_rows(
    lake: DataFrame,
    features: Sequence[str] = FEATURE_COLUMNS,
    label: str = LABEL_COLUMN,
    keys: Sequence[str] = VENUE_KEY,
) -> DataFrame:
    """Rows with a rating (``label > 0``; imputed zeros are unrated) as
    ``keys..., features..., label``. The filter reaches the Parquet scan."""
    return lake.filter(F.col(label) > 0).select(
        *keys, *features, F.col(label).cast("double").alias("label")
    )


def _assembler(features: Sequence[str]) -> VectorAssembler:
    # handleInvalid="error": a null feature fails the fit instead of
    # silently dropping or zeroing the row
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def fit_linear(train: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, **params) -> PipelineModel:
    """Linear regression at MLlib defaults (no regularisation, intercept,
    standardisation; normal-equation solver below 4096 features: one pass)."""
    lr = LinearRegression(featuresCol="features", labelCol="label", **params)
    return Pipeline(stages=[_assembler(features), lr]).fit(train)


def fit_forest(
    train: DataFrame,
    features: Sequence[str] = FEATURE_COLUMNS,
    num_trees: int = FOREST_TREES,
    max_depth: int = FOREST_DEPTH,
    seed: int = FOREST_SEED,
    **params,
) -> PipelineModel:
    rf = RandomForestRegressor(
        featuresCol="features", labelCol="label", numTrees=num_trees, maxDepth=max_depth, seed=seed, **params
    )
    return Pipeline(stages=[_assembler(features), rf]).fit(train)


def score(model: PipelineModel, rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return model.transform(rows).select(*keep, "label", "prediction")


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``n, rmse, mse, mae, r2`` in one aggregate (R2 = 1 - SSE / SST)."""
    err = F.col(label) - F.col(prediction)
    m = pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(err * err).alias("_sse"),
        F.sum(F.abs(err)).alias("_sae"),
        F.var_pop(F.col(label)).alias("_var"),
    )
    return m.select(
        "n",
        F.sqrt(F.try_divide(F.col("_sse"), F.col("n"))).alias("rmse"),
        F.try_divide(F.col("_sse"), F.col("n")).alias("mse"),
        F.try_divide(F.col("_sae"), F.col("n")).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_var") * F.col("n"))).alias("r2"),
    )


def linear_coefficients(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """``feature, coefficient`` per feature plus an ``(intercept)`` row."""
    lm = model.stages[-1]
    rows = [(f, float(w)) for f, w in zip(features, lm.coefficients.toArray())]
    rows.append(("(intercept)", float(lm.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def forest_importances(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """``feature, importance, importance_pct`` (importances sum to 1)."""
    imp = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v), float(v) * 100.0) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "feature string, importance double, importance_pct double")


def compare(spark: SparkSession, results: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """``model, rmse, r2, is_best`` (best = lowest RMSE)."""
    best = min(results, key=lambda k: results[k]["rmse"]) if results else None
    rows = [(k, float(v["rmse"]), v.get("r2"), k == best) for k, v in results.items()]
    return spark.createDataFrame(rows, "model string, rmse double, r2 double, is_best boolean")


MODELS = {"lr": ("linear_regression", fit_linear), "rf": ("random_forest", fit_forest)}


def prepared_split(
    lake: DataFrame,
    features: Sequence[str] = FEATURE_COLUMNS,
    keys: Sequence[str] = VENUE_KEY,
    train_fraction: float = TRAIN_FRACTION,
    seed: int = SPLIT_SEED,
    num_partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Training rows in the canonical layout, split by key hash, each side
    checkpointed once: every model fits and scores these very rows, and
    nothing upstream (lake scan, layout shuffle) is recomputed per model or
    after a lost executor. ``num_partitions`` fixes the layout's partition
    count (and so the forest) independently of the session setting."""
    rows = canonical_layout(training_rows(lake, features, keys=keys), keys, num_partitions)
    # one evaluation of everything upstream; both sides filter the same rows
    rows = with_split(rows, keys, train_fraction, seed).checkpoint(eager=True)
    train = rows.filter(F.col(SPLIT_COLUMN) == "train").drop(SPLIT_COLUMN)
    return train, rows.filter(F.col(SPLIT_COLUMN) == "test").drop(SPLIT_COLUMN)


def train_and_compare(
    spark: SparkSession,
    lake: DataFrame,
    models: Sequence[str] = ("lr", "rf"),
    features: Sequence[str] = FEATURE_COLUMNS,
    keys: Sequence[str] = VENUE_KEY,
    train_fraction: float = TRAIN_FRACTION,
    seed: int = SPLIT_SEED,
    num_partitions: int | None = None,
) -> dict:
    """Fit the chosen models on the same split and layout; return fitted
    models, metrics rows and the comparison table."""
    train, test = prepared_split(lake, features, keys, train_fraction, seed, num_partitions)
    # the fits pass over the training rows many times (one per tree level,
    # one per solver step): keep them in executor memory while fitting
    train.persist(StorageLevel.MEMORY_AND_DISK)
    fitted, metrics = {}, {}
    try:
        for m in models:
            name, fit = MODELS[m]
            model = fit(train, features)
            met = regression_metrics(score(model, test)).first().asDict()
            fitted[name], metrics[name] = model, met
    finally:
        train.unpersist()
    return {"models": fitted, "metrics": metrics, "comparison": compare(spark, metrics),
            "train": train, "test": test}
