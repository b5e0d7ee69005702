"""The one schema shared by the lake, the wire (JSON topic) and the stream.

Defined once; every writer projects to it and every reader declares it, so
the three phases cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results, kept
# together: contract column names, order and types; the critical columns (a
# null sends the row to the DLQ); the numeric columns imputed with 0; the
# price-level texts and codes; the flag columns and their "yes" texts; the
# niche filter of the append query; the model features, label, split and
# forest parameters; the histogram bin count.
# ---------------------------------------------------------------------------
CONTRACT_SCHEMA = StructType(
    [
        StructField("restaurant_name", StringType(), True),
        StructField("country", StringType(), True),
        StructField("city", StringType(), True),
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField("avg_rating", DoubleType(), True),
        StructField("city_avg_rating", DoubleType(), True),
        StructField("rating_diff_city", DoubleType(), True),
        StructField("total_reviews_count", IntegerType(), True),
        StructField("price_level_num", IntegerType(), True),
        StructField("is_claimed", IntegerType(), True),
        StructField("is_veg_friendly", IntegerType(), True),
        StructField("is_gluten_free", IntegerType(), True),
    ]
)
CONTRACT_COLUMNS = [f.name for f in CONTRACT_SCHEMA.fields]
CRITICAL_COLUMNS = ["restaurant_name", "country", "latitude", "longitude"]
NUMERIC_COLUMNS = ["avg_rating", "total_reviews_count"]
FEATURE_COLUMNS = [
    "total_reviews_count",
    "price_level_num",
    "is_claimed",
    "is_veg_friendly",
    "is_gluten_free",
    "city_avg_rating",
]
EDA_COLUMNS = [
    "avg_rating",
    "total_reviews_count",
    "price_level_num",
    "is_claimed",
    "is_veg_friendly",
    "is_gluten_free",
]
LABEL_COLUMN = "avg_rating"
PARTITION_COLUMN = "country"
PRICE_LEVELS = {"$": 1, "$$ - $$$": 2, "$$$$": 3}  # any other text, or null: 0
FLAG_RULES = {
    "is_claimed": ("claimed", "Claimed"),
    "is_veg_friendly": ("vegetarian_friendly", "Y"),
    "is_gluten_free": ("gluten_free", "Y"),
}
NICHE_FLAG = "is_gluten_free"  # append query: flag == 1 and rating >= minimum
NICHE_MIN_RATING = 4.5
TRAIN_FRACTION = 0.8
SPLIT_SEED = 42
FOREST_TREES = 50
FOREST_DEPTH = 5
FOREST_SEED = 42
HISTOGRAM_BINS = 10
# ---------------------------------------------------------------------------

# Spark writes an empty-string partition value as __HIVE_DEFAULT_PARTITION__
# and reads it back as null; the lake maps '' to this sentinel and back.
EMPTY_PARTITION_SENTINEL = "__empty__"


def to_contract(
    df: DataFrame, schema: StructType = CONTRACT_SCHEMA, keep: tuple[str, ...] | list[str] = ()
) -> DataFrame:
    """Project ``df`` to the contract columns, in order, cast to the contract
    types. Casting the integer columns here (before any JSON encoding) keeps a
    float-typed count from being lost by the strict reader downstream.
    ``try_cast``: a value the contract type cannot hold (e.g. a count beyond
    the int range) becomes null, as it would on the wire, instead of failing
    the whole job under ANSI mode. ``keep`` names extra columns (e.g. a row
    key) carried in front."""
    return df.select(
        *keep, *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Fail before any action if a required column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required column(s) missing: {missing}; have {df.columns}")
