"""Column-level encoders: null imputation, whitespace strip, ordinal and
binary encoding. Each returns a ``Column`` or a DataFrame with columns added;
all are built-in expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.contract import FLAG_RULES, PRICE_LEVELS  # fixed values

# Unicode-aware whitespace at either end. Spark's trim() strips spaces only,
# so a tab or newline around the text would survive it.
_EDGE_WS = r"(?U)^\s+|\s+$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading and trailing Unicode whitespace (null stays null)."""
    return F.regexp_replace(_col(c), _EDGE_WS, "")


def impute_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Replace null (only null, not NaN) with 0 in ``columns``, keeping types.

    ``df.fillna(0)`` would also turn NaN into 0, which the reference does not.
    """
    cols = set(columns)
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)).alias(c)
            if c in cols
            else F.col(c)
            for c in df.columns
        ]
    )


def ordinal_encode(
    c: str | Column,
    mapping: Mapping[str, int] = PRICE_LEVELS,
    strip: bool = True,
    default: int = 0,
) -> Column:
    """Map text to an int code; unmatched or null text gives ``default``.

    The input is stripped once (``strip=True``, ETL behaviour) or compared as
    is (``strip=False``, the exploratory variant).
    """
    v = strip_ws(c) if strip else _col(c)
    expr = None
    for text, code in mapping.items():
        expr = (F.when(v == F.lit(text), F.lit(code)) if expr is None
                else expr.when(v == F.lit(text), F.lit(code)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)).cast("int")


def binary_flag(c: str | Column, yes: str) -> Column:
    """1 when the text equals ``yes`` exactly (case-sensitive, unstripped),
    else 0; null falls to 0."""
    return F.when(_col(c) == F.lit(yes), F.lit(1)).otherwise(F.lit(0)).cast("int")


def binary_flags(df: DataFrame, rules: Mapping[str, tuple[str, str]] = FLAG_RULES) -> DataFrame:
    """Add one 0/1 column per ``out -> (source, yes)`` rule."""
    return df.withColumns({out: binary_flag(src, yes) for out, (src, yes) in rules.items()})


def encode_features(
    df: DataFrame,
    numeric_columns: Iterable[str],
    price_column: str = "price_level",
    strip_price: bool = True,
) -> DataFrame:
    """Imputation, price ordinal and the three flags, in the reference order."""
    out = impute_zero(df, numeric_columns)
    out = out.withColumn("price_level_num", ordinal_encode(price_column, strip=strip_price))
    return binary_flags(out)
