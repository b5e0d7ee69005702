"""Join helpers: null-safe key joins and a broadcast behind a measured size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024

_FIXED = {"boolean", "byte", "short", "integer", "long", "float", "double", "date", "timestamp", "timestamp_ntz", "void"}


def row_bytes(schema: StructType) -> Column:
    """Bytes of a row: 8 per fixed-width value, 16 per decimal, the real
    length of texts and binaries (of the text form of nested values)."""
    width = F.lit(16 + sum(16 if f.dataType.typeName().startswith("decimal") else 8 for f in schema.fields)).cast("long")
    for f in schema.fields:
        kind = f.dataType.typeName()
        if kind not in _FIXED and not kind.startswith("decimal"):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
    return width


def bounded_broadcast(
    small: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Materialise ``small`` once in the shared checkpoint folder, counting
    rows and bytes in the same job, and mark it for broadcast only if it has
    at most ``max_rows`` rows and ``max_bytes`` bytes.

    Beyond the bound the plain DataFrame is returned and Spark plans a shuffle
    join (AQE may still convert it, and splits skewed partitions)."""
    size = Observation()
    seen = small.observe(size, F.count(F.lit(1)).alias("n"), F.sum(row_bytes(small.schema)).alias("bytes"))
    small = seen.checkpoint(eager=True)
    got = size.get
    if got["n"] <= max_rows and (got["bytes"] or 0) <= max_bytes:
        return F.broadcast(small)
    return small


def join_on_keys(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join ``small`` (one row per key) onto ``big`` with null-safe equality on
    ``keys`` (null keys match each other, as window partitions do)."""
    keys = list(keys)
    ren = {k: f"_jk{i}" for i, k in enumerate(keys)}
    s = small.select(*[F.col(c).alias(ren.get(c, c)) for c in small.columns])
    s = bounded_broadcast(s, max_broadcast_rows)
    cond = [big[k].eqNullSafe(s[ren[k]]) for k in keys]
    return big.join(s, on=cond, how=how).drop(*ren.values())
