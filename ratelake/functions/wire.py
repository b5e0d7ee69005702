"""Row <-> JSON text on the wire.

Encoding keeps nulls as explicit ``null`` fields (``to_json`` drops them by
default). Decoding is PERMISSIVE with the declared schema: malformed JSON
gives a row of nulls, a value of the wrong type (``26.0`` for an int field)
gives null in that field only; nothing fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratelake.contract import CONTRACT_SCHEMA, to_contract

# microsecond timestamps on the wire (the JSON default keeps milliseconds)
TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}
JSON_OPTIONS = {"ignoreNullFields": "false", **TIME_OPTIONS}


def to_json_value(columns: list[str]) -> Column:
    """One JSON object per row with every column, nulls explicit."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), JSON_OPTIONS)


def encode_json(df: DataFrame, schema: StructType | None = CONTRACT_SCHEMA) -> DataFrame:
    """``value`` column of JSON text. With a schema the rows are projected and
    cast to it first (an int sent as float would not parse back)."""
    rows = to_contract(df, schema) if schema is not None else df
    return rows.select(to_json_value(rows.columns).alias("value"))


def parse_json(df: DataFrame, schema: StructType = CONTRACT_SCHEMA, column: str = "value") -> DataFrame:
    """Bytes or text column -> typed columns of ``schema`` (struct flattened)."""
    text = F.col(column).cast("string")
    return df.select(F.from_json(text, schema, TIME_OPTIONS).alias("data")).select("data.*")
