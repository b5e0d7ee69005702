"""Ingestion: tolerant CSV scan and incremental key-ordered slices.

The reference re-reads its whole CSV and slices it by row position. Row
position has no stable meaning in a distributed file scan, so a slice here is
defined on a key: rows with ``key > after`` in key order, ``cap`` at a time
(``cap = 0``: everything pending), taken as a range filter once the slice's
last key is known. For streams, the file source's offset log
plays the watermark's role instead (see ``ratelake.streaming.etl``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from ratelake.operators.ordering import global_position

CORRUPT_COLUMN = "_corrupt_record"


def _csv_reader(spark: SparkSession, header: bool, multi_line: bool):
    """Quoted cells as in RFC 4180: a quote inside is doubled; ``multi_line``
    allows line breaks in quoted cells (such files are not split)."""
    r = spark.read.option("header", str(header).lower()).option("quote", '"').option("escape", '"')
    return r.option("multiLine", str(multi_line).lower())


def header_fields(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> list[StructField]:
    """The columns of the header under ``path``, the declared ones with their
    types and the others as text; a declared column that is not there raises."""
    names = _csv_reader(spark, True, multi_line).option("inferSchema", "false").csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"column(s) not in the header: {missing}; have {names}")
    declared = {f.name: f for f in schema.fields}
    return [declared.get(n, StructField(n, StringType(), True)) for n in names]


def read_csv_tolerant(
    spark: SparkSession,
    path: str,
    schema: StructType,
    header: bool = True,
    corrupt_column: str | None = CORRUPT_COLUMN,
    multi_line: bool = False,
) -> DataFrame:
    """PERMISSIVE CSV scan with a declared schema: a cell that does not parse
    becomes null and the scan goes on; with ``corrupt_column`` the raw line of
    such a row is kept there (null for clean rows).

    With a header, columns are found by name, in any order and among others;
    a declared column that is not there raises, and so does a file whose
    header differs from the first one's."""
    r = _csv_reader(spark, header, multi_line).option("mode", "PERMISSIVE")
    fields = list(schema.fields)
    if header:
        fields = header_fields(spark, path, schema, multi_line)
        r = r.option("enforceSchema", "false")
    out = [f.name for f in schema.fields]
    if corrupt_column:
        fields.append(StructField(corrupt_column, StringType(), True))
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
        out.append(corrupt_column)
    return r.schema(StructType(fields)).csv(path).select(*[F.col(f"`{c}`") for c in out])


def infer_csv_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> StructType:
    """Discovery: infer types from all rows (production reads declare). A
    smaller ``sampling_ratio`` may miss the value that widens a type."""
    r = _csv_reader(spark, True, False).option("inferSchema", "true")
    return r.option("samplingRatio", str(sampling_ratio)).csv(path).schema


def order_value(df: DataFrame, key: str) -> Column:
    """``key`` in a form that Python and JSON carry exactly: times as
    microseconds since 1970, dates as days; other types as they are."""
    kind = df.schema[key].dataType
    if isinstance(kind, TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{key}`)")
    if isinstance(kind, TimestampType):
        return F.unix_micros(F.col(key))
    if isinstance(kind, DateType):
        return F.unix_date(F.col(key))
    return F.col(key)


def slice_boundary(df: DataFrame, key: str, after=None, cap: int = 0):
    """The last key of the next slice: the ``cap``-th smallest key above
    ``after`` (the largest pending key when fewer are pending; None when
    nothing is pending). The key column alone is range-sorted; positions come
    from distributed prefix sums, so no task holds more than its range."""
    keys = df.filter(F.col(key).isNotNull()) if after is None else df.filter(F.col(key) > F.lit(after))
    pos = global_position(keys.select(key), [key], out="_pos")
    return pos.filter(F.col("_pos") < F.lit(int(cap))).agg(F.max(key)).first()[0]


def next_slice(df: DataFrame, key: str, after=None, cap: int = 0) -> DataFrame:
    """The next pending slice: ``key > after`` in key order, at most ``cap``
    rows (``cap = 0``: all pending rows). With a cap, the slice's last key is
    found first on the key column alone, and the slice itself is a range
    filter: rows stay in their partitions and are never gathered in one task
    (``key`` must be unique for exactly ``cap`` rows)."""
    pending = df if after is None else df.filter(F.col(key) > F.lit(after))
    if cap and cap > 0:
        last = slice_boundary(df, key, after, cap)
        if last is None:
            return pending.filter(F.lit(False))
        return pending.filter(F.col(key) <= F.lit(last))
    return pending


def slice_walk(df: DataFrame, key: str, cap: int, after=None, out: str = "slice_no") -> DataFrame:
    """Every pending row tagged with the slice that would carry it when
    walking ``cap`` rows at a time in key order (``key`` must be unique).

    Positions come from distributed prefix sums, not a single-task
    ``row_number() over (order by key)``."""
    pending = df if after is None else df.filter(F.col(key) > F.lit(after))
    pos = global_position(pending, [key], out="_pos")
    return pos.withColumn(out, F.expr(f"`_pos` div {int(cap)}").cast("long")).drop("_pos")
