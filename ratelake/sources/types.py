"""Type discovery for text files as one mergeable aggregate.

Each cell is of the narrowest kind that can hold it; a file's column is the
count of its cells by kind. Counts add up over files, batches and days, the
type of a column follows from the kinds that occur, and files whose own type
is narrower than the whole table's show where a column widened.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: narrowest first; a cell takes the first that holds it
KINDS = ("empty", "boolean", "bigint", "double", "date", "timestamp", "string")


def cell_kind(c: Column) -> Column:
    """The narrowest kind of a text cell; null and blank cells are empty."""
    t = F.trim(c)
    holds = {
        "empty": c.isNull() | (t == ""),
        "boolean": F.lower(t).isin("true", "false"),
        "bigint": t.rlike(r"^[+-]?[0-9]+$") & t.try_cast("bigint").isNotNull(),
        "double": t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
        "date": t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & t.try_cast("date").isNotNull(),
        "timestamp": t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}") & t.try_cast("timestamp_ntz").isNotNull(),
    }
    return reduce(lambda rest, k: F.when(holds[k], k).otherwise(rest), reversed(KINDS[:-1]), F.lit("string"))


def column_type(counts: dict[str, Column]) -> Column:
    """The narrowest type that holds every kind with a count: integers fit
    doubles, dates fit timestamps, all else mixed is text; a column of empty
    cells is ``void``."""
    some = {k: F.coalesce(n, F.lit(0)) > 0 for k, n in counts.items()}

    def only(*kinds: str) -> Column:
        return reduce(lambda a, b: a & b, [~some[k] for k in KINDS if k not in kinds and k != "empty"])

    lattice = [("void", ()), ("boolean", ("boolean",)), ("bigint", ("bigint",)), ("double", ("bigint", "double")), ("date", ("date",)), ("timestamp", ("date", "timestamp"))]
    return reduce(lambda rest, t: F.when(only(*t[1]), t[0]).otherwise(rest), reversed(lattice), F.lit("string"))


def count_kinds(cells: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by..., column, n_<kind>...`` of text columns: one aggregate over all
    rows, whose result can be added to others'."""
    kinds = cells.select(*by, *[cell_kind(F.col(f"`{c}`")).alias(f"_k{i}") for i, c in enumerate(columns)])
    one = kinds.groupBy(*by).agg(*[F.count_if(F.col(f"_k{i}") == k).alias(f"_{i}_{k}") for i in range(len(columns)) for k in KINDS])
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"_{i}_{k}").alias(f"n_{k}") for k in KINDS]) for i, c in enumerate(columns)]
    return one.select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*")


def merge_kinds(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of several files or runs as one."""
    return counts.groupBy(*by, "column").agg(*[F.sum(f"n_{k}").alias(f"n_{k}") for k in KINDS])


def typed(counts: DataFrame) -> DataFrame:
    """Adds ``type``."""
    return counts.withColumn("type", column_type({k: F.col(f"n_{k}") for k in KINDS}))


def discover_csv(spark: SparkSession, path: str, unit: str = "file") -> DataFrame:
    """``unit, column, type, n_<kind>...`` of the CSV files under ``path``,
    all columns by header name; every cell is read, none is sampled. Counted
    per file, or per folder (``unit="folder"``: loads of several files)."""
    if unit not in ("file", "folder"):
        raise ValueError(f"unknown unit {unit!r}")
    reader = spark.read.option("header", "true").option("escape", '"').option("recursiveFileLookup", "true")
    cells = reader.csv(path)
    names = cells.columns
    file = F.col("_metadata.file_path")
    by = file if unit == "file" else F.regexp_extract(file, "([^/]+)/[^/]+$", 1)
    return typed(count_kinds(cells.withColumn("_unit", by), names, ["_unit"])).withColumnRenamed("_unit", "unit")


def drift(by_unit: DataFrame) -> DataFrame:
    """``column, type, n_<kind>..., n_units, n_narrower``: the type over all
    files or folders, and in how many of them the column alone is narrower."""
    whole = typed(merge_kinds(by_unit))
    own = by_unit.select("column", F.col("type").alias("own"))
    # one row per column and type, at most as many as types
    seen = own.groupBy("column", "own").agg(F.count(F.lit(1)).alias("n"))
    met = seen.join(whole.select("column", "type"), "column")
    files = met.groupBy("column").agg(F.sum("n").alias("n_units"), F.coalesce(F.sum(F.when(F.col("own") != F.col("type"), F.col("n"))), F.lit(0)).alias("n_narrower"))
    return whole.join(files, "column")
