"""Dead-letter split: a row with a null in any critical column is bad.

Only ``isNull`` counts: an empty string or a NaN passes, as in the reference.
The split is one boolean column and two filters over the same plan, so both
sides read the input once per action (persist the input when both are
written in one job, as the ETL does).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAD_FLAG = "_is_bad"
REASON = "dlq_reason"


MALFORMED = "malformed"


OUT_OF_RANGE = "out_of_range"


def _beyond_int(c: str) -> Column:
    """A value that the contract's integer type cannot hold."""
    return F.col(c).isNotNull() & F.col(c).try_cast("int").isNull()


def bad_condition(
    critical: Sequence[str], corrupt_column: str | None = None, integers: Sequence[str] = ()
) -> Column:
    """OR of ``isNull`` over the critical columns (false when none given);
    with ``corrupt_column`` a row the reader could not parse is bad too, and
    with ``integers`` one whose value does not fit an int."""
    conds = [F.col(c).isNull() for c in critical] + [_beyond_int(c) for c in integers]
    if corrupt_column:
        conds.append(F.col(corrupt_column).isNotNull())
    if not conds:
        return F.lit(False)
    return reduce(lambda a, b: a | b, conds)


def null_reasons(
    critical: Sequence[str], corrupt_column: str | None = None, integers: Sequence[str] = ()
) -> Column:
    """Array of the critical column names that are null in this row (plus
    ``malformed`` when the reader kept the raw line, and ``<column>:out_of_range``)."""
    items = [F.when(F.col(c).isNull(), F.lit(c)) for c in critical]
    items += [F.when(_beyond_int(c), F.lit(f"{c}:{OUT_OF_RANGE}")) for c in integers]
    if corrupt_column:
        items.append(F.when(F.col(corrupt_column).isNotNull(), F.lit(MALFORMED)))
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def flag_bad(df: DataFrame, critical: Sequence[str]) -> DataFrame:
    """Add the boolean ``_is_bad`` column."""
    return df.withColumn(BAD_FLAG, bad_condition(critical))


def split(
    df: DataFrame,
    critical: Sequence[str],
    with_reason: bool = False,
    corrupt_column: str | None = None,
    integers: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Return ``(good, bad)``. ``with_reason`` adds ``dlq_reason`` (array of
    the null critical columns) to the bad side. ``corrupt_column`` (the CSV
    reader's raw-line column) also sends unparsable rows to the bad side,
    with reason ``malformed``; by default such a row only loses the bad
    cells (they read as null) and is judged on its critical columns.
    ``integers`` sends rows whose value the contract would lose there too."""
    cond = bad_condition(critical, corrupt_column, integers)
    good = df.filter(~cond)
    bad = df.filter(cond)
    if with_reason:
        bad = bad.withColumn(REASON, null_reasons(critical, corrupt_column, integers))
    return good, bad


def audit_metrics(critical: Sequence[str]) -> list[Column]:
    """The aggregates of a batch's report: total, good, bad and, per critical
    column, how many rows have it null."""
    cond = bad_condition(critical)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~cond).alias("n_good"),
        F.count_if(cond).alias("n_bad"),
        *(F.count_if(F.col(c).isNull()).alias(f"n_null_{c}") for c in critical),
    ]


def batch_audit(df: DataFrame, critical: Sequence[str]) -> DataFrame:
    """Row counts of one batch in a single aggregate (``audit_metrics``)."""
    return df.agg(*audit_metrics(critical))
