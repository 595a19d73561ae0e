"""Data-quality checks; each returns ``check, column, failing_rows, passed``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def _as_rows(totals: DataFrame, checks: Sequence[tuple[str, str]]) -> DataFrame:
    """One row of totals, named by position, as one row per check."""
    rows = F.array(
        *(
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).alias("column"),
                F.col(f"_{i}").alias("failing_rows"),
                (F.col(f"_{i}") == 0).alias("passed"),
            )
            for i, (check, column) in enumerate(checks)
        )
    )
    return totals.select(F.inline(rows))


def column_checks(
    df: DataFrame,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
    unique: Sequence[str] = (),
) -> DataFrame:
    """All not-null and accepted-values checks of a table in one pass, and ``unique`` checks in another.

    A NULL is no unaccepted value; a not-null check finds it.
    """
    if unique:
        repeats = repeated_values(df, unique)
        return column_checks(df, not_null, accepted).unionByName(repeats)
    checks = [("not_null", name) for name in not_null]
    failures: list[Column] = [F.col(name).isNull() for name in not_null]
    for name, values in (accepted or {}).items():
        checks.append(("accepted_values", name))
        failures.append(~F.col(name).isin(*values))
    totals = df.agg(*(F.count_if(failed).alias(f"_{i}") for i, failed in enumerate(failures)))
    return _as_rows(totals, checks)


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL, per column."""
    return column_checks(df, not_null=columns)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is not among ``values``."""
    return column_checks(df, accepted={column: values})


def repeated_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values that occur more than once, per column; NULLs are not compared.

    ``failing_rows`` counts the repeated values. Columns share one scan, and
    repeats are combined before the shuffle.
    """
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value"))
            for name in columns
        )
    )
    counted = df.select(F.inline(pairs)).groupBy("column", "value").agg(
        F.count("value").alias("n")
    )
    totals = counted.agg(
        *(
            F.count_if((F.col("column") == name) & (F.col("n") > 1)).alias(f"_{i}")
            for i, name in enumerate(columns)
        )
    )
    return _as_rows(totals, [("unique", name) for name in columns])


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``repeated_values`` under the name of the check."""
    return repeated_values(df, columns)


# Hours after which a source counts as late, and as failed.
LATE_HOURS, FAILED_HOURS = 25, 49


def _moment(value: datetime | Column) -> Column:
    return value.cast("timestamp") if isinstance(value, Column) else F.lit(value.isoformat(" ")).cast("timestamp")


def freshness(
    df: DataFrame,
    ts: str,
    as_of: datetime | Column | Sequence[datetime | Column] | None = None,
    warn_h: float = LATE_HOURS,
    error_h: float = FAILED_HOURS,
) -> DataFrame:
    """Age of the newest row in hours, and pass, warn or error; an empty table is an error.

    Several times to compare with give a row each, from one scan.
    """
    if as_of is None:
        moments = [F.current_timestamp()]
    else:
        moments = [_moment(m) for m in (as_of if isinstance(as_of, (list, tuple)) else [as_of])]
    age = F.unix_timestamp("_now") - F.unix_timestamp("latest")
    return (
        df.agg(F.max(F.col(ts).cast("timestamp")).alias("latest"))
        .select("latest", F.explode(F.array(*moments)).alias("_now"))
        .select(
            F.lit("freshness").alias("check"),
            F.lit(ts).alias("column"),
            "latest",
            (age / F.lit(3600.0)).alias("age_hours"),
        )
        .withColumn(
            "status",
            F.when(F.col("latest").isNull() | (F.col("age_hours") > error_h), "error")
            .when(F.col("age_hours") > warn_h, "warn")
            .otherwise("pass"),
        )
    )
