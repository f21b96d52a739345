"""Table specifications, checks as Spark expressions, and reports as DataFrames."""

from __future__ import annotations

import functools
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.errors import DataQualityError
from tiersmith.operators.columns import column
from tiersmith.operators.keys import with_next

log = logging.getLogger(__name__)

REPORT_SCHEMA = "table_name string, column_name string, check_name string, failed_rows bigint"

# The week numbers after which a year may start again at 1.
LAST_WEEKS = (49, 50, 51, 52, 53, 54)


@dataclass(frozen=True)
class Check:
    """A registered check with its parameters."""

    name: str
    params: dict = field(default_factory=dict)

    def __str__(self) -> str:
        listed = ", ".join(f"{key}={value!r}" for key, value in self.params.items())
        return f"{self.name}({listed})"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: T.DataType
    nullable: bool = False
    unique: bool = False
    checks: tuple[Check, ...] = ()


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, c.nullable) for c in self.columns])


# name -> (DataFrame, column name, **params) -> condition every row should meet
_ROW_CHECKS: dict[str, Callable[..., Column]] = {}
# name -> (DataFrame, column name, **params) -> DataFrame of the failing rows
_TABLE_CHECKS: dict[str, Callable[..., DataFrame]] = {}


def register_check(name: str, rows: bool = True):
    """Register a check under ``name``.

    With ``rows`` the function returns a condition on one row; all such checks
    of a table are evaluated in one pass. Otherwise it returns the DataFrame
    of what is wrong, and runs as a query of its own.
    """

    def keep(function):
        (_ROW_CHECKS if rows else _TABLE_CHECKS)[name] = function
        return function

    return keep


@register_check("ge")
def at_least(df: DataFrame, name: str, bound) -> Column:
    return column(name) >= F.lit(bound)


@register_check("isin")
def one_of(df: DataFrame, name: str, values: Sequence) -> Column:
    return column(name).isin(list(values))


@register_check("not_in_future")
def not_in_future(df: DataFrame, name: str, as_of: datetime | None = None) -> Column:
    """No later than ``as_of``, which is the time of the query by default."""
    return column(name) <= (F.current_timestamp() if as_of is None else F.lit(as_of))


@register_check("within_years")
def within_years(df: DataFrame, name: str, ref_col: str = "date", years: int = 5) -> Column:
    """No more than ``years`` before the newest ``ref_col`` of the table.

    The newest date is a scalar subquery: no extra round trip, no join.
    """
    newest = df.agg(F.max(column(ref_col))).scalar()
    return column(name) >= newest - F.make_ym_interval(F.lit(years), F.lit(0))


@register_check("continuous", rows=False)
def continuity_breaks(
    df: DataFrame,
    name: str,
    order_by: Sequence[str],
    series: Sequence[str] = (),
    max_values: Sequence[int] = LAST_WEEKS,
) -> DataFrame:
    """The values whose follower is neither one more nor a 1 after an accepted maximum."""
    follower = F.col("next_value")
    steady = (follower - column(name) == 1) | (
        (follower == 1) & column(name).isin(list(max_values))
    )
    return with_next(df, name, order_by, series).where(~steady)


def duplicate_keys(df: DataFrame, name: str) -> DataFrame:
    """The values that occur more than once, with their number of rows."""
    return df.groupBy(column(name).alias(name)).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def violations(df: DataFrame, condition: Column) -> DataFrame:
    """The rows that fail; a condition that is NULL does not fail."""
    return df.where(~condition)


def has_violations(df: DataFrame, condition: Column) -> bool:
    """Whether any row fails; the search ends with the first."""
    return not violations(df, condition).isEmpty()


def validate_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One report row per check: ``(table_name, column_name, check_name, failed_rows)``.

    All row checks share one aggregation over the table, and all unique columns
    of plain types one more. Each table check adds a query over its own columns.
    """
    found = {f.name: f.dataType for f in df.schema}
    counters: list[tuple[str, str, Column]] = []
    queries: list[tuple[str, str, DataFrame]] = []
    unique: list[str] = []
    at_least_one = F.greatest(F.count(F.lit(1)), F.lit(1))
    none = F.lit(0).cast("bigint")

    for col_spec in spec.columns:
        name = col_spec.name
        present = name in found
        counters.append((name, "present", none if present else at_least_one))
        if not present:
            continue
        typed = found[name] == col_spec.dtype
        counters.append(
            (name, f"dtype({col_spec.dtype.simpleString()})", none if typed else at_least_one)
        )
        if not col_spec.nullable:
            counters.append((name, "not_null", F.count_if(column(name).isNull())))
        if col_spec.unique:
            unique.append(name)
        for check in col_spec.checks:
            if check.name in _ROW_CHECKS:
                holds = _ROW_CHECKS[check.name](df, name, **check.params)
                counters.append((name, str(check), F.count_if(~holds)))
            elif check.name in _TABLE_CHECKS:
                wrong = _TABLE_CHECKS[check.name](df, name, **check.params)
                counted = wrong.agg(F.count(F.lit(1)).alias("failed_rows"))
                queries.append((name, str(check), counted))
            else:
                known = ", ".join(sorted([*_ROW_CHECKS, *_TABLE_CHECKS]))
                raise LookupError(f"unknown check {check.name!r}; known: {known}")

    parts = _repeated_rows(df, unique, found)
    counted = df.agg(*[count.alias(f"c{i}") for i, (_, _, count) in enumerate(counters)])
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(label).alias("check_name"),
                F.col(f"c{i}").cast("bigint").alias("failed_rows"),
            )
            for i, (name, label, _) in enumerate(counters)
        ]
    )
    parts.insert(0, counted.select(F.inline(lines)))
    for name, label, failed in queries:
        parts.append(
            failed.select(
                F.lit(name).alias("column_name"),
                F.lit(label).alias("check_name"),
                F.coalesce(F.col("failed_rows"), F.lit(0)).cast("bigint").alias("failed_rows"),
            )
        )
    report = functools.reduce(DataFrame.unionByName, parts)
    return report.select(F.lit(spec.name).alias("table_name"), "*")


def _repeated_rows(df: DataFrame, names: Sequence[str], types: dict[str, T.DataType]) -> list[DataFrame]:
    """Report lines on the unique columns: how many rows share their value with others.

    Columns whose texts are equal exactly when their values are go through one
    pass and one shuffle together; others get a query each.
    """
    plain = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.DecimalType, T.BooleanType)
    together = [n for n in names if isinstance(types[n], plain) or types[n] == T.StringType()]
    parts = []
    if together:
        cells = F.array(
            *[F.struct(F.lit(n).alias("column_name"), column(n).cast("string").alias("value")) for n in together]
        )
        repeated = (
            df.select(F.inline(cells))
            .groupBy("column_name", "value")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .groupBy("column_name")
            .agg(F.sum(F.when(F.col("n_rows") > 1, F.col("n_rows")).otherwise(0)).alias("failed_rows"))
        )
        # An empty table has no groups, but its columns have lines all the same.
        all_names = F.explode(F.array(*map(F.lit, together))).alias("column_name")
        lines = df.sparkSession.range(1).select(all_names).join(repeated, "column_name", "left")
        parts.append(lines.select("column_name", F.lit("unique").alias("check_name"), F.coalesce("failed_rows", F.lit(0)).cast("bigint").alias("failed_rows")))
    for name in (n for n in names if n not in together):
        failed = duplicate_keys(df, name).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("failed_rows"))
        parts.append(failed.select(F.lit(name).alias("column_name"), F.lit("unique").alias("check_name"), "failed_rows"))
    return parts


def quality_gate(tables: Sequence[tuple[DataFrame, TableSpec]], strict: bool = True) -> list[dict]:
    """Check all tables, log what failed, and only then fail the run.

    A report has one row per check, so collecting it is bounded by the specs.
    """
    if not tables:
        return []
    # One query for all tables, so their scans run side by side.
    reports = functools.reduce(
        DataFrame.unionByName, [validate_table(df, spec) for df, spec in tables]
    )
    failures = [row.asDict() for row in reports.where("failed_rows > 0").collect()]
    for row in failures:
        log.error("%s.%s: %s failed on %d row(s)", *row.values())
    for name in {spec.name for _, spec in tables} - {row["table_name"] for row in failures}:
        log.info("%s passed its checks", name)
    if failures and strict:
        raise DataQualityError(failures)
    return failures
