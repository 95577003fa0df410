"""Data-quality checks. Each returns the violating rows; no rows means it passed."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advisorbook import fixed_values as fv
from advisorbook.contracts import KPI_KEYS

ERROR = "error"
WARN = "warn"


# Conditions on one row. They feed both the row-returning checks and the one-pass report.


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_negative(column: str) -> Column:
    """NULL passes."""
    return F.col(column) < 0


def is_unexpected(column: str, accepted: Sequence) -> Column:
    """NULL passes."""
    return ~F.col(column).isin(*accepted)


def is_future(column: str, as_of: Column, offset_hours: int = 0) -> Column:
    """Later than ``as_of`` plus a tolerance."""
    limit = as_of.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(offset_hours))
    return F.col(column).cast("timestamp_ntz") > limit


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_missing(column))


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_negative(column))


def no_future_dates(
    df: DataFrame, column: str, as_of: Column, offset_hours: int = 0
) -> DataFrame:
    return df.filter(is_future(column, as_of, offset_hours))


# Checks that need grouping or a second table.


def accepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Each unexpected value with its number of rows."""
    unexpected = df.filter(is_unexpected(column, accepted))
    return unexpected.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values found more than once, with their number of rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations found more than once, with their number of rows."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter("n_records > 1")


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows whose non-NULL value is absent from the parent column.

    A plain anti join: Spark broadcasts a parent below its size limit and otherwise splits
    skewed keys at run time.
    """
    keys = parent.select(F.col(field).alias("_parent"))
    children = df.filter(F.col(column).isNotNull())
    return children.join(keys, children[column] == keys["_parent"], "left_anti")


# Checks on the monthly fact.


def allocation_reconciles(
    kpis: DataFrame, tolerance: float = fv.RECONCILE_TOLERANCE
) -> DataFrame:
    """Agent-months whose buckets miss the total, or that hold unclassified money."""
    zero = F.lit(0.0)
    buckets = (
        F.coalesce("aum_equity_campuran", zero)
        + F.coalesce("aum_fixed_income", zero)
        + F.coalesce("aum_unknown_class", zero)
    )
    summed = kpis.select(
        "agent_id",
        "month_start_date",
        "total_aum",
        "aum_equity_campuran",
        "aum_fixed_income",
        "aum_unknown_class",
        buckets.alias("bucket_sum"),
    )
    off = F.abs(F.col("bucket_sum") - F.col("total_aum")) > tolerance
    return summed.filter(off | (F.col("aum_unknown_class") > 0))


def core_counts_reconcile(
    expected: DataFrame, kpis: DataFrame, missing: int = 0
) -> DataFrame:
    """Agent-months whose core count differs from a recomputation.

    ``expected`` (agent_id, month_start_date, expected_core_count) has no row for a month
    without core customers. ``missing=0`` reads that as zero. ``missing=-1`` takes it
    literally and reports every such month.
    """
    stored = kpis.select(*KPI_KEYS, "core_customer_count")
    both = expected.join(stored, list(KPI_KEYS), "full_outer").select(
        *KPI_KEYS, "expected_core_count", "core_customer_count"
    )
    return both.filter(
        F.coalesce("expected_core_count", F.lit(missing))
        != F.coalesce("core_customer_count", F.lit(missing))
    )


def positions_within_bounds(
    kpis: DataFrame, catalogue_size: int | Column = fv.CATALOGUE_SIZE
) -> DataFrame:
    """Agent-months with more positions than customers times products on offer."""
    rows = kpis.select(
        "agent_id", "month_start_date", "month_end_positions", "total_customer_count"
    )
    return rows.filter(F.col("month_end_positions") > F.col("total_customer_count") * catalogue_size)


def no_future_months(kpis: DataFrame, as_of: Column) -> DataFrame:
    return kpis.filter(F.col("month_start_date") > as_of).select("agent_id", "month_start_date")


# Report over many checks.


@dataclass(frozen=True)
class RowCheck:
    """A condition that marks a violating row."""

    name: str
    violation: Column
    severity: str = ERROR


@dataclass(frozen=True)
class SetCheck:
    """A frame of violating rows."""

    name: str
    violations: DataFrame
    severity: str = ERROR


def _row_counts(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """All row checks of a table in one pass over it."""
    counted = df.agg(*[F.count_if(c.violation).alias(f"n{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.lit(c.severity).alias("severity"),
            F.col(f"n{i}").alias("violations"),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _set_counts(check: SetCheck) -> DataFrame:
    return check.violations.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity"), "violations"
    )


def dq_report(
    row_checks: Sequence[tuple[DataFrame, Sequence[RowCheck]]],
    set_checks: Sequence[SetCheck] = (),
) -> DataFrame:
    """One row per check: name, severity, violations and status pass / warn / fail."""
    parts = [_row_counts(df, checks) for df, checks in row_checks]
    parts += [_set_counts(check) for check in set_checks]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    status = F.when(F.col("violations") == 0, "pass").when(
        F.col("severity") == WARN, "warn"
    )
    return report.withColumn("status", status.otherwise("fail"))


def require_passed(report: DataFrame) -> None:
    """Fail with the names of the error-level checks that have violations."""
    failed = report.filter("status = 'fail'").orderBy("check_name").collect()
    if failed:
        detail = ", ".join(f"{r['check_name']} ({r['violations']})" for r in failed)
        raise ValueError(f"Data-quality checks failed: {detail}")


def require_rows(df: DataFrame, name: str) -> None:
    """Fail before anything downstream runs on an empty table."""
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
