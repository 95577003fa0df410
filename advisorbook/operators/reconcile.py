"""Compare two versions of the monthly fact."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorbook import fixed_values as fv
from advisorbook.contracts import KPI_KEYS


def rerun_drift(
    before: DataFrame, after: DataFrame, stamp: str, keys: Sequence[str] = KPI_KEYS
) -> DataFrame:
    """One row: keys in both versions, changed load stamps (allowed), changed totals (not)."""
    old = before.select(
        *keys, F.col("total_aum").alias("old_total"), F.col(stamp).alias("old_stamp")
    )
    new = after.select(
        *keys, F.col("total_aum").alias("new_total"), F.col(stamp).alias("new_stamp")
    )
    # A total gained or lost counts as changed.
    none = F.lit(float(fv.MISSING_COUNT))
    moved = F.coalesce("new_total", none) != F.coalesce("old_total", none)
    return old.join(new, list(keys)).agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.count_if(F.col("new_stamp") != F.col("old_stamp")).alias("rows_with_changed_ts"),
        F.count_if(moved).alias("aum_drift_rows"),
    )


def checksums(df: DataFrame, period: str, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per period the rows, those whose keys are all known, and a sum of row hashes that no order changes.

    Two periods with equal sums hold the same rows, but for a collision of 64-bit hashes. Partial sums
    are taken in the map tasks.
    """
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return df.groupBy(period).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(known).alias("known_rows"),
        F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("checksum"),
    )


def rerun_drift_by_period(
    before: DataFrame, after: DataFrame, stamp: str, keys: Sequence[str] = KPI_KEYS, period: str = "month_start_date"
) -> DataFrame:
    """``rerun_drift`` that joins only the periods whose checksums differ.

    Each version holds a key once, and ``period`` is one of the keys. A row per period comes to the
    driver; the differing ones then stand as literals in the plan, so other partitions are not read again.
    A rerun without change joins no row.
    """
    columns = [*keys, "total_aum", stamp]
    old = checksums(before, period, columns, keys).withColumnsRenamed({"checksum": "was", "rows": "were"})
    new = checksums(after, period, columns, keys)
    at = old[period].eqNullSafe(new[period])
    both = old.drop("known_rows").join(new, at, "full_outer")
    found = both.select(new[period].alias("period"), "were", "was", "rows", "known_rows", "checksum").collect()
    same = [r for r in found if r["were"] == r["rows"] and r["was"] == r["checksum"]]
    # A period in one version only has no rows in both.
    differ = [r["period"] for r in found if r["were"] is not None and r["rows"] is not None and r not in same]
    kept = sum(r["known_rows"] for r in same)
    names = ("rows_after", "rows_with_changed_ts", "aum_drift_rows")
    if not differ:
        return before.sparkSession.createDataFrame([(kept, 0, 0)], ", ".join(f"{n} BIGINT" for n in names))
    # Rows of an unknown period match nothing in either version.
    here = F.col(period).isin([p for p in differ if p is not None])
    drift = rerun_drift(before.filter(here), after.filter(here), stamp, keys)
    return drift.withColumn("rows_after", F.col("rows_after") + F.lit(kept))


def stack_totals(recomputed: DataFrame, persisted: DataFrame) -> DataFrame:
    """Recomputed and persisted totals under one another, for side-by-side reading."""
    columns = [*KPI_KEYS, F.col("total_aum").alias("reference_total_aum")]
    return recomputed.select(*columns).unionByName(persisted.select(*columns))


def split_differences(kpis: DataFrame, tolerance: float = fv.RECONCILE_TOLERANCE) -> DataFrame:
    """Agent-months whose buckets do not add up or hold unclassified money, worst first."""
    total = F.col("total_aum")
    buckets = (
        F.col("aum_equity_campuran") + F.col("aum_fixed_income") + F.col("aum_unknown_class")
    )
    rows = kpis.select(
        *KPI_KEYS,
        total,
        "aum_equity_campuran",
        "aum_fixed_income",
        "aum_unknown_class",
        buckets.alias("bucket_sum"),
        (total - buckets).alias("diff"),
    )
    off = (F.abs("diff") > tolerance) | (F.col("aum_unknown_class") > 0)
    return rows.filter(off).orderBy(F.desc_nulls_last("diff"))
