"""Profile id-like columns and pick a business key."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advisorbook import fixed_values as fv


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def id_like(columns: Sequence[str], patterns: Sequence[str]) -> list[str]:
    """Columns whose lower-cased name matches one of the patterns."""
    return [c for c in columns if any(re.search(p, c.lower()) for p in patterns)]


def profile_columns(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """One row per id-like column: distinct values, their share of all rows, NULL share, type.

    The columns are stacked and counted per (column, value) first, which runs inside the
    map tasks; a value with a third of all rows shuffles as one row per task. The second
    count works on distinct values only.
    """
    columns = id_like(df.columns, patterns)
    if not columns:
        raise ValueError(f"No id-like column among {df.columns}")
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    values = [F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns]
    stacked = df.select(F.inline(F.array(*values)))
    per_value = stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    missing = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
    dtype = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    # Every column has its row, also in a frame without rows.
    every = df.sparkSession.range(1).select(F.explode(F.lit(columns)).alias("column"))
    listed = every.select("column", F.lit(None).cast("string").alias("value"), F.lit(0).cast("long").alias("n"))
    return per_value.unionByName(listed).groupBy("column").agg(
        F.count("value").alias("distinct_values"),
        F.try_divide(F.count("value"), total).alias("cardinality_ratio"),
        F.try_divide(missing, total).alias("null_fraction"),
        F.element_at(dtype, F.col("column")).alias("dtype"),
    )


def detect_business_key(
    df: DataFrame,
    patterns: Sequence[str],
    min_ratio: float = fv.COMPOSITE_KEY_RATIO,
) -> list[str]:
    """Key columns of ``df``, judged by name and profile.

    A column without NULLs that is nearly unique is a key by itself; one named ``id`` goes
    first, then by name. Else the NULL-free columns above ``min_ratio`` form the key, else
    all id-like columns do. Only the profile, a row per column, reaches the driver.
    """
    profile = {row["column"]: row for row in profile_columns(df, patterns).collect()}
    if all(p["cardinality_ratio"] is None for p in profile.values()):
        raise ValueError("Cannot detect a key without rows")
    complete = {c: p["cardinality_ratio"] for c, p in profile.items() if p["null_fraction"] == 0}
    single = [c for c, ratio in complete.items() if ratio >= fv.SINGLE_KEY_RATIO]
    if single:
        return [min(single, key=lambda c: (c.lower() != "id", c))]
    composite = sorted(c for c, ratio in complete.items() if ratio >= min_ratio)
    return composite or sorted(profile)
