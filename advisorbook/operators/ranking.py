"""Lag and rank at a grain of one row per (entity, period)."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SPLITS = 64


def with_previous(
    df: DataFrame, entity: Sequence[str], period: str, columns: dict[str, str]
) -> DataFrame:
    """Add the value of the entity's previous present period, ``columns`` = {new: old}.

    Missing periods are skipped, not taken as zero. A window holds one entity's periods,
    so its size is bounded by the calendar.
    """
    window = Window.partitionBy(*entity).orderBy(F.asc_nulls_last(period))
    return df.withColumns({new: F.lag(old).over(window) for new, old in columns.items()})


def rank_in_group(
    df: DataFrame,
    group: Sequence[str],
    by: str,
    name: str,
    splits: int = DEFAULT_SPLITS,
    few_groups: bool = False,
) -> DataFrame:
    """``rank() over (partition by group order by by desc nulls last)`` as BIGINT.

    The plain window sorts a whole group in one task. Here a group is cut by value:
    ``splits`` quantiles of ``by`` divide the values into intervals, rows are ranked inside
    their interval, and the number of rows in the group's higher intervals is added. Any
    cut points give the exact rank, as equal values always share an interval. A value heavy
    enough to be a cut point is an interval of its own, where all rows tie; those rows are
    spread by hash. So one task ranks about 1/splits of all rows, whatever the groups are.

    ``few_groups`` says that the number of groups is bounded, as months are: the interval
    sizes, at most 2 * splits rows per group, are then broadcast. ``df`` is read three times;
    pass a written table or cut its lineage first.
    """
    if splits <= 1:
        window = Window.partitionBy(*group).orderBy(F.desc_nulls_last(by))
        return df.withColumn(name, F.rank().over(window).cast("bigint"))

    points = F.array(*[F.lit(i / splits) for i in range(1, splits)])
    quantiles = df.agg(F.percentile_approx(by, points, 10_000)).scalar()
    # Number of lower cuts: where the value lands when sorted in among them. Counting up
    # from the greatest values, an interval is even between two cuts and odd on a cut.
    cuts = F.col("_cuts")
    value = F.coalesce(F.col(by), F.lit(0).cast(df.schema[by].dataType))
    lower = F.array_position(F.sort_array(F.concat(cuts, F.array(value))), value) - 1
    place = -2 * lower - F.array_contains(cuts, value).cast("bigint")
    # NULLs come last and tie, too.
    interval = F.when(F.col(by).isNull(), 1).otherwise(place)
    tied = F.col("_interval") % 2 != 0
    spread = F.when(tied, F.pmod(F.xxhash64(*df.columns), F.lit(splits))).otherwise(0)
    rows = (
        df.withColumn("_cuts", quantiles)
        .withColumn("_interval", interval)
        .drop("_cuts")
        .withColumn("_spread", spread)
    )

    before = (
        Window.partitionBy(*group)
        .orderBy("_interval")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy(*group, "_interval")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            *[F.col(c).alias(f"_of_{c}") for c in group],
            F.col("_interval").alias("_of_interval"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        )
    )
    same = F.col("_interval") == F.col("_of_interval")
    for c in group:
        same = same & rows[c].eqNullSafe(F.col(f"_of_{c}"))
    inside = Window.partitionBy(*group, "_interval", "_spread").orderBy(F.desc_nulls_last(by))
    return rows.join(F.broadcast(offsets) if few_groups else offsets, same).select(
        *df.columns, (F.rank().over(inside) + F.col("_offset")).cast("bigint").alias(name)
    )


def top_ranked(df: DataFrame, group: Sequence[str], by: str, k: int, name: str) -> DataFrame:
    """Rows whose rank in the group is at most ``k``; ties may give more than ``k`` rows.

    The rank filter lets each map task drop its own losers before the shuffle.
    """
    window = Window.partitionBy(*group).orderBy(F.desc_nulls_last(by))
    return df.withColumn(name, F.rank().over(window).cast("bigint")).filter(F.col(name) <= k)
