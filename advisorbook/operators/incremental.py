"""Watermarks and keyed upserts as DataFrame operations."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advisorbook import fixed_values as fv
from advisorbook.operators.drift import check_types
from advisorbook.operators.latest import latest_per_key


def watermark(
    target: DataFrame, column: str, lookback_days: int = fv.LOOKBACK_DAYS
) -> dt.date:
    """Newest ``column`` of the target minus the lookback; a fixed early date if empty.

    One row comes to the driver, so that later filters hold a literal and prune files.
    """
    newest = F.coalesce(F.max(column), F.lit(fv.FIRST_DATE).cast("date"))
    return target.agg(F.date_sub(newest, lookback_days)).first()[0]


def after(df: DataFrame, column: str, mark: dt.date) -> DataFrame:
    """Rows strictly after the watermark."""
    return df.filter(F.col(column) > F.lit(mark))


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[f"_key_{key}"])
    return condition


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows with the same key; the rest is kept.

    Nothing is deleted. Columns new in the source are NULL for kept rows, columns the
    source lacks are NULL for its rows. A NULL key matches a NULL key, so a rerun never
    adds a second row. The source holds each key once.
    """
    check_types(target.schema, source.schema)
    source_keys = source.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    kept = target.join(source_keys, _same_keys(target, source_keys, keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def upsert_latest(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    version: str,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Upsert that replaces a row only by one with an equal or newer ``version``.

    An old snapshot loaded late never replaces a newer row, so the result is the same for
    any loading order. One aggregation with map-side maxima, no join; ``source`` may hold a
    key several times.
    """
    check_types(target.schema, source.schema)
    both = target.withColumn("_incoming", F.lit(0)).unionByName(
        source.withColumn("_incoming", F.lit(1)), allowMissingColumns=True
    )
    return latest_per_key(both, keys, [version, "_incoming", *tiebreak]).drop("_incoming")


def version_changes(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    version: str,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """What ``upsert_latest`` does to each key: its other columns ``before`` (NULL: none) and ``after``.

    The target holds a key once, the source may hold it several times; both have the same columns.
    """
    data = [c for c in target.columns if c not in keys]
    leading = [version, *(c for c in tiebreak if c not in keys)]
    ordered = leading + [c for c in data if c not in leading]
    both = target.withColumn("_incoming", F.lit(0)).unionByName(source.withColumn("_incoming", F.lit(1)))

    def side(incoming: int) -> Column:
        return F.max(F.when(F.col("_incoming") == incoming, F.struct(*ordered)))

    found = both.groupBy(*keys).agg(side(0).alias("_was"), side(1).alias("_now"))
    was, now = F.col("_was"), F.col("_now")
    stays = now.isNull() | F.coalesce(was[version] > now[version], was[version].isNotNull() & now[version].isNull() & was.isNotNull())

    def row(side: Column) -> Column:
        return F.when(side.isNotNull(), F.struct(*[side[c].alias(c) for c in data]))

    after = F.when(stays, row(was)).otherwise(row(now))
    return found.select(*keys, row(was).alias("before"), after.alias("after"))


def upsert_versions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """History upsert: one row per key, version column among the keys; the source wins.

    Loading a snapshot again updates its rows in place.
    """
    check_types(target.schema, source.schema)
    both = target.withColumn("_incoming", F.lit(0)).unionByName(
        source.withColumn("_incoming", F.lit(1)), allowMissingColumns=True
    )
    return latest_per_key(both, keys, ["_incoming", *tiebreak]).drop("_incoming")

