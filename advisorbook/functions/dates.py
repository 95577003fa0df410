"""Date and time expressions. No function reads the clock; callers pass ``as_of``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from advisorbook import fixed_values as fv


def business_timestamp(value: Column, hours: int = fv.BUSINESS_SHIFT_HOURS) -> Column:
    """Source time moved onto the business clock."""
    return value.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hours))


def business_date(value: Column, hours: int = fv.BUSINESS_SHIFT_HOURS) -> Column:
    return business_timestamp(value, hours).cast("date")


def month_start(value: Column) -> Column:
    return F.trunc(value, "MM")


def tenure_days(since: Column, as_of: Column) -> Column:
    """Whole days from ``since`` to ``as_of``; NULL where ``since`` is NULL."""
    return F.datediff(as_of, since.cast("date")).cast("bigint")


def date_from_name(name: Column) -> Column:
    """Snapshot date in a file name; fails when there is none or it is no real date."""
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    iso = F.regexp_extract(stem, fv.ISO_DATE[0], 1)
    compact = F.regexp_extract(stem, fv.COMPACT_DATE[0], 1)
    parsed = F.when(
        iso != "", F.try_to_timestamp(iso, F.lit(fv.ISO_DATE[1])).cast("date")
    ).when(
        compact != "", F.try_to_timestamp(compact, F.lit(fv.COMPACT_DATE[1])).cast("date")
    )
    problem = F.concat(F.lit("No snapshot date (YYYY-MM-DD or YYYYMMDD) in name: "), name)
    return F.coalesce(parsed, F.raise_error(problem))
