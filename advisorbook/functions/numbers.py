"""Number expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

def share(part: Column, total: Column) -> Column:
    """part / total where the total is positive, else NULL."""
    return F.when(total > 0, part.cast("double") / total.cast("double"))


def relative_change(current: Column, previous: Column) -> Column:
    """(current - previous) / previous, NULL where there is no non-zero previous."""
    return F.when(previous != 0, (current - previous) / previous)
