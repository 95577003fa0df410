"""Additive schema drift: new columns appear, none are dropped or renamed, types only widen."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, LongType, StringType, StructType

# Kinds of values a text column holds, as bits, so that states of parts unite by OR.
_LONG, _DOUBLE, _BOOLEAN, _TEXT = 1, 2, 4, 8


# Every text that casts to BIGINT or DOUBLE is of these forms; a cast that fails raises inside, which costs far more.
_LIKE_LONG = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"
_LIKE_DOUBLE = r"^[\x00-\x20\x7F]*[+-]?(?:[0-9.][0-9a-fA-FxXpP+.-]*|(?i:nan|inf|infinity))[\x00-\x20\x7F]*$"


def kinds_of(text: Column) -> Column:
    """Aggregate: the kinds of values of a text column; NULL where it has none.

    States of files, tasks and loads unite by OR, so one pass over all of them is enough.
    """
    kind = (
        F.when(text.rlike(_LIKE_LONG) & text.try_cast("bigint").isNotNull(), _LONG)
        .when(text.rlike(_LIKE_DOUBLE) & text.try_cast("double").isNotNull(), _DOUBLE)
        .when(F.lower(text).isin("true", "false"), _BOOLEAN)
        .otherwise(_TEXT)
    )
    return F.bit_or(F.when(text.isNotNull(), kind))


def type_of_kinds(kinds: int | None) -> DataType | None:
    """BIGINT, DOUBLE or BOOLEAN where every value fits, else text; None without values."""
    if not kinds:
        return None
    if kinds & ~(_LONG | _DOUBLE) == 0:
        return DoubleType() if kinds & _DOUBLE else LongType()
    return BooleanType() if kinds == _BOOLEAN else StringType()


def widened(column: str, known: DataType | None, found: DataType | None) -> DataType | None:
    """The type that holds both; a column without values (None) takes any.

    BIGINT widens to DOUBLE, and text holds whatever comes later. Text in a column of numbers or
    flags fails, as do flags among numbers.
    """
    if known is None or found is None or known == found:
        return found if known is None else known
    if {known, found} == {LongType(), DoubleType()}:
        return DoubleType()
    if known == StringType():
        return known
    raise ValueError(f"Column type changed: {column}: {known.simpleString()} -> {found.simpleString()}")


def new_columns(existing: StructType, incoming: StructType) -> dict[str, DataType]:
    """Columns of ``incoming`` that ``existing`` lacks, names compared as Spark does."""
    known = {f.name.lower() for f in existing}
    return {f.name: f.dataType for f in incoming if f.name.lower() not in known}


def check_types(existing: StructType, incoming: StructType) -> None:
    """Fail, naming column and both types, where a shared column changed its type."""
    known = {f.name.lower(): f.dataType for f in existing}
    changed = [
        f"{f.name}: {known[f.name.lower()].simpleString()} -> {f.dataType.simpleString()}"
        for f in incoming
        if f.name.lower() in known and known[f.name.lower()] != f.dataType
    ]
    if changed:
        raise ValueError("Column type changed: " + ", ".join(changed))


def align(df: DataFrame, target: StructType) -> DataFrame:
    """Select the target's columns in its order; a missing one becomes NULL."""
    present = {c.lower() for c in df.columns}
    return df.select(
        *[
            F.col("`" + f.name.replace("`", "``") + "`") if f.name.lower() in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target
        ]
    )


def union_with_drift(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column missing in a frame is NULL for its rows."""
    result = frames[0]
    for df in frames[1:]:
        check_types(result.schema, df.schema)
        result = result.unionByName(df, allowMissingColumns=True)
    return result
