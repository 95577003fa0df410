import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from advisorbook import fixed_values as fv
from advisorbook.functions import dates, numbers, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def test_whitespace_is_what_python_strips():
    assert sorted(fv.WHITESPACE) == [chr(i) for i in range(0x110000) if chr(i).isspace()]


@pytest.mark.parametrize(
    "value, expected",
    [(" a b ", "a b"), ("\t x \n", "x"), (" \t ", ""), (" y　", "y"), (None, None)],
)
def test_strip(spark, value, expected):
    assert one(spark, text.strip(F.lit(value).cast("string"))) == expected


def test_null_tokens_before_strip(spark):
    df = spark.createDataFrame([(v,) for v in ("NA", "null", "", " NA ", "x")], "v string")
    cleaned = [r[0] for r in df.select(text.strip(text.null_tokens(F.col("v")))).collect()]
    assert cleaned == [None, None, None, "NA", "x"]


def test_key_hash_matches_python_and_tells_nulls_apart(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("a", "b")], "a string, b string")
    got = [r[0] for r in df.select(text.key_hash(F.col("a"), F.col("b"))).collect()]
    texts = ["__NULL__\x1fx", "x\x1f__NULL__", "a\x1fb"]
    assert got == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def test_key_hash_of_numbers_uses_their_text(spark):
    got = one(spark, text.key_hash(F.lit(12).cast("bigint"), F.lit(True)))
    assert got == hashlib.sha256(b"12\x1ftrue").hexdigest()


def test_first_matching_without_rules(spark):
    assert one(spark, text.first_matching(F.lit("x"), (), "none")) == "none"


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2026-01-31 08:59:59", dt.date(2026, 1, 31)),
        ("2026-01-31 09:00:00", dt.date(2026, 2, 1)),
        ("2026-01-31", dt.date(2026, 1, 31)),
        (None, None),
    ],
)
def test_business_date(spark, value, expected):
    day = dates.business_date(F.lit(value).cast("string"))
    assert one(spark, day) == expected
    month = one(spark, dates.month_start(day))
    assert month == (expected and expected.replace(day=1))


@pytest.mark.parametrize(
    "name, expected",
    [
        ("x_2026-01-10.csv", dt.date(2026, 1, 10)),
        ("x20260110.csv", dt.date(2026, 1, 10)),
        ("2026-02-28", dt.date(2026, 2, 28)),
        ("a.2026-01-10.csv", dt.date(2026, 1, 10)),
        ("20250101_2026-01-10.csv", dt.date(2026, 1, 10)),
    ],
)
def test_date_from_name(spark, name, expected):
    assert one(spark, dates.date_from_name(F.lit(name))) == expected


@pytest.mark.parametrize(
    "name",
    ["x_120260110.csv", "x.csv", "x_2026-13-01.csv", "x_2026-02-30.csv", "2026-13-01_20260110.csv"],
)
def test_date_from_name_fails(spark, name):
    df = spark.createDataFrame([(name,)], "name string")
    with pytest.raises(Exception, match="No snapshot date"):
        df.select(dates.date_from_name(F.col("name"))).collect()


def test_tenure(spark):
    as_of = F.lit("2026-03-01").cast("date")
    assert one(spark, dates.tenure_days(F.lit("2026-02-01 23:00:00").cast("timestamp_ntz"), as_of)) == 28
    assert one(spark, dates.tenure_days(F.lit(None).cast("timestamp_ntz"), as_of)) is None


def test_share_and_change_guard_their_denominators(spark):
    def share(total):
        return one(spark, numbers.share(F.lit(1.0), F.lit(total)))

    assert [share(4.0), share(0.0), share(-1.0)] == [0.25, None, None]
    assert one(spark, numbers.relative_change(F.lit(3.0), F.lit(2.0))) == 0.5
    assert one(spark, numbers.relative_change(F.lit(3.0), F.lit(0.0))) is None
    assert one(spark, numbers.relative_change(F.lit(3.0), F.lit(None).cast("double"))) is None
