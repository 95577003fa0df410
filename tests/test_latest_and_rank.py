import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from advisorbook.operators.latest import latest_per_key
from advisorbook.operators.ranking import rank_in_group, top_ranked, with_previous
from tests.frames import rows_of

SLOW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_latest_wins_and_nulls_come_last(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, 5, "b"), (1, 7, "c"), (2, None, "d"), (None, 1, "e"), (None, 2, "f")],
        "id int, v int, x string",
    )
    assert rows_of(latest_per_key(df, ["id"], ["v"])) == rows_of(
        spark.createDataFrame([(1, 7, "c"), (2, None, "d"), (None, 2, "f")], df.schema)
    )


def test_full_ties_are_settled_by_the_other_columns(spark):
    rows = [(1, 1, "a"), (1, 1, "c"), (1, 1, "b")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "id int, v int, x string").repartition(3)
        assert rows_of(latest_per_key(df, ["id"], ["v"])) == [(1, 1, "c")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    latest = latest_per_key(df, ["k"], ["v"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("functions=[max(") < plan.index("Exchange") < plan.index("partial_max(")
    assert latest.filter("k = -1").first()["v"] == 19_998


def test_lag_skips_missing_months(spark):
    months = [dt.date(2026, 1, 1), dt.date(2026, 3, 1)]
    df = spark.createDataFrame([(1, months[1], 5.0), (1, months[0], 2.0)], "a int, m date, x double")
    got = with_previous(df, ["a"], "m", {"p": "x"}).orderBy("m").collect()
    assert [r["p"] for r in got] == [None, 2.0]


def brute_rank(rows):
    """Rank of each (group, value) by counting greater values; NULL comes last."""
    key = lambda v: float("-inf") if v is None else v
    return sorted(
        ((g, v, 1 + sum(1 for h, w in rows if h == g and key(w) > key(v))) for g, v in rows),
        key=repr,
    )


def test_rank_ties_share_and_leave_gaps(spark):
    rows = [("m", 5.0), ("m", 5.0), ("m", 1.0), ("m", None), ("n", 1.0), (None, 2.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for splits in (1, 2, 64):
        assert rows_of(rank_in_group(df, ["g"], "v", "r", splits)) == brute_rank(rows)


@SLOW
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b"]), st.one_of(st.none(), st.integers(-3, 3).map(float))),
        min_size=1,
        max_size=60,
    ),
    st.integers(2, 9),
)
def test_rank_equals_brute_force(spark, rows, splits):
    df = spark.createDataFrame(rows, "g string, v double")
    assert rows_of(rank_in_group(df, ["g"], "v", "r", splits)) == brute_rank(rows)


def test_rank_spreads_a_hot_group_and_a_hot_value(spark):
    """One month holds nearly all rows and a third of them tie at zero."""
    n = 6_000
    df = spark.range(n).select(
        F.lit("m").alias("g"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id").cast("double")).alias("v"),
        "id",
    )
    ranked = rank_in_group(df, ["g"], "v", "r", 16)
    assert ranked.count() == n
    assert ranked.filter("v = 0").select("r").distinct().collect()[0][0] == 2 * n // 3 + 1
    assert ranked.agg(F.min("r")).first()[0] == 1


def test_top_ranked_keeps_ties(spark):
    df = spark.createDataFrame([(1, 9.0), (2, 8.0), (3, 8.0), (4, 1.0)], "a int, v double")
    got = top_ranked(df.withColumn("g", F.lit(1)), ["g"], "v", 2, "r")
    assert rows_of(got, "a", "r") == [(1, 1), (2, 2), (3, 2)]
