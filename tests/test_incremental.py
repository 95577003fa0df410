import datetime as dt
import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from advisorbook.operators.incremental import (
    after,
    upsert,
    upsert_latest,
    upsert_versions,
    watermark,
)
from advisorbook.plans.kpis import monthly_kpis
from tests.frames import day, products, rows_of, staged


def months(spark, *values):
    return spark.createDataFrame([(day(v),) for v in values], "m date")


def test_watermark_boundary_is_strict(spark):
    mark = watermark(months(spark, "2026-02-01", "2026-04-01"), "m")
    assert mark == day("2026-01-01")
    kept = after(months(spark, "2026-01-01", "2026-02-01"), "m", mark)
    assert rows_of(kept) == [(day("2026-02-01"),)]


def test_watermark_of_an_empty_target(spark):
    assert watermark(months(spark), "m", 0) == day("1900-01-01")


def test_upsert_replaces_inserts_and_deletes_nothing(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, x string")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, x string")
    merged = upsert(target, source, ["k"])
    assert rows_of(merged) == [(1, "a"), (2, "B"), (3, "C"), (None, "N")]
    assert rows_of(upsert(merged, source, ["k"])) == rows_of(merged)


def test_upsert_takes_new_columns(spark):
    target = spark.createDataFrame([(1, "a")], "k int, x string")
    source = spark.createDataFrame([(2, "b", 5)], "k int, x string, risk int")
    assert rows_of(upsert(target, source, ["k"])) == [(1, "a", None), (2, "b", 5)]


def test_upsert_refuses_a_changed_type(spark):
    target = spark.createDataFrame([(1, "a")], "k int, x string")
    source = spark.createDataFrame([(1, 2)], "k int, x int")
    with pytest.raises(ValueError, match="x: string -> int"):
        upsert(target, source, ["k"])


def snapshot(spark, date, *rows):
    return spark.createDataFrame([(k, day(date), x) for k, x in rows], "k int, s date, x string")


def test_history_rerun_updates_in_place(spark):
    target = snapshot(spark, "2026-01-10", (1, "a"), (2, "b"))
    again = snapshot(spark, "2026-01-10", (2, "B"))
    later = snapshot(spark, "2026-01-26", (2, "c"))
    merged = upsert_versions(upsert_versions(target, again, ["k", "s"]), later, ["k", "s"])
    assert rows_of(merged, "k", "x") == [(1, "a"), (2, "B"), (2, "c")]


def test_latest_is_not_replaced_by_an_older_snapshot(spark):
    target = snapshot(spark, "2026-01-26", (1, "new"))
    merged = upsert_latest(target, snapshot(spark, "2026-01-10", (1, "old"), (2, "x")), ["k"], "s")
    assert rows_of(merged, "k", "x") == [(1, "new"), (2, "x")]
    same_day = upsert_latest(merged, snapshot(spark, "2026-01-26", (1, "fixed")), ["k"], "s")
    assert rows_of(same_day, "k", "x") == [(1, "fixed"), (2, "x")]


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.lists(st.integers(1, 4), unique=True, min_size=1), min_size=2, max_size=3))
def test_latest_does_not_depend_on_loading_order(spark, keys_per_snapshot):
    loads = [
        snapshot(spark, f"2026-01-0{i}", *[(k, f"{k}@{i}") for k in keys])
        for i, keys in enumerate(keys_per_snapshot, 1)
    ]
    results = set()
    for order in itertools.permutations(loads):
        target = order[0]
        for source in order[1:]:
            target = upsert_latest(target, source, ["k"], "s")
        results.add(tuple(rows_of(target)))
    assert len(results) == 1


def test_incremental_equals_full_refresh_above_the_watermark(spark):
    old = [
        {"id": 1, "date": "2026-01-05"},
        {"id": 2, "date": "2026-02-05"},
        {"id": 3, "date": "2026-04-05"},
    ]
    late = [
        {"id": 4, "date": "2026-01-20", "product_id": 2, "snapshot": "2026-04-20"},
        {"id": 5, "date": "2026-02-20", "product_id": 2, "snapshot": "2026-04-20"},
    ]
    catalogue = products(spark)
    target = monthly_kpis(staged(spark, *old), catalogue)
    mark = watermark(target, "month_start_date")
    source = monthly_kpis(staged(spark, *old, *late), catalogue, since=mark)
    merged = upsert(target, source, ["agent_id", "month_start_date"])
    totals = {r["month_start_date"].month: r["total_aum"] for r in merged.collect()}
    assert totals == {1: 100.0, 2: 200.0, 4: 100.0}
    full = monthly_kpis(staged(spark, *old, *late), catalogue)
    above = F.col("month_start_date") > F.lit(mark)
    assert rows_of(merged.filter(above)) == rows_of(full.filter(above))


def test_a_month_that_lost_all_rows_keeps_its_old_row(spark):
    catalogue = products(spark)
    before = [{"id": 1, "date": "2026-03-05"}, {"id": 2, "date": "2026-04-05"}]
    gone = [*before, {"id": 1, "date": "2026-03-05", "is_deleted": True, "snapshot": "2026-04-20"}]
    target = monthly_kpis(staged(spark, *before), catalogue)
    rerun = monthly_kpis(staged(spark, *gone), catalogue)
    merged = upsert(target, rerun, ["agent_id", "month_start_date"])
    assert rows_of(merged, "month_start_date") == [(dt.date(2026, 3, 1),), (dt.date(2026, 4, 1),)]
    assert rows_of(rerun, "month_start_date") == [(dt.date(2026, 4, 1),)]
