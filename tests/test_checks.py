import datetime as dt

import pytest
from pyspark.sql import functions as F

from advisorbook.operators import checks
from advisorbook.operators.profiling import detect_business_key, profile_columns
from advisorbook.operators.reconcile import rerun_drift, split_differences
from advisorbook.plans.kpis import core_customers, month_end_entries, monthly_kpis
from advisorbook.plans.quality import standard_report
from tests.frames import day, products, raw, raw_customers, rows_of, staged

PATTERNS = (r"(^|_)id$", r"_key$")


def test_row_checks(spark):
    df = spark.createDataFrame([(1, -1.0), (None, None), (2, 3.0)], "k int, v double")
    assert rows_of(checks.not_null(df, "k")) == [(None, None)]
    assert rows_of(checks.non_negative(df, "v")) == [(1, -1.0)]
    assert rows_of(checks.accepted_values(df, "k", [1])) == [(2, 1)]


def test_future_dates_with_tolerance(spark):
    df = spark.createDataFrame([("2026-01-01 10:00:00",), ("2026-01-01 13:00:00",)], "s string")
    df = df.select(F.col("s").cast("timestamp_ntz").alias("t"))
    noon = F.lit("2026-01-01 09:00:00").cast("timestamp_ntz")
    assert checks.no_future_dates(df, "t", noon).count() == 2
    assert checks.no_future_dates(df, "t", noon, 1).count() == 1
    assert checks.no_future_dates(df, "t", noon, 4).count() == 0


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, x string")
    assert rows_of(checks.unique(df, "k")) == [(1, 3)]
    assert rows_of(checks.unique_combination(df, ["k", "x"])) == [(1, "a", 2), (None, "c", 2)]


def test_relationships_ignore_null_children(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(1,), (None,)], "p int")
    assert rows_of(checks.relationships(child, "p", parent, "p")) == [(2,)]


def fact(spark, *rows):
    return monthly_kpis(staged(spark, *rows), products(spark))


def test_allocation_and_split_find_unclassified_money(spark):
    clean = fact(spark, {"product_id": 1})
    assert checks.allocation_reconciles(clean).isEmpty()
    dirty = fact(spark, {"product_id": 1}, {"product_id": 99})
    assert rows_of(checks.allocation_reconciles(dirty), "aum_unknown_class") == [(100.0,)]
    assert rows_of(split_differences(dirty), "diff") == [(0.0,)]
    off = clean.withColumn("total_aum", F.col("total_aum") + 1.5)
    assert rows_of(checks.allocation_reconciles(off), "bucket_sum") == [(100.0,)]
    within = clean.withColumn("total_aum", F.col("total_aum") + 1.0)
    assert checks.allocation_reconciles(within).isEmpty()


def test_core_counts_missing_as_zero_or_literal(spark):
    rows = ({"agent_id": 1}, {"agent_id": 2, "ending_balance": 2e8})
    expected = core_customers(month_end_entries(staged(spark, *rows)))
    kpis = fact(spark, *rows)
    assert checks.core_counts_reconcile(expected, kpis).isEmpty()
    literal = checks.core_counts_reconcile(expected, kpis, missing=-1)
    assert rows_of(literal, "agent_id", "expected_core_count", "core_customer_count") == [(1, None, 0)]
    wrong = kpis.withColumn("core_customer_count", F.lit(5).cast("bigint"))
    assert checks.core_counts_reconcile(expected, wrong).count() == 2


def test_positions_bound_and_future_month(spark):
    kpis = fact(spark, {"product_id": 1}, {"product_id": 2})
    assert checks.positions_within_bounds(kpis).isEmpty()
    assert checks.positions_within_bounds(kpis, 1).count() == 1
    assert checks.no_future_months(kpis, F.lit("2025-12-31").cast("date")).count() == 1
    assert checks.no_future_months(kpis, F.lit("2026-01-01").cast("date")).isEmpty()


def test_rerun_drift_counts(spark):
    kpis = fact(spark, {"agent_id": 1}, {"agent_id": 2}).withColumn("at", F.lit(1))
    again = kpis.withColumn("at", F.lit(2))
    assert rows_of(rerun_drift(kpis, again, "at")) == [(2, 2, 0)]
    moved = again.withColumn("total_aum", F.when(F.col("agent_id") == 1, 0.0).otherwise(F.col("total_aum")))
    assert rows_of(rerun_drift(kpis, moved, "at")) == [(2, 2, 1)]


def test_report_status_and_gate(spark):
    df = spark.createDataFrame([(1, -1.0)], "k int, v double")
    report = checks.dq_report(
        [
            (
                df,
                [
                    checks.RowCheck("t.k.not_null", checks.is_missing("k")),
                    checks.RowCheck("t.v.non_negative", checks.is_negative("v"), checks.WARN),
                ],
            )
        ],
        [checks.SetCheck("t.k.unique", checks.unique(df, "k"))],
    )
    assert rows_of(report) == [
        ("t.k.not_null", "error", 0, "pass"),
        ("t.k.unique", "error", 0, "pass"),
        ("t.v.non_negative", "warn", 1, "warn"),
    ]
    checks.require_passed(report)
    failing = checks.dq_report([(df, [checks.RowCheck("t.v", checks.is_negative("v"))])])
    with pytest.raises(ValueError, match=r"t\.v \(1\)"):
        checks.require_passed(failing)


def test_empty_input_gate(spark):
    with pytest.raises(ValueError, match="history has no rows"):
        checks.require_rows(spark.range(0), "history")


def test_standard_report_passes_on_clean_data_and_finds_seeded_faults(spark):
    rows = [{"agent_id": 1, "unit_holder_id": 10}]
    masters = {"customer_id": 1, "unit_holder_id": 10, "agent_id": 1}

    def report(history, *customers, catalogue=None):
        entries = staged(spark, *history)
        return standard_report(
            history=raw(spark, *history),
            staged=entries,
            products=products(spark, catalogue),
            customers=raw_customers(spark, *customers),
            agents=entries.select("agent_id").distinct(),
            kpis=monthly_kpis(entries, products(spark, catalogue)),
            as_of=F.lit(dt.date(2026, 2, 1)),
        )

    clean = report(rows, masters)
    assert clean.filter("status <> 'pass'").isEmpty() and clean.count() == 30
    faulty = report(
        [*rows, {"agent_id": 1, "product_id": 99, "unit_holder_id": 77, "date": "2026-05-01"}],
        masters,
        masters,
        catalogue=[1, 2, 3],
    )
    found = {r["check_name"]: r["status"] for r in faulty.filter("status <> 'pass'").collect()}
    assert found == {
        "staged.portfolio_date.no_future_dates": "fail",
        "kpis.month_start_date.no_future_months": "fail",
        "customers.customer_id.unique": "fail",
        "staged.product_id.relationships": "fail",
        "staged.customer_id.relationships": "warn",
        "kpis.allocation_reconciles": "fail",
    }


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 5), (3, "a", 5)], "id int, User_ID string, v int")
    assert rows_of(profile_columns(df, PATTERNS)) == [
        ("User_ID", 1, 1 / 3, 1 / 3, "string"),
        ("id", 3, 1.0, 0.0, "int"),
    ]


def test_key_is_one_complete_nearly_unique_column(spark):
    df = spark.createDataFrame([(i, i, i % 2) for i in range(20)], "a_id int, id int, b_id int")
    assert detect_business_key(df, PATTERNS) == ["id"]
    assert detect_business_key(df.drop("id"), PATTERNS) == ["a_id"]


def test_key_of_several_columns(spark):
    df = spark.createDataFrame([(i // 4, i % 4, 1) for i in range(16)], "z_id int, y_id int, x_id int")
    assert detect_business_key(df, PATTERNS) == ["y_id", "z_id"]
    with_null = df.withColumn("y_id", F.when(F.col("y_id") > 0, F.col("y_id")))
    assert detect_business_key(with_null, PATTERNS) == ["z_id"]


def test_key_falls_back_to_all_candidates(spark):
    df = spark.createDataFrame([(1, 1)] * 20, "b_id int, a_id int")
    assert detect_business_key(df, PATTERNS) == ["a_id", "b_id"]


def test_key_needs_rows_and_candidates(spark):
    with pytest.raises(ValueError, match="without rows"):
        detect_business_key(spark.createDataFrame([], "id int"), PATTERNS)
    with pytest.raises(ValueError, match="No id-like column"):
        detect_business_key(spark.createDataFrame([(1,)], "v int"), PATTERNS)


def test_day_helper():
    assert day("2026-01-10") == dt.date(2026, 1, 10)
