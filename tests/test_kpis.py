import datetime as dt

import pytest
from pyspark.sql import functions as F

from advisorbook.plans.dimensions import dim_agent, dim_customer
from advisorbook.plans.kpis import monthly_kpis, total_aum
from advisorbook.plans.performance import monthly_performance, top_agents_latest_month
from advisorbook.plans.staging import stage_customers, stage_portfolio
from tests.frames import FUNDS, day, products, raw, raw_customers, rows_of, staged

MILLION = 1_000_000.0
JAN, FEB, MAR, APR = (dt.date(2026, m, 1) for m in (1, 2, 3, 4))


def kpis(spark, *rows, **options):
    return monthly_kpis(staged(spark, *rows), products(spark), **options)


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_funds_get_the_class_of_the_first_matching_rule(spark):
    got = rows_of(products(spark), "product_id", "asset_class", "asset_class_bucket")
    assert got == sorted(((i, c, b) for i, _, c, b in FUNDS), key=repr)


def test_staging_columns_and_latest_version(spark):
    df = stage_portfolio(
        raw(
            spark,
            {"id": 1, "ending_balance": 1.0},
            {"id": 1, "ending_balance": 2.0, "snapshot": "2026-01-26"},
        )
    )
    row = only(df)
    assert row["ending_balance"] == 2.0 and row["snapshot_date"] == day("2026-01-26")
    assert len(df.columns) == 24 and df.columns[-1] == "is_active_entry"


def test_deleted_latest_version_removes_the_id_but_not_the_agent(spark):
    rows = ({"id": 1}, {"id": 1, "is_deleted": True, "snapshot": "2026-01-26"})
    assert kpis(spark, *rows).isEmpty()
    agents = dim_agent(staged(spark, *rows), raw_customers(spark))
    assert rows_of(agents, "agent_id", "agent_name") == [(1, "Agent 1")]


def test_earlier_id_is_month_end_when_the_later_one_is_deleted(spark):
    got = kpis(
        spark,
        {"date": "2026-01-05", "ending_balance": 7.0},
        {"date": "2026-01-20", "ending_balance": 9.0, "is_deleted": True},
    )
    assert only(got)["total_aum"] == 7.0


def test_null_flag_and_null_balance_do_not_count(spark):
    got = kpis(
        spark,
        {"date": "2026-01-05", "ending_balance": 7.0},
        {"date": "2026-01-20", "ending_balance": None},
        {"product_id": 2, "is_deleted": None},
    )
    assert only(got)["total_aum"] == 7.0 and only(got)["month_end_positions"] == 1


def test_month_end_tie_goes_to_the_higher_id(spark):
    got = kpis(spark, {"id": 8, "ending_balance": 8.0}, {"id": 9, "ending_balance": 3.0})
    assert only(got)["total_aum"] == 3.0


def test_same_id_twice_in_one_snapshot_is_settled_the_same_way_everywhere(spark):
    rows = ({"id": 1, "ending_balance": 4.0}, {"id": 1, "ending_balance": 6.0})
    for order in (rows, rows[::-1]):
        assert only(kpis(spark, *order))["total_aum"] == 6.0
        assert only(stage_portfolio(raw(spark, *order)))["ending_balance"] == 6.0


def test_shift_moves_an_entry_to_the_next_month(spark):
    got = kpis(spark, {"date": "2026-01-31 08:59:59"}, {"id": 2, "date": "2026-01-31 09:00:00"})
    assert rows_of(got, "month_start_date") == [(JAN,), (FEB,)]


def test_threshold_is_strict_and_spans_products(spark):
    got = kpis(
        spark,
        {"unit_holder_id": 10, "ending_balance": 100 * MILLION},
        {"unit_holder_id": 11, "ending_balance": 100 * MILLION + 1},
        {"unit_holder_id": 12, "ending_balance": 60 * MILLION},
        {"unit_holder_id": 12, "ending_balance": 60 * MILLION, "product_id": 2},
    )
    row = only(got)
    assert row["core_customer_count"] == 2 and row["total_customer_count"] == 3
    assert row["distinct_products_held"] == 2 and row["month_end_positions"] == 4
    assert row["core_customer_threshold_idr"] == 100_000_000


def test_small_digits_of_balances_count(spark):
    part = 33_333_333.3349
    got = only(kpis(spark, *({"id": k, "unit_holder_id": 10, "ending_balance": part, "product_id": k} for k in (1, 2, 3))))
    assert got["total_aum"] == 100_000_000.0047 and got["core_customer_count"] == 1


def test_a_balance_that_does_not_fit_is_named(spark):
    with pytest.raises(Exception, match="Balance does not fit"):
        kpis(spark, {"ending_balance": 1e25}).collect()


def test_buckets_and_unmatched_product(spark):
    got = kpis(
        spark,
        {"product_id": 1, "ending_balance": 10.0},
        {"product_id": 3, "ending_balance": 20.0},
        {"product_id": 11, "ending_balance": 30.0},
        {"product_id": 99, "ending_balance": 40.0},
        {"product_id": None, "ending_balance": 100.0},
    )
    row = only(got)
    assert (row["total_aum"], row["aum_equity_campuran"]) == (200.0, 40.0)
    assert (row["aum_fixed_income"], row["aum_unknown_class"]) == (20.0, 140.0)
    assert (row["pct_equity_campuran"], row["pct_fixed_income"]) == (0.2, 0.1)
    assert row["distinct_products_held"] == 4 and row["month_end_positions"] == 5


def test_agent_change_counts_the_customer_twice(spark):
    got = kpis(spark, {"agent_id": 1, "date": "2026-01-02"}, {"agent_id": 2, "date": "2026-01-20"})
    assert rows_of(got, "agent_id", "total_customer_count") == [(1, 1), (2, 1)]


def test_null_customer_and_null_agent(spark):
    got = kpis(
        spark,
        {"unit_holder_id": None, "ending_balance": 5.0},
        {"agent_id": None, "ending_balance": 200 * MILLION},
    )
    assert rows_of(got, "agent_id", "total_aum", "core_customer_count", "total_customer_count") == [
        (1, 5.0, 0, 0),
        (None, 200 * MILLION, 0, 0),
    ]


def test_as_of_drops_later_entries_and_since_is_strict(spark):
    rows = [{"product_id": i, "date": f"2026-0{i}-05"} for i in (1, 2, 3)]
    assert rows_of(kpis(spark, *rows, as_of=day("2026-02-28")), "month_start_date") == [(JAN,), (FEB,)]
    assert rows_of(kpis(spark, *rows, since=JAN), "month_start_date") == [(FEB,), (MAR,)]


def test_totals_alone_equal_the_fact(spark):
    entries = staged(spark, *[{"product_id": i, "ending_balance": i + 0.01} for i in range(1, 9)])
    fact = monthly_kpis(entries, products(spark))
    assert rows_of(total_aum(entries)) == rows_of(fact, "agent_id", "month_start_date", "total_aum")


def report(spark, *rows, names=(), splits=4):
    entries = staged(spark, *rows)
    agents = dim_agent(entries, raw_customers(spark, *names))
    return monthly_performance(monthly_kpis(entries, products(spark)), agents, splits)


def test_report_changes_over_a_gap_and_from_zero(spark):
    got = report(
        spark,
        {"date": "2026-01-05", "ending_balance": 0.0},
        {"date": "2026-03-05", "ending_balance": 50.0},
        {"date": "2026-04-05", "ending_balance": 25.0},
    ).orderBy("month_start_date")
    assert [tuple(r) for r in got.select("aum_mom_change_idr", "aum_mom_change_pct").collect()] == [
        (None, None),
        (50.0, None),
        (-25.0, -0.5),
    ]


def test_report_profiles_use_unrounded_shares(spark):
    def profile(fixed, equity):
        got = report(
            spark,
            {"product_id": 3, "ending_balance": fixed},
            {"product_id": 1, "ending_balance": equity},
        )
        row = only(got)
        return row["portfolio_profile"], row["pct_fixed_income"]

    assert profile(60.0, 40.0) == ("Fixed Income Heavy", 0.6)
    assert profile(59_996.0, 40_004.0) == ("Balanced", 0.6)
    assert profile(10.0, 90.0)[0] == "Equity Heavy"
    assert profile(0.0, 0.0) == ("No AUM", None)
    assert profile(-1.0, 0.0) == ("Balanced", None)


def test_report_ranks_and_names(spark):
    rows = [{"agent_id": a, "ending_balance": v} for a, v in ((1, 9.0), (2, 9.0), (3, 1.0))]
    names = (
        {"customer_id": 1, "agent_id": 1, "branch_name": "North"},
        {"customer_id": 2, "agent_id": 1, "branch_name": "East"},
    )
    got = report(spark, *rows, names=names)
    assert rows_of(got, "agent_id", "agent_name", "rank_aum_in_month") == [
        (1, "East", 1),
        (2, "Agent 2", 1),
        (3, "Agent 3", 3),
    ]


def test_top_agents_may_exceed_k(spark):
    rows = [{"agent_id": a, "ending_balance": 5.0, "date": "2026-02-05"} for a in range(1, 8)]
    entries = staged(spark, *rows, {"agent_id": 9, "ending_balance": 99.0})
    fact = monthly_kpis(entries, products(spark))
    top = top_agents_latest_month(fact, dim_agent(entries, raw_customers(spark)))
    assert rows_of(top, "agent_id", "rank") == [(a, 1) for a in range(1, 8)]


def test_agent_dimension_activity(spark):
    entries = staged(
        spark,
        {"agent_id": 1, "date": "2026-01-05"},
        {"agent_id": 1, "date": "2026-02-05", "product_id": 2, "unit_holder_id": 11},
        {"agent_id": 2, "date": "2026-01-01", "is_deleted": True},
        {"agent_id": None, "date": "2026-01-01"},
    )
    got = dim_agent(entries, raw_customers(spark, {"agent_id": None, "branch_name": "Lost"}))
    assert rows_of(got) == [
        (1, "Agent 1", day("2026-01-05"), day("2026-02-05"), 2, 2, True),
        (2, "Agent 2", day("2026-01-01"), day("2026-01-01"), 1, 1, False),
        (None, None, day("2026-01-01"), day("2026-01-01"), 1, 1, False),
    ]


@pytest.mark.parametrize("approved, tenure", [("2026-01-31 10:00:00", 28), (None, None)])
def test_customer_tenure_counts_from_the_business_day(spark, approved, tenure):
    staged_customers = stage_customers(
        raw_customers(spark, {"customer_id": 1, "approved_kyc_at": approved})
    )
    got = dim_customer(staged_customers, F.lit("2026-03-01").cast("date"))
    assert rows_of(got, "kyc_tenure_days") == [(tenure,)]
