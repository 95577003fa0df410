"""The whole run on files: reruns, late arrivals, drift, checks, streaming."""

import csv
import datetime as dt

import pytest

from advisorbook.contracts import CUSTOMERS, PORTFOLIO_HISTORY, PRODUCTS
from advisorbook.operators.reconcile import rerun_drift
from advisorbook.plans import daily
from advisorbook.streaming.arrivals import load_arrivals
from tests.frames import FUNDS, day, rows_of

AS_OF = dt.date(2026, 6, 1)


def write_csv(path, columns, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as f:
        writer = csv.DictWriter(f, columns)
        writer.writeheader()
        writer.writerows(rows)


def entry(i, date, balance, agent=1, customer=10, product=1, **more):
    return {
        "id": i,
        "agent_id": agent,
        "selling_agent_id": agent,
        "product_id": product,
        "unit_holder_id": customer,
        "date": date,
        "created_at": f"{date} 01:00:00",
        "updated_at": f"{date} 02:00:00",
        "ending_balance": balance,
        "is_deleted": "False",
        **more,
    }


@pytest.fixture
def world(spark, tmp_path):
    for table in (daily.FACT, daily.RAW_HISTORY, daily.RAW_CUSTOMERS, daily.RAW_PRODUCTS,
                  daily.DIM_AGENT, daily.DIM_CUSTOMER, daily.DIM_PRODUCT):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    for name in ("raw", "marts"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    write_csv(
        tmp_path / "products.csv",
        list(PRODUCTS),
        [{"id": i, "hpfid": f"F{i}", "sid": f"S{i}", "name": name} for i, name, _, _ in FUNDS],
    )
    write_csv(
        tmp_path / "customers.csv",
        list(CUSTOMERS),
        [
            {"customer_id": c, "unit_holder_id": c, "agent_id": a, "branch_name": b,
             "approved_kyc_at": "2025-12-31 10:00:00"}
            for c, a, b in ((10, 1, "North"), (11, 2, ""))
        ],
    )
    columns = list(PORTFOLIO_HISTORY)
    january = [
        entry(1, "2026-01-05", 150_000_000),
        entry(2, "2026-01-20", 60_000_000, agent=2, customer=11, product=3),
    ]
    april = [
        entry(1, "2026-01-05", 150_000_000),
        entry(2, "2026-01-20", 70_000_000, agent=2, customer=11, product=3),
        entry(3, "2026-02-10", 90_000_000, agent=2, customer=11, product=6),
        entry(4, "2026-04-01", 10_000_000),
    ]
    write_csv(tmp_path / "snapshots" / "hist_2026-01-26.csv", columns, january)
    write_csv(
        tmp_path / "snapshots" / "hist_20260401.csv",
        [*columns, "risk_score"],
        [{**r, "risk_score": 3} for r in april],
    )

    def settings(**more):
        return daily.Settings(
            snapshot_folder=str(tmp_path / "snapshots"),
            customers_csv=str(tmp_path / "customers.csv"),
            products_csv=str(tmp_path / "products.csv"),
            warehouse=str(tmp_path / "warehouse"),
            as_of=AS_OF,
            **more,
        )

    return tmp_path, settings


def add_snapshot(folder, name, rows):
    write_csv(folder / "snapshots" / name, list(PORTFOLIO_HISTORY), rows)


def fact(spark):
    return rows_of(spark.table(daily.FACT).drop("updated_at"))


def totals(spark):
    rows = spark.table(daily.FACT).collect()
    return {(r["agent_id"], r["month_start_date"].month): r["total_aum"] for r in rows}


def test_run_builds_every_layer(spark, world):
    _, settings = world
    result = daily.run_daily(spark, settings())
    assert result["summary"] == {"history_rows": 6, "rows_processed": 6 + 2 + len(FUNDS)}
    assert rows_of(result["metrics"], "snapshot_date", "rows_input") == [
        (day("2026-01-26"), 2),
        (day("2026-04-01"), 4),
    ]
    assert totals(spark) == {(1, 1): 150e6, (2, 1): 70e6, (2, 2): 90e6, (1, 4): 10e6}
    assert "risk_score" in spark.table(daily.RAW_HISTORY).columns
    report = spark.table(daily.REPORT)
    assert rows_of(report, "agent_name", "month_start_date", "rank_aum_in_month", "portfolio_profile") == [
        ("Agent 2", day("2026-01-01"), 2, "Fixed Income Heavy"),
        ("Agent 2", day("2026-02-01"), 1, "Fixed Income Heavy"),
        ("North", day("2026-01-01"), 1, "Equity Heavy"),
        ("North", day("2026-04-01"), 1, "Equity Heavy"),
    ]
    assert spark.table("stg_portfolio").count() == 4
    assert {r["status"] for r in result["checks"]} == {"pass"}
    assert rows_of(spark.table(daily.DIM_CUSTOMER), "customer_id", "kyc_tenure_days") == [
        (10, 151),
        (11, 151),
    ]


def test_reruns_change_only_the_load_stamp(spark, world):
    _, settings = world
    daily.run_daily(spark, settings())
    first = fact(spark)
    kept = spark.createDataFrame(spark.table(daily.FACT).collect(), spark.table(daily.FACT).schema)
    for _ in range(2):
        daily.run_daily(spark, settings())
        assert fact(spark) == first
    drift = rerun_drift(kept, spark.table(daily.FACT), "updated_at").first()
    assert drift["rows_after"] == 4 and drift["aum_drift_rows"] == 0
    assert drift["rows_with_changed_ts"] == 2


def test_late_rows_inside_and_outside_the_lookback(spark, world):
    folder, settings = world
    daily.run_daily(spark, settings())
    add_snapshot(
        folder,
        "hist_2026-04-10.csv",
        [
            entry(8, "2026-01-31", 250_000_000, product=2),
            entry(9, "2026-02-20", 250_000_000, product=2),
        ],
    )
    daily.run_daily(spark, settings())
    assert totals(spark) == {
        (1, 1): 150e6, (2, 1): 70e6, (2, 2): 90e6, (1, 2): 250e6, (1, 4): 10e6,
    }
    daily.run_daily(spark, settings(full_refresh=True))
    assert totals(spark)[(1, 1)] == 400e6


def test_runs_by_changes_equal_a_full_refresh_in_any_order(spark, world):
    folder, settings = world
    late = (folder / "snapshots" / "hist_2026-01-26.csv").rename(folder / "late.csv")
    daily.run_daily(spark, settings(by_changes=True))
    add_snapshot(
        folder,
        "hist_2026-04-10.csv",
        [
            entry(1, "2026-01-05", 20_000_000, agent=2),
            entry(3, "2026-02-10", 90_000_000, agent=2, customer=11, product=6, is_deleted="True"),
            entry(8, "2026-01-31", 250_000_000, product=2),
        ],
    )
    daily.run_daily(spark, settings(by_changes=True))
    files = set(spark.table(daily.RAW_HISTORY).inputFiles())
    late.rename(folder / "snapshots" / "hist_2026-01-26.csv")
    daily.run_daily(spark, settings(by_changes=True))
    assert files < set(spark.table(daily.RAW_HISTORY).inputFiles())

    def tables():
        names = (daily.FACT, daily.DIM_AGENT, daily.RAW_LATEST, daily.REPORT, daily.RAW_HISTORY)
        frames = [spark.table(n) for n in names]
        return [rows_of(f, *sorted(c for c in f.columns if c not in ("updated_at", "_bucket"))) for f in frames]

    kept = tables()
    assert totals(spark) == {(2, 1): 90e6, (1, 1): 250e6, (1, 4): 10e6}
    daily.run_daily(spark, settings(full_refresh=True))
    assert tables() == kept


def test_corrected_files_are_loaded_when_named(spark, world):
    folder, settings = world
    daily.run_daily(spark, settings(by_changes=True))
    add_snapshot(folder, "hist_20260401.csv", [entry(4, "2026-04-01", 30_000_000)])
    daily.run_daily(spark, settings(by_changes=True))
    assert totals(spark)[(1, 4)] == 10e6
    daily.run_daily(spark, settings(by_changes=True, reload_dates=(dt.date(2026, 4, 1),)))
    assert totals(spark)[(1, 4)] == 30e6 and totals(spark)[(2, 2)] == 90e6


def test_a_fault_in_the_data_fails_the_run(spark, world):
    folder, settings = world
    add_snapshot(folder, "hist_2026-04-02.csv", [entry(7, "2026-04-01", 5, product=99)])
    with pytest.raises(ValueError, match="kpis.allocation_reconciles"):
        daily.run_daily(spark, settings())


def test_no_rows_stops_the_run_before_the_models(spark, world):
    folder, settings = world
    for name in ("hist_2026-01-26.csv", "hist_20260401.csv"):
        write_csv(folder / "snapshots" / name, list(PORTFOLIO_HISTORY), [])
    with pytest.raises(ValueError, match="no rows|No snapshot rows"):
        daily.run_daily(spark, settings())
    assert not spark.catalog.tableExists(daily.FACT)


def test_arriving_files_are_loaded_once(spark, world):
    folder, settings = world
    daily.create_database(spark, "raw", str(folder / "warehouse" / "raw"))
    checkpoint = str(folder / "checkpoint")

    def run():
        query = load_arrivals(spark, str(folder / "snapshots"), daily.RAW_HISTORY, checkpoint)
        assert query.awaitTermination(120)
        return spark.table(daily.RAW_HISTORY).count()

    assert run() == 6
    assert run() == 6
    add_snapshot(folder, "hist_2026-04-10.csv", [entry(8, "2026-04-09", 1)])
    assert run() == 7
    add_snapshot(folder, "more_2026-04-10.csv", [entry(9, "2026-04-09", 1)])
    assert run() == 8
