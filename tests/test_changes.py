"""Tables kept up by changes: latest rows, the monthly fact, and recovery after a failure."""

import datetime as dt
import random
import time
import uuid
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from advisorbook.operators.latest import latest_per_key
from advisorbook.operators.reconcile import rerun_drift, rerun_drift_by_period
from advisorbook.plans import changes
from advisorbook.plans.changes import MaintainedFact, MaintainedReport
from advisorbook.plans.kpis import kpis_of_totals, monthly_kpis, position_totals, since_month
from advisorbook.plans.performance import performance_rows
from advisorbook.plans.staging import KPI_INPUTS, TIEBREAK, stage_portfolio
from advisorbook.session import SHUFFLE_CLEANUP, cut_lineage, work_path
from advisorbook.sources import change_log, history_table, latest_table
from advisorbook.sources.change_log import StagedChange, recover
from advisorbook.sources.history_table import HistoryTable
from advisorbook.sources.latest_table import LatestTable
from advisorbook.sources.tables import create_database, create_partitioned, merge_table, replace_partitions, replace_table
from advisorbook.sources.zones import ZoneTable
from tests.frames import products, raw, rows_of

COLUMNS = "id LONG, day DATE, value STRING"


@pytest.fixture
def database(spark):
    folder = work_path(spark, "changes")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    create_database(spark, name, folder)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def day(n):
    return dt.date(2026, 1, n)


def load(spark, database, rows, columns=COLUMNS):
    table = LatestTable(spark, f"{database}.latest", ["id"], "day", buckets=8)
    change = StagedChange(spark, f"{database}.log")
    feed = table.merge(spark.createDataFrame(rows, columns), change)
    changed = feed.count()
    change.commit()
    return changed


def files_of(spark, table):
    """Partition and name of each file."""
    return {Path(f).parts[-2:] for f in spark.table(table).inputFiles()}


def test_latest_rows_whatever_the_order_of_loading(spark, database):
    rng = random.Random(1)
    days = {d: [(i, day(d), f"{d}.{i}") for i in rng.sample(range(30), 12)] for d in range(1, 6)}
    days[3].append((None, day(3), "no id"))
    order = [4, 2, 5, 1, 3]
    for d in order:
        load(spark, database, days[d])
    every = spark.createDataFrame([r for rows in days.values() for r in rows], COLUMNS)
    assert rows_of(LatestTable(spark, f"{database}.latest", ["id"], "day").rows()) == rows_of(latest_per_key(every, ["id"], ["day"]))


def test_only_touched_buckets_are_read_and_written(spark, database):
    load(spark, database, [(i, day(5), "a") for i in range(100)])
    before = files_of(spark, f"{database}.latest")
    assert load(spark, database, [(7, day(6), "b")]) == 1
    after = files_of(spark, f"{database}.latest")
    changed = {bucket for bucket, _ in before - after}
    assert len(changed) == 1 and {bucket for bucket, _ in after - before} == changed
    some = LatestTable(spark, f"{database}.latest", ["id"], "day").rows([1, 2])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan.replace("isnotnull(_bucket), ", "") and set(
        Path(f).parent.name for f in some.inputFiles()
    ) <= {"_bucket=1", "_bucket=2"}


def test_loading_again_or_older_rows_writes_nothing(spark, database):
    rows = [(i, day(5), "a") for i in range(50)]
    load(spark, database, rows)
    before = files_of(spark, f"{database}.latest")
    assert load(spark, database, rows) == 0
    assert load(spark, database, [(i, day(4), "older") for i in range(50)]) == 0
    assert files_of(spark, f"{database}.latest") == before
    assert load(spark, database, [(3, day(5), "corrected")]) == 1


def test_new_columns_reach_the_latest_rows(spark, database):
    load(spark, database, [(1, day(1), "a"), (2, day(1), "b")])
    load(spark, database, [(2, day(2), "c", 5)], COLUMNS + ", score INT")
    load(spark, database, [(1, day(3), "d")])
    rows = LatestTable(spark, f"{database}.latest", ["id"], "day").rows()
    assert rows_of(rows, "id", "value", "score") == [(1, "d", None), (2, "c", 5)]


def test_a_change_that_failed_half_way_is_finished(spark, database, monkeypatch):
    load(spark, database, [(i, day(1), "a") for i in range(20)])
    apply, calls = change_log._apply, []

    def failing(spark, step):
        calls.append(step["name"])
        if len(calls) > 1:
            raise RuntimeError("lost")
        apply(spark, step)

    def stage():
        table = LatestTable(spark, f"{database}.latest", ["id"], "day")
        change = StagedChange(spark, f"{database}.log")
        table.merge(spark.createDataFrame([(3, day(2), "b")], COLUMNS), change)
        other = spark.createDataFrame([(1, "x")], "n INT, m STRING")
        if not spark.catalog.tableExists(f"{database}.other"):
            change_log_table(spark, f"{database}.other", other.schema)
        change.stage(other, f"{database}.other", "m", ["x", "y"])
        return change

    def change_log_table(spark, name, schema):
        spark.createDataFrame([(2, "y")], schema).write.partitionBy("m").format("parquet").saveAsTable(name)

    change = stage()
    # A failure before the log entry leaves no trace.
    assert recover(spark, f"{database}.log") == 0
    assert rows_of(spark.table(f"{database}.other")) == [(2, "y")]
    monkeypatch.setattr(change_log, "_apply", failing)
    with pytest.raises(RuntimeError, match="lost"):
        change.commit(["2026-01-02"])
    monkeypatch.setattr(change_log, "_apply", apply)
    assert rows_of(spark.table(f"{database}.other")) == [(2, "y")]
    assert recover(spark, f"{database}.log") == 1 and recover(spark, f"{database}.log") == 0
    assert rows_of(spark.table(f"{database}.other")) == [(1, "x")]
    assert change_log.notes(spark, f"{database}.log") == {"2026-01-02"}
    latest = LatestTable(spark, f"{database}.latest", ["id"], "day").rows()
    assert rows_of(latest.filter("id in (2, 3)"), "id", "value") == [(2, "a"), (3, "b")]


def test_history_writes_only_what_differs(spark, database):
    table = HistoryTable(spark, f"{database}.history", ["id", "day"], "day", ["value"])

    def merge(rows, columns=COLUMNS):
        change = StagedChange(spark, f"{database}.log")
        counts = table.merge(spark.createDataFrame(rows, columns), change)
        change.commit()
        return sorted((r["day"].day, r["kind"], r["n"]) for r in counts.collect())

    first = [(1, day(1), "a"), (2, day(1), "a"), (1, day(2), "b"), (None, day(2), "n"), (1, day(3), None), (1, day(1), "A")]
    assert merge(first) == [(1, "insert", 2), (2, "insert", 2), (3, "insert", 1)]
    before = files_of(spark, f"{database}.history")
    assert merge(first) == [(1, "same", 2), (2, "same", 2), (3, "same", 1)]
    assert files_of(spark, f"{database}.history") == before
    got = merge([(2, day(1), "x"), (3, day(1), "new"), (1, day(2), "b"), (None, day(2), "n")])
    assert got == [(1, "insert", 1), (1, "same", 1), (1, "update", 1), (2, "same", 2)]
    after = files_of(spark, f"{database}.history")
    assert {p for p, _ in before - after} == {p for p, _ in after - before} == {"day=2026-01-01"}
    assert merge([(1, day(3), None, 5)], COLUMNS + ", score INT") == [(3, "update", 1)]
    assert rows_of(table.rows(), "day", "id", "value", "score") == sorted([
        (day(1), 1, "a", None), (day(1), 2, "x", None), (day(1), 3, "new", None), (day(2), 1, "b", None),
        (day(2), None, "n", None), (day(3), 1, None, 5)], key=repr)


def scanned(frame):
    return "\n".join(x for x in frame._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)


def test_a_lookback_reads_only_the_partitions_it_needs(spark, database):
    rng = random.Random(9)
    days = {k: [{**r, "date": f"2026-{min(12, k + rng.randint(-2, 0) if k > 2 else k):02}-05"} for r in rows]
            for k, rows in enumerate(snapshots(rng, 8, 20), 1)}
    every = raw(spark, *[r for rows in days.values() for r in rows])
    replace_table(every, f"{database}.history", ["snapshot_date"])
    history = spark.table(f"{database}.history")
    zones = ZoneTable(spark, f"{database}.zones", "snapshot_date")
    zones.record(history, [day(k) for k in (1, 2, 3, 4)])
    zones.record(history, [day(k) for k in (4, 5, 6, 7, 8)])
    listed = products(spark)
    fact = monthly_kpis(stage_portfolio(every, KPI_INPUTS), listed)
    for month in (1, 4, 6, 8):
        since = dt.date(2026, month, 1)
        rows = zones.rows_since(history, since)
        got = monthly_kpis(stage_portfolio(rows, KPI_INPUTS), listed, since=since)
        assert rows_of(got) == rows_of(fact.filter(F.col("month_start_date") > since))
        read = {Path(f).parent.name for f in rows.inputFiles()}
        assert len(read) < 8 or month == 1
        if read:
            assert "PartitionFilters: [isnotnull(snapshot_date" in scanned(rows)
    merge_table(fact, f"{database}.fact", ["agent_id", "month_start_date"], "month_start_date")
    late = since_month(spark.table(f"{database}.fact"), dt.date(2026, 4, 1))
    assert "PartitionFilters: [isnotnull(month_start_date" in scanned(late)
    assert all(Path(f).parent.name >= "month_start_date=2026-04-01" for f in late.inputFiles())


def test_drift_joins_only_months_that_differ(spark, database):
    columns = "agent_id long, month_start_date date, total_aum double, updated_at date"
    months = [dt.date(2026, m, 1) for m in (1, 2, 3, 4)]
    rows = [(a, m, float(a or 0), day(1)) for a in (1, 2, 3, None) for m in months] + [(9, None, 1.0, day(1))]
    rerun = [(a, m, t + (m == months[1] and a == 2), day(2) if m == months[1] else s) for a, m, t, s in rows if m != months[3]]
    rerun += [(1, dt.date(2026, 9, 1), 5.0, day(1))]
    for name, made in (("old", rows), ("new", rerun), ("again", rows[::-1])):
        replace_table(spark.createDataFrame(made, columns), f"{database}.{name}", ["month_start_date"])
    old, new, again = (spark.table(f"{database}.{n}") for n in ("old", "new", "again"))
    drift = rerun_drift_by_period(old, new, "updated_at")
    assert rows_of(drift) == rows_of(rerun_drift(old, new, "updated_at")) == [(9, 3, 1)]
    assert {Path(f).parent.name for f in drift.inputFiles()} == {"month_start_date=2026-02-01"}
    unchanged = rerun_drift_by_period(old, again, "updated_at")
    assert rows_of(unchanged) == rows_of(rerun_drift(old, again, "updated_at")) == [(12, 0, 0)]
    assert "Join" not in unchanged._jdf.queryExecution().executedPlan().toString()
    empty = rerun_drift_by_period(old.limit(0), new.limit(0), "updated_at")
    assert rows_of(empty) == [(0, 0, 0)]


def snapshots(rng, n, ids):
    """Cumulative snapshots in which entries change balance, agent, product and month, come and go."""
    state = {}
    for k in range(n):
        for i in rng.sample(range(ids), ids // 3):
            state[i] = {
                "id": i,
                "agent_id": rng.choice([1, 2, 3, None]),
                "unit_holder_id": rng.choice([10, 11, 12, None]),
                "product_id": rng.choice([1, 2, 3, 6, 99]),
                "date": rng.choice(["2026-01-05", "2026-01-31 10:00:00", "2026-02-10", "2026-03-01", None]),
                "ending_balance": rng.choice([None, 5.25, 90e6, 120e6, -3.0, 0.0]),
                "is_deleted": rng.choice([False, False, False, True, None]),
            }
        yield [{**r, "snapshot": day(k + 1).isoformat()} for r in state.values()]


def test_fact_after_ten_increments_equals_a_full_build(spark, database):
    rng = random.Random(4)
    loads = list(snapshots(rng, 10, 24))
    rng.shuffle(loads)
    seen, listed = [], products(spark)
    for k, rows in enumerate(loads):
        frame = raw(spark, *rows)
        change = StagedChange(spark, f"{database}.log")
        feed = LatestTable(spark, f"{database}.latest", ["id"], "ingested_at", TIEBREAK, buckets=4).merge(frame, change)
        fact = MaintainedFact(spark, f"{database}.entries", f"{database}.totals", f"{database}.fact")
        months, facts = fact.apply(feed, listed, change)
        MaintainedReport(spark, f"{database}.fact", f"{database}.report", f"{database}.carry").apply(months, facts, change)
        change.commit()
        seen += rows
        if k in (0, 3, 6, 9):
            full = cut_lineage(monthly_kpis(stage_portfolio(raw(spark, *seen), KPI_INPUTS), listed), "full")
            assert rows_of(spark.table(f"{database}.fact").select(*full.columns)) == rows_of(full)
            report = performance_rows(full)
            assert rows_of(spark.table(f"{database}.report").select(*report.columns)) == rows_of(report)


def test_report_over_gaps_and_late_months(spark, database):
    """Few months change at a time, with gaps between an agent's months; facts are made directly."""
    columns = "agent_id long, month_start_date date, total_aum double, core_customer_count long"
    more = ("aum_equity_campuran", "aum_fixed_income", "pct_equity_campuran", "pct_fixed_income",
            "total_customer_count", "distinct_products_held", "month_end_positions")
    rng, stored = random.Random(5), {}

    def frame(rows):
        made = spark.createDataFrame([(a, m, *v) for (a, m), v in rows.items()], columns)
        return made.withColumns({c: F.lit(0.5) for c in more[:4]} | {c: F.lit(1).cast("long") for c in more[4:]})

    calendar = [dt.date(2025, m, 1) for m in range(1, 13)]
    replace_table(frame({(1, calendar[0]): (1.0, 1)}).limit(0), f"{database}.fact", ["month_start_date"])
    for months in (calendar[2:5], [calendar[9]], [calendar[10], None], [calendar[0]], [calendar[4], calendar[7]], [calendar[11]], [calendar[10]]):
        new = {(a, m): (float(rng.randint(0, 9)), rng.randint(0, 5)) for m in months for a in (1, 2, 3, 4, None) if rng.random() < 0.5}
        change = StagedChange(spark, f"{database}.log")
        facts = change.stage(frame(new), f"{database}.fact", "month_start_date", months)
        MaintainedReport(spark, f"{database}.fact", f"{database}.report", f"{database}.carry").apply(months, facts, change)
        change.commit()
        stored = {k: v for k, v in stored.items() if k[1] not in months} | new
        rebuilt = performance_rows(cut_lineage(frame(stored), "facts"))
        assert rows_of(spark.table(f"{database}.report").select(*rebuilt.columns)) == rows_of(rebuilt)


def test_months_without_a_change_are_left_and_emptied_months_go(spark, database):
    def step(rows, listed=products(spark), reclassified=None):
        change = StagedChange(spark, f"{database}.log")
        feed = LatestTable(spark, f"{database}.latest", ["id"], "ingested_at", TIEBREAK, buckets=4).merge(raw(spark, *rows), change)
        fact = MaintainedFact(spark, f"{database}.entries", f"{database}.totals", f"{database}.fact")
        fact.apply(feed, listed, change, reclassified)
        change.commit()
        return files_of(spark, f"{database}.fact")

    first = step([{"id": 1}, {"id": 2, "date": "2026-02-05"}, {"id": 3, "date": "2026-03-05", "product_id": 3}])
    second = step([{"id": 2, "date": "2026-02-05", "is_deleted": True, "snapshot": "2026-01-20"}])
    assert {month for month, _ in second} == {"month_start_date=2026-01-01", "month_start_date=2026-03-01"}
    assert second <= first
    # A product in another bucket folds its months again, without any changed entry.
    moved = products(spark).withColumn("asset_class_bucket", F.lit("fixed_income"))
    step([], moved, spark.createDataFrame([(1,)], "product_id LONG"))
    got = spark.table(f"{database}.fact").select("month_start_date", "aum_fixed_income", "aum_equity_campuran")
    assert [(r[0].month, r[1], r[2]) for r in got.orderBy("month_start_date").collect()] == [(1, 100.0, 0.0), (3, 100.0, 0.0)]


def test_merges_write_each_row_once_before_the_commit(spark, monkeypatch):
    """A first load writes only the staged rows; a second one also the rows that arrive. Repeated and NULL keys are settled as before."""
    written = []
    for module in (latest_table, history_table):
        kept = module.cut_lineage
        monkeypatch.setattr(module, "cut_lineage", lambda df, name, kept=kept: written.append(name) or kept(df, name))
    database = "merged_" + uuid.uuid4().hex
    create_database(spark, database, f"{work_path(spark, database)}/tables")
    first = [(1, 1, 5, "a"), (1, 1, 6, "b"), (1, 2, 1, "c"), (None, 1, 1, "d"), (2, None, 1, "e"), (3, 2, 1, "f")]
    second = [(1, 1, 9, "g"), (2, 1, 1, "h"), (2, 1, 2, "i"), (3, None, 1, "j"), (None, 1, 0, "k"), (4, None, None, None)]
    for rows in (first, second):
        frame = spark.createDataFrame(rows, "id long, version int, rank int, kind string")
        for table in (
            latest_table.LatestTable(spark, f"{database}.latest", ["id"], "version", ["rank"], buckets=3),
            history_table.HistoryTable(spark, f"{database}.history", ["id", "version"], "version", ["rank"]),
        ):
            change = StagedChange(spark, f"{database}.log")
            told = table.merge(frame, change)
            if isinstance(table, latest_table.LatestTable):
                changes = {r["id"]: (r["before"] and r["before"]["kind"], r["after"]["kind"]) for r in told.collect()}
            else:
                counts = {(r[0], r[1]): r[2] for r in told.collect()}
            change.commit()
    assert written == ["history-counts", "latest-source", "history-source", "history-counts"]
    assert changes == {2: ("e", "i"), None: ("d", "k"), 4: (None, None)}
    assert counts == {(1, "update"): 2, (1, "insert"): 1, (None, "insert"): 2, (None, "same"): 1}
    latest = {tuple(r) for r in spark.table(f"{database}.latest").drop("_bucket").select("id", "version", "rank", "kind").collect()}
    assert latest == {(1, 2, 1, "c"), (None, 1, 0, "k"), (2, 1, 2, "i"), (3, 2, 1, "f"), (4, None, None, None)}
    history = {tuple(r) for r in spark.table(f"{database}.history").select("id", "version", "rank", "kind").collect()}
    assert history == {(1, 1, 9, "g"), (1, 2, 1, "c"), (None, 1, 0, "k"), (2, None, 1, "e"), (3, 2, 1, "f"), (2, 1, 2, "i"), (3, None, 1, "j"), (4, None, None, None)}


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for folder in folders for f in Path(folder.getPath()).rglob("shuffle_*.data")}


def test_writes_leave_no_shuffle_files(spark, database):
    summed = spark.range(1000).groupBy("id").agg(F.max(F.col("id") % 3).alias("part"))
    create_partitioned(spark, f"{database}.kept", summed.schema, "part")
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    written = cut_lineage(summed, "kept")
    _, staged = StagedChange(spark, f"{database}.log").write(summed)
    replace_partitions(summed, f"{database}.kept")
    until = time.time() + 20  # executors are told, and not waited for
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) - before == set()
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert rows_of(written) == rows_of(staged) == rows_of(spark.table(f"{database}.kept").select("id", "part")) == rows_of(summed)


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_totals_are_added_in_one_shuffle_and_customers_stay_out_of_the_lookup(spark):
    columns = "month_start_date date, agent_id long, customer_id long, product_id long, aum decimal(28,8), positions long"
    first, rng = [], random.Random(6)
    for _ in range(60):
        ids = (rng.choice([1, 2, None]), rng.choice([10, 11, None]), rng.choice([1, 3, 99, None]))
        first.append((rng.choice([day(1), None]), *ids, Decimal(rng.randint(-3, 9)), rng.choice([1, 1, -1])))
    sums = (F.sum("aum"), F.sum("positions"))
    old, new = spark.createDataFrame(first[:40], columns), spark.createDataFrame(first[40:], columns)
    known = cut_lineage(position_totals(old, *sums), "known")
    added = position_totals(new, *sums, known=known)
    whole = position_totals(old.unionByName(new), *sums)
    names = ("agent_id", "month_start_date", "customer_id", "product_id", "aum", "positions", "is_product_total")
    assert rows_of(added, *names) == rows_of(whole, *names) and exchanges(added) == 1
    totals, listed = cut_lineage(added, "totals"), cut_lineage(products(spark), "listed")
    assert rows_of(kpis_of_totals(totals, listed, stored=True)) == rows_of(kpis_of_totals(whole, listed))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = kpis_of_totals(totals, listed, stored=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning(product_id" in plan and "hash(customer_id" not in plan


def test_moved_entries_are_not_written_again(spark, database, monkeypatch):
    written, kept = [], changes.cut_lineage
    monkeypatch.setattr(changes, "cut_lineage", lambda df, name: written.append(name) or kept(df, name))
    change = StagedChange(spark, f"{database}.log")
    feed = LatestTable(spark, f"{database}.latest", ["id"], "ingested_at", TIEBREAK, buckets=4).merge(raw(spark, {"id": 1}), change)
    MaintainedFact(spark, f"{database}.entries", f"{database}.totals", f"{database}.fact").apply(feed, products(spark), change)
    assert written == []
