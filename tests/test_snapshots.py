import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType

from advisorbook.operators.drift import align, kinds_of, union_with_drift
from advisorbook.plans.ingest import load_master, load_metrics, load_new_dates, rebuild_history
from advisorbook.sources.snapshots import (
    FROM_FOLDER,
    first_lines,
    infer_types,
    list_snapshots,
    read_master,
    read_snapshots,
)
from advisorbook.sources.change_log import StagedChange
from advisorbook.sources.latest_table import LatestTable
from advisorbook.sources.tables import (
    append_table,
    create_database,
    merge_table,
    read_table,
    replace_counted,
    replace_table,
    setting,
    table_schema,
)
from tests.frames import day, rows_of

CONTRACT = {
    "id": LongType(),
    "name": StringType(),
    "amount": DoubleType(),
    "is_deleted": BooleanType(),
}


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def read(spark, folder, **options):
    return read_snapshots(spark, list_snapshots(spark, str(folder)), CONTRACT, **options)


@pytest.fixture
def database(spark, tmp_path):
    name = "db_" + str(abs(hash(str(tmp_path))))
    create_database(spark, name, str(tmp_path / "db"))
    return name


def test_text_is_cleaned_and_typed(spark, tmp_path):
    write(
        tmp_path,
        "s_2026-01-10.csv",
        " id ,name, amount,is_deleted\n"
        '1, a b ,1.5,True\n2,"\tx, ""y"" ",NA,false\n3,   ,,null\n4,NA, 2 ,0\n',
    )
    got = read(spark, tmp_path)
    meta = (day("2026-01-10"), dt.datetime(2026, 1, 10))
    assert got.columns == ["id", "name", "amount", "is_deleted", "snapshot_date", "ingested_at"]
    assert rows_of(got) == [
        (1, "a b", 1.5, True, *meta),
        (2, 'x, "y"', None, False, *meta),
        (3, "", None, None, *meta),
        (4, None, 2.0, False, *meta),
    ]
    assert dict(got.dtypes)["ingested_at"] == "timestamp_ntz"


def test_new_and_missing_columns(spark, tmp_path):
    write(tmp_path, "s_2026-01-10.csv", "id,name,amount,is_deleted\n1,a,1,false\n")
    write(tmp_path, "s_2026-01-26.csv", "id,risk_score,name\n1,7,b\n2,,c\n")
    got = read(spark, tmp_path)
    assert dict(got.dtypes)["risk_score"] == "bigint"
    assert rows_of(got, "id", "name", "amount", "risk_score") == [
        (1, "a", 1.0, None),
        (1, "b", None, 7),
        (2, "c", None, None),
    ]


def test_drift_types_are_inferred_from_all_values(spark):
    df = spark.createDataFrame(
        [("1", "1", "True", "1", None), ("2", "2.5", "false", "x", None)],
        "a string, b string, c string, d string, e string",
    )
    types = infer_types(df, df.columns)
    assert [t.simpleString() for t in types.values()] == [
        "bigint", "double", "boolean", "string", "string",
    ]


def test_a_value_that_does_not_fit_names_its_column(spark, tmp_path):
    write(tmp_path, "s_2026-01-10.csv", "id,name\n1,a\nseven,b\n")
    with pytest.raises(Exception, match="Column id: not bigint: seven"):
        read(spark, tmp_path).collect()


def test_a_drifted_column_must_not_change_its_type(spark, tmp_path):
    write(tmp_path, "s_2026-01-10.csv", "id,risk\n1,5\n")
    write(tmp_path, "s_2026-01-26.csv", "id,name,risk\n1,a,high\n")
    with pytest.raises(ValueError, match="risk: bigint -> string"):
        read(spark, tmp_path)


@pytest.mark.parametrize(
    ("risks", "kind", "expected"),
    [
        (["", "5", "2.5", "7"], "double", [None, 5.0, 2.5, 7.0]),
        (["5", ""], "bigint", [5, None]),
        (["", ""], "string", [None, None]),
        (["", "high", "7"], "string", [None, "high", "7"]),
        (["2.5", "7"], "double", [2.5, 7.0]),
        (["", "true"], "boolean", [None, True]),
    ],
)
def test_drifted_types_widen(spark, tmp_path, database, risks, kind, expected):
    table, n = f"{database}.history", len(risks)
    for k, risk in enumerate(risks, 1):
        # Another column each time, so that every file has a header of its own.
        write(tmp_path / "in", f"s_2026-01-{k:02}.csv", f"id,risk,c{k}\n{k},{risk},x\n")
    together = read(spark, tmp_path / "in")
    for k in range(1, n + 1):
        before = set(spark.table(table).inputFiles()) if k > 1 else set()
        load_new_dates(spark, str(tmp_path / "in"), table, [day(f"2026-01-{k:02}")], CONTRACT, heads=f"{database}.heads")
        assert before < set(spark.table(table).inputFiles())
    one_by_one = read_table(spark, table)
    for got in (together, one_by_one):
        assert dict(got.dtypes)["risk"] == kind
        assert [r["risk"] for r in got.orderBy("id").collect()] == expected
    assert set(one_by_one.columns) == set(together.columns)
    assert "PartitionFilters: [isnotnull(snapshot_date" in one_by_one.filter(
        F.col("snapshot_date") == day("2026-01-01")
    )._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("first", "second"), [("5", "high"), ("2.5", "true"), ("true", "high"), ("true", "1")])
def test_what_does_not_fit_a_stored_type_fails(spark, tmp_path, database, first, second):
    table = f"{database}.history"
    write(tmp_path / "in", "s_2026-01-01.csv", f"id,risk\n1,{first}\n")
    rebuild_history(spark, str(tmp_path / "in"), table, CONTRACT)
    write(tmp_path / "in", "s_2026-01-02.csv", f"id,risk\n1,{second}\n")
    with pytest.raises(ValueError, match="Column type changed: risk"):
        load_new_dates(spark, str(tmp_path / "in"), table, [day("2026-01-02")], CONTRACT)
    assert spark.table(table).count() == 1


def test_latest_rows_follow_a_widened_column(spark, tmp_path, database):
    for k, risk in enumerate(["", "5", "2.5"], 1):
        write(tmp_path / "in", f"s_2026-01-{k:02}.csv", f"id,risk\n{k},{risk}\n9,{risk}\n")
        load_new_dates(spark, str(tmp_path / "in"), f"{database}.history", [day(f"2026-01-{k:02}")], CONTRACT)
        arrived = read_table(spark, f"{database}.history").filter(F.col("snapshot_date") == day(f"2026-01-{k:02}"))
        change = StagedChange(spark, f"{database}.log")
        latest = LatestTable(spark, f"{database}.latest", ["id"], "ingested_at", buckets=2)
        latest.merge(arrived, change)
        change.commit()
    assert rows_of(latest.rows(), "id", "risk") == [(1, None), (2, 5.0), (3, 2.5), (9, 2.5)]


def test_first_lines_take_the_same_jobs_for_any_number_of_files(spark, tmp_path, database):
    def jobs(folder, heads=None):
        group = f"heads-{folder}-{heads}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            files = list_snapshots(spark, str(tmp_path / folder))
            rows = read_snapshots(spark, files, CONTRACT, heads=heads)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return rows, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    for folder, n in (("few", 80), ("many", 160)):  # above 32 files of a header Spark lists them by a job
        for k in range(n):
            header, line = ("id,risk", f"{k},7") if k % 2 else ("id, name", f"{k},a")
            write(tmp_path / folder, f"s{k}_2026-01-{k % 28 + 1:02}.csv", f"{header}\n{line}\n")
    write(tmp_path / "many", "empty_2026-01-01.csv", "")
    long = "".join(f"{k},n{k},1.5,true\n" for k in range(200_000))
    write(tmp_path / "many", "long_2026-01-01.csv", "id,name,amount,is_deleted\n" + long)
    few, few_jobs = jobs("few")
    many, many_jobs = jobs("many")
    assert few_jobs == many_jobs
    assert few.count() == 80 and many.count() == 200_160 and many.agg(F.sum("risk")).first()[0] == 560
    heads = f"{database}.heads"
    jobs("few", heads)
    assert spark.table(heads).count() == 80
    write(tmp_path / "few", "new_2026-02-01.csv", "id\n1\n")
    again, _ = jobs("few", heads)
    assert again.count() == 81 and spark.table(heads).count() == 81


def test_repeated_names_after_trimming_fail(spark, tmp_path):
    write(tmp_path, "s_2026-01-10.csv", "id, name,name \n1,a,b\n")
    with pytest.raises(ValueError, match=r"Duplicate column names .*\['name'\]"):
        read(spark, tmp_path)


def test_malformed_lines_fail(spark, tmp_path):
    write(tmp_path, "s_2026-01-10.csv", "id,name\n1,a,extra\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read(spark, tmp_path).collect()


def test_line_breaks_inside_quotes(spark, tmp_path):
    write(tmp_path, "s_2026-01-10.csv", 'id,name\n1,"two\nlines"\n2,b\n')
    assert rows_of(read(spark, tmp_path, multi_line=True), "id", "name") == [
        (1, "two\nlines"),
        (2, "b"),
    ]


def test_header_only_file_is_skipped_with_its_new_columns(spark, tmp_path):
    write(tmp_path, "s_2026-01-10.csv", "id,name\n1,a\n")
    write(tmp_path, "s_2026-01-26.csv", "id,name,risk_score\n")
    assert "risk_score" not in read(spark, tmp_path).columns
    assert rows_of(read(spark, tmp_path), "id") == [(1,)]


def test_listing_fails_without_folder_or_date(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        list_snapshots(spark, str(tmp_path / "none"))
    write(tmp_path, "undated.csv", "id\n1\n")
    with pytest.raises(Exception, match="No snapshot date"):
        list_snapshots(spark, str(tmp_path)).collect()


def test_only_matching_files_of_the_folder_itself(spark, tmp_path):
    write(tmp_path, "s_2026-01-10.csv", "id\n1\n")
    write(tmp_path, "s_2026-01-11.txt", "id\n2\n")
    write(tmp_path, "old/s_2026-01-12.csv", "id\n3\n")
    assert rows_of(list_snapshots(spark, str(tmp_path)), "snapshot_date") == [(day("2026-01-10"),)]


def test_snapshot_as_folder_of_part_files(spark, tmp_path):
    write(tmp_path, "snapshot=2026-01-10/part-00000-12345678.csv", "id\n1\n")
    write(tmp_path, "snapshot=2026-01-10/part-00001.csv", "id\n2\n")
    write(tmp_path, "snapshot=2026-01-26/part-00000.csv", "id\n1\n")
    files = list_snapshots(spark, str(tmp_path), date_from=FROM_FOLDER)
    got = read_snapshots(spark, files, CONTRACT)
    assert rows_of(got, "id", "snapshot_date") == [
        (1, day("2026-01-10")),
        (1, day("2026-01-26")),
        (2, day("2026-01-10")),
    ]


def test_names_with_blanks_keep_their_date(spark, tmp_path):
    write(tmp_path, "my file 2026-01-10.csv", "id\n1\n")
    assert rows_of(read(spark, tmp_path), "snapshot_date") == [(day("2026-01-10"),)]


def test_rebuild_converges_and_reports_metrics(spark, tmp_path, database):
    folder = tmp_path / "in"
    write(folder, "s_2026-01-10.csv", "id,name\n1,a\n2,b\n")
    write(folder, "s_2026-01-26.csv", "id,name,risk\n1,a,9\n")
    write(folder, "s_2026-02-01.csv", "id,name\n")
    table = f"{database}.history"
    seen = []
    for _ in range(3):
        metrics = rebuild_history(spark, str(folder), table, CONTRACT)
        seen.append(rows_of(spark.table(table)))
        assert rows_of(metrics, "snapshot_date", "rows_input") == [
            (day("2026-01-10"), 2),
            (day("2026-01-26"), 1),
            (day("2026-02-01"), 0),
        ]
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 3


def test_rebuild_of_empty_files_fails(spark, tmp_path, database):
    write(tmp_path / "in", "s_2026-01-10.csv", "id,name\n")
    with pytest.raises(ValueError, match="no rows|No snapshot rows"):
        rebuild_history(spark, str(tmp_path / "in"), f"{database}.history", CONTRACT)


def test_loading_a_date_again_changes_nothing(spark, tmp_path, database):
    folder, table = tmp_path / "in", f"{database}.history"
    write(folder, "s_2026-01-10.csv", "id,name\n1,a\n")
    rebuild_history(spark, str(folder), table, CONTRACT)
    write(folder, "s_2026-01-26.csv", "id,name,risk\n1,b,3\n")
    for _ in range(2):
        load_new_dates(spark, str(folder), table, [day("2026-01-26")], CONTRACT)
        assert rows_of(spark.table(table), "id", "name", "risk") == [(1, "a", None), (1, "b", 3)]


def test_master_is_replaced_and_a_missing_one_skipped(spark, tmp_path, database):
    path = write(tmp_path, "m.csv", 'id,name,kind\n1," a\nb ",x\n2,c,y\n')
    table = f"{database}.master"
    assert [load_master(spark, path, table, CONTRACT) for _ in range(2)] == [2, 2]
    assert rows_of(spark.table(table)) == [(1, "a\nb", "x"), (2, "c", "y")]
    assert read_master(spark, str(tmp_path / "none.csv"), CONTRACT) is None


def test_rows_are_counted_by_the_write_itself(spark, tmp_path, database):
    table = f"{database}.counted"
    rows = spark.range(1000).withColumn("part", F.col("id") % 7)

    def jobs(group, load):
        spark.sparkContext.setJobGroup(group, group)
        try:
            assert load() in (None, 1000)
        finally:
            spark.sparkContext._jsc.clearJobGroup()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    plain = jobs(f"{table}-plain", lambda: replace_table(rows, f"{database}.plain", ["part"]))
    for k in range(2):
        assert jobs(f"{table}-{k}", lambda: replace_counted(rows, table, ["part"])) == plain
    assert spark.table(table).count() == 1000 and spark.catalog.listColumns(table)[-1].isPartition
    empty = write(tmp_path, "empty.csv", "id,name,kind\n")
    assert load_master(spark, empty, table, CONTRACT) == 0 and spark.table(table).columns == ["id", "name", "kind"]


def test_files_without_rows_leave_the_old_history(spark, tmp_path, database):
    table = f"{database}.history"
    write(tmp_path / "in", "s_2026-01-10.csv", "id,name\n1,a\n")
    rebuild_history(spark, str(tmp_path / "in"), table, CONTRACT)
    write(tmp_path / "none", "s_2026-01-11.csv", "id,name\n")
    with pytest.raises(ValueError, match="no rows|No snapshot rows"):
        rebuild_history(spark, str(tmp_path / "none"), table, CONTRACT)
    assert rows_of(spark.table(table), "id", "name") == [(1, "a")]


def test_append_adds_columns_and_skips_empty_frames(spark, database):
    table = f"{database}.t"
    assert len(table_schema(spark, table)) == 0
    first = spark.createDataFrame([(1, day("2026-01-10"))], "id int, snapshot_date date")
    append_table(first.limit(0), table, ["snapshot_date"])
    assert not spark.catalog.tableExists(table)
    append_table(first, table, ["snapshot_date"])
    wider = spark.createDataFrame(
        [(2, "x", day("2026-01-11"))], "id int, note string, snapshot_date date"
    )
    append_table(wider.limit(0), table)
    assert "note" not in table_schema(spark, table).names
    append_table(wider, table)
    append_table(first, table)
    assert rows_of(spark.table(table), "id", "note") == [(1, None), (1, None), (2, "x")]
    with pytest.raises(ValueError, match="id: int -> string"):
        append_table(spark.createDataFrame([("a",)], "id string"), table)


def test_merge_into_table_touches_only_its_partitions(spark, database):
    table = f"{database}.fact"
    jan, feb, mar = day("2026-01-01"), day("2026-02-01"), day("2026-03-01")
    schema = "a int, x double, m date"
    rows = [(1, 1.0, jan), (2, 2.0, jan), (1, 3.0, feb), (None, 4.0, feb)]
    replace_table(spark.createDataFrame(rows, schema), table, ["m"])
    untouched = {f for f in spark.table(table).filter(f"m = '{jan}'").inputFiles()}
    source = spark.createDataFrame(
        [(1, 30.0, feb, "n"), (None, 40.0, feb, "n"), (5, 5.0, mar, "n")], schema + ", note string"
    )
    for _ in range(2):
        merge_table(source, table, ["a", "m"], "m")
        assert rows_of(spark.table(table), "a", "x", "m", "note") == [
            (1, 1.0, jan, None),
            (1, 30.0, feb, "n"),
            (2, 2.0, jan, None),
            (5, 5.0, mar, "n"),
            (None, 40.0, feb, "n"),
        ]
    assert {f for f in spark.table(table).filter(f"m = '{jan}'").inputFiles()} == untouched


def test_merge_creates_a_missing_table(spark, database):
    table = f"{database}.fresh"
    source = spark.createDataFrame([(1, day("2026-01-01"))], "a int, m date")
    merge_table(source, table, ["a", "m"], "m")
    assert rows_of(spark.table(table)) == [(1, day("2026-01-01"))]


def test_merge_refuses_a_repeated_source_key(spark, database):
    table = f"{database}.once"
    jan = day("2026-01-01")
    merge_table(spark.createDataFrame([(1, 1.0, jan)], "a int, x double, m date"), table, ["a", "m"], "m")
    twice = spark.createDataFrame([(None, 2.0, jan), (None, 3.0, jan)], "a int, x double, m date")
    for target in (table, f"{database}.never"):
        with pytest.raises(ValueError, match="holds a key 2 times: a=None"):
            merge_table(twice, target, ["a", "m"], "m")
    assert rows_of(spark.table(table), "a", "x") == [(1, 1.0)]
    assert not spark.catalog.tableExists(f"{database}.never")


def test_union_and_align(spark):
    a = spark.createDataFrame([(1, "x")], "id int, old string")
    b = spark.createDataFrame([(2, 5)], "id int, new int")
    both = union_with_drift([a, b])
    assert rows_of(both) == [(1, "x", None), (2, None, 5)]
    assert rows_of(align(b, both.schema)) == [(2, None, 5)]


def test_metrics_without_files(spark):
    df = spark.createDataFrame([(day("2026-01-10"),)] * 2, "snapshot_date date")
    assert rows_of(load_metrics(df)) == [(day("2026-01-10"), 2)]


def test_kinds_of_text_try_no_cast_that_must_fail(spark):
    """The same kinds as the casts alone give, on odd forms, and each cast guarded by the form it needs."""
    odd = ["1", " 1 ", "+1", "-", "+", "", ".", "1.", ".5", "1e5", "1E-5", "1e", "1d", "1F", "0x1p3", "0x1", "NaN", "nan", "-inf", "+Infinity", "infin",
           "1-2", "1\u007f", "\u007f1.5", "\u00a01", "9223372036854775807", "9223372036854775808", "1_0", "١", "true", "FALSE", "A", "12A", "\n7\t", "1.5 x", "1\n"]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").repartition(4)
    text = F.col("t")
    plain = (
        F.when(text.try_cast("bigint").isNotNull(), 1).when(text.try_cast("double").isNotNull(), 2)
        .when(F.lower(text).isin("true", "false"), 3).otherwise(4)
    )
    found = rows.groupBy("t").agg(kinds_of(text).alias("k"), F.first(plain).alias("p")).collect()
    kinds = {p: {r["k"] for r in found if r["p"] == p} for p in (1, 2, 3, 4)}
    assert all(len(k) == 1 for k in kinds.values()) and len(set.union(*kinds.values())) == 4
    told = rows.agg(kinds_of(text))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in told


def test_first_lines_leave_python_and_dates_come_from_the_listing(spark, tmp_path):
    """Files of several splits, an empty one and one that opens with a blank line."""
    long = "a,b\n" + "".join(f"{k},{k}\n" for k in range(5000))
    for name, body in {"x_2026-01-01.csv": long, "x_2026-01-02.csv": "", "x_2026-01-03.csv": "\na\n", "x_2026-01-04.csv": "c"}.items():
        (tmp_path / name).write_text(body)
    with setting(spark, "spark.sql.files.maxPartitionBytes", "4096"):
        found = first_lines(spark, [str(p) for p in sorted(tmp_path.glob("*.csv"))])
    assert sorted((r["uri"][-14:-4], r["line"]) for r in found.collect()) == [("2026-01-01", "a,b"), ("2026-01-03", ""), ("2026-01-04", "c")]
