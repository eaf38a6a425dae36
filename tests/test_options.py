"""Options of the load that are off by default: point in time, backfill, collated names."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators.clean import resolve_departments
from starloom.operators.load import PublishConflict, current_versions, read_published, rows_not_in
from starloom.operators.scd2 import interval_violations, scd2_backfill, versions_at
from starloom.plans import etl
from starloom.plans.etl import LoadOptions, run_etl, warehouse_tables
from starloom.sources.staging import Staging
from starloom.sources.tables import TableSource

D = dt.date
SF = "/root/testdata/sf0.001"
AS_OF = D(1998, 1, 1)
COLLATION = "UNICODE_CI_AI_RTRIM"
HISTORY = "employee_id long, role string, effective_start date, effective_end date, is_current boolean"


def dim(spark, *rows):
    return spark.createDataFrame(rows, schemas.DIM_EMPLOYEE)


def seen(df):
    return sorted(tuple(r) for r in df.select("employee_key", "employee_id", "role", "is_current", "effective_start",
                                              "effective_end", "action").collect())


def test_backfill_compares_whole_sequences(spark):
    before = dim(
        spark,
        (1, 10, "Ann", "Lead", True, D(2021, 1, 1), None),     # the source has an older and a newer one
        (2, 11, "Bo", "Dev", True, D(2020, 1, 1), None),       # unchanged
        (3, 12, "Cy", "Dev", True, D(2020, 1, 1), None),       # gone
        (4, 13, "Di", "Own", False, D(2018, 1, 1), D(2018, 6, 1)))  # only the dimension has it
    history = spark.createDataFrame(
        [(10, "Dev", D(2019, 1, 1), D(2020, 12, 31), False), (10, "Chief", D(2021, 1, 1), D(2021, 12, 31), False),
         (10, "Boss", D(2022, 1, 1), None, True), (10, "Boss", D(2022, 1, 1), None, True),
         (11, "Dev", D(2020, 1, 1), None, True), (12, "Dev", D(2020, 1, 1), None, True),
         (13, "Dev", D(2018, 3, 1), None, True), (None, "Lost", D(2018, 3, 1), None, True), (11, "No day", None, None, True)],
        HISTORY)
    staff = spark.createDataFrame([(10, "Ann"), (11, "Bo"), (13, "Di")], "employee_id long, name string")
    after = scd2_backfill(before, staff, history, D(2024, 1, 1))
    got = seen(after)
    assert [g for g in got if g[0] <= 4] == [
        (1, 10, "Chief", False, D(2021, 1, 1), D(2021, 12, 31), "update"),
        (2, 11, "Dev", True, D(2020, 1, 1), None, "keep"),
        (3, 12, "Dev", False, D(2020, 1, 1), D(2024, 1, 1), "update"),
        (4, 13, "Own", False, D(2018, 1, 1), D(2018, 2, 28), "update")]
    assert sorted(g[1:] for g in got if g[0] > 4) == [
        (10, "Boss", True, D(2022, 1, 1), None, "insert"), (10, "Dev", False, D(2019, 1, 1), D(2020, 12, 31), "insert"),
        (13, "Dev", True, D(2018, 3, 1), None, "insert")]
    assert sorted(g[0] for g in got) == list(range(1, 8))
    again = scd2_backfill(after.drop("action"), staff, history, D(2025, 1, 1))
    assert seen(again) == [(*g[:-1], "keep") for g in got]
    assert interval_violations(after, "employee_id").where("problem <> 'gap'").count() == 0


def test_backfill_of_nothing(spark):
    none = dim(spark).where("false")
    history = spark.createDataFrame([], HISTORY)
    assert scd2_backfill(none, spark.createDataFrame([], "employee_id long, name string"), history, AS_OF).count() == 0


def test_versions_at(spark):
    versions = dim(
        spark, (1, 10, "A", "x", False, D(2020, 1, 1), D(2020, 6, 30)), (2, 10, "A", "y", True, D(2021, 1, 1), None),
        (3, 11, "B", "x", False, D(2020, 1, 1), D(2020, 1, 31)))
    rows = spark.createDataFrame(
        [(1, 10, D(2019, 12, 31)), (2, 10, D(2020, 1, 1)), (3, 10, D(2020, 6, 30)), (4, 10, D(2020, 7, 1)),
         (5, 10, D(2021, 1, 1)), (6, 10, D(2030, 1, 1)), (7, 11, D(2020, 2, 1)), (8, 12, D(2020, 1, 1)), (9, 10, None),
         (10, None, D(2020, 1, 1)), (11, 10, D(2020, 1, 1))], "n int, employee_id long, day date")
    got = {r["n"]: r["employee_key"] for r in versions_at(rows, versions, "day").collect()}
    assert got == {1: None, 2: 1, 3: 1, 4: None, 5: 2, 6: 2, 7: None, 8: None, 9: None, 10: None, 11: 1}


@pytest.fixture(scope="module")
def oltp(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("oltp"))
    st = Staging(spark, SF)
    for t in ("departments", "employees", "projects", "assignments", "employee_history"):
        st[t].write.parquet(f"{root}/{t}")
    csv = f"{root}/attrition_csv"
    st["attrition_raw"].coalesce(1).write.option("header", True).csv(csv)
    return root, csv


def test_names_that_a_collation_holds_equal_are_one_row(spark, oltp, tmp_path):
    root, csv = oltp
    again = str(tmp_path / "again")
    for t in ("employees", "assignments", "employee_history"):
        spark.read.parquet(f"{root}/{t}").write.parquet(f"{again}/{t}")
    # the second time all names come in another case, with blanks behind them
    for t, name in (("departments", "dept_name"), ("projects", "project_name")):
        rows = spark.read.parquet(f"{root}/{t}")
        changed = F.when(F.col(rows.columns[0]) % 2 == 0, F.concat(F.lower(name), F.lit("  "))).otherwise(F.upper(name))
        rows.withColumn(name, changed).write.parquet(f"{again}/{t}")
    options = LoadOptions(collation=COLLATION)
    first = run_etl(spark, TableSource(root=root), str(tmp_path / "wh"), AS_OF, csv, options=options)
    second = run_etl(spark, TableSource(root=again), str(tmp_path / "wh"), AS_OF, csv, options=options)
    assert first["dim_department_inserted"] == 25 and second["dim_department_inserted"] == 0
    assert second["dim_project_inserted"] == 0 and second["rows_dim_project"] == first["rows_dim_project"]
    assert second["rows_fact_employee_performance"] == first["rows_fact_employee_performance"]
    star = warehouse_tables(spark, str(tmp_path / "wh"))
    assert {r[0] for r in star["dim_department"].select("dept_name").collect()} == {f"NATION_{i}" for i in range(25)}
    plain = run_etl(spark, TableSource(root=again), str(tmp_path / "wh"), AS_OF, csv)
    assert plain["dim_department_inserted"] > 0  # binary comparison by default

    have = spark.createDataFrame([("Sales",)], "dept_name string")
    new = spark.createDataFrame([("SALES ",), ("Süd",)], "dept_name string")
    assert [r[0] for r in rows_not_in(new, have, ["dept_name"], COLLATION).collect()] == ["Süd"]
    ids = spark.createDataFrame([(4, "sales"), (2, "Sales ")], "dept_id int, dept_name string")
    assert [r["dept_id"] for r in resolve_departments(new, ids, COLLATION).orderBy("dept_name").collect()] == [2, None]


def test_backfilled_load_is_whole_and_idempotent(spark, oltp, tmp_path):
    root, csv = oltp
    wh, options = str(tmp_path / "wh"), LoadOptions(backfill=True, point_in_time=True)
    run_etl(spark, TableSource(root=root), wh, AS_OF, csv)  # only current versions
    pinned = current_versions(spark, wh)
    plain = read_published(spark, wh, "dim_employee", schemas.DIM_EMPLOYEE, pinned).count()
    first = run_etl(spark, TableSource(root=root), wh, AS_OF, csv, options=options)
    history = spark.read.parquet(f"{root}/employee_history")
    rows = warehouse_tables(spark, wh)["dim_employee"]
    assert first["rows_dim_employee"] == rows.count() == history.count()
    assert rows.select("employee_id", "role", "effective_start", "effective_end").exceptAll(
        history.select("employee_id", "role", "effective_start", "effective_end")).count() == 0
    keys = sorted(tuple(r) for r in rows.collect())
    run_etl(spark, TableSource(root=root), wh, AS_OF, csv, options=options)
    assert sorted(tuple(r) for r in warehouse_tables(spark, wh)["dim_employee"].collect()) == keys
    run_etl(spark, TableSource(root=root), wh, AS_OF, csv)  # and a plain run goes on from it
    assert sorted(tuple(r) for r in warehouse_tables(spark, wh)["dim_employee"].collect()) == keys
    # what was published before the rewrite can still be read
    assert read_published(spark, wh, "dim_employee", schemas.DIM_EMPLOYEE, pinned).count() == plain


def test_two_loads_at_once_both_count(spark, oltp, tmp_path):
    root, csv = oltp
    wh, errors = str(tmp_path / "wh"), []

    def load(day):
        try:
            run_etl(spark, TableSource(root=root), wh, day, csv, full_refresh=False)
        except Exception as failed:  # reported below
            errors.append(failed)

    threads = [threading.Thread(target=load, args=(day,)) for day in (AS_OF, D(1998, 6, 1))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    star = warehouse_tables(spark, wh)
    assert sorted(r[0] for r in star["fact_employee_performance"].select("date_key").distinct().collect()) == [
        19980101, 19980601]
    assert star["dim_date"].where("date_key in (19980101, 19980601)").count() == 2
    assert star["dim_employee"].count() == spark.read.parquet(f"{root}/employees").count()


def test_a_load_that_always_comes_second_says_so(spark, oltp, tmp_path, monkeypatch):
    tries = []

    def beaten(*args):
        tries.append(args)
        raise PublishConflict("published by another run meanwhile: dim_date")

    monkeypatch.setattr(etl, "_load_once", beaten)
    with pytest.raises(PublishConflict):
        run_etl(spark, TableSource(root=oltp[0]), str(tmp_path / "wh"), AS_OF, oltp[1], attempts=2)
    assert len(tries) == 2
