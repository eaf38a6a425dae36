"""Sources (S1, S9, S11, S12), options (D9, O1, L7) and plan shapes."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.operators.dims import build_dim_department
from starloom.operators.load import current_versions, load_oltp
from starloom.operators.scd2 import interval_violations
from starloom.plans import reports
from starloom.plans.catalog import queries
from starloom.schemas import RULES, SCHEMAS
from starloom.sources.csv import read_attrition_csv, read_raw_snapshot
from starloom.sources.tables import TableSource, quantile_query, register_database, run_sql, split_predicates

SF = "/root/testdata/sf0.001"


def test_splits_at_quantiles_are_even_and_take_each_row_once(spark, monkeypatch):
    # ids in two far clusters and one id that holds a third of all rows
    ids = [*range(0, 400), *range(10**9, 10**9 + 400), *[500] * 400, None, None]
    spark.createDataFrame([(i,) for i in ids], "id long").createOrReplaceTempView("split_me")
    bounds = [r[0] for r in spark.sql(quantile_query("split_me", "id", 12)).collect()]
    clauses = split_predicates("id", bounds)
    sizes = [spark.table("split_me").where(c).count() for c in clauses]
    assert sum(sizes) == len(ids) and sum(spark.table("split_me").where(c).count() for c in clauses) == len(ids)
    hot = [s for s in sizes if s >= 400]
    assert len(hot) == 1 and max(s for s in sizes if s < 400) <= 2 * len(ids) / 12  # only the one id is not split
    assert split_predicates("id", []) == ["1 = 1"] == split_predicates("id", [7])
    assert split_predicates("d", [dt.date(2020, 1, 1), dt.date(2021, 1, 1)]) == [
        "d < '2021-01-01' OR d IS NULL", "d >= '2021-01-01'"]
    assert split_predicates("s", ["a", "o'b"])[1] == "s >= 'o''b'"
    monkeypatch.setenv("DB_PASSWORD", "secret")
    source = TableSource(kind="jdbc", url="jdbc:mysql://db:3306/hr", partitioning={"assignments": ("assignment_id", 8)})
    assert "numPartitions" not in source.jdbc_options("assignments")  # the read itself needs a database: not tested


def test_interval_check_takes_one_scan_and_two_shuffles(spark, tmpdir_path):
    spark.createDataFrame([], SCHEMAS["employee_history"]).write.parquet(f"{tmpdir_path}/h")
    found = interval_violations(spark.read.parquet(f"{tmpdir_path}/h"), "employee_id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert _scans(found) == 1 and plan.count("Exchange") == 2 and "Join" not in plan


def test_jdbc_options_need_a_password(monkeypatch):
    src = TableSource(kind="jdbc", url="jdbc:mysql://db:3306/hr", user="etl",
                      partitioning={"assignments": ("assignment_id", 1, 3000, 8)})
    monkeypatch.delenv("DB_PASSWORD", raising=False)
    with pytest.raises(ValueError, match="DB_PASSWORD"):
        src.jdbc_options("assignments")
    monkeypatch.setenv("DB_PASSWORD", "secret")
    opts = src.jdbc_options("assignments")
    assert opts["partitionColumn"] == "assignment_id" and opts["numPartitions"] == "8"
    assert opts["dbtable"] == "assignments" and opts["user"] == "etl"
    assert "partitionColumn" not in src.jdbc_options("departments")


def test_snapshot_csv_required_columns(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "snap.csv")
    with open(path, "w") as f:
        f.write("EmployeeNumber,Attrition,JobSatisfaction\n1,Yes,3\n")
    with pytest.raises(ValueError, match="WorkLifeBalance"):
        read_attrition_csv(spark, path)
    with pytest.raises(ValueError, match="Department"):
        read_raw_snapshot(spark, path)
    full = os.path.join(tmpdir_path, "full.csv")
    with open(full, "w") as f:
        f.write("EmployeeNumber,Attrition,JobSatisfaction,WorkLifeBalance,OverTime,"
                "PerformanceRating,DistanceFromHome,Age\n7, Yes ,3,2,No,4,9,41\n")
    row = read_attrition_csv(spark, full).first()
    assert (row["EmployeeNumber"], row["Attrition"], row["DistanceFromHome"]) == (7, "Yes", 9)


def test_two_databases_and_named_parameters(spark, tmpdir_path):
    emp = spark.createDataFrame([(1, "Ann", 2), (2, "Bo", 3)], "employee_id long, name string, dept_id int")
    dep = spark.createDataFrame([(2, "Sales"), (3, "R&D")], "dept_id int, dept_name string")
    fact = spark.createDataFrame([(1, 10), (2, 20), (1, 30)], "employee_id long, tenure_days int")
    for name, df in (("employees", emp), ("departments", dep), ("fact", fact)):
        df.write.parquet(f"{tmpdir_path}/{name}")
    register_database(spark, "hr_oltp", {"employees": f"{tmpdir_path}/employees",
                                         "departments": f"{tmpdir_path}/departments"})
    register_database(spark, "hr_olap", {"fact": f"{tmpdir_path}/fact"})
    out = run_sql(
        spark,
        "SELECT d.dept_name, max(f.tenure_days) AS longest FROM hr_olap.fact f "
        "JOIN hr_oltp.employees e ON f.employee_id = e.employee_id "
        "JOIN hr_oltp.departments d ON e.dept_id = d.dept_id "
        "WHERE e.employee_id = :employee_id GROUP BY d.dept_name",
        employee_id=1,
    )
    assert [tuple(r) for r in out.collect()] == [("Sales", 30)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(employee_id,1)" in plan


def test_collation_conforms_department_names(spark):
    d = spark.createDataFrame([(1, "Sales"), (2, "SALES"), (3, "sales "), (4, "R&D")],
                              "dept_id int, dept_name string")
    assert build_dim_department(d).count() == 4
    rows = sorted((r["dept_name"], r["source_id"]) for r in build_dim_department(
        d, "UNICODE_CI_AI_RTRIM").collect())
    assert rows == [("R&D", 4), ("Sales", 1)]


def test_display_order(spark):
    df = spark.createDataFrame([("b", 2), ("a", 3), ("b", 1)], "dept_name string, tenure_rank int")
    got = [tuple(r) for r in reports.for_display(df, "tenure_ranking").collect()]
    assert got == [("a", 3), ("b", 1), ("b", 2)]


def test_load_oltp_keeps_broken_rows_out(spark, tmpdir_path):
    deps = spark.createDataFrame([(1, "Sales"), (1, "Sales"), (2, None)], "dept_id int, dept_name string")
    emps = spark.createDataFrame(
        [(1, "Ann", "a@x", 1, dt.date(2020, 1, 1), 10.0, "Rep", "Active"),
         (2, "Bo", "a@x", 1, dt.date(2020, 1, 1), 10.0, "Rep", "Active"),
         (3, "Cy", "c@x", 9, dt.date(2020, 1, 1), 10.0, "Rep", "Active"),
         (4, None, "d@x", 1, dt.date(2020, 1, 1), 10.0, "Rep", "Gone"),
         (5, "Di", "e@x", 2, dt.date(2020, 1, 1), 10.0, "Rep", "Active")],
        "employee_id long, name string, email string, dept_id int, hire_date date, "
        "current_salary double, current_role string, status string",
    )
    rejects = load_oltp({"employees": emps, "departments": deps}, tmpdir_path)
    got = sorted((r["table_name"], r["record_key"], r["constraint_names"], r["row_count"]) for r in rejects.collect())
    assert got == [
        ("departments", "1", "pk_departments_dept_id", 1), ("departments", "2", "nn_departments_dept_name", 1),
        ("employees", "2", "uq_employees_email", 1), ("employees", "3", "fk_employees_dept_id", 1),
        ("employees", "4", "chk_employees_status,nn_employees_name", 1),
        ("employees", "5", "fk_employees_dept_id", 1)]  # its department was not loaded
    versions = current_versions(spark, tmpdir_path)
    assert versions == {"departments": 1, "employees": 1, "load_rejects": 1}
    assert [r["employee_id"] for r in spark.read.parquet(f"{tmpdir_path}/employees/v000001").collect()] == [1]
    assert '"status":"Gone"' in rejects.where("record_key = '4'").first()["record"]


def test_every_rule_fires_on_the_broken_tables(spark):
    from starloom.plans.catalog import Scenario, _broken

    tables = _broken(Scenario(spark, SF))
    fired = {r["constraint_name"] for r in quality.quality_report(tables).select("constraint_name").distinct().collect()}
    for table, rules in RULES.items():
        for c in rules.not_null:
            assert f"nn_{table}_{c}" in fired
        for name, _ in rules.checks:
            assert name in fired
        for name, _ in quality._keys(table, rules):
            assert name in fired
        for cols, _, _ in rules.foreign_keys:
            assert f"fk_{table}_{cols[0]}" in fired
    assert sum(len(r.foreign_keys) for r in RULES.values()) == 8


def _scans(df):
    return len(re.findall(r"\n\(\d+\) Scan ", df._sc._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")))


def test_one_scan_takes_all_rules_of_a_table(spark, tmpdir_path):
    emps = spark.createDataFrame([], SCHEMAS["employees"])
    emps.write.parquet(f"{tmpdir_path}/employees")
    stored = spark.read.parquet(f"{tmpdir_path}/employees")
    report = quality.table_violations(stored, "employees")
    assert _scans(report) == 1
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    rows = quality.table_violations(stored, "employees", kinds=quality.ROW_RULES)
    assert _scans(rows) == 1 and "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["tenure_top_n", "fact_employee_performance", "monthly_attrition",
                                  "scd2_changes", "dq_check", "department_salary_trend"])
def test_plans_stay_in_the_jvm(spark, name):
    df = queries()[name](spark, SF)
    df.collect()  # the adaptive plan is final once this Dataset has run
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "AdaptiveSparkPlan" not in plan or "isFinalPlan=true" in plan
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node
    assert "WholeStageCodegen" in plan or "*(" in plan


def test_scans_prune_columns(spark):
    df = queries()["department_salary_trend"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # history is stored with 7 columns; the trend reads only the 4 it needs
    assert "ReadSchema: struct<employee_id:bigint,role:string,salary:decimal(12,2),effective_start:date>" in plan


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scd2_intervals_take_one_scan_and_two_exchanges(spark):
    from starloom.operators.scd2 import intervals_from_changelog
    from starloom.sources.staging import Staging

    log = Staging(spark, SF, store=False)["order_log"]
    plan = _final_plan(intervals_from_changelog(
        log, "employee_id", "effective_start", ["change_id"], ["role", "salary"]))
    plan = plan.split("Initial Plan")[0]
    assert len([line for line in plan.splitlines() if "FileScan" in line]) == 1
    assert len([line for line in plan.splitlines() if "Exchange hashpartitioning" in line]) <= 2
    assert "Join" not in plan


def test_nothing_is_persisted_or_pulled_into_one_task():
    from pathlib import Path

    import starloom

    for path in Path(starloom.__file__).parent.rglob("*.py"):
        if "llm" not in path.parts:
            text = path.read_text()
            assert ".persist(" not in text and "localCheckpoint" not in text, path


def test_rank_runs_on_counts_not_rows(spark):
    plan = _final_plan(queries()["tenure_top_n"](spark, SF))
    rank_windows = [line for line in plan.splitlines()
                    if "windowspecdefinition(dept_name" in line]
    assert rank_windows, "expected the rank window over departments"
    # the ranking window sums per-(department, tenure) counts, never ranks raw rows
    assert all("rank(" not in w and "row_number(" not in w for w in rank_windows)
    assert any("sum(" in w for w in rank_windows)
