"""End-to-end: stage operational tables, run the load twice, then a role change."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from starloom.operators.load import apply_role_changes
from starloom.plans.etl import run_etl, warehouse_tables
from starloom.sources.staging import Staging
from starloom.sources.tables import TableSource

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(1998, 1, 1)


@pytest.fixture(scope="module")
def oltp(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("oltp"))
    st = Staging(spark, SF)
    for t in ("departments", "employees", "projects", "assignments", "employee_history"):
        st[t].write.parquet(f"{root}/{t}")
    csv = f"{root}/attrition_csv"
    st["attrition_raw"].coalesce(1).write.option("header", True).csv(csv)
    return root, csv


def test_first_run_rerun_and_change(spark, oltp, tmp_path):
    root, csv = oltp
    wh = str(tmp_path / "warehouse")
    source = TableSource(root=root)
    first = run_etl(spark, source, wh, AS_OF, csv)
    employees = spark.read.parquet(f"{root}/employees").count()
    assignments = spark.read.parquet(f"{root}/assignments").count()
    assert first["scd2_inserted"] == employees and first["scd2_closed"] == 0
    assert first["rows_dim_employee"] == employees
    assert first["rows_fact_employee_performance"] == assignments
    assert first["dim_department_inserted"] == 25

    second = run_etl(spark, source, wh, AS_OF, csv)
    assert (second["scd2_inserted"], second["scd2_closed"]) == (0, 0)
    assert second["dim_date_inserted"] == 0 and second["dim_department_inserted"] == 0
    assert second["dim_project_inserted"] == 0 and second["dim_project_changed"] == 0
    assert second["rows_dim_employee"] == employees

    # promote three employees the day after the snapshot, then load again
    hist = spark.read.parquet(f"{root}/employee_history")
    emps = spark.read.parquet(f"{root}/employees")
    picked = [r["employee_id"] for r in emps.orderBy("employee_id").limit(3).collect()]
    changes = spark.createDataFrame(
        [(i, e, "Manager", 1.0, dt.date(2002, 1, 2)) for i, e in enumerate(picked)],
        "change_id long, employee_id long, role string, salary double, effective_start date",
    ).withColumn("salary", F.col("salary").cast("decimal(12,2)"))
    new_hist, new_emps, rejected = apply_role_changes(hist, emps, changes)
    root2 = str(tmp_path / "oltp2")
    for t in ("departments", "projects", "assignments"):
        spark.read.parquet(f"{root}/{t}").write.parquet(f"{root2}/{t}")
    new_hist.write.parquet(f"{root2}/employee_history")
    new_emps.write.parquet(f"{root2}/employees")
    assert rejected.count() == 0
    third = run_etl(spark, TableSource(root=root2), wh, AS_OF, csv)
    assert (third["scd2_inserted"], third["scd2_closed"]) == (3, 3)
    dim = warehouse_tables(spark, wh)["dim_employee"]
    versions = dim.where(F.col("employee_id") == picked[0]).orderBy("effective_start").collect()
    assert versions[-1]["role"] == "Manager" and versions[-1]["is_current"]
    assert versions[-2]["effective_end"] == dt.date(2002, 1, 1) and not versions[-2]["is_current"]
    assert dim.groupBy("employee_id").agg(F.count_if("is_current").alias("c")).where("c <> 1").count() == 0
    # closed versions are appended once, by the run that closed them
    runs = sorted(p for p in os.listdir(f"{wh}/dim_employee/closed") if p.startswith("run="))
    assert runs == ["run=1", "run=2", "run=3"]
    closed = [spark.read.parquet(f"{wh}/dim_employee/closed/{r}").count() for r in runs]
    assert closed == [0, 0, 3]

    # a second snapshot kept beside the first (per-snapshot fact)
    later = dt.date(1998, 6, 1)
    run_etl(spark, TableSource(root=root2), wh, later, csv, full_refresh=False)
    fact = warehouse_tables(spark, wh)["fact_employee_performance"]
    keys = sorted(r["date_key"] for r in fact.select("date_key").distinct().collect())
    assert keys == [19980101, 19980601]
    assert fact.where("date_key = 19980601").count() == assignments
