"""What the load path must never do: lose rows, double rows, or read half a publication."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import load
from starloom.operators.keys import largest_key
from starloom.operators.load import (
    LAST_HISTORY_ID,
    PublishConflict,
    apply_role_changes,
    claim_run,
    current_versions,
    onboard,
    publish,
    publish_onboarding,
    publish_role_changes,
    read_published,
    rows_not_in,
    write_operational,
    write_scd2_unpublished,
    write_unpublished,
)
from starloom.operators.scd2 import apply_scd2, scd2_changes
from starloom.session import checkpoint_dir
from starloom.sources.objects import numbers, put_if_absent, read_object
from starloom.sources.tables import TableSource, empty_frame, read_table

D = dt.date
DIM = schemas.DIM_EMPLOYEE


def dim(spark, rows):
    return spark.createDataFrame(rows, DIM)


def test_lost_published_table_raises(spark, tmpdir_path):
    run = claim_run(spark, tmpdir_path)
    path = write_unpublished(spark.createDataFrame([(1, "A")], schemas.DIM_DEPARTMENT), tmpdir_path,
                             "dim_department", run)
    publish(spark, tmpdir_path, {"dim_department": run})
    assert read_published(spark, tmpdir_path, "dim_department", schemas.DIM_DEPARTMENT).count() == 1
    os.rename(path, f"{path}-lost")
    with pytest.raises(AnalysisException):
        read_published(spark, tmpdir_path, "dim_department", schemas.DIM_DEPARTMENT).count()
    assert read_published(spark, tmpdir_path, "dim_project", schemas.DIM_PROJECT).count() == 0


def test_manifests_are_never_overwritten_and_a_draft_is_not_seen(spark, tmpdir_path):
    publish(spark, tmpdir_path, {"a": 1})
    publish(spark, tmpdir_path, {"b": 2})
    assert sorted(os.listdir(f"{tmpdir_path}/manifest")) == ["1", "2"]
    with open(f"{tmpdir_path}/manifest/.broken", "w") as draft:  # a publication that broke off
        draft.write("{")
    assert current_versions(spark, tmpdir_path) == {"a": 1, "b": 2}


def test_only_the_newest_manifest_is_read(spark, tmpdir_path):
    for k in range(1, 13):
        publish(spark, tmpdir_path, {"a": k, "dim_employee": k})
    for k in range(1, 12):
        with open(f"{tmpdir_path}/manifest/{k}", "w") as old:
            old.write("no longer readable")
    assert current_versions(spark, tmpdir_path) == {"a": 12, "dim_employee": 12}
    assert claim_run(spark, tmpdir_path) == 13


def test_sixteen_claims_at_once(spark, tmpdir_path):
    with ThreadPoolExecutor(16) as pool:
        runs = list(pool.map(lambda _: claim_run(spark, tmpdir_path), range(16)))
    assert sorted(runs) == list(range(1, 17))


def test_one_writer_creates_an_object(spark, tmpdir_path):
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda k: put_if_absent(spark, f"{tmpdir_path}/x/7", b"%d" % k), range(16)))
    assert won.count(True) == 1 and os.listdir(f"{tmpdir_path}/x") == ["7"]
    assert read_object(spark, f"file://{tmpdir_path}/x/7") == b"%d" % won.index(True)
    assert numbers(spark, f"{tmpdir_path}/x") == [7] and numbers(spark, f"{tmpdir_path}/none") == []


def test_publications_at_once_hide_nothing(spark, tmpdir_path):
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda k: publish(spark, tmpdir_path, {f"t{k}": k}, based_on={}), range(1, 9)))
    assert current_versions(spark, tmpdir_path) == {f"t{k}": k for k in range(1, 9)}


def test_the_later_of_two_runs_on_one_state_is_told(spark, tmpdir_path):
    publish(spark, tmpdir_path, {"a": 1, "b": 1})
    base = current_versions(spark, tmpdir_path)

    def attempt(run):
        try:
            publish(spark, tmpdir_path, {"a": run}, based_on=base)
            return True
        except PublishConflict as conflict:
            assert "another run" in str(conflict) and " a" in str(conflict)
            return False

    with ThreadPoolExecutor(2) as pool:
        won = list(pool.map(attempt, (2, 3)))
    assert sorted(won) == [False, True]
    assert current_versions(spark, tmpdir_path) == {"a": 2 if won[0] else 3, "b": 1}


def test_runs_have_numbers_of_their_own(spark, tmpdir_path):
    assert [claim_run(spark, tmpdir_path) for _ in range(3)] == [1, 2, 3]
    publish(spark, tmpdir_path, {"a": 7, "a.last_key": 900})
    assert claim_run(spark, tmpdir_path) == 8


def test_retry_without_closes_and_failed_runs_leave_no_closed_rows(spark, tmpdir_path):
    open_row = (1, 10, "Ann", "Dev", True, D(2020, 1, 1), None)
    shut_row = (1, 10, "Ann", "Dev", False, D(2020, 1, 1), D(2021, 1, 1))
    odd_row = (2, 11, "Bo", "Dev", None, D(2020, 1, 1), None)
    loose = schemas.T.StructType([schemas.T.StructField(f.name, f.dataType) for f in DIM])
    write_scd2_unpublished(spark.createDataFrame([shut_row, odd_row], loose), tmpdir_path, "dim_employee", 1)
    write_scd2_unpublished(spark.createDataFrame([open_row, odd_row], loose), tmpdir_path, "dim_employee", 1)
    publish(spark, tmpdir_path, {"dim_employee": 1})
    write_scd2_unpublished(spark.createDataFrame([shut_row], loose), tmpdir_path, "dim_employee", 2)  # fails later
    write_scd2_unpublished(spark.createDataFrame([open_row], loose), tmpdir_path, "dim_employee", 3)
    publish(spark, tmpdir_path, {"dim_employee": 3})
    rows = read_published(spark, tmpdir_path, "dim_employee", loose).collect()
    assert sorted((r["employee_key"], r["is_current"]) for r in rows) == [(1, True), (2, None)]


def test_two_current_source_rows_close_a_key_once(spark):
    old = dim(spark, [(1, 10, "Ann", "Dev", True, D(2020, 1, 1), None)])
    history = spark.createDataFrame(
        [(1, 10, "Lead", 1, D(2021, 1, 1), None, True), (2, 10, "Boss", 1, D(2022, 1, 1), None, True)],
        "history_id long, employee_id long, role string, salary int, effective_start date, "
        "effective_end date, is_current boolean")
    staff = spark.createDataFrame([(10, "Ann")], "employee_id long, name string")
    changes = scd2_changes(staff, history, old)
    got = sorted((r["action"], r["role"], r["reason"]) for r in changes.collect())
    assert got == [("close_insert", "Boss", None), ("reject", None, "1 further current source versions")]
    after = apply_scd2(old, changes).collect()
    assert sorted((r["employee_key"], r["role"], r["is_current"]) for r in after) == [
        (1, "Dev", False), (2, "Boss", True)]


def test_keys_go_on_after_the_largest_closed_key(spark):
    old = dim(spark, [(9, 10, "Ann", "Dev", False, D(2020, 1, 1), D(2021, 1, 1)),
                      (3, 11, "Bo", "Dev", True, D(2020, 1, 1), None)])
    history = spark.createDataFrame(
        [(10, "Dev", D(2022, 1, 1), True), (11, "Dev", D(2020, 1, 1), True)],
        "employee_id long, role string, effective_start date, is_current boolean")
    staff = spark.createDataFrame([(10, "Ann"), (11, "Bo")], "employee_id long, name string")
    current = old.where("is_current")
    after = apply_scd2(current, scd2_changes(staff, history, current), largest_key(old, "employee_key"))
    assert sorted(r["employee_key"] for r in after.collect()) == [3, 10]


def test_insert_if_absent_is_null_safe(spark):
    have = spark.createDataFrame([("A",), (None,)], "dept_name string")
    new = spark.createDataFrame([("A",), (None,), ("B",)], "dept_name string")
    assert [r[0] for r in rows_not_in(new, have, ["dept_name"]).collect()] == ["B"]


def test_role_changes_on_dirty_input(spark):
    money = "decimal(12,2)"
    history = spark.createDataFrame(
        [(1, 10, "Dev", 1, D(2020, 1, 1), None, True),
         (2, 11, "Dev", 1, D(2019, 1, 1), D(2020, 1, 1), False),
         (3, 12, "Dev", 1, D(2019, 1, 1), None, None)],
        "history_id long, employee_id long, role string, salary int, effective_start date, "
        "effective_end date, is_current boolean").withColumn("salary", F.col("salary").cast(money))
    staff = spark.createDataFrame(
        [(10, "Dev", 1), (11, "Dev", 1), (12, "Kept", 5)],
        "employee_id long, current_role string, current_salary int").withColumn(
        "current_salary", F.col("current_salary").cast(money))
    changes = spark.createDataFrame(
        [(1, 10, "Lead", 2, D(2021, 1, 1)), (2, 10, "Same day", 2, D(2020, 1, 1)),
         (3, 99, "Ghost", 2, D(2021, 1, 1)), (4, 10, "No day", 2, None),
         (5, 11, "Inside", 2, D(2019, 6, 1)), (6, 11, "Back", 3, D(2022, 1, 1))],
        "change_id long, employee_id long, role string, salary int, effective_start date").withColumn(
        "salary", F.col("salary").cast(money))
    after, people, rejected = apply_role_changes(history, staff, changes)
    assert {r["change_id"]: r["reason"].split(" ")[0] for r in rejected.collect()} == {
        2: "change", 3: "unknown", 4: "employee", 5: "change"}
    kept = sorted((r["employee_id"], r["role"], r["effective_end"], r["is_current"]) for r in after.collect())
    assert [k[:2] for k in kept] == [(10, "Dev"), (10, "Lead"), (11, "Back"), (11, "Dev"), (12, "Dev")]
    assert kept[0][2:] == (D(2020, 12, 31), False) and kept[4][2:] == (None, None)
    assert {r["employee_id"]: r["current_role"] for r in people.collect()} == {
        10: "Lead", 11: "Back", 12: "Kept"}


def _onboarding(spark):
    columns = ("request_id long, name string, email string, dept_name string, hire_date date, "
               "current_salary int, current_role string, status string, project_name string, "
               "allocation_pct int, assignment_start date")
    good = dict(name="N", dept_name="Sales", hire_date=D(2020, 1, 1), current_salary=5, current_role="Dev",
                status="Active", project_name="P", allocation_pct=50, assignment_start=D(2020, 1, 1))
    names = [c.split()[0] for c in columns.split(", ")]
    cases = [dict(good, email="a@x"), dict(good, email=" a@x "), dict(good, email="taken@x")]
    cases += [dict(good, email=f"{c}@x", **{c: None}) for c in (
        "hire_date", "current_salary", "status", "allocation_pct", "assignment_start")]
    rows = [tuple({"request_id": i, **case}.get(n) for n in names) for i, case in enumerate(cases, 1)]
    requests = spark.createDataFrame(rows, columns)
    tables = {
        "employees": spark.createDataFrame(
            [(4, "T", "taken@x", 1, D(2019, 1, 1), 1, "Dev", "Active")],
            "employee_id long, name string, email string, dept_id int, hire_date date, current_salary int, "
            "current_role string, status string").withColumn("current_salary", F.col("current_salary").cast(schemas.SALARY)),
        "assignments": empty_frame(spark, schemas.ASSIGNMENTS),
        "employee_history": empty_frame(spark, schemas.EMPLOYEE_HISTORY),
    }
    departments = spark.createDataFrame([(1, "Sales")], schemas.DEPARTMENTS)
    projects = spark.createDataFrame([(1, "P", D(2019, 1, 1), None, None)],
                                     "project_id long, project_name string, start_date date, end_date date, budget int")
    return onboard(requests, tables["employees"], tables["assignments"], departments, projects,
                   tables["employee_history"]), tables


def test_onboarding_rejects_missing_values_and_used_emails(spark):
    batch, _ = _onboarding(spark)
    assert {r["request_id"]: r["reason"] for r in batch["rejected"].collect()} == {
        2: "email repeated in the batch", 3: "email already used by an employee",
        **dict.fromkeys(range(4, 9), "a required value is missing")}


def test_onboarding_publishes_its_three_tables_together(spark, tmpdir_path):
    batch, tables = _onboarding(spark)
    publish_onboarding(spark, tmpdir_path, batch, tables)
    for name, schema, count in (("employees", schemas.EMPLOYEES, 2), ("assignments", schemas.ASSIGNMENTS, 1),
                                ("employee_history", schemas.EMPLOYEE_HISTORY, 1)):
        stored = read_published(spark, tmpdir_path, name, schema)
        assert stored.count() == count and stored.columns == schema.fieldNames()
    row = read_published(spark, tmpdir_path, "employee_history", schemas.EMPLOYEE_HISTORY).first()
    assert (row["history_id"], row["employee_id"], row["is_current"]) == (1, 5, True)


def _stored_history(spark, root):
    money = schemas.SALARY
    history = spark.createDataFrame(
        [(1, 10, "Dev", 1, D(2019, 1, 1), D(2019, 12, 31), False), (2, 10, "Lead", 2, D(2020, 1, 1), None, True),
         (3, 11, "Dev", 1, D(2020, 1, 1), None, True), (9, 12, "Old", 1, D(2018, 1, 1), D(2019, 1, 1), False)],
        "history_id long, employee_id long, role string, salary int, effective_start date, "
        "effective_end date, is_current boolean").withColumn("salary", F.col("salary").cast(money))
    staff = spark.createDataFrame(
        [(i, f"N{i}", f"{i}@x", 1, D(2018, 1, 1), 1, "Dev", "Active") for i in (10, 11, 12)],
        "employee_id long, name string, email string, dept_id int, hire_date date, current_salary int, "
        "current_role string, status string").withColumn("current_salary", F.col("current_salary").cast(money))
    run = claim_run(spark, root)
    publish(spark, root, write_operational(spark, root, {"employees": staff, "employee_history": history}, run))


def _changes(spark, *rows):
    return spark.createDataFrame(rows, "change_id long, employee_id long, role string, salary int, "
                                       "effective_start date").withColumn("salary", F.col("salary").cast(schemas.SALARY))


def _history(spark, root):
    rows = read_published(spark, root, "employee_history", schemas.EMPLOYEE_HISTORY).collect()
    return sorted((r["history_id"], r["employee_id"], r["role"], r["effective_start"], r["effective_end"],
                   r["is_current"]) for r in rows)


def test_role_changes_are_stored_together_or_not_at_all(spark, tmpdir_path, monkeypatch):
    _stored_history(spark, tmpdir_path)
    before = _history(spark, tmpdir_path)
    changes = _changes(spark, (1, 10, "Boss", 5, D(2021, 1, 1)), (2, 12, "Back", 3, D(2018, 6, 1)),
                       (3, 12, "Back", 3, D(2022, 1, 1)))
    with monkeypatch.context() as broken:
        def lost(*_, **__):
            raise RuntimeError("the driver died")

        broken.setattr(load, "publish", lost)
        with pytest.raises(RuntimeError, match="died"):
            publish_role_changes(spark, tmpdir_path, changes)
    assert _history(spark, tmpdir_path) == before  # all was written, nothing is seen
    run = publish_role_changes(spark, tmpdir_path, changes)
    after = _history(spark, tmpdir_path)
    assert [r[:1] + r[1:] for r in after if r[0] <= 9 and r[0] != 2] == [r for r in before if r[0] != 2]
    assert after[1] == (2, 10, "Lead", D(2020, 1, 1), D(2020, 12, 31), False)
    assert {r[0] for r in after[-2:]} == {10, 11} and all(r[5] for r in after[-2:])
    staff = read_published(spark, tmpdir_path, "employees", schemas.EMPLOYEES).collect()
    assert {r["employee_id"]: r["current_role"] for r in staff} == {10: "Boss", 11: "Dev", 12: "Back"}
    rejects = read_published(spark, tmpdir_path, "role_change_rejects", schemas.ROLE_CHANGE_REJECTS).collect()
    assert [r["change_id"] for r in rejects] == [2]
    # closed versions are stored once: this run's folder holds only the one that it closed
    assert spark.read.parquet(f"{tmpdir_path}/employee_history/closed/run={run}").count() == 1


def test_history_ids_are_never_given_twice(spark, tmpdir_path):
    _stored_history(spark, tmpdir_path)
    publish_role_changes(spark, tmpdir_path, _changes(spark, (1, 10, "A", 5, D(2021, 1, 1))))
    assert current_versions(spark, tmpdir_path)[LAST_HISTORY_ID] == 10
    # the newest version is deleted; its id is not used again
    kept = read_published(spark, tmpdir_path, "employee_history", schemas.EMPLOYEE_HISTORY).where("history_id <> 10")
    base, run = current_versions(spark, tmpdir_path), claim_run(spark, tmpdir_path)
    write_scd2_unpublished(kept.where("is_current"), tmpdir_path, "employee_history", run)
    publish(spark, tmpdir_path, {"employee_history": run}, based_on=base)
    publish_role_changes(spark, tmpdir_path, _changes(spark, (2, 11, "B", 5, D(2021, 1, 1))))
    assert max(r[0] for r in _history(spark, tmpdir_path)) == 11


def test_onboarding_reads_and_writes_open_versions_only(spark, tmpdir_path):
    _stored_history(spark, tmpdir_path)
    batch, tables = _onboarding(spark)
    stored = {"employees": read_published(spark, tmpdir_path, "employees", schemas.EMPLOYEES),
              "employee_history": read_published(spark, tmpdir_path, "employee_history", schemas.EMPLOYEE_HISTORY),
              "assignments": tables["assignments"]}
    count = stored["employee_history"].count()
    publish_onboarding(spark, tmpdir_path, batch, stored)
    assert len(_history(spark, tmpdir_path)) == count + batch["employee_history"].count()
    source = TableSource(kind="published", root=tmpdir_path)
    assert read_table(spark, source, "employee_history").count() == count + 1


def test_shared_folder_is_demanded_unless_local():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(type("Session", (), {"sparkContext": Context()})())


def test_jdbc_tables_need_partitioning(monkeypatch):
    monkeypatch.setenv("DB_PASSWORD", "secret")
    source = TableSource(kind="jdbc", url="jdbc:mysql://db:3306/hr")
    assert source.jdbc_options("departments")["dbtable"] == "departments"
    with pytest.raises(ValueError, match="partitioning"):
        source.jdbc_options("employees")
