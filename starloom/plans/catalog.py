"""Named queries over a scale-factor folder of the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from
the staged tables (``starloom.sources.staging``) by the library operators.
``starloom.plans.oracle`` holds the equivalent SQL for each name.
"""

from __future__ import annotations

import datetime as dt
import re
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import quality
from starloom.operators.clean import (
    clean_raw_snapshot,
    departments_from_snapshot,
    employees_from_snapshot,
    ladder_frames,
    prepare_attrition,
    resolve_departments,
    resolve_projects,
    role_levels,
)
from starloom.operators.dims import build_dim_date, build_dim_department, build_dim_project
from starloom.operators.fact import (
    enriched_assignments,
    fact_from_enriched,
    rejects_from_enriched,
    require_snapshot_date,
)
from starloom.operators.load import (
    apply_role_changes,
    claim_run,
    new_dates,
    new_departments,
    onboard,
    publish,
    publish_role_changes,
    read_published,
    table_counts,
    upsert_dim_project,
    version_folders,
    write_operational,
    write_scd2_unpublished,
)
from starloom.operators.scd2 import interval_violations, scd2_backfill, scd2_changes, versions_at, versions_of
from starloom.plans import reports
from starloom.plans.etl import run_etl, warehouse_tables
from starloom.plans.warehouse import Warehouse, build_warehouse
from starloom.sources.breaks import with_broken_rules
from starloom.sources.csv import read_raw_snapshot
from starloom.sources.staging import AS_OF, DIM_CUTOFF, OLTP, PREVIOUS_DATES_BEFORE, Staging
from starloom.sources.tables import TableSource, employees_with_department, register_database, run_sql


_PUBLISHED: dict[tuple[str, str], dict[str, DataFrame]] = {}
_STAGINGS: dict[tuple[str, str], Staging] = {}
_LOCK = threading.RLock()  # one ETL per session and folder, even across threads


def _staging(spark: SparkSession, sf_dir: str) -> Staging:
    """One staging per session and folder, so its lazily built tables are reused."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key not in _STAGINGS:
            _STAGINGS[key] = Staging(spark, sf_dir)
        return _STAGINGS[key]


class Scenario:
    """Staged tables plus the warehouse built from them, for one folder.

    ``wh`` is the lazy warehouse plan over the staged sources (what the ETL
    operators compute); ``published()`` is the warehouse the ETL wrote, which
    reports and quality checks read, as they would in production.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.st = _staging(spark, sf_dir)
        self._wh: Warehouse | None = None

    @property
    def wh(self) -> Warehouse:
        if self._wh is None:
            st = self.st
            self._wh = build_warehouse(
                _LazyTables(st), None, lambda: st["dim_employee_before"], AS_OF
            )
        return self._wh

    def published(self) -> dict[str, DataFrame]:
        """Run the ETL once per session (seeded with the prior dim_employee) and
        return the published star schema."""
        key = (self.spark.sparkContext.applicationId, self.st.sf_dir)
        with _LOCK:
            return self._publish_once(key)

    def _publish_once(self, key: tuple[str, str]) -> dict[str, DataFrame]:
        if key not in _PUBLISHED:
            self.st.materialize()
            warehouse = f"{self.st.store_root}/warehouse"
            write_scd2_unpublished(self.st["dim_employee_before"], warehouse, "dim_employee", 1)
            publish(self.spark, warehouse, {"dim_employee": 1})
            run_etl(self.spark, TableSource(root=self.st.oltp_root), warehouse, AS_OF,
                    self.st.attrition_csv())
            _PUBLISHED[key] = warehouse_tables(self.spark, warehouse)
        return _PUBLISHED[key]

    def oltp(self) -> dict[str, DataFrame]:
        return {t: self.st[t] for t in OLTP}

    def olap(self) -> dict[str, DataFrame]:
        return self.published()

    def all_tables(self) -> dict[str, DataFrame]:
        return {**self.oltp(), **self.olap()}


def _changed_store(s: Scenario) -> str:
    """A folder in which the staged tables were published and then changed, once per session."""
    root = f"{s.st.store_root}/changed"
    key = (s.spark.sparkContext.applicationId, root)
    with _LOCK:
        if key not in _PUBLISHED:
            start = {"employees": s.st["employees"], "employee_history": s.st["history_before_changes"]}
            publish(s.spark, root, write_operational(s.spark, root, start, claim_run(s.spark, root)))
            publish_role_changes(s.spark, root, s.st["dirty_role_changes"])
            _PUBLISHED[key] = {}
    return root


def _changed(s: Scenario, name: str, schema=None) -> DataFrame:
    return read_published(s.spark, _changed_store(s), name, schema or schemas.SCHEMAS[name])


def _across_databases(s: Scenario) -> DataFrame:
    """Operational staff beside their open dimension rows, as SQL over registered databases."""
    s.published()
    root = f"{s.st.store_root}/databases"
    oltp, olap = (re.sub(r"\W", "_", f"starloom_{kind}_{s.st.sf_dir}") for kind in ("oltp", "olap"))
    register_database(s.spark, oltp, {"employees": f"{s.st.oltp_root}/employees"}, f"{root}/oltp")
    at = version_folders(s.spark, f"{s.st.store_root}/warehouse", "dim_employee")
    register_database(s.spark, olap, {"dim_employee": at[0]}, f"{root}/olap")
    return run_sql(s.spark, f"""
        SELECT e.employee_id, d.employee_key, d.role, e.current_salary
        FROM {oltp}.employees e JOIN {olap}.dim_employee d ON d.employee_id = e.employee_id
        WHERE e.current_salary > :least""", least=LEAST_SALARY)


class _LazyTables(dict):
    """Mapping of staged operational tables, each built on first access."""

    def __init__(self, st: Staging):
        super().__init__()
        self.st = st

    def __missing__(self, key: str) -> DataFrame:
        value = self.st[key]
        self[key] = value
        return value


def _broken(s: Scenario) -> dict[str, DataFrame]:
    """All tables with rows that break each rule."""
    return {name: with_broken_rules(df, name) for name, df in s.all_tables().items()}


def _rule_union(s: Scenario, fn, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    tables = s.all_tables() if tables is None else tables
    parts = [fn(tables, name) for name in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Role ladders of the staged scenario: three departments with a ladder of
# order priorities, one alias; every other department has none (fixed values).
STAGED_LADDERS: dict[str, list[str]] = {
    "NATION_0": ["5-LOW", "4-NOT SPECIFIED", "2-HIGH"],
    "NATION_1": ["5-LOW", "2-HIGH"],
    "NATION_2": ["4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"],
}
# A date after the end of every project that ends.
LATER = dt.date(2000, 6, 1)
# Names compared without case, accents and trailing blanks.
COLLATION = "UNICODE_CI_AI_RTRIM"
# A parameter of the statement over two databases.
LEAST_SALARY = 200_000
# Parameters of the reports on one employee and one department.
ONE_EMPLOYEE = 7
ONE_DEPARTMENT = "NATION_3"
STAGED_ALIASES: dict[str, str] = {"1-URGENT": "2-HIGH"}


def _star(s: Scenario, *names: str) -> list[DataFrame]:
    tables = s.published()
    return [tables["fact_employee_performance" if n == "fact" else n] for n in names]


def _enriched(s: Scenario, as_of: dt.date = AS_OF, point_in_time: bool = False, **other: DataFrame) -> DataFrame:
    """The fact's joined rows over the published dimensions (or ``other`` states of
    some), as the ETL builds them."""
    st, star = s.st, {**s.published(), **other}
    require_snapshot_date(star["dim_date"], as_of)
    return enriched_assignments(
        employees_with_department(st["employees"], st["departments"]), st["projects"],
        st["assignments"], prepare_attrition(st["attrition_raw"]), star["dim_employee"],
        star["dim_department"], star["dim_project"], as_of, None, point_in_time,
    )


def _dim_date(s: Scenario, as_of: dt.date) -> DataFrame:
    return build_dim_date(employees_with_department(s.st["employees"], s.st["departments"]), s.st["assignments"], as_of)


def _backfilled(s: Scenario, employees: DataFrame | None = None) -> DataFrame:
    """The prior dim_employee with every version of the history; employees who are gone are closed."""
    return scd2_backfill(s.st["dim_employee_before"], s.st["employees"] if employees is None else employees,
                         s.st["employee_history"], AS_OF)


def _named_otherwise(s: Scenario) -> DataFrame:
    """Projects under names that only a collation holds equal to the known ones."""
    odd = F.col("project_id") % 2 == 1
    return s.st["projects"].withColumn(
        "project_name", F.when(odd, F.concat(F.upper("project_name"), F.lit("  "))).otherwise(F.col("project_name")))


def _onboard(s: Scenario) -> dict[str, DataFrame]:
    st = s.st
    return onboard(
        st["hire_requests"], st["employees"], st["assignments"], st["departments"], st["projects"],
        st["employee_history"],
    )


def _role_changes(s: Scenario) -> tuple[DataFrame, DataFrame, DataFrame]:
    return apply_role_changes(
        s.st["history_before_changes"], s.st["employees"], s.st["dirty_role_changes"]
    )


BUILDERS: dict[str, Callable[[Scenario], DataFrame]] = {
    # sources, cleaning
    "employees_enriched": lambda s: employees_with_department(s.st["employees"], s.st["departments"]),
    "attrition_snapshot": lambda s: prepare_attrition(s.st["attrition_raw"]),
    "attrition_snapshot_repeated": lambda s: prepare_attrition(s.st["attrition_raw"].unionByName(
        s.st["attrition_raw"].where("EmployeeNumber % 2 = 0").withColumns(
            {"Attrition": F.lit("Maybe"), "DistanceFromHome": F.lit(0)}))),
    "clean_employees": lambda s: employees_from_snapshot(
        clean_raw_snapshot(s.st["raw_snapshot"]), AS_OF
    ),
    "departments_from_snapshot": lambda s: departments_from_snapshot(
        clean_raw_snapshot(s.st["raw_snapshot"])),
    # the same through a text file and the check of its columns
    "clean_employees_from_csv": lambda s: employees_from_snapshot(
        clean_raw_snapshot(read_raw_snapshot(s.spark, s.st.raw_snapshot_csv())), AS_OF),
    # one statement with a named parameter over tables of two databases
    "salaries_across_databases": lambda s: _across_databases(s),
    "hire_date_backcast": lambda s: employees_from_snapshot(
        clean_raw_snapshot(s.st["raw_snapshot"]), AS_OF
    ).select("employee_id", "hire_date"),
    "resolve_lookups": lambda s: resolve_projects(
        resolve_departments(s.st["lookup_requests"], s.st["departments"]), s.st["projects"]
    ).select("request_id", "dept_name", "project_name", "dept_id", "project_id"),
    "role_levels": lambda s: role_levels(
        employees_with_department(s.st["employees"], s.st["departments"]).select(
            "employee_id", "dept_name", "current_role"
        ),
        *ladder_frames(s.spark, STAGED_LADDERS, STAGED_ALIASES),
    ),
    "active_projects": lambda s: reports.active_projects(s.st["projects"], AS_OF),
    # dimensions and loads
    "dim_department": lambda s: s.wh.dim_department,
    "dim_project": lambda s: s.wh.dim_project,
    "dim_date": lambda s: s.wh.dim_date,
    "dim_date_second": lambda s: _dim_date(s, LATER),
    "dim_project_upsert_partial": lambda s: upsert_dim_project(
        build_dim_project(s.st["projects"].where("length(project_name) % 3 <> 1")),
        s.st["dim_project_before"].where("length(project_name) % 3 <> 0")),
    "dim_project_upsert_collated": lambda s: upsert_dim_project(
        build_dim_project(_named_otherwise(s), COLLATION), s.st["dim_project_before"].where("length(project_name) % 3 <> 0"),
        COLLATION),
    "resolve_lookups_collated": lambda s: resolve_projects(
        s.st["lookup_requests"].select("request_id", "project_name"), _named_otherwise(s), COLLATION),
    "new_dates": lambda s: new_dates(
        s.wh.dim_date, s.wh.dim_date.where(F.col("full_date") < F.lit(PREVIOUS_DATES_BEFORE))
    ),
    "new_departments": lambda s: new_departments(
        build_dim_department(s.st["departments"]), s.st["dim_department_before"]
    ),
    "dim_project_upsert": lambda s: upsert_dim_project(
        build_dim_project(s.st["projects"]), s.st["dim_project_before"]
    ),
    # SCD2
    "scd2_changes": lambda s: s.wh.scd2_changes,
    "dim_employee_after": lambda s: s.wh.dim_employee,
    "scd2_backfill": lambda s: _backfilled(s, s.st["employees"].where("employee_id % 11 <> 0")),
    "assignment_versions": lambda s: versions_at(
        s.st["assignments"].select("assignment_id", "employee_id", "start_date"), _backfilled(s), "start_date"),
    "scd2_from_changelog": lambda s: s.st["employee_history"],
    "scd2_integrity": lambda s: interval_violations(
        s.st["employee_history"], "employee_id"
    ).unionByName(
        interval_violations(s.published()["dim_employee"], "employee_id", table="dim_employee")
    ).unionByName(
        interval_violations(
            s.st["assignments"], "employee_id", "start_date", "end_date", table="assignments"
        )
    ),
    "apply_role_changes": lambda s: apply_role_changes(
        s.st["history_before_changes"], s.st["employees"], s.st["role_changes"]
    )[0].select("employee_id", "role", "salary", "effective_start", "effective_end", "is_current"),
    "role_change_rejects": lambda s: _role_changes(s)[2],
    # the same batch of changes stored: what readers of the published tables see
    "role_changes_published": lambda s: _changed(s, "employee_history").select(
        "employee_id", "role", "salary", "effective_start", "effective_end", "is_current"),
    "role_changes_published_employees": lambda s: _changed(s, "employees"),
    "role_changes_published_rejects": lambda s: _changed(s, "role_change_rejects", schemas.ROLE_CHANGE_REJECTS),
    "role_change_employees": lambda s: _role_changes(s)[1].select(
        "employee_id", "current_role", "current_salary"),
    "onboard_employees": lambda s: _onboard(s)["employees"],
    "onboard_history": lambda s: _onboard(s)["employee_history"],
    "onboard_assignments": lambda s: _onboard(s)["assignments"],
    "onboard_hires": lambda s: _onboard(s)["hires"],
    "onboard_rejects": lambda s: _onboard(s)["rejected"],
    # fact
    "fact_employee_performance": lambda s: fact_from_enriched(_enriched(s)),
    "fact_rejects": lambda s: rejects_from_enriched(_enriched(s)),
    "fact_second_snapshot": lambda s: fact_from_enriched(_enriched(s, LATER, dim_date=_dim_date(s, LATER))),
    "fact_point_in_time": lambda s: fact_from_enriched(
        _enriched(s, point_in_time=True, dim_employee=_backfilled(s))),
    "fact_point_in_time_rejects": lambda s: rejects_from_enriched(
        _enriched(s, point_in_time=True, dim_employee=_backfilled(s))),
    # the same rules where they must act: against the earlier department dimension,
    # an older source, versions appended without closing, and a later date
    "fact_rejects_earlier_departments": lambda s: rejects_from_enriched(
        _enriched(s, dim_department=s.st["dim_department_before"])),
    "dq_foreign_key_earlier_departments": lambda s: quality.foreign_key_violations(
        {**s.published(), "dim_department": s.st["dim_department_before"]}, "fact_employee_performance"),
    "dq_one_current_unclosed": lambda s: quality.one_current_violations(
        s.st["history_before_changes"].unionByName(
            s.st["employee_history"].where(F.col("effective_start") > F.lit(DIM_CUTOFF))),
        "employee_history"),
    "scd2_rejects": lambda s: scd2_changes(
        s.st["employees"], s.st["history_before_changes"], s.published()["dim_employee"]
    ).where(F.col("action") == "reject").select("employee_id", "role", "effective_start", "close_date", "reason"),
    "active_projects_later": lambda s: reports.active_projects(s.st["projects"], LATER),
    "active_projects_none_open": lambda s: reports.active_projects(
        s.st["projects"].where(F.col("end_date").isNotNull()), LATER),
    # reports
    "tenure_ranking": lambda s: reports.tenure_ranking(*_star(s, "fact", "dim_employee",
                                                              "dim_department")),
    "tenure_top_n": lambda s: reports.tenure_ranking(
        *_star(s, "fact", "dim_employee", "dim_department"), top_n=5
    ),
    "monthly_attrition": lambda s: reports.monthly_attrition(
        *_star(s, "fact", "dim_employee", "dim_date"), s.st["employees"]
    ),
    "monthly_headcount": lambda s: reports.monthly_headcount(s.published()["dim_date"], s.st["employees"]),
    "headcount_by_department": lambda s: reports.headcount_by_department(
        *_star(s, "fact", "dim_department", "dim_employee")
    ),
    "employee_salary_history": lambda s: reports.employee_salary_history(s.st["employee_history"]),
    "salary_history_of_one": lambda s: reports.employee_salary_history(
        s.st["employee_history"], employee_id=ONE_EMPLOYEE),
    "salary_trend_of_one": lambda s: reports.department_salary_trend(
        s.st["employee_history"], s.st["employees"], s.st["departments"], dept_name=ONE_DEPARTMENT),
    "versions_of_one": lambda s: versions_of(s.published()["dim_employee"], ONE_EMPLOYEE),
    "scd2_versions": lambda s: versions_of(s.published()["dim_employee"]),
    "department_salary_trend": lambda s: reports.department_salary_trend(
        s.st["employee_history"], s.st["employees"], s.st["departments"]
    ),
    "picklists": lambda s: reports.picklists(s.st["departments"], s.st["projects"],
                                             s.st["employees"]),
    # quality
    "over_allocated": lambda s: quality.over_allocated(s.st["assignments"]),
    "dq_not_null": lambda s: _rule_union(s, lambda t, n: quality.not_null_violations(t[n], n)),
    "dq_unique": lambda s: _rule_union(s, lambda t, n: quality.unique_violations(t[n], n)),
    "dq_foreign_key": lambda s: _rule_union(s, quality.foreign_key_violations),
    "dq_check": lambda s: _rule_union(s, lambda t, n: quality.check_violations(t[n], n)),
    # the same rules where each of them is broken by some rows
    "dq_not_null_broken": lambda s: _rule_union(s, lambda t, n: quality.not_null_violations(t[n], n), _broken(s)),
    "dq_unique_broken": lambda s: _rule_union(s, lambda t, n: quality.unique_violations(t[n], n), _broken(s)),
    "dq_check_broken": lambda s: _rule_union(s, lambda t, n: quality.check_violations(t[n], n), _broken(s)),
    "dq_foreign_key_broken": lambda s: _rule_union(s, quality.foreign_key_violations, _broken(s)),
    "load_rejects": lambda s: quality.gate({t: with_broken_rules(s.st[t], t) for t in OLTP})[1].drop("record"),
    "dq_one_current": lambda s: quality.one_current_violations(
        s.st["employee_history"], "employee_history"
    ).unionByName(
        quality.one_current_violations(s.published()["dim_employee"], "dim_employee")
    ),
    "table_counts": lambda s: table_counts(s.all_tables()),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """``name -> (spark, sf_dir) -> DataFrame`` for every catalog entry."""
    def bind(builder):
        return lambda spark, sf_dir: builder(Scenario(spark, sf_dir))

    return {name: bind(b) for name, b in BUILDERS.items()}
