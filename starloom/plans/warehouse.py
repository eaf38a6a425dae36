"""The star schema as one lazy plan (the transform half of the ETL).

``build_warehouse`` takes the operational frames and the previous dimension
states and exposes every dimension, the change set and the fact as lazy
DataFrames, each built on first use (a report that needs two dimensions does
not pay for analysing the others).  ``starloom.plans.etl`` materialises
them; reports and the query catalog use them directly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from starloom.operators.clean import prepare_attrition
from starloom.operators.dims import (
    build_dim_date,
    build_dim_department,
    build_dim_project,
    key_dim_department,
    key_dim_project,
)
from starloom.operators.fact import enriched_assignments, fact_from_enriched, rejects_from_enriched
from starloom.operators.scd2 import apply_scd2, scd2_changes
from starloom.sources.tables import employees_with_department


class Warehouse:
    """Dimensions, SCD2 change set and fact over one set of sources."""

    def __init__(
        self,
        oltp: Mapping[str, DataFrame],
        attrition_raw: DataFrame | None,
        dim_employee_before: DataFrame | Callable[[], DataFrame],
        as_of: dt.date,
        dim_department: DataFrame | None = None,
        dim_project: DataFrame | None = None,
        collation: str | None = None,
    ):
        self.collation = collation
        self.oltp = oltp
        self.attrition_raw = attrition_raw
        self._dim_employee_before = dim_employee_before
        self.as_of = as_of
        self._dim_department = dim_department
        self._dim_project = dim_project

    @cached_property
    def dim_employee_before(self) -> DataFrame:
        before = self._dim_employee_before
        return before if isinstance(before, DataFrame) else before()

    @cached_property
    def employees(self) -> DataFrame:
        return employees_with_department(self.oltp["employees"], self.oltp["departments"])

    @cached_property
    def attrition(self) -> DataFrame:
        raw = self.attrition_raw if self.attrition_raw is not None else self.oltp["attrition_raw"]
        return prepare_attrition(raw)

    @cached_property
    def dim_department(self) -> DataFrame:
        if self._dim_department is not None:
            return self._dim_department
        return key_dim_department(build_dim_department(self.oltp["departments"], self.collation))

    @cached_property
    def dim_project(self) -> DataFrame:
        if self._dim_project is not None:
            return self._dim_project
        return key_dim_project(build_dim_project(self.oltp["projects"], self.collation))

    @cached_property
    def dim_date(self) -> DataFrame:
        return build_dim_date(self.employees, self.oltp["assignments"], self.as_of)

    @cached_property
    def scd2_changes(self) -> DataFrame:
        return scd2_changes(self.employees, self.oltp["employee_history"], self.dim_employee_before)

    @cached_property
    def dim_employee(self) -> DataFrame:
        return apply_scd2(self.dim_employee_before, self.scd2_changes)

    @cached_property
    def enriched(self) -> DataFrame:
        return enriched_assignments(
            self.employees, self.oltp["projects"], self.oltp["assignments"], self.attrition,
            self.dim_employee, self.dim_department, self.dim_project, self.as_of, self.collation,
        )

    @cached_property
    def fact(self) -> DataFrame:
        return fact_from_enriched(self.enriched)

    @cached_property
    def rejects(self) -> DataFrame:
        return rejects_from_enriched(self.enriched)


def build_warehouse(
    oltp: Mapping[str, DataFrame],
    attrition_raw: DataFrame | None,
    dim_employee_before: DataFrame | Callable[[], DataFrame],
    as_of: dt.date,
    dim_department: DataFrame | None = None,
    dim_project: DataFrame | None = None,
    collation: str | None = None,
) -> Warehouse:
    """First-load dims unless keyed ``dim_department``/``dim_project`` are given.

    ``collation`` (e.g. ``UNICODE_CI_AI_RTRIM``) conforms department names the
    way a case-insensitive database collation would (D9); binary by default.
    """
    return Warehouse(
        oltp, attrition_raw, dim_employee_before, as_of, dim_department, dim_project, collation
    )
