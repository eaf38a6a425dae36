"""Equivalent SQL for every catalog query (DuckDB dialect, standard where possible).

The driver runs these against the same parquet tables (registered as views
named like the files) and compares them with the Spark results.  Staging,
dimensions, SCD2 and the fact are written once as CTEs; each query is a final
``SELECT`` over them.  Where DuckDB computes in DOUBLE what Spark computes in
DECIMAL, an exact half-up integer form is used instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from starloom.operators.keys import BUCKET_DIGITS
from starloom.schemas import FACT_COLUMNS, RULES, SCHEMAS
from starloom.sources.breaks import broken_columns
from starloom.sources.staging import DIM_CUTOFF


def keyed(src: str, order_cols: list[str], key: str, base: str = "0", spread: bool = False) -> str:
    """SQL of ``assign_dense_keys``: the bucket is the head of the first order column's MD5 (``spread``: of all)."""
    named = "concat_ws('|', " + ", ".join(f"cast({c} as varchar)" for c in order_cols[:None if spread else 1]) + ")"
    bk = f"substr(md5({named}), 1, {BUCKET_DIGITS})"
    order = ", ".join(order_cols)
    return f"""(select k.* exclude (_kb, _kr), cast(({base}) + o._ko + k._kr as bigint) as {key}
  from (select s.*, {bk} as _kb, row_number() over (partition by {bk} order by {order}) as _kr
        from {src} s) k
  join (select _kb, coalesce(sum(_kc) over (order by _kb rows between unbounded preceding
                                            and 1 preceding), 0) as _ko
        from (select {bk} as _kb, count(*) as _kc from {src} s group by 1) c) o
    on k._kb = o._kb)"""


def changelog_versions(log: str) -> str:
    """SQL of ``intervals_from_changelog`` for an order-shaped change log."""
    return f"""select change_id as history_id, employee_id, role, salary, effective_start,
       cast(lead(effective_start) over w - interval 1 day as date) as effective_end,
       lead(effective_start) over w is null as is_current
from (select * from {log}
      qualify row_number() over (partition by employee_id, effective_start
                                 order by change_id desc) = 1) d
window w as (partition by employee_id order by effective_start)"""


def _dim_department_sql(src: str, base: str = "0") -> str:
    inner = f"(select dept_name, cast(min(dept_id) as bigint) as source_id from {src} group by dept_name)"
    return f"select department_key, dept_name from {keyed(inner, ['source_id'], 'department_key', base)}"


def _dim_project_sql(src: str) -> str:
    inner = (
        f"(select project_name, arg_min(budget, project_id) as budget, "
        f"min(project_id) as source_id from {src} group by project_name)"
    )
    return f"select project_key, project_name, budget from {keyed(inner, ['source_id'], 'project_key')}"


def _projects_from(part: str) -> str:
    return f"""select p_partkey as project_id, p_name as project_name, date '1995-01-01' as start_date,
       case when p_size <= 25 then date '1999-12-31' end as end_date,
       cast(p_retailprice as decimal(14,2)) as budget
from {part}"""


_SCD2_INSERTS = keyed(
    "(select employee_id, name, role, effective_start from scd2_changes "
    "where action in ('insert', 'close_insert'))",
    ["employee_id", "effective_start"],
    "employee_key",
    "select coalesce(max(employee_key), 0) from dim_employee_before",
)

_ONBOARD_OK = keyed(
    keyed(
        "(select * from onboard_checked where reason is null)",
        ["request_id"],
        "employee_id",
        "select coalesce(max(employee_id), 0) from employees",
    ),
    ["request_id"],
    "assignment_id",
    "select coalesce(max(assignment_id), 0) from assignments",
)

PRELUDE = f"""with
departments as (select cast(n_nationkey as integer) as dept_id, n_name as dept_name from nation),
order_log as (
  select o_orderkey as change_id, o_custkey as employee_id, o_orderpriority as role,
         cast(o_totalprice as decimal(12,2)) as salary, cast(o_orderdate as date) as effective_start
  from orders),
employee_history as ({changelog_versions('order_log')}),
employees as (
  select c.c_custkey as employee_id, c.c_name as name, lower(c.c_name) || '@example.com' as email,
         cast(c.c_nationkey as integer) as dept_id, s.hire_date, h.salary as current_salary,
         h.role as current_role,
         case when c.c_mktsegment = 'AUTOMOBILE' then 'Terminated' else 'Active' end as status
  from customer c
  join (select employee_id, min(effective_start) as hire_date from order_log group by employee_id) s
    on s.employee_id = c.c_custkey
  join employee_history h on h.employee_id = c.c_custkey and h.is_current),
projects as ({_projects_from('part')}),
assignments as (
  select l_orderkey * 10 + l_linenumber as assignment_id, o_custkey as employee_id,
         l_partkey as project_id, cast(l_quantity as decimal(5,2)) as allocation_pct,
         cast(o_orderdate as date) as start_date, cast(l_shipdate as date) as end_date
  from lineitem join orders on l_orderkey = o_orderkey),
attrition_raw as (
  select c_custkey as "EmployeeNumber",
         case when c_mktsegment = 'AUTOMOBILE' and c_acctbal >= 0 and c_acctbal >= 5000 then 'YES'
              when c_mktsegment = 'AUTOMOBILE' and c_acctbal >= 0 then 'Yes' else 'No' end
           as "Attrition",
         case when c_acctbal >= 0 then cast(c_custkey % 4 + 1 as integer) end as "JobSatisfaction",
         cast((c_custkey * 7) % 4 + 1 as integer) as "WorkLifeBalance",
         case when c_nationkey % 3 = 0 then 'yes' else 'No' end as "OverTime",
         cast(c_custkey % 2 + 3 as integer) as "PerformanceRating",
         cast(c_custkey % 29 + 1 as integer) as "DistanceFromHome"
  from customer where c_mktsegment <> 'HOUSEHOLD'),
attrition as (
  select cast("EmployeeNumber" as bigint) as employee_id,
         coalesce(lower("Attrition") = 'yes', false) as is_attrition_flag,
         "JobSatisfaction" as job_satisfaction, "WorkLifeBalance" as work_life_balance,
         coalesce(lower("OverTime") = 'yes', false) as overtime,
         "PerformanceRating" as performance_rating, "DistanceFromHome" as distance_from_home
  from attrition_raw
  qualify row_number() over (partition by "EmployeeNumber"
      order by "Attrition" nulls first, "JobSatisfaction" nulls first, "WorkLifeBalance" nulls first,
               "OverTime" nulls first, "PerformanceRating" nulls first,
               "DistanceFromHome" nulls first) = 1),
dim_employee_before as (
  select employee_key, employee_id, name, role, true as is_current, effective_start,
         cast(null as date) as effective_end
  from {keyed('''(select h.employee_id, h.effective_start, h.role, c.c_name as name
      from (select employee_id, effective_start, role from employee_history
            where effective_start <= date '1999-12-31'
            qualify row_number() over (partition by employee_id order by effective_start desc) = 1) h
      join customer c on c.c_custkey = h.employee_id)''', ['employee_id'], 'employee_key')}),
employees_x as (
  select e.employee_id, e.name, e.email, e.dept_id, e.hire_date, e.current_salary,
         e.current_role, e.status, d.dept_name
  from employees e join departments d on e.dept_id = d.dept_id),
dim_department as ({_dim_department_sql('departments')}),
dim_project as ({_dim_project_sql('projects')}),
dim_date as (
  select cast(year(d) * 10000 + month(d) * 100 + day(d) as integer) as date_key, d as full_date,
         cast(month(d) as integer) as month, cast(quarter(d) as integer) as quarter,
         cast(year(d) as integer) as year
  from (select date '1998-01-01' as d union select hire_date from employees_x
        union select start_date from assignments union select end_date from assignments) u
  where d is not null),
cur_src as (
  select h.employee_id, h.role, h.effective_start, e.name
  from employee_history h join employees_x e on e.employee_id = h.employee_id
  where h.is_current),
dim_cur as (
  select employee_id, employee_key as dim_employee_key, name as dim_name, role as dim_role,
         effective_start as dim_effective_start
  from dim_employee_before where is_current
  qualify row_number() over (partition by employee_id order by employee_key) = 1),
scd2_changes as (
  select employee_id, action, employee_key, name, role, effective_start,
         case when action in ('close_insert', 'reject')
              then cast(effective_start - interval 1 day as date) end as close_date,
         case when action = 'reject'
              then 'close date before the start of the version it closes' end as reason
  from (select s.employee_id,
               case when d.dim_employee_key is null then 'insert'
                    when s.name is not distinct from d.dim_name
                     and s.role is not distinct from d.dim_role
                     and s.effective_start is not distinct from d.dim_effective_start then 'skip'
                    when cast(s.effective_start - interval 1 day as date) < d.dim_effective_start
                      then 'reject'
                    else 'close_insert' end as action,
               d.dim_employee_key as employee_key, s.name, s.role, s.effective_start
        from cur_src s left join dim_cur d on d.employee_id = s.employee_id) x),
closes as (select employee_key as ck, close_date from scd2_changes where action = 'close_insert'),
dim_employee as (
  select b.employee_key, b.employee_id, b.name, b.role,
         case when c.ck is not null then false else b.is_current end as is_current,
         b.effective_start,
         case when c.ck is not null then c.close_date else b.effective_end end as effective_end
  from dim_employee_before b left join closes c on b.employee_key = c.ck
  union all
  select employee_key, employee_id, name, role, true, effective_start, cast(null as date)
  from {_SCD2_INSERTS}),
emp_keys as (select employee_key, employee_id from dim_employee where is_current),
staff as (
  select e.employee_id, e.dept_name, e.hire_date, e.current_salary, e.status, dd.department_key
  from employees_x e left join dim_department dd on dd.dept_name = e.dept_name),
profile as (
  select k.employee_key, k.employee_id, s.dept_name, s.hire_date, s.current_salary, s.status,
         s.department_key, a.employee_id is not null as in_snapshot, a.is_attrition_flag,
         a.job_satisfaction, a.work_life_balance, a.overtime, a.performance_rating,
         a.distance_from_home
  from emp_keys k left join staff s on s.employee_id = k.employee_id
  left join attrition a on a.employee_id = k.employee_id),
proj_lookup as (
  select p.project_id, p.project_name, dp.project_key
  from projects p left join dim_project dp on dp.project_name = p.project_name),
enriched as (
  select a.assignment_id, a.employee_id, a.project_id, pr.dept_name, pl.project_name,
         pr.employee_key, pr.department_key, pl.project_key, 19980101 as date_key,
         cast(pr.current_salary as decimal(12,2)) as salary,
         cast(a.allocation_pct as decimal(5,2)) as allocation_pct,
         case when pr.hire_date is null then null
              else cast(greatest(date_diff('day', pr.hire_date, date '1998-01-01'), 0) as integer)
         end as tenure_days,
         case when pr.in_snapshot then pr.is_attrition_flag
              else coalesce(lower(pr.status) = 'terminated', false) end as is_attrition_flag,
         case when pr.in_snapshot then pr.job_satisfaction else 3 end as job_satisfaction,
         case when pr.in_snapshot then pr.work_life_balance else 3 end as work_life_balance,
         case when pr.in_snapshot then pr.overtime else false end as overtime,
         case when pr.in_snapshot then pr.performance_rating else 3 end as performance_rating,
         case when pr.in_snapshot then pr.distance_from_home else 0 end as distance_from_home
  from assignments a join profile pr on pr.employee_id = a.employee_id
  left join proj_lookup pl on pl.project_id = a.project_id),
fact as (
  select assignment_id, employee_key, department_key, project_key, date_key, salary, allocation_pct, tenure_days,
         is_attrition_flag, job_satisfaction, work_life_balance, overtime, performance_rating,
         distance_from_home
  from enriched
  where employee_key is not null and department_key is not null and project_key is not null),
fact_employee_performance as (select * from fact),
raw_snapshot as (
  select c.c_custkey as employee_id, split_part(c.c_name, '#', 1) as first_name,
         split_part(c.c_name, '#', 2) as last_name, n.n_name as dept_name,
         c.c_mktsegment as job_role, cast(cast(c.c_acctbal as varchar) as double) as monthly_income,
         case when c.c_mktsegment = 'AUTOMOBILE' then 'Yes' else 'No' end as attrition,
         1998 - year(l.last_start) as years_at_company
  from customer c join nation n on c.c_nationkey = n.n_nationkey
  join (select employee_id, max(effective_start) as last_start from order_log group by employee_id) l
    on l.employee_id = c.c_custkey),
clean_employees as (
  select employee_id, first_name || ' ' || last_name as name,
         lower(first_name) || '.' || lower(last_name) || '.' || cast(employee_id as varchar)
           || '@company.com' as email,
         dept_name,
         cast(date '1998-01-01' - to_months(cast(12 * greatest(years_at_company, 0) as integer))
              as date) as hire_date,
         cast(monthly_income as decimal(12,2)) as current_salary, job_role as current_role,
         case when lower(attrition) = 'yes' then 'Terminated' else 'Active' end as status
  from raw_snapshot),
hire_requests as (
  select c.c_custkey as request_id,
         case when c.c_acctbal < -900 then '  ' else 'New ' || c.c_name end as name,
         'new.' || lower(c.c_name) || '@example.com' as email,
         'NATION_' || cast(c.c_nationkey + 1 as varchar) as dept_name,
         cast(date '1998-01-01' + cast(c.c_nationkey as integer) as date) as hire_date,
         cast(c.c_acctbal as decimal(12,2)) as current_salary, c.c_mktsegment as current_role,
         case when c.c_mktsegment = 'MACHINERY' then 'Contractor' else 'Active' end as status,
         p.p_name as project_name,
         cast(floor(c.c_acctbal / 100) as decimal(5,2)) as allocation_pct,
         cast(date '1998-01-01' + cast(c.c_nationkey as integer)
              + cast(c.c_custkey % 5 - 1 as integer) as date) as assignment_start
  from customer c left join part p on c.c_custkey = p.p_partkey),
dept_ids as (select dept_name, min(dept_id) as dept_id from departments group by dept_name),
project_ids as (select project_name, min(project_id) as project_id from projects group by project_name),
onboard_checked as (
  select r.*, d.dept_id, p.project_id,
         case when r.name is null or trim(r.name) = '' or r.email is null or trim(r.email) = ''
                   or r.current_role is null or trim(r.current_role) = ''
                then 'name, email and role are required'
              when r.hire_date is null or r.current_salary is null or r.status is null
                   or r.allocation_pct is null or r.assignment_start is null
                then 'a required value is missing'
              when r.assignment_start < r.hire_date then 'assignment start before hire date'
              when r.current_salary < 0 then 'negative salary'
              when not (r.allocation_pct between 1 and 100) then 'allocation outside 1..100'
              when r.status not in ('Active', 'Terminated') then 'unknown status'
              when d.dept_id is null then 'unknown department'
              when p.project_id is null then 'unknown project' end as reason
  from hire_requests r left join dept_ids d on d.dept_name = r.dept_name
  left join project_ids p on p.project_name = r.project_name),
onboard_ok as (select * from {_ONBOARD_OK}),
ladder as (
  select * from (values
    ('NATION_0', '5-LOW', 0), ('NATION_0', '4-NOT SPECIFIED', 1), ('NATION_0', '2-HIGH', 2),
    ('NATION_1', '5-LOW', 0), ('NATION_1', '2-HIGH', 1),
    ('NATION_2', '4-NOT SPECIFIED', 0), ('NATION_2', '3-MEDIUM', 1), ('NATION_2', '2-HIGH', 2),
    ('NATION_2', '1-URGENT', 3)) as l(department, role, position)),
ladder_sizes as (select department, count(*) as len from ladder group by department),
dept_before as ({_dim_department_sql(
    "(select cast(n_nationkey as integer) as dept_id, n_name as dept_name "
    "from nation where n_regionkey < 4)")}),
proj_before as ({_dim_project_sql("(" + _projects_from("(select * from part where p_size > 10)") + ")")}),
proj_incoming as (
  select project_name as _name, arg_min(budget, project_id) as _budget,
         min(project_id) as source_id
  from projects group by project_name),
proj_merged as (select * from proj_before b full outer join proj_incoming i on b.project_name = i._name)
"""


def _integrity(src: str, key: str, start: str, end: str, table: str) -> str:
    return f"""select '{table}' as table_name, {key} as entity_id, problem,
       {start} as effective_start, {end} as effective_end, count(*) as row_count
from (select *, case when prior_end >= {start} then 'overlap'
                     when prior_end + interval 1 day < {start} then 'gap' end as problem
      from (select {key}, {start}, {end},
                   max(coalesce({end}, date '9999-12-31')) over (
                     partition by {key} order by {start}, {end} nulls first
                     rows between unbounded preceding and 1 preceding) as prior_end
            from {src}) p) q
where problem is not null
group by {key}, problem, {start}, {end}
union all
select '{table}', {key}, 'several_open', cast(null as date), cast(null as date),
       count(*) filter (where {end} is null)
from {src} group by {key} having count(*) filter (where {end} is null) > 1"""


ALL_TABLES = (
    "departments", "employees", "projects", "assignments", "employee_history",
    "dim_date", "dim_department", "dim_project", "dim_employee", "fact_employee_performance",
)


def _key_expr(table: str) -> str:
    rules = RULES[table]
    cols = list(rules.primary_key)
    return "concat_ws('|', " + ", ".join(f"cast({c} as varchar)" for c in cols) + ")"


def _backfill_sql(gone: str = "false") -> str:
    """dim_employee with all versions of the history, as CTEs up to ``backfilled``; ``gone`` picks who left."""
    return f""",
bf_source as (
  select h.employee_id, h.effective_start, h.role, h.effective_end, e.name
  from employee_history h join employees e on e.employee_id = h.employee_id where not ({gone.format('h')})),
bf_both as (
  select b.employee_key, coalesce(b.employee_id, s.employee_id) as employee_id, coalesce(b.name, s.name) as name,
         coalesce(s.role, b.role) as role, coalesce(b.effective_start, s.effective_start) as effective_start,
         case when s.employee_id is not null then s.effective_end else b.effective_end end as own_end,
         b.role as old_role, b.is_current as old_current, b.effective_end as old_end
  from dim_employee_before b full outer join bf_source s
    on s.employee_id = b.employee_id and s.effective_start = b.effective_start),
bf_cut as (
  select *, least(own_end, cast(lead(effective_start) over (partition by employee_id order by effective_start)
                                - interval 1 day as date)) as until from bf_both),
bf_rows as (
  select employee_key, employee_id, name, role, until is null and not ({gone.format('c')}) as is_current, effective_start,
         case when until is null and ({gone.format('c')}) then greatest(date '1998-01-01', effective_start)
              else until end as effective_end, old_role, old_current, old_end
  from bf_cut c),
backfilled as (
  select employee_key, employee_id, name, role, is_current, effective_start, effective_end,
         case when role = old_role and is_current = old_current and effective_end is not distinct from old_end
              then 'keep' else 'update' end as action
  from bf_rows where employee_key is not null
  union all
  select employee_key, employee_id, name, role, is_current, effective_start, effective_end, 'insert'
  from {keyed("(select employee_id, name, role, is_current, effective_start, effective_end from bf_rows where employee_key is null)",
              ["employee_id", "effective_start"], "employee_key",
              "select coalesce(max(employee_key), 0) from dim_employee_before", spread=True)})
"""


def _enriched_at(day: str, employee_key: str) -> str:
    """The fact's joined rows on another day, with the given employee key."""
    key = int(day.replace("-", ""))
    return f""",
then_rows as (
  select e.assignment_id, e.employee_id, e.project_id, e.dept_name, e.project_name, {employee_key} as employee_key,
         e.department_key, e.project_key, {key} as date_key, e.salary, e.allocation_pct,
         cast(greatest(date_diff('day', s.hire_date, date '{day}'), 0) as integer) as tenure_days, e.is_attrition_flag,
         e.job_satisfaction, e.work_life_balance, e.overtime, e.performance_rating, e.distance_from_home
  from enriched e join staff s on s.employee_id = e.employee_id
  left join then_keys t on t.employee_id = e.employee_id)
"""


_COLLATED = """,
named_otherwise as (
  select * replace (case when project_id % 2 = 1 then upper(project_name) || '  ' else project_name end as project_name)
  from projects),
spelled as (
  select lower(rtrim(project_name)) as plain, arg_min(project_name, project_id) as _name,
         arg_min(budget, project_id) as _budget, min(project_id) as source_id
  from named_otherwise group by 1),
some_before as (select * from proj_before where length(project_name) % 3 <> 0),
collated as (select * from some_before b full outer join spelled i on lower(b.project_name) = i.plain)
"""

_PARTIAL = """,
some_before as (select * from proj_before where length(project_name) % 3 <> 0),
some_incoming as (select * from proj_incoming where length(_name) % 3 <> 1),
collated as (select * from some_before b full outer join some_incoming i on b.project_name = i._name)
"""

_UPSERT = """
select project_key, project_name, coalesce(_budget, budget) as budget,
       case when _name is null then 'untouched' when budget = _budget then 'unchanged' else 'changed' end as action
from collated where project_key is not null
union all
select project_key, _name as project_name, _budget as budget, 'inserted' as action
from """ + keyed("(select _name, _budget, source_id from collated where project_key is null)", ["source_id"],
                 "project_key", "select coalesce(max(project_key), 0) from some_before")

_VALID_THEN = _backfill_sql() + """,
then_keys as (
  select employee_id, employee_key from backfilled
  where effective_start <= date '1998-01-01' and (effective_end is null or effective_end >= date '1998-01-01')
  qualify row_number() over (partition by employee_id order by effective_start desc, employee_key desc) = 1)
""" + _enriched_at("1998-01-01", "t.employee_key")


def _broken_tables(tables: Sequence[str] = ALL_TABLES) -> str:
    """The tables with their rules broken, as CTEs ``broken_<table>``."""
    return "".join(f",\nbroken_{t} as (select {', '.join(f'{sql} as {c}' for c, sql in broken_columns(t))} from {t})"
                   for t in tables) + "\n"


def _gate_sql() -> str:
    """Rejects of the gated load of the broken operational tables."""
    ctes, parts = "", []
    for t in ("departments", "projects", "employees", "assignments", "employee_history"):
        rules, columns = RULES[t], ", ".join(f.name for f in SCHEMAS[t].fields)
        tests = sorted([(f"nn_{t}_{c}", f"{c} is null") for c in rules.not_null]
                       + [(name, f"not ({expr})") for name, expr in rules.checks])
        names = "concat_ws(',', " + ", ".join(f"case when {test} then '{name}' end" for name, test in tests) + ")"
        ctes += f",\nmarked_{t} as (select *, {names} as why from broken_{t})"
        steps = [(f"marked_{t}", "why")]
        good = f"(select {columns} from marked_{t} where why = '')"
        keys = [("pk", rules.primary_key)] + [("uq", cols) for cols in rules.unique]
        for k, (kind, cols) in enumerate(keys):
            key = ", ".join(cols)
            ctes += (f",\nkeyed_{t}_{k} as (select *, case when row_number() over (partition by {key} order by "
                     + ", ".join(f"{f.name} nulls first" for f in SCHEMAS[t].fields)
                     + f") > 1 then '{kind}_{t}_{'_'.join(cols)}' else '' end as why from {good})")
            steps.append((f"keyed_{t}_{k}", "why"))
            good = f"(select {columns} from keyed_{t}_{k} where why = '')"
        lost = ", ".join(
            f"case when not exists (select 1 from loaded_{parent} p where p.{pc[0]} = g.{cols[0]}) "
            f"then 'fk_{t}_{cols[0]}' end" for cols, parent, pc in sorted(rules.foreign_keys))
        if lost:
            ctes += f",\nlinked_{t} as (select *, concat_ws(',', {lost}) as why from {good} g)"
            steps.append((f"linked_{t}", "why"))
            good = f"(select {columns} from linked_{t} where why = '')"
        ctes += f",\nloaded_{t} as (select * from {good} g)"
        parts += [f"select '{t}' as table_name, {_key_expr(t)} as record_key, why as constraint_names, count(*) as row_count "
                  f"from {step} where why <> '' group by why, {columns}" for step, _ in steps]
    return _broken_tables(("departments", "projects", "employees", "assignments", "employee_history")) + ctes.lstrip() + \
        "\n" + "\nunion all\n".join(parts)


def _dq_not_null(of: str = "") -> str:
    parts = []
    for t in ALL_TABLES:
        for c in RULES[t].not_null:
            parts.append(
                f"select 'not_null' as rule, '{t}' as table_name, 'nn_{t}_{c}' as constraint_name, "
                f"{_key_expr(t)} as record_key, '{c}' as detail from {of}{t} where {c} is null"
            )
    return "\nunion all\n".join(parts)


def _dq_check(of: str = "") -> str:
    parts = []
    for t in ALL_TABLES:
        for name, expr in RULES[t].checks:
            parts.append(
                f"select 'check' as rule, '{t}' as table_name, '{name}' as constraint_name, "
                f"{_key_expr(t)} as record_key, cast(null as varchar) as detail "
                f"from {of}{t} where not ({expr})"
            )
    return "\nunion all\n".join(parts)


def _dq_unique(of: str = "") -> str:
    parts = []
    for t in ALL_TABLES:
        rules = RULES[t]
        keys = ([tuple(rules.primary_key)] if rules.primary_key else []) + list(rules.unique)
        for cols in keys:
            name = ("pk_" if cols == tuple(rules.primary_key) else "uq_") + t + "_" + "_".join(cols)
            kexpr = "concat_ws('|', " + ", ".join(f"cast({c} as varchar)" for c in cols) + ")"
            nn = " and ".join(f"{c} is not null" for c in cols)
            parts.append(
                f"select 'unique' as rule, '{t}' as table_name, '{name}' as constraint_name, "
                f"{kexpr} as record_key, cast(count(*) as varchar) as detail from {of}{t} "
                f"where {nn} group by {', '.join(cols)} having count(*) > 1"
            )
    return "\nunion all\n".join(parts)


def _dq_foreign_key(of: str = "") -> str:
    parts = []
    for t in ALL_TABLES:
        for cols, parent, pcols in RULES[t].foreign_keys:
            nn = " and ".join(f"c.{c} is not null" for c in cols)
            match = " and ".join(f"p.{pc} = c.{c}" for c, pc in zip(cols, pcols))
            fk = "concat_ws('|', " + ", ".join(f"cast(c.{x} as varchar)" for x in cols) + ")"
            key_cols = list(RULES[t].primary_key)
            kexpr = "concat_ws('|', " + ", ".join(f"cast(c.{x} as varchar)" for x in key_cols) + ")"
            parts.append(
                f"select 'foreign_key' as rule, '{t}' as table_name, "
                f"'fk_{t}_{'_'.join(cols)}' as constraint_name, {kexpr} as record_key, "
                f"{fk} as detail from {of}{t} c where {nn} "
                f"and not exists (select 1 from {of}{parent} p where {match})"
            )
    return "\nunion all\n".join(parts)


def _one_current(t: str) -> str:
    return (
        f"select 'one_current' as rule, '{t}' as table_name, 'one_current_{t}' as constraint_name, "
        f"cast(employee_id as varchar) as record_key, "
        f"cast(count(*) filter (where is_current) as varchar) as detail "
        f"from {t} group by employee_id having count(*) filter (where is_current) <> 1"
    )


# Each current employee's days of service per department, and how many there serve longer.
_TENURE = """,
service as (
  select distinct employee_id, name as employee_name, dept_name, tenure_days
  from fact natural join dim_department
  join (select employee_key, employee_id, name from dim_employee where is_current) open_keys
    using (employee_key)),
ladder_of_service as (
  select dept_name, coalesce(tenure_days, -1) as days, count(*) as people
  from service group by all),
ranked as (
  select s.*, cast(1 + coalesce((select sum(people) from ladder_of_service l
                                 where l.dept_name = s.dept_name and l.days > coalesce(s.tenure_days, -1)), 0)
                   as integer) as tenure_rank
  from service s)
"""

# Versions by the department of their employee, the month they start in and their role; cents as integers.
_SALARY_TREND = """,
homes as (select employee_id, dept_name from employees natural join departments),
cents as (
  select dept_name, left(cast(effective_start as varchar), 7) as salary_month, role,
         cast(salary * 100 as bigint) as amount
  from employee_history join homes using (employee_id)),
trend as (
  select dept_name, salary_month, role, count(amount) as employee_versions,
         cast(cast((2 * sum(amount) + count(amount)) // (2 * count(amount)) as decimal(20,0)) / 100
              as decimal(12,2)) as avg_salary,
         cast(cast(min(amount) as decimal(20,0)) / 100 as decimal(12,2)) as min_salary,
         cast(cast(max(amount) as decimal(20,0)) / 100 as decimal(12,2)) as max_salary
  from cents group by all)
"""

# Role changes with their verdict; the history before them has no repeated start days.
_ROLE_CHANGES = """,
before_changes as (select * from order_log where effective_start <= _DIM_CUTOFF_),
asked as (
  select * from order_log where effective_start > _DIM_CUTOFF_
  union all
  select -change_id, case when change_id % 7 = 0 then -employee_id else employee_id end,
         role, salary, effective_start
  from before_changes),
open_start as (select employee_id, max(effective_start) as day from before_changes group by employee_id),
judged as (
  select a.*, case when a.employee_id not in (select employee_id from employees) then 'unknown employee'
                   when a.effective_start <= o.day
                     then 'change dated on or before the open version''s start' end as reason
  from asked a left join open_start o on o.employee_id = a.employee_id)
""".replace("_DIM_CUTOFF_", f"date '{DIM_CUTOFF}'")

FINAL: dict[str, str] = {
    "employees_enriched": "select * from employees_x",
    "attrition_snapshot": "select * from attrition",
    "clean_employees": "select * from clean_employees",
    "clean_employees_from_csv": "select * from clean_employees",
    "salaries_across_databases": """
select e.employee_id, d.employee_key, d.role, e.current_salary
from employees e join dim_employee d on d.employee_id = e.employee_id and d.is_current
where e.current_salary > 200000""",
    "hire_date_backcast": "select employee_id, hire_date from clean_employees",
    "resolve_lookups": """
select r.request_id, r.dept_name, r.project_name, d.dept_id, p.project_id
from (select p_partkey as request_id, 'NATION_' || cast(p_size as varchar) as dept_name,
             p_name as project_name from part) r
left join dept_ids d on d.dept_name = r.dept_name
left join project_ids p on p.project_name = r.project_name""",
    "role_levels": """
select e.employee_id, e.dept_name, e.current_role,
       cast(coalesce(la.position, lr.position,
                     case when s.len is null then 0 else greatest(s.len - 1, 0) end) as integer)
         as role_level
from employees_x e
left join (select '1-URGENT' as role, '2-HIGH' as alias) al on al.role = e.current_role
left join ladder la on la.department = e.dept_name and la.role = coalesce(al.alias, e.current_role)
left join ladder lr on lr.department = e.dept_name and lr.role = e.current_role
left join ladder_sizes s on s.department = e.dept_name""",
    "active_projects": """
select * from projects
where (end_date is null or end_date >= date '1998-01-01')
   or not exists (select 1 from projects where end_date is null or end_date >= date '1998-01-01')""",
    "dim_department": "select * from dim_department",
    "dim_project": "select * from dim_project",
    "dim_date": "select * from dim_date",
    "new_dates": """
select * from dim_date n
where not exists (select 1 from dim_date o
                  where o.full_date < date '1997-01-01' and o.date_key = n.date_key)""",
    "new_departments": "select department_key, dept_name from " + keyed(
        "(select dept_name, cast(min(dept_id) as bigint) as source_id from departments "
        "where dept_name not in (select dept_name from dept_before) group by dept_name)",
        ["source_id"],
        "department_key",
        "select coalesce(max(department_key), 0) from dept_before",
    ),
    "dim_project_upsert": """
select project_key, project_name, coalesce(_budget, budget) as budget,
       case when _name is null then 'untouched' when budget = _budget then 'unchanged'
            else 'changed' end as action
from proj_merged where project_key is not null
union all
select project_key, _name as project_name, _budget as budget, 'inserted' as action
from """ + keyed(
        "(select _name, _budget, source_id from proj_merged where project_key is null)",
        ["source_id"],
        "project_key",
        "select coalesce(max(project_key), 0) from proj_before",
    ),
    "scd2_changes": "select * from scd2_changes",
    "dim_employee_after": "select * from dim_employee",
    "scd2_from_changelog": "select * from employee_history",
    "scd2_integrity": "\nunion all\n".join(
        [
            _integrity("employee_history", "employee_id", "effective_start", "effective_end",
                       "employee_history"),
            _integrity("dim_employee", "employee_id", "effective_start", "effective_end",
                       "dim_employee"),
            _integrity("assignments", "employee_id", "start_date", "end_date", "assignments"),
        ]
    ),
    "apply_role_changes": """
select employee_id, role, salary, effective_start, effective_end, is_current
from employee_history""",
    "scd2_backfill": _backfill_sql("{}.employee_id % 11 = 0") + "select * from backfilled",
    "assignment_versions": _backfill_sql() + """
select a.assignment_id, a.employee_id, a.start_date, b.employee_key
from assignments a left join backfilled b on b.employee_id = a.employee_id and b.effective_start <= a.start_date
 and (b.effective_end is null or b.effective_end >= a.start_date)""",
    "fact_point_in_time": _VALID_THEN + f"""
select {', '.join(FACT_COLUMNS)} from then_rows
where employee_key is not null and department_key is not null and project_key is not null""",
    "fact_point_in_time_rejects": _VALID_THEN + """
select assignment_id, employee_id, project_id, dept_name, project_name, 'employee_key' as missing_keys
from then_rows where employee_key is null""",
    "fact_second_snapshot": ", then_keys as (select employee_id, employee_key from emp_keys)\n"
    + _enriched_at("2000-06-01", "t.employee_key") + f"select {', '.join(FACT_COLUMNS)} from then_rows",
    "dim_date_second": """
select * from dim_date where date_key <> 19980101 or full_date in (
  select hire_date from employees_x union all select start_date from assignments union all select end_date from assignments)
union
select 20000601, date '2000-06-01', 6, 2, 2000""",
    "dim_project_upsert_partial": _PARTIAL + _UPSERT,
    "dim_project_upsert_collated": _COLLATED + _UPSERT,
    "resolve_lookups_collated": _COLLATED + """
select p_partkey as request_id, p_name as project_name, s.source_id as project_id
from part left join spelled s on s.plain = lower(rtrim(p_name))""",
    "attrition_snapshot_repeated": """
, doubled as (
  select * from attrition_raw
  union all
  select * replace ('Maybe' as "Attrition", 0 as "DistanceFromHome") from attrition_raw where "EmployeeNumber" % 2 = 0)
select "EmployeeNumber" as employee_id, coalesce(lower("Attrition") = 'yes', false) as is_attrition_flag,
       "JobSatisfaction" as job_satisfaction, "WorkLifeBalance" as work_life_balance,
       coalesce(lower("OverTime") = 'yes', false) as overtime, "PerformanceRating" as performance_rating,
       "DistanceFromHome" as distance_from_home
from doubled
qualify row_number() over (partition by "EmployeeNumber" order by "Attrition" nulls first) = 1""",
    "onboard_hires": """
select assignment_id, request_id, employee_id, trim(name) as name, trim(email) as email, dept_id,
       hire_date, cast(current_salary as decimal(12,2)) as current_salary,
       trim(current_role) as current_role, status, project_id,
       cast(allocation_pct as decimal(5,2)) as allocation_pct, assignment_start as start_date
from onboard_ok""",
    "departments_from_snapshot": """
select distinct trim(n_name) as dept_name from nation
where n_nationkey in (select c_nationkey from customer
                      where c_custkey in (select o_custkey from orders))""",
    "role_change_rejects": _ROLE_CHANGES + """
select change_id, employee_id, effective_start, reason from judged where reason is not null""",
    "role_change_employees": _ROLE_CHANGES + """
select e.employee_id, coalesce(n.role, e.current_role) as current_role,
       coalesce(n.salary, e.current_salary) as current_salary
from employees e left join (
  select employee_id, role, salary from judged where reason is null
  qualify row_number() over (partition by employee_id order by effective_start desc, change_id desc) = 1) n
  on n.employee_id = e.employee_id""",
    "role_changes_published": """
select employee_id, role, salary, effective_start, effective_end, is_current
from employee_history""",
    "role_changes_published_rejects": _ROLE_CHANGES + """
select change_id, employee_id, effective_start, reason from judged where reason is not null""",
    "role_changes_published_employees": _ROLE_CHANGES + """
select e.employee_id, e.name, e.email, e.dept_id, e.hire_date,
       coalesce(n.salary, e.current_salary) as current_salary,
       coalesce(n.role, e.current_role) as current_role, e.status
from employees e left join (
  select employee_id, role, salary from judged where reason is null
  qualify row_number() over (partition by employee_id order by effective_start desc, change_id desc) = 1) n
  on n.employee_id = e.employee_id""",
    "onboard_employees": """
select employee_id, trim(name) as name, trim(email) as email, dept_id, hire_date,
       cast(current_salary as decimal(12,2)) as current_salary, trim(current_role) as current_role, status
from onboard_ok""",
    "onboard_history": """
select (select coalesce(max(history_id), 0) from employee_history) + assignment_id
         - (select coalesce(max(assignment_id), 0) from assignments) as history_id,
       employee_id, trim(current_role) as role, cast(current_salary as decimal(12,2)) as salary,
       hire_date as effective_start, cast(null as date) as effective_end, true as is_current
from onboard_ok""",
    "onboard_assignments": """
select assignment_id, employee_id, project_id, cast(allocation_pct as decimal(5,2)) as allocation_pct,
       assignment_start as start_date, cast(null as date) as end_date
from onboard_ok""",
    "onboard_rejects": "select request_id, reason from onboard_checked where reason is not null",
    "fact_employee_performance": "select * from fact",
    "fact_rejects": """
select assignment_id, employee_id, project_id, dept_name, project_name,
       concat_ws(',', case when employee_key is null then 'employee_key' end,
                      case when department_key is null then 'department_key' end,
                      case when project_key is null then 'project_key' end) as missing_keys
from enriched
where employee_key is null or department_key is null or project_key is null""",
    "fact_rejects_earlier_departments": """
select assignment_id, employee_id, project_id, dept_name, project_name, 'department_key' as missing_keys
from enriched where dept_name not in (select dept_name from dept_before)""",
    "dq_foreign_key_earlier_departments": """
select 'foreign_key' as rule, 'fact_employee_performance' as table_name,
       'fk_fact_employee_performance_department_key' as constraint_name,
       concat_ws('|', assignment_id, date_key) as record_key,
       cast(department_key as varchar) as detail
from fact where department_key not in (select department_key from dept_before)""",
    "dq_one_current_unclosed": f"""
select 'one_current' as rule, 'employee_history' as table_name,
       'one_current_employee_history' as constraint_name, cast(employee_id as varchar) as record_key,
       cast(1 + count(*) as varchar) as detail
from employee_history
where is_current and effective_start > date '{DIM_CUTOFF}'
  and employee_id in (select employee_id from order_log where effective_start <= date '{DIM_CUTOFF}')
group by employee_id""",
    "scd2_rejects": f"""
select o.employee_id, o.role, o.effective_start,
       cast(o.effective_start - interval 1 day as date) as close_date,
       'close date before the start of the version it closes' as reason
from (select employee_id, role, effective_start from order_log
      where effective_start <= date '{DIM_CUTOFF}'
      qualify row_number() over (partition by employee_id order by effective_start desc, change_id desc) = 1) o
join (select employee_id, role, effective_start from dim_employee where is_current) d
  using (employee_id)
where o.effective_start <= d.effective_start and (o.effective_start, o.role) <> (d.effective_start, d.role)""",
    "active_projects_later": """
select * from projects where coalesce(end_date, date '2000-06-01') >= date '2000-06-01'""",
    "active_projects_none_open": "select * from projects where end_date is not null",
    "tenure_ranking": _TENURE + """
select * from ranked""",
    "tenure_top_n": _TENURE + """
select * from ranked where tenure_rank <= 5""",
    "monthly_attrition": """,
first_days as (select employee_id, min(hire_date) as joined from employees group by employee_id),
calendar as (select distinct last_day(full_date) as closing from dim_date),
staffed as (
  select closing, (select count(*) from first_days where joined <= closing) as staff from calendar),
gone as (
  select last_day(strptime(cast(date_key as varchar), '%Y%m%d')) as closing,
         count(distinct employee_id) as leavers
  from fact natural join (select employee_key, employee_id from dim_employee where is_current) open_keys
  where is_attrition_flag group by 1)
select strftime(closing, '%Y-%m') as report_month, staff as active_headcount,
       coalesce(leavers, 0) as attrition_count,
       cast(cast((20000 * coalesce(leavers, 0) + staff) // (2 * staff) as decimal(20,0)) / 100
              as decimal(12,2)) as monthly_attrition_rate_pct
from staffed left join gone using (closing)
where staff > 0""",
    "monthly_headcount": """
select d.year, d.month, d.closing as month_end,
       (select count(distinct employee_id) from employees where hire_date <= d.closing) as active_headcount
from (select distinct year, month, last_day(full_date) as closing from dim_date) d""",
    "headcount_by_department": """
select dept_name, count(*) as headcount
from (select distinct dept_name, employee_id from fact natural join dim_department
      join (select employee_key, employee_id from dim_employee where is_current) open_keys
        using (employee_key)) people
group by dept_name""",
    "employee_salary_history": """
select employee_id, effective_start, effective_end, role, salary, is_current,
       cast(effective_start as varchar) || ' → '
         || coalesce(cast(effective_end as varchar), 'present') as period_label
from employee_history""",
    "scd2_versions": """
select employee_key, employee_id, role, is_current, effective_start, effective_end
from dim_employee""",
    "department_salary_trend": _SALARY_TREND + """
select * from trend""",
    "salary_trend_of_one": _SALARY_TREND + """
select * from trend where dept_name = 'NATION_3'""",
    "salary_history_of_one": """
select employee_id, effective_start, effective_end, role, salary, is_current,
       concat(effective_start, ' → ', coalesce(cast(effective_end as varchar), 'present')) as period_label
from employee_history where employee_id = 7""",
    "versions_of_one": """
select employee_key, employee_id, role, is_current, effective_start, effective_end
from dim_employee where employee_id = 7""",
    "picklists": """
select 'department' as kind, cast(dept_id as bigint) as item_id, dept_name as label,
       cast(null as date) as start_date, cast(null as date) as end_date from departments
union all
select 'project', cast(project_id as bigint), project_name, start_date, end_date from projects
union all
select 'employee', cast(employee_id as bigint), name || ' (' || current_role || ')', null, null from employees""",
    "over_allocated": """
select employee_id, cast(sum(allocation_pct) as decimal(18,2)) as total_allocation_pct
from assignments group by employee_id having sum(allocation_pct) > 100""",
    "dq_not_null": _dq_not_null(),
    "dq_unique": _dq_unique(),
    "dq_foreign_key": _dq_foreign_key(),
    "dq_check": _dq_check(),
    "dq_not_null_broken": _broken_tables() + _dq_not_null("broken_"),
    "dq_unique_broken": _broken_tables() + _dq_unique("broken_"),
    "dq_check_broken": _broken_tables() + _dq_check("broken_"),
    "dq_foreign_key_broken": _broken_tables() + _dq_foreign_key("broken_"),
    "load_rejects": _gate_sql(),
    "dq_one_current": _one_current("employee_history") + "\nunion all\n" + _one_current("dim_employee"),
    "table_counts": "\nunion all\n".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}" for t in ALL_TABLES
    ),
}


def oracle_sql() -> dict[str, str]:
    """``name -> SQL`` for every catalog query."""
    return {name: PRELUDE + "\n" + body for name, body in FINAL.items()}
