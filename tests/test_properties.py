"""Property tests: the skew-safe operators against brute force in Python."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators.dedup import keep_first
from starloom.operators.keys import assign_dense_keys
from starloom.operators.neighbors import rank_desc
from starloom.operators.scd2 import interval_violations, intervals_from_changelog

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
BASE = dt.date(2020, 1, 1)
days = st.integers(min_value=0, max_value=500)


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 4), st.one_of(st.none(), st.integers(0, 30))),
                min_size=1, max_size=60))
def test_rank_desc_is_sql_rank(spark, rows):
    got = Counter(tuple(r) for r in rank_desc(
        spark.createDataFrame(rows, "g int, v int"), ["g"], "v", "r").collect())
    want = Counter()
    for g, v in rows:
        peers = [w for h, w in rows if h == g]
        if v is None:
            rank = 1 + sum(1 for w in peers if w is not None)
        else:
            rank = 1 + sum(1 for w in peers if w is not None and w > v)
        want[(g, v, rank)] += 1
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3), days, st.integers(0, 10**6)), min_size=1,
                max_size=60, unique_by=lambda t: t[2]))
def test_changelog_intervals_match_brute_force(spark, log):
    df = spark.createDataFrame(
        [(cid, k, f"r{cid}", BASE + dt.timedelta(days=d)) for k, d, cid in log],
        "change_id long, employee_id long, role string, effective_start date",
    )
    got = {(r["employee_id"], r["effective_start"]): (r["role"], r["effective_end"], r["is_current"])
           for r in intervals_from_changelog(df, "employee_id", "effective_start", ["change_id"],
                                             ["role"]).collect()}
    want = {}
    for k in {k for k, _, _ in log}:
        per_day = {}
        for kk, d, cid in log:
            if kk == k and (d not in per_day or cid > per_day[d]):
                per_day[d] = cid
        starts = sorted(per_day)
        for i, d in enumerate(starts):
            nxt = starts[i + 1] if i + 1 < len(starts) else None
            end = BASE + dt.timedelta(days=nxt - 1) if nxt is not None else None
            want[(k, BASE + dt.timedelta(days=d))] = (f"r{per_day[d]}", end, nxt is None)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3), days, st.one_of(st.none(), st.integers(-3, 90))),
                min_size=1, max_size=50))
def test_interval_violations_match_brute_force(spark, spans):
    rows = [(k, BASE + dt.timedelta(days=s),
             None if e is None else BASE + dt.timedelta(days=s + e)) for k, s, e in spans]
    df = spark.createDataFrame(rows, "employee_id long, effective_start date, effective_end date")
    got = Counter()
    for r in interval_violations(df, "employee_id").collect():
        got[(r["entity_id"], r["problem"])] += r["row_count"]
    far = dt.date(9999, 12, 31)
    want = Counter()
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k),
                      key=lambda r: (r[1], r[2] is not None, r[2] or far))
        prior = None
        for _, s, e in mine:
            if prior is not None and prior >= s:
                want[(k, "overlap")] += 1
            elif prior is not None and prior + dt.timedelta(days=1) < s:
                want[(k, "gap")] += 1
            end = e or far
            prior = end if prior is None else max(prior, end)
        open_rows = sum(1 for r in mine if r[2] is None)
        if open_rows > 1:
            want[(k, "several_open")] += open_rows
    assert got == want


@SETTINGS
@given(st.sets(st.integers(-10**9, 10**9), min_size=1, max_size=80), st.integers(0, 1000),
       st.sampled_from([1, 3, 64, 4096]))
def test_dense_keys(spark, ids, base, buckets):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    keys = [r["k"] for r in assign_dense_keys(df, ["id"], "k", base, buckets).collect()]
    assert sorted(keys) == list(range(base + 1, base + len(ids) + 1))


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 5), st.integers(0, 9), st.text("ab", max_size=2)),
                min_size=1, max_size=40))
def test_keep_first_is_minimum_row(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int, v string")
    got = {r["k"]: (r["o"], r["v"]) for r in keep_first(df, ["k"], ["o"]).collect()}
    want = {}
    for k, o, v in rows:
        if k not in want or (o, v) < want[k]:
            want[k] = (o, v)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3), days, st.integers(0, 10**6)), min_size=1,
                max_size=40, unique_by=lambda t: t[2]),
       st.integers(0, 500))
def test_role_changes_after_a_cutoff_equal_the_full_history(spark, log, cutoff):
    from starloom.operators.load import apply_role_changes

    rows = [(cid, k, f"r{cid}", cid % 7, BASE + dt.timedelta(days=d)) for k, d, cid in log]
    schema = "change_id long, employee_id long, role string, salary int, effective_start date"
    full = spark.createDataFrame(rows, schema)
    cut = BASE + dt.timedelta(days=cutoff)

    def versions(df):
        return intervals_from_changelog(df, "employee_id", "effective_start", ["change_id"],
                                        ["role", "salary"]).select(
            F.col("change_id").alias("history_id"), "employee_id", "role", "salary",
            "effective_start", "effective_end", "is_current")

    before = versions(full.where(F.col("effective_start") <= F.lit(cut)))
    employees = spark.createDataFrame([(k, "x", 0) for k in {k for k, _, _ in log}],
                                      "employee_id long, current_role string, current_salary int")
    after, new_employees, rejected = apply_role_changes(
        before, employees, full.where(F.col("effective_start") > F.lit(cut)))
    cols = ["employee_id", "role", "salary", "effective_start", "effective_end", "is_current"]
    assert Counter(tuple(r) for r in after.select(cols).collect()) == Counter(
        tuple(r) for r in versions(full).select(cols).collect())
    assert rejected.count() == 0
    current = {r["employee_id"]: r["role"] for r in versions(full).where("is_current").collect()}
    changed = {k for k, d, _ in log if d > cutoff}  # the others keep what they had
    assert {r["employee_id"]: r["current_role"] for r in new_employees.collect()} == {
        k: role if k in changed else "x" for k, role in current.items()}


@SETTINGS
@given(st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 9), max_size=6),
       st.lists(st.tuples(st.integers(1, 10**6), st.sampled_from("abcdefghij"),
                          st.integers(0, 9)), min_size=1, max_size=20,
                unique_by=lambda t: t[0]))
def test_project_upsert_keeps_keys_and_adds_dense_ones(spark, existing, projects):
    from starloom.operators.dims import build_dim_project
    from starloom.operators.load import upsert_dim_project

    old = [(i + 1, name, float(b)) for i, (name, b) in enumerate(sorted(existing.items()))]
    old_df = spark.createDataFrame(old, "project_key long, project_name string, budget double")
    if not old:
        old_df = old_df.where("false")
    new_df = spark.createDataFrame([(i, n, float(b)) for i, n, b in projects],
                                   "project_id long, project_name string, budget double")
    out = {r["project_name"]: r for r in upsert_dim_project(build_dim_project(new_df), old_df).collect()}
    first = {}
    for pid, name, b in sorted(projects):
        first.setdefault(name, float(b))
    assert set(out) == set(existing) | set(first)
    for key, name, budget in old:
        assert out[name]["project_key"] == key
        if name in first:
            assert out[name]["budget"] == first[name]
            assert out[name]["action"] == ("unchanged" if first[name] == budget else "changed")
        else:
            assert out[name]["action"] == "untouched"
    fresh = sorted(r["project_key"] for r in out.values() if r["action"] == "inserted")
    assert fresh == list(range(len(old) + 1, len(old) + 1 + len(fresh)))
