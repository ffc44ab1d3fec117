"""Operators against brute force, hot keys and both sides of every size check."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from staffloom.functions.dates import now, today
from staffloom.operators import aggregates, changes, checks, evolve
from staffloom.operators.aggregates import rank_departments
from staffloom.operators.hotkeys import hot_keys_of, hot_parts, hot_parts_of, parts_of
from staffloom.operators.latest import latest_overall, latest_per_key, mark_latest, newest_first
from staffloom.operators.lookup import lookup, lookups
from staffloom.operators.numbering import number_rows, previous_in_order, rank_in_groups
from staffloom.plans import load, views
from staffloom.sources import schemas, tables
from staffloom.sources.workspace import is_broadcastable, planned_bytes


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows, a third of them under one key, a tenth under NULL."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        draw = rng.random()
        key = "hot" if draw < 0.34 else None if draw < 0.44 else f"k{rng.randrange(400)}"
        data.append((i, key, rng.randrange(50), rng.choice([None, "x", "y"])))
    return spark.createDataFrame(data, "id long, k string, t int, s string").repartition(6)


def test_hot_parts_finds_the_hot_keys(spark, skewed):
    found = hot_parts(skewed, [F.col("k")], hot_rows=100)
    counts = skewed.groupBy("k").count().select(F.xxhash64("k").alias("h"), "count")
    expected = {r.h: r["count"] for r in counts.filter("count > 100").collect()}
    assert set(found) == set(expected) and len(expected) == 2
    # No part is meant to hold more than half of hot_rows, nor are there many more.
    for key, parts in found.items():
        assert expected[key] / 50 <= parts <= 4 * expected[key] / 50
    assert hot_parts(skewed, [F.col("k")]) == {}
    cut = skewed.select("k", parts_of(found, F.col("k")).alias("n")).distinct().collect()
    assert {r.n for r in cut if r.k not in ("hot", None)} == {1}
    assert all(r.n > 1 for r in cut if r.k in ("hot", None))


@pytest.mark.parametrize("large", [False, True])
def test_mark_latest_marks_one_row_per_key(skewed, large):
    marked = mark_latest(skewed, "k", [-F.col("t"), -F.col("id")], "id", large=large)
    best = {}
    for r in skewed.collect():
        if r.k not in best or (r.t, r.id) > best[r.k]:
            best[r.k] = (r.t, r.id)
    got = marked.collect()
    assert marked.columns == [*skewed.columns, "is_latest"]
    assert len(got) == 3000
    assert {r.k: (r.t, r.id) for r in got if r.is_latest} == best
    assert sum(r.is_latest for r in got) == len(best)


def test_mark_latest_with_rows_all_alike(spark):
    alike = spark.range(500, numPartitions=5).select("id", F.lit("k").alias("k"), F.lit(1).alias("t"))
    marked = mark_latest(alike, "k", [-F.col("t")], "id")
    assert Counter(r.is_latest for r in marked.collect()) == {True: 1, False: 499}


def test_newest_first(spark):
    rows = [(1, "2024-01-01 00:00:00"), (2, "1901-05-01 00:00:00.000001"), (3, None), (4, "2024-01-01 00:00:00.000001")]
    df = spark.createDataFrame(rows, "id long, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    assert [r.id for r in df.orderBy(newest_first("at")).collect()] == [4, 1, 2, 3]


def test_latest_per_key_and_overall(skewed):
    order = [F.col("t").desc(), F.col("id").desc()]
    best = {}
    for r in skewed.collect():
        if r.k not in best or (r.t, r.id) > best[r.k]:
            best[r.k] = (r.t, r.id)
    assert {r.k: (r.t, r.id) for r in latest_per_key(skewed, ["k"], order).collect()} == best
    top = latest_overall(skewed, order).collect()
    assert [(r.t, r.id) for r in top] == [max(best.values())]


def test_number_rows_is_dense_in_order(skewed, ws):
    numbered = number_rows(skewed, ["k", "t", "id"], "n", ws, after=F.lit(10))
    got = sorted(numbered.collect(), key=lambda r: r.n)
    assert [r.n for r in got] == list(range(11, 3011))
    assert [r.id for r in got] == [
        r.id for r in sorted(skewed.collect(), key=lambda r: (r.k or "", r.t, r.id))
    ]


def test_number_rows_of_nothing(skewed, ws):
    assert number_rows(skewed.filter("id < 0"), ["id"], "n", ws).count() == 0


def test_numbering_few_rows_in_one_task_is_the_same(skewed, ws, monkeypatch):
    few = rows_of(number_rows(skewed, ["k", "t", "id"], "n", ws, after=F.lit(10)))
    monkeypatch.setattr("staffloom.operators.numbering.FEW_ROWS", 0)
    assert rows_of(number_rows(skewed, ["k", "t", "id"], "n", ws, after=F.lit(10))) == few


@pytest.mark.parametrize("tiles", [4, 7])
def test_rank_in_groups_by_ranges_equals_one_window(spark, ws, tiles):
    rng = random.Random(3)
    data = []
    for i in range(2000):
        group = rng.choice([1, 1, 1, 1, 2, 3, None, 100 + rng.randrange(30)])
        value = rng.choice([None, *[Decimal(rng.randrange(40)) for _ in range(9)]])
        data.append((i, group, value))
    # One value that fills many ranges of a group on its own.
    data += [(5000 + i, 1, Decimal(20)) for i in range(1500)]
    df = spark.createDataFrame(data, "id long, g int, v decimal(10,2)").repartition(5)
    by_ranges = rank_in_groups(df, "g", "v", "id", ws, tiles=tiles)
    by_window = rank_in_groups(df, "g", "v", "id", ws, largest_group=3500, tiles=tiles)
    assert rows_of(by_ranges) == rows_of(by_window)


def test_ranking_keeps_rows_without_group_or_key(spark, ws):
    """NULL groups, NULL keys and repeated keys come out once each, whichever way."""
    data = [(1, None, 5), (1, None, 7), (None, 1, 3), (None, 1, 3), (2, 1, 9), (2, 1, 9), (3, 2, None)]
    df = spark.createDataFrame(data, "id long, g int, v int")
    by_ranges = rank_in_groups(df, "g", "v", "id", ws)
    by_window = rank_in_groups(df, "g", "v", "id", ws, largest_group=4)
    assert rows_of(by_ranges) == rows_of(by_window)
    assert by_ranges.count() == len(data)


def test_global_ranks_keep_those_without_a_department(spark, ws):
    rows = [(None, 10.0, 1, 5.0), (1, 20.0, 3, 5.0), (2, 20.0, 2, None)]
    df = spark.createDataFrame(
        rows, "department_id long, avg_salary double, total_rejects long, active_ratio_pct double"
    )
    assert rows_of(rank_departments(df, ws, hot_rows=1)) == rows_of(rank_departments(df, ws))


def test_several_keys_are_sketched_in_one_job(spark, skewed):
    rows = skewed.withColumn("none", F.lit(None).cast("string"))
    columns = ("k", "s", "none")
    hashes = [F.when(F.col(c).isNotNull(), F.xxhash64(c)) for c in columns]
    tracker = spark.sparkContext.statusTracker()
    found = hot_parts_of(rows, hashes, hot_rows=100)
    several = len(tracker.getJobIdsForGroup(None))
    alone = hot_parts_of(rows, hashes[:1], hot_rows=100)
    one = len(tracker.getJobIdsForGroup(None)) - several
    before = len(tracker.getJobIdsForGroup(None))
    hot_parts_of(rows, hashes, hot_rows=100)
    assert len(tracker.getJobIdsForGroup(None)) - before == one
    assert found[0] == alone[0] and found[2] == {}
    counts = {c: rows.filter(F.col(c).isNotNull()).groupBy(F.xxhash64(c).alias("h")).count() for c in columns[:2]}
    for i, c in enumerate(columns[:2]):
        assert set(found[i]) == {r.h for r in counts[c].filter("count > 100").collect()}


def test_lookups_in_turn(skewed, ws, no_broadcast):
    table = skewed.filter("k IS NOT NULL").groupBy("k").agg(F.max("t").alias("top"))
    other = skewed.filter("s IS NOT NULL").groupBy("s").agg(F.min("t").alias("low"))
    got = lookups(skewed, [(table, ["k"]), (other, ["s"])], "id", hot_rows=50)
    want = skewed.join(table, "k", "left").join(other, "s", "left").select(*got.columns)
    assert rows_of(got) == rows_of(want)


def test_hot_keys_hide_in_few_bytes(spark, ws):
    """Millions of alike rows pack into next to nothing; they are found all the same."""
    alike = spark.range(3_000_000).select(F.lit("k").alias("k"))
    settled = ws.settle(alike, "alike")
    assert planned_bytes(settled) < 1_000_000
    assert [*hot_parts(settled, [F.col("k")]).values()] == [4]
    assert hot_parts(settled, [F.col("k")], hot_rows=3_000_000) == {}


def test_hot_keys_beyond_a_thousand(spark):
    many = spark.range(36_000).select((F.col("id") % 1_200).alias("k"))
    assert len(hot_parts(many, [F.col("k")], hot_rows=20)) == 1_200


def test_mark_latest_leaves_the_rows_where_they_are(spark, ws):
    """Beyond the broadcast limit winners still meet the rows without a shuffle: a bit each."""
    rows = spark.range(600_000).select("id", F.col("id").alias("k"), F.lit(1).alias("t"))
    rows = ws.settle(rows, "rows")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "400000")
    try:
        marked = mark_latest(rows, "k", [F.col("t")], "id", total=600_000)
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert marked.filter("is_latest").count() == 600_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One exchange by key, of partial aggregates, and one of the winners' numbers.
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 2


def test_more_hot_keys_than_can_be_listed(spark, skewed, ws, no_broadcast, monkeypatch):
    """Most hot keys stay in a table; only the heaviest reach the driver, and none is left out."""
    from staffloom.operators import hotkeys

    monkeypatch.setattr(hotkeys, "LISTED_KEYS", 5)
    hashes = [F.when(F.col("k").isNotNull(), F.xxhash64("k"))]
    (hot,) = hot_keys_of(skewed, hashes, hot_rows=3)
    counts = skewed.filter("k IS NOT NULL").groupBy(F.xxhash64("k").alias("h")).count()
    many = {r.h: 1 << (2 * r["count"] // 3).bit_length() for r in counts.filter("count > 3").collect()}
    assert len(hot.listed) == 1 and len(many) > 100
    others = {r["_hash"]: r["_parts"] for r in hot.others.collect()}
    assert hot.listed | others == many and not hot.listed.keys() & others.keys()

    monkeypatch.setattr(hotkeys, "hot_parts_of", None)
    table = ws.settle(_lookup_case(skewed), "table")
    got = lookup(skewed, table, ["k"], "id", hot_rows=3)
    assert rows_of(got) == rows_of(skewed.join(table, "k", "left"))
    other = skewed.filter("s IS NOT NULL").groupBy("s").agg(F.min("t").alias("low"))
    got = lookups(skewed, [(table, ["k"]), (other, ["s"])], "id", hot_rows=3)
    want = skewed.join(table, "k", "left").join(other, "s", "left").select(*got.columns)
    assert rows_of(got) == rows_of(want)


def test_lookup_broadcasts_few_keys_only(spark, ws, monkeypatch):
    from staffloom.operators import lookup as module

    monkeypatch.setattr(module, "SMALL_KEYS", 10)
    table = ws.settle(spark.range(1_000).select(F.col("id").alias("k"), F.lit(1).alias("x")), "t")
    for keys, hinted in ((10, True), (11, False)):
        rows = spark.range(5_000).select("id", (F.col("id") % keys).alias("k"))
        found = lookup(rows, table, ["k"], "id", small_table=False)
        plan = found._jdf.queryExecution().logical().toString()
        assert ("broadcast" in plan) is hinted
        assert found.filter("x = 1").count() == 5_000


def test_a_stamp_keeps_its_type(spark):
    table = spark.createDataFrame([(1, None), (2, None)], "id int, at date")
    out = changes.update(table, F.col("id") == 1, {}, stamp="at", now=F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))
    assert out.schema["at"].dataType.simpleString() == "date"
    assert sorted(map(str, (r.at for r in out.collect()))) == ["2024-01-02", "None"]


def test_one_clock_in_any_time_zone(spark):
    import datetime as dt

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("America/Los_Angeles", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", name)
            seen = spark.range(1).select(now().alias("t"), today().alias("d")).first()
            apart = seen.t - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            assert abs(apart.total_seconds()) < 60 and seen.d == seen.t.date()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sorted_results_are_in_order(spark):
    people = spark.createDataFrame(
        [(i, f"f{i % 3}", f"l{i % 5}", 50_000 + i % 4 * 10_000, 1, "Active") for i in range(200)],
        "employee_id long, first_name string, last_name string, salary int, department_id int, status string",
    ).withColumns({"email": F.lit("e"), "hire_date": F.lit("2020-01-01").cast("date")})
    rich = [(-r.salary, r.employee_id) for r in views.high_earners(people, 50_000).collect()]
    assert rich == sorted(rich) and len(rich) == 150
    places = spark.createDataFrame([(1, "Ops")], "department_id int, department_name string")
    active = views.active_employees(people, places, "Active").collect()
    named = [(r.last_name, r.first_name, r.employee_id) for r in active]
    assert named == sorted(named) and len(named) == 200


def test_one_run_sorts_into_several_partitions(spark):
    rows = spark.range(200_000).select(
        F.col("id").alias("employee_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("loaded_at")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = load.newest_enriched_first(rows).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(out) > 1


def test_previous_in_order(skewed, ws):
    df = skewed.filter("k IS NOT NULL").select("k", "id", "s")
    got = previous_in_order(df, "k", "id", "s", "before", ws)
    seen = {}
    expected = {}
    for r in sorted(df.collect(), key=lambda r: r.id):
        expected[r.id] = seen.get(r.k)
        seen[r.k] = (r.s,)
    assert {r.id: None if r.before is None else tuple(r.before) for r in got.collect()} == expected


def _lookup_case(skewed):
    table = skewed.filter("k IS NOT NULL").groupBy("k").agg(F.max("t").alias("top"))
    return table.filter("k <> 'k7'").unionByName(
        table.limit(1).select(F.lit(None).cast("string").alias("k"), F.lit(-1).alias("top"))
    )


@pytest.mark.parametrize("hot_rows", [10, 2_000_000])
def test_lookup_is_a_left_join(skewed, ws, no_broadcast, hot_rows):
    table = ws.settle(_lookup_case(skewed), "table")
    assert not is_broadcastable(table)
    got = lookup(skewed, table, ["k"], "id", hot_rows=hot_rows)
    assert rows_of(got) == rows_of(skewed.join(table, "k", "left"))


def test_lookup_on_two_keys(skewed, ws, no_broadcast):
    table = ws.settle(
        skewed.groupBy("k", "s").agg(F.count(F.lit(1)).alias("n")).filter("n > 3"), "table"
    )
    got = lookup(skewed, table, ["k", "s"], "id", hot_rows=20)
    assert rows_of(got) == rows_of(skewed.join(table, ["k", "s"], "left"))


def test_lookup_broadcasts_a_small_table(skewed, ws):
    table = ws.settle(_lookup_case(skewed), "table")
    got = lookup(skewed, table, ["k"], "id")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_lookup_spreads_a_hot_key(spark, skewed, ws, no_broadcast):
    table = ws.settle(_lookup_case(skewed), "table")
    crowd = skewed.filter("k = 'hot' OR k IS NULL")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = lookup(crowd, table, ["k"], "id", hot_rows=100, small_rows=False)
        parts = [r["count"] for r in got.groupBy("k", F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(parts) == crowd.count()
    assert len(parts) > 8 and max(parts) < crowd.count() / 4


def _upsert_case(spark):
    table = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", None), (3, None, "z")], "id long, a string, b string"
    )
    incoming = spark.createDataFrame(
        [(2, None, "new"), (3, "c", "new"), (9, "n", "new")], "id long, a string, b string"
    )
    return table, incoming


@pytest.mark.parametrize("small", [True, False])
def test_upsert(spark, request, small):
    if not small:
        request.getfixturevalue("no_broadcast")
    table, incoming = _upsert_case(spark)
    partial = changes.upsert(table, incoming, "id", ["a"])
    assert [tuple(r) for r in partial.orderBy("id").collect()] == [
        (1, "a", "x"),
        (2, None, None),
        (3, "c", "z"),
        (9, "n", "new"),
    ]
    full = changes.upsert(table, incoming, "id")
    assert [tuple(r) for r in full.orderBy("id").collect()] == [
        (1, "a", "x"),
        (2, None, "new"),
        (3, "c", "new"),
        (9, "n", "new"),
    ]
    assert rows_of(changes.absent(incoming, table, "id")) == [("n", "new", 9)]


def test_small_upsert_does_not_shuffle_the_table(spark, ws):
    table, incoming = _upsert_case(spark)
    table = ws.settle(table, "table")
    out = changes.upsert(table, ws.settle(incoming, "incoming"), "id")
    assert "SortMergeJoin FullOuter" not in out._jdf.queryExecution().executedPlan().toString()


def _people(spark):
    return spark.createDataFrame(
        [
            (1, "Ann", "Lee", "2000-01-01", "10.55", "Inactive"),
            (2, "Bob", "Ray", "1999-12-31", "10.55", "Active"),
            (3, "Cy", "Fox", "1990-01-01", None, "Inactive"),
        ],
        "employee_id long, first_name string, last_name string, hire string, pay string,"
        " status string",
    ).select(
        "employee_id",
        "first_name",
        "last_name",
        F.col("hire").cast("date").alias("hire_date"),
        F.col("pay").cast("decimal(10,2)").alias("salary"),
        "status",
    )


def test_update(spark):
    people = _people(spark)
    hired = F.col("hire_date") < F.lit("2000-01-01").cast("date")
    raised = F.col("salary") * F.lit("1.10").cast("decimal(3,2)")
    moment = now("2024-01-31 00:00:00")
    out = changes.update(people, hired, {"salary": raised}, "updated_at", moment)
    got = {r.employee_id: (r.salary, r.updated_at is not None) for r in out.collect()}
    # 10.55 * 1.10 = 11.605, half up; a matched row is stamped although its NULL stays.
    assert got == {
        1: (Decimal("10.55"), False),
        2: (Decimal("11.61"), True),
        3: (None, True),
    }


def test_update_reads_old_values(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = changes.update(df, F.lit(True), {"a": F.col("b"), "b": F.col("a")})
    assert [tuple(r) for r in out.collect()] == [(2, 1)]


def test_delete_keeps_rows_with_a_null_predicate(spark):
    people = _people(spark)
    gone = (F.col("salary") < 50000) & (F.col("status") == "Inactive")
    left = changes.delete(people, gone)
    log = changes.deleted_log(people, gone, now("2024-01-31 00:00:00"))
    assert [r.employee_id for r in left.orderBy("employee_id").collect()] == [2, 3]
    assert [(r.employee_id, r.name) for r in log.collect()] == [(1, "Ann Lee")]
    assert left.count() + log.count() == people.count()


def test_hire_continues_the_ids(spark, ws):
    people = schemas.EMPLOYEES.conform(_people(spark).withColumn("salary", F.lit(None)))
    hires = spark.createDataFrame(
        [("B", "B", "b@x"), ("A", "A", "a@x")], "first_name string, last_name string, email string"
    ).withColumns({"salary": F.lit(None), "department_id": F.lit(1)})
    day, moment = today("2024-01-31"), now("2024-01-31 08:00:00")
    new = changes.hire(people, hires, ["email"], day, moment, ws).orderBy("employee_id").collect()
    assert [(r.employee_id, r.email, r.status) for r in new] == [
        (4, "a@x", "Active"),
        (5, "b@x", "Active"),
    ]
    assert {str(r.hire_date) for r in new} == {"2024-01-31"}
    none = changes.hire(schemas.EMPLOYEES.empty(spark), hires, ["email"], day, moment, ws)
    assert sorted(r.employee_id for r in none.collect()) == [1, 2]


def test_salary_changes_chain(spark, ws):
    people = schemas.EMPLOYEES.conform(_people(spark))
    moves = spark.createDataFrame(
        [(1, "20", 1), (1, None, 2), (1, "30", 3), (3, "5", 4), (99, "1", 5), (99, "2", 6)],
        "employee_id long, pay string, change_seq long",
    ).select("employee_id", F.col("pay").cast("decimal(10,2)").alias("new_salary"), "change_seq")
    log = changes.salary_log(people, moves, now("2024-01-31 00:00:00"), ws)
    got = Counter((r.employee_id, r.old_salary, r.new_salary) for r in log.collect())
    d = Decimal
    assert got == Counter(
        [
            (1, d("10.55"), d("20.00")),
            (1, d("20.00"), None),
            (1, None, d("30.00")),
            (3, None, d("5.00")),
            (99, None, d("1.00")),
            (99, None, d("2.00")),
        ]
    )
    after = changes.change_salaries(people, moves)
    assert {r.employee_id: r.salary for r in after.collect()} == {
        1: d("30.00"),
        2: d("10.55"),
        3: d("5.00"),
    }


def test_counters(spark):
    departments = spark.createDataFrame(
        [(1, 5), (2, None), (3, 0)], "department_id long, employee_count long"
    )
    inserted = spark.createDataFrame([(1,), (1,), (2,), (7,), (None,)], "department_id long")
    out = changes.count_inserted(departments, inserted)
    assert {r.department_id: r.employee_count for r in out.collect()} == {1: 205, 2: None, 3: 0}


def test_unseen_departments_fold_case(spark, ws):
    departments = spark.createDataFrame(
        [(1, "Sales"), (7, "HR")], "department_id long, department_name string"
    )
    names = spark.createDataFrame(
        [("SALES",), ("Ops",), ("OPS",), (None,), ("Art",)], "department_name string"
    )
    new = changes.discover_departments(names, departments, ws)
    assert [
        (r.department_id, r.department_name, r.location)
        for r in new.orderBy("department_id").collect()
    ] == [(8, "Art", "Auto-Discovered"), (9, "OPS", "Auto-Discovered")]


def test_rank_departments_both_ways(spark, ws):
    rng = random.Random(5)
    data = [(i, rng.randrange(20), rng.randrange(20), rng.randrange(20)) for i in range(300)]
    df = spark.createDataFrame(
        data, "department_id long, avg_salary int, total_rejects int, active_ratio_pct int"
    )
    assert rows_of(aggregates.rank_departments(df, ws)) == rows_of(
        aggregates.rank_departments(df, ws, hot_rows=10)
    )


def test_recent_rejects_window_is_closed(spark):
    df = spark.createDataFrame(
        [("s", "1", "b", "2024-01-17 00:00:00"), ("s", "1", "a", "2024-01-16 23:59:59"),
         ("s", "1", "a", "2024-01-20 00:00:00"), ("s", "1", "b", "2024-01-21 00:00:00"),
         (None, "1", "c", "2024-01-21 00:00:00")],
        "source_system string, source_employee_id string, rejection_reason string, t string",
    ).withColumn("rejected_at", F.col("t").cast("timestamp_ntz"))
    out = aggregates.recent_rejects(df, now("2024-01-31 00:00:00"), 14).collect()
    got = {r.source_system: (r.reject_count, r.reject_reasons) for r in out}
    assert got == {"s": (3, "a; b"), None: (1, "c")}


def test_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (1, None, 1000.0), (2, None, None), (None, "abc", 5.0), (None, "b", 1.0)],
        "id int, s string, n double",
    )
    assert rows_of(checks.repeated_keys(df, ["id"], allow_null=True)) == [(1, 2)]
    assert rows_of(checks.repeated_keys(df, ["id"])) == [(1, 2), (None, 2)]
    assert rows_of(checks.missing_values(df, ["id", "s"])) == [("id", 2), ("s", 2)]
    assert rows_of(checks.overlong_values(df, {"s": 2})) == [("s", 1)]
    assert rows_of(checks.unfit_numbers(df, {"n": "decimal(4,2)"})) == [("n", 1)]
    parent = spark.createDataFrame([(1,)], "pid int")
    assert rows_of(checks.orphans(df, "id", parent, "pid")) == [(2, 1)]
    assert rows_of(checks.missing_values(df.filter("false"), ["id"])) == [("id", 0)]


def test_evolve(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = evolve.add_column(df, "c", "int", 0)
    out = evolve.add_column(out, "d", "string")
    out = evolve.change_type(evolve.drop_column(out, "b"), "a", "bigint")
    assert out.dtypes == [("a", "bigint"), ("c", "int"), ("d", "string")]
    assert [tuple(r) for r in out.collect()] == [(1, 0, None)]


def test_contracts(spark, tmp_path):
    absent = tables.read_table(spark, str(tmp_path / "none"), schemas.EMPLOYEES)
    assert absent.schema == schemas.EMPLOYEES.schema and absent.count() == 0
    moment = now("2024-01-31 00:00:00")
    row = {"employee_id": 1, "first_name": "A", "last_name": "B"}
    added = tables.literal_rows(spark, schemas.EMPLOYEES, [row], moment)
    got = tables.append_rows(absent, added, schemas.EMPLOYEES).collect()
    assert [(r.status, str(r.created_at), r.email) for r in got] == [
        ("Active", "2024-01-31 00:00:00", None)
    ]
    path = str(tmp_path / "t")
    tables.write_snapshot(added, path)
    with pytest.raises(Exception, match="already exists"):
        tables.write_snapshot(added, path)
    tables.append_to(added, path)
    assert tables.read_table(spark, path, schemas.EMPLOYEES).count() == 2


def test_a_settled_table_knows_its_size(skewed, ws):
    settled = ws.settle(skewed, "sized")
    assert planned_bytes(settled) < 200_000
    assert settled.columns == skewed.columns
    assert rows_of(settled) == rows_of(skewed)


def test_ordered_list(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "x string")
    assert df.agg(aggregates.ordered_list(F.col("x"))).first()[0] == "a; b"


def test_groups_are_counted_once(spark, skewed):
    per = defaultdict(int)
    for r in skewed.collect():
        per[r.k] += 1
    got = skewed.groupBy("k").agg(aggregates.count_if(F.lit(True)).alias("n"))
    assert {r.k: r.n for r in got.collect()} == dict(per)


def test_copies_do_not_crowd_one_range(spark, ws, monkeypatch):
    alike = spark.range(4000, numPartitions=8).select(F.lit("k").alias("k"))
    monkeypatch.setattr("staffloom.operators.numbering.FEW_ROWS", 0)
    settled = []
    settle = ws.settle
    monkeypatch.setattr(ws, "settle", lambda *a: settled.append(settle(*a)) or settled[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(r.n for r in number_rows(alike, ["k"], "n", ws).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == list(range(1, 4001))
    ranges = settled[1].groupBy(F.shiftright("_at", 33)).count().collect()
    assert len(ranges) >= 6 and max(r["count"] for r in ranges) <= 1000


def test_contract_report(spark):
    df = spark.createDataFrame(
        [(1, "a" * 101, None, "x"), (1, "b", None, "x" * 200), (2, None, None, None)],
        "department_id long, department_name string, manager_id long, location string",
    )
    got = {(r.check_name, r.column_name): r.bad_rows
           for r in checks.contract_report(df, schemas.DEPARTMENTS).collect()}
    assert got == {
        ("required", "department_id"): 0,
        ("required", "department_name"): 1,
        ("length", "department_name"): 1,
        ("length", "location"): 1,
        ("key", "department_id"): 1,
    }
    for contract in schemas.CONTRACTS.values():
        empty = checks.contract_report(contract.empty(spark), contract) if contract.key else None
        assert empty is None or {r.bad_rows for r in empty.collect()} == {0}
