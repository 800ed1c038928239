"""Ordered work on hot groups gives what one window would, a part at a time."""

import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from wayfare import session
from wayfare.operators.collections import (
    drop_repeats,
    latest_in_one_pass,
    latest_per_key,
    records_from_pairs,
)
from wayfare.operators.ranking import nth_distinct, with_rank
from wayfare.operators.slicing import PART, By, in_parts, ordered_window, with_positions
from wayfare.plans.workforce import nth_salary, salary_rank, salary_rank_sql
from wayfare.sources.tables import rows, view

PARTS = 16

EMPLOYEES = [
    ("Ash", "Docks", 310), ("Bo", "Lab", 480), ("Cy", "Docks", 480), ("Dee", "Docks", 410),
    ("Eli", "Mill", 310), ("Ash", "Docks", 310), ("Flo", "Mill", 330), ("Gus", "Mill", 390),
    ("Hal", "Yard", 310), ("Ivy", "Yard", 200), ("Jo", "Docks", 410),
]


@pytest.fixture(autouse=True)
def many_parts(spark):
    """So many parts that small groups are cut as well."""
    wanted = {
        "spark.sql.shuffle.partitions": str(PARTS),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with session.settings(spark, wanted):
        yield


def numbered(df, keys, order):
    window = ordered_window(keys, order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("position", F.row_number().over(window).cast("bigint")).withColumn(
        "weight_before", F.coalesce(F.sum("id").over(before), F.lit(0)).cast("bigint")
    )


def skewed(spark, seed=1):
    """A third of the rows in group 0, a third of those at one time; nulls in all columns."""
    chance = random.Random(seed)
    data = []
    for i in range(600):
        key = 0 if i % 3 == 0 else chance.choice([None, *range(1, 6)])
        at = 50 if key == 0 and i % 2 == 0 else chance.choice([None, *range(100)])
        data.append((key, at, i, chance.choice(["a", "b", None])))
    return spark.createDataFrame(data, "k int, at int, id int, value string"), data


def as_set(df):
    return sorted(map(str, df.collect()))


# A hot group whose rows are told apart by the last sort column only.
HOT = {
    "all null": "CAST(NULL AS DOUBLE)",
    "half null": "IF(id % 2 = 0, NULL, CAST(id AS DOUBLE))",
    "half NaN": "IF(id % 2 = 0, CAST('NaN' AS DOUBLE), CAST(id AS DOUBLE))",
    "one text": "'same'",
    "text": "md5(CAST(id AS STRING))",
    "numbers": "id",
}


@pytest.mark.parametrize("name", HOT)
def test_parts_are_small_and_in_order(spark, name):
    df = spark.range(0, 2000, 1, 4).selectExpr("1 AS k", f"{HOT[name]} AS at", "id")
    order = [By("at"), By("id")]
    sizes = [r["count"] for r in in_parts(df, ["k"], order).groupBy(PART).count().collect()]
    assert len(sizes) >= PARTS - 2 and max(sizes) <= 3 * 2000 / PARTS
    want = numbered(df, ["k"], order)
    assert as_set(with_positions(df, ["k"], order, "id")) == as_set(want)


def test_equal_rows_are_cut_too(spark):
    df = spark.range(0, 2000, 1, 4).selectExpr("1 AS k", "2 AS at")
    sizes = [r["count"] for r in in_parts(df, ["k"], [By("at")]).groupBy(PART).count().collect()]
    assert max(sizes) <= 3 * 2000 / PARTS
    found = with_positions(df, ["k"], [By("at")])
    assert sorted(r["position"] for r in found.collect()) == list(range(1, 2001))


def test_many_hot_groups(spark):
    df = spark.range(0, 3000, 1, 4).selectExpr("id % 5 AS k", "id % 7 AS at", "id")
    order = [By("at", desc=True), By("id")]
    sizes = [r["count"] for r in in_parts(df, ["k"], order).groupBy(PART).count().collect()]
    assert max(sizes) <= 3 * 3000 / PARTS
    assert as_set(with_positions(df, ["k"], order, "id")) == as_set(numbered(df, ["k"], order))


def test_zone_less_time_in_a_zone_with_summer_time(spark):
    with session.settings(spark, {"spark.sql.session.timeZone": "America/New_York"}):
        df = spark.range(240).selectExpr(
            "1 AS k", "TIMESTAMP_NTZ'2024-03-10 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT), 0) AS at", "id"
        )
        found = with_positions(df, [], [By("at")]).collect()
        assert all(r["position"] == r["id"] + 1 for r in found)
        ranked = with_rank(df, ["k"], By("at")).collect()
        assert all(r["rank"] == r["id"] + 1 for r in ranked)


@pytest.mark.parametrize("desc", [False, True])
@pytest.mark.parametrize("keys", [["k"], []])
def test_positions(spark, keys, desc):
    df, _ = skewed(spark)
    order = [By("at", desc), By("id")]
    assert as_set(with_positions(df, keys, order, "id")) == as_set(numbered(df, keys, order))


@pytest.mark.parametrize("kind", ["timestamp", "date", "decimal(30,2)", "string"])
def test_positions_of_all_kinds(spark, kind):
    values = {
        "timestamp": "timestamp_micros(id * 7777777)",
        "date": "date_from_unix_date(CAST(id AS INT))",
    }.get(kind, f"CAST(id AS {kind})")
    df = spark.range(200).selectExpr(f"{values} AS at", "id")
    order = [By("at"), By("id")]
    assert as_set(with_positions(df, [], order, "id")) == as_set(numbered(df, [], order))


@pytest.mark.parametrize("kind", ["dense_rank", "rank"])
def test_ranks(spark, kind):
    df, _ = skewed(spark)
    function = getattr(F, kind)().over(ordered_window(["k"], [By("at", desc=True)]))
    want = df.withColumn("rank", function.cast("bigint"))
    assert as_set(with_rank(df, ["k"], By("at", desc=True), kind)) == as_set(want)


def test_unknown_rank(spark):
    with pytest.raises(ValueError, match="ntile"):
        with_rank(spark.range(1), [], By("id"), "ntile")


def test_columns_may_have_any_name(spark):
    df = spark.range(300).selectExpr("id % 2 AS rows", "id % 50 AS tie", "id")
    order = [By("tie"), By("id")]
    assert as_set(with_positions(df, ["rows"], order, "id")) == as_set(numbered(df, ["rows"], order))


def test_nan_and_infinity_are_ranked(spark):
    numbers = [float(i) for i in range(60)] + [float("nan")] * 3 + [float("inf"), None]
    df = spark.createDataFrame([("a", x) for x in numbers], "k string, x double")
    want = df.withColumn("rank", F.dense_rank().over(ordered_window(["k"], [By("x")])).cast("bigint"))
    assert as_set(with_rank(df, ["k"], By("x"))) == as_set(want)


def changes(data):
    """Ids of the rows whose value differs from the one before; data is k, at, id, value."""
    low = lambda x: (x is not None, x if x is not None else 0)
    kept = []
    ordered = sorted(data, key=lambda r: (low(r[0]), low(r[1]), r[2]))
    for _, group in itertools.groupby(ordered, key=lambda r: r[0]):
        before = object()
        for row in group:
            if row[3] != before:
                kept.append(row[2])
            before = row[3]
    return sorted(kept)


def test_repeats(spark):
    df, data = skewed(spark)
    found = drop_repeats(df, ["k"], "value", [By("at"), By("id")])
    assert found.columns == df.columns
    assert sorted(r["id"] for r in found.collect()) == changes(data)


@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 4), st.integers(0, 2)), max_size=60))
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_repeats_and_positions_of_any_table(spark, cells):
    data = [(k, at, i, value) for i, (k, at, value) in enumerate(cells)]
    df = spark.createDataFrame(data, "k int, at int, id int, value int")
    order = [By("at"), By("id")]
    assert as_set(with_positions(df, ["k"], order, "id")) == as_set(numbered(df, ["k"], order))
    found = drop_repeats(df, ["k"], "value", order)
    assert sorted(r["id"] for r in found.collect()) == changes(data)


@pytest.mark.parametrize(
    ("values", "kept"), [([1, 3, 3, 5, 7, 8], [1, 3, 5, 7, 8]), ([1, 3, 5, 7, 8], [1, 3, 5, 7, 8]),
                         ([0, 0, 1, 0], [0, 1, 0]), ([], [])],
)
def test_runs_of_equal_numbers(spark, values, kept):
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, i int, v int")
    found = drop_repeats(df, ["k"], "v", [By("i")]).orderBy("i").collect()
    assert [r["v"] for r in found] == kept


def test_employee_ranks(spark):
    employees = rows(spark, EMPLOYEES)
    ranked = salary_rank(employees)
    want = {
        ("Docks", 480): 1, ("Docks", 410): 2, ("Docks", 310): 3,
        ("Mill", 390): 1, ("Mill", 330): 2, ("Mill", 310): 3,
        ("Yard", 310): 1, ("Yard", 200): 2, ("Lab", 480): 1,
    }
    found = ranked.collect()
    assert len(found) == 11
    assert all(r["rank"] == want[r["department"], r["salary"]] for r in found)
    assert as_set(salary_rank_sql(spark, view(employees, "employee"))) == as_set(ranked)
    gaps = salary_rank(employees, kind="rank").where("department = 'Docks'").collect()
    assert sorted(r["rank"] for r in gaps) == [1, 2, 2, 4, 4]


def test_second_salary(spark):
    found = nth_salary(rows(spark, EMPLOYEES), 2).collect()
    assert sorted(r["employee_name"] for r in found if r["department"] == "Docks") == ["Dee", "Jo"]
    assert not [r for r in found if r["department"] == "Lab"]


def test_nth_value_is_limited_before_its_shuffle(spark, plan):
    chosen = nth_distinct(rows(spark, EMPLOYEES), ["department"], By("salary", desc=True), 2)
    assert "WindowGroupLimit [department" in plan(chosen) and "Partial" in plan(chosen)


def test_latest_per_key_sends_a_row_per_key(spark, plan):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 6, None), (2, 1, "c"), (None, 1, "d")], "k int, v int, x string"
    )
    want = sorted(["Row(k=1, v=6, x=None)", "Row(k=2, v=1, x='c')", "Row(k=None, v=1, x='d')"])
    for form in (latest_per_key, latest_in_one_pass):
        assert as_set(form(df, ["k"], ["v"])) == want
    assert "partial_max_by" in plan(latest_in_one_pass(df, ["k"], ["v"]))
    hashed = plan(latest_per_key(df, ["k"], ["v"]))
    assert "partial_max" in hashed and "SortAggregate" not in hashed


def test_latest_per_key_of_several_versions(spark, plan):
    rng = random.Random(3)
    some = lambda *values: rng.choice([None, *values])
    table = [(some(1, 2, 3), some(1.5, float("nan"), -0.0), some(1, 2), i, rng.choice("ab")) for i in range(300)]
    table += table[:50]
    df = spark.createDataFrame(table, "k int, u double, v int, w bigint, x string")
    latest = latest_per_key(df, ["k"], ["u", "v", "w"])
    assert as_set(latest) == as_set(latest_in_one_pass(df, ["k"], ["u", "v", "w"]))
    assert latest.count() == 4
    assert "SortAggregate" not in plan(latest)
    # Text has no fixed width: one pass, and the same rows.
    by_text = latest_per_key(df, ["k"], ["x", "w"])
    assert as_set(by_text) == as_set(latest_in_one_pass(df, ["k"], ["x", "w"]))


def test_records(spark):
    pairs = [(1, "name", "Ada"), (1, "surname", "Lark"), (2, "name", "Bo"), (3, "colour", "red")]
    df = spark.createDataFrame(pairs, "id int, key string, value string")
    found = records_from_pairs(df, "id", "key", "value", ["name", "surname"]).collect()
    assert sorted(map(tuple, found)) == [(1, "Ada", "Lark"), (2, "Bo", ""), (3, "", "")]
