from __future__ import annotations

import pytest

from tests.trips import bronze
from tripflow.operators import quality as q
from tripflow.plans.suites import bronze_suite, bronze_values, model_tests

NAN = float("nan")


def results(frame):
    return {(r["check"], r["column"]): (r["evaluated"], r["failed"], r["success"]) for r in frame.collect()}


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_missing_values_leave_the_denominator(spark):
    rows = numbers(spark, 1.0, 2.0, None, NAN, 10.0)
    found = results(
        q.run_rules(rows, [q.not_null("x"), q.between("x", 1, 10), q.in_set("x", [1.0, 2.0], 0.6)])
    )
    assert found[("not_null", "x")] == (5, 2, False)
    assert found[("between", "x")] == (3, 0, True)
    assert found[("in_set", "x")] == (3, 1, True)


def test_mostly_is_an_inclusive_share(spark):
    rows = numbers(spark, *[0.0] * 99, 7.0)
    assert results(q.run_rules(rows, [q.between("x", 0, 1, 0.99)])) == {("between", "x"): (100, 1, True)}
    rows = numbers(spark, *[0.0] * 98, 7.0, 7.0)
    assert results(q.run_rules(rows, [q.between("x", 0, 1, 0.99)])) == {("between", "x"): (100, 2, False)}


def test_column_without_values_passes_and_absent_column_fails(spark):
    found = results(
        q.run_rules(
            numbers(spark, None, None),
            [q.between("x", 0, 1), q.in_set("x", [1.0]), q.not_null("y"), q.exists("x"), q.exists("X")],
        )
    )
    assert found[("between", "x")] == (0, 0, True)
    assert found[("in_set", "x")] == (0, 0, True)
    assert found[("not_null", "y")] == (0, 0, False)
    assert found[("column_exists", "x")] == (1, 0, True)
    assert found[("column_exists", "X")] == (1, 1, False)


def test_row_count_bounds(spark):
    rows = spark.range(5)
    for low, high, good in ((5, 5, True), (0, 4, False), (6, None, False), (1, None, True)):
        (row,) = q.run_rules(rows, [q.row_count(low, high)]).collect()
        assert (row["evaluated"], row["success"]) == (5, good)


def test_text_values_are_quoted(spark):
    rows = spark.createDataFrame([("it's",), ("a\\b",), ("c",)], "x string")
    assert results(q.run_rules(rows, [q.in_set("x", ["it's", "a\\b"])])) == {("in_set", "x"): (3, 1, False)}


def test_bronze_suite_size_and_one_pass(spark):
    rules = bronze_suite()
    assert len(rules) == 35
    frame = q.run_rules(bronze(spark, {}), bronze_values())
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    found = results(q.run_rules(bronze(spark, {}), rules))
    assert found.pop(("row_count", "*")) == (1, 1, False)
    assert all(success for _, _, success in found.values())


def test_gate(spark):
    good = q.run_rules(spark.range(3), [q.not_null("id"), q.exists("id")])
    assert len(q.gate(good)) == 2
    bad = q.run_rules(spark.range(3), [q.not_null("id"), q.row_count(10)])
    with pytest.raises(q.QualityError, match="1 of 2 checks failed.*row_count"):
        q.gate(bad)
    assert tuple(q.summarize(bad).first()) == (2, 1, 1, False)


def test_model_checks(spark):
    rows = spark.createDataFrame([(1, 1), (1, 9), (2, 8), (2, 9), (None, None), (3, 1)], "k int, v int")
    parents = spark.createDataFrame([(1,), (9,), (9,), (None,)], "id int")
    assert results(q.check_not_null(rows, ["k", "v"]))[("not_null", "k")] == (6, 1, False)
    assert results(q.check_unique(rows, "k")) == {("unique", "k"): (5, 2, False)}
    assert {tuple(r) for r in q.duplicate_keys(rows, "k").collect()} == {(1, 2), (2, 2)}
    assert results(q.check_accepted_values(rows, "v", [1])) == {("accepted_values", "v"): (5, 2, False)}
    assert {tuple(r) for r in q.unaccepted_values(rows, "v", [1]).collect()} == {(9, 2), (8, 1)}
    found = results(q.check_relationships(rows, ["k", "v"], parents, "id"))
    assert found == {("relationships", "k"): (5, 3, False), ("relationships", "v"): (5, 1, False)}


def test_checks_on_empty_tables_pass(spark):
    rows = spark.createDataFrame([], "k int")
    parents = spark.createDataFrame([(1,)], "id int")
    for frame in (
        q.check_not_null(rows, ["k"]),
        q.check_unique(rows, "k"),
        q.check_accepted_values(rows, "k", [1]),
        q.check_relationships(rows, ["k"], parents, "id"),
        q.run_rules(rows, [q.not_null("k"), q.between("k", 0, 1)]),
    ):
        assert set(results(frame).values()) == {(0, 0, True)}


def test_number_of_declared_tests():
    assert len(model_tests(unique_trips=False)) == 24
    assert len(model_tests()) == 25


def test_all_tests_of_a_table_read_it_once(spark, tmp_path):
    path = str(tmp_path / "child")
    child = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (None, "a", 7), (2, "z", None)], "id int, kind string, parent int")
    child.write.parquet(path)
    parent = spark.createDataFrame([(5,), (6,), (None,)], "key int")
    tests = [
        q.ModelTest("child", "not_null", "id"),
        q.ModelTest("child", "not_null", "parent"),
        q.ModelTest("child", "unique", "id"),
        q.ModelTest("child", "accepted_values", "kind", values=("a", "b")),
        q.ModelTest("child", "relationships", "parent", parent="parent", key="key"),
    ]
    found = q.run_model_tests({"child": spark.read.parquet(path), "parent": parent}, tests)
    assert results(found) == {
        ("not_null", "id"): (4, 1, False),
        ("not_null", "parent"): (4, 1, False),
        ("unique", "id"): (3, 1, False),
        ("accepted_values", "kind"): (4, 1, False),
        ("relationships", "parent"): (3, 1, False),
    }
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
    none = q.run_model_tests({"child": child.limit(0), "parent": parent}, tests)
    assert all(row["success"] and row["evaluated"] == 0 for row in none.collect())


def test_top_failing_values_are_few_exact_and_cut_before_the_exchange(spark):
    rows = numbers(spark, *[20.0] * 3, *[30.0] * 3, *[float(k) for k in range(100, 200)], 1.0, None, NAN)
    top = q.top_failing_values(rows, [q.between("x", 0, 10), q.in_set("x", [1.0])], 3)
    found = sorted((row["check"], row["place"], row["value"], row["rows"]) for row in top.collect())
    for check in ("between", "in_set"):
        assert [row[1:] for row in found if row[0] == check] == [(1, 20.0, 3), (2, 30.0, 3), (3, 100.0, 1)]
    assert all(row["share"] == row["rows"] / 107 for row in top.collect())
    assert top._jdf.queryExecution().sparkPlan().toString().count("WindowGroupLimit") == 2
