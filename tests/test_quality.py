"""Expectations."""

import json

import pytest

from chronomart.operators import quality as q

ROWS = [("1", "5", "a"), ("0", "-1", "b"), (None, "x", None), ("4", None, "a"), ("4", "NaN", "c")]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id string, n string, s string")


@pytest.mark.parametrize(
    "rule, expected",
    [
        (q.NotNull("id"), 1), (q.NotNull("id", reject_zero=True), 2), (q.Between("n", 0), 1),
        (q.Between("n", 0, null_ok=False), 4), (q.Between("n", 5, strict_min=True), 2), (q.Between("n", max_value=4), 1),
        (q.InSet("s", ("a", "b")), 2), (q.Matches("s", "[ab]"), 2), (q.Unique("id"), 1),
    ],
)
def test_rules(df, rule, expected):
    row = q.run_suite({"t": df}, {"t": [rule]}).first()
    assert (row["evaluated"], row["violations"], row["success"]) == (5, expected, expected == 0)
    if not isinstance(rule, q.Unique):
        assert q.violations(df, rule).count() == expected
    else:
        assert q.violations(df, rule).count() == 2


def test_one_scan_for_all_row_rules(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(ROWS, "id string, n string, s string").write.parquet(path)
    result = q.run_suite({"t": spark.read.parquet(path)}, {"t": [q.NotNull("id"), q.Between("n", 0), q.InSet("s", ("a",))]})
    assert result._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


@pytest.mark.parametrize("parents, expected", [([], 0), ([1], 2), ([1, None], 1), ([1, 9, 9], 1), ([2], 4)])
def test_references(spark, parents, expected):
    child = spark.createDataFrame([(1,), (1,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(p,) for p in parents], "id int")
    rule = q.References("k", "parents", "id")
    tables = {"child": child, "parents": parent}
    row = q.run_suite(tables, {"child": [rule]}).first()
    assert (row["evaluated"], row["violations"]) == (4, expected)
    assert q.violations(child, rule, tables).count() == expected
    clean, bad = q.quarantine(child, [rule], tables)
    assert (clean.count(), bad.count()) == (4 - expected, expected)


def test_empty_table_passes(df):
    results = q.run_suite({"t": df.filter("false")}, {"t": [q.NotNull("id"), q.Unique("id")]})
    assert [(r["evaluated"], r["success"]) for r in results.collect()] == [(0, True), (0, True)]
    assert len(q.gate(results)) == 2


def test_quarantine_names_every_broken_rule(df):
    clean, bad = q.quarantine(df, [q.NotNull("id"), q.InSet("s", ("a",)), q.Between("n", 0)])
    assert clean.count() + bad.count() == 5
    assert sorted(r["_failed"] for r in bad.collect()) == sorted([
        ["in_set(s)", "between(n)"], ["not_null(id)", "in_set(s)"], ["in_set(s)"],
    ])


def test_suite_as_json(df):
    text = json.dumps({"expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"table": "t", "column": "id"}},
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"table": "t", "column": "n", "min_value": 0}},
        {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"table": "t", "column": "s", "value_set": ["a"]}},
        {"expectation_type": "expect_column_values_to_match_regex", "kwargs": {"table": "t", "column": "s", "regex": "a"}},
    ]})
    found = q.run_suite({"t": df}, q.load_suite(text)).collect()
    assert [r["violations"] for r in found] == [1, 1, 3, 3]
    with pytest.raises(ValueError):
        q.load_suite(text.replace("match_regex", "be_nice"))


def test_model_tests_as_data():
    declared = {"models": [{"name": "m", "columns": [
        {"name": "id", "tests": ["unique", "not_null"]},
        {"name": "s", "tests": [{"accepted_values": {"values": ["a"]}}]}, {"name": "free"},
    ]}]}
    assert q.load_model_tests(declared) == {"m": [q.Unique("id"), q.NotNull("id"), q.InSet("s", ("a",))]}


def test_dimension_checks(spark):
    dim = spark.sql("""
      SELECT * FROM VALUES
        (1, TIMESTAMP_NTZ'2026-01-01', TIMESTAMP_NTZ'2026-01-05', false), (1, TIMESTAMP_NTZ'2026-01-04', NULL, true),
        (2, TIMESTAMP_NTZ'2026-01-01', TIMESTAMP_NTZ'2026-01-02', false), (2, TIMESTAMP_NTZ'2026-01-03', TIMESTAMP_NTZ'2026-01-03', false),
        (3, TIMESTAMP_NTZ'2026-01-01', NULL, true), (3, TIMESTAMP_NTZ'2026-01-02', NULL, true)
      AS t(id, valid_from, valid_to, is_current)""")
    assert {r["entity_id"]: r["current_rows"] for r in q.one_current(dim, "id", "e").collect()} == {2: 0, 3: 2}
    assert {r["entity_id"] for r in q.one_current_strict(dim, "id", "e").collect()} == {3}
    assert {r["entity_id"] for r in q.valid_windows(dim, "id", "e").collect()} == {2}
    found = {(r["entity_id"], r["finding"]) for r in q.no_overlap(dim, "id", "e").collect()}
    assert found == {(1, "overlap"), (2, "gap"), (3, "overlap")}


def test_absent_table_or_parent_is_an_error(spark):
    df = spark.sql("SELECT 1 AS id")
    with pytest.raises(ValueError, match="absent: typo"):
        q.run_suite({"t": df}, {"t": [q.NotNull("id")], "typo": [q.NotNull("id")]})
    with pytest.raises(ValueError, match="absent: parent"):
        q.run_suite({"t": df}, {"t": [q.References("id", "parent", "id")]})


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_one_scan_per_table_for_all_kinds_of_rules(spark, sf):
    tables = {n: spark.read.parquet(f"{sf}/{n}.parquet") for n in ("orders", "customer", "nation")}
    suites = {
        "orders": [q.Unique("o_orderkey"), q.Unique("o_custkey"), q.References("o_custkey", "customer", "c_custkey"), q.Between("o_totalprice", 1000)],
        "customer": [q.Unique("c_custkey"), q.References("c_nationkey", "nation", "n_nationkey"), q.NotNull("c_name")],
    }
    found = q.run_suite(tables, suites)
    assert scans(found) == 3
    rows = {(r["suite"], r["expectation"], r["column"]): (r["evaluated"], r["violations"]) for r in found.collect()}
    n = tables["orders"].count()
    repeated = tables["orders"].groupBy("o_custkey").count().filter("count > 1").count()
    assert rows["orders", "unique", "o_custkey"] == (n, repeated) and rows["orders", "unique", "o_orderkey"] == (n, 0)
    assert rows["orders", "references", "o_custkey"] == (n, 0) and len(rows) == 7


@pytest.mark.parametrize("kind", ["double", "decimal(10,2)", "date", "binary", "boolean", "int"])
def test_keys_of_any_kind(spark, kind):
    values = {
        "double": ["0.0", "-0.0", "1.5", "NaN", "NaN"], "decimal(10,2)": ["1", "1.00", "2", "3", "4"], "boolean": ["true", "true", "false", None, None],
        "date": ["2026-01-01", "2026-01-01", "2026-01-02", None, None], "binary": ["a", "a", "b", None, None], "int": ["1", "01", "2", None, None],
    }[kind]
    child = spark.createDataFrame([(v,) for v in values], "t string").selectExpr(f"CAST(t AS {kind}) AS k")
    parent = child.limit(1).selectExpr("k AS id")
    rows = q.run_suite({"c": child, "p": parent}, {"c": [q.Unique("k"), q.References("k", "p", "id")]}).collect()
    expected = child.groupBy("k").count().filter("k IS NOT NULL AND count > 1").count()
    assert [r["violations"] for r in rows] == [expected, q.violations(child, q.References("k", "p", "id"), {"p": parent}).count()]
