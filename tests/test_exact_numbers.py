"""Numbers of drifted types compare by value, and maps at any depth by content."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from paritas.operators import constraints as C
from paritas.functions.values import exact_number_sql, exact_number_text
from paritas.operators import parity as P
from paritas.operators import profile as PR
from paritas.operators import rowdiff as R
from paritas.operators.pair import TablePair


def pair(spark, a, sa, b, sb, keys=("k",)):
    return TablePair(spark.createDataFrame(a, sa), spark.createDataFrame(b, sb), keys=keys)


def test_bigint_and_double_above_2_53_differ(spark):
    p = pair(spark, [(1, 9007199254740993)], "k int, v bigint", [(1, 9007199254740992.0)], "k int, v double")
    assert R.keyed_diff(p).count() == 1 and R.multiset_diff(p).count() == 2
    p = pair(spark, [(1, 9007199254740992), (2, 5)], "k int, v bigint", [(1, 9007199254740992.0), (2, 5.0)], "k int, v double")
    assert R.keyed_diff(p).count() == 0 and R.multiset_diff(p).count() == 0


@pytest.mark.parametrize("kind", ["double", "decimal(10,2)", "bigint", "float"])
def test_key_type_drift_matches_by_value(spark, kind):
    rows = spark.createDataFrame([(1, "a"), (20, "b"), (None, "c")], "k int, v string")
    p = TablePair(rows, rows.withColumn("k", F.col("k").cast(kind)), keys=("k",))
    assert R.keyed_diff(p).count() == 0 and R.multiset_diff(p).count() == 0


def test_foreign_key_of_another_number_type(spark):
    child = spark.createDataFrame([(9007199254740993,), (7,)], "fk bigint")
    parent = spark.createDataFrame([(9007199254740992.0,), (7.0,)], "id double")
    assert [r.fk for r in C._anti(child, parent, ["fk"], ["id"]).collect()] == [9007199254740993]


def test_decimal_against_double(spark):
    p = pair(spark, [(1, "0.10"), (2, "100.00"), (3, "0.00001"), (4, "-2.50")], "k int, v string", [(1, 0.1), (2, 100.0), (3, 1e-5), (4, -2.5)], "k int, v double")
    p = TablePair(p.source.withColumn("v", F.col("v").cast("decimal(20,5)")), p.target, keys=("k",))
    assert R.keyed_diff(p).count() == 0 and R.multiset_diff(p).count() == 0


def test_maps_at_any_depth(spark):
    kind = "k int, m map<string,int>, n array<struct<x:map<string,int>>>"
    a = [(1, {"a": 1, "b": 2}, [({"p": 1, "q": 2},)]), (2, {"a": 1}, None)]
    b = [(1, {"b": 2, "a": 1}, [({"q": 2, "p": 1},)]), (2, {"a": 3}, None)]
    p = pair(spark, a, kind, b, kind)
    got = R.keyed_diff(p).select("column_name", "change").collect()
    assert [(r.column_name, r.change) for r in got] == [("m", "changed")]
    assert R.multiset_diff(p).count() == 2


NUMBERS = ["0", "-0", "1", "-1", "0.1", "-2.5", "1e21", "1e-7", "123456789012345680", "100", "0.00001", "3.4e5", "-1e22"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers_of_all_types_meet_in_one_form(spark, ansi):
    """Every pair of types, through every operator that compares numbers."""
    kinds = {"float": ["0", "1", "-2.5", "0.1", "100", "1e21"], "double": NUMBERS, "decimal(38,10)": NUMBERS, "decimal(38,0)": ["0", "1", "100", "1e21", "-1e22"], "bigint": ["0", "1", "100", "123456789012345680"]}
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for (a, of_a), (b, of_b) in itertools.combinations(kinds.items(), 2):
            shared = [x for x in of_a if x in of_b]
            make = lambda kind: spark.createDataFrame([(i, x) for i, x in enumerate(shared)], "k int, v string").withColumn("v", F.col("v").cast("double" if kind in ("float", "bigint") else kind).cast(kind) if kind != "bigint" else F.col("v").cast("decimal(38,0)").cast("bigint"))
            p = TablePair(make(a), make(b), keys=("k",))
            assert R.keyed_diff(p).count() == 0 and R.multiset_diff(p, ["v"]).count() == 0, (a, b)
            assert PR.numeric_range_parity(p).filter("column_name = 'v' AND NOT passed").count() == 0, (a, b)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_normal_form_equals_python_decimals(spark):
    from decimal import Decimal

    values = [float(x) for x in NUMBERS] + [1.7976931348623157e308, 2.2250738585072014e-308, 123.456, 5e22, 2e23, 1.1, 0.30000000000000004, 1e16, 12345678.9, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    both = df.select("v", exact_number_text(F.col("v"), df.schema["v"].dataType).alias("t"), F.expr(exact_number_sql("v", df.schema["v"].dataType)).alias("u")).collect()
    for r in both:
        want = "Infinity" if r.v == float("inf") else "0" if r.v == 0 else "{}{}E{}".format("-" if r.v < 0 else "", "".join(map(str, Decimal(repr(r.v)).normalize().as_tuple().digits)), Decimal(repr(r.v)).normalize().as_tuple().exponent)
        assert r.t == r.u == want


def test_date_key_against_timestamp_ntz_key(spark):
    a = spark.sql("SELECT date'2024-01-02' AS k, 1 AS v UNION ALL SELECT NULL, 2 UNION ALL SELECT date'2024-05-01', 3")
    b = spark.sql("SELECT timestamp_ntz'2024-01-02 00:00:00' AS k, 1 AS v UNION ALL SELECT NULL, 2 UNION ALL SELECT timestamp_ntz'2024-05-01 00:00:01', 3")
    assert sorted(r.change for r in R.keyed_diff(TablePair(a, b, keys=("k",))).collect()) == ["extra", "missing"]


@pytest.mark.parametrize("kind, value", [("array<int>", [1, None]), ("struct<a:int,b:string>", (None, "x")), ("map<string,int>", {"a": 1, "b": None}), ("double", -0.0)])
def test_null_keys_of_any_type(spark, kind, value):
    kind = f"k {kind}, v int"
    a = spark.createDataFrame([(None, 1), (value, 2)], kind)
    assert R.keyed_diff(TablePair(a, a, keys=("k",))).collect() == []
    b = spark.createDataFrame([(None, 5), (value, 2)], kind)
    got = R.keyed_diff(TablePair(a, b, keys=("k",))).collect()
    assert [(r.k, r.column_name, r.source_value, r.target_value, r.change) for r in got] == [(None, "v", "1", "5", "changed")]


def test_digests_tell_nulls_and_nested_nulls_apart(spark):
    kind = "k int, a string, b string, c array<int>, d map<string,int>"
    a = spark.createDataFrame([(1, "x", None, [1], {"p": 1}), (2, None, None, [None, 1], None), (3, "s", "s", [1], {})], kind)
    b = spark.createDataFrame([(1, None, "x", [1], {"p": 1}), (2, None, None, [1, None], {}), (3, "s", "s", [1], {})], kind)
    got = sorted((r.k, r.column_name) for r in R.keyed_diff(TablePair(a, b, keys=("k",))).collect())
    assert got == [(1, "a"), (1, "b"), (2, "c"), (2, "d")]


def test_key_grouping_is_a_hash_aggregation(spark, capsys):
    kind = "k string, a string, c array<int>"
    a = spark.createDataFrame([("1", "x", [1])], kind)
    R.key_counts(TablePair(a, a, keys=("k",)), ["k"], ["a", "c"]).explain()
    plan = capsys.readouterr().out
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and plan.count("Exchange") == 1


def test_nested_maps_count_once_in_any_entry_order(spark):
    kind = "a array<map<string,int>>, s struct<m:map<string,array<map<int,int>>>>, t array<string>, w array<double>, u array<timestamp_ntz>"
    import datetime as dt

    u = dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    rows = [([{"x": 1, "y": 2}], ({"m": [{1: 1, 2: 2}], "n": None},), ["a, b"], [0.0], [u]),
            ([{"y": 2, "x": 1}], ({"n": None, "m": [{2: 2, 1: 1}]},), ["a", "b"], [-0.0], [u + dt.timedelta(microseconds=1)]), (None, None, None, None, None), (None, (None,), [], [], [])]
    df = spark.createDataFrame(rows, kind)
    got = {r.column_name: r.source_distinct for r in P.unique_value_parity(TablePair(df, df)).collect()}
    assert got == {"a": 2, "s": 3, "t": 4, "w": 3, "u": 4}
    assert {c: df.select(c).distinct().count() for c in "twu"} == {"t": 4, "w": 3, "u": 4}
