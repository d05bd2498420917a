"""Pair checks on hand-made frames: edge inputs (FIXTURES.md §4), must-fail and clean pairs."""

import decimal
import math

import pytest
from pyspark.sql import types as T

from conftest import rows
from paritas.operators import parity as P
from paritas.operators import profile as PR
from paritas.operators import rowdiff as R
from paritas.operators.pair import TablePair, align


def pair(spark, a, b, ddl_a, ddl_b=None, keys=()):
    return TablePair(spark.createDataFrame(a, ddl_a), spark.createDataFrame(b, ddl_b or ddl_a), keys=keys)


def by_col(df, value_col):
    return {r["column_name"]: r[value_col] for r in df.collect()}


def test_align_sorted_and_case_sensitive(spark):
    p = pair(spark, [(1, 2, 3)], [(1, 2, 3)], "b int, A int, c int", "b int, a int, d int")
    a = align(p)
    assert a.common == ["b"]
    assert a.source_only == ["A", "c"] and a.target_only == ["a", "d"]


def test_identical_pair_every_check_passes(spark, tables):
    p = TablePair(tables.orders, tables.orders, keys=("o_orderkey",))
    assert all(r.passed for r in PR.null_count_parity(p).collect())
    assert all(r.passed for r in PR.numeric_range_parity(p).collect())
    assert all(r.passed for r in PR.date_range_parity(p).collect())
    assert all(r.passed for r in PR.string_length_parity(p).collect())
    assert all(r.passed for r in P.unique_value_parity(p).collect())
    assert all(r.passed for r in R.frame_equal(p).collect())
    assert R.duplicate_row_parity(p).first().passed
    assert R.multiset_diff(p).count() == 0
    assert R.keyed_diff(p).count() == 0
    assert PR.row_count_parity(p).first().passed


def test_empty_vs_empty_and_empty_vs_rows(spark):
    ddl = "k int, v string"
    e = pair(spark, [], [], ddl)
    assert PR.row_count_parity(e).first().passed
    assert rows(PR.null_count_parity(e), "column_name", "source_nulls", "target_nulls") == [("k", 0, 0), ("v", 0, 0)]
    assert R.frame_equal(e).filter("passed").count() == 3
    assert rows(P.unique_value_parity(e), "column_name", "source_distinct", "passed") == [("k", 0, True), ("v", 0, True)]
    ne = pair(spark, [], [(1, "x")], ddl)
    assert not PR.row_count_parity(ne).first().passed
    assert {r.mode: (r.missing, r.extra) for r in R.frame_equal(ne).collect()}["general"] == (0, 1)
    # min/max of an empty side is NULL; NULL vs a value fails, NULL vs NULL passes
    assert not PR.numeric_range_parity(ne).filter("column_name = 'k'").first().passed
    assert PR.numeric_range_parity(e).filter("column_name = 'k'").first().passed


def test_no_common_columns(spark):
    p = pair(spark, [(1,)], [(1,)], "a int", "b int")
    assert P.column_match(p).first().passed is False
    assert R.frame_equal(p).count() == 0
    assert P.unique_value_parity(p).count() == 0
    assert R.duplicate_row_parity(p).count() == 0


def test_column_match_passes_with_common(spark):
    p = pair(spark, [(1, 2)], [(1, 2)], "a int, b int", "a int, c int")
    r = P.column_match(p).first()
    assert r.passed and r.common_n == 1 and r.source_only == ["b"] and r.target_only == ["c"]


def test_all_null_column_and_nulls_injected(spark):
    p = pair(spark, [(1, None), (2, None)], [(1, None), (2, "x")], "k int, v string")
    got = by_col(PR.null_count_parity(p), "source_nulls"), by_col(PR.null_count_parity(p), "target_nulls")
    assert got == ({"k": 0, "v": 2}, {"k": 0, "v": 1})
    assert not by_col(PR.null_count_parity(p), "passed")["v"]


def test_nan_zero_negative_zero(spark):
    p = pair(spark, [(1, float("nan")), (2, 0.0), (3, -0.0)], [(1, float("nan")), (2, 0.0), (3, 0.0)], "k int, x double")
    # NaN = NaN and -0.0 = 0.0 as group keys: the frames are equal, x has two distinct values
    assert R.multiset_diff(p).count() == 0
    assert by_col(P.unique_value_parity(p), "source_distinct")["x"] == 2
    assert R.keyed_diff(p, ["k"]).count() == 0


def test_separator_and_null_marker_rows_differ(spark):
    p = pair(spark, [("a|b", "c"), ("__NULL__", "z")], [("a", "b|c"), (None, "z")], "x string, y string")
    d = R.multiset_diff(p)
    assert d.count() == 4
    assert R.frame_equal(p).filter("passed").count() == 0


def test_decimal_scale_and_big_integers(spark):
    ddl_a = "k bigint, d decimal(10,2)"
    ddl_b = "k bigint, d decimal(12,4)"
    big = 2 ** 53 + 1
    p = TablePair(spark.createDataFrame([(big, decimal.Decimal("1.50"))], ddl_a),
                  spark.createDataFrame([(big - 1, decimal.Decimal("1.5000"))], ddl_b))
    ranges = {r.column_name: r for r in PR.numeric_range_parity(p).collect()}
    assert ranges["d"].passed  # equal value, different scale: native compare
    assert not ranges["k"].passed  # 2^53+1 vs 2^53 differ (a float round trip would hide it)
    assert not P.schema_type_parity(p).filter("column_name = 'd'").first().passed


def test_array_and_map_columns(spark):
    ddl = "k int, a array<int>, m map<string,int>"
    p = pair(spark, [(1, [1, 2], {"x": 1, "y": 2})], [(1, [1, 2], {"y": 2, "x": 1})], ddl)
    assert R.multiset_diff(p).count() == 0  # maps compare as sorted entries
    assert by_col(P.unique_value_parity(p), "source_distinct") == {"a": 1, "k": 1, "m": 1}
    q = pair(spark, [(1, [1, 2], {"x": 1})], [(1, [2, 1], {"x": 2})], ddl)
    assert R.multiset_diff(q).count() == 2


def test_keyed_diff_changes_and_null_keys(spark):
    ddl = "k int, v string, w double"
    p = pair(spark, [(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0), (4, "d", 4.0)],
             [(1, "a", 1.0), (2, "B", 2.5), (None, "n", 0.0), (5, "e", 5.0)], ddl, keys=("k",))
    got = rows(R.keyed_diff(p), "k", "column_name", "source_value", "target_value", "change")
    assert got == sorted([(2, "v", "b", "B", "changed"), (2, "w", "2.0", "2.5", "changed"),
                          (4, None, None, None, "missing"), (5, None, None, None, "extra")], key=repr)


def test_keyed_diff_duplicate_keys_not_paired(spark):
    ddl = "k int, v int"
    p = pair(spark, [(1, 1)] * 3 + [(2, 2)], [(1, 1), (2, 3)], ddl, keys=("k",))
    got = rows(R.keyed_diff(p), "k", "source_value", "target_value", "change")
    assert (1, "3", "1", "duplicate_key") in got and (2, "2", "3", "changed") in got
    assert len(got) == 2


def test_duplicate_rows_must_fail(spark):
    ddl = "a int, b string"
    p = pair(spark, [(1, "x"), (2, "y")], [(1, "x"), (1, "x"), (2, "y")], ddl)
    r = R.duplicate_row_parity(p).first()
    assert (r.source_dups, r.target_dups, r.passed) == (0, 1, False)


def test_ranges_must_fail_and_types(spark):
    ddl = "n int, s string, t timestamp, d date"
    import datetime as dt
    a = [(1, "ab", dt.datetime(2020, 1, 1), dt.date(2020, 1, 1)), (5, "abcd", dt.datetime(2020, 2, 1), dt.date(2020, 3, 1))]
    b = [(1, "ab", dt.datetime(2020, 1, 1), dt.date(2020, 1, 1)), (6, "abcde", dt.datetime(2020, 2, 2), dt.date(2020, 3, 1))]
    p = pair(spark, a, b, ddl)
    assert by_col(PR.numeric_range_parity(p), "passed") == {"n": False}
    assert by_col(PR.string_length_parity(p), "passed") == {"s": False}
    assert by_col(PR.date_range_parity(p), "passed") == {"d": True, "t": False}


def test_nullable_and_type_drift(spark):
    sa = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.IntegerType(), True)])
    sb = T.StructType([T.StructField("k", T.LongType(), True), T.StructField("v", T.LongType(), True)])
    p = TablePair(spark.createDataFrame([(1, 2)], sa), spark.createDataFrame([(1, 2)], sb))
    assert by_col(P.nullable_parity(p), "passed") == {"k": False, "v": True}
    assert by_col(P.schema_type_parity(p), "passed") == {"k": True, "v": False}
    modes = {r.mode: r.passed for r in R.frame_equal(p).collect()}
    assert modes == {"general": False, "schema_adherence": False, "ignore_row_order": False}  # types differ


def test_frame_equal_nullability_only(spark):
    sa = T.StructType([T.StructField("k", T.LongType(), False)])
    sb = T.StructType([T.StructField("k", T.LongType(), True)])
    p = TablePair(spark.createDataFrame([(1,)], sa), spark.createDataFrame([(1,)], sb))
    modes = {r.mode: r.passed for r in R.frame_equal(p).collect()}
    assert modes == {"general": True, "schema_adherence": False, "ignore_row_order": False}


def test_describe_and_profile(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (3, None, "abc"), (None, float("nan"), None)], "i int, x double, s string")
    d = {r.column_name: r for r in PR.describe(df).collect()}
    assert set(d) == {"i", "x"} and d["i"].n == 2 and d["i"].mean == 2.0 and math.isclose(d["i"].sd, math.sqrt(2))
    p = {r.column_name: r for r in PR.profile(df).collect()}
    assert p["x"].nans == 1 and p["x"].nulls == 1 and p["s"].min_len == 1 and p["s"].max_len == 3 and p["i"].rows == 3


def test_pair_samples_first_common_column_nulls_last(spark):
    p = pair(spark, [(None, 1), (3, 1), (1, 1)], [(2, 1)], "a int, b int")
    got = rows(P.pair_samples(p, 2), "side", "value")
    assert got == [("source", "1"), ("source", "3"), ("target", "2")]


@pytest.mark.parametrize("null_keys,expected", [("drop", 2), ("match", 3)])
def test_unique_to_one_side(spark, null_keys, expected):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (None, "only"), (4, "w"), (4, "w")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (3, "q"), (None, "z")], "k int, v string")
    got = rows(R.unique_to_one_side(a, b, "A", "B", null_keys=null_keys), "k", "v", "database_name")
    # (1,'x') is on both sides and (4,'w') repeats within A: both dropped. Rows with a NULL
    # group column are dropped in 'drop' mode; in 'match' mode (NULL,'z') pairs up, (NULL,'only') stays.
    assert (2, "y", "A") in got and (3, "q", "B") in got
    assert len(got) == expected
    if null_keys == "match":
        assert (None, "only", "A") in got


def test_keyed_diff_mixed_types(spark):
    p = pair(spark, [(1, "7"), (2, "x")], [(1, 7), (2, 8)], "k int, v string", "k int, v bigint", keys=("k",))
    got = rows(R.keyed_diff(p), "k", "column_name", "source_value", "target_value", "change")
    assert got == [(2, "v", "x", "8", "changed")]


def test_set_operations_with_incomparable_types(spark):
    p = pair(spark, [(1, "7"), (2, "x")], [(1, 7), (2, 8)], "k int, v string", "k int, v bigint")
    assert rows(R.multiset_diff(p), "k", "v", "side", "n") == [(2, "8", "target", 1), (2, "x", "source", 1)]
    assert rows(R.multiset_diff_except(p), "k", "v", "side", "n") == [(2, "8", "target", 1), (2, "x", "source", 1)]
    assert {r.mode: r.types_equal for r in R.frame_equal(p).collect()}["general"] is False


def test_row_verdicts_group_digests(spark):
    """The verdicts move 16 bytes a row, and count as grouping by the columns does: NULL beside NULL, -0.0 as 0.0,
    NaN as NaN, and NULLs that stand in different columns apart."""
    ddl = "a int, b int, x double, f float, t string, z binary, n decimal(9,2)"
    nan = float("nan")
    src = [(1, None, 0.0, 0.0, "p", b"1", None), (None, 1, nan, nan, "", b"", decimal.Decimal("1.50")), (1, None, -0.0, -0.0, "p", b"1", None), (None,) * 7, (None,) * 7]
    tgt = [(None, 1, 0.0, 0.0, "p", b"1", None), (None, 1, nan, nan, "", b"", decimal.Decimal("1.5")), (1, None, -0.0, 0.0, "p", b"1", None), (None,) * 7, (2, 2, None, None, None, None, None)]
    pair = TablePair(spark.createDataFrame(src, ddl), spark.createDataFrame(tgt, ddl.replace("a int", "a bigint")), keys=())
    found = R.diff_summary(pair)
    assert tuple(found.first()) == (2, 2, 5, 5, 3, 5)
    by_columns = R.counted_rows(pair)
    assert by_columns.count() == 5 and by_columns.filter("source_n > 0").count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(_d0" in plan
    nested = TablePair(spark.createDataFrame([([0.0],)], "v array<double>"), spark.createDataFrame([([-0.0],)], "v array<double>"), keys=())
    assert tuple(R.diff_summary(nested).first()) == (0, 0, 1, 1, 1, 1)
    folded = "t string collate UTF8_LCASE"
    collated = TablePair(spark.createDataFrame([("A",)], folded), spark.createDataFrame([("a",)], folded), keys=())
    assert tuple(R.diff_summary(collated).first()) == (0, 0, 1, 1, 1, 1)


def test_distinct_counts_group_by_kind_of_value(spark):
    """Keys of one kind are grouped by (column, value) alone; a column of drifted types counts each side in its own kind."""
    src = [(1, 0.0, "a", [1], "1"), (1, -0.0, None, [1], "2"), (None, float("nan"), "b", None, "2")]
    tgt = [(1, 0.5, "a", [1], 1), (2, None, "a", [2], None), (None, None, "", [], 3)]
    p = pair(spark, src, tgt, "i int, d double, s string, v array<int>, k string", "i bigint, d double, s string, v array<int>, k int")
    found = P.unique_value_parity(p)
    assert by_col(found, "source_distinct") == {"i": 2, "d": 2, "s": 3, "v": 2, "k": 2}
    assert by_col(found, "target_distinct") == {"i": 3, "d": 2, "s": 2, "v": 3, "k": 3}
    counted = P.value_counts(p).groupBy("ci").agg({"*": "count"}).count()  # the wide keys stay for value_counts
    assert counted == 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(ci" in plan and not [x for x in plan.splitlines() if "hashpartitioning(ci" in x and ", l#" in x]
