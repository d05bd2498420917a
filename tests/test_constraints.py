"""Constraint checks: null rules per operator, must-fail inputs, and properties against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from paritas.operators import constraints as C
from paritas.operators import rowdiff as R
from paritas.operators.pair import TablePair
from paritas.plans import fixtures as FX


def test_pk_violations_composite_and_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1), (None, 1)], "a int, b int")
    r = C.pk_violations(df, ["a", "b"]).first()
    assert (r.total_rows, r.distinct_keys, r.violations, r.dup_keys, r.passed) == (7, 4, 3, 2, False)
    assert rows(C.pk_duplicates(df, ["a", "b"])) == [(1, 1, 2), (2, 1, 3)]
    assert rows(C.pk_samples(df, ["a", "b"], 1)) == [(2, 1, 3)]
    assert C.pk_violations(df.distinct(), ["a", "b"]).first().passed


def test_unique_constraints_ignore_nulls(spark):
    df = spark.createDataFrame([(1, "x", 1), (2, "x", 1), (3, None, 2), (4, None, 2), (5, "y", None)], "id int, s string, t int")
    u = {r.constraint_name: r for r in C.unique_violations(df, {"uq_s": ["s"], "uq_st": ["s", "t"], "uq_id": ["id"],
                                                                  "uq_none": ["t"]}).collect()}
    assert (u["uq_s"].non_null_rows, u["uq_s"].distinct_values, u["uq_s"].violations, u["uq_s"].dup_values) == (3, 2, 1, 1)
    assert (u["uq_st"].non_null_rows, u["uq_st"].violations) == (2, 1)  # rows with any NULL part are exempt
    assert u["uq_id"].passed and u["uq_st"].columns == ["s", "t"]
    assert u["uq_none"].non_null_rows == 4 and u["uq_none"].violations == 2


def test_unique_constraint_all_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, s string")
    r = C.unique_violations(df, {"uq_s": ["s"]}).first()
    assert (r.non_null_rows, r.violations, r.passed) == (0, 0, True)


def test_not_null_violations_nan_only_for_floats(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, float("nan"), "a", dt.date(2020, 1, 1), True), (2, None, None, None, None)],
                               "k int, x double, s string, d date, b boolean")
    got = {r.column_name: (r.nulls, r.nans, r.passed) for r in C.not_null_violations(df, df.columns).collect()}
    assert got == {"k": (0, 0, True), "x": (1, 1, False), "s": (1, 0, False), "d": (1, 0, False), "b": (1, 0, False)}


def test_orphans_null_modes_and_composite(spark):
    child = spark.createDataFrame([(1, 1), (1, 1), (2, 9), (None, 1), (None, 1), (3, None)], "a int, b int")
    parent = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (3, 3)], "pa int, pb int")
    orphan = rows(C.orphan_groups(child, parent, ["a", "b"], ["pa", "pb"], null_fk="orphan"))
    assert orphan == sorted([(2, 9, 1), (None, 1, 2), (3, None, 1)], key=repr)
    ignore = rows(C.orphan_groups(child, parent, ["a", "b"], ["pa", "pb"], null_fk="ignore"))
    assert ignore == [(2, 9, 1)]
    assert C.orphan_total(C.orphan_groups(child, parent, ["a", "b"], ["pa", "pb"])).first().total_orphans == 4
    with pytest.raises(ValueError):
        C.orphan_groups(child, parent, ["a"], ["pa", "pb"])


def test_orphan_total_equals_rows_minus_semi_join(spark, tables):
    child, parent = FX.lineitem_child(tables), FX.orders_parent(tables)
    total = C.orphan_total(C.orphan_groups(child, parent, ["l_orderkey"], ["o_orderkey"])).first().total_orphans
    joined = child.join(parent, child.l_orderkey == parent.o_orderkey, "left_semi").count()
    assert total == child.count() - joined > 0


def test_fk_missing_and_self_reference(spark, tables):
    s = FX.staff(tables)
    missing = C.self_reference_missing(s, ["id"], ["boss"])
    brute = {r.boss for r in s.collect() if r.boss is not None} - {r.id for r in s.collect()}
    assert {r.boss for r in missing.collect()} == brute and brute
    fk = C.fk_missing(s, s, {"fk_boss": (["boss"], ["id"])}).first()
    assert fk.missing_values == len(brute) and not fk.passed


def test_fk_missing_samples_smallest(spark):
    child = spark.createDataFrame([(i,) for i in range(30)], "c int")
    parent = spark.createDataFrame([(i,) for i in range(0, 30, 3)], "p int")
    got = [r.c for r in C.fk_missing_samples(child, parent, ["c"], ["p"], 4).collect()]
    assert got == [1, 2, 4, 5]


def test_integrity_report_rows(spark):
    orders = spark.createDataFrame([(1, 10), (2, 99)], "o int, c int")
    cust = spark.createDataFrame([(10,)], "c int")
    items = spark.createDataFrame([(1,), (3,), (None,)], "o int")
    out = [(C.ForeignKey("fk_oc", "orders", ("c",), "cust", ("c",)), cust)]
    inc = [(C.ForeignKey("fk_io", "items", ("o",), "orders", ("o",)), items)]
    got = {r.constraint_name: (r.direction, r.violations, r.passed) for r in C.integrity_report("orders", orders, out, inc).collect()}
    assert got == {"fk_oc": ("outgoing", 1, False), "fk_io": ("incoming", 2, False)}


def test_orphan_records_form(spark):
    child = spark.createDataFrame([(5, "x")], "k int, s string")
    parent = spark.createDataFrame([(1,)], "k int")
    fk = C.ForeignKey("fk", "child", ("k",), "parent", ("k",))
    r = C.orphan_records(child, parent, fk).first()
    assert r.child_table == "child" and r.foreign_key_columns == ["k"] and r.orphaned_values == {"k": "5"} and r.orphaned_count == 1


def test_fk_parity_and_metadata_column_parity(spark, tables):
    p = TablePair(tables.orders, FX.orders_target(tables))
    got = {r.metric: r for r in C.fk_parity(p, ["o_custkey"]).collect()}
    assert got["nulls"].source_value == 0 and got["nulls"].target_value > 0 and not got["nulls"].passed
    m = {(r.column_name, r.rule): r.passed for r in C.metadata_column_parity(p, ["o_orderkey"], ["o_custkey"]).collect()}
    assert m == {("o_orderkey", "identity_nulls"): True, ("o_custkey", "not_null_parity"): False}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_counted_diff_matches_except_all_and_mirrors(spark, seed):
    rnd = random.Random(seed)
    a = [(rnd.randint(0, 5), rnd.choice(["x", "y", None])) for _ in range(60)]
    b = [(rnd.randint(0, 5), rnd.choice(["x", "y", None])) for _ in range(50)]
    p = TablePair(spark.createDataFrame(a, "k int, v string"), spark.createDataFrame(b, "k int, v string"))
    fast = rows(R.multiset_diff(p), "k", "v", "side", "n")
    slow = rows(R.multiset_diff_except(p), "k", "v", "side", "n")
    assert fast == slow
    flip = TablePair(p.target, p.source)
    mirrored = rows(R.multiset_diff(flip).withColumn("side", F.when(F.col("side") == "source", "target").otherwise("source")),
                    "k", "v", "side", "n")
    assert mirrored == fast
    # brute force on Python multisets
    from collections import Counter
    ca, cb = Counter(a), Counter(b)
    expect = sorted([(k, v, "source", n) for (k, v), n in (ca - cb).items()] + [(k, v, "target", n) for (k, v), n in (cb - ca).items()],
                    key=repr)
    assert fast == expect
    assert R.multiset_diff(TablePair(p.source, p.source)).count() == 0


def test_fk_checks_with_incomparable_key_types(spark):
    child = spark.createDataFrame([("1",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([(1,), (2,)], "k bigint")
    assert rows(C.orphan_groups(child, parent, ["k"], ["k"])) == sorted([("x", 1), (None, 1)], key=repr)
    assert [r.k for r in C.fk_missing_values(child, parent, ["k"], ["k"]).collect()] == ["x"]
    out = R.unique_to_one_side(child, parent, "A", "B")
    assert rows(out, "k", "database_name") == [("2", "B"), ("x", "A")]
