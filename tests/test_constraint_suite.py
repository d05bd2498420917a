"""Metadata-driven constraint checks: catalog rows from frames, key constraints, run_constraints."""

from pyspark.sql import functions as F

from paritas.operators import catalog as G
from paritas.plans.constraint_suite import declared, run_constraints
from paritas.sources.catalog import CatalogTables


def _frames(spark):
    return {
        "staff": spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 9, "b"), (4, 2, None)], "id int, boss int, team string"),
        "orders": spark.createDataFrame([(1, 10, 1.0), (1, 11, 2.0), (2, 99, None), (3, None, float("nan"))],
                                        "o int, c int, amount double"),
        "cust": spark.createDataFrame([(10, "x", 1), (11, "x", 1), (12, "y", 2)], "c int, name string, grp int"),
    }


def _catalog(spark, frames):
    return CatalogTables.from_frames(
        spark, frames, primary_keys={"staff": ["id"], "orders": ["o"], "cust": ["c"]},
        foreign_keys=[("fk_boss", "staff", ["boss"], "staff", ["id"]), ("fk_orders_cust", "orders", ["c"], "cust", ["c"])],
        unique_keys={"cust": [["name", "grp"]]}, not_null={"orders": ["amount"]}, database_name="db")


def test_catalog_rows_from_frames(spark):
    frames = _frames(spark)
    cat = _catalog(spark, frames)
    meta = {(r.table_name, r.column_name): r for r in G.column_metadata(cat).collect()}
    assert meta[("orders", "amount")].data_type == "double" and not meta[("orders", "amount")].is_nullable
    assert meta[("orders", "o")].is_primary_key and meta[("cust", "grp")].is_unique_constraint
    keys = {(r.table_name, r.kind): r.columns for r in G.key_constraints(cat).collect()}
    assert keys == {("staff", "primary_key"): ["id"], ("orders", "primary_key"): ["o"], ("cust", "primary_key"): ["c"],
                    ("cust", "unique"): ["name", "grp"]}
    spec = {d.label: d for d in declared(cat).values()}
    assert [f.name for f in spec["staff"].loops] == ["fk_boss"] and [f.name for f in spec["cust"].into] == ["fk_orders_cust"]


def test_run_constraints_finds_each_violation(spark):
    frames = _frames(spark)
    res = {(r.table_name, r.check, r.column_name): r for r in run_constraints(spark, _catalog(spark, frames), frames, samples=0).collect()}
    assert res[("orders", "primary_key_uniqueness", "o")].source_value == "1" and not res[("orders", "primary_key_uniqueness", "o")].passed
    assert res[("orders", "not_null_constraints", "amount")].source_value == "2"  # one NULL, one NaN
    assert ("orders", "not_null_constraints", "c") not in res  # a nullable FK column has no not-null check
    assert res[("orders", "referential_integrity", "c")].source_value == "1"  # 99; NULL is exempt
    assert res[("cust", "orphaned_records", "c")].source_value == "2"  # 99 and the NULL row (reference rule)
    assert res[("staff", "self_referencing_integrity", "boss")].source_value == "1"  # boss 9
    assert res[("cust", "unique_constraints", "name,grp")].source_value == "1"
    assert res[("staff", "primary_key_uniqueness", "id")].passed
    assert all(r.status == "ok" for r in res.values())


def test_run_constraints_ignore_null_fk(spark):
    frames = _frames(spark)
    res = {(r.table_name, r.check): r for r in run_constraints(spark, _catalog(spark, frames), frames, null_fk="ignore", samples=0).collect()}
    assert res[("cust", "orphaned_records")].source_value == "1"


def test_catalog_parquet_round_trip_and_validation(spark):
    import tempfile

    import pytest

    from paritas.sources.catalog import CATALOG_COLUMNS
    frames = _frames(spark)
    cat = _catalog(spark, frames)
    root = tempfile.mkdtemp(prefix="paritas-cat-", dir="/tmp")
    for name in CATALOG_COLUMNS:
        getattr(cat, name).write.parquet(f"{root}/{name}")
    back = CatalogTables.from_parquet(spark, root, "db")
    assert sorted(map(tuple, G.key_constraints(back).collect())) == sorted(map(tuple, G.key_constraints(cat).collect()))
    with pytest.raises(ValueError):
        CatalogTables(**{n: getattr(cat, n) for n in CATALOG_COLUMNS} | {"tables": spark.range(1)})


def test_one_scan_per_table(spark, capsys):
    from paritas.plans import constraint_suite as CS
    frames = _frames(spark)
    spec = declared(_catalog(spark, frames))
    known = CS.frames_by_id(spec, frames)
    for i, d in spec.items():
        plan = CS._plan(spec, known, i, [])
        assert len(plan.cells) == {"staff": 4, "orders": 4, "cust": 4}[d.label]
        CS.key_cells(known[i], plan.cells).explain()
        text = capsys.readouterr().out
        assert text.count("Scan") == 1 and text.count("Exchange") == 1 and "SortAggregate" not in text


def test_samples_of_duplicates_and_missing_values(spark):
    frames = _frames(spark)
    got = sorted((r.table_name, r.check, r.metric, r.source_value, r.target_value) for r in run_constraints(spark, _catalog(spark, frames), frames).collect() if r.metric.endswith("_sample"))
    assert got == [("cust", "unique_constraints", "duplicate_sample", "x, 1", "2"), ("orders", "primary_key_uniqueness", "duplicate_sample", "1", "2"),
                   ("orders", "referential_integrity", "missing_sample", "99", "1"), ("staff", "self_referencing_integrity", "missing_sample", "9", "1")]


def test_empty_tables_missing_columns_and_frames(spark):
    frames = _frames(spark)
    cat = _catalog(spark, frames)
    given = {"orders": frames["orders"].drop("amount"), "staff": frames["staff"].limit(0)}
    rows = run_constraints(spark, cat, given).collect()
    by = {(r.table_name, r.check): r for r in rows}
    assert by[("orders", "not_null_constraints")].status == "error" and by[("orders", "primary_key_uniqueness")].source_value == "1"
    assert by[("orders", "referential_integrity")].status == "skipped" and "cust" in by[("orders", "referential_integrity")].detail
    assert by[("staff", "primary_key_uniqueness")].passed and by[("staff", "self_referencing_integrity")].passed
    assert run_constraints(spark, cat, {}).collect() == []


def test_keys_of_drifted_and_temporal_types(spark):
    import datetime as dt
    day = dt.date(2024, 2, 29)
    frames = {"p": spark.createDataFrame([(1.0, day), (2.5, None), (2.5, day)], "id double, day date"),
              "c": spark.createDataFrame([(1, day, True), (7, None, True)], "id bigint, day date, ok boolean").withColumn("id", F.col("id").cast("decimal(10,2)"))}
    cat = CatalogTables.from_frames(spark, frames, {"p": ["id"], "c": ["day"]}, [("fk", "c", ["id"], "p", ["id"]), ("both", "c", ["id", "day"], "p", ["id", "day"])], {"c": [["ok"]]})
    got = {(r.check, r.metric, r.column_name): (r.source_value, r.target_value) for r in run_constraints(spark, cat, frames).collect()}
    assert got[("referential_integrity", "missing_values", "id")] == ("1", None) and got[("referential_integrity", "missing_sample", "id")] == ("7E0", "1")
    assert got[("referential_integrity", "missing_values", "id,day")] == ("0", None) and got[("orphaned_records", "orphaned_rows", "id,day")] == ("1", None)
    assert got[("primary_key_uniqueness", "duplicate_sample", "id")] == ("2.5", "2") and got[("unique_constraints", "duplicate_sample", "ok")] == ("true", "2")
