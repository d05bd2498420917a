"""Scope runs, catalog checks of the suite, samples, and split reads of a database."""

import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import paritas.plans.suite as S
from paritas.operators import catalog as G
from paritas.operators.pair import TablePair
from paritas.sources.catalog import CatalogTables
from paritas.sources.jdbc import JdbcSource, inner_bounds, predicates, quantile_sql
from paritas.sources.layers import PAIRINGS, LayerLocator


def test_split_conditions_cover_every_value_once():
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i % 7 = 0 THEN NULL WHEN i < 500 THEN 5 ELSE i * i END AS k, 'o''' || i AS s FROM range(1000) r(i)")
    least = [r[0] for r in con.execute(quantile_sql("t", "k", 8)).fetchall()]
    bounds = inner_bounds(least)
    parts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in predicates("k", bounds)]
    assert sum(parts) == 1000 and len(bounds) == len(set(bounds)) and max(parts[2:]) < 200
    assert predicates("k", []) == ["1 = 1"] and predicates("s", ["o'1"])[1] == "s >= 'o''1'"
    assert inner_bounds([3, 3, 3]) == []
    with pytest.raises(ValueError):
        quantile_sql("t", "k", 0)
    with pytest.raises(ValueError):
        predicates("k", [None, 1])


def test_split_reaches_the_reader_through_the_pairing(monkeypatch):
    asked = {}
    monkeypatch.setattr(JdbcSource, "table", lambda self, spark, table, **how: asked.update({table: how}))
    loc = LayerLocator(jdbc=lambda database: JdbcSource(url="jdbc:x"), splits={"big": {"split_column": "id", "parts": 16}})
    for table in ("big", "small"):
        PAIRINGS["sql_to_landing"][0](None, loc, table, "db")
    assert asked == {"big": {"split_column": "id", "parts": 16}, "small": {}}


def test_split_asks_the_database_for_bounds(monkeypatch):
    class Reader:
        def jdbc(self, url, table, predicates, properties):
            return url, table, predicates, properties

    spark = type("S", (), {"read": Reader()})()
    src = JdbcSource(url="jdbc:x", user="u")
    monkeypatch.setattr(JdbcSource, "quantiles", lambda self, spark, table, column, parts: [10, 20])
    _, _, conditions, properties = src.table(spark, "t", split_column="id", parts=3)
    assert conditions == ["id < 10 OR id IS NULL", "id >= 10 AND id < 20", "id >= 20"] and properties["user"] == "u" and "url" not in properties
    assert src.table(spark, "t", split_column="id", split_bounds=[7])[2] == ["id < 7 OR id IS NULL", "id >= 7"]


def test_scope_is_restartable(spark, tables, monkeypatch):
    root = tempfile.mkdtemp(prefix="paritas-scope-", dir="/tmp")
    loc = LayerLocator(root=root)
    for layer in ("silver", "gold"):
        tables.region.write.parquet(loc.layer(layer, "region", "crm"))
    ran = []
    real = S.run_pair
    monkeypatch.setattr(S, "run_pair", lambda pair, names: ran.append(pair.table_name) or real(pair, names))
    args = dict(scope={"crm": ["region", "late"], "erp": ["region"]}, pairings=["silver_to_gold"], path=f"{root}/results", checks=["row_counts"], databases=["crm"])
    first = {(r.pairing, r.database_name, r.table_name): r.status for r in S.run_scope(spark, loc, **args).collect()}
    assert first == {("silver_to_gold", "crm", "region"): "ok", ("silver_to_gold", "crm", "late"): "error"} and ran == ["region"]
    for layer in ("silver", "gold"):
        tables.nation.write.parquet(loc.layer(layer, "late", "crm"))
    again = {(r.table_name, r.check): r.status for r in S.run_scope(spark, loc, **args).collect()}
    assert again == {("region", "row_counts"): "ok", ("late", "row_counts"): "ok"} and ran == ["region", "late"]
    S.run_scope(spark, loc, **args)
    assert ran == ["region", "late"]  # finished tables are not run again
    assert S.scope_items(args["scope"], ["a", "b"], tables=["late"]) == [("a", "crm", "late"), ("b", "crm", "late")]
    assert S.run_scope(spark, loc, **(args | {"databases": []})).collect() == []


def test_samples_are_in_the_order_of_their_type(spark):
    df = spark.createDataFrame([(10,), (None,), (9,)], "v bigint")
    p = TablePair(df, df.limit(0), database_name="db", table_name="t")
    r = S.run_pair(p, ["data_diagnosis_sample"]).first()
    assert (r.source_value, r.target_value) == ("9,10,NULL", "")


def test_catalog_checks_follow_the_metadata(spark):
    kind = "id int, fk int, note string"
    a = spark.createDataFrame([(1, 10, "x"), (2, None, None), (None, 11, "y")], kind)
    b = spark.createDataFrame([(1, 10, "x"), (2, None, "z")], kind)
    cat = CatalogTables.from_frames(spark, {"t": a.withColumn("gone", F.lit(1))}, {"t": ["id"]}, [("self", "t", ["fk"], "t", ["id"])], not_null={"t": ["note", "gone"]})
    meta = G.column_metadata(cat).withColumn("is_identity", F.col("column_name") == "id")
    other = G.column_metadata(CatalogTables.from_frames(spark, {"t": b}, {"t": ["id"]}, not_null={"t": ["note"]}))
    names = ["table_metadata_retrieval", "schema_comparison", "foreign_key_integrity", "metadata_driven_column_validation"]
    pair = TablePair(a, b, database_name="db", table_name="t").with_metadata(meta, other)
    got = {(r.check, r.column_name, r.metric): (r.source_value, r.target_value, r.passed, r.status) for r in S.run_pair(pair, names).collect()}
    assert got[("foreign_key_integrity", "fk", "nulls")] == ("1", "1", True, "ok") and got[("foreign_key_integrity", "fk", "distinct_values")] == ("3", "2", False, "ok")
    assert got[("metadata_driven_column_validation", "id", "identity_nulls")] == ("1", "0", False, "ok")
    assert got[("metadata_driven_column_validation", "note", "not_null_parity")] == ("1", "0", False, "ok")
    assert got[("metadata_driven_column_validation", "gone", "not_null_parity")][2:] == (None, "skipped")
    assert got[("schema_comparison", "gone", "presence")][0] == "source_only" and got[("schema_comparison", None, "differences")] == ("1", None, False, "ok")
    assert got[("table_metadata_retrieval", None, "columns")] == ("4", None, True, "ok")
    empty = TablePair(a.limit(0), b.limit(0), table_name="t").with_metadata(meta)
    rows = {(r.check, r.metric): (r.source_value, r.passed, r.status) for r in S.run_pair(empty, names).collect() if r.column_name in (None, "fk")}
    assert rows[("foreign_key_integrity", "nulls")] == ("0", True, "ok") and rows[("schema_comparison", None)][2] == "skipped"
    unknown = S.run_pair(TablePair(a, b, table_name="t").with_metadata(meta.limit(0)), names[:1]).collect()
    assert [r.passed for r in unknown] == [False, False]


def test_cache_ends_with_its_block_and_finds_excluded_tables(spark):
    frame = spark.createDataFrame([(1,)], "id int")
    cat = CatalogTables.from_frames(spark, {"t": frame, "t_DO_NOT_USE": frame}, {})
    with G.MetadataCache(lambda db: cat) as cache:
        assert {r.table_name for r in cache.database("db").collect()} == {"t"}
        assert cache.table("db", "t_DO_NOT_USE").count() == 1 and ("db", "dbo") in cache
    assert ("db", "dbo") not in cache


def test_unresolved_target_stays_in_the_metadata(spark):
    frame = spark.createDataFrame([(1, 2)], "id int, fk int")
    cat = CatalogTables.from_frames(spark, {"a": frame, "b": frame}, {}, [("k", "a", ["fk"], "b", ["id"])])
    import dataclasses

    cat = dataclasses.replace(cat, tables=cat.tables.filter("name = 'a'"))
    keys = [tuple(k) for r in G.column_metadata(cat).filter("column_name = 'fk'").collect() for k in r.foreign_keys]
    assert keys == [("k", None, None, "id")] and G.referencing_tables(cat).collect() == []
