"""Sources (layer paths, JDBC options), sinks (write and read back), the suite runner,
and every registered query against its DuckDB oracle at sf0.001."""

import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from paritas.functions.hashing import add_row_fingerprint, add_row_hash
from paritas.operators.pair import TablePair
from paritas.plans import fixtures as FX
from paritas.plans.suite import CHECKS, run_pair, run_suite, summarise
from paritas.sources.jdbc import JdbcSource, sqlserver_url
from paritas.sources.layers import PAIRINGS, LayerLocator, load_pair
from paritas.sources.sinks import write_report, write_results
from paritas.sources.tables import TABLES


def test_layer_paths():
    loc = LayerLocator(root="/lake/warehouse", landing_root="/mnt/temp/container", source_aliases=("crm", "erp"))
    assert loc.source_name("CRM_prod") == "crm" and loc.source_name("Other") == "other"
    assert LayerLocator().source_name("CRM_prod") == "crm_prod"
    assert loc.landing("t1", "xx_erp") == "/mnt/temp/container/erp/t1"
    assert loc.layer("silver", "t1", "crm") == "/lake/warehouse/silver_crm.db/s_crm_t1"
    assert loc.previous("silver", "t1", "crm").endswith("/bronze_crm.db/b_crm_t1")
    assert loc.previous("gold", "t1", "crm").endswith("/silver_crm.db/s_crm_t1")
    assert loc.layer("gold", "t1", "crm").endswith("/gold.db/t1")
    assert loc.truncated("t1").endswith("/gold_truncated.db/t1")
    with pytest.raises(ValueError):
        loc.previous("bronze", "t1", "crm")
    assert set(PAIRINGS) >= {"landing_to_bronze", "bronze_to_silver", "silver_to_gold", "gold_to_truncated", "sql_to_landing"}


def test_jdbc_options_without_server():
    src = JdbcSource(url=sqlserver_url("host:1433", "db1"), driver="com.microsoft.sqlserver.jdbc.SQLServerDriver",
                     user="u", password="p")
    assert src.url == "jdbc:sqlserver://host:1433;databaseName=db1;encrypt=true;trustServerCertificate=true;"
    opts = src.table_options("dbo.t", partition_column="id", lower_bound=0, upper_bound=1000, num_partitions=16)
    assert opts["dbtable"] == "dbo.t" and opts["numPartitions"] == "16" and opts["partitionColumn"] == "id"
    assert opts["user"] == "u" and opts["driver"].endswith("SQLServerDriver")
    assert src.query_options("SELECT 1")["query"] == "SELECT 1"
    with pytest.raises(ValueError):
        src.table_options("t", partition_column="id")


def test_sql_pairing_needs_jdbc_factory(spark):
    with pytest.raises(ValueError):
        load_pair(spark, "sql_to_landing", LayerLocator(root="/x", landing_root="/y"), "t", "crm")


def test_layer_round_trip_and_sinks(spark, tables):
    root = tempfile.mkdtemp(prefix="paritas-test-", dir="/tmp")
    loc = LayerLocator(root=root, landing_root=root + "/landing")
    tables.orders.write.parquet(loc.layer("silver", "orders", "crm"))
    FX.orders_target(tables).write.parquet(loc.layer("gold", "orders", "crm"))
    pair = load_pair(spark, "silver_to_gold", loc, "orders", "crm", keys=("o_orderkey",))
    assert pair.source.count() == tables.orders.count() and pair.target.count() == FX.orders_target(tables).count()
    results = run_pair(pair, ["row_counts", "null_count_per_column"])
    write_results(results, root + "/results")
    back = spark.read.parquet(root + "/results")
    assert back.count() == results.count() and set(back.columns) >= {"database_name", "table_name", "check"}
    assert os.path.isdir(root + "/results/database_name=crm/table_name=orders")
    paths = write_report({"source_only": tables.region, "target_only": tables.nation}, root + "/report")
    assert [spark.read.parquet(p).count() for p in paths] == [tables.region.count(), tables.nation.count()]
    from paritas.operators.parity import column_match
    csv = write_report({"match": column_match(pair)}, root + "/csv", fmt="csv")
    got = spark.read.option("header", "true").csv(csv[0]).first()
    assert got.source_only == '["o_orderstatus"]' and got.target_only == '["load_id"]'


def test_suite_errors_skips_and_summary(spark, tables):
    def broken():
        raise FileNotFoundError("no such table")

    no_common = TablePair(tables.region, tables.nation, database_name="db", table_name="mismatch")
    ok = TablePair(tables.orders, tables.orders, keys=("o_orderkey",), database_name="db", table_name="orders")
    res = run_suite(spark, [("db", "gone", broken), no_common, ok])
    errs = res.filter("status = 'error'").collect()
    assert len(errs) == 1 and errs[0].table_name == "gone" and "no such table" in errs[0].detail
    skipped = {r.check for r in res.filter("status = 'skipped'").collect()}
    assert {"dataframe_general_equality", "duplicate_row_count", "unique_value_counts"} <= skipped
    summ = {r.table_name: r for r in summarise(res).collect()}
    assert summ["orders"].all_passed and summ["orders"].failed_rows == 0
    assert not summ["mismatch"].all_passed and not summ["gone"].all_passed
    assert set(r.check for r in res.filter("table_name = 'orders'").collect()) == set(CHECKS)


def test_row_hash_forms(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("__NULL__", "x")], "p string, q string")
    h = [r.row_hash for r in add_row_hash(df).collect()]
    assert h[0] == h[1] and h[2] == h[3]  # the reference's text form collides on these
    f = [r.row_fingerprint for r in add_row_fingerprint(df).collect()]
    assert len(set(f)) == 4
    assert len(add_row_hash(df, algorithm="md5").first().row_hash) == 32
    with pytest.raises(ValueError):
        add_row_hash(df, algorithm="crc")


def _canon(names, rows):
    import datetime as dt
    import math

    def norm(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else round(v, 6)
        if isinstance(v, (dt.datetime, dt.date)):
            return v.isoformat()
        if isinstance(v, (list, tuple)):
            return tuple(norm(x) for x in v)
        return v
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


SLOW = {"fk_cycles", "fk_cycle_components", "graph_cycle_witnesses", "catalog_constraint_rows", "suite_summary"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _registered():
    import __spark_entry__ as E
    return E.queries(), E.oracle_sql()


@pytest.mark.parametrize("name", sorted(n for n in _registered()[1] if n not in SLOW))
def test_query_matches_oracle(spark, duck, name):
    qs, ors = _registered()
    df = qs[name](spark, SF_SMALL)
    s = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ors[name])
    d = _canon([c[0] for c in cur.description], cur.fetchall())
    assert s == d


def test_every_query_has_oracle_or_is_rows_only():
    qs, ors = _registered()
    assert set(ors) <= set(qs)
    from paritas.plans.queries import QUERIES
    assert set(QUERIES) <= set(ors)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "passed" in df.columns
    assert df.filter(F.col("status") == "error").count() == 0
