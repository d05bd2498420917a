"""Registered queries: one per operator of the inventory, each over whole given tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose columns are
named as in the matching oracle statement (``paritas.plans.oracle``). Most are lazy; those of iterative
operators, the suite and the keyed diff checkpoint steps when they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.functions.hashing import add_row_hash
from paritas.operators import catalog as G
from paritas.operators import constraints as C
from paritas.operators import graph as GR
from paritas.operators import parity as P
from paritas.operators import profile as PR
from paritas.operators import rowdiff as R
from paritas.operators.pair import TablePair
from paritas.plans import fixtures as FX
from paritas.session import reliable_checkpoint
from paritas.sources.tables import TableSet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[TableSet], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(TableSet(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def orders_pair(t: TableSet, **kw) -> TablePair:
    return TablePair(t.orders, FX.orders_target(t, **kw), keys=("o_orderkey",), table_name="orders")


def customer_pair(t: TableSet) -> TablePair:
    return TablePair(t.customer, FX.customer_other(t), keys=("c_custkey",), table_name="customer")


def _join_names(c: str) -> F.Column:
    return F.array_join(F.col(c), ",").alias(c)


# -- E: pair checks -------------------------------------------------------------

@query("pair_diagnosis")
def _pair_diagnosis(t: TableSet) -> DataFrame:
    """E1 summary row for orders vs its injected target."""
    d = P.pair_diagnosis(orders_pair(t))
    return d.select("source_rows", "target_rows", "row_diff", "source_cols", "target_cols", "common_cols",
                    _join_names("source_only"), _join_names("target_only"))


@query("pair_samples")
def _pair_samples(t: TableSet) -> DataFrame:
    """Five smallest values of the first common column per side."""
    return P.pair_samples(orders_pair(t), 5)


@query("row_count_parity")
def _row_count_parity(t: TableSet) -> DataFrame:
    return PR.row_count_parity(orders_pair(t))


@query("column_count_parity")
def _column_count_parity(t: TableSet) -> DataFrame:
    return P.column_count_parity(orders_pair(t))


@query("column_match")
def _column_match(t: TableSet) -> DataFrame:
    return P.column_match(orders_pair(t)).select("common_n", _join_names("source_only"), _join_names("target_only"), "passed")


@query("schema_type_parity")
def _schema_type_parity(t: TableSet) -> DataFrame:
    """E8 with type drift (o_custkey as int on the target)."""
    return P.schema_type_parity(TablePair(t.orders, FX.orders_target(t, custkey_type="int")))


@query("nullable_parity")
def _nullable_parity(t: TableSet) -> DataFrame:
    """E9 with nullability drift (o_orderkey declared NOT NULL on the target)."""
    return P.nullable_parity(TablePair(t.orders, FX.non_nullable(FX.orders_target(t), "o_orderkey")))


@query("null_count_parity")
def _null_count_parity(t: TableSet) -> DataFrame:
    return PR.null_count_parity(orders_pair(t))


@query("duplicate_row_parity")
def _duplicate_row_parity(t: TableSet) -> DataFrame:
    return R.duplicate_row_parity(orders_pair(t))


@query("numeric_range_parity")
def _numeric_range_parity(t: TableSet) -> DataFrame:
    r = PR.numeric_range_parity(orders_pair(t))
    return r.select("column_name", *[F.col(c).cast("double").alias(c) for c in ("source_min", "target_min", "source_max", "target_max")], "passed")


@query("describe_profile")
def _describe_profile(t: TableSet) -> DataFrame:
    """D7 on lineitem: count, mean, stddev (sample), min, max per numeric column."""
    d = PR.describe(t.lineitem)
    return d.select("column_name", "n", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"), "min", "max")


@query("string_length_parity")
def _string_length_parity(t: TableSet) -> DataFrame:
    r = PR.string_length_parity(customer_pair(t))
    return r.select("column_name", *[F.col(c).cast("int").alias(c) for c in ("source_min", "target_min", "source_max", "target_max")], "passed")


@query("date_range_parity")
def _date_range_parity(t: TableSet) -> DataFrame:
    return PR.date_range_parity(orders_pair(t))


@query("unique_value_parity")
def _unique_value_parity(t: TableSet) -> DataFrame:
    return P.unique_value_parity(orders_pair(t))


@query("frame_equal")
def _frame_equal(t: TableSet) -> DataFrame:
    return R.frame_equal(orders_pair(t))


@query("multiset_diff")
def _multiset_diff(t: TableSet) -> DataFrame:
    return R.multiset_diff(orders_pair(t))


@query("keyed_diff")
def _keyed_diff(t: TableSet) -> DataFrame:
    """E5 keyed: the target without its doubled rows (a keyed diff needs unique keys)."""
    return R.keyed_diff(orders_pair(t, doubled=False))


@query("keyed_diff_dup_keys")
def _keyed_diff_dup_keys(t: TableSet) -> DataFrame:
    """E5 keyed on the doubled target: repeated keys are reported, never paired."""
    return R.keyed_diff(orders_pair(t)).filter(F.col("change") == "duplicate_key")


@query("number_drift")
def _number_drift(t: TableSet) -> DataFrame:
    """E5 across drifted types of numbers and dates: differences per column and kind."""
    found = R.keyed_diff(TablePair(*FX.drifted_orders(t), keys=("k",)))
    return found.groupBy("column_name", "change").agg(F.count("*").alias("n"))


@query("number_drift_multiset")
def _number_drift_multiset(t: TableSet) -> DataFrame:
    """E7 and E11 across drifted types, without keys."""
    return R.diff_summary(TablePair(*FX.drifted_orders(t)), ["huge", "price", "tenth", "tiny"])


@query("number_drift_ranges")
def _number_drift_ranges(t: TableSet) -> DataFrame:
    """E12 across drifted types."""
    return PR.numeric_range_parity(TablePair(*FX.drifted_orders(t))).select("column_name", "passed")


@query("nested_unique_values")
def _nested_unique_values(t: TableSet) -> DataFrame:
    """E15 on nested columns: two orders of a map's entries are one value."""
    return P.unique_value_parity(TablePair(*FX.nested_orders(t)))


@query("row_hash")
def _row_hash(t: TableSet) -> DataFrame:
    return add_row_hash(FX.orders_target(t, doubled=False)).select("o_orderkey", "row_hash")


@query("row_hash_md5")
def _row_hash_md5(t: TableSet) -> DataFrame:
    return add_row_hash(FX.orders_target(t, doubled=False), algorithm="md5").select("o_orderkey", "row_hash")


@query("unique_to_one_side")
def _unique_to_one_side(t: TableSet) -> DataFrame:
    return R.unique_to_one_side(t.customer, FX.customer_other(t), "customer", "customer_other")


# -- H: constraints on data -----------------------------------------------------

LINEITEM_KEY = ("l_orderkey", "l_linenumber")


@query("pk_violations")
def _pk_violations(t: TableSet) -> DataFrame:
    return C.pk_violations(t.lineitem, LINEITEM_KEY)


@query("pk_duplicates")
def _pk_duplicates(t: TableSet) -> DataFrame:
    return C.pk_duplicates(t.lineitem, LINEITEM_KEY)


@query("pk_samples")
def _pk_samples(t: TableSet) -> DataFrame:
    """Top-10 report of the most repeated lineitem key combinations."""
    return C.pk_samples(t.lineitem, LINEITEM_KEY, 10)


@query("pk_parity")
def _pk_parity(t: TableSet) -> DataFrame:
    return C.pk_parity(orders_pair(t))


@query("not_null_violations")
def _not_null_violations(t: TableSet) -> DataFrame:
    e = FX.events_bad(t)
    return C.not_null_violations(e, e.columns)


@query("unique_violations")
def _unique_violations(t: TableSet) -> DataFrame:
    u = C.unique_violations(t.part, {"uq_part_name": ["p_name"], "uq_brand_size": ["p_brand", "p_size"],
                                      "uq_partkey": ["p_partkey"]})
    return u.select("constraint_name", F.array_join("columns", ",").alias("columns"), "non_null_rows",
                    "distinct_values", "violations", "dup_values", "passed")


@query("fk_missing")
def _fk_missing(t: TableSet) -> DataFrame:
    return C.fk_missing(FX.lineitem_child(t), FX.orders_parent(t), {"fk_lineitem_orders": (["l_orderkey"], ["o_orderkey"])})


@query("fk_missing_samples")
def _fk_missing_samples(t: TableSet) -> DataFrame:
    return C.fk_missing_samples(FX.lineitem_child(t), FX.orders_parent(t), ["l_orderkey"], ["o_orderkey"], 10)


@query("self_ref_missing")
def _self_ref_missing(t: TableSet) -> DataFrame:
    return C.self_reference_missing(FX.staff(t), ["id"], ["boss"])


@query("orphan_groups")
def _orphan_groups(t: TableSet) -> DataFrame:
    return C.orphan_groups(FX.lineitem_child(t), FX.orders_parent(t), ["l_orderkey"], ["o_orderkey"], null_fk="orphan")


@query("orphan_groups_ignore_null")
def _orphan_groups_ignore_null(t: TableSet) -> DataFrame:
    return C.orphan_groups(FX.lineitem_child(t), FX.orders_parent(t), ["l_orderkey"], ["o_orderkey"], null_fk="ignore")


@query("orphan_groups_composite")
def _orphan_groups_composite(t: TableSet) -> DataFrame:
    """Composite FK (o_orderkey, o_custkey) of the injected orders target into orders_parent."""
    return C.orphan_groups(FX.orders_target(t), FX.orders_parent(t), ["o_orderkey", "o_custkey"],
                           ["o_orderkey", "o_custkey"], null_fk="orphan")


@query("orphan_total")
def _orphan_total(t: TableSet) -> DataFrame:
    return C.orphan_total(C.orphan_groups(FX.lineitem_child(t), FX.orders_parent(t), ["l_orderkey"], ["o_orderkey"]))


@query("integrity_report")
def _integrity_report(t: TableSet) -> DataFrame:
    """H9 for orders_parent: its FK into customer (outgoing) and lineitem_child's FK into it (incoming)."""
    out = [(C.ForeignKey("fk_orders_customer", "orders", ("o_custkey",), "customer", ("c_custkey",)), t.customer)]
    inc = [(C.ForeignKey("fk_lineitem_orders", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",)), FX.lineitem_child(t))]
    return C.integrity_report("orders", FX.orders_parent(t), out, inc)


@query("fk_parity")
def _fk_parity(t: TableSet) -> DataFrame:
    return C.fk_parity(orders_pair(t), ["o_custkey"])


@query("metadata_column_parity")
def _metadata_column_parity(t: TableSet) -> DataFrame:
    return C.metadata_column_parity(orders_pair(t), identity_columns=["o_orderkey"],
                                    not_null_columns=["o_custkey", "o_orderdate", "o_totalprice"])


# -- G: catalog operators over the catalog derived from the data -----------------

def _fk_text(col: str = "foreign_keys") -> F.Column:
    return F.array_join(F.transform(col, lambda x: F.concat_ws(":", x["foreign_key_name"], x["referenced_schema_name"],
                                                              x["referenced_table_name"], x["referenced_column_name"])), ";")


def _meta(t: TableSet, variant: str = "a") -> DataFrame:
    return G.column_metadata(FX.derived_catalog(t, variant))


@query("catalog_metadata")
def _catalog_metadata(t: TableSet) -> DataFrame:
    """Column metadata of every table; DO_NOT tables excluded; FKs as one text."""
    m = _meta(t)
    return m.select(*[c for c in m.columns if c != "foreign_keys"], _fk_text().alias("foreign_keys"))


@query("table_metadata")
def _table_metadata(t: TableSet) -> DataFrame:
    """One table's rows through the metadata cache."""
    with G.MetadataCache(lambda db: FX.derived_catalog(t, db[-1])) as cache:
        m = reliable_checkpoint(cache.table("db_a", "Customer#000000001", schema_name=None))
    return m.select(*[c for c in m.columns if c != "foreign_keys"], _fk_text().alias("foreign_keys"))


@query("table_metadata_nested")
def _table_metadata_nested(t: TableSet) -> DataFrame:
    """DM6/G3: the nested form of one table, columns in column-id order."""
    with G.MetadataCache(lambda db: FX.derived_catalog(t, db[-1])) as cache:
        n = reliable_checkpoint(cache.table_nested("db_a", "Customer#000000001", schema_name=None))
    return n.select("database_name", "schema_name", "table_name", F.size("columns").cast("bigint").alias("n_columns"),
                    F.array_join(F.transform("columns", lambda x: x["column_name"]), ",").alias("column_names"))


@query("table_list")
def _table_list(t: TableSet) -> DataFrame:
    return G.table_list(_meta(t))


@query("pk_columns")
def _pk_columns(t: TableSet) -> DataFrame:
    return G.pk_columns(_meta(t))


@query("fk_columns")
def _fk_columns(t: TableSet) -> DataFrame:
    return G.fk_columns(_meta(t))


@query("schema_compare")
def _schema_compare(t: TableSet) -> DataFrame:
    """Column differences between the two derived databases."""
    return G.compare_schemas(_meta(t, "a"), _meta(t, "b"))


@query("schema_compare_summary")
def _schema_compare_summary(t: TableSet) -> DataFrame:
    return G.compare_schemas_summary(_meta(t, "a"), _meta(t, "b"))


def _referencing(t: TableSet, include_self: bool) -> DataFrame:
    r = G.referencing_tables(FX.derived_catalog(t), include_self=include_self)
    return r.select(*[c for c in r.columns if c not in ("constrained_columns", "referred_columns")],
                    F.array_join("constrained_columns", ",").alias("constrained_columns"),
                    F.array_join("referred_columns", ",").alias("referred_columns"))


@query("referencing_tables")
def _referencing_tables(t: TableSet) -> DataFrame:
    """Every FK with its child and parent column lists, self references included."""
    return _referencing(t, True)


@query("referencing_tables_no_self")
def _referencing_tables_no_self(t: TableSet) -> DataFrame:
    """The same without FKs of a table into itself."""
    return _referencing(t, False)


@query("fk_type_mismatch")
def _fk_type_mismatch(t: TableSet) -> DataFrame:
    return G.fk_type_mismatch(_meta(t))


@query("fk_cycles")
def _fk_cycles(t: TableSet) -> DataFrame:
    """One row per component of the foreign-key graph with a witness path."""
    found = GR.fk_cycles(G.fk_edges(FX.derived_catalog(t)))
    return found.withColumn("path", F.array_join("path", " -> "))


@query("fk_cycle_components")
def _fk_cycle_components(t: TableSet) -> DataFrame:
    """Every table on a cycle and its component."""
    return GR.cycle_components(G.fk_edges(FX.derived_catalog(t)), "parent_table", "referenced_table")


@query("graph_cycle_witnesses")
def _graph_cycle_witnesses(t: TableSet) -> DataFrame:
    """G8 on a graph whose nodes have several out-edges."""
    return GR.fk_cycles(FX.customer_graph(t), "src", "dst").select("component", "n_nodes", "cycle_len")


@query("graph_cycle_nodes")
def _graph_cycle_nodes(t: TableSet) -> DataFrame:
    """G8 on edges_big (one out-edge per customer): nodes on a cycle."""
    return GR.cycle_nodes(FX.edges_big(t))


# -- A/L: layer readers and the suite ---------------------------------------------

def _layers(t: TableSet):
    """Two layers of a small lake in the shared folder, written from the given tables: silver as they are, gold
    with the injected defects. The table ``ghost`` is in neither."""
    import uuid

    from paritas.session import ensure_checkpoint_dir
    from paritas.sources.layers import LayerLocator
    root = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/{uuid.uuid4().hex}"
    loc = LayerLocator(root=root)
    for table, pair in (("orders", orders_pair(t, doubled=False)), ("customer", customer_pair(t))):
        pair.source.write.parquet(loc.layer("silver", table, "tpch"))
        pair.target.write.parquet(loc.layer("gold", table, "tpch"))
    return loc


@query("layer_pair_parity")
def _layer_pair_parity(t: TableSet) -> DataFrame:
    """The silver→gold hop of a lake whose two layers differ."""
    from paritas.sources.layers import load_pair
    return PR.row_count_parity(load_pair(t.spark, "silver_to_gold", _layers(t), "orders", "tpch"))


@query("scope_results")
def _scope_results(t: TableSet) -> DataFrame:
    """L1, L3: two hops of the lake over a scope with a table that does not exist, run twice: the second run
    finds the finished tables and tries the failed ones again."""
    from paritas.plans.suite import run_scope
    loc = _layers(t)
    keys = {"orders": ("o_orderkey",), "customer": ("c_custkey",)}
    args = dict(scope={"tpch": ["orders", "customer", "ghost"], "other": ["orders"]}, pairings=["silver_to_gold"], path=f"{loc.root}/results", keys=keys,
                checks=["row_counts", "null_count_per_column", "keyed_row_differences"], databases=["tpch"])
    run_scope(t.spark, loc, **args)
    found = run_scope(t.spark, loc, **args)
    return found.select("pairing", "database_name", "table_name", "check", "column_name", "metric", "source_value", "target_value", "passed", "status")


def _suite_pairs(t: TableSet) -> list[TablePair]:
    """Orders with its catalog rows on both sides, customer with keys, lineitem without."""
    from dataclasses import replace

    from paritas.sources.catalog import CatalogTables
    orders = replace(orders_pair(t), database_name="tpch")
    own = G.table_metadata(G.column_metadata(FX.table_catalog(t)), "orders")
    other = CatalogTables.from_frames(t.spark, {"orders": orders.target}, {"orders": FX.PRIMARY_KEYS["orders"]}, not_null={"orders": ["o_custkey"]}, database_name="tpch_new")
    return [orders.with_metadata(own, G.column_metadata(other)), replace(customer_pair(t), database_name="tpch"),
            TablePair(t.lineitem, FX.lineitem_child(t), keys=(), database_name="tpch", table_name="lineitem")]


@query("suite_results")
def _suite_results(t: TableSet) -> DataFrame:
    """Every registered check on three pairs, one result table."""
    from paritas.plans.suite import run_suite
    return run_suite(t.spark, _suite_pairs(t))


@query("suite_summary")
def _suite_summary(t: TableSet) -> DataFrame:
    """L4: pass/fail roll-up per table of a results frame."""
    from paritas.plans.suite import summarise
    return summarise(QUERIES["suite_results"](t.spark, t.base_dir))


@query("schema_profile")
def _schema_profile(t: TableSet) -> DataFrame:
    """Types, declared nullability and, from the profile pass over the data, rows and NULLs of both sides."""
    return P.schema_profile(orders_pair(t, custkey_type="int"))


@query("orphan_records")
def _orphan_records(t: TableSet) -> DataFrame:
    """DM7/H5 record form for lineitem_child → orders_parent; the value map rendered as JSON."""
    fk = C.ForeignKey("fk_lineitem_orders", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",))
    r = C.orphan_records(FX.lineitem_child(t), FX.orders_parent(t), fk)
    return r.select("child_table", "foreign_key_name", F.array_join("foreign_key_columns", ",").alias("foreign_key_columns"),
                    F.to_json("orphaned_values").alias("orphaned_values"), "orphaned_count")


@query("declared_constraints")
def _declared_constraints(t: TableSet) -> DataFrame:
    """H1-H5/H7-H9 driven by catalog metadata: every declared key, not-null column and FK of the given tables."""
    from paritas.plans.constraint_suite import run_constraints
    frames = FX.table_frames(t)
    return run_constraints(t.spark, FX.table_catalog(t, frames), frames, samples=0)


@query("declared_constraint_samples")
def _declared_constraint_samples(t: TableSet) -> DataFrame:
    """H1, H3, H4, H7: the duplicated and missing keys that the constraint run reports, on orders with defects."""
    from paritas.plans.constraint_suite import run_constraints
    found = run_constraints(t.spark, *FX.two_schemas(t))
    return found.filter(F.col("metric").endswith("_sample")).select("table_name", "check", "column_name", "source_value", "target_value", "detail")


@query("two_schema_constraints")
def _two_schema_constraints(t: TableSet) -> DataFrame:
    """H1-H5, H7-H9 in a catalog with equal table and constraint names in two schemas, a target that is
    not in the catalog and a table without a frame."""
    from paritas.plans.constraint_suite import run_constraints
    found = run_constraints(t.spark, *FX.two_schemas(t), samples=0)
    return found.select("table_name", "check", "column_name", "metric", "source_value", "target_value", "passed", "status", "detail")


@query("catalog_constraint_rows")
def _catalog_constraint_rows(t: TableSet) -> DataFrame:
    """G8 and G9 as result rows of the constraint run."""
    from paritas.plans.constraint_suite import catalog_rows
    return catalog_rows(FX.derived_catalog(t)).groupBy("check", "metric", "passed").agg(F.count("*").alias("n"), F.max(F.when(F.col("metric") == "total", F.col("source_value"))).alias("total"))
