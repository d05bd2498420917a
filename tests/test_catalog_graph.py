"""Catalog operators on a hand-made star-schema catalog (FIXTURES.md §3), and cycle
detection against brute force on random graphs."""

import dataclasses
import random
from collections import Counter

import pytest

from conftest import rows
from paritas.operators import catalog as G
from paritas.operators import graph as GR
from paritas.sources.catalog import CatalogTables

# object ids: 1 region, 2 nation, 3 customer, 4 orders, 5 lineitem, 6 staff (self-ref),
# 7/8/9 a three-table cycle, 10 a self-loop table, 11 X_DO_NOT_USE
TABLES = [(1, "region", 1), (2, "nation", 1), (3, "customer", 1), (4, "orders", 1), (5, "lineitem", 1), (6, "staff", 1),
          (7, "cyc_a", 1), (8, "cyc_b", 1), (9, "cyc_c", 1), (10, "loop", 1), (11, "X_DO_NOT_USE", 1), (12, "other_schema", 2)]
SCHEMAS = [("dbo", 1), ("stage", 2)]
TYPES = [(1, "int"), (2, "bigint"), (3, "varchar"), (4, "decimal")]


def _columns(drift: bool):
    c = [
        (1, 1, "r_regionkey", 1, 4, 10, 0, False, False, 0), (1, 2, "r_name", 3, 25, 0, 0, True, False, 0),
        (2, 1, "n_nationkey", 1, 4, 10, 0, False, False, 0), (2, 2, "n_regionkey", 1, 4, 10, 0, False, False, 0),
        (3, 1, "c_custkey", 2, 8, 19, 0, False, True, 0), (3, 2, "c_nationkey", 2, 8, 19, 0, True, False, 0),
        (3, 3, "c_name", 3, 25, 0, 0, True, False, 0),
        (4, 1, "o_orderkey", 2, 8, 19, 0, False, False, 0), (4, 2, "o_custkey", 2, 8, 19, 0, True, False, 0),
        (4, 3, "o_total", 4, 9, 12, 2, True, False, 0), (4, 4, "o_total_x2", 4, 9, 12, 2, True, False, 0),
        (5, 1, "l_orderkey", 2, 8, 19, 0, False, False, 0), (5, 2, "l_linenumber", 1, 4, 10, 0, False, False, 0),
        (5, 3, "l_orderkey2", 2, 8, 19, 0, True, False, 0),
        (6, 1, "id", 1, 4, 10, 0, False, False, 0), (6, 2, "boss", 1, 4, 10, 0, True, False, 0),
        (7, 1, "a_id", 1, 4, 10, 0, False, False, 0), (7, 2, "a_b", 1, 4, 10, 0, True, False, 0),
        (8, 1, "b_id", 1, 4, 10, 0, False, False, 0), (8, 2, "b_c", 1, 4, 10, 0, True, False, 0),
        (9, 1, "c_id", 1, 4, 10, 0, False, False, 0), (9, 2, "c_a", 1, 4, 10, 0, True, False, 0),
        (10, 1, "l_id", 1, 4, 10, 0, False, False, 0), (10, 2, "l_parent", 1, 4, 10, 0, True, False, 0),
        (11, 1, "junk", 1, 4, 10, 0, True, False, 0), (12, 1, "o_id", 1, 4, 10, 0, True, False, 0),
    ]
    if drift:  # drop r_name, add r_comment, change a type, a length and a nullability
        c = [x for x in c if x[2] != "r_name"] + [(1, 3, "r_comment", 3, 100, 0, 0, True, False, 0)]
        c = [(o, i, n, 1 if n == "c_nationkey" else t, 50 if n == "c_name" else ml, p, s,
              False if n == "o_custkey" else nl, idn, d) for (o, i, n, t, ml, p, s, nl, idn, d) in c]
    return c


# (constraint id, name, parent=child table, referenced table) and column pairs
FKS = [(100, "fk_nation_region", 2, 1), (101, "fk_customer_nation", 3, 2), (102, "fk_orders_customer", 4, 3),
       (103, "fk_lineitem_orders", 5, 4), (104, "fk_lineitem_orders2", 5, 4), (105, "fk_staff_boss", 6, 6),
       (106, "fk_ab", 7, 8), (107, "fk_bc", 8, 9), (108, "fk_ca", 9, 7), (109, "fk_loop", 10, 10)]
FK_COLUMNS = [(100, 1, 2, 2, 1, 1), (101, 1, 3, 2, 2, 1), (102, 1, 4, 2, 3, 1), (103, 1, 5, 1, 4, 1), (104, 1, 5, 3, 4, 1),
              (105, 1, 6, 2, 6, 1), (106, 1, 7, 2, 8, 1), (107, 1, 8, 2, 9, 1), (108, 1, 9, 2, 7, 1), (109, 1, 10, 2, 10, 1)]
# composite PK on lineitem, composite unique on orders, o_custkey in two indexes
INDEXES = [(1, 1, True, False), (2, 1, True, False), (3, 1, True, False), (4, 1, True, False), (5, 1, True, False),
           (4, 2, False, True), (4, 3, False, False)]
INDEX_COLUMNS = [(1, 1, 1, 1), (2, 1, 1, 1), (3, 1, 1, 1), (4, 1, 1, 1), (5, 1, 1, 1), (5, 1, 2, 2),
                 (4, 2, 2, 1), (4, 2, 3, 2), (4, 3, 2, 1)]


def catalog(spark, drift=False, name="db_a"):
    mk = spark.createDataFrame
    return CatalogTables(
        tables=mk(TABLES, "object_id int, name string, schema_id int"),
        schemas=mk(SCHEMAS, "name string, schema_id int"),
        columns=mk(_columns(drift), "object_id int, column_id int, name string, user_type_id int, max_length int, precision int, "
                                    "scale int, is_nullable boolean, is_identity boolean, default_object_id int"),
        types=mk(TYPES, "user_type_id int, name string"),
        computed_columns=mk([(4, 4, "([o_total]*(2))")], "object_id int, column_id int, definition string"),
        index_columns=mk(INDEX_COLUMNS, "object_id int, index_id int, column_id int, key_ordinal int"),
        indexes=mk(INDEXES, "object_id int, index_id int, is_primary_key boolean, is_unique_constraint boolean"),
        foreign_key_columns=mk(FK_COLUMNS, "constraint_object_id int, constraint_column_id int, parent_object_id int, "
                                           "parent_column_id int, referenced_object_id int, referenced_column_id int"),
        foreign_keys=mk([(i, n, p, r) for i, n, p, r in FKS], "object_id int, name string, parent_object_id int, referenced_object_id int"),
        database_name=name)


@pytest.fixture(scope="module")
def meta(spark):
    return G.column_metadata(catalog(spark)).cache()


def test_metadata_one_row_per_column_and_flags(meta):
    m = {(r.table_name, r.column_name): r for r in meta.collect()}
    assert len(m) == meta.count() == 25  # X_DO_NOT_USE excluded, no row multiplied
    assert ("X_DO_NOT_USE", "junk") not in m
    oc = m[("orders", "o_custkey")]
    assert oc.is_unique_constraint and not oc.is_primary_key  # in two indexes, still one row
    assert [f.foreign_key_name for f in m[("lineitem", "l_orderkey")].foreign_keys] == ["fk_lineitem_orders"]
    assert m[("lineitem", "l_linenumber")].is_primary_key and m[("orders", "o_total_x2")].definition == "([o_total]*(2))"
    assert m[("staff", "boss")].foreign_keys[0].referenced_column_name == "id"
    assert m[("customer", "c_custkey")].data_type == "bigint" and m[("customer", "c_custkey")].is_identity


def test_table_lookup_and_errors(meta):
    assert G.table_metadata(meta, "orders").count() == 4
    assert G.table_metadata(meta, "other_schema", "stage").count() == 1
    with pytest.raises(ValueError):
        G.require_table(meta, "no_such_table")
    nested = G.nested_table_metadata(G.table_metadata(meta, "orders")).first()
    assert [c.column_name for c in nested.columns] == ["o_orderkey", "o_custkey", "o_total", "o_total_x2"]


def test_g4_lists(meta):
    assert ("dbo", "X_DO_NOT_USE") not in rows(G.table_list(meta))
    assert rows(G.pk_columns(meta).filter("table_name = 'lineitem'"), "column_name") == [("l_linenumber",), ("l_orderkey",)]
    assert G.fk_columns(meta).count() == 10


def test_metadata_cache_evict_and_refresh(spark):
    loads = []

    def loader(db):
        loads.append(db)
        return catalog(spark, drift=(db == "db_b"), name=db)

    cache = G.MetadataCache(loader)
    assert cache.table("db_a", "region").count() == 2
    assert cache.table("db_a", "nation").count() == 2 and loads == ["db_a"]
    assert ("db_a", "dbo") in cache
    cache.evict("db_a")
    assert ("db_a", "dbo") not in cache
    cache.refresh("db_b")
    assert loads == ["db_a", "db_b"]


def test_compare_schemas(spark, meta):
    b = G.column_metadata(catalog(spark, drift=True, name="db_b"))
    got = rows(G.compare_schemas(meta, b), "table_name", "column_name", "attribute", "source_value", "target_value")
    assert got == sorted([("region", "r_name", "presence", "source_only", None), ("region", "r_comment", "presence", None, "target_only"),
                          ("customer", "c_nationkey", "data_type", "bigint", "int"), ("customer", "c_name", "max_length", "25", "50"),
                          ("orders", "o_custkey", "is_nullable", "true", "false")], key=repr)
    summary = {r.table_name: r for r in G.compare_schemas_summary(meta, b).collect()}
    assert not summary["region"].is_schema_match and summary["region"].source_only_columns == 1
    assert summary["nation"].is_schema_match and summary["customer"].differing_columns == 2


def test_referencing_tables_with_and_without_self(spark):
    cat = catalog(spark)
    r = rows(G.referencing_tables(cat, "orders"), "child_table_name", "foreign_key_name", "constrained_columns", "referred_columns")
    assert r == [("lineitem", "fk_lineitem_orders", ["l_orderkey"], ["o_orderkey"]),
                 ("lineitem", "fk_lineitem_orders2", ["l_orderkey2"], ["o_orderkey"])]
    assert G.referencing_tables(cat, "staff").count() == 1
    assert G.referencing_tables(cat, "staff", include_self=False).count() == 0


def test_fk_type_mismatch(meta):
    got = rows(G.fk_type_mismatch(meta), "table_name", "column_name", "attribute", "child_value", "parent_value")
    # only customer.c_nationkey (bigint, 8, 19) → nation.n_nationkey (int, 4, 10) differs; scale is 0 on both
    assert got == sorted([("customer", "c_nationkey", "data_type", "bigint", "int"), ("customer", "c_nationkey", "max_length", "8", "4"),
                          ("customer", "c_nationkey", "precision", "19", "10")], key=repr)


def test_fk_type_mismatch_found(spark):
    b = G.column_metadata(catalog(spark, drift=True, name="db_b"))
    got = rows(G.fk_type_mismatch(b), "table_name", "column_name", "attribute", "child_value", "parent_value")
    assert ("orders", "o_custkey", "data_type", "bigint", "bigint") not in got
    assert ("customer", "c_nationkey", "data_type", "int", "int") not in got
    assert ("customer", "c_nationkey", "max_length", "8", "4") in got


def test_fk_cycles_on_catalog(spark):
    cyc = {r.component: (r.n_nodes, r.cycle_len, r.path) for r in GR.fk_cycles(G.fk_edges(catalog(spark))).collect()}
    assert cyc == {"dbo.cyc_a": (3, 3, ["dbo.cyc_a", "dbo.cyc_b", "dbo.cyc_c", "dbo.cyc_a"]),
                   "dbo.loop": (1, 1, ["dbo.loop", "dbo.loop"]), "dbo.staff": (1, 1, ["dbo.staff", "dbo.staff"])}


def test_equal_table_names_in_two_schemas_make_no_cycle(spark):
    cat = catalog(spark)
    tables = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "a", 2)], "object_id int, name string, schema_id int")
    keys = spark.createDataFrame([(10, "k1", 1, 2), (11, "k2", 2, 3)], "object_id int, name string, parent_object_id int, referenced_object_id int")
    cat = dataclasses.replace(cat, tables=tables, foreign_keys=keys)
    assert GR.fk_cycles(G.fk_edges(cat)).collect() == []
    assert [r.path for r in GR.fk_cycles(G.fk_edges(cat, qualified=False)).collect()] == [["a", "b", "a"]]


def _reach(edges):
    adj = {}
    for s, d in edges:
        adj.setdefault(s, set()).add(d)
    out = {}
    for v in {x for e in edges for x in e}:
        seen, todo = set(), list(adj.get(v, ()))
        while todo:
            u = todo.pop()
            if u not in seen:
                seen.add(u)
                todo += adj.get(u, ())
        out[v] = seen
    return adj, out


def _brute_components(edges):
    """node -> least node of its component, for the nodes on cycles."""
    _, reach = _reach(edges)
    return {v: min(u for u in reach[v] if v in reach[u]) for v in reach if v in reach[v]}


def _shortest(edges, root):
    adj, _ = _reach(edges)
    seen, frontier, depth = set(), {root}, 0
    while True:
        depth += 1
        frontier = {w for u in frontier for w in adj.get(u, ())} - seen
        if root in frontier:
            return depth
        seen |= frontier


def _holds(spark, edges):
    df = spark.createDataFrame(sorted(edges), "src long, dst long")
    member = _brute_components(edges)
    assert {r.node: r.component for r in GR.cycle_components(df).collect()} == member
    assert {r.node for r in GR.cycle_nodes(df).collect()} == set(member)
    found = GR.fk_cycles(df, "src", "dst").collect()
    assert {r.component: r.n_nodes for r in found} == dict(Counter(member.values()))
    for r in found:
        assert r.path[0] == r.path[-1] == r.component and len(set(r.path)) == r.cycle_len == len(r.path) - 1
        assert set(zip(r.path, r.path[1:])) <= edges and r.cycle_len == _shortest(edges, r.component)


@pytest.mark.parametrize("seed", [3, 7])
def test_cycles_random_graph_vs_brute_force(spark, seed):
    rnd = random.Random(seed)
    n = 40
    _holds(spark, {(rnd.randrange(n), rnd.randrange(n)) for _ in range(55)})


@pytest.mark.parametrize("n", [50, 97])
def test_cycles_functional_graph_vs_brute_force(spark, n):
    _holds(spark, {(k, (k * k + 1) % n) for k in range(n)})


def test_rings_of_several_lengths(spark):
    perm = {0: 0, 1: 2, 2: 1, 3: 4, 4: 5, 5: 3, 6: 7, 7: 8, 8: 9, 9: 10, 10: 11, 11: 12, 12: 6}
    _holds(spark, set(perm.items()))


def test_no_edges_and_null_ends(spark):
    df = spark.createDataFrame([(1, None), (None, 2)], "src long, dst long")
    assert GR.fk_cycles(df, "src", "dst").collect() == [] == GR.cycle_components(df).collect()


def _rounds(spark, monkeypatch, edges):
    cuts = []
    real = GR._cut
    monkeypatch.setattr(GR, "_cut", lambda df: cuts.append(1) or real(df))
    found = {r.component: r.path for r in GR.fk_cycles(spark.createDataFrame(sorted(edges), "src long, dst long"), "src", "dst").collect()}
    return found, len(cuts)


def test_long_chain_takes_tens_of_rounds(spark, monkeypatch):
    found, cuts = _rounds(spark, monkeypatch, {(k, k + 1) for k in range(10_000)})
    assert found == {} and cuts < 40


def test_long_chains_at_a_branching_cycle_take_tens_of_rounds(spark, monkeypatch):
    cycle = {(0, 1), (1, 2), (2, 0), (1, 0)}
    way_in = {(k, k + 1) for k in range(-3000, 0)}
    way_out = {(2, 10)} | {(k, k + 1) for k in range(10, 3000)} | {(k, -k - 100_000) for k in range(10, 3000, 7)}
    found, cuts = _rounds(spark, monkeypatch, cycle | way_in | way_out)
    assert found == {0: [0, 1, 0]} and cuts < 120


def test_cycle_search_broadcasts_no_side_of_its_joins(spark, monkeypatch):
    """Sides grow with the graph; each one below the broadcast threshold would pass through the driver."""
    plans = []

    def kept(cut):
        def run(df):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return cut(df)
        return run

    monkeypatch.setattr(GR, "_cut", kept(GR._cut))
    monkeypatch.setattr(GR, "_table", kept(GR._table))
    # two linked components with chords, a ring of three, a self-loop, a tail
    edges = [(1, 2), (2, 3), (3, 1), (2, 1), (3, 4), (4, 5), (5, 6), (6, 4), (5, 4), (7, 8), (8, 9), (9, 7), (10, 10), (11, 1)]
    found = GR.fk_cycles(spark.createDataFrame(edges, "src long, dst long"), "src", "dst")
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert {(r["component"], r["n_nodes"], r["cycle_len"]) for r in found.collect()} == {(1, 3, 2), (4, 3, 2), (7, 3, 3), (10, 1, 1)}
    assert any("SortMergeJoin" in p for p in plans)
    assert not [p for p in plans if "BroadcastHashJoin" in p or "BroadcastNestedLoopJoin" in p]


def _ring(nodes):
    return list(zip(nodes, [*nodes[1:], nodes[0]]))


def _positions(edges):
    """(node, component, position) of each node of rings without a common node."""
    ahead, found = dict(edges), set()
    for least in sorted(ahead):
        node, position = least, 0
        while node not in {n for n, _, _ in found}:
            found.add((node, least, position))
            node, position = ahead[node], position + 1
    return found


def test_rounds_of_rings_follow_the_longest_ring(spark, monkeypatch):
    rings = [_ring([10 * k + x for x in (3, 1, 4, 0, 2)[: 2 + k % 4]]) for k in range(200)]
    edges, rounds = [e for r in rings for e in r], []
    for name in ("_cut", "_table"):
        monkeypatch.setattr(GR, name, lambda df, real=getattr(GR, name): rounds.append(1) or real(df))
    found = GR._rings(spark.createDataFrame(edges, "src long, dst long"))
    assert {tuple(r) for r in found.collect()} == _positions(edges) and len(rounds) <= 9


def test_estimates_of_doubling_rounds_do_not_double(spark, monkeypatch):
    """The driver holds the optimizer's estimate of a state's size, whose digits must not double with each round."""
    bits = []

    def kept(cut):
        def run(df):
            out = cut(df)
            bits.append(out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length())
            return out
        return run

    monkeypatch.setattr(GR, "_cut", kept(GR._cut))
    monkeypatch.setattr(GR, "_table", kept(GR._table))
    edges = _ring([(k * 37) % 101 for k in range(101)])
    ring = spark.createDataFrame(edges, "src long, dst long")
    assert {tuple(r) for r in GR._rings(ring).collect()} == _positions(edges)
    assert GR._ring_edges(ring.unionByName(spark.createDataFrame([(200, 3), (201, 200)], "src long, dst long"))).count() == 101
    assert {r["end"] for r in GR._jump_ends(spark.createDataFrame([(k, k + 1) for k in range(60)], "node long, jump long")).collect()} == {60}
    chords = spark.createDataFrame([(k, (k + 1) % 9, 0) for k in range(9)] + [(3, 1, 0)], "src long, dst long, component long")
    assert GR._searched(chords).count() == 9
    assert max(bits) < 1000, bits
