"""Injected-defect inputs derived from the given tables (FIXTURES.md §3).

Each is a deterministic expression over a whole base table, so its size grows with the
data; the oracle SQL states the same rules independently in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.sources.tables import TableSet


def orders_target(t: TableSet, doubled: bool = True, custkey_type: str | None = None) -> DataFrame:
    """Lost rows, changed values, new nulls, one column dropped, one added; doubled rows unless ``doubled=False``."""
    o = t.orders
    k = F.col("o_orderkey")
    custkey = F.when(k % 53 == 0, F.lit(None)).otherwise(F.col("o_custkey"))
    if custkey_type:
        custkey = custkey.cast(custkey_type)
    base = o.filter(k % 97 != 0).select(
        k,
        custkey.alias("o_custkey"),
        F.when(k % 89 == 0, F.col("o_totalprice") + 1000000).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.col("o_orderdate"),
        F.when(k % 83 == 0, F.concat(F.col("o_orderpriority"), F.lit("x"))).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.lit(1).cast("int").alias("load_id"),
    )
    if not doubled:
        return base
    return base.unionAll(base.filter(k % 101 == 0))


#: Fixed values of the drifted pair: keys by these moduli get another value in the named column.
DRIFT = {"price": 89, "huge": 83, "tiny": 79, "tenth": 73}
DRIFT_LOST = 97


def drifted_orders(t: TableSet) -> tuple[DataFrame, DataFrame]:
    """Orders and the same orders under other types of numbers: key bigint → decimal, price and tiny
    double → decimal, huge decimal of 22 digits and more → double, tenth float → double, day date →
    timestamp_ntz. Keys by ``DRIFT_LOST`` are lost, keys by ``DRIFT`` changed."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    tenth = (k % 10).cast("double") / 10
    source = t.orders.select(k.alias("k"), F.col("o_totalprice").cast("double").alias("price"), (c.cast("decimal(17,0)") * F.lit("1000000000000000000000").cast("decimal(22,0)")).cast("decimal(38,0)").alias("huge"),
                             (c / 1e7).alias("tiny"), tenth.cast("float").alias("tenth"), F.col("o_orderdate").cast("date").alias("day"))
    moved = {n: F.when(k % m == 0, 1).otherwise(0) for n, m in DRIFT.items()}
    target = t.orders.filter(k % DRIFT_LOST != 0).select(
        k.cast("decimal(20,0)").alias("k"), (F.col("o_totalprice").cast("decimal(20,4)") + moved["price"]).cast("decimal(22,4)").alias("price"), ((c + moved["huge"]) * 1e21).alias("huge"),
        (c.cast("decimal(20,10)") * F.lit("0.0000001").cast("decimal(8,7)") + moved["tiny"]).cast("decimal(38,17)").alias("tiny"), (tenth + moved["tenth"]).alias("tenth"),
        F.col("o_orderdate").cast("date").cast("timestamp_ntz").alias("day"))
    return source, target


def nested_orders(t: TableSet) -> tuple[DataFrame, DataFrame]:
    """Maps inside arrays of structs, whose entries stand in either order, and arrays whose texts would look
    alike without quotes; the target has other values."""
    k = F.col("o_orderkey")

    def side(modulus: int) -> DataFrame:
        a, b = (F.lit("a"), k % 7), (F.lit("b"), k % modulus)
        either = F.when(k % 2 == 0, F.create_map(*a, *b)).otherwise(F.create_map(*b, *a))
        p, q = (k % 3).cast("string"), (k % 5).cast("string")
        listed = F.when(k % 2 == 0, F.array(p, q)).otherwise(F.array(F.concat(p, F.lit(", "), q)))
        return t.orders.select(F.array(F.struct(either.alias("m"))).alias("nested"), listed.alias("listed"),
                               F.when(k % 11 != 0, F.struct(either.alias("m"), F.when(k % 4 != 0, k % 4).alias("r"))).alias("part"))

    return side(3), side(4)


def orders_parent(t: TableSet) -> DataFrame:
    return t.orders.filter(F.col("o_orderkey") % 10 != 0)


def lineitem_child(t: TableSet) -> DataFrame:
    l = t.lineitem
    return l.withColumn("l_orderkey", F.when(F.col("l_partkey") % 50 == 0, F.lit(None).cast("bigint")).otherwise(F.col("l_orderkey")))


def staff(t: TableSet) -> DataFrame:
    k = F.col("c_custkey")
    boss = (F.when(k % 7 == 0, F.lit(None).cast("bigint"))
            .when(k % 11 == 0, k + 1000000)
            .otherwise(k))
    return t.customer.select(k.alias("id"), F.col("c_name").alias("name"), boss.alias("boss"))


def events_bad(t: TableSet) -> DataFrame:
    e = F.col("event_id")
    value = (F.when(e % 71 == 0, F.lit(float("nan")))
             .when(e % 73 == 0, F.lit(None).cast("double"))
             .otherwise(F.col("value")))
    etype = F.when(e % 79 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type"))
    return t.events.withColumn("value", value).withColumn("event_type", etype)


def customer_other(t: TableSet) -> DataFrame:
    k = F.col("c_custkey")
    base = t.customer.filter(k % 13 != 0).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal",
        F.when(k % 17 == 0, F.concat(F.col("c_mktsegment"), F.lit("x"))).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return base.unionAll(base.filter(k % 19 == 0))


def edges_big(t: TableSet) -> DataFrame:
    """One out-edge per customer: ``dst = (k*k + 1) mod n`` with ``n`` a scalar subquery (row count)."""
    n = t.customer.agg(F.count(F.lit(1))).scalar()
    k = F.col("c_custkey")
    return t.customer.select(k.alias("src"), ((k * k + 1) % n).alias("dst"))


def customer_graph(t: TableSet) -> DataFrame:
    """Several out-edges per customer: inside its block of 31 customers by ``x*x + 1`` (all) and ``5x + 3``
    (every fourth), and on to the next block (every fifth): components of many sizes, cycles of many
    lengths, and ways between them that lie on no cycle."""
    k = F.col("c_custkey")
    block, x = F.floor(k / 31).cast("bigint") * 31, k % 31
    squares = t.customer.select(k.alias("src"), (block + (x * x + 1) % 31).alias("dst"))
    lines = t.customer.filter(k % 4 == 0).select(k.alias("src"), (block + (x * 5 + 3) % 31).alias("dst"))
    return squares.unionByName(lines).unionByName(t.customer.filter(k % 5 == 0).select(k.alias("src"), (k + 31).alias("dst")))


def non_nullable(df: DataFrame, *columns: str) -> DataFrame:
    """Same rows with the named columns declared NOT NULL (``coalesce`` with a typed default keeps values;
    the input holds no NULL there). Parquet reads are always nullable, so nullability drift needs this."""
    types = {f.name: f.dataType for f in df.schema.fields}
    defaults = {"string": F.lit(""), "boolean": F.lit(False)}
    out = df
    for c in columns:
        d = defaults.get(types[c].typeName(), F.lit(0)).cast(types[c])
        out = out.withColumn(c, F.coalesce(F.col(c), d))
    return out


def derived_catalog(t: TableSet, variant: str = "a") -> "CatalogTables":
    """Catalog views derived from the star schema, so catalog work grows with the data.

    nations → schemas; customers → tables (a negative balance marks the table ``_DO_NOT_USE``);
    orders → columns of their customer's table (type from the priority digit, length of the
    priority text, precision = order month, scale = day mod 4, nullable unless status F);
    priorities → types; status P orders → computed columns; per table a primary key on its
    lowest order and a unique constraint over its urgent orders; one foreign key per table,
    from its highest-order column into table ``(k*k + 1) mod n`` at that table's key column,
    and for MACHINERY customers a second one from the same column into the table itself.
    Variant ``b`` is the drifted database: orders with key mod 7 = 0 are renamed (one column
    dropped, one added), and type (mod 5), length (mod 3) and nullability (mod 11) change.
    """
    from paritas.sources.catalog import CatalogTables

    c, o = t.customer, t.orders
    k = F.col("o_orderkey")
    n = c.agg(F.count(F.lit(1))).scalar()
    schemas = t.nation.select(F.col("n_nationkey").alias("schema_id"), F.col("n_name").alias("name"))
    tables = c.select(F.col("c_custkey").alias("object_id"),
                      F.when(F.col("c_acctbal") < 0, F.concat(F.col("c_name"), F.lit("_DO_NOT_USE"))).otherwise(F.col("c_name")).alias("name"),
                      F.col("c_nationkey").alias("schema_id"))
    type_id = F.substring(F.col("o_orderpriority"), 1, 1).cast("int")
    types = o.select(type_id.alias("user_type_id"),
                     F.lower(F.regexp_replace(F.col("o_orderpriority"), "^[0-9]+-", "")).alias("name")).distinct()
    columns = o.select(F.col("o_custkey").alias("object_id"), k.alias("column_id"),
                       F.concat(F.lit("col_"), k.cast("string")).alias("name"), type_id.alias("user_type_id"),
                       F.length(F.col("o_orderpriority")).alias("max_length"), F.month(F.col("o_orderdate")).alias("precision"),
                       (F.dayofmonth(F.col("o_orderdate")) % 4).alias("scale"), (F.col("o_orderstatus") != "F").alias("is_nullable"),
                       F.lit(False).alias("is_identity"), F.lit(0).alias("default_object_id"))
    if variant == "b":
        kept = columns.filter(F.col("column_id") % 7 != 0)
        added = (columns.filter(F.col("column_id") % 7 == 0)
                 .withColumn("name", F.concat(F.col("name"), F.lit("_v2")))
                 .withColumn("column_id", F.col("column_id") + F.lit(1000000000000)))
        cid = F.col("column_id")
        columns = (kept.unionByName(added)
                   .withColumn("user_type_id", F.when(cid % 5 == 0, F.col("user_type_id") % 5 + 1).otherwise(F.col("user_type_id")))
                   .withColumn("max_length", F.when(cid % 3 == 0, F.col("max_length") + 1).otherwise(F.col("max_length")))
                   .withColumn("is_nullable", F.when(cid % 11 == 0, ~F.col("is_nullable")).otherwise(F.col("is_nullable"))))
    computed = o.filter(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").alias("object_id"), k.alias("column_id"),
        F.concat(F.lit("("), F.col("o_orderpriority"), F.lit(")")).alias("definition"))
    indexes = (c.select(F.col("c_custkey").alias("object_id"), F.lit(1).alias("index_id"), F.lit(True).alias("is_primary_key"),
                        F.lit(False).alias("is_unique_constraint"))
               .unionByName(c.select(F.col("c_custkey").alias("object_id"), F.lit(2).alias("index_id"),
                                     F.lit(False).alias("is_primary_key"), F.lit(True).alias("is_unique_constraint"))))
    bounds = o.groupBy("o_custkey").agg(F.min(k).alias("lo"), F.max(k).alias("hi"))
    index_columns = (bounds.select(F.col("o_custkey").alias("object_id"), F.lit(1).alias("index_id"), F.col("lo").alias("column_id"),
                                   F.lit(1).cast("bigint").alias("key_ordinal"))
                     .unionByName(o.filter(F.col("o_orderpriority") == "1-URGENT").select(
                         F.col("o_custkey").alias("object_id"), F.lit(2).alias("index_id"), k.alias("column_id"),
                         k.alias("key_ordinal"))))
    dst = ((F.col("c_custkey") * F.col("c_custkey") + 1) % n)
    outward = c.select((F.col("c_custkey") * 2).alias("object_id"), F.concat(F.lit("FK_"), F.col("c_name")).alias("name"),
                       F.col("c_custkey").alias("parent_object_id"), dst.alias("referenced_object_id"))
    selfref = c.filter(F.col("c_mktsegment") == "MACHINERY").select(
        (F.col("c_custkey") * 2 + 1).alias("object_id"), F.concat(F.lit("SELF_"), F.col("c_name")).alias("name"),
        F.col("c_custkey").alias("parent_object_id"), F.col("c_custkey").alias("referenced_object_id"))
    foreign_keys = outward.unionByName(selfref)
    fk_columns = (foreign_keys.select("object_id", "parent_object_id", "referenced_object_id")
                  .join(bounds.select(F.col("o_custkey").alias("parent_object_id"), F.col("hi").alias("parent_column_id")),
                        "parent_object_id")
                  .join(bounds.select(F.col("o_custkey").alias("referenced_object_id"), F.col("lo").alias("referenced_column_id")),
                        "referenced_object_id")
                  .select(F.col("object_id").alias("constraint_object_id"), F.lit(1).alias("constraint_column_id"),
                          "parent_object_id", "parent_column_id", "referenced_object_id",
                          "referenced_column_id"))
    return CatalogTables(tables=tables, schemas=schemas, columns=columns, types=types, computed_columns=computed,
                         index_columns=index_columns, indexes=indexes, foreign_key_columns=fk_columns,
                         foreign_keys=foreign_keys, database_name=f"db_{variant}")


# Declared keys of the given tables (FIXTURES.md §2). lineitem's natural key
# (l_orderkey, l_linenumber) repeats in the data, and part's names and (brand, size) repeat,
# so those declared constraints are violated on purpose.
PRIMARY_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"],
    "documents": ["doc_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"], "pages": ["page_id"],
    "benchmark": ["item_id"], "embeddings": ["vec_id"],
}
UNIQUE_KEYS = {"part": [["p_name"], ["p_brand", "p_size"]]}
FOREIGN_KEYS = [
    ("fk_lineitem_orders", "lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
    ("fk_lineitem_part", "lineitem", ["l_partkey"], "part", ["p_partkey"]),
    ("fk_lineitem_supplier", "lineitem", ["l_suppkey"], "supplier", ["s_suppkey"]),
    ("fk_orders_customer", "orders", ["o_custkey"], "customer", ["c_custkey"]),
    ("fk_customer_nation", "customer", ["c_nationkey"], "nation", ["n_nationkey"]),
    ("fk_supplier_nation", "supplier", ["s_nationkey"], "nation", ["n_nationkey"]),
    ("fk_nation_region", "nation", ["n_regionkey"], "region", ["r_regionkey"]),
    ("fk_labels_documents", "labels", ["doc_id"], "documents", ["doc_id"]),
    ("fk_events_customer", "events", ["user_id"], "customer", ["c_custkey"]),
]


def table_frames(t: TableSet) -> dict:
    from paritas.sources.tables import TABLES
    return {n: getattr(t, n) for n in TABLES}


def table_catalog(t: TableSet, frames: dict | None = None) -> "CatalogTables":
    """Catalog rows describing the given tables: columns and types from their schemas, keys as declared."""
    from paritas.sources.catalog import CatalogTables
    frames = frames or table_frames(t)
    not_null: dict[str, list[str]] = {}
    for _, child, cols, _, _ in FOREIGN_KEYS:
        not_null.setdefault(child, []).extend(cols)
    return CatalogTables.from_frames(t.spark, frames, PRIMARY_KEYS, FOREIGN_KEYS, UNIQUE_KEYS, not_null,
                                     database_name="tpch")


def two_schemas(t: TableSet) -> tuple["CatalogTables", dict[str, DataFrame]]:
    """``live`` holds customer and orders, ``stage`` tables of the same names with defects, keys of the same
    names, a key into a table that the catalog lacks, and one into ``stage.nation``, which has no frame."""
    from paritas.sources.catalog import CatalogTables

    k = F.col("o_orderkey")
    orders = t.orders.select("o_orderkey", "o_custkey")
    staged = orders.filter(k % 97 != 0).select(k, F.when(k % 53 == 0, F.lit(None)).when(k % 59 == 0, F.col("o_custkey") + 10000000).otherwise(F.col("o_custkey")).cast("decimal(20,0)").alias("o_custkey"))
    customer = t.customer.select("c_custkey", "c_nationkey")
    frames = {"live.customer": customer, "live.orders": orders, "stage.customer": customer.filter(F.col("c_custkey") % 31 != 0),
              "stage.orders": staged.unionAll(staged.filter(k % 101 == 0))}
    mk = t.spark.createDataFrame
    names = [(1, "customer", 1), (2, "orders", 1), (3, "customer", 2), (4, "orders", 2), (5, "nation", 2)]
    columns = [(1, 1, "c_custkey", False), (1, 2, "c_nationkey", False), (2, 1, "o_orderkey", False), (2, 2, "o_custkey", True), (3, 1, "c_custkey", False), (3, 2, "c_nationkey", True),
               (4, 1, "o_orderkey", False), (4, 2, "o_custkey", False), (5, 1, "n_nationkey", False)]
    indexes = [(i, 1, True, False) for i in (1, 2, 3, 4)] + [(4, 2, False, True)]
    index_columns = [(i, 1, 1, 1) for i in (1, 2, 3, 4)] + [(4, 2, 2, 1), (4, 2, 1, 2)]
    keys = [(11, "fk_customer", 2, 1), (12, "fk_customer", 4, 3), (13, "fk_nation", 3, 5), (14, "fk_gone", 4, 99)]
    key_columns = [(11, 1, 2, 2, 1, 1), (12, 1, 4, 2, 3, 1), (13, 1, 3, 2, 5, 1), (14, 1, 4, 1, 99, 1)]
    cat = CatalogTables(
        tables=mk(names, "object_id int, name string, schema_id int"), schemas=mk([("live", 1), ("stage", 2)], "name string, schema_id int"),
        columns=mk([(i, c, n, 1, None, None, None, null, False, 0) for i, c, n, null in columns],
                   "object_id int, column_id int, name string, user_type_id int, max_length int, precision int, scale int, is_nullable boolean, is_identity boolean, default_object_id int"),
        types=mk([(1, "bigint")], "user_type_id int, name string"), computed_columns=mk([], "object_id int, column_id int, definition string"),
        index_columns=mk(index_columns, "object_id int, index_id int, column_id int, key_ordinal int"),
        indexes=mk(indexes, "object_id int, index_id int, is_primary_key boolean, is_unique_constraint boolean"),
        foreign_key_columns=mk(key_columns, "constraint_object_id int, constraint_column_id int, parent_object_id int, parent_column_id int, referenced_object_id int, referenced_column_id int"),
        foreign_keys=mk(keys, "object_id int, name string, parent_object_id int, referenced_object_id int"), database_name="tpch")
    return cat, frames
