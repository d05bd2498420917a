"""Catalog operators (G1-G7, G9): column metadata, cached lookup, schema comparison,
referencing tables and FK type consistency, all as joins over ``CatalogTables``.

Index flags and foreign keys are aggregated per column *before* they are joined to the
columns, so a column in several indexes or FKs stays one row (FKs become an array).
Join strategies are left to Catalyst/AQE: the catalog views are small in practice, but
nothing here assumes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.sources.catalog import CatalogTables

FK_STRUCT = "array<struct<foreign_key_name:string,referenced_schema_name:string,referenced_table_name:string,referenced_column_name:string>>"
# The column attributes that a schema comparison compares.
COMPARED_ATTRIBUTES = ("data_type", "max_length", "precision", "scale", "is_nullable")


def _tables(cat: CatalogTables) -> DataFrame:
    """object_id, table_name, schema_name."""
    return (cat.tables.select(F.col("object_id"), F.col("name").alias("table_name"), "schema_id")
            .join(cat.schemas.select("schema_id", F.col("name").alias("schema_name")), "schema_id")
            .drop("schema_id"))


def _column_names(cat: CatalogTables) -> DataFrame:
    return cat.columns.select("object_id", "column_id", F.col("name").alias("column_name"))


def resolved_fk_columns(cat: CatalogTables) -> DataFrame:
    """One row per FK column pair with names resolved on both sides; a target that is not in the catalog
    leaves its names NULL (another database, no permission)."""
    tabs = _tables(cat)
    cols = _column_names(cat)
    fkc = cat.foreign_key_columns.join(
        cat.foreign_keys.select(F.col("object_id").alias("constraint_object_id"), F.col("name").alias("foreign_key_name")),
        "constraint_object_id")
    child = tabs.select(F.col("object_id").alias("parent_object_id"), F.col("table_name").alias("child_table_name"),
                        F.col("schema_name").alias("child_schema_name"))
    ref = tabs.select(F.col("object_id").alias("referenced_object_id"), F.col("table_name").alias("referenced_table_name"),
                      F.col("schema_name").alias("referenced_schema_name"))
    ccol = cols.select(F.col("object_id").alias("parent_object_id"), F.col("column_id").alias("parent_column_id"),
                       F.col("column_name").alias("child_column_name"))
    rcol = cols.select(F.col("object_id").alias("referenced_object_id"), F.col("column_id").alias("referenced_column_id"),
                       F.col("column_name").alias("referenced_column_name"))
    return (fkc.join(child, "parent_object_id").join(ref, "referenced_object_id", "left")
            .join(ccol, ["parent_object_id", "parent_column_id"]).join(rcol, ["referenced_object_id", "referenced_column_id"], "left"))


def column_metadata(cat: CatalogTables, schema_name: str | None = None, exclude_pattern: str | None = "DO_NOT") -> DataFrame:
    """One row per column of every table (B8: tables whose name contains ``exclude_pattern`` are dropped).

    Columns: database_name, schema_name, table_name, column_id, column_name, data_type, max_length,
    precision, scale, is_nullable, is_identity, default_object_id, definition, is_primary_key,
    is_unique_constraint, foreign_keys (array of {name, referenced schema/table/column}).
    """
    tabs = _tables(cat)
    if schema_name is not None:
        tabs = tabs.filter(F.col("schema_name") == schema_name)
    if exclude_pattern:
        tabs = tabs.filter(~F.col("table_name").contains(exclude_pattern))
    cols = cat.columns.select("object_id", "column_id", F.col("name").alias("column_name"), "user_type_id", "max_length",
                              "precision", "scale", "is_nullable", "is_identity", "default_object_id")
    types = cat.types.select("user_type_id", F.col("name").alias("data_type"))
    computed = cat.computed_columns.select("object_id", "column_id", "definition")
    flags = (cat.index_columns.select("object_id", "index_id", "column_id")
             .join(cat.indexes.select("object_id", "index_id", "is_primary_key", "is_unique_constraint"), ["object_id", "index_id"])
             .groupBy("object_id", "column_id")
             .agg(F.bool_or(F.coalesce("is_primary_key", F.lit(False))).alias("is_primary_key"),
                  F.bool_or(F.coalesce("is_unique_constraint", F.lit(False))).alias("is_unique_constraint")))
    fks = (resolved_fk_columns(cat)
           .groupBy(F.col("parent_object_id").alias("object_id"), F.col("parent_column_id").alias("column_id"))
           .agg(F.sort_array(F.collect_list(F.struct("foreign_key_name", "referenced_schema_name", "referenced_table_name",
                                                     "referenced_column_name"))).alias("foreign_keys")))
    meta = (tabs.join(cols, "object_id").join(types, "user_type_id")
            .join(computed, ["object_id", "column_id"], "left")
            .join(flags, ["object_id", "column_id"], "left")
            .join(fks, ["object_id", "column_id"], "left"))
    return meta.select(
        F.lit(cat.database_name).alias("database_name"), "schema_name", "table_name", "column_id", "column_name", "data_type",
        "max_length", "precision", "scale", "is_nullable", "is_identity", "default_object_id", "definition",
        F.coalesce("is_primary_key", F.lit(False)).alias("is_primary_key"),
        F.coalesce("is_unique_constraint", F.lit(False)).alias("is_unique_constraint"),
        F.coalesce("foreign_keys", F.array().cast(FK_STRUCT)).alias("foreign_keys"))


def table_metadata(meta: DataFrame, table_name: str, schema_name: str | None = "dbo") -> DataFrame:
    """G1: the metadata rows of one table (lazy; see ``require_table`` for the not-found error).
    ``schema_name=None`` matches the table name in any schema."""
    cond = F.col("table_name") == table_name
    if schema_name is not None:
        cond = cond & (F.col("schema_name") == schema_name)
    return meta.filter(cond)


def require_table(meta: DataFrame, table_name: str, schema_name: str | None = "dbo") -> DataFrame:
    """G1 at the API edge: raises ``ValueError`` when the table has no columns (a one-row probe)."""
    df = table_metadata(meta, table_name, schema_name)
    if df.isEmpty():
        raise ValueError(f"Table '{schema_name}.{table_name}' not found in the catalog")
    return df


def nested_table_metadata(meta: DataFrame) -> DataFrame:
    """DM6: one row per table with its columns as an array ordered by column id.

    The array holds one table's columns; SQL Server caps a table at 1,024 columns
    (30,000 for wide tables), which bounds each group."""
    col = F.struct("column_id", "column_name", "data_type", "max_length", "precision", "scale", "is_nullable", "is_identity",
                   "default_object_id", "definition", "is_primary_key", "is_unique_constraint", "foreign_keys")
    return (meta.groupBy("database_name", "schema_name", "table_name")
            .agg(F.sort_array(F.collect_list(col)).alias("columns")))


def table_list(meta: DataFrame) -> DataFrame:
    """Distinct (schema_name, table_name)."""
    return meta.select("schema_name", "table_name").distinct()


def pk_columns(meta: DataFrame) -> DataFrame:
    """Primary-key columns per table."""
    return meta.filter(F.col("is_primary_key")).select("schema_name", "table_name", "column_id", "column_name")


def fk_columns(meta: DataFrame) -> DataFrame:
    """FK columns per table, one row per (column, FK)."""
    return (meta.select("schema_name", "table_name", "column_id", "column_name", F.explode("foreign_keys").alias("fk"))
            .select("schema_name", "table_name", "column_id", "column_name", "fk.*"))


class MetadataCache:
    """Column metadata cached per (database, schema); evict one entry or all, refresh one.

    The cached frames are the metadata rows themselves (``cache()``), not collected Python objects, of every
    table: ``exclude_pattern`` (B8) applies to the listing of a database (G2), while one table is found
    whatever its name (G1). As a context manager the cache ends with its block: all entries are
    evicted, so a query that looks tables up leaves nothing behind.
    """

    def __init__(self, loader: Callable[[str], CatalogTables], exclude_pattern: str | None = "DO_NOT"):
        self._loader = loader
        self._exclude = exclude_pattern
        self._frames: dict[tuple[str, str | None], DataFrame] = {}

    def __enter__(self) -> "MetadataCache":
        return self

    def __exit__(self, *exc) -> None:
        self.evict()

    def _whole(self, database_name: str, schema_name: str | None) -> DataFrame:
        key = (database_name, schema_name)
        if key not in self._frames:
            self._frames[key] = column_metadata(self._loader(database_name), schema_name, None).cache()
        return self._frames[key]

    def database(self, database_name: str, schema_name: str | None = "dbo") -> DataFrame:
        found = self._whole(database_name, schema_name)
        return found.filter(~F.col("table_name").contains(self._exclude)) if self._exclude else found

    def table(self, database_name: str, table_name: str, schema_name: str | None = "dbo") -> DataFrame:
        return table_metadata(self._whole(database_name, schema_name), table_name, schema_name)

    def table_nested(self, database_name: str, table_name: str, schema_name: str | None = "dbo") -> DataFrame:
        return nested_table_metadata(self.table(database_name, table_name, schema_name))

    def evict(self, database_name: str | None = None, schema_name: str | None = None) -> None:
        for key in [k for k in self._frames if (database_name is None or k[0] == database_name)
                    and (schema_name is None or k[1] == schema_name)]:
            self._frames.pop(key).unpersist()

    def refresh(self, database_name: str, schema_name: str | None = "dbo") -> DataFrame:
        self.evict(database_name, schema_name)
        return self.database(database_name, schema_name)

    def __contains__(self, key: tuple[str, str]) -> bool:
        return key in self._frames


def compare_schemas(source_meta: DataFrame, target_meta: DataFrame) -> DataFrame:
    """Per (schema, table, column) difference between two databases' metadata.

    Rows: schema_name, table_name, column_name, attribute, source_value, target_value, where
    attribute is ``presence`` (column on one side only; value = side) or one of data_type,
    max_length, precision, scale, is_nullable (null-safe inequality).
    """
    key = ["schema_name", "table_name", "column_name"]
    s = source_meta.select(*key, *[F.col(a).alias(f"s_{a}") for a in COMPARED_ATTRIBUTES], F.lit(True).alias("_s"))
    t = target_meta.select(*key, *[F.col(a).alias(f"t_{a}") for a in COMPARED_ATTRIBUTES], F.lit(True).alias("_t"))
    j = s.join(t, key, "full_outer")

    def diff(attribute: str, sv: Column, tv: Column, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(attribute).alias("attribute"), sv.alias("source_value"), tv.alias("target_value")))

    both = F.col("_s").isNotNull() & F.col("_t").isNotNull()
    items = [diff("presence", F.when(F.col("_s").isNotNull(), F.lit("source_only")), F.when(F.col("_t").isNotNull(), F.lit("target_only")),
                  ~both)]
    for a in COMPARED_ATTRIBUTES:
        items.append(diff(a, F.col(f"s_{a}").cast("string"), F.col(f"t_{a}").cast("string"),
                          both & ~F.col(f"s_{a}").eqNullSafe(F.col(f"t_{a}"))))
    return j.select(*key, F.inline(F.filter(F.array(*items), lambda x: x.isNotNull())))


def compare_schemas_summary(source_meta: DataFrame, target_meta: DataFrame) -> DataFrame:
    """G5 summary per table: common, source-only, target-only column counts, columns with differences, match flag."""
    key = ["schema_name", "table_name", "column_name"]
    s = source_meta.select(*key, *[F.col(a).alias(f"s_{a}") for a in COMPARED_ATTRIBUTES], F.lit(True).alias("_s"))
    t = target_meta.select(*key, *[F.col(a).alias(f"t_{a}") for a in COMPARED_ATTRIBUTES], F.lit(True).alias("_t"))
    j = s.join(t, key, "full_outer")
    both = F.col("_s").isNotNull() & F.col("_t").isNotNull()
    differs = F.lit(False)
    for a in COMPARED_ATTRIBUTES:
        differs = differs | ~F.col(f"s_{a}").eqNullSafe(F.col(f"t_{a}"))
    out = j.groupBy("schema_name", "table_name").agg(
        F.count_if(both).alias("common_columns"),
        F.count_if(F.col("_t").isNull()).alias("source_only_columns"),
        F.count_if(F.col("_s").isNull()).alias("target_only_columns"),
        F.count_if(both & differs).alias("differing_columns"))
    return out.withColumn("is_schema_match", (F.col("source_only_columns") == 0) & (F.col("target_only_columns") == 0)
                          & (F.col("differing_columns") == 0))


def referencing_tables(cat: CatalogTables, table_name: str | None = None, schema_name: str | None = None,
                       include_self: bool = True) -> DataFrame:
    """Foreign keys pointing at a table (all tables when ``table_name`` is None), one row per FK:
    referenced schema/table, child schema/table, FK name, child and parent column lists in
    constraint-column order. ``include_self=False`` drops FKs of a table into itself. A key whose target is
    not in the catalog points at no listed table."""
    r = resolved_fk_columns(cat).filter(F.col("referenced_table_name").isNotNull())
    if table_name is not None:
        r = r.filter(F.col("referenced_table_name") == table_name)
    if schema_name is not None:
        r = r.filter(F.col("referenced_schema_name") == schema_name)
    if not include_self:
        r = r.filter(F.col("parent_object_id") != F.col("referenced_object_id"))
    g = r.groupBy("referenced_schema_name", "referenced_table_name", "child_schema_name", "child_table_name", "foreign_key_name").agg(
        F.sort_array(F.collect_list(F.struct("constraint_column_id", "child_column_name", "referenced_column_name"))).alias("_cols"))
    return g.select("referenced_schema_name", "referenced_table_name", "child_schema_name", "child_table_name", "foreign_key_name",
                    F.transform("_cols", lambda x: x["child_column_name"]).alias("constrained_columns"),
                    F.transform("_cols", lambda x: x["referenced_column_name"]).alias("referred_columns"))


def fk_type_mismatch(meta: DataFrame) -> DataFrame:
    """FK columns whose type differs from the referenced column's; max_length, precision
    and scale are compared only when both sides are non-NULL."""
    child = (meta.select("schema_name", "table_name", "column_name", "data_type", "max_length", "precision", "scale",
                         F.explode("foreign_keys").alias("fk"))
             .select("schema_name", "table_name", "column_name", "fk.foreign_key_name", "fk.referenced_schema_name",
                     "fk.referenced_table_name", "fk.referenced_column_name",
                     *[F.col(a).alias(f"c_{a}") for a in ("data_type", "max_length", "precision", "scale")]))
    parent = meta.select(F.col("schema_name").alias("referenced_schema_name"), F.col("table_name").alias("referenced_table_name"),
                         F.col("column_name").alias("referenced_column_name"),
                         *[F.col(a).alias(f"p_{a}") for a in ("data_type", "max_length", "precision", "scale")])
    j = child.join(parent, ["referenced_schema_name", "referenced_table_name", "referenced_column_name"])
    items = [F.when(~F.col("c_data_type").eqNullSafe(F.col("p_data_type")),
                    F.struct(F.lit("data_type").alias("attribute"), F.col("c_data_type").alias("child_value"),
                             F.col("p_data_type").alias("parent_value")))]
    for a in ("max_length", "precision", "scale"):
        c, p = F.col(f"c_{a}"), F.col(f"p_{a}")
        items.append(F.when(c.isNotNull() & p.isNotNull() & (c != p),
                            F.struct(F.lit(a).alias("attribute"), c.cast("string").alias("child_value"),
                                     p.cast("string").alias("parent_value"))))
    return j.select("schema_name", "table_name", "column_name", "foreign_key_name", "referenced_schema_name",
                    "referenced_table_name", "referenced_column_name",
                    F.inline(F.filter(F.array(*items), lambda x: x.isNotNull())))


def fk_edges(cat: CatalogTables, qualified: bool = True) -> DataFrame:
    """DM8: (parent_table, referenced_table) per foreign key, by schema.table; with ``qualified=False`` by
    table name alone, which takes tables of equal name in two schemas for one."""
    tabs = _tables(cat)
    name = F.concat_ws(".", "schema_name", "table_name") if qualified else F.col("table_name")
    t = tabs.select("object_id", name.alias("n"))
    fk = cat.foreign_keys.select("parent_object_id", "referenced_object_id")
    return (fk.join(t.select(F.col("object_id").alias("parent_object_id"), F.col("n").alias("parent_table")), "parent_object_id")
            .join(t.select(F.col("object_id").alias("referenced_object_id"), F.col("n").alias("referenced_table")), "referenced_object_id")
            .select("parent_table", "referenced_table"))


def key_constraints(cat: CatalogTables) -> DataFrame:
    """Primary-key and unique constraints as ordered column lists (M-12: the index id is kept, so a
    composite constraint is one row): schema_name, table_name, index_id, kind, columns."""
    tabs = _tables(cat)
    idx = cat.indexes.filter(F.col("is_primary_key") | F.col("is_unique_constraint")).select(
        "object_id", "index_id", F.when(F.col("is_primary_key"), F.lit("primary_key")).otherwise(F.lit("unique")).alias("kind"))
    cols = (cat.index_columns.select("object_id", "index_id", "column_id", "key_ordinal")
            .join(_column_names(cat), ["object_id", "column_id"]))
    g = (idx.join(cols, ["object_id", "index_id"]).groupBy("object_id", "index_id", "kind")
         .agg(F.sort_array(F.collect_list(F.struct("key_ordinal", "column_name"))).alias("_c")))
    return (g.join(tabs, "object_id")
            .select("schema_name", "table_name", "index_id", "kind", F.transform("_c", lambda x: x["column_name"]).alias("columns")))
