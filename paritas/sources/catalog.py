"""Catalog tables (DM4, A3): the nine ``sys.*`` views as DataFrames.

Any supplier works (JDBC against the database, parquet exports, or frames derived in
Spark); operators only need the columns listed in ``CATALOG_COLUMNS``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from paritas.sources.jdbc import JdbcSource

# Columns of the database's system views that the operators read.
CATALOG_COLUMNS: dict[str, tuple[str, ...]] = {
    "tables": ("object_id", "name", "schema_id"),
    "schemas": ("schema_id", "name"),
    "columns": ("object_id", "column_id", "name", "user_type_id", "max_length", "precision", "scale",
                "is_nullable", "is_identity", "default_object_id"),
    "types": ("user_type_id", "name"),
    "computed_columns": ("object_id", "column_id", "definition"),
    "index_columns": ("object_id", "index_id", "column_id", "key_ordinal"),
    "indexes": ("object_id", "index_id", "is_primary_key", "is_unique_constraint"),
    "foreign_key_columns": ("constraint_object_id", "constraint_column_id", "parent_object_id", "parent_column_id",
                            "referenced_object_id", "referenced_column_id"),
    "foreign_keys": ("object_id", "name", "parent_object_id", "referenced_object_id"),
}


@dataclass(frozen=True)
class CatalogTables:
    tables: DataFrame
    schemas: DataFrame
    columns: DataFrame
    types: DataFrame
    computed_columns: DataFrame
    index_columns: DataFrame
    indexes: DataFrame
    foreign_key_columns: DataFrame
    foreign_keys: DataFrame
    database_name: str = ""

    def __post_init__(self):
        for f in fields(self):
            if f.name == "database_name":
                continue
            df = getattr(self, f.name)
            missing = [c for c in CATALOG_COLUMNS[f.name] if c not in df.columns]
            if missing:
                raise ValueError(f"catalog table {f.name} lacks columns {missing}")

    @classmethod
    def from_jdbc(cls, spark: SparkSession, source: JdbcSource, database_name: str) -> "CatalogTables":
        """Read the nine catalog views through JDBC, projected to the columns the operators use."""
        frames = {name: source.table(spark, f"sys.{name}").select(*cols) for name, cols in CATALOG_COLUMNS.items()}
        return cls(**frames, database_name=database_name)

    @classmethod
    def from_parquet(cls, spark: SparkSession, base_dir: str, database_name: str) -> "CatalogTables":
        """Catalog exported as ``{base_dir}/{view}`` parquet datasets."""
        frames = {name: spark.read.parquet(f"{base_dir.rstrip('/')}/{name}").select(*cols) for name, cols in CATALOG_COLUMNS.items()}
        return cls(**frames, database_name=database_name)

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame], primary_keys: Mapping[str, Sequence[str]],
                    foreign_keys: Sequence[tuple[str, str, Sequence[str], str, Sequence[str]]] = (),
                    unique_keys: Mapping[str, Sequence[Sequence[str]]] | None = None, not_null: Mapping[str, Sequence[str]] | None = None,
                    database_name: str = "", schema_name: str = "dbo") -> "CatalogTables":
        """Catalog views describing DataFrames (a parquet-only layer has no database catalog).

        Columns and types come from each frame's schema; keys are declared: ``primary_keys``
        {table: columns}, ``unique_keys`` {table: [columns, ...]}, ``foreign_keys`` [(name, child,
        child_columns, parent, parent_columns)], ``not_null`` {table: columns} (PK columns are not
        null as well). Only schema facts enter these rows, never data.
        """
        unique_keys = unique_keys or {}
        not_null = not_null or {}
        names = list(frames)
        tid = {n: i + 1 for i, n in enumerate(names)}
        type_names = sorted({f.dataType.simpleString() for df in frames.values() for f in df.schema.fields})
        type_id = {t: i + 1 for i, t in enumerate(type_names)}
        cid, col_rows = {}, []
        for n in names:
            required = set(primary_keys.get(n, ())) | set(not_null.get(n, ()))
            for j, f in enumerate(frames[n].schema.fields, start=1):
                cid[(n, f.name)] = j
                dt = f.dataType
                precision = dt.precision if isinstance(dt, T.DecimalType) else None
                scale = dt.scale if isinstance(dt, T.DecimalType) else None
                col_rows.append((tid[n], j, f.name, type_id[dt.simpleString()], None, precision, scale,
                                 f.name not in required, False, 0))
        idx_rows, ic_rows = [], []
        for n in names:
            keys = ([(primary_keys[n], True)] if n in primary_keys else []) + [(u, False) for u in unique_keys.get(n, ())]
            for k, (cols, is_pk) in enumerate(keys, start=1):
                idx_rows.append((tid[n], k, is_pk, not is_pk))
                ic_rows += [(tid[n], k, cid[(n, c)], o) for o, c in enumerate(cols, start=1)]
        fk_rows, fkc_rows = [], []
        for k, (name, child, ccols, parent, pcols) in enumerate(foreign_keys, start=1):
            fk_rows.append((k, name, tid[child], tid[parent]))
            fkc_rows += [(k, o, tid[child], cid[(child, c)], tid[parent], cid[(parent, p)])
                         for o, (c, p) in enumerate(zip(ccols, pcols), start=1)]
        mk = spark.createDataFrame
        return cls(
            tables=mk([(tid[n], n, 1) for n in names], "object_id int, name string, schema_id int"),
            schemas=mk([(schema_name, 1)], "name string, schema_id int"),
            columns=mk(col_rows, "object_id int, column_id int, name string, user_type_id int, max_length int, "
                                 "precision int, scale int, is_nullable boolean, is_identity boolean, default_object_id int"),
            types=mk([(i, t) for t, i in type_id.items()], "user_type_id int, name string"),
            computed_columns=mk([], "object_id int, column_id int, definition string"),
            index_columns=mk(ic_rows, "object_id int, index_id int, column_id int, key_ordinal int"),
            indexes=mk(idx_rows, "object_id int, index_id int, is_primary_key boolean, is_unique_constraint boolean"),
            foreign_key_columns=mk(fkc_rows, "constraint_object_id int, constraint_column_id int, parent_object_id int, "
                                             "parent_column_id int, referenced_object_id int, referenced_column_id int"),
            foreign_keys=mk(fk_rows, "object_id int, name string, parent_object_id int, referenced_object_id int"),
            database_name=database_name)
