"""Table pair and column alignment (DM2, B1, I5).

A pair is two lazy DataFrames plus optional key columns. Alignment is schema-only:
it never starts a Spark job.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class TablePair:
    source: DataFrame
    target: DataFrame
    keys: tuple[str, ...] = ()
    database_name: str | None = None
    table_name: str | None = None
    label: str = ""
    #: Column metadata (G2 rows) of the table on either side; the suite's catalog checks read it.
    source_metadata: DataFrame | None = None
    target_metadata: DataFrame | None = None

    def with_keys(self, *keys: str) -> "TablePair":
        return replace(self, keys=tuple(keys))

    def with_metadata(self, source: DataFrame, target: DataFrame | None = None) -> "TablePair":
        return replace(self, source_metadata=source, target_metadata=target)


@dataclass(frozen=True)
class Alignment:
    common: list[str]
    source_only: list[str]
    target_only: list[str]
    source_types: dict[str, T.DataType] = field(default_factory=dict)
    target_types: dict[str, T.DataType] = field(default_factory=dict)
    source_nullable: dict[str, bool] = field(default_factory=dict)
    target_nullable: dict[str, bool] = field(default_factory=dict)


def align(pair: TablePair) -> Alignment:
    """Common, source-only and target-only column names (case-sensitive, sorted)."""
    s_fields = {f.name: f for f in pair.source.schema.fields}
    t_fields = {f.name: f for f in pair.target.schema.fields}
    common = sorted(set(s_fields) & set(t_fields))
    return Alignment(
        common=common,
        source_only=sorted(set(s_fields) - set(t_fields)),
        target_only=sorted(set(t_fields) - set(s_fields)),
        source_types={n: f.dataType for n, f in s_fields.items()},
        target_types={n: f.dataType for n, f in t_fields.items()},
        source_nullable={n: f.nullable for n, f in s_fields.items()},
        target_nullable={n: f.nullable for n, f in t_fields.items()},
    )


def common_frames(pair: TablePair) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides projected on the sorted common columns."""
    cols = align(pair).common
    return pair.source.select(*cols), pair.target.select(*cols), cols
