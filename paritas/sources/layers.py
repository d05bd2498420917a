"""Layered lakehouse readers (A4-A8): landing, bronze, silver, gold, truncated gold.

Paths come from templates on an explicit ``LayerLocator`` (no environment lookups).
Fields: ``{root}`` warehouse root, ``{landing}`` landing root, ``{layer}`` layer name,
``{l}`` its first letter, ``{source}`` normalised data-source name, ``{table}``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from paritas.operators.pair import TablePair
from paritas.sources.jdbc import JdbcSource

#: Layer order; all names of databases, folders and sources are the caller's, by templates and aliases.
LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class LayerLocator:
    root: str = ""
    landing_root: str = ""
    source_aliases: tuple[str, ...] = ()
    landing_template: str = "{landing}/{source}/{table}"
    layer_template: str = "{root}/{layer}_{source}.db/{l}_{source}_{table}"
    gold_template: str = "{root}/gold.db/{table}"
    truncated_template: str = "{root}/gold_truncated.db/{table}"
    jdbc: Callable[[str], JdbcSource] | None = field(default=None, compare=False)
    #: Split of a table's SQL read, by table name (see ``JdbcSource.table``); tables without one are read by one task.
    splits: Mapping[str, Mapping[str, object]] = field(default_factory=dict, compare=False)

    def source_name(self, name: str) -> str:
        """A source name containing a known alias (case-insensitive) is reduced to the alias."""
        low = name.lower()
        for alias in self.source_aliases:
            if alias in low:
                return alias
        return low

    def _fmt(self, template: str, table: str, source: str, layer: str = "") -> str:
        return template.format(root=self.root.rstrip("/"), landing=self.landing_root.rstrip("/"), layer=layer,
                               l=layer[:1], source=self.source_name(source), table=table)

    def landing(self, table: str, source: str) -> str:
        return self._fmt(self.landing_template, table, source)

    def layer(self, layer: str, table: str, source: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
        if layer == "gold":
            return self._fmt(self.gold_template, table, source, layer)
        return self._fmt(self.layer_template, table, source, layer)

    def previous(self, layer: str, table: str, source: str) -> str:
        """The layer one hop back: silver → bronze, gold → silver."""
        i = LAYERS.index(layer)
        if i == 0:
            raise ValueError("bronze reads from landing; use landing()")
        return self.layer(LAYERS[i - 1], table, source)

    def truncated(self, table: str, source: str = "") -> str:
        return self._fmt(self.truncated_template, table, source)


Reader = Callable[[SparkSession, LayerLocator, str, str], DataFrame]


def _sql(spark: SparkSession, loc: LayerLocator, table: str, database: str) -> DataFrame:
    if loc.jdbc is None:
        raise ValueError("this pairing reads the SQL source; give the locator a jdbc factory")
    return loc.jdbc(database).table(spark, table, **loc.splits.get(table, {}))


def _landing(spark, loc, table, source):
    return spark.read.parquet(loc.landing(table, source))


def _layer(name: str) -> Reader:
    return lambda spark, loc, table, source: spark.read.parquet(loc.layer(name, table, source))


def _truncated(spark, loc, table, source):
    return spark.read.parquet(loc.truncated(table, source))


# pairing → (source reader, target reader); one per layer hop of the reference's modules
PAIRINGS: dict[str, tuple[Reader, Reader]] = {
    "sql_to_landing": (_sql, _landing),
    "landing_to_bronze": (_landing, _layer("bronze")),
    "landing_to_bronze_second": (_landing, _layer("bronze")),
    "bronze_to_silver": (_layer("bronze"), _layer("silver")),
    "silver_to_gold": (_layer("silver"), _layer("gold")),
    "gold_to_truncated": (_layer("gold"), _truncated),
    "sql_constraints": (_sql, _landing),
}


def load_pair(spark: SparkSession, pairing: str, locator: LayerLocator, table: str, source: str,
              keys: tuple[str, ...] = ()) -> TablePair:
    """The (source, target) frames of one table for one layer hop."""
    read_s, read_t = PAIRINGS[pairing]
    return TablePair(read_s(spark, locator, table, source), read_t(spark, locator, table, source), keys=keys,
                     database_name=source, table_name=table, label=pairing)
