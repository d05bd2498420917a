"""Constraint checks driven by catalog metadata (H1-H5, H7-H9; the reference's SQL-source module).

The catalog is read for its constraint definitions only (schema facts: key column lists,
not-null columns, foreign keys), which are collected to the driver; constraints are held by
the catalog's object ids, so equal names in two schemas stay apart.

A table is scanned once whatever it declares: every row gives one cell per key set (primary
key, unique constraints, child columns of its foreign keys, columns that other keys refer to)
and one per not-null column without a value, and cells are counted by (constraint id, key).
The counts are written to the shared folder, by constraint id. Key
statistics and samples are read from there, and all foreign keys together are one anti
join of child counts against parent counts.

Rows use the suite's result schema: ``source_value`` holds the violation count, ``target_value``
the number of duplicated key values for key checks, and ``detail`` the constraint name. Sample
rows (metric ``duplicate_sample`` or ``missing_sample``) hold a key in ``source_value`` and its rows
in ``target_value``, with ``passed`` NULL. A constraint that names a column its frame lacks is an error row, one
whose other table has no frame (or is not in the catalog) a skipped row; all others still run.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.functions.types import is_floating, is_numeric
from paritas.functions.values import canonical_sql, exact_number_sql, quote, typed_key_sql
from paritas.operators import catalog as G
from paritas.operators import constraints as C
from paritas.operators import graph as GR
from paritas.plans.suite import RESULT_COLUMNS, RESULT_DDL, ROW_FIELDS, E, _row, _union
from paritas.session import ensure_checkpoint_dir, reliable_checkpoint
from paritas.sources.catalog import CatalogTables

COUNTS = "ci int, l bigint, d double, s string, has_null boolean, n bigint"
SAMPLES = 10  # of the reference's reports


@dataclass
class Declared:
    """Constraints of one table: ``keys`` (kind, name, columns), not-null columns, foreign keys out of and into it."""
    schema: str
    table: str
    label: str
    keys: list[tuple[str, str, list[str]]] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    out: list["Reference"] = field(default_factory=list)
    into: list["Reference"] = field(default_factory=list)

    @property
    def loops(self) -> list["Reference"]:
        return [f for f in self.out if f.parent_id == f.child_id]


@dataclass(frozen=True)
class Reference:
    """A foreign key by object id; ``parent_id`` is None when its target is not in the catalog."""
    number: int
    name: str
    child_id: int
    columns: tuple[str, ...]
    parent_id: int | None
    referred: tuple[str | None, ...]


def declared(cat: CatalogTables) -> dict[int, Declared]:
    """Constraint definitions per table's object id (a small collect of schema facts)."""
    tables = G._tables(cat).collect()
    bare = {}
    for t in tables:
        bare.setdefault(t.table_name, []).append(t)
    out = {t.object_id: Declared(t.schema_name, t.table_name, t.table_name if len(bare[t.table_name]) == 1 else f"{t.schema_name}.{t.table_name}") for t in tables}
    names = G._column_names(cat)
    keys = (cat.indexes.filter("is_primary_key OR is_unique_constraint").select("object_id", "index_id", "is_primary_key")
            .join(cat.index_columns.select("object_id", "index_id", "column_id", "key_ordinal"), ["object_id", "index_id"])
            .join(names, ["object_id", "column_id"]).groupBy("object_id", "index_id", "is_primary_key")
            .agg(F.sort_array(F.collect_list(F.struct("key_ordinal", "column_name"))).alias("of")))
    for k in keys.orderBy("object_id", "index_id").collect():
        kind = "primary_key" if k.is_primary_key else "unique"
        if k.object_id in out:
            out[k.object_id].keys.append((kind, f"{kind}_{k.index_id}", [c.column_name for c in k.of]))
    for r in cat.columns.filter("NOT is_nullable").orderBy("object_id", "column_id").select("object_id", "name").collect():
        if r.object_id in out:
            out[r.object_id].not_null.append(r.name)
    pairs = (G.resolved_fk_columns(cat).groupBy("constraint_object_id", "foreign_key_name", "parent_object_id", "referenced_object_id", "referenced_table_name")
             .agg(F.sort_array(F.collect_list(F.struct("constraint_column_id", "child_column_name", "referenced_column_name"))).alias("of")))
    for f in pairs.orderBy("constraint_object_id").collect():
        known = f.referenced_table_name is not None
        ref = Reference(f.constraint_object_id, f.foreign_key_name, f.parent_object_id, tuple(c.child_column_name for c in f.of),
                        f.referenced_object_id if known else None, tuple(c.referenced_column_name for c in f.of))
        out[ref.child_id].out.append(ref)
        if known:
            out[ref.parent_id].into.append(ref)
    return out


def frames_by_id(spec: Mapping[int, Declared], tables: Mapping[str, DataFrame]) -> dict[int, DataFrame]:
    """Frames by object id; a frame is named ``schema.table``, or ``table`` where one schema has that table."""
    return {i: tables[name] for i, d in spec.items() for name in (f"{d.schema}.{d.table}", d.label) if name in tables}


def _cell(ci: int, df: DataFrame, columns: tuple[str, ...], others: tuple[T.DataType, ...] | None = None) -> str:
    """SQL of the cell of one key set: its typed key and its text. Columns whose types differ from the other table's
    (``others``) are compared as text: numbers in their normal form."""
    types = {f.name: f.dataType for f in df.schema.fields}
    own = tuple(types[c] for c in columns)
    forms = []
    for c, dt, other in zip(columns, own, others or own):
        e = quote(c)
        forms.append(e if dt == other else exact_number_sql(e, dt) if is_numeric(dt) and is_numeric(other) else f"CAST({e} AS STRING)")
    if len(columns) == 1 and forms[0] == quote(columns[0]):
        l, d, s = typed_key_sql(forms[0], own[0])
    elif len(columns) == 1:
        l, d, s = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", forms[0]
    else:
        parts = [canonical_sql(f, dt) if f == quote(c) else f for f, c, dt in zip(forms, columns, own)]
        s = "to_json(array(" + ", ".join(f"to_json(struct({p} AS v))" for p in parts) + "))"
        l, d = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)"
    null = " OR ".join(f"{quote(c)} IS NULL" for c in columns)
    return f"named_struct('ci', {ci}, 'l', {l}, 'd', {d}, 's', {s}, 'has_null', {null})"


def _shown(df: DataFrame, columns: tuple[str, ...], drifted: bool = False) -> str:
    """SQL of a key's text for a sample, from its typed key."""
    if len(columns) > 1:
        return "concat_ws(', ', transform(from_json(s, 'array<string>'), x -> coalesce(get_json_object(x, '$.v'), 'NULL')))"
    dt = df.schema[columns[0]].dataType
    if drifted:
        return "s"
    if isinstance(dt, T.BooleanType):
        return "CAST(l = 1 AS STRING)"
    if isinstance(dt, T.DateType):
        return "CAST(date_from_unix_date(CAST(l AS INT)) AS STRING)"
    if isinstance(dt, T.TimestampType):
        return "CAST(timestamp_micros(l) AS STRING)"
    if isinstance(dt, T.TimestampNTZType):
        return "CAST(timestampadd(MICROSECOND, l, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS STRING)"
    return "coalesce(CAST(l AS STRING), CAST(d AS STRING), s)"


def _by(column: str, shown: dict[int, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN {e}" for k, e in shown.items()) + " END"


@dataclass
class Plan:
    """What one table's scan counts: cell SQL by constraint id, and what each id means."""
    cells: list[str] = field(default_factory=list)
    keys: dict[int, tuple[str, str, list[str]]] = field(default_factory=dict)
    not_null: dict[int, str] = field(default_factory=dict)
    child: dict[int, int] = field(default_factory=dict)  # foreign key's number -> id
    parent: dict[int, int] = field(default_factory=dict)
    shown: dict[int, str] = field(default_factory=dict)

    def add(self, cell) -> int:
        self.cells.append(cell(len(self.cells)))
        return len(self.cells) - 1


def _missing(df: DataFrame, columns) -> str | None:
    lost = [c for c in columns if c not in df.columns]
    return f"column {', '.join(lost)} is not in the frame" if lost else None


def _key_types(df: DataFrame, columns) -> tuple[T.DataType, ...]:
    return tuple(df.schema[c].dataType for c in columns)


def _plan(spec: Mapping[int, Declared], frames: Mapping[int, DataFrame], i: int, notes: list[str]) -> Plan:
    d, df, plan = spec[i], frames[i], Plan()

    def note(check: str, columns, metric: str, status: str, why: str, name: str) -> None:
        notes.append((d.label, _row(check, ",".join(columns), metric, None, None, None, status, f"{name}: {why}")))

    for kind, name, columns in d.keys:
        if why := _missing(df, columns):
            note("primary_key_uniqueness" if kind == "primary_key" else "unique_constraints", columns, "violations", "error", why, name)
        else:
            ci = plan.add(lambda ci: _cell(ci, df, tuple(columns)))
            plan.keys[ci], plan.shown[ci] = (kind, name, columns), _shown(df, tuple(columns))
    for c in d.not_null:
        if why := _missing(df, [c]):
            note("not_null_constraints", [c], "null_or_nan", "error", why, "not null")
            continue
        bad = f"{quote(c)} IS NULL" + (f" OR isnan({quote(c)})" if is_floating(df.schema[c].dataType) else "")
        plan.not_null[plan.add(lambda ci: f"CASE WHEN {bad} THEN named_struct('ci', {ci}, 'l', CAST(NULL AS BIGINT), 'd', CAST(NULL AS DOUBLE), 's', "
                                          f"CAST(NULL AS STRING), 'has_null', true) END")] = c
    for f in dict.fromkeys(d.out + d.into):
        checks = []
        if f.child_id == i:
            checks.append(("self_referencing_integrity" if f.parent_id == i else "referential_integrity", f.columns, "missing_values", f.name))
        elif f.parent_id == i:
            checks.append(("orphaned_records", f.columns, "orphaned_rows", f"{f.name} from {spec[f.child_id].label}"))
        other = f.parent_id if f.child_id == i else f.child_id
        if other is None or other not in frames:
            why = ("skipped", "its target is not in the catalog" if other is None else f"no frame for {spec[other].label}")
        else:
            lost = _missing(frames[f.child_id], f.columns) or _missing(frames[f.parent_id], f.referred)
            why = ("error", lost) if lost else None
        for check, columns, metric, name in checks:
            if why:
                note(check, columns, metric, *why, name)
        if why:
            continue
        child, parent = (_key_types(frames[f.child_id], f.columns), _key_types(frames[f.parent_id], f.referred))
        if f.child_id == i:
            ci = plan.child[f.number] = plan.add(lambda ci: _cell(ci, df, f.columns, parent))
            plan.shown[ci] = _shown(df, f.columns, child != parent)
        if f.parent_id == i:
            plan.parent[f.number] = plan.add(lambda ci: _cell(ci, df, f.referred, child))
    return plan


def key_cells(df: DataFrame, cells: list[str]) -> DataFrame:
    """``COUNTS`` of every cell of every row, from one scan."""
    rows = df.selectExpr(f"inline(filter(array({', '.join(cells)}), x -> x IS NOT NULL))")
    return rows.groupBy("ci", "l", "d", "s").agg(F.bool_or("has_null").alias("has_null"), F.count(F.lit(1)).alias("n"))


def _table_rows(spark: SparkSession, counts: DataFrame, plan: Plan, samples: int) -> DataFrame:
    """Result rows of the key sets and not-null columns of one table. Counts of a constraint
    without any cell (an empty table) are zero: the listing of constraints is one row each."""
    valued = ~F.col("has_null")
    stats = counts.groupBy("ci").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("different"), F.count_if(F.col("n") > 1).alias("dups"),
        F.sum(F.when(valued, F.col("n"))).alias("v_rows"), F.count_if(valued).alias("v_different"), F.count_if(valued & (F.col("n") > 1)).alias("v_dups"))
    listing = [(ci, "primary_key_uniqueness" if kind == "primary_key" else "unique_constraints", ",".join(cols), name, kind) for ci, (kind, name, cols) in plan.keys.items()]
    listing += [(ci, "not_null_constraints", c, None, "not_null") for ci, c in plan.not_null.items()]
    named = spark.createDataFrame(listing, "ci int, check string, column_name string, name string, kind string")
    j = F.broadcast(named).join(stats, "ci", "left").na.fill(0, ["rows", "different", "dups", "v_rows", "v_different", "v_dups"])
    of = lambda pk, unique, other: f"CASE kind WHEN 'primary_key' THEN {pk} WHEN 'unique' THEN {unique} ELSE {other} END"
    found = j.selectExpr("check", "column_name", "kind", "name", f"{of('rows - different', 'v_rows - v_different', 'rows')} AS bad", f"{of('dups', 'v_dups', 'CAST(NULL AS BIGINT)')} AS dups")
    out = found.selectExpr("check", "column_name", "CASE kind WHEN 'not_null' THEN 'null_or_nan' ELSE 'violations' END AS metric", "CAST(bad AS STRING) AS source_value",
                           "CAST(dups AS STRING) AS target_value", "bad = 0 AS passed", "'ok' AS status", "name AS detail")
    if samples and plan.keys:
        top = Window.partitionBy("ci").orderBy(F.desc("n"), F.asc_nulls_last("l"), F.asc_nulls_last("d"), F.asc_nulls_last("s"))
        dups = counts.filter(F.col("n") > 1).withColumn("r", F.row_number().over(top)).filter(F.col("r") <= samples)  # a top-k per partition before the shuffle
        unique = [ci for ci, (kind, _, _) in plan.keys.items() if kind == "unique"]
        dups = dups.filter(~(F.col("ci").isin(unique) & F.col("has_null"))) if unique else dups
        out = out.unionByName(dups.join(F.broadcast(named.filter("kind <> 'not_null'")), "ci").selectExpr(
            "check", "column_name", "'duplicate_sample' AS metric", f"{_by('ci', {ci: plan.shown[ci] for ci in plan.keys})} AS source_value", "CAST(n AS STRING) AS target_value", "CAST(NULL AS BOOLEAN) AS passed", "'ok' AS status", "name AS detail"))
    return out


def _reference_rows(spark: SparkSession, spec, found: list[tuple[Reference, DataFrame, DataFrame]], shown: dict[int, str], null_fk: str, samples: int) -> DataFrame:
    """Result rows of all foreign keys from one anti join of child counts against parent counts."""
    tag = lambda df, f: df.withColumn("fk", F.lit(f.number).cast("bigint"))
    child = _union([tag(c, f) for f, c, _ in found])
    parent = _union([tag(p, f) for f, _, p in found]).filter(~F.col("has_null")).select("fk", "l", "d", "s")
    same = F.col("c.fk") == F.col("p.fk")
    for x in "lds":
        same &= F.col(f"c.{x}").eqNullSafe(F.col(f"p.{x}"))
    lost = reliable_checkpoint(child.alias("c").join(parent.alias("p"), same & ~F.col("c.has_null"), "left_anti"))
    per = lost.groupBy("fk").agg(F.count_if(~F.col("has_null")).alias("missing"), F.sum(F.when(~F.col("has_null") | F.lit(null_fk == "orphan"), F.col("n"))).alias("orphans"))
    listing = []
    for f, _, _ in found:
        own, into = spec[f.child_id].label, spec[f.parent_id].label
        if f.child_id == f.parent_id:
            listing.append((f.number, own, "self_referencing_integrity", ",".join(f.columns), "missing_values", f.name))
        else:
            listing.append((f.number, own, "referential_integrity", ",".join(f.columns), "missing_values", f.name))
            listing.append((f.number, into, "orphaned_records", ",".join(f.columns), "orphaned_rows", f"{f.name} from {own}"))
    named = spark.createDataFrame(listing, "fk bigint, table_name string, check string, column_name string, metric string, detail string")
    j = F.broadcast(named).join(per, "fk", "left").na.fill(0, ["missing", "orphans"]).withColumn("bad", F.expr("CASE metric WHEN 'missing_values' THEN missing ELSE orphans END"))
    out = j.selectExpr("table_name", "check", "column_name", "metric", "CAST(bad AS STRING) AS source_value", "CAST(NULL AS STRING) AS target_value", "bad = 0 AS passed", "'ok' AS status", "detail")
    if samples:
        top = Window.partitionBy("fk").orderBy(F.asc_nulls_last("l"), F.asc_nulls_last("d"), F.asc_nulls_last("s"))
        some = lost.filter(~F.col("has_null")).withColumn("r", F.row_number().over(top)).filter(F.col("r") <= samples)
        out = out.unionByName(some.join(F.broadcast(named.filter("metric = 'missing_values'")), "fk").selectExpr(
            "table_name", "check", "column_name", "'missing_sample' AS metric", f"{_by('fk', shown)} AS source_value", "CAST(n AS STRING) AS target_value",
            "CAST(NULL AS BOOLEAN) AS passed", "'ok' AS status", "detail"))
    return out


def catalog_rows(cat: CatalogTables, exclude_pattern: str | None = "DO_NOT") -> DataFrame:
    """G9 and G8 as result rows: foreign-key columns (of the tables that G2 lists) whose types differ from the referenced ones, cycles of
    foreign keys with a witness path, and for each a total, 0 when all is well."""
    wrong = G.fk_type_mismatch(G.column_metadata(cat, exclude_pattern=exclude_pattern)).selectExpr(
        "concat(schema_name, '.', table_name) AS table_name", "'foreign_key_datatype_consistency' AS check", "column_name", "attribute AS metric",
        "child_value AS source_value", "parent_value AS target_value", "false AS passed", "'ok' AS status", "foreign_key_name AS detail")
    cycles = GR.fk_cycles(G.fk_edges(cat)).selectExpr(
        "component AS table_name", "'circular_references' AS check", "CAST(NULL AS STRING) AS column_name", "'cycle' AS metric", "CAST(cycle_len AS STRING) AS source_value",
        "CAST(n_nodes AS STRING) AS target_value", "false AS passed", "'ok' AS status", "array_join(path, ' -> ') AS detail")
    rows = wrong.unionByName(cycles)
    totals = [rows.filter(F.col("check") == c).agg(F.count(F.lit(1)).alias("n")).selectExpr(
        "CAST(NULL AS STRING) AS table_name", f"'{c}' AS check", "CAST(NULL AS STRING) AS column_name", "'total' AS metric", "CAST(n AS STRING) AS source_value",
        "CAST(NULL AS STRING) AS target_value", "n = 0 AS passed", "'ok' AS status", "CAST(NULL AS STRING) AS detail") for c in ("foreign_key_datatype_consistency", "circular_references")]
    return _union([rows, *totals]).select(F.lit(cat.database_name).alias("database_name"), *RESULT_COLUMNS[1:])


def run_constraints(spark: SparkSession, cat: CatalogTables, tables: Mapping[str, DataFrame], null_fk: str = "orphan",
                    parallelism: int = 4, samples: int = SAMPLES) -> DataFrame:
    """H1-H5/H7-H9 for every table of ``tables`` that the catalog declares constraints on, with at most ``samples``
    duplicated or missing keys for each constraint. Tables are named ``table`` or ``schema.table``; their
    scans run concurrently from driver threads. An empty table passes; see the module for skipped and error rows.
    """
    if null_fk not in ("orphan", "ignore"):
        raise ValueError("null_fk must be 'orphan' or 'ignore'")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    spec = declared(cat)
    frames = frames_by_id(spec, tables)
    notes: list[tuple[str, str]] = []
    plans = {i: _plan(spec, frames, i, notes) for i in frames}
    counts: dict[int, DataFrame] = {}

    def scan(i: int) -> None:
        if not plans[i].cells:
            return
        try:
            key_cells(frames[i], plans[i].cells).write.partitionBy("ci").parquet(f"{folder}/{i}")
            counts[i] = spark.read.schema(COUNTS).parquet(f"{folder}/{i}")
        except Exception as e:  # noqa: BLE001 - one table's failure becomes an error row
            notes.append((spec[i].label, _row("constraints", None, None, None, None, None, "error", f"{type(e).__name__}: {e}")))

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(plans) or 1))) as pool:
        list(pool.map(scan, plans))
    out = []
    for i, df in counts.items():
        if plans[i].keys or plans[i].not_null:
            out.append(_table_rows(spark, df, plans[i], samples).select(F.lit(spec[i].label).alias("table_name"), *ROW_FIELDS))
    references = [f for i in plans for f in spec[i].out if f.number in plans[i].child]
    whole = [f for f in references if f.child_id in counts and f.parent_id in counts]
    of = lambda i, ci: counts[i].filter(F.col("ci") == ci)
    if whole:
        found = [(f, of(f.child_id, plans[f.child_id].child[f.number]), of(f.parent_id, plans[f.parent_id].parent[f.number])) for f in whole]
        out.append(_reference_rows(spark, spec, found, {f.number: plans[f.child_id].shown[plans[f.child_id].child[f.number]] for f in whole}, null_fk, samples).select("table_name", *ROW_FIELDS))
    for f in references:
        if f not in whole:
            notes.append((spec[f.child_id].label, _row("referential_integrity", ",".join(f.columns), "missing_values", None, None, None, "error", f"{f.name}: a table could not be read")))
    for label, row in notes:
        out.append(spark.range(1).selectExpr(f"inline(array({row}))").select(F.lit(label).alias("table_name"), *ROW_FIELDS))
    if not out:
        return spark.createDataFrame([], RESULT_DDL)
    return reliable_checkpoint(_union(out)).select(F.lit(cat.database_name).cast("string").alias("database_name"), *RESULT_COLUMNS[1:])
