"""Check registry and suite runner (L1-L4, E1-E15, E17; the reference's test class).

Per pair, three shared passes do all the data work: the one-pass profile (one row), the
counted-row grouping summarised to one row, and the unpivoted distinct-value counts (one
row per column). Row checks are result-row structs over a single one-row ``facts`` frame
(profile and summary stacked and merged, no join), so all of them become rows through one
``inline`` select; only the distinct-value and key checks are frames of their own. Each
pass appears once in the pair's plan, so the pair is one job whose independent stages
run side by side, materialised once as a small reliable checkpoint. Typed values are
compared natively and cast to text last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.functions.types import is_numeric, is_string, is_temporal
from paritas.operators import constraints as C
from paritas.operators import parity as P
from paritas.operators import rowdiff as R
from paritas.operators.pair import Alignment, TablePair, align
from paritas.operators.profile import PairProfile
from paritas.session import ensure_checkpoint_dir, reliable_checkpoint

RESULT_DDL = ("database_name string, table_name string, check string, column_name string, metric string, "
              "source_value string, target_value string, passed boolean, status string, detail string")
RESULT_COLUMNS = [c.split()[0] for c in RESULT_DDL.split(", ")]
ROW_FIELDS = RESULT_COLUMNS[2:]


@dataclass
class SuiteContext:
    pair: TablePair
    use_profile: bool = True
    use_summary: bool = True

    @cached_property
    def alignment(self) -> Alignment:
        return align(self.pair)

    @cached_property
    def profile(self) -> PairProfile:
        return PairProfile(self.pair)

    @cached_property
    def summary(self) -> DataFrame:
        return R.diff_summary(self.pair)

    @cached_property
    def distinct(self) -> DataFrame:
        return P.unique_value_parity(self.pair)

    @cached_property
    def facts(self) -> DataFrame:
        """One row holding the profile (``s_*``/``t_*``) and summary columns that were asked for."""
        frames = []
        if self.use_profile:
            frames.append(self.profile.wide)
        if self.use_summary and self.alignment.common:
            frames.append(self.summary)
        if not frames:
            return self.pair.source.sparkSession.range(1).select(F.lit(1).alias("_one"))
        if len(frames) == 1:
            return frames[0]
        stacked = frames[0].unionByName(frames[1], allowMissingColumns=True)
        return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


ROW_CHECKS: dict[str, Callable[[SuiteContext], list[str]]] = {}
FRAME_CHECKS: dict[str, Callable[[SuiteContext], DataFrame]] = {}
CHECKS: list[str] = []
NEEDS_COMMON: set[str] = set()
USES_SUMMARY: set[str] = set()


def row_check(name: str, needs_common: bool = False, uses_summary: bool = False):
    """Register ``fn(ctx) -> list of result rows`` (``_row`` SQL text) evaluated over ``ctx.facts``."""
    def deco(fn):
        ROW_CHECKS[name] = fn
        CHECKS.append(name)
        if needs_common:
            NEEDS_COMMON.add(name)
        if uses_summary:
            USES_SUMMARY.add(name)
        return fn
    return deco


def frame_check(name: str, needs_common: bool = False):
    """Register ``fn(ctx) -> DataFrame`` whose columns are ``ROW_FIELDS``."""
    def deco(fn):
        FRAME_CHECKS[name] = fn
        CHECKS.append(name)
        if needs_common:
            NEEDS_COMMON.add(name)
        return fn
    return deco


class E(str):
    """SQL expression text (a value that is not a literal)."""


def _sql(v) -> str:
    if isinstance(v, E):
        return str(v)
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _row(check: str, column, metric: str | None, sv, tv, passed, status: str = "ok", detail: str | None = None) -> str:
    """One result row as SQL ``named_struct`` text; all rows of a pair are parsed in one ``selectExpr``
    (building them as Column objects costs several JVM round trips per field)."""
    return (f"named_struct('check', {_sql(check)}, 'column_name', CAST({_sql(column)} AS STRING), "
            f"'metric', CAST({_sql(metric)} AS STRING), 'source_value', CAST({_sql(sv)} AS STRING), "
            f"'target_value', CAST({_sql(tv)} AS STRING), 'passed', CAST({_sql(passed)} AS BOOLEAN), "
            f"'status', {_sql(status)}, 'detail', CAST({_sql(detail)} AS STRING))")


def _rows_frame(df: DataFrame, rows: list[str]) -> DataFrame:
    return df.selectExpr(f"inline(array({', '.join(rows)}))")


@row_check("data_diagnosis")
def _diagnosis(ctx: SuiteContext) -> list[str]:
    a, n = ctx.alignment, "data_diagnosis"
    return [_row(n, None, "row_count", E("s_rows"), E("t_rows"), None),
            _row(n, None, "row_count_difference", E("abs(s_rows - t_rows)"), None, None),
            _row(n, None, "column_count", len(ctx.pair.source.columns), len(ctx.pair.target.columns), None),
            _row(n, None, "common_columns", len(a.common), len(a.common), None),
            _row(n, None, "only_on_side", ",".join(a.source_only), ",".join(a.target_only), None)]


@frame_check("data_diagnosis_sample", needs_common=True)
def _sample(ctx: SuiteContext) -> DataFrame:
    """E1's sample: the five smallest values (NULLs last) of the first common column on each side."""
    return _rows_frame(P.sample_texts(ctx.pair, 5), [_row("data_diagnosis_sample", E("column_name"), "sample", E("source_sample"), E("target_sample"), None)])


@row_check("row_counts")
def _row_counts(ctx: SuiteContext) -> list[str]:
    return [_row("row_counts", None, "row_count", E("s_rows"), E("t_rows"), E("s_rows = t_rows"))]


@row_check("column_counts")
def _column_counts(ctx: SuiteContext) -> list[str]:
    s, t = len(ctx.pair.source.columns), len(ctx.pair.target.columns)
    return [_row("column_counts", None, "column_count", s, t, s == t)]


@row_check("column_match")
def _column_match(ctx: SuiteContext) -> list[str]:
    a = ctx.alignment
    return [_row("column_match", None, "common_columns", ",".join(a.source_only), ",".join(a.target_only), len(a.common) > 0)]


def _equality(name: str, needs_nullable: bool):
    def fn(ctx: SuiteContext) -> list[str]:
        a = ctx.alignment
        types_equal = all(a.source_types[c] == a.target_types[c] for c in a.common)
        nullable_equal = all(a.source_nullable[c] == a.target_nullable[c] for c in a.common)
        schema_ok = types_equal and (nullable_equal or not needs_nullable)
        return [_row(name, None, "rows_only_in_side", E("missing"), E("extra"),
                     E(f"missing = 0 AND extra = 0 AND {_sql(schema_ok)}"))]
    return fn


row_check("dataframe_general_equality", needs_common=True, uses_summary=True)(_equality("dataframe_general_equality", False))
row_check("dataframe_schema_adherence", needs_common=True, uses_summary=True)(_equality("dataframe_schema_adherence", True))
row_check("dataframe_equality_ignore_row_order", needs_common=True, uses_summary=True)(
    _equality("dataframe_equality_ignore_row_order", True))


@row_check("schema_data_types")
def _types(ctx: SuiteContext) -> list[str]:
    a = ctx.alignment
    return [_row("schema_data_types", c, "data_type", a.source_types[c].simpleString(), a.target_types[c].simpleString(),
                 a.source_types[c] == a.target_types[c]) for c in a.common]


@row_check("column_nullable_properties")
def _nullable(ctx: SuiteContext) -> list[str]:
    a = ctx.alignment
    return [_row("column_nullable_properties", c, "nullable", a.source_nullable[c], a.target_nullable[c],
                 a.source_nullable[c] == a.target_nullable[c]) for c in a.common]


@row_check("null_count_per_column")
def _nulls(ctx: SuiteContext) -> list[str]:
    p = ctx.profile
    out = []
    for i, c in enumerate(p.columns):
        s, t = p.sql("s", "nulls", i), p.sql("t", "nulls", i)
        out.append(_row("null_count_per_column", c, "null_count", E(s), E(t), E(f"{s} <=> {t}")))
    return out


@row_check("duplicate_row_count", needs_common=True, uses_summary=True)
def _dups(ctx: SuiteContext) -> list[str]:
    sd, td = "(source_rows - source_distinct)", "(target_rows - target_distinct)"
    return [_row("duplicate_row_count", None, "duplicate_rows", E(sd), E(td), E(f"{sd} = {td}"))]


def _ranges(name: str, pick, lo: str, hi: str):
    def fn(ctx: SuiteContext) -> list[str]:
        p = ctx.profile
        out = []
        for i, c in enumerate(p.columns):
            if pick(ctx.alignment.source_types[c]):
                for metric in (lo, hi):
                    sv, tv, eq = p.pair_values_sql(i, metric)
                    out.append(_row(name, c, metric, E(sv), E(tv), E(eq)))
        return out
    return fn


row_check("numeric_column_ranges")(_ranges("numeric_column_ranges", is_numeric, "min", "max"))
row_check("string_column_lengths")(_ranges("string_column_lengths", is_string, "min_len", "max_len"))
row_check("date_column_ranges")(_ranges("date_column_ranges", is_temporal, "min", "max"))


@frame_check("unique_value_counts", needs_common=True)
def _unique(ctx: SuiteContext) -> DataFrame:
    return _rows_frame(ctx.distinct, [_row("unique_value_counts", E("column_name"), "distinct_values", E("source_distinct"),
                                           E("target_distinct"), E("passed"))])


@frame_check("primary_key_uniqueness")
def _pk(ctx: SuiteContext) -> DataFrame:
    name = "primary_key_uniqueness"
    if not ctx.pair.keys:
        return _rows_frame(ctx.facts, [_row(name, None, None, None, None, None, "skipped", "no key columns given")])
    pk = C.pk_parity(ctx.pair)
    both = pk.agg(F.max(F.when(F.col("side") == "source", F.col("violations"))).alias("sv"),
                  F.max(F.when(F.col("side") == "target", F.col("violations"))).alias("tv"))
    return _rows_frame(both, [_row(name, ",".join(ctx.pair.keys), "key_violations", E("sv"), E("tv"), E("sv = 0 AND tv = 0"))])


@frame_check("keyed_row_differences", needs_common=True)
def _keyed(ctx: SuiteContext) -> DataFrame:
    """E5 with keys: how many keys are missing, extra, duplicated, and changed per column."""
    name = "keyed_row_differences"
    if not ctx.pair.keys:
        return _rows_frame(ctx.facts, [_row(name, None, None, None, None, None, "skipped", "no key columns given")])
    counts = R.keyed_diff(ctx.pair).groupBy("column_name", "change").agg(F.count(F.lit(1)).alias("n"))
    # one total row always exists (a global aggregate), so a clean pair reports a passing check
    total = counts.selectExpr("CAST(NULL AS STRING) AS column_name", "'all_differences' AS change",
                              "coalesce(sum(n), CAST(0 AS BIGINT)) AS n")
    return _rows_frame(counts.unionByName(total), [_row(name, E("column_name"), E("change"), E("n"), None, E("n = 0"))])


# -- catalog checks: which column is checked by which rule comes from the metadata rows -----------

def _needs_metadata(fn: Callable[[SuiteContext, str], DataFrame], name: str, both: bool = False):
    """Registers a catalog check; without metadata it is one skipped row."""
    @frame_check(name)
    def check(ctx: SuiteContext) -> DataFrame:
        p = ctx.pair
        if p.source_metadata is None or (both and p.target_metadata is None):
            why = "no metadata given" if p.source_metadata is None else "no target metadata given"
            return _rows_frame(ctx.pair.source.sparkSession.range(1), [_row(name, None, None, None, None, None, "skipped", why)])
        return fn(ctx, name)
    return check


def _ruled(ctx: SuiteContext, flag: str) -> DataFrame:
    """The metadata rows with ``flag`` joined to the long-form profile of the same column. The metadata of one
    table is bounded by the database's column limit; a column that is not on both sides keeps NULL counts."""
    profile = ctx.profile.null_counts().select("column_name", "source_nulls", "target_nulls").join(ctx.distinct.drop("passed"), "column_name")
    wanted = ctx.pair.source_metadata.filter(flag).select("column_name").distinct()
    return wanted.join(profile, "column_name", "left")


def _verdicts(df: DataFrame, rows: list[tuple[str, str, str, str, str]]) -> DataFrame:
    """Result rows (check, metric, source, target, passed) per column; skipped where the column is not on both sides."""
    lost = "source_nulls IS NULL"
    cells = [f"named_struct('check', '{c}', 'column_name', column_name, 'metric', '{m}', 'source_value', CAST({s} AS STRING), 'target_value', CAST({t} AS STRING), "
             f"'passed', CASE WHEN {lost} THEN NULL ELSE {p} END, 'status', CASE WHEN {lost} THEN 'skipped' ELSE 'ok' END, "
             f"'detail', CASE WHEN {lost} THEN 'column is not on both sides' END)" for c, m, s, t, p in rows]
    return _rows_frame(df, cells)


def _metadata_found(ctx: SuiteContext, name: str) -> DataFrame:
    """The catalog knows the table by this name, with at least one column."""
    one = ctx.pair.source_metadata.agg(F.count(F.lit(1)).alias("n"), F.min("table_name").alias("lo"), F.max("table_name").alias("hi"))
    wanted = _sql(ctx.pair.table_name)
    named = "true" if ctx.pair.table_name is None else f"(n > 0 AND lo = {wanted} AND hi = {wanted})"
    return _rows_frame(one, [_row(name, None, "columns", E("n"), None, E("n > 0")), _row(name, None, "table_name", E("lo"), ctx.pair.table_name, E(named))])


def _schema_comparison(ctx: SuiteContext, name: str) -> DataFrame:
    """Every column attribute in which the two catalogs differ, and how many (0 passes)."""
    from paritas.operators.catalog import compare_schemas
    same = [m.withColumn("schema_name", F.lit("")).withColumn("table_name", F.lit("")) for m in (ctx.pair.source_metadata, ctx.pair.target_metadata)]
    found = compare_schemas(*same)
    rows = _rows_frame(found, [_row(name, E("column_name"), E("attribute"), E("source_value"), E("target_value"), False)])
    return rows.unionByName(_rows_frame(found.agg(F.count(F.lit(1)).alias("n")), [_row(name, None, "differences", E("n"), None, E("n = 0"))]))


def _fk_columns(ctx: SuiteContext, name: str) -> DataFrame:
    """NULL and distinct counts of every foreign-key column agree."""
    return _verdicts(_ruled(ctx, "size(foreign_keys) > 0"), [(name, "nulls", "source_nulls", "target_nulls", "source_nulls = target_nulls"),
                                                             (name, "distinct_values", "source_distinct", "target_distinct", "source_distinct = target_distinct")])


def _metadata_columns(ctx: SuiteContext, name: str) -> DataFrame:
    """Identity columns hold no NULL on either side, declared not-null columns equally many."""
    identity = _verdicts(_ruled(ctx, "is_identity"), [(name, "identity_nulls", "source_nulls", "target_nulls", "source_nulls = 0 AND target_nulls = 0")])
    return identity.unionByName(_verdicts(_ruled(ctx, "NOT is_nullable"), [(name, "not_null_parity", "source_nulls", "target_nulls", "source_nulls = target_nulls")]))


_needs_metadata(_metadata_found, "table_metadata_retrieval")
_needs_metadata(_schema_comparison, "schema_comparison", both=True)
_needs_metadata(_fk_columns, "foreign_key_integrity")
_needs_metadata(_metadata_columns, "metadata_driven_column_validation")


def _error_row(name: str, e: Exception) -> str:
    return _row(name, None, None, None, None, None, "error", f"{type(e).__name__}: {e}")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _assemble(pair: TablePair, ctx: SuiteContext, names: list[str]) -> tuple[list[DataFrame], list[tuple[str, DataFrame]]]:
    structs: list[str] = []
    frames: list[tuple[str, DataFrame]] = []
    for name in names:
        try:
            if name in NEEDS_COMMON and not ctx.alignment.common:
                structs.append(_row(name, None, None, None, None, None, "skipped", "no common columns"))
            elif name in ROW_CHECKS:
                structs.extend(ROW_CHECKS[name](ctx))
            else:
                frames.append((name, FRAME_CHECKS[name](ctx)))
        except Exception as e:  # noqa: BLE001 - a failing check becomes an error row, the suite goes on
            structs.append(_error_row(name, e))
    parts = [_rows_frame(ctx.facts, structs)] if structs else []
    return parts, frames


def _labelled(pair: TablePair, df: DataFrame) -> DataFrame:
    return df.select(F.lit(pair.database_name).cast("string").alias("database_name"),
                     F.lit(pair.table_name).cast("string").alias("table_name"), *ROW_FIELDS)


def run_pair(pair: TablePair, checks: Iterable[str] | None = None) -> DataFrame:
    """All (or the named) registered checks on one pair, materialised as a small checkpoint."""
    spark = pair.source.sparkSession
    names = list(checks or CHECKS)
    ctx = SuiteContext(pair, use_profile=any(n in ROW_CHECKS for n in names),
                       use_summary=any(n in USES_SUMMARY for n in names))
    parts, frames = _assemble(pair, ctx, names)
    everything = parts + [f for _, f in frames]
    try:
        return reliable_checkpoint(_labelled(pair, _union(everything)))
    except Exception as e:  # noqa: BLE001 - isolate what fails at execution time
        kept = []
        for part in parts:
            try:
                kept.append(reliable_checkpoint(_labelled(pair, part)))
            except Exception as e2:  # noqa: BLE001
                kept.append(_labelled(pair, _rows_frame(spark.range(1), [_error_row("row_checks", e2)])))
        for name, f in frames:
            try:
                kept.append(reliable_checkpoint(_labelled(pair, f)))
            except Exception as e2:  # noqa: BLE001
                kept.append(_labelled(pair, _rows_frame(spark.range(1), [_error_row(name, e2)])))
        if not kept:
            kept.append(_labelled(pair, _rows_frame(spark.range(1), [_error_row("suite", e)])))
        return _union(kept)


def run_suite(spark: SparkSession, pairs: Iterable[TablePair | tuple[str, str, Callable[[], TablePair]]],
              checks: Iterable[str] | None = None, parallelism: int = 4) -> DataFrame:
    """L1: every check on every pair; a pair that fails to load yields one ``error`` row and the run goes on.

    ``pairs`` holds ready pairs or ``(database, table, loader)`` triples whose loader builds the pair.
    Up to ``parallelism`` pairs are planned and run at once from driver threads, so one table's
    plan building overlaps another's execution and small tables do not leave the cluster idle.
    """
    from concurrent.futures import ThreadPoolExecutor

    ensure_checkpoint_dir(spark)  # once, before any thread checkpoints
    names = list(checks) if checks is not None else None

    def one(item) -> DataFrame:
        if isinstance(item, TablePair):
            return run_pair(item, names)
        database, table, loader = item
        try:
            pair = loader()
        except Exception as e:  # noqa: BLE001
            failed = TablePair(spark.range(0), spark.range(0), database_name=database, table_name=table)
            return _labelled(failed, _rows_frame(spark.range(1), [_error_row("load", e)]))
        return run_pair(pair, names)

    items = list(pairs)
    if not items:
        return spark.createDataFrame([], RESULT_DDL)
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(items)))) as pool:
        out = list(pool.map(one, items))
    return _union(out).select(*RESULT_COLUMNS)


def scope_items(scope: Mapping[str, Iterable[str]], pairings: Iterable[str], databases: Iterable[str] | None = None,
                tables: Iterable[str] | None = None) -> list[tuple[str, str, str]]:
    """(pairing, database, table) of a scope ``{database: tables}``, optionally of some databases or tables only (L3)."""
    dbs, tabs = (None if x is None else set(x) for x in (databases, tables))
    return [(p, d, t) for p in pairings for d, of in scope.items() if dbs is None or d in dbs for t in of if tabs is None or t in tabs]


def run_scope(spark: SparkSession, locator: "LayerLocator", scope: Mapping[str, Iterable[str]], pairings: Iterable[str], path: str,
              keys: Mapping[str, tuple[str, ...]] | None = None, checks: Iterable[str] | None = None, databases: Iterable[str] | None = None,
              tables: Iterable[str] | None = None, parallelism: int = 4) -> DataFrame:
    """L1, L3: every check on every table of every database at every layer hop, results kept per table.

    The results of one table and hop are one dataset below ``path`` (``pairing=/database_name=/table_name=``),
    complete when its success marker is there. A run that was stopped is started again with the same
    ``path``: finished tables are skipped, unfinished ones written anew. A table that cannot be
    loaded is an ``error`` row and counts as unfinished, so the next run tries it again.
    Returns the results of the whole scope, read back.
    """
    from concurrent.futures import ThreadPoolExecutor

    from paritas.sources.layers import load_pair
    from paritas.sources.sinks import finished, read_scope, write_scope

    ensure_checkpoint_dir(spark)
    names = list(checks) if checks is not None else None
    items = scope_items(scope, pairings, databases, tables)
    todo = [i for i in items if not finished(spark, path, *i)]

    def one(item: tuple[str, str, str]) -> None:
        pairing, database, table = item
        try:
            pair = load_pair(spark, pairing, locator, table, database, tuple((keys or {}).get(table, ())))
            rows, whole = run_pair(pair, names), True
        except Exception as e:  # noqa: BLE001 - one table's failure does not stop the run
            failed = TablePair(spark.range(0), spark.range(0), database_name=database, table_name=table)
            rows, whole = _labelled(failed, _rows_frame(spark.range(1), [_error_row("load", e)])), False
        write_scope(rows, path, pairing, database, table, whole)

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(todo) or 1))) as pool:
        list(pool.map(one, todo))
    if not items:
        return spark.createDataFrame([], "pairing string, " + RESULT_DDL)
    return read_scope(spark, path, items)


def summarise(results: DataFrame) -> DataFrame:
    """L4: per table, checks passed / failed / skipped / in error, and the overall verdict."""
    out = results.groupBy("database_name", "table_name").agg(
        F.count_if(F.col("passed") == F.lit(True)).alias("passed_rows"),
        F.count_if(F.col("passed") == F.lit(False)).alias("failed_rows"),
        F.count_distinct(F.when(F.col("passed") == F.lit(False), F.col("check"))).alias("failed_checks"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "error").alias("errors"))
    return out.withColumn("all_passed", (F.col("failed_rows") == 0) & (F.col("errors") == 0))
