"""Pair checks.

Schema checks read only the two schemas; their small result frames are built from
schema facts. Data checks are lazy DataFrames; nothing here collects data rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.functions.values import display_text, quote, typed_key_sql
from paritas.operators.pair import TablePair, align
from paritas.operators.profile import PairProfile


def _frame(pair: TablePair, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    return pair.source.sparkSession.createDataFrame(rows, schema)


def column_count_parity(pair: TablePair) -> DataFrame:
    """Number of columns on both sides."""
    s, t = len(pair.source.columns), len(pair.target.columns)
    schema = T.StructType([T.StructField("source_n", T.LongType()), T.StructField("target_n", T.LongType()),
                           T.StructField("passed", T.BooleanType())])
    return _frame(pair, [(s, t, s == t)], schema)


def column_match(pair: TablePair) -> DataFrame:
    """Passes when the sides share at least one column; lists names by side."""
    a = align(pair)
    schema = T.StructType([T.StructField("common_n", T.LongType()),
                           T.StructField("source_only", T.ArrayType(T.StringType())),
                           T.StructField("target_only", T.ArrayType(T.StringType())),
                           T.StructField("passed", T.BooleanType())])
    return _frame(pair, [(len(a.common), a.source_only, a.target_only, len(a.common) > 0)], schema)


def schema_type_parity(pair: TablePair) -> DataFrame:
    """Data type per common column (exact type equality, decimal precision/scale included)."""
    a = align(pair)
    rows = [(c, a.source_types[c].simpleString(), a.target_types[c].simpleString(),
             a.source_types[c] == a.target_types[c]) for c in a.common]
    schema = T.StructType([T.StructField("column_name", T.StringType()), T.StructField("source_type", T.StringType()),
                           T.StructField("target_type", T.StringType()), T.StructField("passed", T.BooleanType())])
    return _frame(pair, rows, schema)


def nullable_parity(pair: TablePair) -> DataFrame:
    """Nullability flag per common column."""
    a = align(pair)
    rows = [(c, a.source_nullable[c], a.target_nullable[c], a.source_nullable[c] == a.target_nullable[c]) for c in a.common]
    schema = T.StructType([T.StructField("column_name", T.StringType()), T.StructField("source_nullable", T.BooleanType()),
                           T.StructField("target_nullable", T.BooleanType()), T.StructField("passed", T.BooleanType())])
    return _frame(pair, rows, schema)


def pair_diagnosis(pair: TablePair, profile: PairProfile | None = None) -> DataFrame:
    """One summary row (row counts and difference, column counts, name lists). Always informational."""
    a = align(pair)
    p = profile or PairProfile(pair, [])
    arr = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    return p.wide.select(
        F.col("s_rows").alias("source_rows"), F.col("t_rows").alias("target_rows"),
        F.abs(F.col("s_rows") - F.col("t_rows")).alias("row_diff"),
        F.lit(len(pair.source.columns)).cast("bigint").alias("source_cols"),
        F.lit(len(pair.target.columns)).cast("bigint").alias("target_cols"),
        F.lit(len(a.common)).cast("bigint").alias("common_cols"),
        arr(a.source_only).alias("source_only"), arr(a.target_only).alias("target_only"))


def schema_profile(pair: TablePair, profile: PairProfile | None = None) -> DataFrame:
    """E3, E8-E10 in one row per common column: data type and declared nullability of both sides, and from
    the profile pass their rows and NULLs. ``nullable_ok``: a column declared not null holds none."""
    p = profile or PairProfile(pair)
    a = p.alignment
    cells = []
    for i, c in enumerate(p.columns):
        sn, tn = p.get("s", "nulls", i), p.get("t", "nulls", i)
        kept = F.lit(True)
        for nullable, n in ((a.source_nullable[c], sn), (a.target_nullable[c], tn)):
            kept = kept & (F.lit(nullable) | (n == 0))
        cells.append(F.struct(F.lit(c).alias("column_name"), F.lit(a.source_types[c].simpleString()).alias("source_type"), F.lit(a.target_types[c].simpleString()).alias("target_type"),
                              F.lit(a.source_types[c] == a.target_types[c]).alias("types_equal"), F.lit(a.source_nullable[c]).alias("source_nullable"),
                              F.lit(a.target_nullable[c]).alias("target_nullable"), F.col("s_rows").alias("source_rows"), F.col("t_rows").alias("target_rows"),
                              sn.alias("source_nulls"), tn.alias("target_nulls"), kept.alias("nullable_ok")))
    if not cells:
        return _frame(pair, [], "column_name string, source_type string, target_type string, types_equal boolean, source_nullable boolean, target_nullable boolean, "
                                "source_rows bigint, target_rows bigint, source_nulls bigint, target_nulls bigint, nullable_ok boolean")
    return p.wide.select(F.inline(F.array(*cells)))


def pair_samples(pair: TablePair, n: int = 5, column: str | None = None) -> DataFrame:
    """The ``n`` smallest values (NULLs last) of one common column per side.

    The first common column by name is used, so the sample repeats run to run. Each side
    is a top-k (per-partition top-n, then a merge), not a sort of the table.
    """
    a = align(pair)
    if not a.common and column is None:
        schema = T.StructType([T.StructField("side", T.StringType()), T.StructField("column_name", T.StringType()),
                               T.StructField("value", T.StringType())])
        return _frame(pair, [], schema)
    col = column or a.common[0]

    def side(df: DataFrame, name: str, dt: T.DataType) -> DataFrame:
        top = df.select(quote(col)).orderBy(F.col(quote(col)).asc_nulls_last()).limit(n)
        return top.select(F.lit(name).alias("side"), F.lit(col).alias("column_name"), display_text(F.col(quote(col)), dt).alias("value"))

    return side(pair.source, "source", a.source_types[col]).unionAll(side(pair.target, "target", a.target_types[col]))


def sample_texts(pair: TablePair, n: int = 5, column: str | None = None) -> DataFrame:
    """The samples of ``pair_samples`` as one row: column_name, source_sample, target_sample, values in their
    type's order with NULL last (9,10,NULL). Each side is a top-k, then one aggregate over at most ``n`` rows."""
    a = align(pair)
    col = column or a.common[0]

    def side(df: DataFrame, number: int, dt: T.DataType) -> DataFrame:
        top = df.select(F.col(quote(col)).alias("v")).orderBy(F.col("v").asc_nulls_last()).limit(n)
        ranked = top.select(F.row_number().over(Window.orderBy(F.col("v").asc_nulls_last())).alias("r"), F.coalesce(display_text(F.col("v"), dt), F.lit("NULL")).alias("text"))
        return ranked.select(F.lit(number).alias("side"), "r", "text")

    def joined(number: int) -> F.Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("side") == number, F.struct("r", "text")))), lambda x: x["text"]), ",")

    both = side(pair.source, 0, a.source_types[col]).unionAll(side(pair.target, 1, a.target_types[col]))
    return both.agg(joined(0).alias("source_sample"), joined(1).alias("target_sample")).select(F.lit(col).alias("column_name"), "source_sample", "target_sample")


def _unpivot(df: DataFrame, columns: list[str], side: int) -> DataFrame:
    """(side, ci, l, d, s) per cell: the typed exact key as flat columns, all NULL exactly when the cell is.
    Built as one SQL ``inline`` expression (one parse, no per-node JVM round trips)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = []
    for i, c in enumerate(columns):
        l, d, s = typed_key_sql(quote(c), types[c])
        cells.append(f"named_struct('ci', {i}, 'l', {l}, 'd', {d}, 's', {s})")
    return df.selectExpr(f"{side} AS side", f"inline(array({', '.join(cells)}))")


VALUE_KEY = ["ci", "l", "d", "s"]


def value_is_null() -> Column:
    return F.col("l").isNull() & F.col("d").isNull() & F.col("s").isNull()


def value_counts(pair: TablePair, columns: list[str] | None = None) -> DataFrame:
    """(ci, l, d, s, source_n, target_n): occurrences of every value of every column on both sides.

    Both sides are unpivoted to (column index, typed exact key) and grouped together, so a
    pair costs one shuffle whatever its width; map-side partial aggregation absorbs hot values.
    Keys stay flat primitive columns (no struct), which keeps the hash aggregation cheap.
    """
    cols = columns if columns is not None else align(pair).common
    cells = _unpivot(pair.source, cols, 0).unionAll(_unpivot(pair.target, cols, 1))
    return cells.groupBy(*VALUE_KEY).agg(F.count_if(F.col("side") == 0).alias("source_n"),
                                         F.count_if(F.col("side") == 1).alias("target_n"))


def _cells_by_kind(df: DataFrame, columns: list[str], side: int) -> dict[str, DataFrame]:
    """(side, ci, v) per cell, by the typed slot (l, d or s) that a column's key takes: v alone is the exact key."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cells: dict[str, list[str]] = {}
    for i, c in enumerate(columns):
        slot, key = next((n, k) for n, k in zip("lds", typed_key_sql(quote(c), types[c])) if not k.startswith("CAST(NULL AS"))
        cells.setdefault(slot, []).append(f"named_struct('ci', {i}, 'v', {key})")
    return {slot: df.selectExpr(f"{side} AS side", f"inline(array({', '.join(x)}))") for slot, x in cells.items()}


def _distinct_counts(pair: TablePair, cols: list[str]) -> DataFrame:
    """(ci, source_distinct, target_distinct): ``value_counts`` counted per column, grouped by kind of value, so that
    a key is two columns instead of four, and with the sides that hold a value (1, 2 or 3) as the only buffer. A
    column whose types drifted stands in two kinds, one a side."""
    kinds: dict[str, DataFrame] = {}
    for side, df in enumerate((pair.source, pair.target), 1):
        for slot, cells in _cells_by_kind(df, cols, side).items():
            kinds[slot] = kinds[slot].unionAll(cells) if slot in kinds else cells
    counts = [cells.groupBy("ci", "v").agg(F.bit_or("side").alias("sides")).groupBy("ci").agg(
        *[F.count_if(F.col("sides").bitwiseAND(bit) > 0).alias(name) for name, bit in (("source_distinct", 1), ("target_distinct", 2))]) for cells in kinds.values()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionAll(c)
    return out.groupBy("ci").agg(F.sum("source_distinct").alias("source_distinct"), F.sum("target_distinct").alias("target_distinct"))


def unique_value_parity(pair: TablePair) -> DataFrame:
    """Distinct values per common column, NULL counted as one value."""
    cols = align(pair).common
    schema = T.StructType([T.StructField("column_name", T.StringType()), T.StructField("source_distinct", T.LongType()),
                           T.StructField("target_distinct", T.LongType()), T.StructField("passed", T.BooleanType())])
    if not cols:
        return _frame(pair, [], schema)
    per_col = _distinct_counts(pair, cols)
    # A column with no value on either side (empty tables) has no group; the column list is
    # schema-sized, so it is broadcast and the counts default to 0.
    listing = _frame(pair, [(i, c) for i, c in enumerate(cols)], "ci int, column_name string")
    j = F.broadcast(listing).join(per_col, "ci", "left")
    s = F.coalesce(F.col("source_distinct"), F.lit(0).cast("bigint"))
    t = F.coalesce(F.col("target_distinct"), F.lit(0).cast("bigint"))
    return j.select("column_name", s.alias("source_distinct"), t.alias("target_distinct"), (s == t).alias("passed"))
