"""Column profiles in one pass per side.

Shape: every metric of every column of a side is one aggregate expression of a single
global ``agg`` (map-side partial aggregation, one final merge of one row per task).
The two one-row side results are stacked and merged by a one-row aggregate, so a pair
profile is one job and no join. Long form comes from ``inline(array(struct ...))`` over
that single row. Comparisons are native (``eqNullSafe``); values become text last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.functions.types import comparable, is_floating, is_numeric, is_orderable, is_string, is_temporal
from paritas.functions.values import common_form, exact_number_sql, display_sql, display_text, quote
from paritas.operators.pair import TablePair, align


def _metric_sql(c: str, dt: T.DataType) -> dict[str, str]:
    """Aggregate SQL text per metric for column expression ``c`` of type ``dt``."""
    out = {"nulls": f"count_if({c} IS NULL)"}
    if is_floating(dt):
        out["nans"] = f"count_if(isnan({c}))"
    if is_orderable(dt) and not is_string(dt):
        out["min"] = f"min({c})"
        out["max"] = f"max({c})"
    if is_string(dt):
        out["min_len"] = f"min(length({c}))"
        out["max_len"] = f"max(length({c}))"
    if is_numeric(dt):
        out["mean"] = f"CAST(avg({c}) AS DOUBLE)"
        out["stddev"] = f"CAST(stddev_samp({c}) AS DOUBLE)"
    return out


def _name(tag: str, metric: str, i: int) -> str:
    return f"{tag}_{metric}_{i}"


def _side_agg(df: DataFrame, columns: Sequence[str], tag: str) -> tuple[list[str], dict[tuple[str, int], T.DataType]]:
    """Every metric of every column as ``expr AS name`` SQL text; ``df.selectExpr(*exprs)`` is one
    global aggregate, parsed in one call (Column objects would cost JVM round trips per node)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = [f"count(1) AS {tag}_rows"]
    produced: dict[tuple[str, int], T.DataType] = {}
    for i, name in enumerate(columns):
        for metric, e in _metric_sql(quote(name), types[name]).items():
            exprs.append(f"{e} AS {_name(tag, metric, i)}")
            produced[(metric, i)] = types[name]
    return exprs, produced


class PairProfile:
    """One-row profile of both sides of a pair over the common columns.

    ``wide`` is the single row; cache it when several checks read it (it is tiny).
    """

    def __init__(self, pair: TablePair, columns: Sequence[str] | None = None):
        self.pair = pair
        self.alignment = align(pair)
        self.columns = list(columns) if columns is not None else self.alignment.common
        s_exprs, self._s = _side_agg(pair.source, self.columns, "s")
        t_exprs, self._t = _side_agg(pair.target, self.columns, "t")
        s_row = pair.source.selectExpr(*s_exprs)
        t_row = pair.target.selectExpr(*t_exprs)
        stacked = s_row.unionByName(t_row, allowMissingColumns=True)
        # Each output column is non-null in at most one of the two stacked rows.
        self.wide = stacked.selectExpr(*[f"max({c}) AS {c}" for c in stacked.columns])

    def has(self, tag: str, metric: str, i: int) -> bool:
        return (metric, i) in (self._s if tag == "s" else self._t)

    def get(self, tag: str, metric: str, i: int) -> Column:
        if self.has(tag, metric, i):
            return F.col(_name(tag, metric, i))
        return F.lit(None)

    def sql(self, tag: str, metric: str, i: int) -> str:
        """SQL text for a metric of ``wide`` (``NULL`` when the metric does not apply)."""
        return _name(tag, metric, i) if self.has(tag, metric, i) else "NULL"

    def pair_values_sql(self, i: int, metric: str) -> tuple[str, str, str]:
        """SQL text of ``_pair_values``: (source text, target text, equal), native compare when types allow."""
        name = self.columns[i]
        st, tt = self.alignment.source_types[name], self.alignment.target_types[name]
        s, t = self.sql("s", metric, i), self.sql("t", metric, i)
        s_txt = display_sql(s, st) if s != "NULL" else "CAST(NULL AS STRING)"
        t_txt = display_sql(t, tt) if t != "NULL" else "CAST(NULL AS STRING)"
        if s != "NULL" and t != "NULL" and comparable(st, tt):
            return s_txt, t_txt, f"({s} <=> {t})"
        if s != "NULL" and t != "NULL" and is_numeric(st) and is_numeric(tt):
            return s_txt, t_txt, f"({exact_number_sql(s, st)} <=> {exact_number_sql(t, tt)})"
        return s_txt, t_txt, f"({s_txt} <=> {t_txt})"

    def index(self, column: str) -> int:
        return self.columns.index(column)

    # -- long-form builders -------------------------------------------------

    def _long(self, structs: list[Column], schema: T.StructType) -> DataFrame:
        if not structs:
            return self.wide.sparkSession.createDataFrame([], schema)
        return self.wide.select(F.inline(F.array(*structs)))

    def row_counts(self) -> DataFrame:
        return self.wide.select(
            F.col("s_rows").alias("source_rows"), F.col("t_rows").alias("target_rows"),
            F.col("s_rows").eqNullSafe(F.col("t_rows")).alias("passed"))

    def null_counts(self) -> DataFrame:
        structs = []
        for i, name in enumerate(self.columns):
            s, t = self.get("s", "nulls", i), self.get("t", "nulls", i)
            structs.append(F.struct(F.lit(name).alias("column_name"), s.cast("bigint").alias("source_nulls"),
                                    t.cast("bigint").alias("target_nulls"), s.eqNullSafe(t).alias("passed")))
        schema = T.StructType([T.StructField("column_name", T.StringType()), T.StructField("source_nulls", T.LongType()),
                               T.StructField("target_nulls", T.LongType()), T.StructField("passed", T.BooleanType())])
        return self._long(structs, schema)

    def _pair_values(self, i: int, metric: str) -> tuple[Column, Column, Column]:
        """(source text, target text, equal) for one metric, compared natively when types allow."""
        name = self.columns[i]
        st, tt = self.alignment.source_types[name], self.alignment.target_types[name]
        s, t = self.get("s", metric, i), self.get("t", metric, i)
        s_txt = display_text(s, st) if self.has("s", metric, i) else F.lit(None).cast("string")
        t_txt = display_text(t, tt) if self.has("t", metric, i) else F.lit(None).cast("string")
        if self.has("s", metric, i) and self.has("t", metric, i) and comparable(st, tt):
            eq = s.eqNullSafe(t)
        elif self.has("s", metric, i) and self.has("t", metric, i):
            eq = common_form(s, st, tt).eqNullSafe(common_form(t, tt, st))
        else:
            eq = s_txt.eqNullSafe(t_txt)
        return s_txt, t_txt, eq

    def ranges(self, kind: str) -> DataFrame:
        """min/max per common column whose *source* type is of ``kind`` (numeric | temporal | string-length)."""
        pick = {"numeric": is_numeric, "temporal": is_temporal, "length": is_string}[kind]
        lo, hi = ("min_len", "max_len") if kind == "length" else ("min", "max")
        structs = []
        for i, name in enumerate(self.columns):
            if not pick(self.alignment.source_types[name]):
                continue
            s_lo, t_lo, eq_lo = self._pair_values(i, lo)
            s_hi, t_hi, eq_hi = self._pair_values(i, hi)
            structs.append(F.struct(F.lit(name).alias("column_name"), s_lo.alias("source_min"), t_lo.alias("target_min"),
                                    s_hi.alias("source_max"), t_hi.alias("target_max"), (eq_lo & eq_hi).alias("passed")))
        schema = T.StructType([T.StructField("column_name", T.StringType())] +
                              [T.StructField(n, T.StringType()) for n in ("source_min", "target_min", "source_max", "target_max")] +
                              [T.StructField("passed", T.BooleanType())])
        return self._long(structs, schema)


def null_count_parity(pair: TablePair, profile: PairProfile | None = None) -> DataFrame:
    """Null count per common column, both sides, one pass."""
    return (profile or PairProfile(pair)).null_counts()


def row_count_parity(pair: TablePair, profile: PairProfile | None = None) -> DataFrame:
    """Row counts of both sides."""
    return (profile or PairProfile(pair, [])).row_counts()


def numeric_range_parity(pair: TablePair, profile: PairProfile | None = None) -> DataFrame:
    """Min and max per common numeric column (numeric on the source), native compare."""
    return (profile or PairProfile(pair)).ranges("numeric")


def string_length_parity(pair: TablePair, profile: PairProfile | None = None) -> DataFrame:
    """Min and max character length per common string column."""
    return (profile or PairProfile(pair)).ranges("length")


def date_range_parity(pair: TablePair, profile: PairProfile | None = None) -> DataFrame:
    """Min and max per common date/timestamp column."""
    return (profile or PairProfile(pair)).ranges("temporal")


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One-side profile in one pass: rows, nulls, NaNs, min, max (as text), lengths, mean, stddev."""
    cols = list(columns) if columns is not None else list(df.columns)
    exprs, produced = _side_agg(df, cols, "s")
    wide = df.selectExpr(*exprs)
    types = {f.name: f.dataType for f in df.schema.fields}

    def m(metric: str, i: int, cast: str | None = None) -> Column:
        if (metric, i) not in produced:
            return F.lit(None).cast(cast or "string")
        c = F.col(_name("s", metric, i))
        return c.cast(cast) if cast else display_text(c, types[cols[i]])

    structs = [F.struct(F.lit(n).alias("column_name"), F.col("s_rows").alias("rows"), m("nulls", i, "bigint").alias("nulls"),
                        m("nans", i, "bigint").alias("nans"), m("min", i).alias("min"), m("max", i).alias("max"),
                        m("min_len", i, "int").alias("min_len"), m("max_len", i, "int").alias("max_len"),
                        m("mean", i, "double").alias("mean"), m("stddev", i, "double").alias("stddev"))
               for i, n in enumerate(cols)]
    return wide.select(F.inline(F.array(*structs)))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample stddev, min, max per numeric column; values as double for one long form."""
    cols = [n for n in (columns or df.columns) if is_numeric(df.schema[n].dataType)]
    aggs = []
    for i, n in enumerate(cols):
        c = F.col(n)
        aggs += [F.count(c).alias(f"n_{i}"), F.avg(c).cast("double").alias(f"mean_{i}"),
                 F.stddev_samp(c).cast("double").alias(f"sd_{i}"),
                 F.min(c).cast("double").alias(f"min_{i}"), F.max(c).cast("double").alias(f"max_{i}")]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(n).alias("column_name"), F.col(f"n_{i}").alias("n"), F.col(f"mean_{i}").alias("mean"),
                        F.col(f"sd_{i}").alias("sd"), F.col(f"min_{i}").alias("min"), F.col(f"max_{i}").alias("max"))
               for i, n in enumerate(cols)]
    return wide.select(F.inline(F.array(*structs)))
