"""Row-level comparison.

The core is one counted grouping: both sides projected on the common columns, tagged,
and grouped by every column (for the verdicts alone, by a 128-bit digest of the row). One shuffle gives the multiset difference, duplicate
counts and the equality verdict; map-side partial aggregation collapses repeated rows
(a hot row value costs one row per map task). ``exceptAll`` stays as the readable
cross-check. The keyed diff groups both sides by key with fixed-width buffers and fetches
rows only for keys whose digests differ; a duplicated key never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.functions.types import comparable, is_floating
from paritas.functions.values import common_form, display_text, groupable, quote, sorted_maps
from paritas.operators.pair import TablePair, align
from paritas.session import reliable_checkpoint


#: Types whose hash is equal for equal group keys (floating ones after -0.0 is folded).
_PLAIN = (T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def _forms(df: DataFrame, cols: Sequence[str], other: DataFrame | None = None) -> list[Column]:
    """Columns ready for grouping against ``other``: maps as sorted entries, and a column whose
    type cannot be compared with the other side's (e.g. string vs number) as display text, so
    the union never casts data (an ANSI cast would fail on bad values)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    others = {f.name: f.dataType for f in other.schema.fields} if other is not None else types
    return [groupable(F.col(quote(c)), types[c], c) if comparable(types[c], others[c]) else common_form(F.col(quote(c)), types[c], others[c]).alias(c)
            for c in cols]


def _projected(df: DataFrame, cols: Sequence[str], other: DataFrame | None = None) -> DataFrame:
    return df.select(*_forms(df, cols, other))


def counted_rows(pair: TablePair, columns: Sequence[str] | None = None) -> DataFrame:
    """Every distinct row over the common columns with its count on each side: cols…, source_n, target_n."""
    cols = list(columns) if columns is not None else align(pair).common
    s = _projected(pair.source, cols, pair.target).withColumn("_side", F.lit(0))
    t = _projected(pair.target, cols, pair.source).withColumn("_side", F.lit(1))
    return (s.unionByName(t)
            .groupBy(*cols)
            .agg(F.count_if(F.col("_side") == 0).alias("source_n"), F.count_if(F.col("_side") == 1).alias("target_n")))


def multiset_diff(pair: TablePair, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose multiplicity differs: cols…, side ('source' = only/more in source), n (surplus)."""
    cols = list(columns) if columns is not None else align(pair).common
    counted = counted_rows(pair, cols)
    delta = F.col("source_n") - F.col("target_n")
    return (counted.filter(delta != 0)
            .select(*cols, F.when(delta > 0, F.lit("source")).otherwise(F.lit("target")).alias("side"),
                    F.abs(delta).alias("n")))


def multiset_diff_except(pair: TablePair, columns: Sequence[str] | None = None) -> DataFrame:
    """Same result as ``multiset_diff`` from two ``exceptAll`` (two shuffles); used as a cross-check."""
    cols = list(columns) if columns is not None else align(pair).common
    s, t = _projected(pair.source, cols, pair.target), _projected(pair.target, cols, pair.source)
    only_s = s.exceptAll(t).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("source"))
    only_t = t.exceptAll(s).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("target"))
    return only_s.unionByName(only_t).select(*cols, "side", "n")


def _digest_counts(pair: TablePair, cols: Sequence[str]) -> DataFrame:
    """``counted_rows`` with a 128-bit digest of the row in place of its columns, where every column has a plain
    type: 16 bytes a row are grouped and shuffled, whatever its width. Types that a hash tells apart otherwise
    than a grouping does (nested ones, collated strings) take the columns themselves."""
    both = (_projected(pair.source, cols, pair.target).withColumn("_side", F.lit(0))
            .unionByName(_projected(pair.target, cols, pair.source).withColumn("_side", F.lit(1))))
    types = {f.name: f.dataType for f in both.schema.fields}
    if not all(isinstance(types[c], _PLAIN) or types[c] == T.StringType() for c in cols):
        return counted_rows(pair, cols)
    # a hash skips nulls, so null flags go in; adding 0 folds -0.0 into 0.0 as a grouping does
    cell = lambda c: F.col(quote(c)) + F.lit(0).cast(types[c]) if is_floating(types[c]) else F.col(quote(c))
    parts = [p for c in cols for p in (F.col(quote(c)).isNull(), cell(c))]
    return (both.select("_side", *[F.xxhash64(F.lit(d), *parts).alias(f"_d{d}") for d in range(2)]).groupBy("_d0", "_d1")
            .agg(F.count_if(F.col("_side") == 0).alias("source_n"), F.count_if(F.col("_side") == 1).alias("target_n")))


def diff_summary(pair: TablePair, columns: Sequence[str] | None = None) -> DataFrame:
    """One row from the counted grouping, by row digests: surplus per side, distinct and duplicate rows per side."""
    counted = _digest_counts(pair, list(columns) if columns is not None else align(pair).common)
    s, t = F.col("source_n"), F.col("target_n")
    return counted.agg(
        F.coalesce(F.sum(F.greatest(s - t, F.lit(0))), F.lit(0)).cast("bigint").alias("missing"),
        F.coalesce(F.sum(F.greatest(t - s, F.lit(0))), F.lit(0)).cast("bigint").alias("extra"),
        F.coalesce(F.sum(s), F.lit(0)).cast("bigint").alias("source_rows"),
        F.coalesce(F.sum(t), F.lit(0)).cast("bigint").alias("target_rows"),
        F.count_if(s > 0).alias("source_distinct"),
        F.count_if(t > 0).alias("target_distinct"))


def duplicate_row_parity(pair: TablePair) -> DataFrame:
    """(rows − distinct rows) over the common columns, both sides, from one grouping."""
    if not align(pair).common:
        return _empty(pair, "source_dups bigint, target_dups bigint, passed boolean")
    d = diff_summary(pair)
    sd = F.col("source_rows") - F.col("source_distinct")
    td = F.col("target_rows") - F.col("target_distinct")
    return d.select(sd.alias("source_dups"), td.alias("target_dups"), (sd == td).alias("passed"))


def frame_equal(pair: TablePair) -> DataFrame:
    """E5-E7 as three verdict rows over the common columns (Spark tables are unordered, so
    equality is multiset equality): ``general`` ignores nullability, ``schema_adherence`` and
    ``ignore_row_order`` also require equal nullability. Types must match in every mode."""
    a = align(pair)
    if not a.common:
        return _empty(pair, "mode string, missing bigint, extra bigint, types_equal boolean, nullable_equal boolean, passed boolean")
    types_equal = all(a.source_types[c] == a.target_types[c] for c in a.common)
    nullable_equal = all(a.source_nullable[c] == a.target_nullable[c] for c in a.common)
    d = diff_summary(pair)
    rows_equal = (F.col("missing") == 0) & (F.col("extra") == 0)
    modes = F.array(
        F.struct(F.lit("general").alias("mode"), F.lit(False).alias("needs_nullable")),
        F.struct(F.lit("schema_adherence").alias("mode"), F.lit(True).alias("needs_nullable")),
        F.struct(F.lit("ignore_row_order").alias("mode"), F.lit(True).alias("needs_nullable")))
    return (d.select("missing", "extra", F.inline(modes))
            .select("mode", "missing", "extra", F.lit(types_equal).alias("types_equal"),
                    F.lit(nullable_equal).alias("nullable_equal"),
                    (rows_equal & F.lit(types_equal) & (~F.col("needs_nullable") | F.lit(nullable_equal))).alias("passed")))


def _digest_parts(c: str, dt: T.DataType) -> list[Column]:
    """What a row digest hashes for one column: a hash skips nulls, so the null flag is a part of its own,
    and nested values, where it would skip nulls inside, go in as JSON."""
    nested = isinstance(dt, (T.ArrayType, T.StructType, T.MapType))
    return [F.col(c).isNull(), F.to_json(F.col(c), {"ignoreNullFields": "false"}) if nested else F.col(c)]


def _same_keys(left: str, right: str, n: int) -> Column:
    out = F.lit(True)
    for i in range(n):
        out &= F.col(f"{left}._k{i}").eqNullSafe(F.col(f"{right}._k{i}"))
    return out


def key_counts(pair: TablePair, keys: Sequence[str], vals: Sequence[str]) -> DataFrame:
    """Every key of either side (``_k0``…, in the form that both sides share): rows per side ``s_n, t_n``, and
    ``differs``: it stands once on each side, with different 128-bit digests of the row. One grouping of the
    stacked sides over fixed-width buffers, so a hash aggregation; no row is shuffled."""
    n = len(keys)

    def side(df: DataFrame, other: DataFrame, number: int) -> DataFrame:
        shared = _projected(df, [*keys, *vals], other)
        names = [f"_k{i}" for i in range(n)] + [f"_v{i}" for i in range(len(vals))]
        return shared.toDF(*names).withColumn("_side", F.lit(number))

    both = side(pair.source, pair.target, 0).unionByName(side(pair.target, pair.source, 1))
    types = {f.name: f.dataType for f in both.schema.fields}
    parts = [p for i in range(len(vals)) for p in _digest_parts(f"_v{i}", types[f"_v{i}"])]
    knames = [f"_k{i}" for i in range(n)]
    buffers = []
    for number, tag in enumerate("st"):
        mine = F.col("_side") == number
        buffers.append(F.count_if(mine).alias(f"{tag}_n"))
        buffers += [F.max(F.when(mine, F.col(f"_d{d}"))).alias(f"{tag}_d{d}") for d in range(2)]
    counted = both.select(*knames, "_side", *[F.xxhash64(F.lit(d), *parts).alias(f"_d{d}") for d in range(2)]).groupBy(*knames).agg(*buffers)
    same = (F.col("s_d0") == F.col("t_d0")) & (F.col("s_d1") == F.col("t_d1"))
    return counted.select(*knames, "s_n", "t_n", ((F.col("s_n") == 1) & (F.col("t_n") == 1) & ~same).alias("differs"))


def keyed_diff(pair: TablePair, keys: Sequence[str] | None = None) -> DataFrame:
    """E5 with keys: one row per difference: keys…, column_name, source_value, target_value, change.

    change ∈ missing (key only in source) · extra (only in target) · changed (per column) ·
    duplicate_key (key repeated on a side; values show the counts, the rows are not paired).
    NULL keys match NULL keys, of any type; a key whose types drifted is compared and shown in the
    common form, a map as its sorted entries. Values are rendered as text after a native null-safe compare.

    One grouping by key finds the keys that differ (``key_counts``), which are checkpointed: few rows of
    a pair that is nearly equal. Rows are read again only for keys with different digests, by a
    semi join with those keys, and not at all when there are none; equal values of different digests (-0.0 and 0.0) drop out there.
    """
    a = align(pair)
    keys = list(keys or pair.keys)
    if not keys:
        raise ValueError("keyed_diff needs key columns")
    vals = [c for c in a.common if c not in keys]
    n, knames = len(keys), [f"_k{i}" for i in range(len(keys))]
    counted = key_counts(pair, keys, vals)
    types = {f.name: f.dataType for f in counted.schema.fields}
    unequal = reliable_checkpoint(counted.filter(F.col("differs") | (F.col("s_n") != 1) | (F.col("t_n") != 1)))

    nul = F.lit(None).cast("string")
    twice = (F.col("s_n") > 0) & (F.col("t_n") > 0)
    whole = unequal.filter(~F.col("differs")).select(
        *[F.col(k).alias(name) for k, name in zip(knames, keys)], nul.alias("column_name"),
        F.when(twice, F.col("s_n").cast("string")).alias("source_value"), F.when(twice, F.col("t_n").cast("string")).alias("target_value"),
        F.when(F.col("t_n") == 0, "missing").when(F.col("s_n") == 0, "extra").otherwise("duplicate_key").alias("change"))
    suspects = unequal.filter("differs").select(*knames)
    if not vals or suspects.isEmpty():
        return whole

    def rows(df: DataFrame, other: DataFrame, name: str) -> DataFrame:
        key = [form.cast(types[k]).alias(k) for k, form in zip(knames, _forms(df, keys, other))]
        keyed = df.select(*key, F.struct(*[F.col(quote(c)).alias(c) for c in vals]).alias("_row"))
        return keyed.alias(name).join(suspects.alias("want"), _same_keys(name, "want", n), "left_semi").alias(name)

    paired = rows(pair.source, pair.target, "s").join(rows(pair.target, pair.source, "t"), _same_keys("s", "t", n))

    def changed(c: str) -> Column:
        st, tt = a.source_types[c], a.target_types[c]
        sv, tv = F.col("s._row").getField(c), F.col("t._row").getField(c)
        forms = (sorted_maps(sv, st), sorted_maps(tv, tt)) if comparable(st, tt) else (common_form(sv, st, tt), common_form(tv, tt, st))
        return F.when(~forms[0].eqNullSafe(forms[1]), F.struct(F.lit(c).alias("column_name"), display_text(sv, st).alias("source_value"),
                                                              display_text(tv, tt).alias("target_value"), F.lit("changed").alias("change")))

    found = F.filter(F.array(*[changed(c) for c in vals]), lambda x: x.isNotNull())
    return whole.unionByName(paired.select(*[F.col(f"s.{k}").alias(name) for k, name in zip(knames, keys)], F.inline(found)))


#: Columns that do not decide whether a metadata row stands on both sides.
IGNORED = ("database_name", "foreign_key_name", "referenced_object_id")


def unique_to_one_side(first: DataFrame, second: DataFrame, first_name: str, second_name: str,
                       ignore_cols: Sequence[str] = IGNORED,
                       null_keys: str = "drop") -> DataFrame:
    """stack two frames by column name (missing columns → NULL), tag each with
    ``database_name``, keep rows whose group over all non-ignored columns has exactly one row.

    A row repeated within one side is dropped too. ``null_keys='drop'`` also drops rows with a
    NULL in a group column (the reference's grouping gives them no size); ``'match'`` groups
    NULLs together.
    """
    ft = {f.name: f.dataType for f in first.schema.fields}
    st = {f.name: f.dataType for f in second.schema.fields}
    clash = [c for c in ft if c in st and not comparable(ft[c], st[c])]
    for c in clash:  # incomparable types stack as text (a union would cast data)
        first = first.withColumn(c, common_form(F.col(c), ft[c], st[c]))
        second = second.withColumn(c, common_form(F.col(c), st[c], ft[c]))
    a = first.withColumn("database_name", F.lit(first_name))
    b = second.withColumn("database_name", F.lit(second_name))
    merged = a.unionByName(b, allowMissingColumns=True)
    group_cols = [c for c in merged.columns if c not in set(ignore_cols)]
    if null_keys == "drop":
        no_null = None
        for c in group_cols:
            e = F.col(c).isNotNull()
            no_null = e if no_null is None else no_null & e
        if no_null is not None:
            merged = merged.filter(no_null)
    elif null_keys != "match":
        raise ValueError("null_keys must be 'drop' or 'match'")
    # Group sizes come from one grouped aggregate (partial aggregation collapses a hot group
    # map-side); the side of a size-one group is recovered from a fixed-width count.
    others = [c for c in merged.columns if c in set(ignore_cols) and c != "database_name"]
    sized = merged.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("_size"),
        F.count_if(F.col("database_name") == F.lit(first_name)).alias("_first"),
        *[F.first(c).alias(c) for c in others])
    return (sized.filter(F.col("_size") == 1)
            .withColumn("database_name", F.when(F.col("_first") == 1, F.lit(first_name)).otherwise(F.lit(second_name)))
            .select(*merged.columns))


def _empty(pair: TablePair, ddl: str) -> DataFrame:
    return pair.source.sparkSession.createDataFrame([], T._parse_datatype_string(ddl))
