"""Declared-constraint checks on data.

Shapes chosen for skew: every key check starts with ``groupBy(key).count()`` (partial
aggregation collapses a hot key map-side before the shuffle); orphan detection groups
the child by FK value *before* the anti join, so the join sees one row per distinct
value; parent keys are de-duplicated, which the anti join then reuses as its
partitioning. Several unique constraints of one table share one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.functions.types import comparable, is_floating
from paritas.functions.values import common_form, canonical_text, display_text
from paritas.operators.pair import TablePair


@dataclass(frozen=True)
class Key:
    table: str
    columns: tuple[str, ...]
    name: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    name: str
    child: str
    child_columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def _all(preds: list[Column]) -> Column:
    out = F.lit(True)
    for p in preds:
        out = out & p
    return out


def _no_null(cols: Sequence[str]) -> Column:
    return _all([F.col(c).isNotNull() for c in cols])


def key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """cols…, n: multiplicity of every key value (NULL is a value)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def pk_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """H1: total_rows, distinct key combinations, violations (= rows − distinct), duplicated combinations."""
    kc = key_counts(df, columns)
    out = kc.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
                 F.count(F.lit(1)).alias("distinct_keys"),
                 F.count_if(F.col("n") > 1).alias("dup_keys"))
    return out.select("total_rows", "distinct_keys", (F.col("total_rows") - F.col("distinct_keys")).alias("violations"), "dup_keys",
                      (F.col("total_rows") == F.col("distinct_keys")).alias("passed"))


def pk_duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every duplicated key combination with its count (``HAVING count > 1``)."""
    return key_counts(df, columns).filter(F.col("n") > 1)


def pk_samples(df: DataFrame, columns: Sequence[str], limit: int = 10) -> DataFrame:
    """The ``limit`` most repeated key combinations (ties by key), a top-k report."""
    order = [F.col("n").desc()] + [F.col(c).asc_nulls_last() for c in columns]
    return pk_duplicates(df, columns).orderBy(*order).limit(limit)


def pk_parity(pair: TablePair, keys: Sequence[str] | None = None) -> DataFrame:
    """Primary-key uniqueness on both sides (key columns must exist on both)."""
    keys = list(keys or pair.keys)
    s = pk_violations(pair.source, keys).withColumn("side", F.lit("source"))
    t = pk_violations(pair.target, keys).withColumn("side", F.lit("target"))
    return s.unionByName(t).select("side", "total_rows", "distinct_keys", "violations", "dup_keys", "passed")


def _key_text(df: DataFrame, cols: Sequence[str]) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    if len(cols) == 1:
        return canonical_text(F.col(cols[0]), types[cols[0]])
    return F.to_json(F.array(*[canonical_text(F.col(c), types[c]) for c in cols]))


def unique_violations(df: DataFrame, constraints: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per unique constraint (ordered column list): rows with no NULL key column,
    distinct such keys, violations (= rows − distinct) and duplicated values. NULLs never
    violate. All constraints are unpivoted into one grouping: one shuffle for the table."""
    names = list(constraints)
    cells = F.array(*[F.when(_no_null(constraints[n]), F.struct(F.lit(i).alias("ci"), _key_text(df, constraints[n]).alias("k")))
                      for i, n in enumerate(names)])
    keyed = df.select(F.explode(cells).alias("c")).filter(F.col("c").isNotNull()).select("c.ci", "c.k")
    counts = keyed.groupBy("ci", "k").agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy("ci").agg(F.sum("n").cast("bigint").alias("non_null_rows"),
                                   F.count(F.lit(1)).alias("distinct_values"),
                                   F.count_if(F.col("n") > 1).alias("dup_values"))
    # Constraints whose rows are all NULL produce no group; the constraint list is tiny.
    spark = df.sparkSession
    listing = spark.createDataFrame([(i, n, list(constraints[n])) for i, n in enumerate(names)],
                                    "ci int, constraint_name string, columns array<string>")
    j = F.broadcast(listing).join(per, "ci", "left")
    rows = F.coalesce(F.col("non_null_rows"), F.lit(0).cast("bigint"))
    distinct = F.coalesce(F.col("distinct_values"), F.lit(0).cast("bigint"))
    return j.select("constraint_name", "columns", rows.alias("non_null_rows"), distinct.alias("distinct_values"),
                    (rows - distinct).alias("violations"), F.coalesce(F.col("dup_values"), F.lit(0).cast("bigint")).alias("dup_values"),
                    (rows == distinct).alias("passed"))


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per declared not-null column, NULLs and (float/double only) NaNs, in one pass."""
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for i, c in enumerate(columns):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"nul_{i}"))
        aggs.append(F.count_if(F.isnan(F.col(c))).alias(f"nan_{i}") if is_floating(types[c]) else F.lit(0).cast("bigint").alias(f"nan_{i}"))
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"nul_{i}").alias("nulls"), F.col(f"nan_{i}").alias("nans"),
                        (F.col(f"nul_{i}") + F.col(f"nan_{i}")).alias("violations"),
                        ((F.col(f"nul_{i}") + F.col(f"nan_{i}")) == 0).alias("passed"))
               for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*structs)))


def _parent_keys(parent: DataFrame, parent_cols: Sequence[str]) -> DataFrame:
    """Distinct parent key values renamed to ``_p{i}`` (dedupe map-side; the anti join reuses the partitioning)."""
    return parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(parent_cols)]).distinct()


def _anti(child_keys: DataFrame, parent: DataFrame, child_cols: Sequence[str], parent_cols: Sequence[str]) -> DataFrame:
    if len(child_cols) != len(parent_cols):
        raise ValueError("foreign key column lists differ in length")
    pk = _parent_keys(parent, parent_cols)
    ct = {f.name: f.dataType for f in child_keys.schema.fields}
    pt = {f.name: f.dataType for f in pk.schema.fields}
    preds = []
    for i, c in enumerate(child_cols):
        cv, pv = F.col(c), F.col(f"_p{i}")
        if comparable(ct[c], pt[f"_p{i}"]):
            preds.append(cv == pv)
        else:  # match on exact or display text, never cast data
            preds.append(common_form(cv, ct[c], pt[f"_p{i}"]) == common_form(pv, pt[f"_p{i}"], ct[c]))
    return child_keys.join(pk, _all(preds), "left_anti")


def fk_missing_values(child: DataFrame, parent: DataFrame, child_cols: Sequence[str], parent_cols: Sequence[str]) -> DataFrame:
    """Distinct non-NULL child key values with no parent row."""
    keys = child.select(*child_cols).filter(_no_null(child_cols)).distinct()
    return _anti(keys, parent, child_cols, parent_cols)


def fk_missing(child: DataFrame, parent: DataFrame, fks: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """H7: per FK name, the number of distinct non-NULL child values missing from the parent."""
    parts = []
    for name, (ccols, pcols) in fks.items():
        m = fk_missing_values(child, parent, ccols, pcols).agg(F.count(F.lit(1)).alias("missing_values"))
        parts.append(m.select(F.lit(name).alias("constraint_name"), "missing_values",
                              (F.col("missing_values") == 0).alias("passed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fk_missing_samples(child: DataFrame, parent: DataFrame, child_cols: Sequence[str], parent_cols: Sequence[str],
                       limit: int = 10) -> DataFrame:
    """H7/H9 report: the ``limit`` smallest missing values (a top-k report, per-partition top-k then merge)."""
    return fk_missing_values(child, parent, child_cols, parent_cols).orderBy(*[F.col(c).asc() for c in child_cols]).limit(limit)


def self_reference_missing(df: DataFrame, id_cols: Sequence[str], ref_cols: Sequence[str]) -> DataFrame:
    """Distinct non-NULL reference values with no row of the same table carrying that id."""
    return fk_missing_values(df, df, ref_cols, id_cols)


def orphan_groups(child: DataFrame, parent: DataFrame, child_cols: Sequence[str], parent_cols: Sequence[str],
                  null_fk: str = "orphan") -> DataFrame:
    """Child FK values without a parent, with their row count: child cols…, orphaned_count.

    ``null_fk='orphan'`` (the reference) reports NULL FK values as orphan groups, as the
    left-join-IS-NULL form does; ``'ignore'`` applies the SQL rule (a NULL column exempts the row).
    """
    src = child.select(*child_cols)
    if null_fk == "ignore":
        src = src.filter(_no_null(child_cols))
    elif null_fk != "orphan":
        raise ValueError("null_fk must be 'orphan' or 'ignore'")
    grouped = src.groupBy(*child_cols).agg(F.count(F.lit(1)).alias("orphaned_count"))
    return _anti(grouped, parent, child_cols, parent_cols)


def orphan_records(child: DataFrame, parent: DataFrame, fk: ForeignKey, null_fk: str = "orphan") -> DataFrame:
    """DM7 record form: child_table, foreign_key_name, foreign_key_columns, orphaned_values (map), orphaned_count."""
    g = orphan_groups(child, parent, fk.child_columns, fk.parent_columns, null_fk)
    values = F.create_map(*[x for c in fk.child_columns for x in (F.lit(c), F.col(c).cast("string"))])
    return g.select(F.lit(fk.child).alias("child_table"), F.lit(fk.name).alias("foreign_key_name"),
                    F.array(*[F.lit(c) for c in fk.child_columns]).alias("foreign_key_columns"),
                    values.alias("orphaned_values"), F.col("orphaned_count"))


def orphan_total(orphans: DataFrame) -> DataFrame:
    """H6: total orphaned rows (0 when there are none)."""
    return orphans.agg(F.coalesce(F.sum("orphaned_count"), F.lit(0)).cast("bigint").alias("total_orphans"))


def integrity_report(table: str, df: DataFrame, outgoing: Sequence[tuple[ForeignKey, DataFrame]],
                     incoming: Sequence[tuple[ForeignKey, DataFrame]], null_fk: str = "orphan") -> DataFrame:
    """H8/H9: one row per FK touching ``table``: outgoing FKs count distinct missing parent values
    (H7 rule), incoming FKs count orphaned child rows (H5 rule); passed when zero."""
    parts = []
    for fk, parent in outgoing:
        m = fk_missing_values(df, parent, fk.child_columns, fk.parent_columns).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(m.select(F.lit("outgoing").alias("direction"), F.lit(fk.name).alias("constraint_name"),
                              F.lit(fk.child).alias("child_table"), F.lit(fk.parent).alias("parent_table"), "violations"))
    for fk, child in incoming:
        m = orphan_total(orphan_groups(child, df, fk.child_columns, fk.parent_columns, null_fk))
        parts.append(m.select(F.lit("incoming").alias("direction"), F.lit(fk.name).alias("constraint_name"),
                              F.lit(fk.child).alias("child_table"), F.lit(fk.parent).alias("parent_table"),
                              F.col("total_orphans").alias("violations")))
    if not parts:
        return df.sparkSession.createDataFrame([], "direction string, constraint_name string, child_table string, "
                                                   "parent_table string, violations bigint, passed boolean")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("violations") == 0)


def fk_parity(pair: TablePair, fk_columns: Sequence[str]) -> DataFrame:
    """Per FK column, NULL count and distinct count (NULL counted once) on both sides.

    Both metrics come from the pair's unpivoted value counts (one shuffle)."""
    from paritas.operators.parity import value_counts, value_is_null
    cols = list(fk_columns)
    vc = value_counts(pair, cols)
    per = vc.groupBy("ci").agg(
        F.coalesce(F.sum(F.when(value_is_null(), F.col("source_n"))), F.lit(0)).cast("bigint").alias("s_nulls"),
        F.coalesce(F.sum(F.when(value_is_null(), F.col("target_n"))), F.lit(0)).cast("bigint").alias("t_nulls"),
        F.count_if(F.col("source_n") > 0).alias("s_distinct"), F.count_if(F.col("target_n") > 0).alias("t_distinct"))
    names = F.array(*[F.lit(c) for c in cols])
    metrics = F.array(
        F.struct(F.lit("nulls").alias("metric"), F.col("s_nulls").alias("source_value"), F.col("t_nulls").alias("target_value")),
        F.struct(F.lit("distinct").alias("metric"), F.col("s_distinct").alias("source_value"), F.col("t_distinct").alias("target_value")))
    return (per.select(F.element_at(names, F.col("ci") + 1).alias("column_name"), F.inline(metrics))
            .withColumn("passed", F.col("source_value") == F.col("target_value")))


def metadata_column_parity(pair: TablePair, identity_columns: Sequence[str], not_null_columns: Sequence[str]) -> DataFrame:
    """Identity columns hold no NULL on either side; declared not-null columns have equal NULL counts."""
    from paritas.operators.profile import PairProfile
    cols = sorted(set(identity_columns) | set(not_null_columns))
    p = PairProfile(pair, cols)
    structs = []
    for c in cols:
        i = p.index(c)
        s, t = p.get("s", "nulls", i), p.get("t", "nulls", i)
        if c in identity_columns:
            structs.append(F.struct(F.lit(c).alias("column_name"), F.lit("identity_nulls").alias("rule"),
                                    s.alias("source_nulls"), t.alias("target_nulls"), ((s == 0) & (t == 0)).alias("passed")))
        if c in not_null_columns:
            structs.append(F.struct(F.lit(c).alias("column_name"), F.lit("not_null_parity").alias("rule"),
                                    s.alias("source_nulls"), t.alias("target_nulls"), (s == t).alias("passed")))
    return p.wide.select(F.inline(F.array(*structs)))

