"""DuckDB statement of the whole suite result, check by check in plain SQL over the two sides."""

from __future__ import annotations

from dataclasses import dataclass, field

NUMERIC, TEXT, TIME = {"bigint", "int", "double"}, {"string"}, {"timestamp_ntz"}


@dataclass
class Side:
    relation: str
    columns: dict[str, str]


@dataclass
class Pair:
    table: str
    source: Side
    target: Side
    keys: tuple[str, ...] = ()
    catalog: list[str] = field(default_factory=list)  # statements of the catalog checks; empty: skipped


def _text(value) -> str:
    return "NULL" if value is None else f"'{value}'"


def row(table: str, check: str, column, metric, sv: str, tv: str, passed: str, status: str = "ok", detail=None) -> str:
    return (f"SELECT 'tpch' AS database_name, '{table}' AS table_name, '{check}' AS \"check\", CAST({_text(column)} AS VARCHAR) AS column_name, CAST({_text(metric)} AS VARCHAR) AS metric, "
            f"CAST({sv} AS VARCHAR) AS source_value, CAST({tv} AS VARCHAR) AS target_value, CAST({passed} AS BOOLEAN) AS passed, '{status}' AS status, CAST({_text(detail)} AS VARCHAR) AS detail")


def _both(p: Pair, check: str, column, metric, expr: str, same: str = "IS NOT DISTINCT FROM") -> str:
    s, t = f"(SELECT {expr} FROM {p.source.relation})", f"(SELECT {expr} FROM {p.target.relation})"
    return row(p.table, check, column, metric, s, t, f"{s} {same} {t}")


def statements(p: Pair) -> list[str]:
    s, t = p.source.relation, p.target.relation
    common = sorted(set(p.source.columns) & set(p.target.columns))
    only = [",".join(sorted(set(a) - set(b))) for a, b in ((p.source.columns, p.target.columns), (p.target.columns, p.source.columns))]
    cols, n, m = ", ".join(common), f"(SELECT count(*) FROM {s})", f"(SELECT count(*) FROM {t})"
    counts = (str(len(p.source.columns)), str(len(p.target.columns)))
    out = [row(p.table, "data_diagnosis", None, "row_count", n, m, "NULL"), row(p.table, "data_diagnosis", None, "row_count_difference", f"abs({n} - {m})", "NULL", "NULL"),
           row(p.table, "data_diagnosis", None, "column_count", *counts, "NULL"), row(p.table, "data_diagnosis", None, "common_columns", str(len(common)), str(len(common)), "NULL"),
           row(p.table, "data_diagnosis", None, "only_on_side", _text(only[0]), _text(only[1]), "NULL")]
    sample = lambda r: f"(SELECT string_agg(coalesce(CAST(v AS VARCHAR), 'NULL'), ',' ORDER BY v NULLS LAST) FROM (SELECT {common[0]} AS v FROM {r} ORDER BY v NULLS LAST LIMIT 5))"
    out += [row(p.table, "data_diagnosis_sample", common[0], "sample", sample(s), sample(t), "NULL"), _both(p, "row_counts", None, "row_count", "count(*)"),
            row(p.table, "column_counts", None, "column_count", *counts, f"{counts[0]} = {counts[1]}"),
            row(p.table, "column_match", None, "common_columns", _text(only[0]), _text(only[1]), str(len(common) > 0))]
    surplus = lambda a, b: f"(SELECT count(*) FROM (SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b}))"
    same = str(all(p.source.columns[c] == p.target.columns[c] for c in common))
    for check in ("dataframe_general_equality", "dataframe_schema_adherence", "dataframe_equality_ignore_row_order"):
        out.append(row(p.table, check, None, "rows_only_in_side", surplus(s, t), surplus(t, s), f"{surplus(s, t)} = 0 AND {surplus(t, s)} = 0 AND {same}"))
    dups = [f"({k} - (SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {r})))" for k, r in ((n, s), (m, t))]
    out.append(row(p.table, "duplicate_row_count", None, "duplicate_rows", *dups, " = ".join(dups)))
    for c in common:
        a, b = p.source.columns[c], p.target.columns[c]
        zero = "0.0::DOUBLE" if a == "double" else "0"  # -0.0 and 0.0 are one number
        out += [row(p.table, "schema_data_types", c, "data_type", _text(a), _text(b), str(a == b)), row(p.table, "column_nullable_properties", c, "nullable", "'true'", "'true'", "true"),
                _both(p, "null_count_per_column", c, "null_count", f"count(*) - count({c})"), _both(p, "unique_value_counts", c, "distinct_values", f"count(DISTINCT {c}) + max(({c} IS NULL)::INT)")]
        for check, kind, metrics in (("numeric_column_ranges", NUMERIC, {"min": f"min({c}) + {zero}", "max": f"max({c}) + {zero}"}), ("date_column_ranges", TIME, {"min": f"min({c})", "max": f"max({c})"}),
                                     ("string_column_lengths", TEXT, {"min_len": f"min(length({c}))", "max_len": f"max(length({c}))"})):
            if a in kind:
                out += [_both(p, check, c, metric, e) for metric, e in metrics.items()]
    out += _keyed(p, common) + (p.catalog or [row(p.table, c, None, None, "NULL", "NULL", "NULL", "skipped", "no metadata given")
                                              for c in ("table_metadata_retrieval", "schema_comparison", "foreign_key_integrity", "metadata_driven_column_validation")])
    return out


def _keyed(p: Pair, common: list[str]) -> list[str]:
    if not p.keys:
        return [row(p.table, c, None, None, "NULL", "NULL", "NULL", "skipped", "no key columns given") for c in ("primary_key_uniqueness", "keyed_row_differences")]
    (key,), s, t = p.keys, p.source.relation, p.target.relation
    bad = [f"(SELECT count(*) - count(DISTINCT {key}) FROM {r})" for r in (s, t)]
    per = " UNION ALL ".join(
        [f"SELECT CAST(NULL AS VARCHAR) AS c, CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'extra' ELSE 'duplicate_key' END AS change FROM a FULL JOIN b ON a.k = b.k WHERE a.n IS DISTINCT FROM 1 OR b.n IS DISTINCT FROM 1"]
        + [f"SELECT '{c}', 'changed' FROM a JOIN b ON a.k = b.k AND a.n = 1 AND b.n = 1 JOIN {s} x ON x.{key} = a.k JOIN {t} y ON y.{key} = a.k WHERE x.{c} IS DISTINCT FROM y.{c}" for c in common if c != key])
    found = (f"(WITH a AS (SELECT {key} AS k, count(*) AS n FROM {s} GROUP BY 1), b AS (SELECT {key} AS k, count(*) AS n FROM {t} GROUP BY 1), d AS ({per}) "
             f"SELECT c, change, count(*) AS n FROM d GROUP BY 1, 2 UNION ALL SELECT NULL, 'all_differences', count(*) FROM d)")
    return [row(p.table, "primary_key_uniqueness", key, "key_violations", *bad, f"{bad[0]} = 0 AND {bad[1]} = 0"),
            f"SELECT 'tpch', '{p.table}', 'keyed_row_differences', c, change, CAST(n AS VARCHAR), NULL, n = 0, 'ok', NULL FROM {found}"]


def build(orders_target: str, customer_other: str) -> dict[str, str]:
    orders = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}
    moved = {k: v for k, v in orders.items() if k != "o_orderstatus"} | {"load_id": "int"}
    customer = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}
    lineitem = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
                "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}
    pair = Pair("orders", Side("orders", orders), Side("orders_target", moved), ("o_orderkey",))
    nulls, distinct = "count(*) - count(o_custkey)", "count(DISTINCT o_custkey) + max((o_custkey IS NULL)::INT)"
    pair.catalog = [row("orders", "table_metadata_retrieval", None, "columns", "6", "NULL", "true"), row("orders", "table_metadata_retrieval", None, "table_name", "'orders'", "'orders'", "true"),
                    row("orders", "schema_comparison", "o_orderstatus", "presence", "'source_only'", "NULL", "false"), row("orders", "schema_comparison", "load_id", "presence", "NULL", "'target_only'", "false"),
                    row("orders", "schema_comparison", None, "differences", "2", "NULL", "false"), _both(pair, "foreign_key_integrity", "o_custkey", "nulls", nulls),
                    _both(pair, "foreign_key_integrity", "o_custkey", "distinct_values", distinct), _both(pair, "metadata_driven_column_validation", "o_custkey", "not_null_parity", nulls),
                    _both(pair, "metadata_driven_column_validation", "o_orderkey", "not_null_parity", "count(*) - count(o_orderkey)")]
    pairs = [pair, Pair("customer", Side("customer", customer), Side("customer_other", customer), ("c_custkey",)),
             Pair("lineitem", Side("lineitem", lineitem), Side("lineitem_child", lineitem))]
    ctes = f"{orders_target}, {customer_other}, lineitem_child AS (SELECT * REPLACE (CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey) FROM lineitem)"
    whole = "\nUNION ALL\n".join(x for p in pairs for x in statements(p))
    summary = f"""SELECT database_name, table_name, count_if(passed) AS passed_rows, count_if(NOT passed) AS failed_rows, count(DISTINCT CASE WHEN NOT passed THEN "check" END) AS failed_checks,
  count_if(status = 'skipped') AS skipped, count_if(status = 'error') AS errors, count_if(NOT passed) = 0 AND count_if(status = 'error') = 0 AS all_passed
FROM whole GROUP BY 1, 2"""
    return {"suite_results": f"WITH {ctes}\n{whole}", "suite_summary": f"WITH {ctes}, whole AS ({whole})\n{summary}"}


def scope(orders_t: str, customer_other: str) -> str:
    """The scope query: three checks on two tables, and a table that cannot be loaded."""
    wanted = ("row_counts", "null_count_per_column", "keyed_row_differences")
    orders = Pair("orders", Side("orders", dict.fromkeys(["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"], "bigint")),
                  Side("orders_t", dict.fromkeys(["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"], "bigint")), ("o_orderkey",))
    columns = dict.fromkeys(["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], "bigint")
    customer = Pair("customer", Side("customer", columns), Side("customer_other", columns), ("c_custkey",))
    rows = [x for p in (orders, customer) for x in statements(p) if any(f"'{w}'" in x for w in wanted)]
    rows.append(row("ghost", "load", None, None, "NULL", "NULL", "NULL", "error"))
    return f"""WITH {orders_t}, {customer_other}, whole AS ({" UNION ALL ".join(rows)})
SELECT 'silver_to_gold' AS pairing, database_name, table_name, "check", column_name, metric, source_value, target_value, passed, status FROM whole"""
