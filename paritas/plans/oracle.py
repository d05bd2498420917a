"""DuckDB statements that state each registered query's result independently.

The injected-defect inputs are restated as SQL CTEs over the pre-registered views; the
checks are written the plain SQL way (EXCEPT ALL, NOT EXISTS, LEFT JOIN … IS NULL,
FULL JOIN … IS DISTINCT FROM), not as the counted groupings the Spark side uses.
"""

from __future__ import annotations

from paritas.plans import suite_oracle

ORDERS_T = """orders_t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
         CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1000000 ELSE o_totalprice END AS o_totalprice,
         o_orderdate,
         CASE WHEN o_orderkey % 83 = 0 THEN concat(o_orderpriority, 'x') ELSE o_orderpriority END AS o_orderpriority,
         CAST(1 AS INTEGER) AS load_id
  FROM orders WHERE o_orderkey % 97 <> 0)"""
ORDERS_TARGET = ORDERS_T + """,
orders_target AS (SELECT * FROM orders_t UNION ALL SELECT * FROM orders_t WHERE o_orderkey % 101 = 0)"""
CUSTOMER_OTHER = """customer_t AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
         CASE WHEN c_custkey % 17 = 0 THEN concat(c_mktsegment, 'x') ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_custkey % 13 <> 0),
customer_other AS (SELECT * FROM customer_t UNION ALL SELECT * FROM customer_t WHERE c_custkey % 19 = 0)"""
ORDERS_PARENT = "orders_parent AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 0)"
LINEITEM_CHILD = """lineitem_child AS (
  SELECT CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey, l_partkey, l_suppkey, l_linenumber
  FROM lineitem)"""
STAFF = """staff AS (
  SELECT c_custkey AS id, c_name AS name,
         CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS boss
  FROM customer)"""
EVENTS_BAD = """events_bad AS (
  SELECT event_id, ts, user_id,
         CASE WHEN event_id % 79 = 0 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN event_id % 71 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 73 = 0 THEN NULL ELSE value END AS value,
         props
  FROM events)"""

ORDERS_COMMON = ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_totalprice"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


ORACLES: dict[str, str] = {}

ORACLES["pair_diagnosis"] = f"""WITH {ORDERS_TARGET}
SELECT s.n AS source_rows, t.n AS target_rows, abs(s.n - t.n) AS row_diff,
       (SELECT count(*) FROM information_schema.columns WHERE table_name = 'orders') AS source_cols,
       CAST(6 AS BIGINT) AS target_cols, CAST(5 AS BIGINT) AS common_cols,
       'o_orderstatus' AS source_only, 'load_id' AS target_only
FROM (SELECT count(*) AS n FROM orders) s, (SELECT count(*) AS n FROM orders_target) t"""

ORACLES["pair_samples"] = f"""WITH {ORDERS_TARGET}
SELECT 'source' AS side, 'o_custkey' AS column_name, CAST(o_custkey AS VARCHAR) AS value
FROM (SELECT o_custkey FROM orders ORDER BY o_custkey NULLS LAST LIMIT 5)
UNION ALL
SELECT 'target', 'o_custkey', CAST(o_custkey AS VARCHAR)
FROM (SELECT o_custkey FROM orders_target ORDER BY o_custkey NULLS LAST LIMIT 5)"""

ORACLES["row_count_parity"] = f"""WITH {ORDERS_TARGET}
SELECT s.n AS source_rows, t.n AS target_rows, s.n = t.n AS passed
FROM (SELECT count(*) AS n FROM orders) s, (SELECT count(*) AS n FROM orders_target) t"""

ORACLES["column_count_parity"] = """SELECT CAST(6 AS BIGINT) AS source_n, CAST(6 AS BIGINT) AS target_n, true AS passed"""

ORACLES["column_match"] = """SELECT CAST(5 AS BIGINT) AS common_n, 'o_orderstatus' AS source_only, 'load_id' AS target_only, true AS passed"""

ORACLES["schema_type_parity"] = """SELECT * FROM (VALUES
  ('o_custkey', 'bigint', 'int', false),
  ('o_orderdate', 'timestamp_ntz', 'timestamp_ntz', true),
  ('o_orderkey', 'bigint', 'bigint', true),
  ('o_orderpriority', 'string', 'string', true),
  ('o_totalprice', 'double', 'double', true)) v(column_name, source_type, target_type, passed)"""

ORACLES["nullable_parity"] = """SELECT * FROM (VALUES
  ('o_custkey', true, true, true),
  ('o_orderdate', true, true, true),
  ('o_orderkey', true, false, false),
  ('o_orderpriority', true, true, true),
  ('o_totalprice', true, true, true)) v(column_name, source_nullable, target_nullable, passed)"""

ORACLES["null_count_parity"] = f"""WITH {ORDERS_TARGET},
n AS ({_union([f"SELECT '{c}' AS column_name, (SELECT count(*) FROM orders WHERE {c} IS NULL) AS s, (SELECT count(*) FROM orders_target WHERE {c} IS NULL) AS t" for c in ORDERS_COMMON])})
SELECT column_name, s AS source_nulls, t AS target_nulls, s = t AS passed FROM n"""

_cols = ", ".join(ORDERS_COMMON)
ORACLES["duplicate_row_parity"] = f"""WITH {ORDERS_TARGET},
d AS (SELECT (SELECT count(*) FROM orders) - (SELECT count(*) FROM (SELECT DISTINCT {_cols} FROM orders)) AS s,
             (SELECT count(*) FROM orders_target) - (SELECT count(*) FROM (SELECT DISTINCT {_cols} FROM orders_target)) AS t)
SELECT s AS source_dups, t AS target_dups, s = t AS passed FROM d"""

ORACLES["numeric_range_parity"] = f"""WITH {ORDERS_TARGET},
r AS ({_union([f"SELECT '{c}' AS column_name, (SELECT CAST(min({c}) AS DOUBLE) FROM orders) AS smin, (SELECT CAST(min({c}) AS DOUBLE) FROM orders_target) AS tmin, (SELECT CAST(max({c}) AS DOUBLE) FROM orders) AS smax, (SELECT CAST(max({c}) AS DOUBLE) FROM orders_target) AS tmax" for c in ["o_custkey", "o_orderkey", "o_totalprice"]])})
SELECT column_name, smin AS source_min, tmin AS target_min, smax AS source_max, tmax AS target_max,
       (smin IS NOT DISTINCT FROM tmin) AND (smax IS NOT DISTINCT FROM tmax) AS passed FROM r"""

_LNUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORACLES["describe_profile"] = _union([
    f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in _LNUM])

ORACLES["string_length_parity"] = f"""WITH {CUSTOMER_OTHER},
r AS ({_union([f"SELECT '{c}' AS column_name, (SELECT CAST(min(length({c})) AS INTEGER) FROM customer) AS smin, (SELECT CAST(min(length({c})) AS INTEGER) FROM customer_other) AS tmin, (SELECT CAST(max(length({c})) AS INTEGER) FROM customer) AS smax, (SELECT CAST(max(length({c})) AS INTEGER) FROM customer_other) AS tmax" for c in ["c_mktsegment", "c_name"]])})
SELECT column_name, smin AS source_min, tmin AS target_min, smax AS source_max, tmax AS target_max,
       (smin IS NOT DISTINCT FROM tmin) AND (smax IS NOT DISTINCT FROM tmax) AS passed FROM r"""

ORACLES["date_range_parity"] = f"""WITH {ORDERS_TARGET},
r AS (SELECT 'o_orderdate' AS column_name,
             (SELECT CAST(min(o_orderdate) AS VARCHAR) FROM orders) AS smin, (SELECT CAST(min(o_orderdate) AS VARCHAR) FROM orders_target) AS tmin,
             (SELECT CAST(max(o_orderdate) AS VARCHAR) FROM orders) AS smax, (SELECT CAST(max(o_orderdate) AS VARCHAR) FROM orders_target) AS tmax)
SELECT column_name, smin AS source_min, tmin AS target_min, smax AS source_max, tmax AS target_max,
       (smin IS NOT DISTINCT FROM tmin) AND (smax IS NOT DISTINCT FROM tmax) AS passed FROM r"""

ORACLES["unique_value_parity"] = f"""WITH {ORDERS_TARGET},
u AS ({_union([f"SELECT '{c}' AS column_name, (SELECT CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM orders) AS s, (SELECT CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM orders_target) AS t" for c in ORDERS_COMMON])})
SELECT column_name, s AS source_distinct, t AS target_distinct, s = t AS passed FROM u"""

ORACLES["frame_equal"] = f"""WITH {ORDERS_TARGET},
m AS (SELECT count(*) AS missing FROM (SELECT {_cols} FROM orders EXCEPT ALL SELECT {_cols} FROM orders_target)),
e AS (SELECT count(*) AS extra FROM (SELECT {_cols} FROM orders_target EXCEPT ALL SELECT {_cols} FROM orders))
SELECT v.mode, missing, extra, true AS types_equal, true AS nullable_equal, missing = 0 AND extra = 0 AS passed
FROM m, e, (VALUES ('general'), ('schema_adherence'), ('ignore_row_order')) v(mode)"""

ORACLES["multiset_diff"] = f"""WITH {ORDERS_TARGET}
SELECT {_cols}, 'source' AS side, count(*) AS n
FROM (SELECT {_cols} FROM orders EXCEPT ALL SELECT {_cols} FROM orders_target) GROUP BY ALL
UNION ALL
SELECT {_cols}, 'target' AS side, count(*) AS n
FROM (SELECT {_cols} FROM orders_target EXCEPT ALL SELECT {_cols} FROM orders) GROUP BY ALL"""

_VALS = ["o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice"]
ORACLES["keyed_diff"] = f"""WITH {ORDERS_T},
j AS (SELECT s.o_orderkey AS sk, t.o_orderkey AS tk, {", ".join(f"s.{c} AS s_{c}, t.{c} AS t_{c}" for c in _VALS)}
      FROM orders s FULL JOIN orders_t t ON s.o_orderkey = t.o_orderkey)
SELECT sk AS o_orderkey, CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS VARCHAR) AS source_value,
       CAST(NULL AS VARCHAR) AS target_value, 'missing' AS change FROM j WHERE tk IS NULL
UNION ALL
SELECT tk, NULL, NULL, NULL, 'extra' FROM j WHERE sk IS NULL
UNION ALL
{_union([f"SELECT sk, '{c}', CAST(s_{c} AS VARCHAR), CAST(t_{c} AS VARCHAR), 'changed' FROM j WHERE sk IS NOT NULL AND tk IS NOT NULL AND s_{c} IS DISTINCT FROM t_{c}" for c in _VALS])}"""

ORACLES["keyed_diff_dup_keys"] = f"""WITH {ORDERS_TARGET},
s AS (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY o_orderkey),
t AS (SELECT o_orderkey, count(*) AS n FROM orders_target GROUP BY o_orderkey)
SELECT s.o_orderkey, CAST(NULL AS VARCHAR) AS column_name, CAST(s.n AS VARCHAR) AS source_value,
       CAST(t.n AS VARCHAR) AS target_value, 'duplicate_key' AS change
FROM s JOIN t ON s.o_orderkey = t.o_orderkey WHERE s.n > 1 OR t.n > 1"""

# by the rules of the injected changes, on the values before any change of type
def _drift_sql() -> dict[str, str]:
    from paritas.plans.fixtures import DRIFT, DRIFT_LOST

    kept = f"o_orderkey % {DRIFT_LOST} <> 0"
    row = lambda change, by: f"o_custkey + {change} * (o_orderkey % {by} = 0)::INT"
    source = "SELECT o_custkey AS huge, o_totalprice AS price, o_orderkey % 10 AS tenth, o_custkey AS tiny FROM orders"
    target = (f"SELECT {row(1, DRIFT['huge'])} AS huge, o_totalprice + (o_orderkey % {DRIFT['price']} = 0)::INT AS price, "
              f"o_orderkey % 10 + 10 * (o_orderkey % {DRIFT['tenth']} = 0)::INT AS tenth, {row(10000000, DRIFT['tiny'])} AS tiny FROM orders WHERE {kept}")
    keyed = _union([f"SELECT '{c}' AS column_name, 'changed' AS change, count(*) AS n FROM orders WHERE {kept} AND o_orderkey % {m} = 0 HAVING count(*) > 0" for c, m in DRIFT.items()])
    ranges = _union([f"SELECT '{c}' AS column_name, (SELECT min({c}) = min(t_{c}) AND max({c}) = max(t_{c}) FROM s, (SELECT min({c}) AS t_{c} FROM t UNION ALL SELECT max({c}) FROM t)) AS passed" for c in DRIFT])
    both = f"WITH s AS ({source}), t AS ({target})"
    return {
        "number_drift": f"{keyed} UNION ALL SELECT NULL, 'missing', count(*) FROM orders WHERE NOT ({kept}) HAVING count(*) > 0",
        "number_drift_multiset": f"""{both} SELECT (SELECT count(*) FROM (FROM s EXCEPT ALL FROM t)) AS missing, (SELECT count(*) FROM (FROM t EXCEPT ALL FROM s)) AS extra,
  (SELECT count(*) FROM s) AS source_rows, (SELECT count(*) FROM t) AS target_rows,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM s)) AS source_distinct, (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS target_distinct""",
        "number_drift_ranges": f"{both}, x AS ({ranges}) FROM x UNION ALL SELECT 'k', (SELECT min(o_orderkey) FROM orders) = (SELECT min(o_orderkey) FROM orders WHERE {kept}) "
                               f"AND (SELECT max(o_orderkey) FROM orders) = (SELECT max(o_orderkey) FROM orders WHERE {kept})",
    }


ORACLES |= _drift_sql()

ORACLES["nested_unique_values"] = """WITH v AS (
  SELECT o_orderkey % 7 AS a, o_orderkey % 3 AS s, o_orderkey % 4 AS t, o_orderkey % 2 AS odd, o_orderkey % 5 AS q, o_orderkey % 11 = 0 AS gone FROM orders),
d AS (
  SELECT count(DISTINCT (a, s)) AS nested_s, count(DISTINCT (a, t)) AS nested_t, count(DISTINCT (odd, s, q)) AS listed,
    count(DISTINCT CASE WHEN NOT gone THEN (a, s, t) END) + max(gone::INT) AS part_s, count(DISTINCT CASE WHEN NOT gone THEN (a, t) END) + max(gone::INT) AS part_t FROM v)
SELECT 'nested' AS column_name, nested_s AS source_distinct, nested_t AS target_distinct, nested_s = nested_t AS passed FROM d
UNION ALL SELECT 'listed', listed, listed, true FROM d
UNION ALL SELECT 'part', part_s, part_t, part_s = part_t FROM d"""

_HASH_COLS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "load_id"]
_hash_text = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '__NULL__')" for c in _HASH_COLS) + ")"
ORACLES["row_hash"] = f"WITH {ORDERS_T}\nSELECT o_orderkey, sha256({_hash_text}) AS row_hash FROM orders_t"
ORACLES["row_hash_md5"] = f"WITH {ORDERS_T}\nSELECT o_orderkey, md5({_hash_text}) AS row_hash FROM orders_t"

_CCOLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
ORACLES["unique_to_one_side"] = f"""WITH {CUSTOMER_OTHER},
m AS (SELECT {_CCOLS}, 'customer' AS database_name FROM customer
      UNION ALL SELECT {_CCOLS}, 'customer_other' FROM customer_other),
w AS (SELECT *, count(*) OVER (PARTITION BY {_CCOLS}) AS n FROM m
      WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL AND c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL)
SELECT {_CCOLS}, database_name FROM w WHERE n = 1"""

_PK = "l_orderkey, l_linenumber"
ORACLES["pk_violations"] = f"""WITH k AS (SELECT {_PK}, count(*) AS n FROM lineitem GROUP BY {_PK})
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, CAST(sum(n) - count(*) AS BIGINT) AS violations,
       count(*) FILTER (WHERE n > 1) AS dup_keys, sum(n) = count(*) AS passed FROM k"""

ORACLES["pk_duplicates"] = f"SELECT {_PK}, count(*) AS n FROM lineitem GROUP BY {_PK} HAVING count(*) > 1"

ORACLES["pk_samples"] = f"""SELECT {_PK}, count(*) AS n FROM lineitem GROUP BY {_PK} HAVING count(*) > 1
ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 10"""

ORACLES["pk_parity"] = f"""WITH {ORDERS_TARGET},
ks AS (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY o_orderkey),
kt AS (SELECT o_orderkey, count(*) AS n FROM orders_target GROUP BY o_orderkey)
SELECT 'source' AS side, CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, CAST(sum(n) - count(*) AS BIGINT) AS violations,
       count(*) FILTER (WHERE n > 1) AS dup_keys, sum(n) = count(*) AS passed FROM ks
UNION ALL
SELECT 'target', CAST(sum(n) AS BIGINT), count(*), CAST(sum(n) - count(*) AS BIGINT), count(*) FILTER (WHERE n > 1), sum(n) = count(*) FROM kt"""

_EV = ["event_id", "ts", "user_id", "event_type", "value", "props"]
ORACLES["not_null_violations"] = f"""WITH {EVENTS_BAD},
c AS ({_union([f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls, " + (f"count(*) FILTER (WHERE isnan({c}))" if c == "value" else "CAST(0 AS BIGINT)") + f" AS nans FROM events_bad" for c in _EV])})
SELECT column_name, nulls, nans, nulls + nans AS violations, nulls + nans = 0 AS passed FROM c"""


def _uq(name: str, cols: list[str]) -> str:
    cl = ", ".join(cols)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return (f"SELECT '{name}' AS constraint_name, '{','.join(cols)}' AS columns, CAST(sum(n) AS BIGINT) AS non_null_rows, "
            f"count(*) AS distinct_values, CAST(sum(n) - count(*) AS BIGINT) AS violations, count(*) FILTER (WHERE n > 1) AS dup_values, "
            f"sum(n) = count(*) AS passed FROM (SELECT {cl}, count(*) AS n FROM part WHERE {nn} GROUP BY {cl})")


ORACLES["unique_violations"] = _union([_uq("uq_part_name", ["p_name"]), _uq("uq_brand_size", ["p_brand", "p_size"]),
                                       _uq("uq_partkey", ["p_partkey"])])

_MISSING = f"""WITH {LINEITEM_CHILD}, {ORDERS_PARENT},
miss AS (SELECT l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem_child WHERE l_orderkey IS NOT NULL) c
         WHERE NOT EXISTS (SELECT 1 FROM orders_parent p WHERE p.o_orderkey = c.l_orderkey))"""
ORACLES["fk_missing"] = _MISSING + "\nSELECT 'fk_lineitem_orders' AS constraint_name, count(*) AS missing_values, count(*) = 0 AS passed FROM miss"
ORACLES["fk_missing_samples"] = _MISSING + "\nSELECT l_orderkey FROM miss ORDER BY l_orderkey LIMIT 10"

ORACLES["self_ref_missing"] = f"""WITH {STAFF}
SELECT DISTINCT boss FROM staff s WHERE boss IS NOT NULL AND NOT EXISTS (SELECT 1 FROM staff p WHERE p.id = s.boss)"""

_ORPHANS = f"""WITH {LINEITEM_CHILD}, {ORDERS_PARENT}
SELECT c.l_orderkey, count(*) AS orphaned_count
FROM lineitem_child c LEFT JOIN orders_parent p ON c.l_orderkey = p.o_orderkey
WHERE p.o_orderkey IS NULL{{extra}}
GROUP BY c.l_orderkey"""
ORACLES["orphan_groups"] = _ORPHANS.format(extra="")
ORACLES["orphan_groups_ignore_null"] = _ORPHANS.format(extra=" AND c.l_orderkey IS NOT NULL")
ORACLES["orphan_groups_composite"] = f"""WITH {ORDERS_TARGET}, {ORDERS_PARENT}
SELECT c.o_orderkey, c.o_custkey, count(*) AS orphaned_count
FROM orders_target c LEFT JOIN orders_parent p ON c.o_orderkey = p.o_orderkey AND c.o_custkey = p.o_custkey
WHERE p.o_orderkey IS NULL AND p.o_custkey IS NULL
GROUP BY c.o_orderkey, c.o_custkey"""
ORACLES["orphan_total"] = f"""SELECT CAST(coalesce(sum(orphaned_count), 0) AS BIGINT) AS total_orphans FROM ({_ORPHANS.format(extra="")})"""

ORACLES["integrity_report"] = f"""WITH {LINEITEM_CHILD}, {ORDERS_PARENT},
o AS (SELECT count(*) AS v FROM (SELECT DISTINCT o_custkey FROM orders_parent WHERE o_custkey IS NOT NULL) c
      WHERE NOT EXISTS (SELECT 1 FROM customer p WHERE p.c_custkey = c.o_custkey)),
i AS (SELECT count(*) AS v FROM lineitem_child c LEFT JOIN orders_parent p ON c.l_orderkey = p.o_orderkey WHERE p.o_orderkey IS NULL)
SELECT 'outgoing' AS direction, 'fk_orders_customer' AS constraint_name, 'orders' AS child_table, 'customer' AS parent_table,
       v AS violations, v = 0 AS passed FROM o
UNION ALL
SELECT 'incoming', 'fk_lineitem_orders', 'lineitem', 'orders', v, v = 0 FROM i"""

ORACLES["fk_parity"] = f"""WITH {ORDERS_TARGET},
m AS (SELECT 'o_custkey' AS column_name, 'nulls' AS metric,
             (SELECT count(*) FROM orders WHERE o_custkey IS NULL) AS source_value,
             (SELECT count(*) FROM orders_target WHERE o_custkey IS NULL) AS target_value
      UNION ALL
      SELECT 'o_custkey', 'distinct',
             (SELECT CAST(count(DISTINCT o_custkey) + max(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM orders),
             (SELECT CAST(count(DISTINCT o_custkey) + max(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM orders_target))
SELECT column_name, metric, source_value, target_value, source_value = target_value AS passed FROM m"""

ORACLES["metadata_column_parity"] = f"""WITH {ORDERS_TARGET},
n AS ({_union([f"SELECT '{c}' AS column_name, '{rule}' AS rule, (SELECT count(*) FROM orders WHERE {c} IS NULL) AS s, (SELECT count(*) FROM orders_target WHERE {c} IS NULL) AS t" for c, rule in [("o_custkey", "not_null_parity"), ("o_orderdate", "not_null_parity"), ("o_orderkey", "identity_nulls"), ("o_totalprice", "not_null_parity")]])})
SELECT column_name, rule, s AS source_nulls, t AS target_nulls,
       CASE WHEN rule = 'identity_nulls' THEN s = 0 AND t = 0 ELSE s = t END AS passed FROM n"""


# -- catalog derived from the data (restated; see fixtures.derived_catalog) ------

CATALOG = """cat_n AS (SELECT count(*) AS n FROM customer),
cat_schemas AS (SELECT n_nationkey AS schema_id, n_name AS name FROM nation),
cat_tables AS (SELECT c_custkey AS object_id,
                      CASE WHEN c_acctbal < 0 THEN concat(c_name, '_DO_NOT_USE') ELSE c_name END AS name,
                      c_nationkey AS schema_id FROM customer),
cat_types AS (SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS user_type_id,
                     lower(regexp_replace(o_orderpriority, '^[0-9]+-', '')) AS name FROM orders),
cat_columns_a AS (SELECT o_custkey AS object_id, o_orderkey AS column_id, concat('col_', CAST(o_orderkey AS VARCHAR)) AS name,
                         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS user_type_id,
                         CAST(length(o_orderpriority) AS INTEGER) AS max_length, CAST(month(o_orderdate) AS INTEGER) AS precision,
                         CAST(day(o_orderdate) % 4 AS INTEGER) AS scale, o_orderstatus <> 'F' AS is_nullable,
                         false AS is_identity, 0 AS default_object_id FROM orders),
cat_columns_b AS (SELECT object_id, column_id, name,
                         CASE WHEN column_id % 5 = 0 THEN user_type_id % 5 + 1 ELSE user_type_id END AS user_type_id,
                         CASE WHEN column_id % 3 = 0 THEN max_length + 1 ELSE max_length END AS max_length,
                         precision, scale,
                         CASE WHEN column_id % 11 = 0 THEN NOT is_nullable ELSE is_nullable END AS is_nullable,
                         is_identity, default_object_id
                  FROM (SELECT * FROM cat_columns_a WHERE column_id % 7 <> 0
                        UNION ALL
                        SELECT object_id, column_id + 1000000000000, concat(name, '_v2'), user_type_id, max_length, precision,
                               scale, is_nullable, is_identity, default_object_id
                        FROM cat_columns_a WHERE column_id % 7 = 0)),
cat_computed AS (SELECT o_custkey AS object_id, o_orderkey AS column_id, concat('(', o_orderpriority, ')') AS definition
                 FROM orders WHERE o_orderstatus = 'P'),
cat_indexes AS (SELECT c_custkey AS object_id, 1 AS index_id, true AS is_primary_key, false AS is_unique_constraint FROM customer
                UNION ALL SELECT c_custkey, 2, false, true FROM customer),
cat_bounds AS (SELECT o_custkey, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders GROUP BY o_custkey),
cat_index_columns AS (SELECT o_custkey AS object_id, 1 AS index_id, lo AS column_id FROM cat_bounds
                      UNION ALL SELECT o_custkey, 2, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'),
cat_fks AS (SELECT c_custkey * 2 AS object_id, concat('FK_', c_name) AS name, c_custkey AS parent_object_id,
                   (c_custkey * c_custkey + 1) % (SELECT n FROM cat_n) AS referenced_object_id FROM customer
            UNION ALL
            SELECT c_custkey * 2 + 1, concat('SELF_', c_name), c_custkey, c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'),
cat_fk_columns AS (SELECT f.object_id AS constraint_object_id, 1 AS constraint_column_id, f.parent_object_id,
                          bp.hi AS parent_column_id, f.referenced_object_id, br.lo AS referenced_column_id
                   FROM cat_fks f JOIN cat_bounds bp ON bp.o_custkey = f.parent_object_id
                                  JOIN cat_bounds br ON br.o_custkey = f.referenced_object_id),
cat_named AS (SELECT t.object_id, t.name AS table_name, s.name AS schema_name
              FROM cat_tables t JOIN cat_schemas s ON s.schema_id = t.schema_id),
cat_resolved AS (SELECT fc.constraint_column_id, f.name AS foreign_key_name, fc.parent_object_id, fc.parent_column_id,
                        fc.referenced_object_id, ct.table_name AS child_table_name, ct.schema_name AS child_schema_name,
                        rt.table_name AS referenced_table_name, rt.schema_name AS referenced_schema_name,
                        cc.name AS child_column_name, rc.name AS referenced_column_name
                 FROM cat_fk_columns fc
                 JOIN cat_fks f ON f.object_id = fc.constraint_object_id
                 JOIN cat_named ct ON ct.object_id = fc.parent_object_id
                 JOIN cat_named rt ON rt.object_id = fc.referenced_object_id
                 JOIN cat_columns_a cc ON cc.object_id = fc.parent_object_id AND cc.column_id = fc.parent_column_id
                 JOIN cat_columns_a rc ON rc.object_id = fc.referenced_object_id AND rc.column_id = fc.referenced_column_id)"""


def _meta_sql(name: str, columns_cte: str, db: str) -> str:
    resolved = "cat_resolved" if columns_cte == "cat_columns_a" else f"{name}_resolved"
    prefix = ""
    if resolved != "cat_resolved":
        prefix = f"""{resolved} AS (SELECT r.* FROM cat_resolved r
      JOIN {columns_cte} cc ON cc.object_id = r.parent_object_id AND cc.column_id = r.parent_column_id
      JOIN {columns_cte} rc ON rc.object_id = r.referenced_object_id
       AND rc.column_id = (SELECT lo FROM cat_bounds WHERE o_custkey = r.referenced_object_id)),
"""
    return prefix + f"""{name} AS (
  SELECT '{db}' AS database_name, t.schema_name, t.table_name, c.column_id, c.name AS column_name, ty.name AS data_type,
         c.max_length, c.precision, c.scale, c.is_nullable, c.is_identity, c.default_object_id, cc.definition,
         coalesce(fl.is_pk, false) AS is_primary_key, coalesce(fl.is_uq, false) AS is_unique_constraint,
         coalesce(fk.fks, '') AS foreign_keys
  FROM cat_named t
  JOIN {columns_cte} c ON c.object_id = t.object_id
  JOIN cat_types ty ON ty.user_type_id = c.user_type_id
  LEFT JOIN cat_computed cc ON cc.object_id = c.object_id AND cc.column_id = c.column_id
  LEFT JOIN (SELECT ic.object_id, ic.column_id, bool_or(i.is_primary_key) AS is_pk, bool_or(i.is_unique_constraint) AS is_uq
             FROM cat_index_columns ic JOIN cat_indexes i ON i.object_id = ic.object_id AND i.index_id = ic.index_id
             GROUP BY ic.object_id, ic.column_id) fl ON fl.object_id = c.object_id AND fl.column_id = c.column_id
  LEFT JOIN (SELECT parent_object_id, parent_column_id,
                    string_agg(concat_ws(':', foreign_key_name, referenced_schema_name, referenced_table_name, referenced_column_name), ';'
                               ORDER BY foreign_key_name, referenced_schema_name, referenced_table_name, referenced_column_name) AS fks
             FROM {resolved} GROUP BY parent_object_id, parent_column_id) fk
         ON fk.parent_object_id = c.object_id AND fk.parent_column_id = c.column_id
  WHERE t.table_name NOT LIKE '%DO_NOT%')"""


META_A = _meta_sql("meta_a", "cat_columns_a", "db_a")
META_B = _meta_sql("meta_b", "cat_columns_b", "db_b")
_META_COLS = ("database_name, schema_name, table_name, column_id, column_name, data_type, max_length, precision, scale, "
              "is_nullable, is_identity, default_object_id, definition, is_primary_key, is_unique_constraint, foreign_keys")

ORACLES["catalog_metadata"] = f"WITH {CATALOG},\n{META_A}\nSELECT {_META_COLS} FROM meta_a"
ORACLES["table_metadata"] = f"WITH {CATALOG},\n{META_A}\nSELECT {_META_COLS} FROM meta_a WHERE table_name = 'Customer#000000001'"
ORACLES["table_metadata_nested"] = f"""WITH {CATALOG},
{META_A}
SELECT database_name, schema_name, table_name, count(*) AS n_columns, string_agg(column_name, ',' ORDER BY column_id) AS column_names
FROM meta_a WHERE table_name = 'Customer#000000001' GROUP BY database_name, schema_name, table_name"""
ORACLES["table_list"] = f"WITH {CATALOG},\n{META_A}\nSELECT DISTINCT schema_name, table_name FROM meta_a"
ORACLES["pk_columns"] = f"WITH {CATALOG},\n{META_A}\nSELECT schema_name, table_name, column_id, column_name FROM meta_a WHERE is_primary_key"
ORACLES["fk_columns"] = f"""WITH {CATALOG},
{META_A},
live AS (SELECT DISTINCT schema_name, table_name FROM meta_a)
SELECT r.child_schema_name AS schema_name, r.child_table_name AS table_name, r.parent_column_id AS column_id,
       r.child_column_name AS column_name, r.foreign_key_name, r.referenced_schema_name, r.referenced_table_name, r.referenced_column_name
FROM cat_resolved r JOIN live l ON l.schema_name = r.child_schema_name AND l.table_name = r.child_table_name"""

_JOINED = f"""WITH {CATALOG},
{META_A},
{META_B},
j AS (SELECT coalesce(a.schema_name, b.schema_name) AS schema_name, coalesce(a.table_name, b.table_name) AS table_name,
             coalesce(a.column_name, b.column_name) AS column_name, a.column_name IS NOT NULL AS in_a, b.column_name IS NOT NULL AS in_b,
             a.data_type AS s_data_type, b.data_type AS t_data_type, a.max_length AS s_max_length, b.max_length AS t_max_length,
             a.precision AS s_precision, b.precision AS t_precision, a.scale AS s_scale, b.scale AS t_scale,
             a.is_nullable AS s_is_nullable, b.is_nullable AS t_is_nullable
      FROM meta_a a FULL JOIN meta_b b
        ON a.schema_name = b.schema_name AND a.table_name = b.table_name AND a.column_name = b.column_name)"""
ORACLES["schema_compare"] = _JOINED + "\n" + _union(
    ["SELECT schema_name, table_name, column_name, 'presence' AS attribute, CASE WHEN in_a THEN 'source_only' END AS source_value, "
     "CASE WHEN in_b THEN 'target_only' END AS target_value FROM j WHERE NOT (in_a AND in_b)"] +
    [f"SELECT schema_name, table_name, column_name, '{a}', CAST(s_{a} AS VARCHAR), CAST(t_{a} AS VARCHAR) FROM j "
     f"WHERE in_a AND in_b AND s_{a} IS DISTINCT FROM t_{a}" for a in ("data_type", "max_length", "precision", "scale", "is_nullable")])
_DIFFERS = " OR ".join(f"s_{a} IS DISTINCT FROM t_{a}" for a in ("data_type", "max_length", "precision", "scale", "is_nullable"))
ORACLES["schema_compare_summary"] = _JOINED + f"""
SELECT schema_name, table_name, count(*) FILTER (WHERE in_a AND in_b) AS common_columns,
       count(*) FILTER (WHERE NOT in_b) AS source_only_columns, count(*) FILTER (WHERE NOT in_a) AS target_only_columns,
       count(*) FILTER (WHERE in_a AND in_b AND ({_DIFFERS})) AS differing_columns,
       count(*) FILTER (WHERE NOT in_b) = 0 AND count(*) FILTER (WHERE NOT in_a) = 0
         AND count(*) FILTER (WHERE in_a AND in_b AND ({_DIFFERS})) = 0 AS is_schema_match
FROM j GROUP BY schema_name, table_name"""

_REF = f"""WITH {CATALOG}
SELECT referenced_schema_name, referenced_table_name, child_schema_name, child_table_name, foreign_key_name,
       string_agg(child_column_name, ',' ORDER BY constraint_column_id) AS constrained_columns,
       string_agg(referenced_column_name, ',' ORDER BY constraint_column_id) AS referred_columns
FROM cat_resolved {{where}}
GROUP BY referenced_schema_name, referenced_table_name, child_schema_name, child_table_name, foreign_key_name"""
ORACLES["referencing_tables"] = _REF.format(where="")
ORACLES["referencing_tables_no_self"] = _REF.format(where="WHERE parent_object_id <> referenced_object_id")

ORACLES["fk_type_mismatch"] = f"""WITH {CATALOG},
{META_A},
j AS (SELECT c.schema_name, c.table_name, c.column_name, r.foreign_key_name, r.referenced_schema_name, r.referenced_table_name,
             r.referenced_column_name, c.data_type AS c_dt, p.data_type AS p_dt, c.max_length AS c_ml, p.max_length AS p_ml,
             c.precision AS c_pr, p.precision AS p_pr, c.scale AS c_sc, p.scale AS p_sc
      FROM cat_resolved r
      JOIN meta_a c ON c.schema_name = r.child_schema_name AND c.table_name = r.child_table_name AND c.column_name = r.child_column_name
      JOIN meta_a p ON p.schema_name = r.referenced_schema_name AND p.table_name = r.referenced_table_name
                   AND p.column_name = r.referenced_column_name)
SELECT schema_name, table_name, column_name, foreign_key_name, referenced_schema_name, referenced_table_name, referenced_column_name,
       'data_type' AS attribute, c_dt AS child_value, p_dt AS parent_value FROM j WHERE c_dt IS DISTINCT FROM p_dt
UNION ALL
""" + _union([f"SELECT schema_name, table_name, column_name, foreign_key_name, referenced_schema_name, referenced_table_name, "
              f"referenced_column_name, '{a}', CAST(c_{s} AS VARCHAR), CAST(p_{s} AS VARCHAR) FROM j "
              f"WHERE c_{s} IS NOT NULL AND p_{s} IS NOT NULL AND c_{s} <> p_{s}"
              for a, s in (("max_length", "ml"), ("precision", "pr"), ("scale", "sc"))])

# one out-edge per table besides a self-reference: the walk from a node comes back or never does
_FK_WALK = f"""{CATALOG},
q AS (SELECT object_id, concat_ws('.', s.name, t.name) AS name FROM cat_tables t JOIN cat_schemas s USING (schema_id)),
e AS (SELECT DISTINCT pt.name AS src, rt.name AS dst FROM cat_fks f
      JOIN q pt ON pt.object_id = f.parent_object_id JOIN q rt ON rt.object_id = f.referenced_object_id),
e2 AS (SELECT * FROM e WHERE src <> dst),
r(origin, node, depth) AS (
  SELECT src, dst, 1 FROM e2
  UNION ALL
  SELECT r.origin, e2.dst, r.depth + 1 FROM r JOIN e2 ON r.node = e2.src
  WHERE r.node <> r.origin AND r.depth < (SELECT count(*) FROM e2)),
back AS (SELECT origin, depth AS len FROM r WHERE origin = node),
walk AS (SELECT r.origin, r.node, r.depth FROM r JOIN back ON r.origin = back.origin),
ring AS (SELECT origin AS node, min(node) AS component FROM walk GROUP BY origin),
member AS (SELECT node, component FROM ring UNION ALL SELECT src, src FROM e WHERE src = dst AND src NOT IN (SELECT node FROM ring))"""

ORACLES["fk_cycles"] = f"""WITH RECURSIVE {_FK_WALK},
path AS (
  SELECT origin AS component, count(*) AS cycle_len, origin || ' -> ' || string_agg(walk.node, ' -> ' ORDER BY depth) AS path
  FROM walk WHERE origin IN (SELECT component FROM ring) AND origin NOT IN (SELECT src FROM e WHERE src = dst) GROUP BY origin
  UNION ALL SELECT src, 1, src || ' -> ' || src FROM e WHERE src = dst)
SELECT m.component, count(*) AS n_nodes, p.cycle_len, p.path FROM member m JOIN path p ON p.component = m.component GROUP BY ALL"""

ORACLES["fk_cycle_components"] = f"""WITH RECURSIVE {_FK_WALK}
SELECT node, component FROM member"""

# closure of the whole graph: two nodes are in one component when each reaches the other
ORACLES["graph_cycle_witnesses"] = """WITH RECURSIVE e AS (
  SELECT c_custkey AS src, c_custkey // 31 * 31 + ((c_custkey % 31) * (c_custkey % 31) + 1) % 31 AS dst FROM customer
  UNION SELECT c_custkey, c_custkey // 31 * 31 + ((c_custkey % 31) * 5 + 3) % 31 FROM customer WHERE c_custkey % 4 = 0
  UNION SELECT c_custkey, c_custkey + 31 FROM customer WHERE c_custkey % 5 = 0),
r(origin, node) AS (SELECT src, dst FROM e UNION SELECT r.origin, e.dst FROM r JOIN e ON r.node = e.src),
member AS (SELECT a.origin AS node, least(a.origin, min(a.node)) AS component FROM r a JOIN r b ON a.origin = b.node AND a.node = b.origin GROUP BY a.origin),
d(root, node, depth) AS (
  SELECT src, dst, 1 FROM e WHERE src IN (SELECT component FROM member)
  UNION
  SELECT d.root, e.dst, d.depth + 1 FROM d JOIN e ON d.node = e.src JOIN member m ON m.node = e.dst AND m.component = d.root
  WHERE d.node <> d.root AND d.depth < (SELECT count(*) FROM member))
SELECT m.component, m.n_nodes, min(d.depth) AS cycle_len
FROM (SELECT component, count(*) AS n_nodes FROM member GROUP BY component) m JOIN d ON d.root = m.component AND d.node = m.component GROUP BY ALL"""

ORACLES["graph_cycle_nodes"] = """WITH RECURSIVE e AS (
  SELECT c_custkey AS src, (c_custkey * c_custkey + 1) % (SELECT count(*) FROM customer) AS dst FROM customer),
r(origin, node, depth) AS (
  SELECT src, dst, 1 FROM e
  UNION ALL
  SELECT r.origin, e.dst, r.depth + 1 FROM r JOIN e ON r.node = e.src
  WHERE r.node <> r.origin AND r.depth < (SELECT count(*) FROM e))
SELECT DISTINCT origin AS node FROM r WHERE origin = node"""

ORACLES["layer_pair_parity"] = f"""WITH {ORDERS_T}
SELECT s.n AS source_rows, t.n AS target_rows, s.n = t.n AS passed
FROM (SELECT count(*) AS n FROM orders) s, (SELECT count(*) AS n FROM orders_t) t"""

ORACLES |= suite_oracle.build(ORDERS_TARGET, CUSTOMER_OTHER)
ORACLES["scope_results"] = suite_oracle.scope(ORDERS_T, CUSTOMER_OTHER)

_TYPES = {"o_custkey": ("bigint", "int"), "o_orderdate": ("timestamp_ntz",) * 2, "o_orderkey": ("bigint",) * 2, "o_orderpriority": ("string",) * 2, "o_totalprice": ("double",) * 2}
ORACLES["schema_profile"] = f"WITH {ORDERS_TARGET}\n" + _union([f"""SELECT '{c}' AS column_name, '{a}' AS source_type, '{b}' AS target_type, {a == b} AS types_equal, true AS source_nullable, true AS target_nullable,
  (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM orders_target) AS target_rows, (SELECT count(*) - count({c}) FROM orders) AS source_nulls,
  (SELECT count(*) - count({c}) FROM orders_target) AS target_nulls, true AS nullable_ok""" for c, (a, b) in _TYPES.items()])

ORACLES["orphan_records"] = f"""WITH {LINEITEM_CHILD}, {ORDERS_PARENT},
g AS (SELECT c.l_orderkey, count(*) AS n FROM lineitem_child c LEFT JOIN orders_parent p ON c.l_orderkey = p.o_orderkey
      WHERE p.o_orderkey IS NULL GROUP BY c.l_orderkey)
SELECT 'lineitem' AS child_table, 'fk_lineitem_orders' AS foreign_key_name, 'l_orderkey' AS foreign_key_columns,
       '{{"l_orderkey":' || CASE WHEN l_orderkey IS NULL THEN 'null' ELSE '"' || CAST(l_orderkey AS VARCHAR) || '"' END || '}}'
         AS orphaned_values,
       n AS orphaned_count
FROM g"""


def _declared_constraints_sql() -> str:
    from paritas.plans.fixtures import FOREIGN_KEYS, PRIMARY_KEYS, UNIQUE_KEYS

    def row(table, check, column, metric, sv, tv, passed, detail):
        return (f"SELECT 'tpch' AS database_name, '{table}' AS table_name, '{check}' AS \"check\", '{column}' AS column_name, "
                f"'{metric}' AS metric, CAST({sv} AS VARCHAR) AS source_value, CAST({tv} AS VARCHAR) AS target_value, "
                f"{passed} AS passed, 'ok' AS status, {detail} AS detail")

    parts = []
    not_null: dict[str, list[str]] = {t: list(k) for t, k in PRIMARY_KEYS.items()}
    for _, child, cols, _, _ in FOREIGN_KEYS:
        not_null.setdefault(child, []).extend(c for c in cols if c not in not_null.get(child, []))
    for t, cols in not_null.items():
        for c in cols:
            n = f"(SELECT count(*) FROM {t} WHERE {c} IS NULL)"
            parts.append(row(t, "not_null_constraints", c, "null_or_nan", n, "NULL", f"{n} = 0", "NULL"))
    for t, cols in PRIMARY_KEYS.items():
        cl = ", ".join(cols)
        v = f"((SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT {cl} FROM {t})))"
        d = f"(SELECT count(*) FROM (SELECT {cl} FROM {t} GROUP BY {cl} HAVING count(*) > 1))"
        parts.append(row(t, "primary_key_uniqueness", ",".join(cols), "violations", v, d, f"{v} = 0", "'primary_key_1'"))
    for t, keys in UNIQUE_KEYS.items():
        for i, cols in enumerate(keys, start=2):
            cl, nn = ", ".join(cols), " AND ".join(f"{c} IS NOT NULL" for c in cols)
            v = f"((SELECT count(*) FROM {t} WHERE {nn}) - (SELECT count(*) FROM (SELECT DISTINCT {cl} FROM {t} WHERE {nn})))"
            d = f"(SELECT count(*) FROM (SELECT {cl} FROM {t} WHERE {nn} GROUP BY {cl} HAVING count(*) > 1))"
            parts.append(row(t, "unique_constraints", ",".join(cols), "violations", v, d, f"{v} = 0", f"'unique_{i}'"))
    for name, child, ccols, parent, pcols in FOREIGN_KEYS:
        on = " AND ".join(f"p.{p} = x.{c}" for c, p in zip(ccols, pcols))
        nn = " AND ".join(f"{c} IS NOT NULL" for c in ccols)
        miss = (f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(ccols)} FROM {child} WHERE {nn}) x "
                f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE {on}))")
        parts.append(row(child, "referential_integrity", ",".join(ccols), "missing_values", miss, "NULL", f"{miss} = 0", f"'{name}'"))
        on2 = " AND ".join(f"x.{c} = p.{p}" for c, p in zip(ccols, pcols))
        orph = (f"(SELECT count(*) FROM {child} x LEFT JOIN {parent} p ON {on2} WHERE "
                + " AND ".join(f"p.{p} IS NULL" for p in pcols) + ")")
        parts.append(row(parent, "orphaned_records", ",".join(ccols), "orphaned_rows", orph, "NULL", f"{orph} = 0",
                         f"'{name} from {child}'"))
    return _union(parts)


ORACLES["declared_constraints"] = _declared_constraints_sql()


_STAGED = """o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 59 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS o_custkey FROM orders WHERE o_orderkey % 97 <> 0),
so AS (FROM o UNION ALL FROM o WHERE o_orderkey % 101 = 0),
sc AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey % 31 <> 0),
lost AS (SELECT o_custkey, count(*) AS n FROM so WHERE o_custkey IS NULL OR o_custkey NOT IN (SELECT c_custkey FROM sc) GROUP BY o_custkey),
live_lost AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey)"""


def _two_schema_sql() -> dict[str, str]:
    row = lambda table, check, column, metric, sv, tv, detail, status="'ok'", passed=None: (
        f"SELECT '{table}' AS table_name, '{check}' AS \"check\", '{column}' AS column_name, '{metric}' AS metric, CAST({sv} AS VARCHAR) AS source_value, "
        f"CAST({tv} AS VARCHAR) AS target_value, {passed or f'({sv}) = 0'} AS passed, {status} AS status, {detail} AS detail")
    pk = lambda table, rel, key: row(table, "primary_key_uniqueness", key, "violations", f"(SELECT count(*) - count(DISTINCT {key}) FROM {rel})",
                                     f"(SELECT count(*) FROM (SELECT 1 FROM {rel} GROUP BY {key} HAVING count(*) > 1))", "'primary_key_1'")
    nn = lambda table, rel, c: row(table, "not_null_constraints", c, "null_or_nan", f"(SELECT count(*) FROM {rel} WHERE {c} IS NULL)", "NULL", "NULL")
    skipped = lambda table, check, column, metric, detail: row(table, check, column, metric, "NULL", "NULL", f"'{detail}'", "'skipped'", "CAST(NULL AS BOOLEAN)")
    rows = [pk("live.customer", "customer", "c_custkey"), pk("live.orders", "orders", "o_orderkey"), pk("stage.customer", "sc", "c_custkey"), pk("stage.orders", "so", "o_orderkey"),
            row("stage.orders", "unique_constraints", "o_custkey,o_orderkey", "violations", "(SELECT count(*) - count(DISTINCT (o_custkey, o_orderkey)) FROM so WHERE o_custkey IS NOT NULL)",
                "(SELECT count(*) FROM (SELECT 1 FROM so WHERE o_custkey IS NOT NULL GROUP BY o_custkey, o_orderkey HAVING count(*) > 1))", "'unique_2'"),
            nn("live.customer", "customer", "c_custkey"), nn("live.customer", "customer", "c_nationkey"), nn("live.orders", "orders", "o_orderkey"), nn("stage.customer", "sc", "c_custkey"),
            nn("stage.orders", "so", "o_orderkey"), nn("stage.orders", "so", "o_custkey"),
            row("stage.orders", "referential_integrity", "o_custkey", "missing_values", "(SELECT count(o_custkey) FROM lost)", "NULL", "'fk_customer'"),
            row("stage.customer", "orphaned_records", "o_custkey", "orphaned_rows", "(SELECT sum(n) FROM lost)", "NULL", "'fk_customer from stage.orders'"),
            row("live.orders", "referential_integrity", "o_custkey", "missing_values", "(SELECT count(*) FROM live_lost)", "NULL", "'fk_customer'"),
            row("live.customer", "orphaned_records", "o_custkey", "orphaned_rows", "(SELECT coalesce(sum(n), 0) FROM live_lost)", "NULL", "'fk_customer from live.orders'"),
            skipped("stage.customer", "referential_integrity", "c_nationkey", "missing_values", "fk_nation: no frame for nation"),
            skipped("stage.orders", "referential_integrity", "o_orderkey", "missing_values", "fk_gone: its target is not in the catalog")]
    sample = lambda table, check, column, detail, rel, shown, order: (
        f"SELECT * FROM (SELECT '{table}' AS table_name, '{check}' AS \"check\", '{column}' AS column_name, {shown} AS source_value, CAST(n AS VARCHAR) AS target_value, '{detail}' AS detail "
        f"FROM ({rel}) ORDER BY {order} LIMIT 10)")
    twice = "SELECT o_orderkey, o_custkey, count(*) AS n FROM so {0} GROUP BY ALL HAVING count(*) > 1"
    samples = [sample("stage.orders", "primary_key_uniqueness", "o_orderkey", "primary_key_1", twice.format(""), "CAST(o_orderkey AS VARCHAR)", "n DESC, o_orderkey"),
               sample("stage.orders", "unique_constraints", "o_custkey,o_orderkey", "unique_2", twice.format("WHERE o_custkey IS NOT NULL"), "concat(o_custkey, ', ', o_orderkey)",
                      "n DESC, CAST(concat('[\"{\\\\\"v\\\\\":', o_custkey, '}\",\"{\\\\\"v\\\\\":', o_orderkey, '}\"]') AS VARCHAR)"),
               sample("stage.orders", "referential_integrity", "o_custkey", "fk_customer", "FROM lost WHERE o_custkey IS NOT NULL",
                      "CASE WHEN o_custkey = 0 THEN '0' ELSE concat(rtrim(CAST(o_custkey AS VARCHAR), '0'), 'E', length(CAST(o_custkey AS VARCHAR)) - length(rtrim(CAST(o_custkey AS VARCHAR), '0'))) END", "source_value")]
    return {"two_schema_constraints": f"WITH {_STAGED}\n" + _union(rows), "declared_constraint_samples": f"WITH {_STAGED}\n" + _union(samples)}


ORACLES |= _two_schema_sql()
_mismatch = ORACLES["fk_type_mismatch"]
ORACLES["catalog_constraint_rows"] = f"""WITH m AS (SELECT attribute AS metric, count(*) AS n FROM ({_mismatch}) GROUP BY attribute),
c AS (SELECT count(*) AS n FROM ({ORACLES["fk_cycles"]}))
SELECT 'foreign_key_datatype_consistency' AS "check", metric, false AS passed, n, CAST(NULL AS VARCHAR) AS total FROM m
UNION ALL SELECT 'circular_references', 'cycle', false, n, NULL FROM c WHERE n > 0
UNION ALL SELECT 'foreign_key_datatype_consistency', 'total', coalesce(sum(n), 0) = 0, 1, CAST(coalesce(sum(n), 0) AS BIGINT)::VARCHAR FROM m
UNION ALL SELECT 'circular_references', 'total', n = 0, 1, n::VARCHAR FROM c"""
