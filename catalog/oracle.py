"""The registered queries in plain SQL."""

from __future__ import annotations

from catalog.fixtures import FIXTURE_SQL

_ALL = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, ver"

_MATCHED = "ord_t t LEFT JOIN ord_s s ON t.o_orderkey = s.o_orderkey"
_MATCHED_WITH_TOKEN = f"{_MATCHED} AND t.ver = s.ver"
_HIT = "s.o_orderkey IS NOT NULL"

_NEW_ROWS = f"""SELECT {_ALL} FROM ord_s s
WHERE NOT EXISTS (SELECT 1 FROM ord_t t WHERE t.o_orderkey = s.o_orderkey)"""


def _after_update(join: str, ver: str = "t.ver", more: str = "") -> str:
    return f"""SELECT t.o_orderkey,
  CASE WHEN {_HIT} THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
  CASE WHEN {_HIT} THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN {_HIT} THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
  CASE WHEN {_HIT} THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
  {ver} AS ver{more}
FROM {join}"""


def _after_merge(source: str) -> str:
    return f"""SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
  CASE WHEN {_HIT} THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
  CASE WHEN {_HIT} THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN {_HIT} THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
  CASE WHEN {_HIT} THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
  CASE WHEN t.o_orderkey IS NULL THEN s.ver ELSE t.ver END AS ver
FROM ord_t t FULL OUTER JOIN {source} s ON t.o_orderkey = s.o_orderkey"""


_UPSERTED = _after_merge("ord_s")
_ACTIONS = """SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
  CASE WHEN t.o_orderkey IS NULL THEN 'INSERT' WHEN s.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action
FROM ord_t t FULL OUTER JOIN ord_s s ON t.o_orderkey = s.o_orderkey"""
_NEXT_VERSION = "(SELECT max(ver) + 1 FROM ord_t)"
_PART_COLUMNS = "p_name, p_brand, p_type, p_size, p_retailprice"
_LINE_ORDER = """l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
  l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"""

_COMPUTED = f"""SELECT {_ALL}, CAST(o_totalprice * 0.5 AS DOUBLE) AS half_price, o_totalprice + 1 AS paid
FROM (SELECT {_ALL} FROM ord_t UNION ALL SELECT {_ALL} FROM ord_new) both_parts"""

_BODIES = {
    "bulk_append": f"SELECT {_ALL} FROM ord_t UNION ALL SELECT {_ALL} FROM ord_new",
    "append_subset_defaults": f"""SELECT {_ALL} FROM ord_t UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'NONE', ver FROM ord_new""",
    "append_null_defaults": f"""SELECT {_ALL} FROM ord_t UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus,
  coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, 0.0), o_orderpriority, ver FROM ord_new""",
    "typed_append": f"""SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_custkey, o_orderstatus,
  CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS o_totalprice, o_orderpriority, ver
FROM (SELECT {_ALL} FROM ord_t UNION ALL SELECT {_ALL} FROM ord_new) both_parts""",
    "enum_codes": f"""SELECT o_orderkey,
  CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS INTEGER) AS status_code,
  o_orderstatus
FROM (SELECT {_ALL} FROM ord_t UNION ALL SELECT {_ALL} FROM ord_new) both_parts""",
    "computed_column": f"""SELECT {_ALL}, CAST(o_totalprice * 0.5 AS DOUBLE) AS half_price
FROM ({_after_update(_MATCHED)}) updated""",
    "computed_on_insert": _COMPUTED,
    "computed_on_merge": _COMPUTED,
    "merge_null_keys": f"""SELECT * FROM (
  SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    o_orderpriority, ver FROM ord_s) s
UNION ALL
SELECT {_ALL} FROM ord_t t
WHERE NOT EXISTS (SELECT 1 FROM ord_s s WHERE s.o_orderstatus <> 'P' AND s.o_orderkey = t.o_orderkey)""",
    "insert_if_missing": f"SELECT {_ALL} FROM ord_t UNION ALL {_NEW_ROWS}",
    "insert_if_missing_output": f"SELECT o_orderkey, 'INSERT' AS action FROM ({_NEW_ROWS}) added",
    "insert_null_keys": f"""SELECT {_ALL} FROM ord_t UNION ALL
SELECT {_ALL} FROM (
  SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    o_orderpriority, ver FROM ord_s) s
WHERE NOT EXISTS (SELECT 1 FROM ord_t t WHERE t.o_orderkey = s.o_orderkey)""",
    "insert_identity": f"""SELECT p_partkey, {_PART_COLUMNS} FROM part UNION ALL
SELECT (SELECT max(p_partkey) FROM part) + 1 + position, {_PART_COLUMNS} FROM part_new""",
    "insert_output": """SELECT position AS __bulk_index, 'INSERT' AS action,
  (SELECT max(p_partkey) FROM part) + 1 + position AS p_partkey FROM part_new""",
    "insert_keep_identity": f"""SELECT p_partkey, {_PART_COLUMNS} FROM part UNION ALL
SELECT origin + 1000000000, {_PART_COLUMNS} FROM part_new""",
    "update_by_key": _after_update(_MATCHED),
    "update_subset": f"""SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice,
  CASE WHEN {_HIT} THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority, t.ver FROM {_MATCHED}""",
    "update_natural_key": """SELECT p.p_partkey, p.p_name,
  CASE WHEN s.p_name IS NOT NULL THEN s.p_brand ELSE p.p_brand END AS p_brand, p.p_type, p.p_size, p.p_retailprice
FROM part p LEFT JOIN part_s s ON p.p_name = s.p_name""",
    "mapped_update": f"""SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus,
  CASE WHEN {_HIT} THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
  CASE WHEN {_HIT} THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority, t.ver FROM {_MATCHED}""",
    "update_token_checked": _after_update(_MATCHED_WITH_TOKEN),
    "update_output": """SELECT s.seq AS __bulk_index, 'UPDATE' AS action, t.o_orderkey, s.o_totalprice, s.o_orderpriority
FROM ord_t t JOIN ord_s s ON t.o_orderkey = s.o_orderkey AND t.ver = s.ver""",
    "collated_update": """SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal,
  CASE WHEN d.c_acctbal < 0 THEN 'OVERDRAWN' ELSE 'IN CREDIT' END AS c_mktsegment
FROM customer c JOIN (SELECT upper(c_name) AS c_name, c_acctbal FROM customer) d
ON lower(c.c_name) = lower(d.c_name)""",
    "delete_by_key": f"""SELECT {_ALL} FROM ord_t t
WHERE NOT EXISTS (SELECT 1 FROM ord_s s WHERE s.o_orderkey = t.o_orderkey)""",
    "delete_slim_source": """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM customer d WHERE d.c_acctbal < 0 AND d.c_name = c.c_name)""",
    "delete_rows_removed": """SELECT o_orderkey FROM ord_t t
WHERE EXISTS (SELECT 1 FROM ord_s s WHERE s.o_orderkey = t.o_orderkey)""",
    "delete_token_checked": f"""SELECT {_ALL} FROM ord_t t
WHERE NOT EXISTS (SELECT 1 FROM ord_s s WHERE s.o_orderkey = t.o_orderkey AND s.ver = t.ver)""",
    "merge_upsert": _UPSERTED,
    "merge_mirror": """SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderpriority,
  CASE WHEN t.o_orderkey IS NULL THEN s.ver ELSE t.ver END AS ver
FROM ord_s s LEFT JOIN ord_t t ON t.o_orderkey = s.o_orderkey""",
    "merge_actions": _ACTIONS,
    "merge_counts": f"""SELECT count(*) FILTER (action = 'INSERT') AS inserted, count(*) FILTER (action = 'UPDATE') AS updated,
  count(*) FILTER (action = 'DELETE') AS deleted, count(action) AS total_affected FROM ({_ACTIONS}) acted""",
    "merge_token_checked": f"{_after_update(_MATCHED_WITH_TOKEN)} UNION ALL {_NEW_ROWS}",
    "merge_insert_columns": f"""{_after_update(_MATCHED)} UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'NONE', ver FROM ({_NEW_ROWS}) added""",
    "merge_insert_only": f"SELECT {_ALL} FROM ord_t UNION ALL {_NEW_ROWS}",
    "merge_dedup_last": _after_merge(
        "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS rn FROM ord_d) d"
        " WHERE rn = 1)"
    ),
    "merge_insert_identity": f""", part_last AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY position DESC) AS rn FROM part_m) ranked WHERE rn = 1)
SELECT p.p_partkey, p.p_name,
  CASE WHEN s.p_name IS NOT NULL THEN s.p_brand ELSE p.p_brand END AS p_brand,
  CASE WHEN s.p_name IS NOT NULL THEN s.p_type ELSE p.p_type END AS p_type,
  CASE WHEN s.p_name IS NOT NULL THEN s.p_size ELSE p.p_size END AS p_size,
  CASE WHEN s.p_name IS NOT NULL THEN s.p_retailprice ELSE p.p_retailprice END AS p_retailprice
FROM part p LEFT JOIN part_last s ON p.p_name = s.p_name
UNION ALL SELECT (SELECT max(p_partkey) FROM part) + 1 + position, {_PART_COLUMNS} FROM part_last s
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_name = s.p_name)""",
    "merge_empty_source": f"SELECT {_ALL} FROM ord_t",
    "merge_output": """SELECT s.seq AS __bulk_index, CASE WHEN t.o_orderkey IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS action,
  s.o_orderkey, s.o_totalprice, s.o_orderpriority
FROM ord_s s LEFT JOIN ord_t t ON t.o_orderkey = s.o_orderkey""",
    "write_back": f"""SELECT s.o_orderkey, s.seq,
  CASE WHEN t.o_orderkey IS NULL OR t.ver = s.ver THEN {_NEXT_VERSION} ELSE s.ver END AS ver
FROM ord_s s LEFT JOIN ord_t t ON t.o_orderkey = s.o_orderkey""",
    "row_version_bump": f"""{_after_update(_MATCHED_WITH_TOKEN, f"CASE WHEN {_HIT} THEN {_NEXT_VERSION} ELSE t.ver END")}
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, {_NEXT_VERSION}
FROM ({_NEW_ROWS}) added""",
    "dedup_last": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn FROM lineitem) ranked WHERE rn = 1""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "unique_violations": """SELECT o_orderkey, count(*) AS copies
FROM (SELECT o_orderkey FROM ord_t UNION ALL SELECT o_orderkey FROM ord_s) grown
GROUP BY o_orderkey HAVING count(*) > 1""",
    "constraint_rejects": """SELECT * FROM (
  SELECT p_partkey, CASE WHEN p_size <> 7 THEN p_name END AS p_name FROM part) sent
WHERE p_name IS NULL OR length(p_name) > 10""",
    "stale_rows": """SELECT s.o_orderkey, s.ver FROM ord_s s JOIN ord_t t ON t.o_orderkey = s.o_orderkey
WHERE t.ver <> s.ver""",
    "unmatched_source": f"SELECT o_orderkey FROM ({_NEW_ROWS}) added",
    "op_chain": f""", ord_all AS (SELECT {_ALL} FROM ord_t UNION ALL SELECT {_ALL} FROM ord_new)
{_after_update("ord_all t LEFT JOIN ord_s s ON t.o_orderkey = s.o_orderkey")}
WHERE NOT EXISTS (SELECT 1 FROM orders f WHERE f.o_orderstatus = 'F' AND f.o_orderkey = t.o_orderkey)""",
    "ordered_key_layout": _UPSERTED,
    "bucketed_merge": _UPSERTED,
    "partitioned_merge": _UPSERTED,
    "catalog_commit": _UPSERTED,
    "catalog_commit_buckets": _UPSERTED,
    "catalog_defaults": f"""SELECT {_ALL} FROM ord_t UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'NONE', ver FROM ord_new""",
    "chain_counts": """, ended AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'),
left_over AS (SELECT o_orderkey FROM ord_t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ended)),
known AS (SELECT count(*) AS n FROM ord_s WHERE o_orderkey IN (SELECT o_orderkey FROM left_over)),
fresh AS (SELECT count(*) AS n FROM ord_s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM left_over)),
again AS (SELECT count(*) AS n FROM ord_s WHERE o_orderkey IN (SELECT o_orderkey FROM ended)),
gone AS (SELECT count(*) AS n FROM ord_t WHERE o_orderkey IN (SELECT o_orderkey FROM ended))
SELECT 0::INTEGER AS step, 0::BIGINT AS inserted, 0::BIGINT AS updated, n AS deleted, n AS total_affected FROM gone
UNION ALL SELECT 1, fresh.n, known.n, 0, fresh.n + known.n FROM fresh, known
UNION ALL SELECT 2, 0, 0, n, n FROM again""",
    "stream_changes": "SELECT user_id, 'INSERT' AS action, max(event_id) AS event_id FROM events GROUP BY user_id",
    "stream_merge": """SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) ranked WHERE rn = 1""",
}

ORACLE_SQL = {name: FIXTURE_SQL + body for name, body in _BODIES.items()}
