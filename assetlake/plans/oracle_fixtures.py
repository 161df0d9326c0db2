"""The derived resource tables of ``sources/derived.py`` written as DuckDB SQL.

Used only by the independent SQL oracle (``oracle_sql()``): each entry is a
CTE body over the driver views; ``with_ctes`` prepends the CTEs a query
needs, in dependency order.
"""

from __future__ import annotations

B = "1700000000000"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (sql, deps)


# ----------------------------------------------------------------- data sets
for side, base, where in (("src", 500, ""), ("tgt", 900, "WHERE r_regionkey <> 3")):
    cte(f"{side}_data_sets", f"""
SELECT CAST({base} + r_regionkey AS BIGINT) AS id, 'ds:' || r_name AS external_id, r_name AS name,
       'data set ' || r_name AS description, MAP {{'region': CAST(r_regionkey AS VARCHAR)}} AS metadata,
       (r_regionkey % 2 = 0) AS write_protected,
       CAST({B} + r_regionkey * 1000 AS BIGINT) AS created_time,
       CAST({B} + r_regionkey * 1000 + 3600000 AS BIGINT) AS last_updated_time
FROM region {where}""")


# -------------------------------------------------------------------- assets
def _asset(src_id, ext, name, parent_src, parent_ext, descr, root_src, region, labels, metadata, target):
    tid = (lambda c: f"CAST(({c}) * 10 + 7 AS BIGINT)") if target else (lambda c: f"CAST({c} AS BIGINT)")
    ds = (f"CAST(CASE WHEN ({region}) <> 3 THEN 900 + ({region}) END AS BIGINT)" if target
          else f"CAST(500 + ({region}) AS BIGINT)")
    pext = parent_ext if target else "CAST(NULL AS VARCHAR)"
    return (f"{tid(src_id)} AS id, {ext} AS external_id, {name} AS name, {tid(parent_src)} AS parent_id, "
            f"{pext} AS parent_external_id, {descr} AS description, {tid(root_src)} AS root_id, "
            f"'tpch' AS source, CAST({B} + (({src_id}) % 1000000) * 1000 AS BIGINT) AS created_time, "
            f"CAST({B} + (({src_id}) % 1000000) * 4000000 AS BIGINT) AS last_updated_time, "
            f"{ds} AS data_set_id, {labels} AS labels, {metadata} AS metadata")


for side in ("src", "tgt"):
    target = side == "tgt"
    rk = "CAST(r_regionkey AS BIGINT)"
    regions = _asset(f"1000000 + {rk}", f"'R:' || CAST({rk} AS VARCHAR)", "r_name", "CAST(NULL AS BIGINT)",
                     "CAST(NULL AS VARCHAR)", "'region ' || r_name", f"1000000 + {rk}", rk, "['region']",
                     "MAP {'level': 'region'}", target)
    nk, nrk = "CAST(n_nationkey AS BIGINT)", "CAST(n_regionkey AS BIGINT)"
    nations = _asset(f"2000000 + {nk}", f"'N:' || CAST({nk} AS VARCHAR)", "n_name", f"1000000 + {nrk}",
                     f"'R:' || CAST({nrk} AS VARCHAR)", "'nation ' || n_name", f"1000000 + {nrk}", nrk,
                     "CAST([] AS VARCHAR[])", "MAP {'level': 'nation'}", target)
    ck = "c.c_custkey"
    src_ext = f"CASE WHEN {ck} % 97 <> 0 THEN 'C:' || CAST({ck} AS VARCHAR) END"
    ext = f"COALESCE({src_ext}, CAST(3000000 + {ck} AS VARCHAR))" if target else src_ext
    name = f"CASE WHEN {ck} % 7 = 0 THEN c.c_name || '-old' ELSE c.c_name END" if target else "c.c_name"
    nk_c = (f"CASE WHEN {ck} % 11 = 0 THEN (CAST(c.c_nationkey AS BIGINT) + 1) % 25 "
            f"ELSE CAST(c.c_nationkey AS BIGINT) END") if target else "CAST(c.c_nationkey AS BIGINT)"
    cust_filter = f"WHERE {ck} % 10 <> 9" if target else ""
    customers = _asset(f"3000000 + {ck}", ext, name, "2000000 + cc.nk", "'N:' || CAST(cc.nk AS VARCHAR)",
                       "'segment ' || cc.c_mktsegment", "1000000 + CAST(n.n_regionkey AS BIGINT)",
                       "CAST(n.n_regionkey AS BIGINT)", "['seg:' || cc.c_mktsegment]",
                       "MAP {'level': 'customer'}", target).replace("c.c_name", "cc.c_name").replace(
                           "c.c_custkey", "cc.c_custkey")
    sql = f"""
SELECT {regions} FROM region
UNION ALL SELECT {nations} FROM nation
UNION ALL SELECT {customers}
FROM (SELECT c.c_custkey, c.c_name, c.c_mktsegment, {nk_c} AS nk FROM customer c {cust_filter}) cc
JOIN nation n ON CAST(n.n_nationkey AS BIGINT) = cc.nk"""
    if target:
        sk, snk, srk = "s.s_suppkey", "CAST(s.s_nationkey AS BIGINT)", "CAST(n.n_regionkey AS BIGINT)"
        suppliers = _asset(f"4000000 + {sk}", f"'S:' || CAST({sk} AS VARCHAR)", "s.s_name", f"2000000 + {snk}",
                           f"'N:' || CAST({snk} AS VARCHAR)", "'supplier'", f"1000000 + {srk}", srk,
                           "CAST([] AS VARCHAR[])", "MAP {'level': 'supplier'}", True)
        sql += f"\nUNION ALL SELECT {suppliers} FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"
    cte(f"{side}_assets", sql)


# -------------------------------------------------------------------- events
cte("src_events", f"""
SELECT event_id AS id,
       CASE WHEN event_id % 13 <> 0 THEN 'ev:' || CAST(event_id AS VARCHAR) END AS external_id,
       CAST(CASE WHEN event_id % 17 = 0 THEN -1 WHEN event_id % 37 = 0 THEN NULL ELSE (epoch_us(ts) // 1000) END AS BIGINT) AS start_time,
       CAST(CASE WHEN event_id % 19 = 0 THEN -5 WHEN event_id % 23 = 0 THEN (epoch_us(ts) // 1000) - 1000
                 WHEN event_id % 29 = 0 THEN 253402300800000 WHEN event_id % 5 = 0 THEN NULL
                 ELSE (epoch_us(ts) // 1000) + CAST(trunc(value * 1000) AS BIGINT) END AS BIGINT) AS end_time,
       CASE WHEN event_id % 31 = 0 THEN repeat('x', 600) WHEN event_id % 41 = 0 THEN repeat('y', 500)
            WHEN event_id % 43 = 0 THEN repeat('z', 501) ELSE props END AS description,
       event_type AS type, CAST(event_id % 4 AS VARCHAR) AS subtype, 'events' AS source,
       CASE WHEN event_id % 11 = 0 THEN CAST([] AS BIGINT[])
            WHEN event_id % 53 = 0 THEN [CAST(9999999 AS BIGINT)]
            WHEN event_id % 7 = 0 THEN [3000000 + user_id, 3000009 + user_id, 3000000 + user_id]
            ELSE [3000000 + user_id, 3000009 + user_id] END AS asset_ids,
       (epoch_us(ts) // 1000) AS created_time, (epoch_us(ts) // 1000) + event_id % 3600000 AS last_updated_time,
       CAST(500 + user_id % 6 AS BIGINT) AS data_set_id,
       MAP {{'user': CAST(user_id AS VARCHAR)}} AS metadata
FROM events""")

cte("tgt_events", """
SELECT CAST(NULL AS BIGINT) AS id, COALESCE(external_id, CAST(id AS VARCHAR)) AS external_id,
       start_time, end_time, 'old' AS description, type, subtype, source, CAST([] AS BIGINT[]) AS asset_ids,
       created_time, last_updated_time - 86400000 AS last_updated_time, CAST(NULL AS BIGINT) AS data_set_id, metadata
FROM src_events WHERE id % 3 = 0""", ("src_events",))

# --------------------------------------------------------------- time series
cte("ts_headers", f"""
SELECT CAST(7000000 + u AS BIGINT) AS id,
       CASE WHEN u % 13 <> 0 THEN 'ts:' || CAST(u AS VARCHAR) END AS external_id,
       CASE WHEN u % 20 = 0 THEN 'SYS-' || CAST(u AS VARCHAR) ELSE 'series ' || CAST(u AS VARCHAR) END AS name,
       'user ' || CAST(u AS VARCHAR) AS description, (u % 25 = 0) AS is_string, (u % 3 = 0) AS is_step,
       'kW' AS unit, CAST(3000000 + u AS BIGINT) AS asset_id,
       CASE WHEN u % 10 = 3 THEN [CAST(1 AS BIGINT), CAST(2 AS BIGINT)] ELSE CAST([] AS BIGINT[]) END AS security_categories,
       CAST({B} + u * 1000 AS BIGINT) AS created_time, CAST({B} + u * 60000000 AS BIGINT) AS last_updated_time,
       CAST(500 + u % 6 AS BIGINT) AS data_set_id, MAP {{'user': CAST(u AS VARCHAR)}} AS metadata
FROM (SELECT DISTINCT user_id AS u FROM events)""")

cte("ts_points", """
SELECT CAST(7000000 + u AS BIGINT) AS id,
       CASE WHEN u % 13 <> 0 THEN 'ts:' || CAST(u AS VARCHAR) END AS external_id,
       t AS timestamp, CASE WHEN u % 25 <> 0 THEN v END AS value, CASE WHEN u % 25 = 0 THEN vs END AS value_string
FROM (SELECT user_id AS u, (epoch_us(ts) // 1000) AS t, max(value) AS v, max(event_type) AS vs FROM events GROUP BY 1, 2)""")

# ----------------------------------------------------------------- sequences
cte("seq_headers", f"""
SELECT CAST(8000000 + o_orderkey AS BIGINT) AS id,
       CASE WHEN o_orderkey % 97 <> 0 THEN 'seq:' || CAST(o_orderkey AS VARCHAR) END AS external_id,
       'order ' || CAST(o_orderkey AS VARCHAR) AS name, o_orderpriority AS description,
       CAST(3000000 + o_custkey AS BIGINT) AS asset_id, MAP {{'status': o_orderstatus}} AS metadata,
       [{{'name': 'quantity', 'external_id': 'qty', 'description': 'line quantity', 'value_type': 'DOUBLE', 'metadata': MAP {{'kind': 'measure'}}, 'created_time': CAST({B} AS BIGINT), 'last_updated_time': CAST({B} AS BIGINT)}},
        {{'name': 'price', 'external_id': 'price', 'description': 'extended price', 'value_type': 'DOUBLE', 'metadata': MAP {{'kind': 'money'}}, 'created_time': CAST({B} AS BIGINT), 'last_updated_time': CAST({B} AS BIGINT)}},
        {{'name': 'flag', 'external_id': 'flag', 'description': 'return flag', 'value_type': 'STRING', 'metadata': MAP {{'kind': 'code'}}, 'created_time': CAST({B} AS BIGINT), 'last_updated_time': CAST({B} AS BIGINT)}},
        {{'name': 'late', 'external_id': 'late', 'description': 'line status F', 'value_type': 'BOOLEAN', 'metadata': MAP {{'kind': 'status'}}, 'created_time': CAST({B} AS BIGINT), 'last_updated_time': CAST({B} AS BIGINT)}}] AS columns,
       (epoch_us(o_orderdate) // 1000) AS created_time, (epoch_us(o_orderdate) // 1000) + (o_orderkey % 1000) * 3600000 AS last_updated_time,
       CAST(500 + o_custkey % 6 AS BIGINT) AS data_set_id
FROM orders""")

cte("seq_rows", """
SELECT CAST(8000000 + l_orderkey AS BIGINT) AS id,
       CASE WHEN l_orderkey % 97 <> 0 THEN 'seq:' || CAST(l_orderkey AS VARCHAR) END AS external_id,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                l_quantity, l_extendedprice) - 1 AS BIGINT) AS row_number,
       CAST(l_quantity AS VARCHAR) AS c_qty,
       CASE WHEN l_partkey % 50 = 0 THEN '' ELSE CAST(l_extendedprice AS VARCHAR) END AS c_price,
       l_returnflag AS c_flag, CASE WHEN l_linestatus = 'F' THEN 'true' ELSE 'false' END AS c_late
FROM lineitem""")

# --------------------------------------------------------------------- files
cte("src_files", f"""
SELECT CAST(9000000 + page_id AS BIGINT) AS id,
       CASE WHEN page_id % 13 <> 0 THEN 'file:' || CAST(page_id AS VARCHAR) END AS external_id,
       CAST({B} + page_id * 1000 AS BIGINT) AS source_created_time,
       CAST({B} + page_id * 1000 + 3600000 AS BIGINT) AS source_modified_time,
       CASE WHEN page_id % 5 = 0 THEN 'page-' || CAST(page_id AS VARCHAR) || '.html'
            WHEN page_id % 7 = 0 THEN translate(url, '/', '\\')
            WHEN page_id % 11 = 0 THEN url || '\\x' ELSE url END AS name,
       '/web' AS directory, 'text/html' AS mime_type, 'crawler' AS source,
       CASE WHEN page_id % 17 = 0 THEN CAST([] AS BIGINT[])
            ELSE [3000000 + page_id, 3000000 + page_id * 2] END AS asset_ids,
       CAST([] AS BIGINT[]) AS security_categories,
       ['lb:' || CAST(page_id % 5 AS VARCHAR), 'lb:bad' || CAST(page_id % 3 AS VARCHAR)] AS labels,
       (page_id % 4 <> 0) AS uploaded,
       CAST(CASE WHEN page_id % 4 <> 0 THEN {B} + page_id * 1000 + 60000 END AS BIGINT) AS uploaded_time,
       CAST({B} + page_id * 1000 AS BIGINT) AS created_time,
       CAST({B} + (page_id % 250) * 40000000 AS BIGINT) AS last_updated_time,
       CAST(500 + page_id % 6 AS BIGINT) AS data_set_id,
       MAP {{'length': CAST(length(html) AS VARCHAR)}} AS metadata, html AS content
FROM pages""")

# -------------------------------------------------------------------- labels
cte("src_labels", f"""
SELECT 'lb:' || CAST(r_regionkey AS VARCHAR) AS external_id, 'label ' || r_name AS name,
       'region label' AS description, CAST(500 + r_regionkey AS BIGINT) AS data_set_id,
       CAST({B} + r_regionkey * 1000 AS BIGINT) AS created_time
FROM region
UNION ALL
SELECT p_brand, lower(p_brand), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
FROM (SELECT DISTINCT p_brand FROM part)""")

cte("tgt_labels", f"""
SELECT 'lb:' || CAST(r_regionkey AS VARCHAR) AS external_id, 'label ' || r_name AS name,
       'region label' AS description, CAST(900 + r_regionkey AS BIGINT) AS data_set_id,
       CAST({B} + r_regionkey * 1000 AS BIGINT) AS created_time
FROM region WHERE r_regionkey < 4""")

# ------------------------------------------------------------- relationships
cte("src_relationships", """
SELECT 'rel:' || CAST(p AS VARCHAR) || ':' || CAST(s AS VARCHAR) AS external_id,
       'P:' || CAST(p AS VARCHAR) AS source_external_id, 'ASSET' AS source_type,
       'S:' || CAST(s AS VARCHAR) AS target_external_id,
       CASE WHEN s % 2 = 0 THEN 'ASSET' ELSE 'EVENT' END AS target_type,
       start_time, end_time, confidence, CAST(500 + p % 6 AS BIGINT) AS data_set_id,
       ['lb:' || CAST(p % 5 AS VARCHAR)] AS labels, start_time AS created_time, end_time AS last_updated_time
FROM (SELECT l_partkey AS p, l_suppkey AS s, min((epoch_us(l_shipdate) // 1000)) AS start_time,
             max((epoch_us(l_shipdate) // 1000)) AS end_time, round(avg(l_discount), 4) AS confidence
      FROM lineitem GROUP BY 1, 2)""")

# ----------------------------------------------------------------------- raw
# One row per (db, table, key, column) with the column value already as text
# (strings verbatim, other kinds as JSON).
cte("src_raw_cells", f"""
SELECT 'geo' AS db_name, 'nation' AS table_name, CAST(n_nationkey AS VARCHAR) AS key,
       CAST({B} + CAST(n_nationkey AS BIGINT) * 4000000 AS BIGINT) AS last_updated_time, c.k AS col, c.v AS val
FROM nation, (SELECT UNNEST([
    {{'k': 'name', 'v': n_name}},
    {{'k': 'region', 'v': CAST(CAST(n_regionkey AS DOUBLE) AS VARCHAR)}},
    {{'k': 'ref', 'v': '{{"region":' || CAST(n_regionkey AS VARCHAR) || '}}'}},
    {{'k': 'note', 'v': CASE WHEN n_nationkey % 5 = 0 THEN 'null'
                            WHEN n_nationkey % 2 = 0 THEN 'true' ELSE 'false' END}}]) AS c)
UNION ALL
SELECT 'geo', 'region', CAST(r_regionkey AS VARCHAR), CAST({B} + CAST(r_regionkey AS BIGINT) * 4000000 AS BIGINT),
       'name', r_name FROM region
UNION ALL
SELECT 'sales', 'supplier', CAST(s_suppkey AS VARCHAR), CAST({B} + s_suppkey * 4000000 AS BIGINT), c.k, c.v
FROM supplier, (SELECT UNNEST([
    {{'k': 'name', 'v': s_name}},
    {{'k': 'acctbal', 'v': CAST(s_acctbal AS VARCHAR)}},
    {{'k': 'nation', 'v': CAST(CAST(s_nationkey AS DOUBLE) AS VARCHAR)}}]) AS c)
UNION ALL
SELECT 'sales', 'part', CAST(p_partkey AS VARCHAR), CAST({B} + p_partkey * 4000000 AS BIGINT), c.k, c.v
FROM part, (SELECT UNNEST([
    {{'k': 'name', 'v': p_name}},
    {{'k': 'brand', 'v': p_brand}},
    {{'k': 'size', 'v': CAST(CAST(p_size AS DOUBLE) AS VARCHAR)}},
    {{'k': 'tags', 'v': CASE WHEN p_size % 10 = 0 THEN '["big","round"]' ELSE 'null' END}}]) AS c)""")

cte("src_raw", """
SELECT db_name, table_name, key, last_updated_time,
       array_to_string(list_sort(list(col || '=' || val)), ';') AS columns_text
FROM src_raw_cells GROUP BY db_name, table_name, key, last_updated_time""", ("src_raw_cells",))


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the named CTEs and their dependencies."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = [f"{n} AS ({CTES[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body
