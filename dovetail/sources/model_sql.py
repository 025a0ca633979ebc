"""DuckDB twins of :mod:`dovetail.sources.model` for the oracle statements.

Written independently in SQL; ``with_model(body, names)`` prefixes a statement
with the named derived tables as common table expressions.
"""

from __future__ import annotations

from dovetail.sources.model import DIC_ROWS, RUN_DATE

_DIC_VALUES = ", ".join(f"('{a}', '{b}')" for a, b in DIC_ROWS)

MODEL = {
    "dic": f"SELECT * FROM (VALUES {_DIC_VALUES}) AS t(id, name)",
    "order_info": """
        SELECT o_orderkey AS order_id, 'NO' || CAST(o_orderkey AS VARCHAR) AS order_no,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '60999'
                    ELSE '600' || substr(o_orderpriority, 1, 1) || '0' END AS status,
               CASE WHEN o_orderstatus = 'O' THEN '65001' ELSE '65002' END AS collect_type,
               CASE WHEN o_orderstatus = 'O' THEN '66001' WHEN o_orderstatus = 'F' THEN '66002'
                    ELSE '66003' END AS payment_type,
               o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(16,2)) AS amount,
               o_orderdate AS create_time,
               CAST(10000 + o_custkey % 10 AS BIGINT) AS receiver_district_id,
               o_custkey AS receiver_complex_id, 'Customer' || CAST(o_custkey AS VARCHAR) AS receiver_name,
               CAST(1 + o_orderkey % 7 AS BIGINT) AS cargo_num,
               CAST(o_orderdate AS DATE) + 7 AS estimate_arrive_date
        FROM orders""",
    "order_cargo": """
        SELECT CAST(10 * l_orderkey + l_linenumber AS BIGINT) AS id, l_orderkey AS order_id, l_linenumber AS line_no,
               p_type AS cargo_type, CAST(l_quantity AS DECIMAL(16,2)) AS weight,
               CAST(trunc(l_quantity) AS BIGINT) AS volume_length, CAST(l_linenumber AS BIGINT) AS volume_width,
               CAST(1 + l_partkey % 40 AS BIGINT) AS volume_height,
               l_suppkey + 10000 AS sender_district_id,
               CAST(CASE WHEN n_nationkey IS NOT NULL THEN s_nationkey + 100 END AS BIGINT) AS sender_city_id,
               CAST(n_regionkey + 1 AS BIGINT) AS sender_province_id, l_suppkey AS sender_complex_id,
               'Supplier' || CAST(l_suppkey AS VARCHAR) AS sender_name,
               l_shipdate AS update_time,
               CAST(l_quantity * l_linenumber AS DECIMAL(16,2)) AS volume,
               CAST(l_quantity * 10 AS DECIMAL(16,2)) AS distance
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
                      LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "areas": """
        SELECT s_suppkey + 10000 AS district_id, CAST(n_nationkey + 100 AS BIGINT) AS city_id,
               CAST(n_regionkey + 1 AS BIGINT) AS province_id
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "region_info": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, CAST(0 AS BIGINT) AS parent_id, r_name AS name,
               'province' AS dict_code FROM region
        UNION ALL
        SELECT CAST(n_nationkey + 100 AS BIGINT), CAST(n_regionkey + 1 AS BIGINT), n_name, 'city' FROM nation
        UNION ALL
        SELECT s_suppkey + 10000, CAST(s_nationkey + 100 AS BIGINT), 'DISTRICT_' || CAST(s_suppkey AS VARCHAR),
               'district' FROM supplier""",
    "organ": """
        SELECT s_suppkey AS id, 'ORG_' || CAST(s_suppkey AS VARCHAR) AS org_name,
               CASE WHEN s_acctbal >= 5000 THEN 1 ELSE 2 END AS org_level,
               s_suppkey + 10000 AS region_id,
               CASE WHEN s_acctbal >= 5000 THEN NULL ELSE CAST(s_nationkey AS BIGINT) END AS org_parent_id
        FROM supplier""",
    "transport_task": """
        SELECT l_orderkey AS order_id, l_partkey AS shift_id, CAST(l_linenumber AS BIGINT) AS line_id,
               l_suppkey AS start_org_id, l_suppkey AS driver1_emp_id,
               CASE WHEN l_discount >= 0.05 THEN l_partkey + 100000 END AS driver2_emp_id,
               l_partkey AS truck_id,
               CAST(epoch_ms(l_shipdate) AS VARCHAR) AS actual_start_time,
               CASE WHEN l_linestatus = 'F'
                    THEN CAST(epoch_ms(l_shipdate) + CAST(trunc(l_quantity * 3600000) AS BIGINT) AS VARCHAR)
               END AS actual_end_time,
               CAST(l_quantity * 10 AS DECIMAL(16,2)) AS actual_distance
        FROM lineitem""",
    "order_org_bound": """
        SELECT CAST(10 * l_orderkey + l_linenumber AS BIGINT) AS id, l_orderkey AS order_id, l_suppkey AS org_id,
               l_suppkey + 20000 AS inbound_emp_id, l_suppkey + 30000 AS sort_emp_id, l_suppkey + 40000 AS outbound_emp_id,
               CAST(epoch_ms(l_shipdate) AS VARCHAR) AS inbound_time,
               CASE WHEN l_returnflag <> 'N' THEN CAST(epoch_ms(l_shipdate) + 3600000 AS VARCHAR) END AS sort_time,
               CASE WHEN l_linestatus = 'F' THEN CAST(epoch_ms(l_shipdate) + 7200000 AS VARCHAR) END AS outbound_time
        FROM lineitem""",
    "user_info": """
        SELECT c_custkey AS id, 'login' || CAST(c_custkey AS VARCHAR) AS login_name, c_name AS real_name,
               CASE WHEN c_acctbal >= 0 THEN '13' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')
                    ELSE '13' || CAST(c_custkey AS VARCHAR) END AS phone_num,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN 'user' || CAST(c_custkey AS VARCHAR) || '@mail.example'
                    ELSE 'user' || CAST(c_custkey AS VARCHAR) || '#mail.example' END AS email,
               CAST(trunc(abs(c_acctbal)) AS INTEGER) + 3000 AS birthday,
               CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'F' ELSE 'M' END AS gender,
               c_mktsegment AS user_level, c_nationkey
        FROM customer""",
}


def with_model(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <model tables> <extra ctes> <body>``; extra CTEs may refer to the model ones."""
    parts = [f"{n} AS ({MODEL[n]})" for n in names]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    if not parts:
        return body
    head = body.lstrip()
    if head[:5].upper() == "WITH ":
        # the statement has its own CTEs: continue the same WITH list
        return "WITH " + ",\n".join(parts) + ",\n" + head[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


RUN = f"DATE '{RUN_DATE}'"
