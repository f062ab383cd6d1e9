"""The fixture views of ``skyledger.sources.fixtures`` written in DuckDB SQL.

Used only to build the independent oracle queries; the definitions must
stay equal to the Spark ones. Each entry is (sql, dependencies).
"""

from __future__ import annotations

from skyledger.functions.net import ip_literal_to_long
from skyledger.sources import fixtures as fx
from skyledger.sources import literals


def _case(col: str, pairs, default="NULL") -> str:
    parts = " ".join(f"WHEN {k} THEN {v}" for k, v in pairs)
    return f"CASE {col} {parts} ELSE {default} END"


def _q(s) -> str:
    return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"


def _list(items) -> str:
    return "CAST([" + ", ".join(_q(t) for t in items) + "] AS VARCHAR[])"


def _ip(col: str) -> str:
    return " || '.' || ".join(f"CAST(({col} >> {s}) & 255 AS VARCHAR)" for s in (24, 16, 8, 0))


CENTS = "CAST(CAST({c} AS DECIMAL(15,2)) * 100 AS BIGINT)"

FIXTURES: dict[str, tuple[str, tuple[str, ...]]] = {}

FIXTURES["billing"] = ("""
SELECT CAST(c.c_nationkey AS VARCHAR) AS billing_account_id,
       'proj-' || CAST(c.c_custkey AS VARCHAR) AS project_id, c.c_name AS project_name,
       p.p_type AS service_description, p.p_name AS sku_description, n.n_name AS country,
       CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2))
                  * CAST(l.l_tax AS DECIMAL(4,2)) * 0.05, 2) AS DECIMAL(18,2)) AS cost,
       'USD' AS currency, CAST(1.0 AS DOUBLE) AS currency_conversion_rate,
       l.l_quantity AS usage_amount, l.l_returnflag || '-' || l.l_linestatus AS usage_unit,
       l.l_linestatus AS pricing_unit, l.l_shipdate AS usage_end_time,
       l.l_orderkey AS order_key, l.l_linenumber AS line_number, l.l_partkey AS part_key,
       l.l_suppkey AS supp_key
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON s.s_nationkey = n.n_nationkey""", ())

_bases = [(i, ip_literal_to_long(b)) for i, b in enumerate(fx.REQUEST_BASES)]
FIXTURES["requests"] = (f"""
SELECT event_id AS request_id, ts, user_id, {_ip('ip_num')} AS ip, ip_num,
       {_case('user_id % 4', [(i, _q(n)) for i, n in enumerate(fx.NETWORKS)])} AS network,
       {_case('event_type', [(_q(k), _q(v[0])) for k, v in fx.TYPE_PORTS.items()])} AS protocol,
       CAST({_case('event_type', [(_q(k), 'NULL' if v[1] is None else v[1]) for k, v in fx.TYPE_PORTS.items()])} AS INTEGER) AS port,
       {_case('user_id % 3', [(i, _list(t)) for i, t in enumerate(fx.TAG_SETS)])} AS target_tags,
       event_type
FROM (SELECT *, CAST({_case('event_id % 4', _bases)} + user_id AS BIGINT) AS ip_num FROM events)""", ())

FIXTURES["probes"] = ("""
SELECT event_id AS probe_id, user_id AS instance, ts, event_type <> 'error' AS ok,
       value / 50.0 AS latency_s
FROM events""", ())

FIXTURES["policy_members"] = ("""
SELECT 'projects/' || lower(n.n_name) || '-' || CAST(c.c_custkey // 100 AS VARCHAR) AS resource,
       'roles/' || lower(c.c_mktsegment) AS role, 'user:' || c.c_name AS member
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""", ())

FIXTURES["grants"] = (f"""
SELECT event_id AS seq, user_id AS member, 'bucket-' || CAST(user_id % 10 AS VARCHAR) AS resource,
       {_case('event_type', [(_q(k), _q(v)) for k, v in fx.ROLE_BY_TYPE.items()])} AS role,
       CASE WHEN event_type = 'error' AND value > 250 THEN 'reset'
            WHEN value > 20 THEN 'add' ELSE 'remove' END AS action
FROM events""", ())

FIXTURES["attempts"] = (f"""
SELECT event_id AS seq, user_id AS member, 'bucket-' || CAST(user_id % 10 AS VARCHAR) AS resource,
       {_case('event_type', [(_q(k), _q(v)) for k, v in fx.PERMISSION_BY_TYPE.items()])} AS permission
FROM events WHERE event_id % 5 = 0""", ())

FIXTURES["role_permissions"] = (
    "SELECT * FROM (VALUES " + ", ".join(f"({_q(r)}, {_q(p)})" for r, p in literals.ROLE_PERMISSIONS)
    + ") AS t(role, permission)", ())

FIXTURES["object_versions"] = (f"""
SELECT 'obj-' || CAST(o_custkey AS VARCHAR) AS name, o_orderkey AS generation,
       o_orderdate AS created, {CENTS.format(c='o_totalprice')} AS size_bytes
FROM orders""", ())

_SYNC_NAME = ("'firstlevel/' || CASE WHEN o_orderkey % 2 = 0 THEN 'secondlevel/' ELSE '' END"
              " || 'file-' || CAST(o_orderkey AS VARCHAR) || '.html'")
FIXTURES["sync_src"] = (f"""
SELECT {_SYNC_NAME} AS name, {CENTS.format(c='o_totalprice')} AS size_bytes FROM orders""", ())

FIXTURES["sync_dst"] = (f"""
SELECT {_SYNC_NAME} AS name,
       {CENTS.format(c='o_totalprice')} + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS size_bytes
FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL
SELECT 'firstlevel/old-' || CAST(o_orderkey AS VARCHAR) || '.html' AS name,
       {CENTS.format(c='o_totalprice')} AS size_bytes
FROM orders WHERE o_orderkey % 13 = 0""", ())

FIXTURES["doc_lines"] = ("""
SELECT doc_id, line_no, n_lines, parts[line_no] AS line
FROM (SELECT doc_id, parts, len(parts) AS n_lines,
             unnest(generate_series(1, len(parts))) AS line_no
      FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))""", ())

FIXTURES["jobs"] = (f"""
SELECT 'job-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS job_id,
       'proj-' || CAST(o_custkey AS VARCHAR) AS project_id,
       {_case('o_orderstatus', [(_q(k), _q(v)) for k, v in fx.JOB_STATE.items()], "'ERROR'")} AS state,
       o_orderdate AS state_start_time,
       'staging/driveroutput/job-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '/driveroutput'
           AS driver_output_uri,
       'cluster-' || CAST(o_custkey % 5 AS VARCHAR) AS cluster_name
FROM orders""", ())

FIXTURES["subnets"] = (
    "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(_q(x) for x in s) + ")" for s in literals.SUBNETS)
    + ") AS t(subnet, network, region, range)", ())


def _instances_sql(table: str, key: str, prefix: str) -> str:
    n = len(literals.SUBNETS)
    idx = f"{key} % {n}"
    subnet = _case(idx, [(i, _q(s[0])) for i, s in enumerate(literals.SUBNETS)])
    region = _case(idx, [(i, _q(s[2])) for i, s in enumerate(literals.SUBNETS)])
    start = _case(idx, [(i, ip_literal_to_long(s[3].split('/')[0])) for i, s in enumerate(literals.SUBNETS)])
    suffix = _case(f"{key} % 3", [(i, _q(z)) for i, z in enumerate(fx.ZONE_SUFFIX)])
    mtype = _case(f"{key} % 3", [(i, _q(m)) for i, m in enumerate(fx.MACHINE_TYPES)])
    tags = _case(f"{key} % 3", [(i, _list(t)) for i, t in enumerate(fx.TAG_SETS)])
    ipn = f"CAST({start} + 2 + {key} % 250 AS BIGINT)"
    return (f"SELECT '{prefix}' || CAST({key} AS VARCHAR) AS name, {region} || '-' || {suffix} AS zone, "
            f"{mtype} AS machine_type, {subnet} AS subnet, {tags} AS tags, {_ip(ipn)} AS internal_ip "
            f"FROM {table}")


FIXTURES["instances"] = (_instances_sql("customer", "c_custkey", "vm-c") + "\nUNION ALL\n"
                         + _instances_sql("supplier", "s_suppkey", "vm-s"), ())

FIXTURES["connections"] = ("""
SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_number, l.l_partkey AS part_key,
       l.l_suppkey AS supp_key, 'vm-c' || CAST(o.o_custkey AS VARCHAR) AS src,
       'vm-s' || CAST(l.l_suppkey AS VARCHAR) AS dst
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""", ())


# addresses as 128-bit numbers: IPv4 at ::ffff:a.b.c.d, the IPv6 ones at 2001:db8:<group>::<low>
_V6 = "(CAST(536939960 AS UHUGEINT) * 4294967296 + CAST({group} AS UHUGEINT) * 65536) * 18446744073709551616 + {low}"
_V4 = "CAST(281470681743360 AS UHUGEINT) + CAST({v} AS UHUGEINT)"
FIXTURES["range_rules"] = (f"""
SELECT name, network, priority, action, spec, addr - addr % size AS low, addr - addr % size + (size - 1) AS high
FROM (SELECT c_name AS name, 'net-' || CAST(c_custkey % 4 AS VARCHAR) AS network,
             CAST(c_custkey * 7919 % 1000 AS INTEGER) AS priority,
             CASE WHEN c_custkey % 3 = 0 THEN 'DENY' ELSE 'ALLOW' END AS action, c_custkey % 5 AS spec,
             CASE WHEN c_custkey % 7 = 0 THEN {_V6.format(group='c_custkey % 65536', low='0')}
                  ELSE {_V4.format(v='(c_custkey * 2654435761) % 4294967296')} END AS addr,
             CASE WHEN c_custkey % 7 = 0 THEN CAST(pow(2, 92 - c_custkey % 60) AS UHUGEINT)
                  ELSE CAST(pow(2, 28 - c_custkey % 27) AS UHUGEINT) END AS size
      FROM customer)""", ())

FIXTURES["range_requests"] = (f"""
SELECT event_id AS request_id, 'net-' || CAST(user_id % 4 AS VARCHAR) AS network,
       CASE WHEN event_id % 5 = 0 THEN '2001:DB8:' || hex(user_id % 65536) || '::' || hex(event_id % 65536)
            ELSE {_ip('((event_id * 2246822519) % 4294967296)')} END AS ip,
       CASE WHEN event_id % 5 = 0 THEN {_V6.format(group='user_id % 65536', low='CAST(event_id % 65536 AS UHUGEINT)')}
            ELSE {_V4.format(v='(event_id * 2246822519) % 4294967296')} END AS addr,
       {_case('event_type', [(_q(k), _q(v[0])) for k, v in fx.TYPE_PORTS.items()])} AS protocol,
       CAST({_case('event_type', [(_q(k), 'NULL' if v[1] is None else v[1]) for k, v in fx.TYPE_PORTS.items()])} AS INTEGER) AS port
FROM events""", ())


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs for the named fixtures (and their dependencies)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in FIXTURES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    sql = sql.strip()
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({FIXTURES[n][0].strip()})" for n in order)
    if sql[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{sql[5:]}"
    return f"WITH {ctes}\n{sql}"
