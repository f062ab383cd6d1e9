"""Fixture views derived from the supplied tables.

Each function reads the parquet tables under ``sf_dir`` and returns a lazy
DataFrame with the shape of one input of the labs (billing export, request
log, probe log, policy documents, object inventory, ...). The same
definitions are written in DuckDB SQL in ``skyledger.plans.oracle_fixtures``; keep
the two in step.

Only the TPC-H nation table (25 rows by specification), suppliers up to a size and
the literal configuration tables are broadcast. Tables that grow with the line items
(orders, parts, customers) are merge joined at every size, so that what is shuffled
grows as the input does; other joins are left to AQE, which broadcasts at run time
only below ``autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.net import ip_literal_to_long, long_to_ip
from skyledger.operators.sizing import bounded_broadcast, literal_table, sql_literal
from skyledger.sources import literals

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


DIMENSION_BROADCAST_BYTES = 64 << 20  # nation: 25 rows by specification, checked anyway
SUPPLIER_BROADCAST_BYTES = 8 << 20  # of two numbers a supplier, as stored; a longer table is joined by AQE's choice


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------ billing
def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested billing export: one row per line item.

    cost = round(extendedprice * discount * tax / 20, 2), computed in
    DECIMAL so that every engine rounds the same cents.
    """
    cost = F.round(
        F.col("l_extendedprice").cast("decimal(12,2)")
        * F.col("l_discount").cast("decimal(4,2)")
        * F.col("l_tax").cast("decimal(4,2)")
        * F.lit(Decimal("0.05")), 2).cast("decimal(18,2)")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", cost.alias("cost"),
        "l_returnflag", "l_linestatus", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    # customers meet the orders, so line items are shuffled twice: by order, then (parts are wide) by part
    oc = o.join(c.hint("merge"), o.o_custkey == c.c_custkey).drop("o_custkey")
    j = (li.join(oc.hint("merge"), li.l_orderkey == oc.o_orderkey)
         .join(p.hint("merge"), li.l_partkey == p.p_partkey)
         .join(bounded_broadcast(s, SUPPLIER_BROADCAST_BYTES), li.l_suppkey == s.s_suppkey)
         .join(bounded_broadcast(n, DIMENSION_BROADCAST_BYTES), s.s_nationkey == n.n_nationkey))

    return j.select(
        F.col("c_nationkey").cast("string").alias("billing_account_id"),
        F.struct(F.concat(F.lit("proj-"), F.col("c_custkey").cast("string")).alias("id"),
                 F.col("c_name").alias("name")).alias("project"),
        F.struct(F.col("p_type").alias("description")).alias("service"),
        F.struct(F.col("p_name").alias("description")).alias("sku"),
        F.struct(F.col("n_name").alias("country")).alias("location"),
        "cost",
        F.lit("USD").alias("currency"),
        F.lit(1.0).cast("double").alias("currency_conversion_rate"),
        F.struct(F.col("l_quantity").alias("amount"),
                 F.concat(F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus")).alias("unit"),
                 F.col("l_linestatus").alias("pricing_unit")).alias("usage"),
        F.col("l_shipdate").alias("usage_end_time"),
        F.struct(F.col("l_orderkey").alias("order_key"),
                 F.col("l_linenumber").alias("line_number"),
                 F.col("l_partkey").alias("part_key"),
                 F.col("l_suppkey").alias("supp_key")).alias("line_item"),
    )


# ---------------------------------------------------------------- requests
REQUEST_BASES = ["10.128.0.0", "130.211.0.0", "35.235.240.0", "203.0.113.0"]
NETWORKS = ["default", "mynetwork", "managementnet", "privatenet"]
TYPE_PORTS = {"click": ("tcp", 80), "view": ("tcp", 22), "signup": ("tcp", 3389),
              "error": ("tcp", 443), "purchase": ("icmp", None)}
TAG_SETS = [["http-server", "allow-health-checks"], ["iap-gce"], []]


def _case(col_sql: str, pairs, type_str: str, default=None) -> Column:
    """CASE col WHEN k THEN v ... END as one SQL expression (one call into the JVM)."""
    dt = T._parse_datatype_string(type_str)
    key = lambda k: str(k) if isinstance(k, int) else sql_literal(k, T.StringType())
    whens = " ".join(f"WHEN {key(k)} THEN {sql_literal(v, dt)}" for k, v in pairs)
    return F.expr(f"CASE {col_sql} {whens} ELSE {sql_literal(default, dt)} END")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request / flow log derived from events: one row per event."""
    return requests_from_events(read_table(spark, sf_dir, "events"))


def requests_from_events(ev: DataFrame) -> DataFrame:
    """The request-log derivation on any events frame (batch or streaming)."""
    base = _case("event_id % 4", [(i, ip_literal_to_long(b)) for i, b in enumerate(REQUEST_BASES)], "bigint")
    ip_num = (base + ev.user_id).cast("bigint")
    tags = _case("user_id % 3", list(enumerate(TAG_SETS)), "array<string>")
    return ev.select(
        ev.event_id.alias("request_id"), ev.ts, ev.user_id,
        long_to_ip(ip_num).alias("ip"), ip_num.alias("ip_num"),
        _case("user_id % 4", list(enumerate(NETWORKS)), "string").alias("network"),
        _case("event_type", [(k, v[0]) for k, v in TYPE_PORTS.items()], "string").alias("protocol"),
        _case("event_type", [(k, v[1]) for k, v in TYPE_PORTS.items()], "int").alias("port"),
        tags.alias("target_tags"),
        ev.event_type,
    )


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health-probe log: instance = user, failure = error event, latency = value/50 s."""
    return probes_from_events(read_table(spark, sf_dir, "events"))


def probes_from_events(ev: DataFrame) -> DataFrame:
    return ev.select(ev.event_id.alias("probe_id"), ev.user_id.alias("instance"), ev.ts,
                     (ev.event_type != "error").alias("ok"),
                     (ev.value / F.lit(50.0)).alias("latency_s"))


# ---------------------------------------------------------------- policies
def policy_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat (resource, role, member) rows; a resource holds at most 100 customers."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    return c.join(bounded_broadcast(n, DIMENSION_BROADCAST_BYTES), c.c_nationkey == n.n_nationkey).select(
        F.concat(F.lit("projects/"), F.lower(n.n_name), F.lit("-"),
                 F.expr("c_custkey div 100").cast("string")).alias("resource"),
        F.concat(F.lit("roles/"), F.lower(c.c_mktsegment)).alias("role"),
        F.concat(F.lit("user:"), c.c_name).alias("member"))


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Role policy documents: resource, bindings: array<struct<role, members>>.

    Members of one binding are bounded (<= 100) because a resource covers one
    block of 100 customer keys, so collect_list never gathers an unbounded group.
    """
    pm = policy_members(spark, sf_dir)
    b = pm.groupBy("resource", "role").agg(F.array_sort(F.collect_list("member")).alias("members"))
    return b.groupBy("resource").agg(
        F.array_sort(F.collect_list(F.struct("role", "members"))).alias("bindings"))


ROLE_BY_TYPE = {"view": "roles/storage.objectViewer", "purchase": "roles/storage.objectCreator",
                "click": "roles/viewer", "signup": "roles/iam.serviceAccountUser",
                "error": "roles/compute.instanceAdmin.v1"}
PERMISSION_BY_TYPE = {"view": "storage.objects.get", "click": "storage.objects.list",
                      "purchase": "storage.objects.create",
                      "signup": "iam.serviceAccounts.actAs", "error": "compute.instances.list"}


def grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grant log, one entry per event: add / remove of (member, resource, role); 'reset' = ACL set private."""
    ev = read_table(spark, sf_dir, "events")
    action = (F.when((ev.event_type == "error") & (ev.value > 250), "reset")
              .when(ev.value > 20, "add").otherwise("remove"))
    return ev.select(ev.event_id.alias("seq"), ev.user_id.alias("member"),
                     F.concat(F.lit("bucket-"), (ev.user_id % 10).cast("string")).alias("resource"),
                     _case("event_type", list(ROLE_BY_TYPE.items()), "string").alias("role"),
                     action.alias("action"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access attempts: (seq, member, resource, permission)."""
    ev = read_table(spark, sf_dir, "events").where(F.col("event_id") % 5 == 0)
    return ev.select(ev.event_id.alias("seq"), ev.user_id.alias("member"),
                     F.concat(F.lit("bucket-"), (ev.user_id % 10).cast("string")).alias("resource"),
                     _case("event_type", list(PERMISSION_BY_TYPE.items()), "string").alias("permission"))


def role_permissions(spark: SparkSession) -> DataFrame:
    return literal_table(spark, literals.ROLE_PERMISSIONS, "role string, permission string")


# ----------------------------------------------------------------- objects
def _cents(col):
    return (col.cast("decimal(15,2)") * F.lit(100)).cast("bigint")


def object_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object inventory: one row per (name, generation)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("obj-"), o.o_custkey.cast("string")).alias("name"),
                    o.o_orderkey.alias("generation"), o.o_orderdate.alias("created"),
                    _cents(o.o_totalprice).alias("size_bytes"))


def _sync_name(key):
    return F.concat(F.lit("firstlevel/"),
                    F.when(key % 2 == 0, F.lit("secondlevel/")).otherwise(F.lit("")),
                    F.lit("file-"), key.cast("string"), F.lit(".html"))


def sync_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(_sync_name(o.o_orderkey).alias("name"), _cents(o.o_totalprice).alias("size_bytes"))


def sync_dst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Destination: misses keys % 7 == 0, stale size where % 11 == 0, extra keys % 13 == 0."""
    o = read_table(spark, sf_dir, "orders")
    k = o.o_orderkey
    kept = o.where(k % 7 != 0).select(
        _sync_name(k).alias("name"),
        (_cents(o.o_totalprice) + F.when(k % 11 == 0, F.lit(1)).otherwise(F.lit(0))).alias("size_bytes"))
    extra = o.where(k % 13 == 0).select(
        F.concat(F.lit("firstlevel/old-"), k.cast("string"), F.lit(".html")).alias("name"),
        _cents(o.o_totalprice).alias("size_bytes"))
    return kept.unionByName(extra)


# -------------------------------------------------------------------- text
def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_no 1-based, n_lines, line) for every line of every document."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.split(F.col("text"), "\n")
    return d.select("doc_id", F.size(lines).cast("bigint").alias("n_lines"), F.posexplode(lines)) \
        .select("doc_id", (F.col("pos") + 1).cast("bigint").alias("line_no"), "n_lines",
                F.col("col").alias("line"))


# ------------------------------------------------------------ job records
JOB_STATE = {"F": "DONE", "O": "RUNNING", "P": "PENDING"}


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested job-run records: reference.jobId, status.{state, stateStartTime}, output URI."""
    o = read_table(spark, sf_dir, "orders")
    jid = F.concat(F.lit("job-"), F.lpad(o.o_orderkey.cast("string"), 9, "0"))
    return o.select(
        F.struct(jid.alias("jobId"),
                 F.concat(F.lit("proj-"), o.o_custkey.cast("string")).alias("projectId")).alias("reference"),
        F.struct(_case("o_orderstatus", list(JOB_STATE.items()), "string", "ERROR").alias("state"),
                 o.o_orderdate.alias("stateStartTime")).alias("status"),
        F.concat(F.lit("staging/driveroutput/"), jid, F.lit("/driveroutput")).alias(
            "driverOutputResourceUri"),
        F.concat(F.lit("cluster-"), (o.o_custkey % 5).cast("string")).alias("clusterName"),
    )


# --------------------------------------------------------------- instances
ZONE_SUFFIX = ["a", "b", "c"]
MACHINE_TYPES = ["e2-micro", "e2-medium", "e2-standard-2"]


def subnets(spark: SparkSession) -> DataFrame:
    return literal_table(spark, literals.SUBNETS, "subnet string, network string, region string, range string")


def _instances_from(df, key: str, prefix: str):
    idx = f"{key} % {len(literals.SUBNETS)}"
    subnet = _case(idx, [(i, sn[0]) for i, sn in enumerate(literals.SUBNETS)], "string")
    region = _case(idx, [(i, sn[2]) for i, sn in enumerate(literals.SUBNETS)], "string")
    start = _case(idx, [(i, ip_literal_to_long(sn[3].split("/")[0])) for i, sn in enumerate(literals.SUBNETS)],
                  "bigint")
    suffix = _case(f"{key} % 3", list(enumerate(ZONE_SUFFIX)), "string")
    tags = _case(f"{key} % 3", list(enumerate(TAG_SETS)), "array<string>")
    k = F.col(key)
    ip_num = (start + F.lit(2) + k % 250).cast("bigint")
    return df.select(
        F.concat(F.lit(prefix), k.cast("string")).alias("name"),
        F.concat(region, F.lit("-"), suffix).alias("zone"),
        _case(f"{key} % 3", list(enumerate(MACHINE_TYPES)), "string").alias("machine_type"),
        subnet.alias("subnet"), tags.alias("tags"),
        long_to_ip(ip_num).alias("internal_ip"))


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VM inventory: one VM per customer ('vm-c<key>') and per supplier ('vm-s<key>')."""
    c = read_table(spark, sf_dir, "customer")
    s = read_table(spark, sf_dir, "supplier")
    return _instances_from(c, "c_custkey", "vm-c").unionByName(_instances_from(s, "s_suppkey", "vm-s"))


def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connection log: the customer's VM of each order talks to the supplier's VM of each line."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey).select(
        li.l_orderkey.alias("order_key"), li.l_linenumber.alias("line_number"),
        li.l_partkey.alias("part_key"), li.l_suppkey.alias("supp_key"),
        F.concat(F.lit("vm-c"), o.o_custkey.cast("string")).alias("src"),
        F.concat(F.lit("vm-s"), li.l_suppkey.cast("string")).alias("dst"))


def project_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-customer project metadata as a key/value item list."""
    c = read_table(spark, sf_dir, "customer")
    inst = _instances_from(c, "c_custkey", "vm-c")
    region = F.regexp_replace(F.col("zone"), "-[^-]*$", "")
    item = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    return inst.select(
        F.concat(F.lit("proj-"), F.substring(F.col("name"), 5, 100)).alias("project"),
        F.struct(F.array(item(literals.METADATA_ZONE_KEY, F.col("zone")),
                         item(literals.METADATA_REGION_KEY, region),
                         item("enable-oslogin", F.lit("TRUE")))
                 .alias("items")).alias("commonInstanceMetadata"))


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


# ------------------------------------------------- rules over address ranges
RANGE_SPECS = ["all", "tcp", "tcp:443,icmp", "icmp", "tcp:22-80"]


def range_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingress rules as many as there are customers, each over one IPv4 or IPv6 range."""
    c = read_table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_name AS name")
    v6 = F.concat(F.lit("2001:db8:"), F.lower(F.hex(F.col("k") % 65536)), F.lit("::/"), (36 + F.col("k") % 60).cast("string"))
    v4 = F.concat(long_to_ip((F.col("k") * 2654435761) % 4294967296), F.lit("/"), (4 + F.col("k") % 27).cast("string"))
    return c.select("name", F.concat(F.lit("net-"), (F.col("k") % 4).cast("string")).alias("network"),
                    F.lit("INGRESS").alias("direction"), (F.col("k") * 7919 % 1000).cast("int").alias("priority"),
                    F.when(F.col("k") % 3 == 0, "DENY").otherwise("ALLOW").alias("action"),
                    _case("k % 5", list(enumerate(RANGE_SPECS)), "string").alias("rules"),
                    F.array(F.when(F.col("k") % 7 == 0, v6).otherwise(v4)).alias("source_ranges"),
                    F.array().cast("array<string>").alias("target_tags"))


def range_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event, from an IPv4 or (every fifth) IPv6 address."""
    ev = read_table(spark, sf_dir, "events")
    v6 = F.concat(F.lit("2001:DB8:"), F.hex(F.col("user_id") % 65536), F.lit("::"), F.hex(F.col("event_id") % 65536))
    v4 = long_to_ip((F.col("event_id") * 2246822519) % 4294967296)
    return ev.select(ev.event_id.alias("request_id"), F.concat(F.lit("net-"), (F.col("user_id") % 4).cast("string")).alias("network"),
                     F.when(F.col("event_id") % 5 == 0, v6).otherwise(v4).alias("ip"),
                     _case("event_type", [(k, v[0]) for k, v in TYPE_PORTS.items()], "string").alias("protocol"),
                     _case("event_type", [(k, v[1]) for k, v in TYPE_PORTS.items()], "int").alias("port"),
                     F.array().cast("array<string>").alias("target_tags"))
