"""Contract queries: object inventories, retention, sync, snapshots, reconcile."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.operators import objects as O
from skyledger.plans.registry import register
from skyledger.sources import fixtures as fx
from skyledger.sources import literals

NOW = "1998-08-02 00:00:00"
TODAY = "1998-08-02"
TTL = literals.DATASET_DEFAULT_TTL_S


@register("expire_ttl_1d", f"""
SELECT name, generation, created, created + INTERVAL {TTL} SECOND AS expires_at,
       created + INTERVAL {TTL} SECOND <= TIMESTAMP '{NOW}' AS expired
FROM object_versions""", ("object_versions",))
def expire_ttl_1d(spark, sf):
    ov = fx.object_versions(spark, sf)
    return O.expire_by_ttl(ov, "created", TTL, NOW).select(
        "name", "generation", "created", "expires_at", "expired")


@register("lifecycle_31d", f"""
SELECT name, generation, CAST(date_diff('day', CAST(created AS DATE), DATE '{TODAY}') AS INTEGER) AS age_days,
       CASE WHEN date_diff('day', CAST(created AS DATE), DATE '{TODAY}') >= 31 THEN 'Delete' ELSE 'Keep' END
           AS action
FROM object_versions""", ("object_versions",))
def lifecycle_31d(spark, sf):
    ov = fx.object_versions(spark, sf)
    return O.lifecycle_delete(ov, "created", TODAY).select("name", "generation", "age_days", "action")


@register("object_versions", """
SELECT name, generation, created, size_bytes,
       row_number() OVER (PARTITION BY name ORDER BY generation) AS version_no
FROM object_versions""", ("object_versions",))
def object_versions(spark, sf):
    return O.list_versions(fx.object_versions(spark, sf))


@register("oldest_vs_current", """
SELECT name, COUNT(*) AS versions, min(generation) AS oldest_generation,
       arg_min(size_bytes, generation) AS oldest_size, max(generation) AS current_generation,
       arg_max(size_bytes, generation) AS current_size,
       arg_max(size_bytes, generation) - arg_min(size_bytes, generation) AS size_change
FROM object_versions GROUP BY name""", ("object_versions",))
def oldest_vs_current(spark, sf):
    return O.oldest_vs_current(fx.object_versions(spark, sf))


@register("sync_plan", """
SELECT COALESCE(s.name, d.name) AS name, s.size_bytes AS src_size, d.size_bytes AS dst_size,
       CASE WHEN d.size_bytes IS NULL THEN 'new' WHEN s.size_bytes IS NULL THEN 'kept'
            WHEN s.size_bytes <> d.size_bytes THEN 'changed' ELSE 'same' END AS status
FROM sync_src s FULL OUTER JOIN sync_dst d ON s.name = d.name""", ("sync_src", "sync_dst"))
def sync_plan(spark, sf):
    return O.sync_plan(fx.sync_src(spark, sf), fx.sync_dst(spark, sf))


@register("sync_apply", """
SELECT name, size_bytes, 'src' AS origin FROM sync_src
UNION ALL
SELECT name, size_bytes, 'dst' AS origin FROM sync_dst WHERE name NOT IN (SELECT name FROM sync_src)""",
          ("sync_src", "sync_dst"))
def sync_apply(spark, sf):
    return O.sync_apply(fx.sync_src(spark, sf), fx.sync_dst(spark, sf))


PREFIX_GLOB = "obj-12*"


@register("prefix_list", """
SELECT name, generation, created, size_bytes FROM object_versions WHERE name LIKE 'obj-12%'""",
          ("object_versions",))
def prefix_list(spark, sf):
    return O.list_prefix(fx.object_versions(spark, sf), PREFIX_GLOB)


@register("snapshot_4h", """
SELECT user_id, window_start, snapshot_key, event_id AS last_event_id, value AS last_value
FROM (SELECT user_id, event_id, value, wb AS window_start,
             strftime(wb + INTERVAL 4 HOUR, '%Y%m%d-%H%M%S') || '-world' AS snapshot_key,
             row_number() OVER (PARTITION BY user_id, wb ORDER BY ts DESC, event_id DESC, value DESC) AS rn
      FROM (SELECT *, time_bucket(INTERVAL 4 HOUR, ts, TIMESTAMP '1970-01-01') AS wb FROM events))
WHERE rn = 1""")
def snapshot_4h(spark, sf):
    ev = fx.read_table(spark, sf, "events")
    return O.snapshot_windows(ev, "user_id", "ts", "4 hours", ("event_id", "value"))


@register("reconcile_plan", """
SELECT name, size_bytes, CASE WHEN name IN (SELECT name FROM sync_dst) THEN 'skip' ELSE 'create' END
           AS action
FROM sync_src""", ("sync_src", "sync_dst"))
def reconcile_plan(spark, sf):
    return O.reconcile(fx.sync_src(spark, sf), fx.sync_dst(spark, sf))


_KEPT = """
SELECT user_id, snapshot_time, event_type, cents
FROM (SELECT user_id, snapshot_time, event_type, cents,
             lag(user_id) OVER w AS p, lag(event_type) OVER w AS pt, lag(cents) OVER w AS pc
      FROM (SELECT user_id, wb + INTERVAL 4 HOUR AS snapshot_time, event_type, cents,
                   row_number() OVER (PARTITION BY user_id, wb ORDER BY ts DESC, event_type DESC, cents DESC) AS rn
            FROM (SELECT user_id, ts, event_type, CAST(round(value * 100) AS BIGINT) AS cents,
                         time_bucket(INTERVAL 4 HOUR, ts, TIMESTAMP '1970-01-01') AS wb FROM events))
      WHERE rn = 1 WINDOW w AS (PARTITION BY user_id ORDER BY snapshot_time))
WHERE p IS NULL OR pt IS DISTINCT FROM event_type OR pc IS DISTINCT FROM cents"""


def _copies(spark, sf):
    ev = fx.read_table(spark, sf, "events").selectExpr("user_id", "ts", "event_type", "cast(round(value * 100) as bigint) as cents")
    return O.snapshot_versions(ev, "user_id", "ts", "4 hours", ("event_type", "cents"))


@register("snapshot_versions_4h", f"""
WITH kept AS ({_KEPT})
SELECT user_id, snapshot_time AS valid_from,
       lead(snapshot_time) OVER (PARTITION BY user_id ORDER BY snapshot_time) AS valid_to, event_type, cents
FROM kept""")
def snapshot_versions_4h(spark, sf):
    return _copies(spark, sf)


@register("snapshot_full_4h", f"""
WITH kept AS ({_KEPT}),
     grid AS (SELECT unnest(generate_series((SELECT min(snapshot_time) FROM kept), (SELECT max(snapshot_time) FROM kept),
                                            INTERVAL 4 HOUR)) AS snapshot_time),
     users AS (SELECT DISTINCT user_id FROM kept),
     asked AS (SELECT g.snapshot_time, u.user_id FROM grid g CROSS JOIN users u),
     copies AS (SELECT a.snapshot_time, k.cents FROM asked a ASOF JOIN kept k
                ON a.user_id = k.user_id AND a.snapshot_time >= k.snapshot_time)
SELECT snapshot_time, strftime(snapshot_time, '%Y%m%d-%H%M%S') || '-world' AS snapshot_key, COUNT(*) AS keys,
       CAST(SUM(COALESCE(cents, 0)) AS BIGINT) AS total
FROM copies GROUP BY snapshot_time""")
def snapshot_full_4h(spark, sf):
    return O.snapshot_totals(_copies(spark, sf), F.coalesce("cents", F.lit(0)), "4 hours")


@register("list_level", """
SELECT entry, kind, COUNT(*) AS objects, CAST(SUM(size_bytes) AS BIGINT) AS bytes
FROM (SELECT CASE WHEN name LIKE 'firstlevel/%/%' THEN 'firstlevel/' || split_part(name, '/', 2) || '/' ELSE name END AS entry,
             CASE WHEN name LIKE 'firstlevel/%/%' THEN 'prefix' ELSE 'object' END AS kind, size_bytes
      FROM sync_src WHERE name LIKE 'firstlevel/%')
GROUP BY entry, kind""", ("sync_src",))
def list_level(spark, sf):
    return O.list_level(fx.sync_src(spark, sf), "firstlevel/")


@register("glob_list", """
SELECT name, size_bytes FROM sync_src WHERE regexp_full_match(name, 'firstlevel/file-[^/]*7[.]html')""", ("sync_src",))
def glob_list(spark, sf):
    return O.list_prefix(fx.sync_src(spark, sf), "firstlevel/file-*7.html")


@register("prefix_tree", """
WITH f AS (SELECT list_slice(string_split(name, '/'), 1, -2) AS folders, size_bytes FROM sync_src),
     u AS (SELECT folders, size_bytes, unnest(generate_series(0, len(folders))) AS depth FROM f)
SELECT CASE WHEN depth = 0 THEN '' ELSE array_to_string(list_slice(folders, 1, depth), '/') || '/' END AS folder,
       CAST(depth AS INTEGER) AS depth, COUNT(*) AS objects, CAST(SUM(size_bytes) AS BIGINT) AS bytes,
       COUNT(*) FILTER (WHERE len(folders) = depth) AS direct_objects
FROM u GROUP BY 1, 2""", ("sync_src",))
def prefix_tree(spark, sf):
    return O.prefix_tree(fx.sync_src(spark, sf))


def _resources(spark, sf):
    """(name, key, needs): orders need customers, these need nations, these need regions."""
    def of(table, kind, key, needs, parent):
        return fx.read_table(spark, sf, table).selectExpr(
            f"concat('{kind}-', {key}) AS name", f"cast({key} AS bigint) AS key",
            f"concat('{needs}-', {parent}) AS needs" if needs else "cast(null AS string) AS needs")

    return (of("region", "region", "r_regionkey", None, None).union(of("nation", "nation", "n_nationkey", "region", "n_regionkey"))
            .union(of("customer", "customer", "c_custkey", "nation", "c_nationkey"))
            .union(of("orders", "order", "o_orderkey", "customer", "o_custkey")))


@register("reconcile_order", """
WITH r AS (SELECT 'region-' || r_regionkey AS name, r_regionkey AS key, 0 AS level FROM region
           UNION ALL SELECT 'nation-' || n_nationkey, n_nationkey, 1 FROM nation
           UNION ALL SELECT 'customer-' || c_custkey, c_custkey, 2 FROM customer
           UNION ALL SELECT 'order-' || o_orderkey, o_orderkey, 3 FROM orders)
SELECT name, 'create' AS operation, CAST(2 AS INTEGER) AS phase, CAST(level AS INTEGER) AS step FROM r WHERE key % 3 <> 1
UNION ALL
SELECT name, 'delete' AS operation, CAST(1 AS INTEGER) AS phase, CAST(3 - level AS INTEGER) AS step FROM r WHERE key % 3 = 2""")
def reconcile_order(spark, sf):
    r = _resources(spark, sf)
    plan = r.select("name", F.when(F.col("key") % 3 == 0, "create").when(F.col("key") % 3 == 2, "recreate")
                    .otherwise("skip").alias("action"))
    return O.ordered_plan(plan, r.select("name", "needs"))
