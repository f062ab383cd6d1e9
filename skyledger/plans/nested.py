"""Contract queries: JSON documents, nested records, keyed lookup, listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.operators import nested as N
from skyledger.plans.registry import register
from skyledger.sources import fixtures as fx
from skyledger.sources import literals


@register("json_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_props(spark, sf):
    ev = fx.read_table(spark, sf, "events")
    return N.parse_json(ev, "props", "k int").select("event_id", F.col("doc.k").alias("k"))


@register("iam_flatten", "SELECT resource, role, member FROM policy_members", ("policy_members",))
def iam_flatten(spark, sf):
    return N.flatten_bindings(fx.policies(spark, sf))


MEMBER_PROBE = "#0000001"
ROLE_PROBE = "build"


@register("iam_filter_members", f"""
SELECT resource, role, member FROM policy_members
WHERE contains(member, '{MEMBER_PROBE}') AND contains(role, '{ROLE_PROBE}')""", ("policy_members",))
def iam_filter_members(spark, sf):
    flat = N.flatten_bindings(fx.policies(spark, sf))
    return N.filter_contains(flat, member=MEMBER_PROBE, role=ROLE_PROBE)


HAS_ROLE, HAS_MEMBER = "roles/automobile", "7"


@register("iam_has_role", f"""
SELECT resource, bool_or(role = '{HAS_ROLE}' AND contains(member, '{HAS_MEMBER}')) AS has_role
FROM policy_members GROUP BY resource""", ("policy_members",))
def iam_has_role(spark, sf):
    return N.has_binding(fx.policies(spark, sf), HAS_ROLE, HAS_MEMBER)


@register("project_paths", """
SELECT job_id, state, state_start_time, driver_output_uri FROM jobs""", ("jobs",))
def project_paths(spark, sf):
    return N.project_paths(fx.jobs(spark, sf), {
        "job_id": "reference.jobId", "state": "status.state",
        "state_start_time": "status.stateStartTime",
        "driver_output_uri": "driverOutputResourceUri"})


@register("map_lookup", """
SELECT 'proj-' || substr(name, 5) AS project, zone, regexp_replace(zone, '-[^-]*$', '') AS region
FROM instances WHERE name LIKE 'vm-c%'""", ("instances",))
def map_lookup(spark, sf):
    return N.map_lookup(fx.project_metadata(spark, sf), "commonInstanceMetadata.items",
                        {"zone": literals.METADATA_ZONE_KEY,
                         "region": literals.METADATA_REGION_KEY}, keep=("project",))


@register("list_sorted", """
SELECT name, zone, machine_type, subnet, internal_ip FROM instances ORDER BY zone, name""",
          ("instances",))
def list_sorted(spark, sf):
    inst = fx.instances(spark, sf).select("name", "zone", "machine_type", "subnet", "internal_ip")
    return N.sort_listing(inst, "zone")


@register("latest_two_runs", """
SELECT job_id, state, state_start_time FROM jobs
ORDER BY state_start_time DESC, job_id DESC LIMIT 2""", ("jobs",))
def latest_two_runs(spark, sf):
    runs = N.project_paths(fx.jobs(spark, sf), {"job_id": "reference.jobId", "state": "status.state",
                                                "state_start_time": "status.stateStartTime"})
    return N.latest_n(runs, "state_start_time", 2, "job_id")
