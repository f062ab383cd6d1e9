"""Role-grant replay and point-in-time permission checks.

The grant log holds ordered rows (seq, member, resource, role, action) with
action 'add', 'remove' or 'reset' ('acl set private': a reset drops every
grant on the resource made before it). Roles add up: an attempt passes if
any role held at that moment grants the permission.

No range join is used: the "latest action before the attempt" is an as-of
lookup computed with the running scan over the union of grant rows and
attempt probes, so no pairs are formed and a hot member or resource is split
across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.scan import running
from skyledger.operators.sizing import bounded_broadcast
from skyledger.session import stage_table

KEY = ["member", "resource", "role"]


def effective_bindings(log: DataFrame) -> DataFrame:
    """(resource, member, role) held after replaying the whole log."""
    g = log.where(F.col("action").isin("add", "remove"))
    # fixed-width buffers only (hash aggregate): held if the last action was an add
    last = g.groupBy(*KEY).agg(F.max("seq").alias("seq"),
                               F.max(F.when(F.col("action") == "add", F.col("seq"))).alias("add_seq"))
    resets = log.where(F.col("action") == "reset").groupBy("resource").agg(F.max("seq").alias("reset_seq"))
    j = last.join(resets, on="resource", how="left")
    held = (F.col("add_seq") == F.col("seq")) & (F.col("reset_seq").isNull() | (F.col("seq") > F.col("reset_seq")))
    return j.where(held).select("resource", "member", "role", F.col("seq").alias("granted_seq"))


def check_access(attempts: DataFrame, log: DataFrame, role_permissions: DataFrame,
                 max_role_bytes: int = 64 << 20) -> DataFrame:
    """Decide every attempt (seq, member, resource, permission) as of its seq.

    1. as-of the last reset of the attempt's resource (scan keyed by resource);
    2. one probe row per role that could grant the permission (the role
       catalogue is broadcast when its estimated size is within the bound,
       joined normally otherwise; an attempt whose permission no
       role grants keeps one probe with an empty role, which nothing holds);
    3. as-of the last add/remove of (member, resource, role) before the
       attempt (scan keyed by member, resource, role);
    4. one aggregate per attempt: allowed = any role held and not reset since.
    """
    roles = bounded_broadcast(role_permissions, max_role_bytes)
    att = attempts.select("seq", "member", "resource", "permission")

    # at equal seq an attempt sorts before log rows (kind 0 < 1), so it only
    # sees grants and resets strictly before it
    resets = log.where(F.col("action") == "reset").select(
        "seq", "resource", F.lit(None).cast("bigint").alias("member"),
        F.lit(None).cast("string").alias("permission"), F.lit(1).alias("kind"))
    r = running(att.withColumn("kind", F.lit(0)).unionByName(resets), ["resource"], ["seq", "kind"],
                {"reset_seq": ("last", F.when(F.col("kind") == 1, F.col("seq")))}, exclusive=True)
    # written once: the role scan below reads its input twice
    att = stage_table(r.where(F.col("kind") == 0).drop("kind"), "access-attempts")

    probes = att.join(roles, on="permission", how="left").select(
        "seq", F.lit(0).alias("kind"), "member", "resource",
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.col("seq").alias("attempt_seq"),
        "permission", "reset_seq", F.lit(None).cast("struct<seq:bigint,action:string>").alias("act"))
    grants = log.where(F.col("action").isin("add", "remove")).select(
        "seq", F.lit(1).alias("kind"), "member", "resource", "role",
        F.lit(None).cast("bigint").alias("attempt_seq"), F.lit(None).cast("string").alias("permission"),
        F.lit(None).cast("bigint").alias("reset_seq"), F.struct("seq", "action").alias("act"))
    u = running(grants.unionByName(probes), KEY, ["seq", "kind"],
                {"last_act": ("last", F.col("act"))}, exclusive=True)

    held = (F.col("last_act.action") == "add") & (
        F.col("reset_seq").isNull() | (F.col("last_act.seq") > F.col("reset_seq")))
    return (u.where(F.col("attempt_seq").isNotNull())
            .groupBy("attempt_seq", "member", "resource", "permission")
            .agg(F.coalesce(F.bool_or(held), F.lit(False)).alias("allowed")))
