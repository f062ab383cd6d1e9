"""Object-store inventories over time: TTL, lifecycle rules, versions, sync,
listing, snapshots and reconcile plans.

Inventories are tables of (name, generation, created, size_bytes). All
per-object work is either a partial/final aggregate (min_by / max_by —
safe under skew) or the bucketed running scan of ``operators.scan``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.text import timestamp_key
from skyledger.operators.scan import running
from skyledger.session import stage_table
from skyledger.sources import literals

LIFECYCLE_SCHEMA = T.StructType([T.StructField("rule", T.ArrayType(T.StructType([
    T.StructField("action", T.StructType([T.StructField("type", T.StringType())])),
    T.StructField("condition", T.StructType([T.StructField("age", T.IntegerType())])),
])))])


def expire_by_ttl(df: DataFrame, ts: str, ttl_s: int, now: str) -> DataFrame:
    """An item expires ``ttl_s`` seconds after ``ts``; ``now`` is a parameter."""
    expires = F.col(ts) + F.expr(f"INTERVAL {int(ttl_s)} SECONDS")
    return df.withColumn("expires_at", expires).withColumn(
        "expired", F.col("expires_at") <= F.lit(now).cast("timestamp_ntz"))


def lifecycle_rules(policy_json: str = literals.LIFECYCLE_POLICY_JSON) -> Column:
    """The rule array of a lifecycle policy document, parsed once (a folded literal)."""
    return F.from_json(F.lit(policy_json), LIFECYCLE_SCHEMA)["rule"]


def lifecycle_delete(objects: DataFrame, created: str, today: str,
                     policy_json: str = literals.LIFECYCLE_POLICY_JSON) -> DataFrame:
    """Apply delete-by-age rules: action 'Delete' when any Delete rule's age is reached.

    The rules document is tiny configuration, evaluated per row with
    higher-order functions instead of a join.
    """
    age = F.datediff(F.lit(today).cast("date"), F.col(created).cast("date"))
    hit = F.exists(lifecycle_rules(policy_json),
                   lambda r: (r["action"]["type"] == F.lit("Delete")) & (age >= r["condition"]["age"]))
    return objects.withColumn("age_days", age).withColumn(
        "action", F.when(hit, F.lit("Delete")).otherwise(F.lit("Keep")))


def list_versions(objects: DataFrame, name: str = "name", generation: str = "generation") -> DataFrame:
    """All generations of each object, oldest first, numbered 1..n.

    The version number is a running count per object, computed by a scan
    that splits an object with very many versions. Equal generations are numbered in the order of
    the other columns.
    """
    ties = [f.name for f in objects.schema.fields if f.name not in (name, generation)
            and not isinstance(f.dataType, T.MapType)]
    return running(objects, [name], [generation, *ties], {"version_no": ("sum", F.lit(1))})


def oldest_vs_current(objects: DataFrame, name: str = "name", generation: str = "generation",
                      size: str = "size_bytes") -> DataFrame:
    """Oldest (recoverable) and live generation of each object, with their sizes."""
    # fixed-width buffers only, so this is a hash aggregate with a map-side combine
    g = objects.groupBy(name).agg(
        F.count(F.lit(1)).alias("versions"),
        F.min(generation).alias("oldest_generation"), F.min_by(size, generation).alias("oldest_size"),
        F.max(generation).alias("current_generation"), F.max_by(size, generation).alias("current_size"))
    return g.withColumn("size_change", F.col("current_size") - F.col("oldest_size"))


def sync_plan(src: DataFrame, dst: DataFrame, key: str = "name", size: str = "size_bytes",
              also: tuple[str, ...] = ()) -> DataFrame:
    """One-way sync plan: new / changed / same for source keys; destination-only
    keys are kept (the sync never deletes). A key is changed if its size or any
    column of ``also`` (a checksum, say) differs; two unknown sizes are equal, and an
    unknown key is the same key on both sides."""
    def side(df, name):
        values = F.struct(F.col(size), *[F.col(c) for c in also]).alias(f"__{name}_values")
        return df.select(F.col(key).alias(f"__{name}_key"), F.col(size).alias(f"{name}_size"), values,
                         F.lit(True).alias(f"__in_{name}"))

    j = side(src, "src").join(side(dst, "dst"), F.col("__src_key").eqNullSafe(F.col("__dst_key")), "full_outer")
    status = (F.when(F.col("__in_dst").isNull(), "new")
              .when(F.col("__in_src").isNull(), "kept")
              .when(F.col("__src_values").eqNullSafe(F.col("__dst_values")), "same")
              .otherwise("changed"))
    return j.select(F.coalesce("__src_key", "__dst_key").alias(key), "src_size", "dst_size", status.alias("status"))


def sync_apply(src: DataFrame, dst: DataFrame, key: str = "name") -> DataFrame:
    """Destination after the sync: every source object plus destination-only objects (an unknown key
    is the same key on both sides)."""
    cols = src.columns
    names = src.select(F.col(key).alias("__src_key"))
    kept = dst.join(names, F.col(key).eqNullSafe(F.col("__src_key")), "left_anti").select(*cols)
    return src.withColumn("origin", F.lit("src")).unionByName(kept.withColumn("origin", F.lit("dst")))


def glob_to_regex(glob: str) -> tuple[str, str]:
    """(literal prefix, regular expression of the whole name) of a shell-like pattern: '*' and '?' stop
    at '/', '**' does not, and '**/' also stands for no folder at all."""
    out, prefix, at = "", None, 0
    while at < len(glob):
        if glob[at] in "*?" and prefix is None:
            prefix = glob[:at]
        if glob.startswith("**/", at):
            out, at = out + "(?:.*/)?", at + 3
        elif glob.startswith("**", at):
            out, at = out + ".*", at + 2
        elif glob[at] == "*":
            out, at = out + "[^/]*", at + 1
        elif glob[at] == "?":
            out, at = out + "[^/]", at + 1
        else:
            out, at = out + re.escape(glob[at]), at + 1
    return glob if prefix is None else prefix, rf"(?s)\A{out}\z"


def list_prefix(objects: DataFrame, pattern: str, name: str = "name") -> DataFrame:
    """Objects whose name matches a prefix ('dir/') or a glob ('setup*', 'logs/**/x?.txt'). The part
    before the first wildcard reaches the scan as a StartsWith filter."""
    prefix, regex = glob_to_regex(pattern)
    found = objects.where(F.col(name).startswith(prefix))
    return found if prefix == pattern else found.where(F.col(name).rlike(regex))


def list_level(objects: DataFrame, prefix: str = "", delimiter: str = "/", name: str = "name",
               size: str = "size_bytes") -> DataFrame:
    """One level of a listing: (entry, kind, objects, bytes). Names below ``prefix`` without a further
    delimiter are objects; the others are folded into common prefixes that end with it."""
    rest = F.substring(F.col(name), F.lit(len(prefix) + 1), F.length(name))
    cut = F.instr(rest, delimiter)
    folder = cut > 0
    return (objects.where(F.col(name).startswith(prefix))
            .select(F.concat(F.lit(prefix), F.when(folder, F.substring(rest, F.lit(1), cut + len(delimiter) - 1))
                             .otherwise(rest)).alias("entry"),
                    F.when(folder, "prefix").otherwise("object").alias("kind"), F.col(size).alias("size"))
            .groupBy("entry", "kind").agg(F.count(F.lit(1)).alias("objects"), F.sum("size").alias("bytes")))


def prefix_tree(objects: DataFrame, name: str = "name", size: str = "size_bytes") -> DataFrame:
    """Every folder of every level ('' is the root) with its objects and bytes, those of the folders
    below included, and the objects directly in it. Names are folded to their own folder first (with
    partial counts before the shuffle); only these few rows are handed up the tree."""
    path = F.split(F.col(name), "/")
    own = (objects.select(F.slice(path, 1, F.size(path) - 1).alias("folders"), F.col(size).alias("size"))
           .where(F.col("folders").isNotNull())
           .groupBy("folders").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")))
    up = own.select("n", "size", F.size("folders").alias("own_depth"), F.explode(F.transform(
        F.sequence(F.lit(0), F.size("folders")), lambda d: F.struct(
            d.alias("depth"), F.concat_ws("", F.transform(F.slice("folders", F.lit(1), d), lambda x: F.concat(x, F.lit("/"))))
            .alias("folder")))).alias("at"))
    return (up.groupBy(F.col("at.folder").alias("folder"), F.col("at.depth").alias("depth"))
            .agg(F.sum("n").alias("objects"), F.sum("size").alias("bytes"),
                 F.sum(F.when(F.col("own_depth") == F.col("at.depth"), F.col("n")).otherwise(0)).alias("direct_objects")))


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Recursive listing of a directory tree: path, length, modification time.

    The file contents are never read (the binaryFile source prunes them).
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).select("path", "length", "modificationTime")


def snapshot_windows(df: DataFrame, key: str, ts: str, every: str = literals.SNAPSHOT_EVERY,
                     value_cols: tuple[str, ...] = ()) -> DataFrame:
    """Last row per key per ``every`` window — the state a periodic full copy keeps.

    The snapshot is named by its time like the backup job: yyyyMMdd-HHmmss-world.
    """
    w = F.window(F.col(ts), every)
    last = F.max_by(F.struct(*[F.col(c) for c in value_cols]), F.struct(F.col(ts), *[F.col(c) for c in value_cols]))
    g = df.groupBy(F.col(key), w.alias("w")).agg(last.alias("last"))
    return g.select(key, F.col("w.start").alias("window_start"),
                    F.concat(timestamp_key(F.col("w.end")), F.lit("-world")).alias("snapshot_key"),
                    *[F.col(f"last.{c}").alias(f"last_{c}") for c in value_cols])


def snapshot_versions(df: DataFrame, key: str, ts: str, every: str = literals.SNAPSHOT_EVERY,
                      value_cols: tuple[str, ...] = ()) -> DataFrame:
    """Full copies in compact form: (key, valid_from, valid_to, values). A row is what a key holds in
    every periodic copy from ``valid_from`` up to, not including, ``valid_to`` (null: up to now); a key
    without changes in a window, or whose values come out the same, is not stored again. Rows are
    folded to one per key and window first, so a key has at most as many rows as there are windows."""
    w = F.window(F.col(ts), every)
    order = F.struct(F.col(ts), *[F.col(c) for c in value_cols])
    last = (df.where(F.col(ts).isNotNull()).groupBy(F.col(key), w.alias("w"))
            .agg(F.max_by(F.struct(*[F.col(c) for c in value_cols]), order).alias("now")))
    per_key = Window.partitionBy(key).orderBy("valid_from")
    changed = (last.select(key, F.col("w.end").alias("valid_from"), "now")
               .withColumn("was", F.lag("now").over(per_key))
               .where(F.col("was").isNull() | ~F.col("was").eqNullSafe(F.col("now"))))
    return changed.select(key, "valid_from", F.lead("valid_from").over(per_key).alias("valid_to"),
                          *[F.col(f"now.{c}").alias(c) for c in value_cols])


def snapshot_at(versions: DataFrame, at: str) -> DataFrame:
    """The full copy of one time from ``snapshot_versions``: all keys as they were."""
    t = F.lit(at).cast("timestamp_ntz")
    return versions.where((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def full_snapshots(versions: DataFrame, until: str, every: str = literals.SNAPSHOT_EVERY) -> DataFrame:
    """All full copies up to ``until``, row by row: the versions with ``snapshot_key``, the copy's name."""
    step, end = F.expr(f"INTERVAL {every}"), F.lit(until).cast("timestamp_ntz")
    stop = F.least(F.coalesce(F.col("valid_to") - step, end), end)
    times = F.when(F.col("valid_from") <= stop, F.sequence("valid_from", stop, step))
    return versions.withColumn("snapshot_time", F.explode(times)).withColumn(
        "snapshot_key", F.concat(timestamp_key(F.col("snapshot_time")), F.lit("-world")))


def snapshot_totals(versions: DataFrame, amount: Column, every: str = literals.SNAPSHOT_EVERY) -> DataFrame:
    """(snapshot_time, snapshot_key, keys, total) of every full copy between the first and the last
    change, without making the copies: what versions add and take away, summed along the times."""
    begin = versions.select(F.col("valid_from").alias("t"), F.lit(1).alias("n"), amount.alias("x"))
    end = versions.where("valid_to is not null").select(F.col("valid_to").alias("t"), F.lit(-1).alias("n"), (-amount).alias("x"))
    steps = begin.union(end).groupBy("t").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    grid = steps.agg(F.min("t").alias("a"), F.max("t").alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {every}"))).alias("t"))
    along = Window.partitionBy(F.lit(0)).orderBy("t")  # one row per snapshot time
    return grid.join(steps, "t", "left").select(
        F.col("t").alias("snapshot_time"), F.concat(timestamp_key(F.col("t")), F.lit("-world")).alias("snapshot_key"),
        F.sum(F.coalesce("n", F.lit(0))).over(along).alias("keys"), F.sum(F.coalesce("x", F.lit(0))).over(along).alias("total"))


def write_full_snapshots(versions: DataFrame, root: str, until: str, every: str = literals.SNAPSHOT_EVERY) -> str:
    """Write all full copies in one job, one folder per snapshot key; refuses to overwrite."""
    (full_snapshots(versions, until, every).drop("snapshot_time", "valid_from", "valid_to")
     .write.mode("errorifexists").partitionBy("snapshot_key").parquet(root))
    return root


def write_snapshot(df: DataFrame, root: str, key: str, fmt: str = "parquet") -> str:
    """Timestamped full copy; refuses to overwrite an existing snapshot."""
    path = f"{root.rstrip('/')}/{key}-world"
    df.write.mode("errorifexists").format(fmt).save(path)
    return path


def write_snapshot_windows(df: DataFrame, root: str, key: str, ts: str, every: str = literals.SNAPSHOT_EVERY,
                           value_cols: tuple[str, ...] = ()) -> str:
    """Backfill every periodic snapshot in one job: the last row per key per
    window, written partitioned by snapshot key (one folder per snapshot).
    Refuses to overwrite an existing snapshot root."""
    snaps = snapshot_windows(df, key, ts, every, value_cols)
    snaps.write.mode("errorifexists").partitionBy("snapshot_key").parquet(root)
    return root


def reconcile(desired: DataFrame, actual: DataFrame, key: str = "name",
              mode: str = "create_if_absent") -> DataFrame:
    """Idempotent create: 'create' when absent, 'skip' when present; or
    'recreate' (drop and create) for present keys in recreate mode."""
    present_action = {"create_if_absent": "skip", "recreate": "recreate"}[mode]
    present = actual.select(key).distinct().withColumn("__present", F.lit(True))
    j = desired.join(present, on=key, how="left")
    return j.withColumn("action", F.when(F.col("__present"), F.lit(present_action))
                        .otherwise(F.lit("create"))).drop("__present")


def dependency_levels(edges: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """(name, level) of a resource graph of (name, needs): level 0 needs nothing, any other resource
    lies one above the highest it needs; null marks a resource on a cycle or behind one.

    Rounds of one equi-join and one aggregation, each written to the shared folder: what becomes
    known in a round is handed to the resources that need it, with counts added up before the
    shuffle, so a resource that very many need, or that needs very many, crowds no task beyond one
    row per partition and name. ``max_rounds`` bounds the depth; a deeper graph is an error.
    """
    edges = stage_table(edges.where("name is not null and needs is not null").select("name", "needs").distinct(), "needs")
    names = edges.select("name").union(edges.select("needs")).distinct()
    open_ = stage_table(names.join(edges.groupBy("name").agg(F.count(F.lit(1)).alias("missing")), "name", "left")
                        .select("name", F.coalesce("missing", F.lit(0)).alias("missing")), "levels")
    known, level = [], 0
    while True:
        ready = open_.where("missing = 0").select("name")
        if ready.isEmpty():
            break
        if level > max_rounds:
            raise ValueError(f"more than {max_rounds} levels")
        known.append(ready.withColumn("level", F.lit(level)))
        met = (edges.join(ready.withColumnRenamed("name", "needs"), "needs", "left_semi")
               .groupBy("name").agg(F.count(F.lit(1)).alias("met")))
        open_ = stage_table(open_.where("missing > 0").join(met, "name", "left").select(
            "name", (F.col("missing") - F.coalesce("met", F.lit(0))).alias("missing")), "levels")
        level += 1
    out = open_.where("missing > 0").select("name", F.lit(None).cast("int").alias("level"))
    for part in known:
        out = out.union(part)
    return out


def ordered_plan(plan: DataFrame, edges: DataFrame, name: str = "name", action: str = "action") -> DataFrame:
    """A reconcile plan in dependency order: every action as the steps (phase, step, name, operation).
    Deletes run first, from what nothing needs down to the roots; creates follow, from the roots up.
    Steps of one phase and number can run together; actions on a cycle have no step (null)."""
    levels = dependency_levels(edges)
    acts = plan.select(F.col(name).alias("name"), F.explode(F.when(F.col(action) == "recreate", F.array(F.lit("delete"), F.lit("create")))
                       .when(F.col(action).isin("create", "delete"), F.array(F.col(action))).otherwise(F.array().cast("array<string>")))
                       .alias("operation"))
    top = levels.agg(F.max("level")).first()[0] or 0  # one number
    met = acts.join(levels.withColumn("listed", F.lit(True)), "name", "left")
    level = F.when(F.col("listed"), F.col("level")).otherwise(F.lit(0))
    delete = F.col("operation") == "delete"
    return met.select("name", "operation", F.when(delete, 1).otherwise(2).alias("phase"),
                      F.when(delete, F.lit(top) - level).otherwise(level).alias("step"))
