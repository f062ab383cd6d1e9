"""Network rules over connection and request logs.

Firewall rules become decision tables over disjoint address ranges (``ranges``), which
connections meet by network and slab; the first match is found inside the row. A security
policy is one document, swept once and searched as a literal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.net import cidr_bounds_hex, ip_binary, long_to_ip_binary, parse_rule_spec, spec_matches
from skyledger.operators import ranges
from skyledger.operators.sizing import bounded_broadcast, literal_table
from skyledger.sources import literals

MAX_BROADCAST_BYTES = 256 << 20
HEAVY_SHARE = 1 / 200  # of all rows: a machine with more is split

RULE_SCHEMA = ("name string, network string, direction string, priority int, action string, "
               "rules string, source_ranges array<string>, target_tags array<string>")


def firewall_rules(spark) -> DataFrame:
    return literal_table(spark, literals.FIREWALL_RULES, RULE_SCHEMA)


def _condition(r: DataFrame, specs: str, tags: str) -> tuple[Column, Column]:
    """A text that is equal for rules that match the same rows of their ranges, and whether a rule
    matches all of them."""
    tagged = F.coalesce(F.col(tags), F.array().cast("array<string>"))
    text = F.concat_ws("|", F.regexp_replace(F.lower(F.col(specs)), r"\s", ""), F.array_join(F.array_sort(tagged), ","))
    return text, (F.lower(F.trim(F.col(specs))) == "all") & (F.size(tagged) == 0)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Ingress rules for ``ranges.decision_tables``: one row per rule and source range (IPv4, IPv6 or
    '*'), with the specs parsed once."""
    condition, always = _condition(rules, "rules", "target_tags")
    bounds = F.transform("source_ranges", lambda r: cidr_bounds_hex(r))
    return (rules.where(F.upper(F.col("direction")) == "INGRESS")
            .select(F.col("network").alias("group"), F.explode(bounds).alias("b"), "priority", "name",
                    F.struct("priority", "name", F.upper(F.col("action")).alias("action"),
                             parse_rule_spec(F.col("rules")).alias("specs"),
                             F.coalesce(F.col("target_tags"), F.array().cast("array<string>")).alias("tags")).alias("rule"),
                    condition.alias("condition"), always.alias("always"))
            .select("group", F.unhex("b.start").alias("start"), F.unhex("b.end").alias("end"),
                    F.coalesce("priority", F.lit((1 << 31) - 1)).alias("priority"),  # unknown: last
                    F.coalesce("name", F.lit("")).alias("name"), "rule", "condition", "always"))


def _matches(r: Column, protocol: Column, port: Column, tags: Column) -> Column:
    return (F.exists(r["specs"], lambda s: spec_matches(s, protocol, port))
            & ((F.size(r["tags"]) == 0) | F.arrays_overlap(r["tags"], F.coalesce(
                tags, F.array().cast("array<string>")))))


def firewall_decide(conns: DataFrame, rules: DataFrame, slab_rules: int = ranges.SLAB_RULES) -> DataFrame:
    """Ingress decision per connection: among the rules of its network whose
    source range, protocol/port and target tags match, the lowest priority
    number wins (ties: rule name); no match means DENY.

    The rules of a network become a decision table over disjoint address ranges (see
    ``ranges``); a connection finds its range by binary search and takes the first rule of the
    range's short list that matches. It needs no identity: rows with equal or null ids are
    decided one by one. A null network or address matches nothing.

    ``conns`` needs: network, protocol, port, target_tags, and the source as ``ip_num`` (an
    IPv4 number) or ``ip`` (text of either family, used where there is no ``ip_num``).
    """
    cuts, tables = ranges.decision_tables(prepare_rules(rules), slab_rules)
    source = long_to_ip_binary(F.col("ip_num")) if "ip_num" in conns.columns else ip_binary(F.col("ip"))
    met = ranges.candidates(conns.withColumn("__address", source), cuts, tables, "network", "__address", "__rules")
    best = F.get(F.filter("__rules", lambda r: _matches(r, F.col("protocol"), F.col("port"), F.col("target_tags"))), 0)
    return met.withColumn("__best", best).select(
        *conns.columns, F.coalesce(F.col("__best.action"), F.lit("DENY")).alias("decision"),
        F.col("__best.name").alias("rule_name"), F.col("__best.priority").alias("rule_priority"))


SECURITY_POLICY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("rules", T.ArrayType(T.StructType([
        T.StructField("action", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("priority", T.LongType()),
        T.StructField("match", T.StructType([
            T.StructField("versionedExpr", T.StringType()),
            T.StructField("config", T.StructType([
                T.StructField("srcIpRanges", T.ArrayType(T.StringType()))]))])),
        T.StructField("rateLimitOptions", T.StructType([
            T.StructField("conformAction", T.StringType()),
            T.StructField("enforceOnKey", T.StringType()),
            T.StructField("exceedAction", T.StringType()),
            T.StructField("rateLimitThreshold", T.StructType([
                T.StructField("count", T.IntegerType()),
                T.StructField("intervalSec", T.IntegerType())]))])),
    ]))),
])


def policy_rules(spark, policy_json: str = literals.SECURITY_POLICY_JSON) -> DataFrame:
    """The rules of a security-policy document as rows."""
    doc = spark.range(1).select(F.from_json(F.lit(policy_json), SECURITY_POLICY_SCHEMA).alias("p"))
    return doc.select(F.explode("p.rules").alias("r")).select(
        F.col("r.priority").alias("priority"), F.col("r.action").alias("action"),
        F.col("r.description").alias("description"),
        F.col("r.match.config.srcIpRanges").alias("src_ip_ranges"),
        F.col("r.rateLimitOptions.rateLimitThreshold.count").alias("rate_limit_count"),
        F.col("r.rateLimitOptions.rateLimitThreshold.intervalSec").alias("rate_limit_interval_s"),
        F.col("r.rateLimitOptions.exceedAction").alias("exceed_action"))


def policy_first_match(requests: DataFrame, ip: str = "ip",
                       policy_json: str = literals.SECURITY_POLICY_JSON) -> DataFrame:
    """First rule (lowest priority number) whose source ranges match the request, whether they are
    IPv4 or IPv6 ('*' matches all, and is the only range that matches what is no address).

    A policy is one document of a bounded size, so its sweep runs on the driver and the
    elementary ranges are a literal; a request's address is parsed once and searched."""
    doc = requests.sparkSession.range(1).select(F.explode(F.from_json(F.lit(policy_json), SECURITY_POLICY_SCHEMA)["rules"]).alias("r"))
    rows = doc.select("r.priority", "r.action", F.explode("r.match.config.srcIpRanges").alias("range"))
    found = rows.select("priority", "action", "range", cidr_bounds_hex(F.col("range")).alias("b")).collect()
    rules = [(bytes.fromhex(r.b.start), bytes.fromhex(r.b.end), (r.priority, r.action), "", True)
             for r in found if r.b and r.b.start]
    lows, lists = ranges.sweep(rules)
    any_of = min(((r.priority, r.action) for r in found if r.range == "*"), default=(None, None))
    winner = F.array(*[_rule_literal(*(rules[some[0]][2] if some else (None, None))) for some in lists])
    asked = requests.withColumn("__ip", ip_binary(F.col(ip)))
    at = ranges.position(F.col("__ip"), F.array(*[F.lit(low) for low in lows]))
    met = asked.withColumn("__rule", F.when(F.col("__ip").isNull(), _rule_literal(*any_of)).otherwise(F.get(winner, at - 1)))
    return met.select(*requests.columns, F.col("__rule.priority").alias("rule_priority"),
                      F.col("__rule.action").alias("rule_action"))


def _rule_literal(priority: int | None, action: str | None) -> Column:
    return F.struct(F.lit(priority).cast("long").alias("priority"), F.lit(action).cast("string").alias("action"))


def resolve_network(instances: DataFrame, subnets: DataFrame) -> DataFrame:
    """instance -> subnet -> network (the subnet catalogue is broadcast after a size check)."""
    cat = bounded_broadcast(subnets.select("subnet", "network", "region"), MAX_BROADCAST_BYTES)
    return instances.join(cat, on="subnet", how="left")


def heavy_keys_of(df: DataFrame, keys: list[str], share: float = HEAVY_SHARE) -> dict[str, dict]:
    """Per key column, its values with about ``share`` of the rows or more, and of how many such shares each
    has the rows. One pass for all columns, with frequent-items sketches per task, merged: at most
    1 / share values of a column reach the driver."""
    k = int(1 / share)
    tops = [F.expr(f"approx_top_k(`{key}`, {k}, {4 * k})").alias(f"top{i}") for i, key in enumerate(keys)]
    counts = [F.count(F.col(f"`{key}`")).alias(f"n{i}") for i, key in enumerate(keys)]
    found = df.agg(*tops, *counts).first()
    return {key: {r["item"]: math.ceil(r["count"] / (share * found[f"n{i}"])) for r in found[f"top{i}"] or []
                  if r["count"] >= share * found[f"n{i}"] and r["item"] is not None} for i, key in enumerate(keys)}


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> dict:
    """The heavy values of one column (see ``heavy_keys_of``)."""
    return heavy_keys_of(df, [key], share)[key]


def salted_left_join(big: DataFrame, small: DataFrame, key: str, share: float = HEAVY_SHARE,
                     heavy: dict | None = None) -> DataFrame:
    """``big`` left join ``small`` (one row per key) on ``key``, its hot keys split: rows of a hot key are
    dealt over as many salts as it has shares of the rows, and the key's row is copied to each salt.
    Other keys are not copied. The salt is a hash of the row, so a repeated task deals alike.
    ``heavy``: the hot keys, where they are known. Merge joined at every size: what is shuffled grows
    as ``big`` does."""
    heavy = heavy_keys(big, key, share) if heavy is None else heavy
    if not heavy:
        return big.join(small.hint("merge"), key, "left")
    salts = F.create_map(*[F.lit(x) for pair in heavy.items() for x in pair])
    of = F.coalesce(F.try_element_at(salts, F.col(key)), F.lit(1))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), of).cast("int")
    dealt = big.withColumn("__salt", salt)
    copied = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), of - 1)))
    return dealt.join(copied.hint("merge"), [key, "__salt"], "left").drop("__salt")


def reachability(conns: DataFrame, located: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Per connection: 'internal' when both ends are on the same network,
    else 'external' (internal addresses do not route across networks).
    Linear in the connections — no instance pairs are enumerated, and machines with a large
    share of the connections are split (see ``salted_left_join``); both ends' are found in one pass."""
    loc = located.select("name", "network")
    s = loc.select(F.col("name").alias(src), F.col("network").alias("src_network"))
    d = loc.select(F.col("name").alias(dst), F.col("network").alias("dst_network"))
    heavy = heavy_keys_of(conns, [src, dst])
    j = salted_left_join(salted_left_join(conns, s, src, heavy=heavy[src]), d, dst, heavy=heavy[dst])
    same = F.col("src_network").isNotNull() & (F.col("src_network") == F.col("dst_network"))
    return j.withColumn("path", F.when(same, "internal").otherwise("external"))
