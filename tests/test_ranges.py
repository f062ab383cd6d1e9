"""128-bit addresses and decision tables over disjoint ranges."""

import ipaddress
import random

from pyspark.sql import functions as F

from skyledger.functions.net import cidr_bounds_hex, ip_binary
from skyledger.operators import network as NW
from skyledger.operators import ranges as R
from skyledger.plans.check import compare, duckdb_connection

from conftest import SF_SMALL

RULES = ("name string, network string, direction string, priority int, action string, "
         "rules string, source_ranges array<string>, target_tags array<string>")


def packed(text):
    """The 16 bytes of an address, None if Python does not take it (zones and leading zeros apart)."""
    try:
        a = ipaddress.ip_address(text)
    except ValueError:
        return None
    return a.packed if a.version == 6 else b"\0" * 10 + b"\xff\xff" + a.packed


def test_addresses(spark):
    texts = ["::", "::1", "1::", "2001:db8::1", "2001:DB8:0:0:8:800:200C:417A", "::ffff:1.2.3.4", "64:ff9b::192.0.2.33",
             "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4", "255.255.255.255", "0.0.0.0", "10.1.2.3",
             "", ":", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7:8::", "12345::", "g::", ":1", "1:",
             "::1.2.3", "::1.2.3.256", "1.2.3", "1.2.3.4.5", "256.1.1.1", "1.2.3.4::", "a.b.c.d", " ::1", "::1 ", "::1%eth0", None]
    rng = random.Random(1)
    for _ in range(300):
        texts.append(str(ipaddress.IPv6Address(rng.getrandbits(128) & rng.choice([-1, (1 << 64) - 1, ~((1 << 64) - 1), 0xFFFF << 48]))))
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", ip_binary(F.col("t")).alias("b"))
    for r in got.collect():
        want = packed(texts[r.i]) if texts[r.i] is not None and "%" not in texts[r.i] else None
        assert (bytes(r.b) if r.b is not None else None) == want, texts[r.i]


def test_bounds_of_both_families(spark):
    rng = random.Random(2)
    cases = [(f"{ipaddress.IPv6Address(rng.getrandbits(128))}/{p}") for p in range(129)]
    cases += [(f"{ipaddress.IPv4Address(rng.getrandbits(32))}/{p}") for p in range(33)]
    rows = spark.createDataFrame([(c,) for c in cases], "c string").select("c", cidr_bounds_hex(F.col("c")).alias("b")).collect()
    for r in rows:
        net = ipaddress.ip_network(r.c, strict=False)
        assert (r.b.start, r.b.end) == tuple(packed(str(a)).hex() for a in (net[0], net[-1])), r.c
    odd = ["*", "::1", "1.2.3.4", "::/129", "1.2.3.4/33", "x/3", "::/", "::/-1", "", None]
    got = [(r.b.start, r.b.end) if r.b else (None, None) for r in spark.createDataFrame(
        [(i, c) for i, c in enumerate(odd)], "i int, c string").select("i", cidr_bounds_hex(F.col("c")).alias("b")).orderBy("i").collect()]
    assert got[:3] == [("0" * 32, "f" * 32), ("0" * 31 + "1",) * 2, ("0" * 20 + "ffff01020304",) * 2]
    assert got[3:] == [(None, None)] * 7


def first_match(rules, at, condition_of):
    hits = [(r[2], n) for n, r in enumerate(rules) if r[0] <= at <= r[1] and condition_of(r)]
    return min(hits)[1] if hits else None


def test_sweep_against_every_rule():
    rng = random.Random(3)
    for shape in ("nested", "any"):
        rules = []
        for n in range(400):
            if shape == "nested":
                p = rng.randint(100, 128)
                low = (rng.getrandbits(8) << 20 | rng.getrandbits(20)) >> (128 - p) << (128 - p)
                high = low + (1 << (128 - p)) - 1
            else:
                low, high = sorted(rng.getrandbits(16) for _ in range(2))
            rules.append((low.to_bytes(16), high.to_bytes(16), (rng.randint(0, 50), f"r{n}"), rng.choice("abc") if n % 40 else "d", n % 40 == 0))
        rules.append((b"\0" * 16, b"\xff" * 16, (99, "all"), "d", True))
        lows, lists = R.sweep(rules)
        assert lows == sorted(set(lows)) and max(map(len, lists)) <= 5
        for at in [0, 1, (1 << 128) - 1, *(rng.getrandbits(rng.choice([16, 28])) for _ in range(500))]:
            a = at.to_bytes(16)
            some = lists[sum(low <= a for low in lows) - 1]
            for c in "abcd":
                want = first_match(rules, a, lambda r: r[3] == c or r[4])
                have = next((n for n in some if rules[n][3] == c or rules[n][4]), None)
                assert have == want


def test_hundred_thousand_rules_equal_brute_force(spark):
    """Random rules of one network in many slabs, requests compared with every rule."""
    import duckdb
    rules = (spark.range(100_000).selectExpr(
        "concat('r', id) AS name", "'n' AS network", "'INGRESS' AS direction", "cast(id * 7919 % 5003 AS int) AS priority",
        "if(id % 3 = 0, 'DENY', 'ALLOW') AS action", "element_at(array('all', 'tcp', 'icmp'), cast(1 + id % 3 AS int)) AS rules",
        "pmod(xxhash64(id), 4294967296) AS v", "8 + pmod(xxhash64(id, 1), 25) AS p"))
    dotted = F.concat_ws(".", *[F.shiftright("v", s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)])
    rules = rules.withColumn("source_ranges", F.array(F.concat(dotted, F.lit("/"), F.col("p").cast("string")))).withColumn(
        "target_tags", F.array().cast("array<string>"))
    conns = spark.range(400).selectExpr("id", "'n' AS network", "pmod(xxhash64(id, 2), 4294967296) AS ip_num",
                                        "if(id % 2 = 0, 'tcp', 'icmp') AS protocol", "1 AS port", "cast(array() AS array<string>) AS target_tags")
    got = sorted((r.id, r.decision, r.rule_name) for r in NW.firewall_decide(conns, rules.drop("v", "p")).collect())
    con = duckdb.connect()
    con.register("r", rules.selectExpr("name", "priority", "action", "rules", "v - v % cast(pow(2, 32 - p) AS bigint) AS low",
                                       "cast(pow(2, 32 - p) AS bigint) AS size").toPandas())
    con.register("c", conns.select("id", "ip_num", "protocol").toPandas())
    want = con.sql("""SELECT c.id, COALESCE(m.action, 'DENY'), m.name FROM c LEFT JOIN (
        SELECT c.id, r.name, r.action, row_number() OVER (PARTITION BY c.id ORDER BY r.priority, r.name) AS rn
        FROM c JOIN r ON c.ip_num >= r.low AND c.ip_num < r.low + r.size AND (r.rules = 'all' OR r.rules = c.protocol)) m
        ON m.id = c.id AND m.rn = 1""").fetchall()
    assert got == sorted(want) and sum(r[2] is not None for r in want) > 100


def test_slabs_do_not_change_decisions(spark):
    from skyledger.sources import fixtures as fx
    asked, rules = fx.range_requests(spark, SF_SMALL), fx.range_rules(spark, SF_SMALL)
    whole = sorted(tuple(r) for r in NW.firewall_decide(asked, rules).select("request_id", "decision", "rule_name").collect())
    parts = sorted(tuple(r) for r in NW.firewall_decide(asked, rules, slab_rules=3).select("request_id", "decision", "rule_name").collect())
    assert whole == parts and len({r[2] for r in whole}) > 3


def test_rows_may_have_any_columns(spark):
    rules = spark.createDataFrame([("r", "n", "INGRESS", 1, "ALLOW", "all", ["10.0.0.0/8", "nonsense"], [])], RULES)
    rows = spark.createDataFrame([("n", "10.1.2.3", "tcp", 1, None, 1, 2, 3, 4), ("n", "x", "tcp", 1, None, 1, 2, 3, 4), (None, "10.0.0.1", "tcp", 1, None, 1, 2, 3, 4)],
                                 "network string, ip string, protocol string, port int, target_tags array<string>, cuts int, lows int, lists int, slab int")
    out = NW.firewall_decide(rows, rules)
    assert out.columns == [*rows.columns, "decision", "rule_name", "rule_priority"]
    assert sorted(((r.network or "", r.ip, r.decision) for r in out.collect())) == [("", "10.0.0.1", "DENY"), ("n", "10.1.2.3", "ALLOW"), ("n", "x", "DENY")]
    assert [r.decision for r in NW.firewall_decide(rows, rules.limit(0)).collect()] == ["DENY"] * 3


def test_policy_over_both_families(spark):
    doc = """{"rules": [{"priority": 5, "action": "deny(403)", "match": {"config": {"srcIpRanges": ["2001:db8::/32", "10.0.0.0/8"]}}},
      {"priority": 1, "action": "allow", "match": {"config": {"srcIpRanges": ["2001:db8:1::/48", "bad"]}}},
      {"priority": 9, "action": "throttle", "match": {"config": {"srcIpRanges": ["*"]}}}]}"""
    df = spark.createDataFrame([("2001:db8::7",), ("2001:db8:1::7",), ("10.1.1.1",), ("::ffff:10.1.1.1",), ("fe80::1",), ("x",), (None,)], "ip string")
    got = {r.ip: r.rule_action for r in NW.policy_first_match(df, policy_json=doc).collect()}
    assert got == {"2001:db8::7": "deny(403)", "2001:db8:1::7": "allow", "10.1.1.1": "deny(403)", "::ffff:10.1.1.1": "deny(403)",
                   "fe80::1": "throttle", "x": "throttle", None: "throttle"}


def test_queries_equal_their_oracle(spark):
    con = duckdb_connection("/root/testdata/sf0.01")
    for name in ("cidr6_bounds", "range_decisions", "firewall_decisions", "policy_first_match", "cidr_bounds"):
        r = compare(spark, name, "/root/testdata/sf0.01", con)
        assert r["status"] == "ok", r
