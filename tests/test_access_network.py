"""Grant replay, as-of access checks, CIDR, rule specs, firewall and policy matching."""

from pyspark.sql import functions as F

from skyledger.functions.net import cidr_bounds, parse_rule_spec
from skyledger.operators import access as A
from skyledger.operators import network as NW
from skyledger.sources import literals

LOG = "seq long, member long, resource string, role string, action string"
ATT = "seq long, member long, resource string, permission string"


def rp(spark):
    return spark.createDataFrame(literals.ROLE_PERMISSIONS, "role string, permission string")


def test_lab_access_matrix(spark):
    """The service account's probes: list VMs fails, download passes, upload
    fails, and passes once objectCreator joins objectViewer."""
    log = spark.createDataFrame([(10, 1, "b", "roles/storage.objectViewer", "add"),
                                 (40, 1, "b", "roles/storage.objectCreator", "add")], LOG)
    att = spark.createDataFrame([(20, 1, "b", "compute.instances.list"), (21, 1, "b", "storage.objects.get"),
                                 (22, 1, "b", "storage.objects.create"), (50, 1, "b", "storage.objects.create"),
                                 (51, 1, "b", "storage.objects.get")], ATT)
    got = {r.attempt_seq: r.allowed for r in A.check_access(att, log, rp(spark)).collect()}
    assert got == {20: False, 21: True, 22: False, 50: True, 51: True}


def test_added_removed_readded_and_reset(spark):
    log = spark.createDataFrame([(1, 7, "b", "roles/viewer", "add"), (3, 7, "b", "roles/viewer", "remove"),
                                 (5, 7, "b", "roles/viewer", "add"), (7, 0, "b", None, "reset"),
                                 (9, 8, "b", "roles/viewer", "add")], LOG)
    att = spark.createDataFrame([(2, 7, "b", "compute.instances.list"), (4, 7, "b", "compute.instances.list"),
                                 (6, 7, "b", "compute.instances.list"), (8, 7, "b", "compute.instances.list"),
                                 (10, 8, "b", "compute.instances.list")], ATT)
    got = {r.attempt_seq: r.allowed for r in A.check_access(att, log, rp(spark)).collect()}
    assert got == {2: True, 4: False, 6: True, 8: False, 10: True}
    eff = {(r.member, r.role) for r in A.effective_bindings(log).collect()}
    assert eff == {(8, "roles/viewer")}


def test_cidr_bounds_and_wildcard(spark):
    df = spark.createDataFrame([("10.128.0.0/9",), ("*",), ("35.235.240.7/20",)], "c string")
    r = [tuple(x.b) for x in df.select(cidr_bounds(F.col("c")).alias("b")).collect()]
    assert r[0] == (176160768, 176160768 + 8388608 - 1, 8388608)
    assert r[1] == (0, 4294967295, 4294967296)
    assert r[2][0] % 4096 == 0 and r[2][2] == 4096


def test_rule_spec_all_and_icmp(spark):
    df = spark.createDataFrame([("icmp,tcp:22,tcp:3389",), ("all",)], "s string")
    specs = [[tuple(x) for x in r.p] for r in df.select(parse_rule_spec(F.col("s")).alias("p")).collect()]
    assert specs == [[("icmp", None, None), ("tcp", 22, 22), ("tcp", 3389, 3389)], [("all", None, None)]]
    wide = spark.createDataFrame([("tcp:8000-9000",), ("tcp:x",)], "s string")
    specs = [[tuple(x) for x in r.p] for r in wide.select(parse_rule_spec(F.col("s")).alias("p")).collect()]
    assert specs == [[("tcp", 8000, 9000)], [("tcp", 1, 0)]]


CONN = "request_id long, network string, ip_num long, protocol string, port int, target_tags array<string>"


def test_firewall_priority_tags_and_default_deny(spark):
    ip = lambda s: sum(int(p) << (8 * (3 - i)) for i, p in enumerate(s.split(".")))
    conns = spark.createDataFrame([
        (1, "mynetwork", ip("35.235.240.5"), "tcp", 22, ["iap-gce"]),     # iap rule (1000) beats ssh (65534)
        (2, "mynetwork", ip("8.8.8.8"), "tcp", 22, []),                   # ssh, no tags needed
        (3, "mynetwork", ip("10.200.0.1"), "udp", 53, []),                # allow-custom: all
        (4, "default", ip("8.8.8.8"), "tcp", 80, []),                     # http needs tag -> deny
        (5, "default", ip("8.8.8.8"), "tcp", 80, ["http-server"]),
        (6, "privatenet", ip("1.2.3.4"), "icmp", None, None),
        (7, "no-such-net", ip("1.2.3.4"), "tcp", 22, []),                 # network without rules
    ], CONN)
    rules = NW.firewall_rules(spark)
    got = {r.request_id: (r.decision, r.rule_name) for r in NW.firewall_decide(conns, rules).collect()}
    assert got == {1: ("ALLOW", "allow-iap-ssh"), 2: ("ALLOW", "mynetwork-allow-ssh"),
                   3: ("ALLOW", "mynetwork-allow-custom"), 4: ("DENY", None),
                   5: ("ALLOW", "allow-http"), 6: ("ALLOW", "privatenet-allow-icmp-ssh-rdp"),
                   7: ("DENY", None)}


def test_firewall_rows_need_no_identity(spark):
    """Repeated and null ids, null networks on either side, and more than a thousand rules."""
    ip = 8 * 16777216
    conns = spark.createDataFrame([(1, "default", ip, "tcp", 80, ["http-server"]), (1, "default", ip, "tcp", 81, []),
                                   (None, "default", ip, "tcp", 80, ["http-server"]), (2, None, ip, "tcp", 80, []),
                                   (3, "big", ip, "tcp", 8500, []), (4, "big", ip, "tcp", 9001, [])], CONN)
    extra = spark.createDataFrame(
        [(f"r{i:04}", "big", "INGRESS", 5000 - i, "ALLOW", f"tcp:{8000 + i}-{8000 + i}", ["0.0.0.0/0"], []) for i in range(1200)]
        + [("none", None, "INGRESS", 1, "ALLOW", "all", ["0.0.0.0/0"], []), ("bad", "big", "INGRESS", 1, "DENY", "tcp:x", ["::/0"], []),
           ("wide", "big", "INGRESS", 6000, "DENY", "tcp:8000-8999", ["0.0.0.0/0"], None)], NW.RULE_SCHEMA)
    rows = NW.firewall_decide(conns, NW.firewall_rules(spark).unionByName(extra)).collect()
    got = sorted(((r.request_id, r.port, r.decision, r.rule_name) for r in rows), key=str)
    assert got == sorted([(1, 80, "ALLOW", "allow-http"), (1, 81, "DENY", None), (None, 80, "ALLOW", "allow-http"),
                          (2, 80, "DENY", None), (3, 8500, "ALLOW", "r0500"), (4, 9001, "ALLOW", "r1001")], key=str)


def test_addresses_that_are_not_ipv4(spark):
    df = spark.createDataFrame([("10.0.0.1",), ("2001:db8::1",), ("1.2.3",), ("1.2.3.400",), (None,), ("10.0.0.0/40",)], "c string")
    got = [tuple(r.b) if r.b else None for r in df.select(cidr_bounds(F.col("c")).alias("b")).collect()]
    assert got[0] == (167772161, 167772161, 1)
    assert all(g is None or g[0] is None for g in got[1:])
    import json
    doc = json.dumps({"rules": [
        {"action": "deny(403)", "priority": 1, "match": {"config": {"srcIpRanges": ["10.0.0.0/8", "2001:db8::/32"]}}},
        {"action": "allow", "priority": 9, "match": {"config": {"srcIpRanges": ["*"]}}}]})
    got = {r.c: r.rule_action for r in NW.policy_first_match(df, "c", doc).collect()}
    assert got["10.0.0.1"] == "deny(403)" and got["2001:db8::1"] == "deny(403)"  # an IPv6 range matches IPv6
    assert got["1.2.3"] == "allow" and got[None] == "allow"


def test_policy_first_match_prefers_throttle(spark):
    df = spark.createDataFrame([("1.2.3.4",)], "ip string")
    r = NW.policy_first_match(df).first()
    assert (r.rule_priority, r.rule_action) == (2147483646, "throttle")
    rules = {r.action: r.rate_limit_count for r in NW.policy_rules(spark).collect()}
    assert rules == {"allow": None, "throttle": 500}


def test_reachability_same_network_only(spark):
    inst = spark.createDataFrame([("a", "net1"), ("b", "net1"), ("c", "net2")], "name string, network string")
    conns = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "zz")], "src string, dst string")
    got = {(r.src, r.dst): r.path for r in NW.reachability(conns, inst).collect()}
    assert got == {("a", "b"): "internal", ("a", "c"): "external", ("a", "zz"): "external"}


def test_grant_with_the_same_seq_is_not_seen(spark):
    log = spark.createDataFrame([(5, 1, "b", "roles/viewer", "add"), (9, 1, "b", None, "reset"),
                                 (12, 1, "b", "roles/viewer", "add")], LOG)
    att = spark.createDataFrame([(5, 1, "b", "compute.instances.list"), (6, 1, "b", "compute.instances.list"),
                                 (9, 1, "b", "compute.instances.list"), (10, 1, "b", "compute.instances.list")],
                                ATT)
    got = {r.attempt_seq: r.allowed for r in A.check_access(att, log, rp(spark)).collect()}
    assert got == {5: False, 6: True, 9: True, 10: False}


def test_policy_first_match_with_ranges(spark):
    import json
    doc = json.dumps({"rules": [
        {"action": "allow", "priority": 2147483647, "match": {"config": {"srcIpRanges": ["*"]}}},
        {"action": "deny(403)", "priority": 100, "match": {"config": {"srcIpRanges": ["10.0.0.0/8"]}}},
        {"action": "throttle", "priority": 200, "match": {"config": {"srcIpRanges": ["10.1.0.0/16"]}}}]})
    df = spark.createDataFrame([("10.1.2.3",), ("192.168.0.1",)], "ip string")
    got = {r.ip: (r.rule_priority, r.rule_action) for r in NW.policy_first_match(df, policy_json=doc).collect()}
    assert got == {"10.1.2.3": (100, "deny(403)"), "192.168.0.1": (2147483647, "allow")}
