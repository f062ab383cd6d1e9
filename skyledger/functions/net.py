"""IPv4 and firewall-spec column functions (JVM-side expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ip_literal_to_long(ip: str) -> int:
    """Dotted IPv4 text to its integer value (for literal configuration)."""
    a, b, c, d = (int(x) for x in ip.split("."))
    return (a << 24) | (b << 16) | (c << 8) | d


_OCTET = "(25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 string column -> bigint; NULL for anything else (an IPv6 address, say)."""
    value = F.aggregate(F.split(ip, r"\."), F.lit(0).cast("bigint"), lambda n, o: n * 256 + o.cast("bigint"))
    return F.when(ip.rlike(rf"\A{_OCTET}(\.{_OCTET}){{3}}\z"), value)


def long_to_ip(n: Column) -> Column:
    """bigint -> dotted IPv4 string."""
    octet = lambda s: F.shiftright(n, s).bitwiseAND(F.lit(255)).cast("string")
    return F.concat_ws(".", octet(24), octet(16), octet(8), octet(0))


def cidr_bounds(cidr: Column) -> Column:
    """'a.b.c.d/n' (or '*', or a bare address) -> struct(start, end, size) as bigints.

    The start is the network address (host bits cleared), the end the
    broadcast address; '*' covers the whole IPv4 space. Any other text, IPv6
    ranges included, gives NULL fields, which no address lies between. The number and
    the prefix are parsed once, as the one item of an array that is then transformed.
    """
    text = F.when(cidr == "*", F.lit("0.0.0.0/0")).otherwise(cidr)
    parts = F.split(text, "/", 2)
    prefix = F.when(F.size(parts) == 1, F.lit(32)).otherwise(F.get(parts, 1).try_cast("int"))
    parsed = F.array(F.struct(ip_to_long(F.get(parts, 0)).alias("number"),
                              F.when(prefix.between(0, 32), F.call_function(
                                  "shiftleft", F.lit(1).cast("bigint"), F.lit(32) - prefix)).alias("size")))

    def bounds(p):
        start = p["number"].bitwiseAND(-p["size"])
        return F.struct(start.alias("start"), (start + p["size"] - 1).alias("end"), p["size"].alias("size"))

    return F.get(F.transform(parsed, bounds), 0)


def parse_rule_spec(spec: Column) -> Column:
    """'icmp,tcp:22,udp:8000-9000' or 'all' -> array<struct<protocol, low, high>>.

    Null ports mean any port; protocol 'all' matches every protocol. An item whose
    ports are not numbers matches nothing: low 1, high 0.
    """
    def item(text):
        ports = F.trim(F.substring_index(text, ":", -1))
        low = F.trim(F.substring_index(ports, "-", 1)).try_cast("int")
        high = F.trim(F.substring_index(ports, "-", -1)).try_cast("int")
        some = text.contains(":")
        good = low.isNotNull() & high.isNotNull()
        return F.struct(F.lower(F.trim(F.substring_index(text, ":", 1))).alias("protocol"),
                        F.when(some, F.when(good, low).otherwise(1)).alias("low"),
                        F.when(some, F.when(good, high).otherwise(0)).alias("high"))

    return F.transform(F.split(spec, ","), item)


def spec_matches(spec: Column, protocol: Column, port: Column) -> Column:
    """Does one parsed (protocol, low, high) spec admit this connection?"""
    return ((spec["protocol"] == F.lit("all")) | (spec["protocol"] == protocol)) & (
        spec["low"].isNull() | port.between(spec["low"], spec["high"]))


# ------------------------------------------------------- 128-bit addresses
_V4_MAPPED = "0" * 20 + "ffff"  # IPv4 addresses stand at ::ffff:a.b.c.d
_GROUPS = "[0-9a-f]{1,4}(:[0-9a-f]{1,4})*"


def _ipv6_hex(ip: Column) -> Column:
    """IPv6 text (with '::', an IPv4 tail, any case) -> 32 hex digits; NULL for anything else."""
    low = F.lower(ip)
    tail = F.regexp_extract(low, r":([0-9.]+)\z", 1)
    octets = F.lpad(F.lower(F.hex(ip_to_long(tail))), 8, "0")
    text = F.when(tail.contains("."), F.concat(
        F.substring(low, F.lit(1), F.length(low) - F.length(tail)), F.substring(octets, 1, 4), F.lit(":"),
        F.substring(octets, 5, 4))).otherwise(low)
    halves = F.split(text, "::", 2)

    def groups(side):
        return F.filter(F.split(F.coalesce(F.get(halves, side), F.lit("")), ":"), lambda g: g != "")

    parsed = F.array(F.struct(groups(0).alias("left"), groups(1).alias("right"), (F.size(halves) == 2).alias("short")))

    def digits(p):
        n = F.size(p["left"]) + F.size(p["right"])
        zeros = F.array_repeat(F.lit("0"), F.when(p["short"], 8 - n).otherwise(0))
        whole = F.when(p["short"], n <= 7).otherwise(n == 8)
        return F.when(whole, F.array_join(F.transform(F.concat(p["left"], zeros, p["right"]),
                                                      lambda g: F.lpad(g, 4, "0")), ""))

    shape = text.rlike(rf"\A({_GROUPS})?(::({_GROUPS})?)?\z") & (text != "")
    return F.when(shape, F.get(F.transform(parsed, digits), 0))


def ip_hex(ip: Column) -> Column:
    """IPv4 or IPv6 text -> 32 lower-case hex digits of the 128-bit address, NULL for anything else."""
    return F.when(ip.contains(":"), _ipv6_hex(ip)).otherwise(
        F.concat(F.lit(_V4_MAPPED), F.lpad(F.lower(F.hex(ip_to_long(ip))), 8, "0")))


def ip_binary(ip: Column) -> Column:
    """IPv4 or IPv6 text -> binary(16), which compares as the unsigned number does."""
    return F.unhex(ip_hex(ip))


def long_to_ip_binary(n: Column) -> Column:
    """An IPv4 address as bigint -> binary(16)."""
    return F.unhex(F.concat(F.lit(_V4_MAPPED), F.lpad(F.lower(F.hex(n)), 8, "0")))


def cidr_bounds_hex(cidr: Column) -> Column:
    """'address/n' of either family (or '*', or a bare address) -> struct(start, end) of 32 hex digits
    each, NULL fields for anything else. '*' covers all addresses of both families."""
    parts = F.split(cidr, "/", 2)
    base = F.get(parts, 0)
    width = F.when(base.contains(":"), 128).otherwise(32)
    given = F.when(F.size(parts) == 1, width).otherwise(F.get(parts, 1).try_cast("int"))
    parsed = F.array(F.struct(ip_hex(base).alias("digits"),
                              F.when(given.between(0, width), given + 128 - width).alias("prefix")))

    def bounds(p):
        whole, rest = F.floor(p["prefix"] / 4).cast("int"), p["prefix"] % 4
        kept = F.substring(p["digits"], F.lit(1), whole)
        nibble = F.conv(F.substring(p["digits"], whole + 1, F.lit(1)), 16, 10).cast("int")
        keep = F.call_function("shiftleft", F.lit(15), F.lit(4) - rest).bitwiseAND(F.lit(15))

        def side(value, fill):
            part = F.when(rest > 0, F.lower(F.hex(value.cast("long")))).otherwise(F.lit(""))
            return F.rpad(F.concat(kept, part), 32, fill)

        return F.struct(side(nibble.bitwiseAND(keep), "0").alias("start"),
                        side(nibble.bitwiseOR(F.bitwise_not(keep).bitwiseAND(F.lit(15))), "f").alias("end"))

    every = F.struct(F.lit("0" * 32).alias("start"), F.lit("f" * 32).alias("end"))
    return F.when(cidr == "*", every).otherwise(F.get(F.transform(parsed, bounds), 0))
