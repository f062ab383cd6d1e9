"""First matching rule by address: decision tables over disjoint address ranges.

Rules have address ranges (binary(16), so IPv4 and IPv6 alike), a priority and a condition.
The bounds of a group's rules cut the address space into elementary intervals, and a sweep
over the sorted bounds gives each interval the rules that cover it, in priority order, as far
as they can win: a rule behind an unconditional one, or behind one with the same condition,
is left out. So a list has at most one rule per distinct condition, whatever the number of
rules. A row finds its interval by binary search and tests the few rules of its list.

A group with many rules is swept in slabs: its address space is cut at approximate quantiles
of the rules' starts into slabs of about ``SLAB_RULES`` rules, a rule goes to every slab it
overlaps, and a row belongs to one slab. So no group of rules is gathered whole, and rows of
a large group are spread over its slabs. Rows meet slabs by an equi-join, broadcast while the
table's size is within a bound.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.scan import FAN, _bucket_of
from skyledger.operators.sizing import bounded_broadcast
from skyledger.session import ship_package, stage_table

SLAB_RULES = 4096
MAX_BROADCAST_BYTES = 256 << 20
_LAST = b"\xff" * 16


def _number(address: Column) -> Column:
    """A double that never decreases as the address grows (exact below 2^53, so for IPv4)."""
    digits = F.hex(address)
    parts = [F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("double") for i in range(4)]
    return ((parts[0] * 2.0**32 + parts[1]) * 2.0**32 + parts[2]) * 2.0**32 + parts[3]


def sweep(rules: list[tuple]) -> tuple[list[bytes], list[list[int]]]:
    """Elementary intervals of rules (start, end, order, condition, unconditional): the first address of
    each interval, and the numbers of the rules that may win in it, in order."""
    opens, closes = {}, {}
    for n, (start, end, *_) in enumerate(rules):
        opens.setdefault(start, []).append(n)
        if end != _LAST:
            closes.setdefault((int.from_bytes(end) + 1).to_bytes(16), []).append(n)
    lows, lists, active = [b"\0" * 16], [[]], []
    for at in sorted(opens.keys() | closes.keys()):
        for n in closes.get(at, ()):
            del active[bisect_left(active, (rules[n][2], n))]
        for n in opens.get(at, ()):
            insort(active, (rules[n][2], n))
        some, seen = [], set()
        for _, n in active:
            if rules[n][3] not in seen:
                seen.add(rules[n][3])
                some.append(n)
            if rules[n][4]:
                break
        if at == lows[-1]:
            lists[-1] = some
        elif some != lists[-1]:
            lows.append(at)
            lists.append(some)
    return lows, lists


def decision_tables(rules: DataFrame, slab_rules: int = SLAB_RULES) -> tuple[DataFrame, DataFrame]:
    """(cuts, tables) of rules (group, start, end, priority, name, rule, condition, always): ``rule`` is
    the struct a row gets, equal ``condition`` strings match the same rows, ``always`` rules match all.
    cuts: (group, cuts); tables: (group, slab, lows, lists). Ranges with a null bound match nothing."""
    ship_package(rules.sparkSession)
    rules = rules.filter("group is not null and start is not null and end is not null and start <= end")
    rules = stage_table(rules.withColumn("at", _number(F.col("start"))), "range-rules")
    sizes = rules.groupBy("group").agg(F.count("*").alias("n"), F.percentile_approx(
        "at", [i / FAN for i in range(1, FAN)], 4 * FAN).alias("all"))
    slabs = F.least(F.lit(FAN), F.ceil(F.col("n") / slab_rules).cast("int"))
    cuts = stage_table(sizes.select("group", F.when(slabs > 1, F.array_distinct(F.transform(
        F.sequence(F.lit(1), slabs - 1), lambda i: F.element_at("all", F.floor(i * FAN / slabs).cast("int")))))
        .otherwise(F.array().cast("array<double>")).alias("cuts")), "range-cuts")
    placed = rules.join(bounded_broadcast(cuts, MAX_BROADCAST_BYTES), "group")
    reach = F.sequence(_bucket_of(F.col("at"), F.col("cuts")), _bucket_of(_number(F.col("end")), F.col("cuts")))
    placed = placed.select("group", F.explode(reach).alias("slab"), "start", "end", "priority", "name", "rule",
                           "condition", "always")
    payload = rules.schema["rule"].dataType.simpleString()
    group = rules.schema["group"].dataType.simpleString()

    def table(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        rows = [(bytes(s), bytes(e), (p, n), c, a) for s, e, p, n, c, a in zip(
            *(frame[c] for c in ("start", "end", "priority", "name", "condition", "always")), strict=True)]
        lows, lists = sweep(rows)
        payloads = frame["rule"].tolist()
        return pd.DataFrame({"group": [key[0]], "slab": [key[1]], "lows": [lows],
                             "lists": [[[payloads[n] for n in some] for some in lists]]})

    tables = placed.groupBy("group", "slab").applyInPandas(
        table, f"`group` {group}, slab int, lows array<binary>, lists array<array<{payload}>>")
    return cuts, stage_table(tables, "range-tables")


def candidates(rows: DataFrame, cuts: DataFrame, tables: DataFrame, group: str, address: str, out: str) -> DataFrame:
    """``rows`` with the column ``out``: the rules that may win at the row's address, in order (null
    where its group has no rules or its address is null)."""
    cuts = cuts.select(F.col("group").alias("__range_group"), F.col("cuts").alias("__cuts"))
    tables = tables.select(F.col("group").alias("__table_group"), F.col("slab").alias("__slab"),
                           F.col("lows").alias("__lows"), F.col("lists").alias("__lists"))
    met = rows.join(bounded_broadcast(cuts, MAX_BROADCAST_BYTES), F.col(group) == F.col("__range_group"), "left")
    met = met.withColumn("__row_slab", _bucket_of(_number(F.col(address)), F.col("__cuts")))
    met = met.join(bounded_broadcast(tables, MAX_BROADCAST_BYTES), (F.col("__range_group") == F.col("__table_group"))
                   & (F.col("__row_slab") == F.col("__slab")), "left")
    found = met.withColumn("__at", position(F.col(address), F.col("__lows")))
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], F.get("__lists", F.col("__at") - 1).alias(out))


def position(value: Column, lows: Column) -> Column:
    """How many of the sorted ``lows`` are at most ``value``, by binary search (31 steps at most)."""
    steps = F.transform(F.sequence(F.ceil(F.log2(F.size(lows) + 1)).cast("int"), F.lit(0)), lambda b: F.pow(F.lit(2), b).cast("int"))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(lows)) & (F.try_element_at(lows, at + step) <= value), at + step).otherwise(at))
