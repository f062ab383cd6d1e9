"""Keyed running aggregates that survive hot keys.

A plain ``Window.partitionBy(key).orderBy(seq)`` is one shuffle and is right for
ordinary keys, but it sends a key with a third of the data to one task. ``running``
counts the rows of every key first (a partial aggregate over the key columns only).
Keys with at least ``hot_rows`` rows are cut into buckets along their order, at
approximate quantiles of the first order column, so a bucket has about
``hot_rows / 2`` rows whether the sequence is dense or sparse. One cut makes at most
``FAN`` buckets of a key; where a bucket still has ``hot_rows`` rows or more, it is cut
again by the same rule, so a key may have any number of buckets and no list of cuts is
longer than ``FAN``. Then:

1. one window within (key, buckets) gives local results; an ordinary key is one bucket;
2. hot keys only: one summary row per innermost bucket (map-side combined); for each level
   of cuts the exclusive prefix of at most ``FAN`` summaries within their parent bucket is
   the carry of that level, and the summaries of a level are combined into those of the
   level above, as in a prefix sum over a tree;
3. the carries join back on (key, buckets), on which the large side is partitioned.

Without hot keys, step 1 is all. Supported kinds are associative: ``sum``, ``max``,
``min`` and ``last`` (last non-null value in order). Key columns may be null: they are
carried as one struct key, which is never null itself. Rows that tie in the first order
column stay in one bucket. Internal columns get names that the frame does not have.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.sizing import bounded_broadcast
from skyledger.session import stage_table

KINDS = ("sum", "max", "min", "last")
HOT_ROWS = 8192
FAN = 1024  # buckets that one cut makes of a key or bucket
CUTS_BROADCAST_BYTES = 64 << 20
_AGG = {"sum": F.sum, "max": F.max, "min": F.min}
_K, _N, _CUTS = "__key", "__n", "__cuts"


@dataclass
class HotKeys:
    """Cuts of hot keys, one frame per level: (key struct, cuts); the key of level l ends with the
    bucket numbers of the levels before. Frames have internal names only."""
    levels: list[DataFrame]


def _names(columns: list[str], *wanted: str) -> list[str]:
    """``wanted``, each with underscores until no column has the name (in any letter case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def _bucket_of(value: Column, cuts: Column) -> Column:
    """How many of the sorted cuts are at most ``value``, by binary search."""
    steps = F.transform(F.sequence(F.lit(FAN.bit_length() - 1), F.lit(0)), lambda b: F.pow(F.lit(2), b).cast("int"))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(cuts)) & (F.try_element_at(cuts, at + step) <= value), at + step).otherwise(at))


def hot_keys(df: DataFrame, keys: list[str], order: list[str], hot_rows: int | None = None) -> HotKeys | None:
    """The cuts of keys with at least ``hot_rows`` rows, or None if there are none. Runs a job, and
    one more for every level of cuts that a key needs."""
    hot_rows = hot_rows or HOT_ROWS
    rows = df.select(F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]).alias(_K),
                     F.col(f"`{order[0]}`").alias("v"))
    levels: list[DataFrame] = []
    while True:
        counted = rows.groupBy(_K).agg(F.count("*").alias(_N), F.min("v").alias("low"), F.max("v").alias("high"))
        # a bucket of one value cannot be cut
        many = stage_table(counted.filter((F.col(_N) >= hot_rows) & ((F.col("low") < F.col("high")) if levels else F.lit(True)))
                           .select(_K, _N), "hot-keys")
        if many.isEmpty():
            break
        rows = rows.join(bounded_broadcast(many, CUTS_BROADCAST_BYTES), on=_K)
        shares = [i / FAN for i in range(1, FAN)]
        parts = F.least(F.lit(FAN), F.ceil(2 * F.col(_N) / F.lit(hot_rows)).cast("int"))
        cuts = rows.groupBy(_K, _N).agg(F.percentile_approx("v", shares, 4 * FAN).alias("all")).select(
            _K, F.array_distinct(F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.element_at(
                "all", F.floor(i * FAN / parts).cast("int")))).alias(_CUTS))
        levels.append(stage_table(cuts, "hot-cuts"))
        if many.filter(F.ceil(2 * F.col(_N) / F.lit(hot_rows)) > FAN).isEmpty():
            break  # every bucket is about half of what is hot
        cut = rows.join(bounded_broadcast(levels[-1], CUTS_BROADCAST_BYTES), on=_K)
        rows = cut.select(F.struct(f"{_K}.*", F.coalesce(_bucket_of(F.col("v"), F.col(_CUTS)), F.lit(0)).alias(f"b{len(levels) - 1}"))
                          .alias(_K), "v")
    return HotKeys(levels) if levels else None


def _over(kind: str, c: Column, window) -> Column:
    return F.last(c, ignorenulls=True).over(window) if kind == "last" else _AGG[kind](c).over(window)


def _combine(kind: str, first: Column, then: Column) -> Column:
    """The aggregate of two adjacent stretches; null is that of no values."""
    if kind == "sum":
        return F.when(first.isNull() & then.isNull(), F.lit(None)).otherwise(
            F.coalesce(first, F.lit(0)) + F.coalesce(then, F.lit(0)))
    return {"max": F.greatest, "min": F.least, "last": lambda a, b: F.coalesce(b, a)}[kind](first, then)


def running(df: DataFrame, keys: list[str], order: list[str], aggs: dict[str, tuple[str, Column]],
            exclusive: bool = False, hot_rows: int | None = None, hot: HotKeys | None | bool = False) -> DataFrame:
    """Add one column per entry of ``aggs`` = {out: (kind, value expression)}.

    ``exclusive=True`` aggregates the rows strictly before each row (lag-like). ``hot`` takes
    the result of ``hot_keys`` for scans that share keys and order (False: found here).
    """
    for out, (kind, _) in aggs.items():
        if kind not in KINDS:
            raise ValueError(f"{out}: unsupported kind {kind}")
    if hot is False:
        hot = hot_keys(df, keys, order, hot_rows)
    depth = len(hot.levels) if hot else 0
    kinds = [kind for kind, _ in aggs.values()]
    key, cuts, *rest = _names([*df.columns, *aggs], _K, _CUTS, *[f"__b{i}" for i in range(depth)],
                              *[f"__v{i}" for i in range(len(aggs))], *[f"__l{i}" for i in range(len(aggs))])
    buckets, values, local = rest[:depth], rest[depth:depth + len(aggs)], rest[depth + len(aggs):]
    keep = [F.col(f"`{c}`") for c in df.columns if c not in aggs]
    d = df.select("*", F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]).alias(key),
                  *[expr.alias(v) for v, (_, expr) in zip(values, aggs.values(), strict=True)])
    first = F.col(f"`{order[0]}`")
    for i, b in enumerate(buckets):
        level = hot.levels[i].select(F.col(_K).alias(cuts + "_key"), F.col(_CUTS).alias(cuts))
        whole = F.struct(*[F.col(key)[f"k{n}"].alias(f"k{n}") for n in range(len(keys))],
                         *[F.col(x).alias(f"b{n}") for n, x in enumerate(buckets[:i])])
        d = d.join(bounded_broadcast(level, CUTS_BROADCAST_BYTES), whole == F.col(cuts + "_key"), "left")
        d = d.withColumn(b, F.when(F.col(cuts).isNotNull(), F.coalesce(_bucket_of(first, F.col(cuts)), F.lit(0)))
                         ).drop(cuts, cuts + "_key")
    # a bucket that is not cut further has no number there: one group of the windows below
    within = Window.partitionBy(key, *buckets).orderBy(*[F.col(f"`{c}`") for c in order]).rowsBetween(
        Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    results = d.select("*", *[_over(kind, F.col(v), within).alias(x)
                              for kind, v, x in zip(kinds, values, local, strict=True)])
    if not depth:
        return results.select(*keep, *[F.col(x).alias(out) for x, out in zip(local, aggs, strict=True)])

    ordered = F.struct(*[F.col(f"`{c}`") for c in order])
    summary = d.filter(F.col(buckets[0]).isNotNull()).groupBy(key, *buckets).agg(*[
        (F.max_by(F.col(v), F.when(F.col(v).isNotNull(), ordered)) if kind == "last" else _AGG[kind](F.col(v))).alias(v)
        for kind, v in zip(kinds, values, strict=True)])
    if depth > 1:
        summary = stage_table(summary, "scan-summaries")  # read by every level
    carried = results
    for i in reversed(range(depth)):
        cell = [key, *buckets[:i + 1]]
        rows = summary if i == depth - 1 else summary.groupBy(*cell).agg(*[
            (F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.struct(*buckets[i + 1:]))) if kind == "last"
             else _AGG[kind](F.col(v))).alias(v) for kind, v in zip(kinds, values, strict=True)])
        before = Window.partitionBy(key, *buckets[:i]).orderBy(buckets[i]).rowsBetween(Window.unboundedPreceding, -1)
        names = [f"{x}_c" for x in local]
        carry = rows.filter(F.col(buckets[i]).isNotNull()).select(
            F.struct(*cell).alias(cuts), *[_over(kind, F.col(v), before).alias(n)
                                           for kind, v, n in zip(kinds, values, names, strict=True)])
        met = carried.join(bounded_broadcast(carry, CUTS_BROADCAST_BYTES), F.struct(*cell) == F.col(cuts), "left")
        new = {x: _combine(kind, F.col(n), F.col(x)) for kind, x, n in zip(kinds, local, names, strict=True)}
        carried = met.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in results.columns])
    return carried.select(*keep, *[F.col(x).alias(out) for x, out in zip(local, aggs, strict=True)])
