"""Health state over a probe stream with an ordered keyed state (transformWithStateInPandas).

Probes may arrive out of order. An instance's probes are kept in time order in a map state:
chunks of bounded size, keyed by the time of their first probe, each with its probes, their
outcomes and their states. A small value state has the index: where the chunks begin and
end, and the decision (open run, state) behind each. A probe is put into its chunk, states
are decided again from there, and the walk ends at the first chunk whose decision comes out
as it was; runs longer than the thresholds count as the threshold, so a late probe inside a
long run changes nothing behind it. Only new probes and probes whose state changed are
returned, with a version number; a probe's state is read from its highest version, so the
result equals the batch operator and the sink has about one row per probe.

With ``lateness_s`` set, probes older than the newest one of the instance by more than
that are decided for good and leave the state, which bounds it; a probe that comes later
still cannot be placed any more and is returned with state LATE, never dropped. Without it
(the default) every order of arrival gives the batch result, and an instance's probes stay
in the state store (RocksDB, which this API needs). With ``expire_after`` a timer of the
instance, set anew by every probe, clears its state after that much silence.

A probe without an answer or latency is a failure; one without a time is returned as
UNKNOWN and does not count. Probes of one instance with equal times stay in one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skyledger.session import scratch_path, ship_package
from skyledger.sources import literals
from skyledger.sources.fixtures import probes_from_events
from skyledger.streaming.rate_limit import event_stream

HC = literals.HEALTH_CHECK

OUTPUT_SCHEMA = ("probe_id long, instance long, ts timestamp_ntz, success boolean, counted boolean, "
                 "state string, version long")
INDEX_SCHEMA = ("first_us long, decided_us long, newest_us long, version long, run_ok boolean, run_len long, state string, "
                "starts array<long>, lasts array<long>, out_ok array<boolean>, out_len array<long>, out_state array<string>")
CHUNK_SCHEMA = "ids array<long>, times array<long>, successes array<boolean>, counted array<boolean>, states array<string>"
CHUNK_PROBES = 512
NO_ID = np.iinfo(np.int64).min  # a null probe id inside
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def decide(ts_us, success, first_us, run_ok, run_len, cur, initial_delay_s, up, down):
    """States of sorted probes after a decided past: (counted, states, run lengths). A probe is
    decisive when its run of equal outcomes reaches the threshold."""
    counted = ts_us >= first_us + int(initial_delay_s) * 1_000_000
    states = np.full(len(ts_us), "UNKNOWN", dtype=object)
    lengths = np.zeros(len(ts_us), dtype=np.int64)
    ok = success[counted]
    if len(ok):
        change = np.empty(len(ok), dtype=bool)
        change[0] = run_ok is None or bool(ok[0]) != run_ok
        change[1:] = ok[1:] != ok[:-1]
        start = np.maximum.accumulate(np.where(change, np.arange(len(ok)), -1 if not change[0] else 0))
        lens = np.where(start >= 0, np.arange(len(ok)) - start + 1, np.arange(len(ok)) + 1 + run_len)
        mark = np.where(ok & (lens >= up), "HEALTHY", np.where(~ok & (lens >= down), "UNHEALTHY", None))
        states[counted] = pd.Series(mark, dtype=object).ffill().fillna(cur).to_numpy()
        lengths[counted] = lens
    return counted, states, lengths


class Timeline:
    """One instance's probes in order. ``load(start)``, ``save(start, chunk)`` and ``remove(start)``
    reach its chunks; ``index`` is the tuple of INDEX_SCHEMA, or None for a new instance."""

    def __init__(self, index, load, save, remove, timeout_s: float = HC["timeout_s"],
                 initial_delay_s: int = HC["initial_delay_s"], up: int = HC["healthy_threshold"],
                 down: int = HC["unhealthy_threshold"], lateness_s: float | None = None,
                 chunk_probes: int = CHUNK_PROBES):
        self.load, self.save, self.remove = load, save, remove
        self.timeout_s, self.delay, self.up, self.down = timeout_s, initial_delay_s, up, down
        self.lateness_s, self.chunk_probes = lateness_s, chunk_probes
        index = index or (None, None, None, 0, None, 0, "UNKNOWN", [], [], [], [], [])
        self.first, self.decided, self.newest, self.version = index[:4]
        self.base = tuple(index[4:7])
        self.starts, self.lasts = list(index[7]), list(index[8])
        self.outs = list(zip(*index[9:12], strict=True))

    def index(self):
        outs = [list(c) for c in zip(*self.outs, strict=True)] or [[], [], []]
        return (self.first, self.decided, self.newest, self.version, *self.base, self.starts, self.lasts, *outs)

    def _decide(self, times, ok, carry):
        """Counted, states, and the decision behind the probes."""
        counted, states, lengths = decide(times, ok, self.first, *carry, self.delay, self.up, self.down)
        done = np.nonzero(counted)[0]
        if len(done):
            last = done[-1]
            carry = (bool(ok[last]), min(int(lengths[last]), max(self.up, self.down)), str(states[last]))
        return counted, states, carry

    def add(self, ids, us, ok):
        """Merge probes; returns arrays (ids, us, ok, counted, states) of new and changed ones."""
        self.version += 1
        out = []
        if self.decided is not None and (us <= self.decided).any():
            late = us <= self.decided
            out.append((ids[late], us[late], ok[late], np.zeros(late.sum(), bool), np.full(late.sum(), "LATE", object)))
            ids, us, ok = ids[~late], us[~late], ok[~late]
        if len(us):
            order = np.lexsort((ids, us))
            out += self._merge(ids[order], us[order], ok[order])
            if self.lateness_s is not None:
                self._settle()
        return [np.concatenate(c) for c in zip(*out, strict=True)] if out else None

    def _merge(self, ids, us, ok):
        redo_before = None
        if self.decided is None and (self.first is None or us[0] < self.first):
            redo_before = None if self.first is None else self.first + int(self.delay) * 1_000_000
            self.first = int(us[0])
        self.newest = int(max(us[-1], us[-1] if self.newest is None else self.newest))
        starts, lasts, outs = self.starts, self.lasts, self.outs
        if not starts:
            starts, lasts, outs = [int(us[0])], [int(us[0])], [None]
        place = np.maximum(np.searchsorted(np.array(starts), us, side="right") - 1, 0)
        touched = set(place.tolist())
        self.starts, self.lasts, self.outs = [], [], []
        out, before, carry = [], self.base, self.base
        for k, start in enumerate(starts):
            old_out = outs[k]
            if k not in touched and carry == before and (redo_before is None or start >= redo_before):
                self._index(start, lasts[k], old_out)
                before = carry = old_out
                continue
            chunk = self.load(start) if old_out is not None else None
            out.append(self._chunk(start, chunk, *(a[place == k] for a in (ids, us, ok)), carry))
            before, carry = old_out, self.outs[-1]
        return out

    def _index(self, start, last, out):
        self.starts.append(start)
        self.lasts.append(last)
        self.outs.append(out)

    def _chunk(self, start, chunk, ids, us, ok, carry):
        """Put probes into a chunk, decide it, write it (in pieces if it is large); the probes to return."""
        n = len(ids)
        if chunk is not None:
            ids = np.concatenate([np.array(chunk[0], np.int64), ids])
            us = np.concatenate([np.array(chunk[1], np.int64), us])
            ok = np.concatenate([np.array(chunk[2], bool), ok])
            was = list(zip(chunk[3], chunk[4], strict=True)) + [None] * n
            self.remove(start)
        else:
            was = [None] * n
        order = np.lexsort((ids, us))
        ids, us, ok = ids[order], us[order], ok[order]
        end, shown, at = carry, np.zeros(len(ids), bool), 0
        counted_all, states_all = np.zeros(len(ids), bool), np.empty(len(ids), object)
        while at < len(ids):
            to = min(len(ids), at + self.chunk_probes) if len(ids) > 2 * self.chunk_probes else len(ids)
            to = int(np.searchsorted(us, us[to - 1], side="right"))  # equal times stay together
            counted, states, end = self._decide(us[at:to], ok[at:to], end)
            self.save(int(us[at]), (ids[at:to].tolist(), us[at:to].tolist(), ok[at:to].tolist(), counted.tolist(), states.tolist()))
            self._index(int(us[at]), int(us[to - 1]), end)
            counted_all[at:to], states_all[at:to] = counted, states
            at = to
        for i, j in enumerate(order.tolist()):
            shown[i] = was[j] is None or was[j] != (counted_all[i], states_all[i])
        # copies of a probe come back together, so they share a version
        edge = np.concatenate([[True], (ids[1:] != ids[:-1]) | (us[1:] != us[:-1])])
        group = np.cumsum(edge) - 1
        shown = (np.bincount(group, weights=shown) > 0)[group]
        return ids[shown], us[shown], ok[shown], counted_all[shown], states_all[shown]

    def _settle(self):
        """Probes older than the newest by more than the lateness leave the state."""
        cut = self.newest - int(self.lateness_s * 1_000_000)
        while self.starts and self.lasts[0] <= cut:
            self.remove(self.starts.pop(0))
            self.decided, self.base = self.lasts.pop(0), self.outs.pop(0)
        if self.starts and self.starts[0] <= cut:
            chunk = self.load(self.starts[0])
            times, ok = np.array(chunk[1], np.int64), np.array(chunk[2], bool)
            n = int(np.searchsorted(times, cut, side="right"))
            _, _, self.base = self._decide(times[:n], ok[:n], self.base)
            self.decided = int(times[n - 1])
            self.remove(self.starts[0])
            self.starts[0] = int(times[n])
            self.save(self.starts[0], tuple(c[n:] for c in chunk))


class HealthProcessor(StatefulProcessor):
    """State of one instance per key; settings as of ``Timeline``, and ``expire_ms``."""

    def __init__(self, expire_ms: int | None = None, **settings):
        self.expire_ms, self.settings = expire_ms, settings

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.index = handle.getValueState("index", INDEX_SCHEMA)
        self.chunks = handle.getMapState("probes", "start long", CHUNK_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        if new.empty:
            return
        timeline = Timeline(self.index.get(), lambda k: self.chunks.getValue((k,)),
                            lambda k, chunk: self.chunks.updateValue((k,), chunk),
                            lambda k: self.chunks.removeKey((k,)), **self.settings)
        ids = np.array([NO_ID if pd.isna(i) else int(i) for i in new["probe_id"]], dtype=np.int64)
        answered = new["ok"].fillna(False).astype(bool) & new["latency_s"].notna()
        ok = (answered & (new["latency_s"] <= float(timeline.timeout_s))).to_numpy(bool)
        timed = new["ts"].notna().to_numpy()
        us = new["ts"].to_numpy("datetime64[us]").astype(np.int64)
        found = timeline.add(ids[timed], us[timed], ok[timed])
        self.index.update(timeline.index())
        if found is not None:
            yield _frame(key, *found, timeline.version)
        if not timed.all():
            n = int((~timed).sum())
            yield _frame(key, ids[~timed], np.full(n, NO_ID), ok[~timed], np.zeros(n, bool), np.full(n, "UNKNOWN", object),
                         timeline.version)
        if self.expire_ms:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.expire_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.index.clear()
        self.chunks.clear()
        return iter([])

    def close(self) -> None:
        pass


def _frame(key, ids, us, ok, counted, states, version) -> pd.DataFrame:
    return pd.DataFrame({"probe_id": pd.array(ids, "Int64").copy() if (ids != NO_ID).all() else
                         pd.array([None if i == NO_ID else i for i in ids.tolist()], "Int64"),
                         "instance": pd.array([key[0]] * len(ids), "Int64"),
                         "ts": us.astype("datetime64[us]"),  # NO_ID is the missing time
                         "success": ok, "counted": counted, "state": states, "version": version})


def start_health_stream(probes: DataFrame, sink: str, checkpoint: str, available_now: bool = True,
                        timeout_s: float = HC["timeout_s"], initial_delay_s: int = HC["initial_delay_s"],
                        healthy_threshold: int = HC["healthy_threshold"],
                        unhealthy_threshold: int = HC["unhealthy_threshold"],
                        lateness_s: float | None = None, expire_after_s: float | None = None,
                        chunk_probes: int = CHUNK_PROBES):
    """Start the stream. This API needs the RocksDB state store, and a run over the available input must
    not wait for timers to fire (they fire in the next run that has input); the session's own settings
    are restored once the query has taken these."""
    spark = probes.sparkSession
    ship_package(spark)
    processor = HealthProcessor(
        expire_ms=int(expire_after_s * 1000) if expire_after_s else None, timeout_s=timeout_s,
        initial_delay_s=initial_delay_s, up=healthy_threshold, down=unhealthy_threshold, lateness_s=lateness_s,
        chunk_probes=chunk_probes)
    out = probes.groupBy("instance").transformWithStateInPandas(
        processor, OUTPUT_SCHEMA, "Append", "ProcessingTime" if expire_after_s else "None")
    w = out.writeStream.outputMode("append").format("parquet").option("path", sink) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    needs = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if available_now and expire_after_s:
        needs["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {k: spark.conf.get(k, None) for k in needs}
    for k, v in needs.items():
        spark.conf.set(k, v)
    try:
        return w.start()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def latest_states(log: DataFrame) -> DataFrame:
    """The states of every probe as its highest version has them. Rows that repeat a probe share
    its versions and all stay; every LATE row stays, as each is written once."""
    late = F.when(F.col("state") == "LATE", F.col("version"))
    order = Window.partitionBy("probe_id", "instance", "ts", late).orderBy(F.col("version").desc())
    return (log.withColumn("newest", F.rank().over(order)).filter((F.col("newest") == 1) | F.col("ts").isNull())
            .select("probe_id", "instance", "ts", "success", "counted", "state"))


def health_log(spark: SparkSession, events_dir: str, glob: str = "events*.parquet",
               max_files_per_trigger: int | None = None, **settings) -> DataFrame:
    """Run the probe stream over the available input and return its sink: every version of every
    probe. ``settings`` override the health-check thresholds (see ``start_health_stream``)."""
    root = scratch_path(spark, "streams", "health")
    sink, ckpt = f"{root}/sink", f"{root}/checkpoint"
    probes = probes_from_events(event_stream(spark, events_dir, glob, max_files_per_trigger))
    q = start_health_stream(probes, sink, ckpt, **settings)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(sink)


def health_stream(spark: SparkSession, events_dir: str, glob: str = "events*.parquet",
                  max_files_per_trigger: int | None = None, **settings) -> DataFrame:
    """The latest state of every probe of the available input."""
    return latest_states(health_log(spark, events_dir, glob, max_files_per_trigger, **settings))
