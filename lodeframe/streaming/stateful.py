"""Streams that keep state a key: tool calls, sequence numbers, replay with an end of life, leases.

Each is a processor of `transformWithState` over a state store on disk. Times are microseconds in state, and only event time
decides, so that a stream that starts again, or a log that is cut into other batches, gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import StructType

from ..functions.text import rounded_long
from ..operators.state import CALL_KINDS, LEASE_SECONDS

_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB, which transformWithState asks for."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before else spark.conf.unset(_STORE)


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _time(micros: str) -> Column:
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def call_rows(events: DataFrame, run: str, call: str, seq: str, kind: str, ts: str, name: str, iteration: str | None = None) -> DataFrame:
    """A stream of tool events as a stream of their calls' rows: run, call, iteration_no, tool_name, status, started_at, finished_at,
    latency_ms. A batch gives each call that it changes once; the newest row of a call counts (`newest`).

    Whatever order the events come in, the first by number gives iteration, name and start, the last one the status, the last end the end.
    Only an end behind the first event has a latency. Repeated events change nothing. Spark's own aggregation keeps the state.
    """
    counted = F.col(kind).isin(*CALL_KINDS) & (F.coalesce(F.col(call).cast("string"), F.lit("")) != "")
    iteration_no = F.greatest(F.coalesce(F.col(iteration).cast("int"), F.lit(0)), F.lit(1)) if iteration else F.lit(1)
    rows = events.where(counted).select(F.col(run).alias("run"), F.col(call).alias("call"), F.col(seq).cast("long").alias("seq"), F.col(kind).alias("kind"),
                                        _micros(F.col(ts)).alias("at"), F.col(name).cast("string").alias("tool_name"), iteration_no.alias("iteration_no"))
    ends = F.col("kind") != "started"
    folded = rows.groupBy("run", "call").agg(F.min_by(F.struct("iteration_no", "tool_name", "at"), "seq").alias("f"), F.max_by("kind", "seq").alias("kind"),
                                             F.max_by("at", F.when(ends, F.col("seq"))).alias("finished"), F.min("seq").alias("first"), F.max(F.when(ends, F.col("seq"))).alias("end"))
    folded = folded.select("run", "call", "f.iteration_no", "f.tool_name", F.when(F.col("kind") == "started", "running").otherwise(F.col("kind")).alias("status"),
                           F.col("f.at").alias("started"), "finished", F.coalesce(F.col("end") > F.col("first"), F.lit(False)).alias("late"))
    latency = F.when(F.col("late"), rounded_long((F.col("finished") - F.col("started")) / 1000)).alias("latency_ms")
    return folded.select("run", "call", "iteration_no", "tool_name", "status", _time("started").alias("started_at"), _time("finished").alias("finished_at"), latency)


def newest(rows: DataFrame, *keys: str, number: str = "batch") -> DataFrame:
    """The row of each key that the last batch wrote."""
    rest = [c for c in rows.columns if c not in (*keys, number)]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), number).alias("r")).select(*keys, "r.*")


class Stamper(StatefulProcessor):
    """Numbers a run's rows from 1 on; the run's last number is all that is kept."""

    def __init__(self, order: list[str], seq: str) -> None:
        self.order, self.seq = order, seq

    def init(self, handle) -> None:
        self.top = handle.getValueState("top", "n long")

    def handleInputRows(self, key, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        n = self.top.get()[0] if self.top.exists() else 0
        for r in sorted(rows, key=lambda r: [(r[c] is not None, r[c]) for c in self.order]):
            n += 1
            yield Row(**r.asDict(), **{self.seq: n})
        self.top.update((n,))

    def close(self) -> None:
        pass


def stamped(log: DataFrame, run: str, order: list[str], seq: str = "seq") -> DataFrame:
    """The stream with each row's place in its run, from 1 on in the order of arrival, and by the order columns within a batch.

    No earlier output is read. The rows that a run has in one batch are sorted in memory: bound a batch by the source's
    maxFilesPerTrigger or maxBytesPerTrigger where runs are long.
    """
    schema = StructType(list(log.schema.fields)).add(seq, "long")
    return log.groupBy(run).transformWithState(Stamper(order, seq), schema, "Append", "None")


class Replay(StatefulProcessor):
    """A run's events until their end of life, and the answers to those who come back with a cursor.

    A run's events are read once a batch, however many ask for them, and one timer, for the earliest end of life, clears all that are over.
    """

    def __init__(self, ttl: int) -> None:
        self.ttl = ttl

    def init(self, handle) -> None:
        self.handle = handle
        self.events = handle.getMapState("events", "seq long", "id string, at long")
        self.due = handle.getValueState("due", "ms long")

    def wake(self, old: int | None, earliest: int) -> None:
        new = (earliest + self.ttl) // 1000 + 1
        if old is None or new < old:
            if old is not None:
                self.handle.deleteTimer(old)
            self.due.update((new,))
            self.handle.registerTimer(new)

    def handleInputRows(self, key, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        there, earliest = None, None
        for r in sorted(rows, key=lambda r: (r.at, r.seq)):
            if r.after is None:
                self.events.updateValue((r.seq,), (r.id, r.at))
                earliest = r.at if earliest is None else earliest
                if there is not None:
                    there[r.seq] = (r.id, r.at)
                continue
            if there is None:
                there = {k[0]: tuple(v) for k, v in self.events.iterator()}
            for seq, (own, at) in sorted(there.items()):
                if seq > r.after and at + self.ttl > r.at:
                    yield Row(run=key[0], request=r.id, seq=seq, id=own)
        if earliest is not None:
            self.wake(self.due.get()[0] if self.due.exists() else None, earliest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, living = timerValues.getCurrentWatermarkInMs() * 1000, []
        for seq, (_, at) in [(k, tuple(v)) for k, v in self.events.iterator()]:
            if at + self.ttl < now:
                self.events.removeKey(seq)
            else:
                living.append(at)
        self.due.clear()
        if living:
            self.wake(None, min(living))
        return iter(())

    def close(self) -> None:
        pass


def replayed(log: DataFrame, run: str, seq: str, row_id: str, ts: str, after: str, ttl_seconds: int = 24 * 3600, lateness: str = "0 seconds") -> DataFrame:
    """Answers run, request, seq, id to a stream of events and requests, in the order of their times within a batch.

    A row with a value in `after` is a request: it gets the run's earlier events with a larger number, as long as they live. An
    event that has outlived ttl_seconds behind the watermark leaves the state. Rows older than the watermark by then are late and dropped.
    """
    rows = log.select(F.col(run).alias("run"), F.col(seq).cast("long").alias("seq"), F.col(row_id).cast("string").alias("id"),
                      F.col(ts).cast("timestamp").alias("ts"), _micros(F.col(ts)).alias("at"), F.col(after).cast("long").alias("after")).withWatermark("ts", lateness)
    kind = rows.schema["run"].dataType.simpleString()
    return rows.groupBy("run").transformWithState(Replay(ttl_seconds * 1_000_000), f"run {kind}, request string, seq long, id string", "Append", "EventTime")


class Lease(StatefulProcessor):
    """The end of a running job's lease; each beat moves it, an end of the job lifts it, and where time passes it the job is stale once."""

    def __init__(self, lease: int, ends: tuple[str, ...]) -> None:
        self.lease, self.ends = lease, ends

    def init(self, handle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "at long")

    def handleInputRows(self, key, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        due = old = self.due.get()[0] if self.due.exists() else None
        for r in sorted(rows, key=lambda r: (r.at, r.seq)):
            if due is not None and due < r.at:
                yield Row(job=key[0], due=due)
            due = None if r.kind in self.ends else r.at + self.lease
        if due == old:
            return
        if old is not None:
            self.handle.deleteTimer(old // 1000 + 1)
        if due is None:
            self.due.clear()
        else:
            self.due.update((due,))
            self.handle.registerTimer(due // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.due.exists():
            due = self.due.get()[0]
            if due // 1000 < expiredTimerInfo.getExpiryTimeInMs():
                self.due.clear()
                yield Row(job=key[0], due=due)

    def close(self) -> None:
        pass


def stale_leases(beats: DataFrame, job: str, seq: str, kind: str, ts: str, ends: tuple[str, ...], lease_seconds: int = LEASE_SECONDS,
                 lateness: str = "0 seconds") -> DataFrame:
    """job, stale_at of every lease that ends without a beat: a stream of a job's rows, each of which is a beat or, by its kind, an end.

    A lease is over where a later row of the job or the watermark is behind its end (a millisecond is the watermark's grain).
    """
    rows = beats.select(F.col(job).alias("job"), F.col(seq).cast("long").alias("seq"), F.col(kind).alias("kind"), F.col(ts).cast("timestamp").alias("ts"),
                        _micros(F.col(ts)).alias("at")).withWatermark("ts", lateness)
    found = rows.groupBy("job").transformWithState(Lease(lease_seconds * 1_000_000, ends), f"job {rows.schema['job'].dataType.simpleString()}, due long", "Append", "EventTime")
    return found.select("job", _time("due").alias("stale_at"))
