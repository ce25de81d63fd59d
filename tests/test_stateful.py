"""Streams with state: any cut of the log into batches, and a start from the checkpoint after each, give the batch's rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from lodeframe.operators import state as W
from lodeframe.streaming import stateful, usage

LOG = "n long, run string, call string, kind string, secs long, name string, iteration int, after long"


def run_in_parts(spark, tmp_path, parts, mode, stream, schema=LOG):
    """The rows that the stream writes when the parts come one by one, each to a stream that starts anew."""
    folder, rows = str(tmp_path), []
    with stateful.state_on_disk(spark):
        for number, part in enumerate(parts):
            df = spark.createDataFrame(part, schema).withColumn("ts", F.timestamp_seconds("secs").cast("timestamp_ntz"))
            df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
            source = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
            stream(source).writeStream.option("checkpointLocation", f"{folder}/log").outputMode(mode).foreachBatch(usage.replace_batches(f"{folder}/out")) \
                .trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def cut(rows, sizes):
    out, at = [], 0
    for size in sizes:
        out.append(rows[at:at + size])
        at += size
    return [*out, rows[at:]]


def tool_log(seed, n):
    draw = random.Random(seed)
    kinds = ("started", "completed", "failed", "iteration")
    return [(i, draw.choice("ab"), draw.choice(["x", "y", "", None]), draw.choice(kinds), i * 7, draw.choice(["s", "t", None]), draw.randint(0, 2), None) for i in range(n)]


@pytest.mark.parametrize("sizes, shuffled", [([], False), ([0, 1, 20], False), ([10], True)])
def test_tool_calls(spark, tmp_path, sizes, shuffled):
    """Events out of order give the same calls, since their number decides."""
    rows = tool_log(3, 40)
    batch = W.fold_calls(spark.createDataFrame(rows, LOG).withColumn("ts", F.timestamp_seconds("secs").cast("timestamp_ntz")), "run", "call", "n", "kind", "ts", "name", "iteration")
    if shuffled:
        random.Random(1).shuffle(rows)
    out = run_in_parts(spark, tmp_path, cut(rows, sizes), "update", lambda s: stateful.call_rows(s, "run", "call", "n", "kind", "ts", "name", "iteration"))
    names = ["run", "call", "status", "started_at", "finished_at", "tool_name", "iteration_no", "latency_ms"]
    got = stateful.newest(out, "run", "call").select(names)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.select(names).collect()))


def test_tool_call_rules(spark):
    """An end before a start: the row keeps the first event's start and name and the end; only an update has a latency."""
    rows = [(1, "r", "c", "completed", 1, "A", 0, None), (2, "r", "c", "started", 5, "B", 2, None), (3, "r", "d", "failed", 9, "A", 3, None),
            (4, "r", "e", "started", 10, "A", 1, None), (5, "r", "e", "failed", 12, "A", 1, None), (6, "r", "e", "completed", 15, None, 1, None), (7, "r", " ", "started", 1, "A", 1, None),
            (8, "r", "", "started", 1, "A", 1, None), (9, "r", None, "started", 1, "A", 1, None)]
    got = {r["call"]: r for r in W.fold_calls(spark.createDataFrame(rows, LOG), "run", "call", "n", "kind", "secs", "name", "iteration").withColumn("latency_ms", F.lit(None)).collect()}
    assert set(got) == {"c", "d", "e", " "}
    assert (got["c"]["status"], got["c"]["started_at"], got["c"]["finished_at"], got["c"]["tool_name"], got["c"]["iteration_no"]) == ("running", 1, 1, "A", 1)
    assert (got["e"]["status"], got["e"]["finished_at"], got["d"]["iteration_no"]) == ("completed", 15, 3)
    timed = spark.createDataFrame(rows, LOG).withColumn("ts", F.timestamp_seconds("secs"))
    late = {r["call"]: r["latency_ms"] for r in W.fold_calls(timed, "run", "call", "n", "kind", "ts").collect()}
    assert late == {"c": None, "d": None, "e": 5000, " ": None}


@pytest.mark.parametrize("sizes", [[], [0, 3, 1]])
def test_sequence(spark, tmp_path, sizes):
    rows = [(i, "ab"[i % 3 // 2], "c", "k", 100 + i // 2, None, 0, None) for i in range(15)]
    out = run_in_parts(spark, tmp_path, cut(rows, sizes), "append", lambda s: stateful.stamped(s, "run", ["ts", "n"]))
    want, top = [], {}
    for r in rows:
        top[r[1]] = top.get(r[1], 0) + 1
        want.append((r[0], top[r[1]], datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=r[4])))
    assert sorted((r["n"], r["seq"], r["ts"]) for r in out.collect()) == want


@pytest.mark.parametrize("sizes", [[], [5, 0, 1, 20]])
def test_replay(spark, tmp_path, sizes):
    """Requests with cursors against the batch answer, with events that die between them."""
    draw, rows, secs = random.Random(4), [], 0
    for i in range(40):
        secs += draw.choice([1, 20, 70])
        rows.append((i, draw.choice("ab"), None, "k", secs, None, 0, draw.randint(-1, i) if i % 3 == 2 else None))
    want = sorted((q[1], str(q[0]), e[0], str(e[0])) for q in rows if q[7] is not None for e in rows if e[7] is None and e[1] == q[1] and e[0] < q[0] and e[0] > q[7] and e[4] + 100 > q[4])
    out = run_in_parts(spark, tmp_path, cut(rows, sizes), "append", lambda s: stateful.replayed(s, "run", "n", "n", "ts", "after", ttl_seconds=100))
    assert sorted(map(tuple, out.select("run", "request", "seq", "id").collect())) == want and want
    kept = spark.read.format("statestore").option("stateVarName", "events").load(f"{tmp_path}/log")
    alive = {r[0] for r in rows if r[7] is None and r[4] + 100 >= rows[-1][4]}
    assert {r["key"]["seq"] for r in kept.selectExpr("user_map_key as key").collect()} <= alive | {r[0] for r in rows if r[4] == rows[-1][4]}


@pytest.mark.parametrize("sizes", [[], [4, 0, 1, 9]])
def test_leases(spark, tmp_path, sizes):
    draw, rows, secs = random.Random(6), [], 0
    for i in range(40):
        secs += draw.choice([5, 30, 50])
        rows.append((i, draw.choice("abc"), None, draw.choice(["beat", "beat", "done"]), secs, None, 0, None))
    want = []
    for job in "abc":
        own = [r for r in rows if r[1] == job]
        for r, later in zip(own, [x[4] for x in own[1:]] + [rows[-1][4]]):
            if r[3] == "beat" and r[4] + 60 < later:
                want.append((job, datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=r[4] + 60)))
    out = run_in_parts(spark, tmp_path, cut(rows, sizes), "append", lambda s: stateful.stale_leases(s, "run", "n", "kind", "ts", ("done",), lease_seconds=60))
    assert sorted(map(tuple, out.select("job", "stale_at").collect())) == sorted(want) and want


def test_the_store_is_only_set_inside(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    with pytest.raises(KeyError), stateful.state_on_disk(spark):
        raise KeyError
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_replay_reads_state_once():
    """A batch reads a run's events once and keeps one timer, however many events and requests it has."""
    from collections import namedtuple

    class Handle:
        def __init__(self):
            self.map, self.value, self.timers, self.reads = {}, [], set(), 0
            self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

        def getMapState(self, *_):
            self.updateValue, self.removeKey = self.map.__setitem__, lambda k: self.map.pop(k)
            return self

        def getValueState(self, *_):
            state = type("Value", (), {})()
            state.exists, state.get = lambda: bool(self.value), lambda: self.value[-1]
            state.update, state.clear = self.value.append, self.value.clear
            return state

        def iterator(self):
            self.reads += 1
            return iter(list(self.map.items()))

    row, times = namedtuple("R", "seq id at after"), type("T", (), {"getCurrentWatermarkInMs": lambda self: 7})()
    handle, replay = Handle(), stateful.Replay(2000)
    replay.init(handle)
    rows = [row(i, str(i), 1000 * i, i - 3 if i % 3 == 2 else None) for i in range(30)]
    found = [(r.request, r.seq) for r in replay.handleInputRows(("a",), rows[::-1], None)]
    assert found == [(str(q.seq), e.seq) for q in rows if q.after is not None for e in rows if e.after is None and q.after < e.seq < q.seq and e.at + 2000 > q.at]
    assert handle.reads == 1 and handle.timers == {3}
    list(replay.handleExpiredTimer(("a",), times, None))
    assert {k[0] for k in handle.map} == {r.seq for r in rows if r.after is None and r.at + 2000 >= 7000} and handle.value[-1] == (9,)
