"""Usage report: hourly usage, daily statistics, tool calls and top questions for the administrators.

    python -m jobs.usage_report --events DIR --conversations DIR --output DIR [--config FILE]

A batch job over a window of days (`from` to `to`; null: from the first, to the last day there is). It leaves below the output

    hourly/day=D     bucket_start, operation, requests, successes, failures, tokens, duration
    calls/day=D      run, call, status, started_at, finished_at, tool_name, latency_ms: tool calls that started in the window
    daily/day=D      operation, requests, failures, tokens, avg_latency_ms, active_users, share, calls, calls_failed, avg_call_ms
    questions        query, n, turns: the users' most frequent questions

Days of the window without any usage are there too, with zeros. A run replaces the days of its window and no others, by dynamic
partition overwrite, so it may run again at any time: after late events came in, or after it stopped half-way. Events are a
log: a day gains events, but never loses all of them.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobs import common
from lodeframe.functions import text as T
from lodeframe.operators import metrics as M
from lodeframe.operators import state as W

LOG = logging.getLogger("jobs.usage_report")
DEFAULTS = {"from": None, "to": None, "failed": ["error"], "call_slots": 7, "top_questions": 20}
#: What an event is for a tool call that it belongs to; any other kind completes it.
CALL_EVENTS = {"view": "started", "error": "failed"}
HOURLY = "bucket_start timestamp_ntz, operation string, requests long, successes long, failures long, tokens long, duration double, day date"
CALLS = "run long, call long, status string, started_at timestamp_ntz, finished_at timestamp_ntz, tool_name string, latency_ms long, day date"
DAILY = "operation string, requests long, failures long, tokens long, avg_latency_ms long, active_users long, share double, calls long, calls_failed long, avg_call_ms long, day date"


def in_window(events: DataFrame, conf: dict) -> DataFrame:
    """Events of the window's days; the bounds are plain comparisons of the time, which reach the scan."""
    time = lambda day: F.lit(day).cast("timestamp_ntz")
    if conf["from"]:
        events = events.where(F.col("ts") >= time(conf["from"]))
    if conf["to"]:
        events = events.where(F.col("ts") < time(conf["to"]) + F.make_dt_interval(days=F.lit(1)))
    return events


def hourly(events: DataFrame, conf: dict) -> DataFrame:
    status = F.when(F.col("event_type").isin(conf["failed"]), "failed").otherwise("succeeded")
    rows = events.withColumnRenamed("event_type", "operation").withColumn("event_type", F.col("operation"))
    tokens = F.coalesce(F.get_json_object("props", "$.k").cast("long"), F.lit(0))
    return M.usage_hourly(rows, "ts", ["operation"], status, F.col("value"), tokens).withColumn("day", F.to_date("bucket_start"))


def tool_calls(events: DataFrame, slots: int) -> DataFrame:
    """A user's events as those of their tool calls, in so many slots; the number of an event gives its slot and its place."""
    kind = F.lit("completed")
    for name, what in CALL_EVENTS.items():
        kind = F.when(F.col("event_type") == name, what).otherwise(kind)
    log = events.select(F.col("user_id").alias("run"), (F.col("event_id") % slots).alias("call"), F.to_date("ts").alias("on"), F.col("event_id").alias("seq"), kind.alias("kind"), "ts", "event_type")
    # A slot is used anew every day: a call is what happens in it on one day.
    log = log.withColumn("run", F.struct("run", "on"))
    calls = W.fold_calls(log, "run", "call", "seq", "kind", "ts", "event_type")
    return calls.select("run.run", "call", "status", "started_at", "finished_at", "tool_name", "latency_ms", F.to_date("started_at").alias("day"))


def daily(hours: DataFrame, calls: DataFrame, events: DataFrame, conf: dict) -> DataFrame:
    """A row for each day of the window and each operation in it, zero-filled."""
    used = hours.groupBy("day", "operation").agg(*[F.sum(c).alias(c) for c in ("requests", "failures", "tokens", "duration")])
    people = events.groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("operation")).agg(F.count_distinct("user_id").alias("active_users"))
    called = calls.groupBy("day", F.col("tool_name").alias("operation")).agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("status") == "failed").alias("calls_failed"),
                                                                             F.avg("latency_ms").alias("call_ms"))
    # The window without a key runs over one row an operation.
    ends = used.groupBy("operation").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    span = ends.select("operation", (F.lit(conf["from"]).cast("date") if conf["from"] else F.min("first").over(Window.partitionBy())).alias("a"),
                       (F.lit(conf["to"]).cast("date") if conf["to"] else F.max("last").over(Window.partitionBy())).alias("b"))
    spine = span.select("operation", F.explode(F.sequence("a", "b")).alias("day"))
    rows = spine.join(used, ["day", "operation"], "left").join(people, ["day", "operation"], "left").join(called, ["day", "operation"], "left")
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    per_day = F.sum(F.coalesce("requests", F.lit(0))).over(Window.partitionBy("day"))
    mean = F.when(F.col("requests") > 0, T.rounded_long(F.round("duration", 4) / F.col("requests")))
    return rows.select("operation", none("requests"), none("failures"), none("tokens"), F.coalesce(mean, F.lit(0)).cast("long").alias("avg_latency_ms"), none("active_users"),
                       T.share_percent(F.coalesce("requests", F.lit(0)), per_day).alias("share"), none("calls"), none("calls_failed"),
                       F.coalesce(T.rounded_long(F.col("call_ms")), F.lit(0)).cast("long").alias("avg_call_ms"), "day")


def questions(conversations: DataFrame, limit: int) -> DataFrame:
    asked = conversations.where("role = 'user' AND text IS NOT NULL").select(F.col("text").alias("query"), F.col("turn"))
    return M.top_groups(asked, "query", F.lit(0), F.col("turn"), limit).select("query", "n", F.col("last_at").alias("last_turn"))


def run(spark: SparkSession, events: str, conversations: str, output: str, config: dict | None = None) -> dict:
    """Writes the report of the window and returns how many rows each table of it got."""
    conf = common.settings(config, DEFAULTS)
    log = in_window(spark.read.parquet(events), conf)
    LOG.info("read %d events of %s, days %s to %s", log.count(), events, conf["from"] or "first", conf["to"] or "last")

    def write(rows: DataFrame, name: str, schema: str) -> DataFrame:
        """Replaces the days that rows has; what was written is read back, not computed again."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{output}/{name}")
        return in_days(spark.read.schema(schema).parquet(f"{output}/{name}"), conf)

    hours = write(hourly(log, conf), "hourly", HOURLY)
    calls = write(tool_calls(log, conf["call_slots"]), "calls", CALLS)
    days = write(daily(hours, calls, log, conf), "daily", DAILY)
    questions(spark.read.parquet(conversations), conf["top_questions"]).write.mode("overwrite").parquet(f"{output}/questions")
    wrote = {"hourly": hours.count(), "calls": calls.count(), "daily": days.count()}
    LOG.info("wrote %s to %s", ", ".join(f"{n} rows of {name}" for name, n in wrote.items()), output)
    return wrote


def in_days(rows: DataFrame, conf: dict) -> DataFrame:
    """Rows of the window's partitions."""
    if conf["from"]:
        rows = rows.where(F.col("day") >= F.lit(conf["from"]).cast("date"))
    return rows.where(F.col("day") <= F.lit(conf["to"]).cast("date")) if conf["to"] else rows


if __name__ == "__main__":
    raise SystemExit(common.main(run, __doc__.split("\n")[0], {"events": "the events, as Parquet", "conversations": "the conversations, as Parquet", "output": "folder of the report"},
                                 __file__.removesuffix(".py") + ".json"))
