"""Reports over usage data. Days and windows are parameters; nothing reads the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import intent_label, rounded_long, share_percent


def days(spark, last_day: str, count: int) -> DataFrame:
    """A row a day of the `count` days that end at last_day."""
    end = F.to_date(F.lit(last_day))
    return spark.range(1).select(F.explode(F.sequence(F.date_sub(end, count - 1), end)).alias("day"))


def daily_trend(rows: DataFrame, ts: str, last_day: str, count: int = 30) -> DataFrame:
    """Zero-filled counts a day. The range join on the calendar is an equality on the day."""
    counts = rows.groupBy(F.to_date(ts).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return days(rows.sparkSession, last_day, count).join(counts, F.col("day") == F.col("d"), "left") \
        .select("day", F.coalesce("n", F.lit(0)).cast("long").alias("n")).orderBy("day")


def since(ts: Column, as_of: Column, days: int, default: int = 7) -> Column:
    """In the last `days` days before as_of; 0 or less: the default."""
    return ts >= as_of - F.make_dt_interval(days=F.lit(days if days > 0 else default))


def overview(messages: DataFrame, conversations: DataFrame, runs: DataFrame, as_of: str, window_days: int = 1) -> DataFrame:
    """One row: total_qa, today_qa, conversations, avg_latency_ms, active_users_today. One pass over each table.

    messages: role, created_at; conversations: user_id, created_at, deleted_at; runs: started_at, latency_ms.
    """
    now, today = F.lit(as_of).cast("timestamp_ntz"), F.lit(as_of[:10]).cast("timestamp_ntz")
    asked = F.col("role") == "user"
    said = messages.agg(F.count_if(asked).alias("total_qa"), F.count_if(asked & (F.col("created_at") >= today)).alias("today_qa"))
    talked = conversations.agg(F.count_if(F.col("deleted_at").isNull()).alias("conversations"),
                               F.count_distinct(F.when(F.col("created_at") >= today, F.col("user_id"))).alias("active_users_today"))
    ran = runs.where(since(F.col("started_at"), now, window_days, 1)).agg(F.coalesce(rounded_long(F.avg("latency_ms")), F.lit(0)).cast("long").alias("avg_latency_ms"))
    return said.crossJoin(talked).crossJoin(ran)  # one row each


def top_questions(messages: DataFrame, blocks: DataFrame, runs: DataFrame, as_of: str, window_days: int = 7, limit: int = 10) -> DataFrame:
    """query, n, avg_latency_ms, last_asked_at of the users' most frequent first blocks in the window.

    messages: id, role, created_at; blocks: message_id, block_order, content; runs: user_message_id, latency_ms.
    """
    recent = messages.where((F.col("role") == "user") & since(F.col("created_at"), F.lit(as_of).cast("timestamp_ntz"), window_days)).select("id", "created_at")
    rows = recent.join(blocks.where("block_order = 0").select("message_id", F.col("content").alias("query")), F.col("id") == F.col("message_id")) \
        .join(runs.select("user_message_id", "latency_ms"), F.col("id") == F.col("user_message_id"), "left")
    return top_groups(rows, "query", F.col("latency_ms"), F.col("created_at"), limit if limit > 0 else 10) \
        .withColumnsRenamed({"avg_latency": "avg_latency_ms", "last_at": "last_asked_at"})


def report_statistics(reports: DataFrame, jobs: DataFrame, last_day: str, days_: int) -> DataFrame:
    """day, kind, created, generated, failed, exported in the days that end at last_day; deleted reports don't count.

    reports: id, kind, status, created_at, generated_at, exported_at, deleted_at; jobs: report_id, status, finished_at, created_at.
    A report with the status 'deleted' still counts as generated and exported, as long as it has no deletion time.
    """
    end = F.to_date(F.lit(last_day))
    inside = lambda c: F.to_date(c).between(F.date_sub(end, days_ - 1), end)
    live = reports.where("deleted_at IS NULL")
    there = live.where("status <> 'deleted'")
    event = lambda df, c: df.where(inside(F.col(c))).select(F.to_date(c).alias("day"), "kind")
    ended = jobs.where("status = 'failed'").select("report_id", F.coalesce("finished_at", "created_at").alias("at")) \
        .join(there.select(F.col("id").alias("report_id"), "kind"), "report_id")
    return daily_statistics([("created", event(there, "created_at")), ("generated", event(live, "generated_at")), ("failed", event(ended, "at")),
                             ("exported", event(live, "exported_at"))])


def accumulate_tokens(usage: DataFrame, by: str) -> DataFrame:
    """Token sums a run over its iterations; a total of 0 counts as the sum of its parts."""
    parts = [F.coalesce(c, F.lit(0)) for c in ("prompt_tokens", "completion_tokens", "reasoning_tokens")]
    total = F.coalesce(F.nullif(F.col("total_tokens"), F.lit(0)), parts[0] + parts[1] + parts[2])
    return usage.groupBy(by).agg(*[F.sum(p).alias(n) for p, n in zip(parts, ("prompt_tokens", "completion_tokens", "reasoning_tokens"))], F.sum(total).alias("total_tokens"))


def sum_or(rows: DataFrame, count: str, fallback: Column, name: str) -> DataFrame:
    """The sum of a count that older rows lack; those count by the fallback. Nothing sums to 0."""
    return rows.agg(F.coalesce(F.sum(F.coalesce(F.col(count), fallback)), F.lit(0)).cast("long").alias(name))


def top_groups(rows: DataFrame, key: str, latency: Column, at: Column, limit: int) -> DataFrame:
    """Most frequent keys: count, average latency (0 if none), last time."""
    grouped = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.coalesce(rounded_long(F.avg(latency)), F.lit(0)).cast("long").alias("avg_latency"),
                                    F.max(at).alias("last_at"))
    return grouped.orderBy(F.desc("n"), F.desc("last_at"), F.asc(key)).limit(limit)


def share_of_total(rows: DataFrame, key: Column, name: str) -> DataFrame:
    """Count and share of each key; null is 'unknown'. The window runs over one row a key."""
    counts = rows.groupBy(F.coalesce(key, F.lit("unknown")).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", share_percent(F.col("n"), F.sum("n").over(Window.partitionBy())))


def intents(messages: DataFrame, as_of: str, window_days: int = 7) -> DataFrame:
    """intent, label, n, share of the users' messages (role, created_at, intent) in the days before as_of, most frequent first."""
    asked = messages.where((F.col("role") == "user") & since(F.col("created_at"), F.lit(as_of).cast("timestamp_ntz"), window_days))
    return share_of_total(asked, F.col("intent"), "intent").withColumn("label", intent_label(F.col("intent"))).select("intent", "label", "n", "share").orderBy(F.desc("n"), "intent")


def daily_statistics(tagged: list[tuple[str, DataFrame]], day: str = "day", kind: str = "kind") -> DataFrame:
    """Counts of several event tables by day and kind, one column an event."""
    rows = None
    for name, df in tagged:
        part = df.select(F.col(day), F.col(kind), F.lit(name).alias("tag"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(day, kind).agg(*[F.count_if(F.col("tag") == name).alias(name) for name, _ in tagged])


def usage_hourly(rows: DataFrame, ts: str, keys: list[str], status: Column, duration: Column, tokens: Column | None = None) -> DataFrame:
    """Requests, successes, failures, tokens and duration by UTC hour and keys."""
    ok = F.coalesce(status == "succeeded", F.lit(False))
    hour = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")
    return rows.groupBy(hour.alias("bucket_start"), *keys).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(ok).alias("successes"), F.count_if(~ok).alias("failures"),
        F.coalesce(F.sum(tokens if tokens is not None else F.lit(0)), F.lit(0)).cast("long").alias("tokens"), F.sum(duration).alias("duration"))


def merge_usage(old: DataFrame, new: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Additive upsert: counters add up."""
    return old.unionByName(new).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
