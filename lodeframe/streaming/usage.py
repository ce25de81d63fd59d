"""Streams: hourly usage, the fold of event logs, and idempotent ingestion.

Every stream is a file (or Kafka) source, stateful aggregation, and a foreachBatch sink whose effect is a
function of the batch number, so a batch that runs again replaces what it wrote.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def replace_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink: each batch owns the partition with its number, and replaces it when it runs again."""
    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
    return sink


def split_dead_letters(path: str, good: Callable[[DataFrame], DataFrame], permanent) -> Callable[[DataFrame, int], None]:
    """Rows with a permanent error are acknowledged into dead letters, the others are handled."""
    def sink(batch: DataFrame, number: int) -> None:
        batch.where(permanent).write.mode("overwrite").parquet(f"{path}/dead/batch={number}")
        good(batch.where(~permanent)).write.mode("overwrite").parquet(f"{path}/done/batch={number}")
    return sink


def add_usage(path: str, keys: list[str], sums: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that adds each batch's rollup to a table: the parts of a batch are a partition of its own, so a
    batch that runs again replaces what it added; `added` sums the parts."""
    def sink(batch: DataFrame, number: int) -> None:
        batch.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]).write.mode("overwrite").parquet(f"{path}/batch={number}")
    return sink


def added(parts: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def hourly_parts(events: DataFrame) -> DataFrame:
    """Each event as a rollup of one: what a stream without state hands to `add_usage`, however late the event is."""
    return events.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("bucket_start"), F.col("event_type").alias("operation"),
                         F.lit(1).cast("long").alias("requests"), (F.col("event_type") == "error").cast("long").alias("failures"), F.col("value").alias("duration"))


class BatchMetrics(StreamingQueryListener):
    """Metrics of a stream's batches, one row a batch however often it is reported: `observe` the stream under the listener's name,
    add the listener to the session, and ask for the `table` once the queries are over."""

    def __init__(self, name: str, **metrics: Column) -> None:
        self.name, self.metrics = name, metrics
        self._rows: dict[tuple[str, int], dict] = {}
        self._started, self._over = set(), set()
        self._change = threading.Condition()

    def observe(self, df: DataFrame) -> DataFrame:
        return df.observe(self.name, *[c.alias(k) for k, c in self.metrics.items()])

    def onQueryStarted(self, event) -> None:
        with self._change:
            self._started.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is not None and event.progress.numInputRows:
            with self._change:
                self._rows[str(event.progress.id), event.progress.batchId] = found.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._over.add(str(event.runId))
            self._change.notify_all()

    def wait(self, seconds: float = 60) -> None:
        """Until every query that this listener saw start has ended, and its reports are in: they arrive a little later."""
        with self._change:
            if not self._change.wait_for(lambda: self._started <= self._over, seconds):
                raise TimeoutError("a query has not ended")

    def table(self, spark: SparkSession, schema: str) -> DataFrame:
        """batch and the metrics: a row a batch, which is what the driver holds."""
        with self._change:
            rows = [(batch, *[values[k] for k in self.metrics]) for (_, batch), values in sorted(self._rows.items())]
        return spark.createDataFrame(rows, f"batch long, {schema}")


def relay_lines(lines: DataFrame, run: str, seq: str, line: str) -> DataFrame:
    """Every line of a captured token stream up to its first bad one: run, seq, kind ('skip', 'data', 'done', 'bad'), usage, payload.

    Blank lines and comments are skipped. A line that is not `data:`, or holds no valid chunk (`sanitize.clean_chunk`), is bad and ends
    its run; an end marker does not, what follows is read too. payload: what may be handed on of a data line.
    """
    from pyspark.sql import Window

    from ..functions.sanitize import clean_chunk
    from ..functions.text import unicode_trim

    text = unicode_trim(F.coalesce(F.col(line), F.lit("")))
    data = unicode_trim(F.regexp_replace(text, "^data:", ""))
    rows = lines.select(run, seq, text.alias("__text"), data.alias("__data"), F.when(text.startswith("data:") & (data != "[DONE]"), clean_chunk(data)).alias("payload"))
    text, data = F.col("__text"), F.col("__data")
    kind = F.when((text == "") | text.startswith(":"), "skip").when(~text.startswith("data:"), "bad").when(data == "[DONE]", "done") \
        .when(F.col("payload").isNotNull(), "data").otherwise("bad")
    rows = rows.select(run, seq, kind.alias("kind"), F.get_json_object("payload", "$.usage.total_tokens").cast("long").alias("usage"), "payload")
    before = Window.partitionBy(run).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.max(F.col("kind") == "bad").over(before), F.lit(False))
    return rows.withColumn("__over", ended).where("NOT __over").drop("__over")


def relay_summary(lines: DataFrame, run: str, seq: str, line: str) -> DataFrame:
    """A row a run, whatever its lines hold: done (it reached its marker), total_tokens (the last usage), status, error.

    A run succeeds with a marker and without a bad line, before or behind it; it fails with `dependency_error` otherwise.
    """
    rows = relay_lines(lines, run, seq, line)
    data = (F.col("kind") == "data") & F.col("usage").isNotNull()
    out = rows.groupBy(run).agg(F.bool_or(F.col("kind") == "done").alias("done"), F.bool_or(F.col("kind") == "bad").alias("bad"),
                                F.max_by(F.when(data, F.col("usage")), F.when(data, F.col(seq))).alias("total_tokens"))
    good = F.col("done") & ~F.col("bad")
    return out.withColumn("status", F.when(good, "succeeded").otherwise("failed")).withColumn("error", F.when(~good, "dependency_error")).drop("bad")
