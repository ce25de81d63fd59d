"""What a step may hold or call for each row, where a table grows."""

from lodeframe.streaming import stateful


def test_tool_calls_are_folded_by_spark(spark, tmp_path):
    """No Python is called for a tool event: the fold is an aggregation with Spark's own state."""
    rows = spark.createDataFrame([(1, "r", "c", "started", 5, "A", 1)], "n long, run string, call string, kind string, secs long, name string, iteration int")
    rows.selectExpr("*", "timestamp_seconds(secs) as ts").write.parquet(f"{tmp_path}/in")
    log = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
    plan = stateful.call_rows(log, "run", "call", "n", "kind", "ts", "name", "iteration")._jdf.queryExecution().analyzed().toString()
    assert "Aggregate [run" in plan and "TransformWithState" not in plan


def test_chunks_are_not_sorted(spark):
    """Neither the kept nor the new chunks are sorted to meet the documents that are done."""
    from conftest import SF
    from lodeframe.plans.queries import QUERIES

    plan = QUERIES["complete_chunks"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 1 and all("shuffle_hash" in line for line in plan.splitlines() if "Join LeftAnti" in line)
    assert all("shuffle_hash" in line for line in plan.splitlines() if "Join LeftSemi" in line and "document_id" in line)
