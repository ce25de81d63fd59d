"""The jobs: two runs over growing input, on copies; their queries against their SQL."""

import json
import logging
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF
from jobs import common, ingest_documents, usage_report
from jobs.queries import ORACLES, QUERIES
from test_queries import table

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    got, want = QUERIES[name](spark, SF), con.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got.columns, [tuple(r) for r in got.collect()]) == table(want.columns, want.fetchall())


def write(spark, rows, folder):
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.mode("append").parquet(folder)


def state(spark, base):
    docs = {r["document_id"]: (r["status"], r["error_code"], r["n_chunks"], r["batch"]) for r in ingest_documents.documents_now(spark, base).collect()}
    chunks = sorted((r["document_id"], r["kb"], r["chunk_index"], r["content"]) for r in ingest_documents.chunks_now(spark, base).collect())
    return docs, chunks


def test_ingestion_takes_only_what_is_new(spark, tmp_path, caplog):
    caplog.set_level(logging.INFO)
    files, base, log = (f"{tmp_path}/{x}" for x in ("in", "base", "log"))
    conf = {"strategies": {"b": {"size": 64, "overlap": 0}}, "most_chars": 1000}
    write(spark, [(1, "# One\nfirst text", "a"), (2, "w " * 64, "b"), (3, "  ", "a"), (None, "nobody's", "a"), (4, "x" * 1001, None), (5, None, None)], files)
    assert ingest_documents.run(spark, files, base, log, conf) == {"batches": 1, "rows": 6}
    docs, chunks = state(spark, base)
    assert docs == {1: ("ready", None, 1, 0), 2: ("ready", None, 2, 0), 3: ("failed", "empty_text", 0, 0), 4: ("failed", "too_large", 0, 0), 5: ("failed", "empty_text", 0, 0)}
    assert [c[:3] for c in chunks] == [(1, "a", 0), (2, "b", 0), (2, "b", 1)]
    assert [r["error_code"] for r in spark.read.parquet(f"{base}/rejected").collect()] == ["missing_id"]

    # Nothing new: nothing is read or written.
    assert ingest_documents.run(spark, files, base, log, conf) == {"batches": 0, "rows": 0}
    assert state(spark, base) == (docs, chunks)

    # A text unchanged, one shortened, one mended, one voided, one new and twice in a batch: the later file counts.
    write(spark, [(1, "# One\nfirst text", "a"), (2, "w", "b"), (3, "now it reads", "a"), (3, "now it reads", "a"), (6, "early", "a")], files)
    write(spark, [(6, "late", "a"), (4, " ", None)], files)
    assert ingest_documents.run(spark, files, base, log, conf)["rows"] == 7
    docs, chunks = state(spark, base)
    assert docs == {1: ("ready", None, 1, 0), 2: ("ready", None, 1, 1), 3: ("ready", None, 1, 1), 4: ("failed", "empty_text", 0, 1), 5: ("failed", "empty_text", 0, 0), 6: ("ready", None, 1, 1)}
    assert chunks == [(1, "a", 0, "# One\nfirst text"), (2, "b", 0, "w"), (3, "a", 0, "now it reads"), (6, "a", 0, "late")]
    titles = {r["document_id"]: r["title"] for r in ingest_documents.documents_now(spark, base).collect()}
    assert titles[1] == "One"
    assert "read 7 rows in 1 batches" in caplog.text and "batch 1: read 7 rows, wrote 4 documents (1 failed) with 3 chunks" in caplog.text


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    base = f"{tmp_path}/base"
    batch = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"file": F.lit("f"), "row": F.monotonically_increasing_id(), "changed": F.lit("2024-01-01").cast("timestamp")})
    conf = ingest_documents.DEFAULTS
    ingest_documents.ingest_batch(batch([(1, "one", "a"), (2, "two", "a")]), 0, base, conf)
    once = state(spark, base)
    # As if the batch had stopped before its documents were written, and behind them.
    spark.createDataFrame([(7, 0, "p", "torn", 1, [1], [1.0], "z")], ingest_documents.CHUNKS + ", kb string").write.partitionBy("kb").parquet(f"{base}/chunks/batch=1")
    assert state(spark, base) == once
    for _ in range(2):
        ingest_documents.ingest_batch(batch([(2, "changed", "a"), (3, "three", None)]), 1, base, conf)
        docs, chunks = state(spark, base)
        assert {d: r[3] for d, r in docs.items()} == {1: 0, 2: 1, 3: 1}
        assert chunks == [(1, "a", 0, "one"), (2, "a", 0, "changed"), (3, "unassigned", 0, "three")]


def test_a_new_strategy_makes_chunks_anew(spark, tmp_path):
    files, base, log = (f"{tmp_path}/{x}" for x in ("in", "base", "log"))
    write(spark, [(1, "word " * 40, "a")], files)
    ingest_documents.run(spark, files, base, log, {})
    write(spark, [(1, "word " * 40, "a")], files)
    ingest_documents.run(spark, files, base, log, {"strategies": {"a": {"size": 64, "overlap": 16}}})
    docs, chunks = state(spark, base)
    assert docs[1][2:] == (len(chunks), 1) and len(chunks) > 1


def days(spark, base, name="daily"):
    return sorted(map(str, spark.read.parquet(f"{base}/{name}").collect()))


def test_usage_report_replaces_its_window_only(spark, tmp_path):
    events, base, talk = f"{tmp_path}/events", f"{tmp_path}/base", f"{SF}/conversations.parquet"
    all_events = spark.read.parquet(f"{SF}/events.parquet")
    all_events.where("ts < '2024-01-10'").write.parquet(events)
    whole = {"from": "2024-01-01", "to": "2024-01-14"}
    first = usage_report.run(spark, events, talk, base, whole)
    before = days(spark, base)
    assert usage_report.run(spark, events, talk, base, whole) == first and days(spark, base) == before
    assert first["daily"] == 14 * 5  # days without usage too

    # More events of the last days arrive: a run over these replaces them and leaves the others.
    all_events.where("ts >= '2024-01-08' and ts < '2024-01-15'").write.mode("append").parquet(events)
    usage_report.run(spark, events, talk, base, {"from": "2024-01-08", "to": "2024-01-14"})
    late, after = "datetime.date(2024, 1, ", days(spark, base)
    early = [r for r in before if int(r.rsplit(late, 1)[1].split(")")[0]) < 8]
    assert [r for r in after if int(r.rsplit(late, 1)[1].split(")")[0]) < 8] == early and after != before
    usage_report.run(spark, events, talk, f"{tmp_path}/other", whole)
    for name in ("hourly", "calls", "daily", "questions"):
        assert days(spark, base, name) == days(spark, f"{tmp_path}/other", name)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_settings_and_command_line(tmp_path, monkeypatch):
    with pytest.raises(ValueError):
        common.settings({"fro": 1}, {"from": 2})
    seen, stopped = [], []

    class Session:
        class builder:
            appName = staticmethod(lambda _: Session.builder)
            config = staticmethod(lambda *_: Session.builder)
            getOrCreate = staticmethod(lambda: Session())

        def stop(self):
            stopped.append(1)

    monkeypatch.setattr(common, "SparkSession", Session)
    (tmp_path / "c.json").write_text(json.dumps({"x": 1}))
    assert common.main(lambda spark, *a: seen.append(a), "a job: x", {"in": "", "out": ""}, f"{tmp_path}/c.json", ["--in", "i", "--out", "o"]) == 0
    assert seen == [("i", "o", {"x": 1})] and stopped == [1]
    for job in (ingest_documents, usage_report):
        with open(job.__file__.removesuffix(".py") + ".json") as file:
            assert common.settings(json.load(file), job.DEFAULTS).keys() == job.DEFAULTS.keys()
