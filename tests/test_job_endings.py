"""Ends, changes, edits and token streams that come stale, repeated or late."""

import itertools

import pytest

from lodeframe.operators import state as W
from lodeframe.streaming import usage

JOBS = "id string, document_id string, status string, attempts int, error_code string, finished_at int, updated_at int, message string"
DOCS = "id string, status string, deleted_at int, error_code string, parser_backend string, updated_at int"
ENDS = "job_id string, document_id string, expected_attempts int, at int, parser_backend string, code string, message string"


def ended(spark, ends, status="running", deleted=None, how="complete"):
    jobs = spark.createDataFrame([("j", "d", status, 2, "E1", None, 0, "m"), ("k", "e", "running", 1, None, None, 0, "m")], JOBS)
    docs = spark.createDataFrame([("d", "parsing", deleted, "E1", "old", 0), ("e", "parsing", None, None, "old", 0)], DOCS)
    rows = spark.createDataFrame([("j", d, x, at, f"b{at}", f"c{at}", "why") for d, x, at in ends], ENDS)
    chunks = spark.createDataFrame([("d", "old"), ("e", "old")], "document_id string, content string")
    if how == "fail":
        jobs, docs = W.fail(jobs, docs, rows)
        left = None
    else:
        jobs, docs, left = W.complete(jobs, docs, chunks, rows, spark.createDataFrame([("d", "new")], "document_id string, content string"))
    job = {r["id"]: r for r in jobs.collect()}["j"]
    doc = {r["id"]: r for r in docs.collect()}["d"]
    return job, doc, sorted(map(tuple, left.collect())) if left is not None else None


@pytest.mark.parametrize("ends", list(itertools.permutations([("d", 1, 1), ("d", 2, 2), ("d", 3, 3)])))
def test_a_stale_end_hides_no_valid_one(spark, ends):
    job, doc, chunks = ended(spark, ends)
    assert (job["status"], job["finished_at"], job["error_code"], doc["status"], doc["parser_backend"]) == ("succeeded", 2, None, "ready", "b2")
    assert chunks == [("d", "new"), ("e", "old")]
    job, doc, _ = ended(spark, ends, how="fail")
    assert (job["status"], job["finished_at"], job["error_code"], doc["status"], doc["error_code"]) == ("failed", 2, "c2", "failed", "c2")


@pytest.mark.parametrize("ends, at", [([("d", 2, 5), ("d", 2, 4)], 4), ([("d", 1, 4)], None), ([("x", 2, 4)], None), ([("d", 2, 4), ("d", None, 6), ("d", None, 5)], 6),
                                      ([("d", None, 3), ("d", 2, 9)], 3), ([], None)])
def test_which_end_counts(spark, ends, at):
    for how, status in (("complete", "succeeded"), ("fail", "failed")):
        job, doc, _ = ended(spark, ends, how=how)
        assert (job["status"], job["finished_at"]) == ((status, at) if at else ("running", None))
        assert doc["updated_at"] == (at or 0)


def test_a_job_that_is_over_ends_only_without_a_fence(spark):
    assert ended(spark, [("d", 2, 4)], status="failed")[0]["status"] == "failed"
    assert ended(spark, [("d", None, 4)], status="failed")[0]["status"] == "succeeded"


def test_ends_of_a_deleted_document(spark):
    job, doc, chunks = ended(spark, [("d", 2, 4)], deleted=1)
    assert (job["status"], doc["status"], chunks) == ("running", "parsing", [("d", "old"), ("e", "old")])
    job, doc, _ = ended(spark, [("d", 2, 4)], deleted=1, how="fail")
    assert (job["status"], doc["status"]) == ("failed", "parsing")


def test_the_first_change_that_leaves_running_counts(spark):
    jobs = spark.createDataFrame([("a", "running", 2), ("b", "queued", 2)], "id string, status string, attempts int")
    changes = [(k, x, s, o) for k in "ab" for x, s, o in ((1, "failed", 0), (2, "running", 1), (2, "succeeded", 2), (2, "failed", 3))]
    for order in itertools.permutations(changes[:4]):
        rows = spark.createDataFrame([*order, *changes[4:]], "id string, attempts int, new_status string, o int")
        assert sorted((r["id"], r["status"]) for r in W.fenced_update(jobs, rows, order="o").collect()) == [("a", "succeeded"), ("b", "queued")]


def test_edits_apply_one_after_the_other(spark):
    sections = spark.createDataFrame([(i, "t", "c", "[]", 1, False, "ai", None) for i in range(4)],
                                     "id int, title string, content string, tables string, version int, manual_edited boolean, content_source string, updated_at int")
    edits = [(0, "T1", "C1", None, None, 1), (0, "T2", None, "[1]", False, 2), (1, "T1", None, None, True, 1), (1, None, None, None, False, 2), (2, None, "C", None, False, 1), (2, None, None, None, False, 2)]
    from pyspark.sql import functions as F
    got = W.save_sections(sections, spark.createDataFrame(edits, "id int, title string, content string, tables string, manual_edited boolean, o int"), F.lit(9), order="o").collect()
    assert sorted((r["id"], r["title"], r["content"], r["tables"], r["version"], r["manual_edited"], r["content_source"], r["updated_at"]) for r in got) == [
        (0, "T2", "C1", "[1]", 3, True, "manual", 9), (1, "T1", "c", "[]", 1, False, "ai", 9), (2, "t", "C", "[]", 2, False, "mixed", 9), (3, "t", "c", "[]", 1, False, "ai", None)]


DATA = 'data: {"object":"chat.completion.chunk","choices":%s%s}'
USED = ',"usage":{"total_tokens":%d}'


@pytest.mark.parametrize("lines, want", [
    ([DATA % ("[]", USED % 3), "data: [DONE]"], (True, 3, "succeeded", None)),
    ([DATA % ("[]", USED % 3)], (False, 3, "failed", "dependency_error")),
    ([DATA % ("[]", USED % 3), "data: [DONE]", DATA % ("[]", USED % 8)], (True, 8, "succeeded", None)),
    (["data: [DONE]", "junk", DATA % ("[]", USED % 8)], (True, None, "failed", "dependency_error")),
    ([DATA % ("[5]", ""), "data: [DONE]"], (False, None, "failed", "dependency_error")),
    ([DATA % ('[{"delta":"x"}]', ""), "data: [DONE]"], (False, None, "failed", "dependency_error")),
    ([DATA % ('[{"delta":{"content":"x"}}, null]', ',"usage":null'), "", ": ping", " data:[DONE] "], (True, None, "succeeded", None)),
    ([DATA % ("null", ""), "data: [DONE]"], (True, None, "succeeded", None)),
    ([DATA % ("{}", ""), "data: [DONE]"], (False, None, "failed", "dependency_error")),
    (['data: {"object":"chat.completion.chunk"}', "data: [DONE]"], (False, None, "failed", "dependency_error")),
    ([DATA % ("[]", ',"usage":[]'), "data: [DONE]"], (False, None, "failed", "dependency_error")),
    ([None, ""], (False, None, "failed", "dependency_error")),
])
def test_relay(spark, lines, want):
    rows = spark.createDataFrame([("r", i, x) for i, x in enumerate(lines)], "run string, seq int, line string")
    got = usage.relay_summary(rows, "run", "seq", "line").first()
    assert (got["done"], got["total_tokens"], got["status"], got["error"]) == want
