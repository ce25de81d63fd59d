"""Writes as functions from tables to tables; the sink decides where the result goes.

A column that a rule resets is only touched where the table has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import latency_ms

LEASE_SECONDS = 30 * 60
#: Fixed values of a finished ingestion.
DONE_STAGE, DONE_MESSAGE = "completed", "document ingestion completed"


def _set(rows: DataFrame, where: Column, **values: Column | None) -> DataFrame:
    """The values where the condition holds; None: null. Names that the table lacks are passed over."""
    own = {k: v for k, v in values.items() if k in rows.columns}
    new = {k: F.when(where, F.lit(None) if v is None else v).otherwise(F.col(k)).cast(rows.schema[k].dataType) for k, v in own.items()}
    return rows.withColumns(new)


def insert_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.unionByName(new.dropDuplicates([key]).join(old.select(key), key, "left_anti"))


def replace_children(old: DataFrame, new: DataFrame, key: str, parents: DataFrame | None = None) -> DataFrame:
    """The new rows, and the old ones of keys that are not replaced. parents: the keys to replace, also those without a new row; default: the new rows' keys."""
    replaced = (new if parents is None else parents).select(key).distinct()
    return old.join(replaced, key, "left_anti").select(*old.columns).unionByName(new)


def soft_delete(parents: DataFrame, children: DataFrame, key: str, child_key: str, doomed: Column, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Parents with deleted_at set where doomed, and children with it set where their parent is doomed; earlier marks stay."""
    gone = parents.where(doomed).select(F.col(key).alias("__gone")).distinct()
    marked = parents.withColumn("deleted_at", F.when(doomed, F.coalesce("deleted_at", as_of)).otherwise(F.col("deleted_at")))
    below = children.join(gone, F.col(child_key) == F.col("__gone"), "left") \
        .withColumn("deleted_at", F.when(F.col("__gone").isNotNull(), F.coalesce("deleted_at", as_of)).otherwise(F.col("deleted_at"))).drop("__gone")
    return marked, below


def purge(files: DataFrame, wanted: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """Two-phase delete. wanted: id; outcomes of the store: storage_key, outcome ('deleted', 'missing', 'failed').

    Files (id, storage_key, state, error, delete_requested_at) that are wanted become 'purged', or 'purge_failed' with the
    error: a blank key, or a store that failed; an object that is missing is as good as deleted. No outcome yet: 'delete_requested'.
    """
    asked = wanted.select(F.col("id").alias("__w")).distinct()
    ends = outcomes.groupBy(F.col("storage_key").alias("__k")).agg(F.max_by("outcome", F.col("outcome") != "failed").alias("__o"))
    rows = files.join(asked, F.col("id") == F.col("__w"), "left").join(ends, F.col("storage_key") == F.col("__k"), "left")
    blank = F.coalesce(F.trim("storage_key") == "", F.lit(True))
    state = F.when(blank, "purge_failed").when(F.col("__o") == "failed", "purge_failed").when(F.col("__o").isin("deleted", "missing"), "purged").otherwise("delete_requested")
    error = F.when(blank, "object storage reference is missing").when(F.col("__o") == "failed", "object storage delete failed")
    open_ = F.col("__w").isNotNull() & (F.coalesce("state", F.lit("")) != "purged")
    return _set(rows, open_, state=state, error=error, delete_requested_at=F.coalesce("delete_requested_at", as_of)).select(*files.columns)


def claimable(as_of: Column, lease_seconds: int = LEASE_SECONDS) -> Column:
    """Queued or failed, or running with an outdated lease, and attempts are left; a budget of 0 or less has no end."""
    stale = (F.col("status") == "running") & (F.col("updated_at") < as_of - F.make_dt_interval(secs=F.lit(lease_seconds)))
    return (F.col("status").isin("queued", "failed") | stale) & ((F.col("max_attempts") <= 0) | (F.col("attempts") < F.col("max_attempts")))


def claim(jobs: DataFrame, as_of: Column, lease_seconds: int = LEASE_SECONDS, stage: str | None = None, progress: int = 0, message: str | None = None) -> DataFrame:
    """Adds `claimed`; claimed jobs run with one attempt more, a new start, and nothing left of earlier errors."""
    rows = jobs.withColumn("claimed", F.coalesce(claimable(as_of, lease_seconds), F.lit(False)))
    text = lambda x: F.lit(x).cast("string")
    return _set(rows, F.col("claimed"), status=F.lit("running"), attempts=F.col("attempts") + 1, updated_at=as_of, started_at=as_of, finished_at=None,
                current_stage=text(stage), progress_percent=F.lit(progress), message=text(message), error_code=None, error_message=None)


def fenced_update(jobs: DataFrame, changes: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """Changes (key, attempts, new_status) apply to running jobs of the same attempt only.

    Several changes of a job come one after the other, by the order column: the first that leaves `running` counts, as those behind it
    find no running job. Without a column, the least of the statuses that leave it counts.
    """
    c = changes.select(F.col(key).alias("__k"), F.col("attempts").alias("__a"), F.when(F.col("new_status") != "running", F.col("new_status")).alias("__s"),
                       (F.col(order) if order else F.col("new_status")).alias("__o"))
    c = c.groupBy("__k", "__a").agg(F.min_by("__s", F.when(F.col("__s").isNotNull(), F.struct("__o", "__s"))).alias("__s"))
    fits = (F.col(key) == F.col("__k")) & (F.col("attempts") == F.col("__a")) & (F.col("status") == "running")
    return jobs.join(c, fits, "left").withColumn("status", F.coalesce("__s", "status")).drop("__k", "__a", "__s")


def _fitting(jobs: DataFrame, ends: DataFrame, *more: str) -> DataFrame:
    """The end that decides each job, of those (job_id, document_id, expected_attempts, at) that fit it; names that no table has.

    An end fits a job of the same document; where it expects an attempt, a running job of that attempt only. The fence comes
    first: a stale end hides no valid one. Then the ends come by time: the first fenced one counts, as it leaves no running
    job, and an end that expects nothing counts whatever came before, so that the last of these counts.
    """
    rows = ends.select(F.col("job_id").alias("__j"), F.col("document_id").alias("__d"), F.col("expected_attempts").alias("__x"), F.col("at").alias("__at"),
                       *[F.col(c).alias(f"__{c}") for c in more])
    there = jobs.select(F.col("id").alias("__id"), F.col("document_id").alias("__doc"), "attempts", "status")
    fits = (F.col("__id") == F.col("__j")) & (F.col("__doc") == F.col("__d")) \
        & (F.col("__x").isNull() | ((F.col("attempts") == F.col("__x")) & (F.col("status") == "running")))
    rows = rows.join(there.hint("shuffle_hash"), fits, "left_semi")
    free, body = F.col("__x").isNull(), F.struct(*rows.columns)
    ties = F.struct("__at", *[f"__{c}" for c in more])
    one = rows.groupBy("__j").agg(F.max_by(F.when(free, body), F.when(free, ties)).alias("f"), F.min_by(body, F.when(~free, ties)).alias("e"))
    return one.select(F.coalesce("f", "e").alias("r")).select("r.*")


def complete(jobs: DataFrame, documents: DataFrame, chunks: DataFrame, ends: DataFrame, new_chunks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ingestions that end well: (jobs, documents, chunks) after them.

    ends: job_id, document_id, expected_attempts (null: any), at, parser_backend. An end counts if it fits its job (see `_fitting`)
    and its document is live; then the document's chunks are replaced by the new ones, it is ready, and the job has succeeded.
    """
    live = documents.where("deleted_at IS NULL").select(F.col("id").alias("__live"))
    good = _fitting(jobs, ends, "parser_backend").join(live, F.col("__d") == F.col("__live"), "left_semi")
    rows = jobs.join(good, F.col("id") == F.col("__j"), "left")
    done = _set(rows, F.col("__j").isNotNull(), status=F.lit("succeeded"), current_stage=F.lit(DONE_STAGE), progress_percent=F.lit(100), message=F.lit(DONE_MESSAGE),
                error_code=None, error_message=None, finished_at=F.col("__at"), updated_at=F.col("__at")).select(*jobs.columns)
    per = good.groupBy("__d").agg(F.max("__at").alias("__at"), F.max_by("__parser_backend", "__at").alias("__parser_backend"))
    ready = documents.join(per, F.col("id") == F.col("__d"), "left")
    ready = _set(ready, F.col("__d").isNotNull(), status=F.lit("ready"), error_code=None, error_message=None, updated_at=F.col("__at"),
                 parser_backend=F.coalesce("__parser_backend", "parser_backend") if "parser_backend" in documents.columns else None).select(*documents.columns)
    # Chunks, the larger side, flow past a table of their part's documents: no task sorts them.
    names = per.select(F.col("__d").alias("document_id")).hint("shuffle_hash")
    kept = chunks.join(names, "document_id", "left_anti").select(*chunks.columns)
    return done, ready, kept.unionByName(new_chunks.join(names, "document_id", "left_semi").select(*chunks.columns))


def fail(jobs: DataFrame, documents: DataFrame, ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ingestions that end badly: (jobs, documents). ends: job_id, document_id, expected_attempts, at, code, message.

    The job ends even where its document was deleted meanwhile; only a live document is marked.
    """
    good = _fitting(jobs, ends, "code", "message")
    rows = jobs.join(good, F.col("id") == F.col("__j"), "left")
    over = _set(rows, F.col("__j").isNotNull(), status=F.lit("failed"), error_code=F.col("__code"), error_message=F.col("__message"),
                finished_at=F.col("__at"), updated_at=F.col("__at")).select(*jobs.columns)
    per = good.groupBy("__d").agg(F.max_by(F.struct("__code", "__message", "__at"), "__at").alias("__e"))
    hit = documents.join(per, F.col("id") == F.col("__d"), "left")
    marked = _set(hit, F.col("__d").isNotNull() & F.col("deleted_at").isNull(), status=F.lit("failed"), error_code=F.col("__e.__code"),
                  error_message=F.col("__e.__message"), updated_at=F.col("__e.__at"))
    return over, marked.select(*documents.columns)


def retry_claim(jobs: DataFrame, attempts: DataFrame, key: str = "id", source: str = "manual", reason: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(jobs, new attempts): failed or cancelled jobs under their budget wait again, with one retry more and no errors.

    attempts: job_id, attempt_no. A new one has the number behind its job's largest, and is pending.
    """
    top = attempts.groupBy(F.col("job_id").alias("__j")).agg(F.max("attempt_no").alias("__top"))
    again = F.coalesce(F.col("status").isin("failed", "canceled") & (F.col("retry_count") < F.col("max_attempts")), F.lit(False))
    new = jobs.where(again).join(top, F.col(key) == F.col("__j"), "left").select(
        F.col(key).alias("job_id"), (F.coalesce("__top", F.lit(0)) + 1).cast("long").alias("attempt_no"), F.lit(source).alias("trigger_source"),
        F.lit(reason).cast("string").alias("reason"), F.lit("pending").alias("status"))
    rows = _set(jobs.withColumn("__again", again), F.col("__again"), retry_count=F.col("retry_count") + 1, progress_json=F.lit("{}"), error_code=None, error_message=None)
    return _set(rows, F.col("__again"), status=F.lit("pending")).drop("__again"), new


def patch(rows: DataFrame, changes: dict[str, object]) -> DataFrame:
    """Only the fields that are given."""
    for name, value in changes.items():
        rows = rows.withColumn(name, F.lit(value).cast(rows.schema[name].dataType))
    return rows


def job_progress(status: Column, old: Column) -> Column:
    """Progress as JSON: how many of one step are complete; other statuses keep what there was."""
    done = lambda n: F.to_json(F.named_struct(F.lit("completed"), F.lit(n), F.lit("total"), F.lit(1)))
    return F.when(status.isin("running", "failed", "canceled"), done(0)).when(status.isin("succeeded", "partial_succeeded"), done(1)).otherwise(old)


def finalize(runs: DataFrame, ends: DataFrame, invocations: DataFrame, tokens: tuple[str, ...] = ("prompt_tokens", "completion_tokens", "reasoning_tokens")) -> DataFrame:
    """Running runs (id, status, started_at, current_iteration, tokens) end once: the earliest of their ends counts, later ones don't.

    ends: run_id, status, reason, iteration, completed_at, tokens. A token count is the end's unless 0, else the sum over the
    run's invocations, else what it was. Iterations never go down; a blank reason is null.
    """
    first = Window.partitionBy("run_id").orderBy("completed_at", "status")
    end = ends.withColumn("__n", F.row_number().over(first)).where("__n = 1").select(F.col("run_id").alias("__r"), F.struct(*[c for c in ends.columns if c != "run_id"]).alias("__e"))
    sums = invocations.groupBy(F.col("run_id").alias("__i")).agg(*[F.sum(c).alias(f"__{c}") for c in tokens])
    rows = runs.join(end, F.col("id") == F.col("__r"), "left").join(sums, F.col("id") == F.col("__i"), "left")
    counts = {c: F.coalesce(F.nullif(F.col(f"__e.{c}"), F.lit(0)), F.col(f"__{c}"), F.col(c)) for c in tokens}
    ends_now = F.col("__r").isNotNull() & (F.col("status") == "running")
    return _set(rows.withColumn("__now", ends_now), F.col("__now"), status=F.col("__e.status"), stop_reason=F.nullif(F.col("__e.reason"), F.lit("")),
                current_iteration=F.greatest("current_iteration", F.col("__e.iteration")), completed_at=F.col("__e.completed_at"),
                latency_ms=latency_ms(F.col("started_at"), F.col("__e.completed_at")), **counts).select(*runs.columns)


def iteration_marks(runs: DataFrame, events: DataFrame) -> DataFrame:
    """runs (id, current_iteration) with the highest iteration that any event (run_id, iteration_no) has reported."""
    top = events.groupBy(F.col("run_id").alias("__r")).agg(F.max("iteration_no").alias("__top"))
    return runs.join(top, F.col("id") == F.col("__r"), "left").withColumn("current_iteration", F.greatest("current_iteration", "__top")).select(*runs.columns)


def save_sections(sections: DataFrame, edits: DataFrame, as_of: Column, order: str | None = None) -> DataFrame:
    """sections (id, title, content, tables, version, manual_edited, content_source) after edits (id, new title, content, tables, manual_edited; null: not given).

    New content or tables are a manual edit whatever the edit says: one version more, and a source of 'ai' becomes 'mixed', any other 'manual'.
    Edits of a section come one after the other, by the order column: the last value given of a field counts, each change of content
    is a version, and the flag is what the last edit that sets it says. A second change finds 'mixed', which becomes 'manual'.
    """
    at = F.col(order) if order else F.struct("title", "content", "tables", "manual_edited")
    changes = F.col("content").isNotNull() | F.col("tables").isNotNull()
    flag = F.when(changes, True).otherwise(F.col("manual_edited"))
    last = lambda c: F.max_by(c, F.when(c.isNotNull(), at))
    e = edits.groupBy(F.col("id").alias("__k")).agg(*[last(F.col(c)).alias(f"__{c}") for c in ("title", "content", "tables")], last(flag).alias("__manual_edited"),
                                                    F.count_if(changes).alias("__n"))
    rows = sections.join(e, F.col("id") == F.col("__k"), "left")
    given = F.col("__k").isNotNull()
    source = F.when((F.col("content_source") == "ai") & (F.col("__n") == 1), "mixed").otherwise("manual")
    rows = _set(rows, given & (F.col("__n") > 0), version=F.col("version") + F.col("__n"), content_source=source)
    rows = _set(rows, given, manual_edited=F.coalesce("__manual_edited", "manual_edited"))
    return _set(rows, given, title=F.coalesce("__title", "title"), content=F.coalesce("__content", "content"), tables=F.coalesce("__tables", "tables"),
                updated_at=as_of).select(*sections.columns)


def export_back(reports: DataFrame, exports: DataFrame) -> DataFrame:
    """reports (id, status, deleted_at) with the newest of their exports (report_id, file_id, at); deleted ones stay as they are."""
    last = exports.groupBy(F.col("report_id").alias("__r")).agg(F.max_by("file_id", F.struct("at", "file_id")).alias("__f"), F.max("at").alias("__at"))
    rows = reports.join(last, F.col("id") == F.col("__r"), "left")
    alive = F.col("__r").isNotNull() & F.col("deleted_at").isNull() & (F.col("status") != "deleted")
    return _set(rows.withColumn("__ok", alive), F.col("__ok"), latest_report_file_id=F.col("__f"), exported_at=F.col("__at"), updated_at=F.col("__at"),
                status=F.lit("exported")).select(*reports.columns)


def hand_over(rows: DataFrame, key: str, *order: Column, flag: str = "is_current") -> DataFrame:
    """The flag on the first row of each key in the given order, and on no other."""
    return rows.withColumn(flag, F.row_number().over(Window.partitionBy(key).orderBy(*order)) == 1)


def deliver(queue: DataFrame, outcomes: DataFrame, most_retries: int) -> tuple[DataFrame, DataFrame]:
    """(tasks to deliver again, tasks given up with their reason) of queue (id, retries) after outcomes (id, outcome).

    'ok' is acknowledged, 'permanent' too but kept as a dead letter, 'dependency' is tried again while retries are left; no
    outcome: the task is delivered again as it is (at least once).
    """
    o = outcomes.groupBy(F.col("id").alias("__k")).agg(F.max_by("outcome", F.when(F.col("outcome") == "ok", 2).when(F.col("outcome") == "permanent", 1).otherwise(0)).alias("__o"))
    rows = queue.join(o, F.col("id") == F.col("__k"), "left")
    spent = (F.col("__o") == "dependency") & (F.col("retries") >= most_retries)
    dead = rows.where((F.col("__o") == "permanent") | spent).select(*queue.columns, F.when(F.col("__o") == "permanent", "permanent").otherwise("retries").alias("reason"))
    again = rows.where(F.col("__o").isNull() | ((F.col("__o") == "dependency") & ~spent))
    return again.withColumn("retries", F.col("retries") + F.col("__o").isNotNull().cast("int")).select(*queue.columns), dead


#: Kinds of events that make a tool call; all but the first end it (fixed values).
CALL_KINDS = ("started", "completed", "failed")


def fold_calls(events: DataFrame, run: str, call: str, seq: str, kind: str, ts: str, name: str | None = None, iteration: str | None = None) -> DataFrame:
    """Tool events to one row a call, as if each were written over the row of those before it.

    The first event by seq, of whatever kind, gives started_at, tool_name and iteration_no (1 at least); the last one the status,
    'running' where it is a start. The last end gives finished_at, and latency_ms if it is not the first event. Other kinds and blank calls don't count.
    """
    rows = events.where(F.col(kind).isin(*CALL_KINDS) & (F.coalesce(F.col(call).cast("string"), F.lit("")) != ""))
    first = [F.col(seq).alias("s"), F.col(ts).alias("at")]
    first += [F.col(name).alias("name")] if name else []
    first += [F.greatest(F.coalesce(F.col(iteration), F.lit(0)), F.lit(1)).cast("int").alias("i")] if iteration else []
    ended = F.col(kind) != "started"
    rows = rows.groupBy(run, call).agg(F.min(F.struct(*first)).alias("__f"), F.max_by(F.when(ended, F.col(kind)).otherwise("running"), seq).alias("status"),
                                       F.max(F.when(ended, F.struct(F.col(seq).alias("s"), F.col(ts).alias("at")))).alias("__e"), F.count(F.lit(1)).alias("n_events"))
    latency = F.when(F.col("__e.s") > F.col("__f.s"), latency_ms(F.col("__f.at"), F.col("__e.at")))
    more = ([F.col("__f.name").alias("tool_name")] if name else []) + ([F.col("__f.i").alias("iteration_no")] if iteration else [])
    return rows.select(run, call, "status", "n_events", F.col("__f.at").alias("started_at"), F.col("__e.at").alias("finished_at"), *more, latency.alias("latency_ms"))


def replay(events: DataFrame, run_col: str, run, seq: str, after: int, as_of: Column, ts: str, ttl_hours: int = 24) -> DataFrame:
    """Events of a run behind the cursor that have not expired, in order."""
    fresh = F.col(ts) + F.make_dt_interval(hours=F.lit(ttl_hours)) > as_of
    return events.where((F.col(run_col) == run) & (F.col(seq) > after) & fresh).orderBy(seq)
