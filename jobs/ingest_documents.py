"""Knowledge-base ingestion: new document files become titled documents, chunks and vectors.

    python -m jobs.ingest_documents --documents DIR --output DIR --checkpoint DIR [--config FILE]

An incremental job. A file stream with a checkpoint takes the Parquet files (doc_id, text, source) that have come since the last
run, in batches, and ends. Each batch leaves three tables below the output, all in partitions of its own:

    chunks/batch=N/kb=K     document_id, chunk_index, point_id, content, token_count, buckets, weights
    documents/batch=N       document_id, kb, title, checksum, n_chars, n_chunks, status, error_code
    rejected/batch=N        document_id, file, error_code: what has no identifier, which no document can stand for

A document that comes again replaces its chunks if its text, its knowledge base or its strategy has changed, and is passed over
if not. A text that can't be ingested makes the document `failed` and its chunks void. `documents` is written last and speaks for
the batch: chunks count where the newest row of their document is of the same batch. A batch that stopped half-way runs
again under its number, compares itself with earlier batches only, and replaces what it wrote; a run without new files changes nothing.
"""

from __future__ import annotations

import json
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobs import common
from lodeframe.functions import text as T
from lodeframe.operators import knowledge as K

LOG = logging.getLogger("jobs.ingest_documents")
DEFAULTS = {"strategies": {"*": {"size": K.SIZE, "overlap": 200}}, "dimensions": K.DIMENSIONS, "most_chars": 8 << 20, "files_per_batch": 256}
SCHEMA = "doc_id long, text string, source string"
CHUNKS = "document_id long, chunk_index int, point_id string, content string, token_count int, buckets array<int>, weights array<double>"
DOCUMENTS = "document_id long, kb string, title string, checksum string, n_chars long, n_chunks long, status string, error_code string"


def strategy_of(kb: Column, strategies: dict) -> Column:
    """struct(size, overlap) of a knowledge base: its own strategy, else that of '*', within the chunker's bounds."""
    found = {name: K.chunk_strategy(json.dumps(given)) for name, given in ({"*": {}} | strategies).items()}
    pair = lambda v: F.struct(F.lit(v[0]).alias("size"), F.lit(v[1]).alias("overlap"))
    out = pair(found["*"])
    for name, value in found.items():
        if name != "*":
            out = F.when(kb == name, pair(value)).otherwise(out)
    return out


def read_documents(rows: DataFrame, conf: dict) -> DataFrame:
    """document_id, kb, text, file, row, changed, strategy, checksum, n_chars, error_code of rows as the stream has them.

    The checksum covers text, knowledge base and strategy: what the chunks depend on.
    """
    kb = F.coalesce(F.nullif(F.trim("source"), F.lit("")), F.lit("unassigned"))
    rows = rows.select(F.col("doc_id").alias("document_id"), kb.alias("kb"), F.coalesce("text", F.lit("")).alias("text"), "file", "row", "changed")
    rows = rows.withColumn("strategy", strategy_of(F.col("kb"), conf["strategies"]))
    own = F.concat_ws("\0", "text", "kb", F.to_json("strategy"), F.lit(str(conf["dimensions"])))
    rows = rows.withColumn("checksum", F.sha2(own.cast("binary"), 256)).withColumn("n_chars", F.length("text").cast("long"))
    return rows.withColumn("error_code", F.when(F.col("n_chars") > conf["most_chars"], "too_large").when(T.unicode_trim(F.col("text")) == "", "empty_text"))


def passed_over(rows: DataFrame, known: DataFrame) -> DataFrame:
    """file, row of what changes nothing: a document's rows but its newest, by the time of the file, its name and the place in it, and
    that one too if its checksum is what the document's newest entry so far has. Texts are read for their checksum, and never shuffled."""
    newest = Window.partitionBy("document_id").orderBy(F.desc("changed"), F.desc("file"), F.desc("row"))
    narrow = rows.select("document_id", "file", "row", "changed", "checksum").withColumn("n", F.row_number().over(newest))
    last = known.groupBy(F.col("document_id").alias("known_id")).agg(F.max_by("checksum", "batch").alias("known_sum"))
    return narrow.join(last, F.col("document_id") == F.col("known_id"), "left").where((F.col("n") > 1) | (F.col("checksum") == F.col("known_sum"))).select("file", "row")


def chunk_and_embed(docs: DataFrame, dimensions: int) -> DataFrame:
    """The CHUNKS columns, and kb, of documents with document_id, kb, text, strategy."""
    parts = docs.select("document_id", "kb", F.posexplode(K.chunk_texts(F.col("text"), F.col("strategy.size"), F.col("strategy.overlap"))).alias("chunk_index", "content"))
    name = F.concat_ws("-", F.lit("chunk"), F.col("document_id").cast("string"), F.col("chunk_index").cast("string"))
    parts = parts.withColumns({"point_id": T.point_id(name), "token_count": T.token_estimate(F.col("content"))})
    return K.hash_vectors(parts, "content", dimensions).select("document_id", "chunk_index", "point_id", "content", "token_count", "buckets", "weights", "kb")


def _table(spark: SparkSession, path: str, schema: str, *parts: str) -> DataFrame:
    """A table below the output; without a row where no batch has written it yet."""
    whole = ", ".join([schema, *parts])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


def ingest_batch(batch: DataFrame, number: int, output: str, conf: dict) -> int:
    """One batch of new rows, written under its number; nothing it reads is of this batch or a later one. Returns how many rows came.

    Few rows are passed over as a rule: joined by their place in a file, they are broadcast by their size and texts stay where they are.
    """
    spark = batch.sparkSession
    known = _table(spark, f"{output}/documents", DOCUMENTS, "batch int").where(F.col("batch") < number)
    rows = read_documents(batch.where("doc_id IS NOT NULL"), conf)
    over = passed_over(rows, known).persist()
    try:
        new = rows.join(over, ["file", "row"], "left_anti")
        chunks = chunk_and_embed(new.where("error_code IS NULL"), conf["dimensions"])
        chunks.hint("rebalance", "kb").write.mode("overwrite").partitionBy("kb").parquet(f"{output}/chunks/batch={number}")
        rejected = batch.where("doc_id IS NULL").select(F.col("doc_id").alias("document_id"), "file", F.lit("missing_id").alias("error_code"))
        rejected.write.mode("overwrite").parquet(f"{output}/rejected/batch={number}")
        made = _table(spark, f"{output}/chunks", CHUNKS, "batch int", "kb string").where(F.col("batch") == number)
        counts = made.groupBy(F.col("document_id").alias("own")).agg(F.count(F.lit(1)).alias("n_chunks"))
        entries = new.withColumn("title", T.title_of(F.col("text"))).drop("text").join(counts, F.col("document_id") == F.col("own"), "left").select(
            "document_id", "kb", "title", "checksum", "n_chars", F.coalesce("n_chunks", F.lit(0)).cast("long").alias("n_chunks"),
            F.when(F.col("error_code").isNull(), "ready").otherwise("failed").alias("status"), "error_code")
        entries.write.mode("overwrite").parquet(f"{output}/documents/batch={number}")
    finally:
        over.unpersist()
    wrote = _table(spark, f"{output}/documents", DOCUMENTS, "batch int").where(F.col("batch") == number)
    n = wrote.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "failed").alias("failed"), F.coalesce(F.sum("n_chunks"), F.lit(0)).alias("chunks")).first()
    came = batch.count()
    LOG.info("batch %d: read %d rows, wrote %d documents (%d failed) with %d chunks to %s", number, came, n["n"], n["failed"], n["chunks"], output)
    return came


def documents_now(spark: SparkSession, output: str) -> DataFrame:
    """DOCUMENTS and batch: the newest row of each document."""
    rows = _table(spark, f"{output}/documents", DOCUMENTS, "batch int")
    rest = [c for c in rows.columns if c not in ("document_id", "batch")]
    return rows.groupBy("document_id").agg(F.max(F.struct("batch", *rest)).alias("r")).select("document_id", "r.*")


def chunks_now(spark: SparkSession, output: str) -> DataFrame:
    """CHUNKS and kb of the documents that are ready, as they stand."""
    ready = documents_now(spark, output).where("status = 'ready'").select(F.col("document_id").alias("own"), F.col("batch").alias("own_batch"))
    rows = _table(spark, f"{output}/chunks", CHUNKS, "batch int", "kb string")
    return rows.join(ready, (F.col("document_id") == F.col("own")) & (F.col("batch") == F.col("own_batch")), "left_semi").drop("batch")


def run(spark: SparkSession, documents: str, output: str, checkpoint: str, config: dict | None = None) -> dict:
    """Takes the files below `documents` that no earlier run with this checkpoint has taken. Returns how many batches and rows were read."""
    conf = common.settings(config, DEFAULTS)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", conf["files_per_batch"]).option("recursiveFileLookup", "true").parquet(documents)
    source = source.select("doc_id", "text", "source", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
                           F.col("_metadata.file_modification_time").alias("changed"))
    came: list[int] = []
    stream = source.writeStream.foreachBatch(lambda batch, number: came.append(ingest_batch(batch, number, output, conf))) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    LOG.info("read %d rows in %d batches from %s", sum(came), len(came), documents)
    return {"batches": len(came), "rows": sum(came)}


if __name__ == "__main__":
    raise SystemExit(common.main(run, __doc__.split("\n")[0], {"documents": "folder of Parquet files (doc_id, text, source)", "output": "folder of the tables", "checkpoint": "folder of the stream's progress"},
                                 __file__.removesuffix(".py") + ".json"))
