"""The corpus pipeline: documents in, a weighted mix of clean documents out.

Each stage is one operator, works on all rows that the stage before kept, and is written as Parquet
before the next one reads it. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeframe.llm import common, decontam, line_dedup, mixing, quality, simhash


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    A null text is judged like an empty one, a very long one as a whole; null identifiers, ties and repeated rows are judged by their
    texts, each for itself. Without labels of both kinds all have one score. An empty table gives no rows; other columns stay, whatever their names.
    """
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def fewer_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; n_chars follows the text.

    A null text stays null, an emptied one is empty: every row stays. The earliest line counts by document, null identifiers last; lines of
    equal position (rows that repeat an identifier) don't duplicate each other. Long lines are indexed in pieces. Other columns stay.
    """
    left = line_dedup.dedup_lines(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest identifier of each group of near duplicates.

    Near is op2's rule, at most 3 of 64 bits over three-word shingles: far stricter than a similarity of 0.8 (figures in README).
    """
    return simhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages.

    Null and empty texts hold none and stay; a very long text goes whole if any part of it holds one. Rows are judged by their texts, so
    repeated ones and null identifiers go or stay together. Null and empty items are looked for nowhere. Other columns stay.
    """
    return decontam.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The weighted mix: a row for each time that a document is taken, numbered by copy_no.

    A null source is a source, the last in order; null and wordless texts have size 0. Draws are by identifier: repeated rows, and all
    rows without one, are taken or left together. An empty table gives an empty mix. Other columns stay.
    """
    return mixing.mix(docs)


STAGES = [("quality", good), ("line_dedup", fewer_lines), ("simhash", one_of_each), ("decontamination", clean), ("mixing", mixed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each but the last is written, and the next one reads what was written."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
