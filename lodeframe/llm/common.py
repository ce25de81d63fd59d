"""Pieces that several operators share: the shared folder, written tables, components, words."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space and the five ASCII line and tab controls.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_own: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on a local master one of our own where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not (spark.sparkContext.master or "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = f"file://{tempfile.mkdtemp(prefix='lodeframe-')}"
        spark.sparkContext.setCheckpointDir(_own[app])
    return _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses; removed when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/lodeframe/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


#: Has Spark delete a plan's shuffle files as soon as the plan has run.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder, drop its shuffle files, and read it back."""
    spark = df.sparkSession
    path, before = new_path(spark, name), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    found = spark.read.schema(df.schema).parquet(path)
    found._lodeframe_path = path
    return found


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of `written` that no later plan reads."""
    for df in tables:
        delete(df.sparkSession, df._lodeframe_path)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            delete(spark, path)
        except Exception:  # the session may be gone; the folder then outlives it
            return


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Names like the given ones that no column of df has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def crc_mod5(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
