"""Approximate top k with a must-filter: inverted lists over k-means cells, and exact scores.

`build` writes every point to the partition of its nearest centre; `search` reads the partitions of the cells nearest to a query,
filters inside them, and scores what is left by the dot product of the vectors themselves. The centres are fitted on a sample
of at most SAMPLE_A_CELL points a cell; points that no centre fits (no vector, another length) have a cell of their own,
REST, that every search reads. A query that finds fewer than k points in its cells is answered from all cells.

How many cells a search probes is measured, not guessed: `build` answers CALIBRATE points exactly and keeps the number of cells that
would have held `target` of their neighbours. Vectors in clusters need few cells, vectors without any need many.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import knowledge as K
from .knowledge import dot

CELLS_MOST, SAMPLE_A_CELL, ROUNDS, REST = 4096, 256, 12, -1
TARGET, CALIBRATE, NEIGHBOURS = 0.95, 200, 10


def _unit(vector: Column) -> Column:
    """The vector in double and of length 1; a zero vector stays."""
    wide = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(norm > 0, F.transform(wide, lambda x: x / norm)).otherwise(wide)


def _fits(vector: Column, size: int) -> Column:
    """Whether a centre of that size can be near: as long, and every part a finite number."""
    return F.coalesce((F.size(vector) == size) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def fit_centres(points: DataFrame, vector_col: str, cells: int | None = None, seed: int = 7) -> np.ndarray:
    """Centres (cell, dimension) of the points' directions; cells: by default the root of their number, CELLS_MOST at most.

    The driver holds the centres, and the sample is spread over the cluster: neither grows with the points beyond its bound.
    """
    sizes = points.where(F.col(vector_col).isNotNull()).groupBy(F.size(vector_col).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    usual = sizes.where("size > 0").orderBy(F.desc("n"), F.desc("size")).first()
    if usual is None:
        return np.zeros((1, 0))
    cells = min(cells or max(1, round(usual["n"] ** 0.5)), CELLS_MOST, usual["n"])
    rows = points.where(_fits(F.col(vector_col), usual["size"]))
    share = SAMPLE_A_CELL * cells / usual["n"]
    rows = (rows.sample(share, seed) if share < 0.9 else rows).limit(SAMPLE_A_CELL * cells)
    rows = rows.select(array_to_vector(_unit(F.col(vector_col))).alias("features")).persist()
    try:
        model = KMeans(k=cells, maxIter=ROUNDS, seed=seed).fit(rows) if rows.take(1) else None
    finally:
        rows.unpersist()
    return np.array(model.clusterCenters()) if model else np.zeros((1, usual["size"]))


def _cells_of(centres: np.ndarray, n: int):
    """A function from vectors to the n nearest centres, the nearest first; centres of directions are compared as points."""
    sizes, n = (centres ** 2).sum(axis=1) / 2, min(n, len(centres))

    @F.pandas_udf("array<int>")
    def nearest(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        away = sizes - np.stack(vectors.to_numpy()) @ centres.T
        first = np.argpartition(away, n - 1, axis=1)[:, :n] if n < len(centres) else np.tile(np.arange(n), (len(away), 1))
        order = np.take_along_axis(first, np.argsort(np.take_along_axis(away, first, 1), axis=1, kind="stable"), 1)
        return pd.Series(list(order.astype(np.int32)))

    return nearest


def build(points: DataFrame, path: str, id_col: str = "point_id", vector_col: str = "vector", cells: int | None = None, target: float = TARGET) -> None:
    """Writes the index of all points, with all their columns: a partition a cell below path/points, path/centres, and path/probes.

    A cell with very many points is written in several files (REBALANCE splits it), so none of them is one task's work.
    """
    if "cell" in (c.lower() for c in points.columns):
        raise ValueError("the index has a column `cell` of its own")
    spark, centres = points.sparkSession, fit_centres(points, vector_col, cells)
    own = _fits(F.col(vector_col), centres.shape[1])
    fits = points.where(own).withColumn("cell", F.get(_cells_of(centres, 1)(_unit(F.col(vector_col))), F.lit(0)))
    rows = fits.unionByName(points.where(~own).withColumn("cell", F.lit(REST)))
    if points.isEmpty():
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/points")  # a file, so that the columns are known
    else:
        rows.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/points")
    table = [(i, c.tolist()) for i, c in enumerate(centres)]
    spark.createDataFrame(table, "cell int, centre array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
    probes = _calibrated(spark.read.parquet(f"{path}/points").where(F.col("cell") != REST), centres, id_col, vector_col, target)
    spark.createDataFrame([(probes, target)], "probes int, target double").coalesce(1).write.mode("overwrite").parquet(f"{path}/probes")


def _calibrated(points: DataFrame, centres: np.ndarray, id_col: str, vector_col: str, target: float) -> int:
    """The least number of cells, nearest first, that hold the share `target` of the NEIGHBOURS of CALIBRATE points, themselves not counted."""
    asked = points.select(F.col(id_col).alias("__q"), F.col(vector_col).alias("__w")).orderBy(F.xxhash64("__q"), "__q").limit(CALIBRATE).persist()
    exact = K.batch_search(points, asked, NEIGHBOURS + 1, id_col, vector_col, "__q", "__w").where(~F.col("__q").eqNullSafe(F.col(id_col)))
    order = asked.select(F.col("__q").alias("__own"), _cells_of(centres, len(centres))(_unit(F.col("__w"))).alias("order"))
    hits = exact.join(points.select(F.col(id_col).alias("__p"), "cell"), F.col(id_col) == F.col("__p")).join(order, F.col("__q") == F.col("__own"))
    places = hits.groupBy(F.array_position("order", F.col("cell")).alias("place")).agg(F.count(F.lit(1)).alias("n")).orderBy("place").collect()
    asked.unpersist()
    total, seen = sum(r["n"] for r in places), 0
    for r in places:
        seen += r["n"]
        if seen >= target * total:
            return r["place"]
    return 1


def _centres(spark: SparkSession, path: str) -> np.ndarray:
    """At most CELLS_MOST rows."""
    return np.array([r["centre"] for r in spark.read.parquet(f"{path}/centres").orderBy("cell").collect()])


def _probes(spark: SparkSession, path: str, given: int | None) -> int:
    return given or spark.read.parquet(f"{path}/probes").first()["probes"]


def _points(spark: SparkSession, path: str, where: Column | None) -> DataFrame:
    rows = spark.read.parquet(f"{path}/points")
    return rows if where is None else rows.where(where)


def search(spark: SparkSession, path: str, query: Sequence[float], k: int, probes: int | None = None, threshold: float | None = None, where: Column | None = None,
           id_col: str = "point_id", vector_col: str = "vector") -> DataFrame:
    """Top k of one query: id_col, score, and the points' other columns, best first, ties by id. The cells are partition filters of the scan."""
    centres, rows = _centres(spark, path), _points(spark, path, where)
    literal, probes = F.array(*[F.lit(float(x)) for x in query]), _probes(spark, path, probes)

    def best(part: DataFrame) -> DataFrame:
        part = part.withColumn("score", dot(F.col(vector_col), literal))
        part = part if threshold is None else part.where(F.col("score") >= threshold)
        return part.drop("cell").orderBy(F.desc("score"), F.asc(id_col)).limit(k)

    unit = np.array(query, float)
    if len(unit) != centres.shape[1] or probes >= len(centres):
        return best(rows)
    away = (centres ** 2).sum(axis=1) / 2 - centres @ (unit / (np.linalg.norm(unit) or 1))
    found = best(rows.where(F.col("cell").isin([REST, *np.argsort(away, kind="stable")[:probes].tolist()])))
    return found if found.count() >= k else best(rows)


def _blocks(rows: DataFrame) -> list[tuple[int, int, int, list[int]]]:
    """(block, parts, first, cells): neighbouring cells share a block of points, a larger cell is dealt over `parts` blocks from `first` on. At most CELLS_MOST cells."""
    sizes, out, open_, n = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cell").collect(), [], [], 0
    close = lambda cells: out.append((len(out), 1, len(out), cells)) if cells else None
    for r in sizes:
        parts = -(-r["n"] // K.POINT_BLOCK)
        if parts > 1:
            first = len(out)
            out += [(first + i, parts, first, [r["cell"]]) for i in range(parts)]
        elif n + r["n"] > K.POINT_BLOCK:
            close(open_)
            open_, n = [r["cell"]], r["n"]
        else:
            open_, n = [*open_, r["cell"]], n + r["n"]
    close(open_)
    return out


def batch_search(spark: SparkSession, path: str, queries: DataFrame, k: int, probes: int | None = None, where: Column | None = None, id_col: str = "point_id", vector_col: str = "vector",
                 query_id: str = "query_id", query_vector: str = "query_vector") -> DataFrame:
    """Top k points of every query (one row each): query_id, id_col, score, rank. Cells are packed in blocks of points; a query meets those blocks that hold a cell it probes."""
    centres, rows = _centres(spark, path), _points(spark, path, where).select(F.col(id_col).alias("__p"), F.col(vector_col).alias("__v"), "cell")
    asked, probes = queries.select(F.col(query_id).alias("__q"), F.col(query_vector).alias("__w")), _probes(spark, path, probes)
    fits, every = _fits(F.col("__w"), centres.shape[1]), F.sequence(F.lit(REST), F.lit(len(centres) - 1))

    if probes >= len(centres):
        return K.batch_search(rows, asked, k, "__p", "__v", "__q", "__w").withColumnsRenamed({"__q": query_id, "__p": id_col})
    blocks = spark.createDataFrame(_blocks(rows), "block int, parts int, first int, cells array<int>")
    places = blocks.select(F.explode("cells").alias("__cell"), "first", "parts").distinct()
    dealt = rows.join(F.broadcast(places), F.col("cell") == F.col("__cell")).select(
        (F.col("first") + F.pmod(F.xxhash64("__p"), F.col("parts")).cast("int")).alias("__b"), "__p", "__v", "__cell")

    def best(probing: DataFrame) -> DataFrame:
        met = probing.crossJoin(F.broadcast(blocks)).select(F.col("block").alias("__b"), "__q", "__w", F.array_intersect("__probed", "cells").alias("__cells"))
        return K.best_of_blocks(dealt, met.where(F.size("__cells") > 0), k, id_col, query_id)

    near = asked.where(fits).withColumn("__probed", F.concat(F.array(F.lit(REST)), _cells_of(centres, probes)(_unit(F.col("__w")))))
    found = best(near.unionByName(asked.where(~fits).withColumn("__probed", every))).persist()
    short = asked.join(found.groupBy(F.col(query_id).alias("__own")).agg(F.count(F.lit(1)).alias("n")), F.col("__q").eqNullSafe(F.col("__own")), "left").where("n IS NULL OR n < " + str(k))
    short = short.select("__q", "__w").persist()
    if short.isEmpty():
        return found
    ids = short.select(F.col("__q").alias("__short"))
    return found.join(ids, F.col(query_id).eqNullSafe(F.col("__short")), "left_anti").unionByName(best(short.withColumn("__probed", every)))


def recall(found: DataFrame, exact: DataFrame, query_id: str, id_col: str) -> float:
    """The share of the exact answers that were found."""
    hit = exact.select(query_id, id_col).join(found.select(query_id, id_col), [query_id, id_col], "left_semi").count()
    return hit / max(1, exact.count())
