"""Approximate search against the exact one."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodeframe.operators import ann
from lodeframe.operators import knowledge as K


@pytest.fixture(scope="module", params=["sf0.001", "sf0.1"])
def index(spark, tmp_path_factory, request):
    points = spark.read.parquet(f"/root/testdata/{request.param}/embeddings.parquet").withColumnsRenamed({"vec_id": "point_id", "embedding": "vector"})
    path = str(tmp_path_factory.mktemp("index"))
    ann.build(points, path)
    return points, path


def asked(points):
    return points.where("point_id % 20 = 0").select(F.col("point_id").alias("query_id"), F.col("vector").alias("query_vector"))


@pytest.mark.parametrize("where", [None, "label <> 3"])
def test_recall(spark, index, where):
    points, path = index
    where = F.expr(where) if where else None
    exact = K.batch_search(points if where is None else points.where(where), asked(points), 10, "point_id", "vector", "query_id", "query_vector")
    found = ann.batch_search(spark, path, asked(points), 10, where=where)
    assert found.groupBy("query_id").count().where("count <> 10").isEmpty()
    assert ann.recall(found, exact, "query_id", "point_id") >= 0.9
    scores = {(r["query_id"], r["point_id"]): r["score"] for r in exact.collect()}
    assert all(r["score"] == scores[r["query_id"], r["point_id"]] for r in found.collect() if (r["query_id"], r["point_id"]) in scores)


def test_every_point_is_in_the_index(spark, index):
    points, path = index
    assert sorted(r[0] for r in spark.read.parquet(f"{path}/points").select("point_id").collect()) == sorted(r[0] for r in points.select("point_id").collect())


def test_only_the_probed_cells_are_read(spark, index):
    points, path = index
    query = points.where("point_id = 40").first()["vector"]
    found = ann.search(spark, path, query, 3, probes=4, where=F.col("label") >= 0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan and "PushedFilters: [IsNotNull(label), GreaterThanOrEqual(label,0)]" in plan
    assert found.first()["point_id"] == 40
    exact = K.search(points, query, 3).select("point_id", "score").collect()
    assert ann.search(spark, path, query, 3, probes=ann.CELLS_MOST).select("point_id", "score").collect() == exact


def test_odd_points(spark, tmp_path):
    """Vectors that no centre fits are found all the same; a query with too few hits around it gets those of other cells."""
    rows = [(i, [float(i % 7), 1.0], i % 2) for i in range(60)] + [(100, [50.0], 0), (101, [50.0, 0.0, 0.0], 0), (102, [float("nan"), 1.0], 9), (103, None, 9), (104, [], 9), (105, [0.0, 0.0], 1)]
    points = spark.createDataFrame(rows, "point_id long, vector array<float>, label int")
    ann.build(points, str(tmp_path), cells=8)
    assert spark.read.parquet(f"{tmp_path}/points").count() == len(rows)
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0]), (4, None)], "query_id long, query_vector array<float>")
    for k in (2, 40):
        exact = K.batch_search(points.where("label < 2"), queries.where("query_id < 4"), k, "point_id", "vector", "query_id", "query_vector")
        found = ann.batch_search(spark, str(tmp_path), queries.where("query_id < 4"), k, probes=2, where=F.col("label") < 2)
        assert {(r["query_id"], r["rank"]) for r in found.collect()} == {(r["query_id"], r["rank"]) for r in exact.collect()}
    assert {r["point_id"] for r in ann.batch_search(spark, str(tmp_path), queries.where("query_id = 1"), 2, probes=1).where("rank <= 2").collect()} & {100, 101, 102}
    ann.build(points.limit(0), f"{tmp_path}/none")
    assert ann.search(spark, f"{tmp_path}/none", [1.0], 3).count() == 0
    with pytest.raises(ValueError):
        ann.build(points.withColumn("cell", F.lit(1)), f"{tmp_path}/clash")


def test_blocks_and_odd_vectors(spark, monkeypatch):
    """Blocks that are smaller than the tables, copies, nulls, infinite and huge numbers and other lengths, against `dot` of every pair."""
    monkeypatch.setattr(K, "POINT_BLOCK", 7)
    monkeypatch.setattr(K, "QUERY_BLOCK", 3)
    odd = [None, [], [None, 1.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0], [3e38, 3e38], [1e-30, 1e-30], [0.0, 0.0], [-0.0, 2.0], [5.0], [1.0, 2.0, 3.0]]
    rows = [(i, [((i * 37) % 19 - 9) / 7, ((i * 11) % 5) / 3]) for i in range(60)] + [(100 + i, v) for i, v in enumerate(odd)] + [(200 + i, [1.0, 1.0]) for i in range(20)]
    points = spark.createDataFrame(rows, "p long, v array<float>")
    queries = points.select(F.col("p").alias("q"), F.col("v").alias("w"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc("p"))
    every = points.crossJoin(queries).select("q", "p", K.dot(F.col("v"), F.col("w")).alias("score")).withColumn("rank", F.row_number().over(order))
    for k in (1, 9, 200):
        found = K.batch_search(points, queries, k, "p", "v", "q", "w")
        assert sorted(map(repr, found.collect())) == sorted(map(repr, every.where(F.col("rank") <= k).collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "lambdafunction" not in plan  # no expression over each pair of vectors
    assert K.batch_search(points.limit(0), queries, 3, "p", "v", "q", "w").isEmpty()


def test_cells_are_packed_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(K, "POINT_BLOCK", 10)
    cells = spark.createDataFrame([(c,) for c, n in ((-1, 2), (0, 3), (1, 25), (2, 6), (3, 9)) for _ in range(n)], "cell int")
    dealt = ann._blocks(cells)
    assert sorted(c for _, parts, first, own in dealt for c in own) == [-1, 0, 1, 1, 1, 2, 3] and [b for b, *_ in dealt] == list(range(len(dealt)))
    assert all(first <= block < first + parts for block, parts, first, _ in dealt)
