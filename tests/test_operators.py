"""Hand-computed cases of the engine's own operators."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from lodeframe.functions import predicates as P
from lodeframe.functions import sanitize as S
from lodeframe.functions import text as T
from lodeframe.operators import knowledge as K
from lodeframe.operators import relational as R
from lodeframe.operators import state as W
from lodeframe.operators import tree as Tr
from lodeframe.sources import files
from lodeframe.streaming import usage


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def test_chunker_lengths(spark):
    parts = one(spark, K.chunk_texts(F.lit("x" * 90), 64, 16))
    assert [len(p) for p in parts] == [64, 42]
    assert one(spark, K.chunk_texts(F.lit(" \t\n"), 64, 16)) == []


@pytest.mark.parametrize("text, want", [(None, (1600, 0)), ("{bad", (1600, 0)), ('{"size": 10}', (64, 0)), ('{"chunkSize": 9000, "overlap": 50}', (8000, 50)),
                                        ('{"size": 100, "overlap": 100}', (100, 25))])
def test_chunk_strategy(text, want):
    assert K.chunk_strategy(text) == want


def test_text_functions(spark):
    assert one(spark, T.normalize_text(F.lit("a \t b\r\n\n c "))) == "a b\nc"
    assert one(spark, T.title_of(F.lit("\n## Title here\nx"))) == "## Title here"
    assert one(spark, T.title_of(F.lit("\n# Title here\nx"))) == "Title here"
    assert one(spark, T.unicode_trim(F.lit("\u3000a b\t"))) == "a b"
    assert one(spark, T.file_name(F.lit("C:\\x\\y.txt"))) == "y.txt"
    assert one(spark, T.truncate_bytes(F.lit("aé"), 2, "...")) == "a..."
    assert one(spark, T.checksum(F.lit("A" * 64))) == "a" * 64
    assert one(spark, T.checksum(F.lit("zz"))) is None
    assert [one(spark, T.token_estimate(F.lit(x))) for x in ("", "ab", "a" * 9)] == [0, 1, 2]
    assert one(spark, T.distinct_trimmed(F.array(F.lit(" b "), F.lit("a"), F.lit(""), F.lit("b")))) == ["b", "a"]
    assert one(spark, T.table_row(F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1")))) == "a: 1; b: 2"


def test_sanitize(spark):
    m = F.create_map(F.lit("API-Key"), F.lit("x"), F.lit("name"), F.lit(" ok "), F.lit("note"), F.lit("see https://x"), F.lit("long"), F.lit("x" * 300))
    assert one(spark, S.clean_map(m)) == {"name": "ok", "note": "[redacted]", "long": "[redacted]"}
    assert one(spark, S.clean_json(F.lit('{"a": [{"password": 1, "b": " c "}]}'))) == '{"a": [{"b": "c"}]}'
    assert one(spark, S.strict_fields(F.lit('{"a":1}'), ["a", "b"])) and not one(spark, S.strict_fields(F.lit('{"z":1}'), ["a"]))
    assert one(spark, S.strict_fields(F.lit("nonsense"), ["a"])) is False
    assert one(spark, S.strict_fields(F.lit(' {"a":1}\n'), ["a"]))
    for more in (" {}", "junk", "]", "}", ", {}", "] []", "}}", ', "v":1'):
        assert one(spark, S.strict_fields(F.lit('{"a":1}' + more), ["a"])) is False


def test_predicates(spark):
    assert one(spark, P.accepts_type(F.array(F.lit("image/*")), F.lit("image/png")))
    assert one(spark, P.has_tags(F.array(F.lit("a"), F.lit("b")), ["b", "a"])) and not one(spark, P.has_tags(F.array(F.lit("a")), ["b"]))
    assert one(spark, P.has_metadata(F.create_map(F.lit("n"), F.lit("7")), {"n": 7}))
    assert not one(spark, P.has_metadata(F.create_map(F.lit("n"), F.lit("7")), {"m": 7}))


def test_retrieve_filters_and_rerank(spark):
    points = spark.createDataFrame([("p1", "c1", "k1", [1.0, 0.0]), ("p2", "c2", "k1", [0.9, 0.0]), ("p3", "c3", "k2", [0.8, 0.0]), ("p4", "c4", "k1", [0.1, 0.0])],
                                   "point_id string, chunk_id string, kb_id string, vector array<float>")
    chunk_rows = spark.createDataFrame([(f"c{i}", f"d{i}", f"text {i}") for i in range(1, 5)], "chunk_id string, document_id string, content string")
    docs = spark.createDataFrame([("d1", "ready", ["x"]), ("d2", "failed", ["x"]), ("d3", "ready", ["x"]), ("d4", "ready", ["x"])],
                                 "document_id string, status string, tags array<string>")
    got = K.retrieve(points, chunk_rows, docs, [1.0, 0.0], ["k1", " k1 "], tags=["x"]).collect()
    assert [r["chunk_id"] for r in got] == ["c1"]
    every = K.retrieve(points, chunk_rows, docs, [1.0, 0.0], threshold=0.0, reranker=lambda h: spark.createDataFrame(
        [("c4", 1, 9.0), ("zz", 2, 8.0), ("c4", 3, 7.0)], "chunk_id string, rerank_rank int, rerank_score double")).collect()
    assert [(r["chunk_id"], round(r["final_score"], 2)) for r in every] == [("c4", 9.0), ("c1", 1.0), ("c3", 0.8)]
    assert K.retrieve(points, chunk_rows, docs, [1.0, 0.0], readable=spark.createDataFrame([], "kb_id string")).count() == 0
    with pytest.raises(ValueError):
        K.retrieve(points, chunk_rows, docs, [1.0], top_k=101)
    assert (K.candidate_limit(10), K.candidate_limit(100)) == (50, 500)


def test_rerank_problems(spark):
    docs = spark.createDataFrame([(0, "a"), (1, "b")], "index int, document_id string")
    bad = spark.createDataFrame([(0, "a", 1.0), (0, "a", 0.9), (5, None, 0.1), (1, "z", 0.2)], "index int, document_id string, score double")
    assert sorted((r["index"], r["reason"]) for r in K.rerank_problems(bad, docs).collect()) == [(0, "duplicate"), (1, "id"), (5, "index")]


def test_pages():
    assert R.page_bounds(2, 20) == (20, 20) and R.page_bounds(0, 999, lenient=True) == (0, 200)
    for bad in ((0, 20), (1, 201), (1, 0)):
        with pytest.raises(ValueError):
            R.page_bounds(*bad)


def test_job_claim_and_fence(spark):
    jobs = spark.sql("""SELECT * FROM VALUES ('q', 'queued', 0, 3, timestamp'2024-01-01 00:00:00'), ('s', 'running', 1, 3, timestamp'2024-01-01 00:00:00'),
        ('f', 'running', 1, 3, timestamp'2024-01-01 00:50:00'), ('x', 'queued', 3, 3, timestamp'2024-01-01 00:00:00') AS t(id, status, attempts, max_attempts, updated_at)""")
    got = {r["id"]: (r["claimed"], r["attempts"]) for r in W.claim(jobs, F.expr("timestamp'2024-01-01 01:00:00'")).collect()}
    assert got == {"q": (True, 1), "s": (True, 2), "f": (False, 1), "x": (False, 3)}
    changes = spark.createDataFrame([("s", 1, "succeeded"), ("f", 9, "succeeded")], "id string, attempts int, new_status string")
    assert {r["id"]: r["status"] for r in W.fenced_update(jobs, changes).collect()} == {"q": "queued", "s": "succeeded", "f": "running", "x": "queued"}


def test_tree(spark):
    nodes = spark.createDataFrame([("a", None, 1), ("b", "a", 2), ("c", "a", 1), ("d", "b", 1)], "node string, parent string, position int")
    assert {r["node"]: (r["level"], r["numbering"]) for r in Tr.renumber(nodes).collect()} == {"a": (1, "1"), "c": (2, "1.1"), "b": (2, "1.2"), "d": (3, "1.2.1")}
    assert sorted(r["node"] for r in Tr.without_subtree(nodes, "b").collect()) == ["a", "c"]
    loop = spark.createDataFrame([("a", "b", 1), ("b", "a", 1), ("c", "a", 1)], "node string, parent string, position int")
    assert sorted(r["node"] for r in Tr.cycles(loop).collect()) == ["a", "b"]


def _zip(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in parts.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), body)
    return out.getvalue()


def test_parse_files(spark):
    sheet = '<worksheet xmlns="m"><row><c t="s"><v>1</v></c><c><v>5</v></c></row></worksheet>'
    rows = [("a.md", "text/markdown", b"# Title\n\n body  text"), ("b.docx", "", files.docx_of([("Head", True), ("para", False)])),
            ("c.pptx", "", _zip(ppt__slides__slide2_dot_xml="<s><p><t>two</t></p></s>", ppt__slides__slide1_dot_xml="<s><p><t>one</t></p></s>")),
            ("d.xlsx", "", _zip(xl__worksheets__sheet1_dot_xml=sheet, xl__sharedStrings_dot_xml="<x><si><t>zero</t></si><si><t>uno</t></si></x>")),
            ("e.pdf", "", b"%PDF-1.4"), ("f.bin", "", b"\x00\x01\x02"), ("g.zip", "", b"PK\x03\x04junk"), ("h.txt", "", b" \n ")]
    got = {r["name"]: r for r in files.parse_files(spark.createDataFrame(rows, "name string, content_type string, content binary")).collect()}
    assert (got["a.md"]["content"], got["a.md"]["title"]) == ("# Title\nbody text", "Title")
    assert got["b.docx"]["content"] == "Head\npara"
    assert (got["c.pptx"]["content"], got["c.pptx"]["title"]) == ("Slide 1\none\nSlide 2\ntwo", "one")
    assert (got["d.xlsx"]["content"], got["d.xlsx"]["title"]) == ("Sheet 1\nuno 5", "Sheet 1")
    assert all(got[n]["error"] and got[n]["content"] is None for n in ("e.pdf", "f.bin", "g.zip", "h.txt"))
    assert got["e.pdf"]["format"] == "pdf"


def test_stream_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "ok"), (2, "bad")], "id int, kind string")
    sink = usage.split_dead_letters(str(tmp_path), lambda df: df, F.col("kind") == "bad")
    sink(rows, 3), sink(rows, 3)  # the same batch again replaces what it wrote
    assert spark.read.parquet(f"{tmp_path}/done").count() == 1 and spark.read.parquet(f"{tmp_path}/dead").count() == 1


def test_long_cycle(spark):
    """A cycle of twenty, a tail that leads into it, and a chain that ends."""
    rows = [(f"n{i}", f"n{(i + 1) % 20}") for i in range(20)] + [("t0", "t1"), ("t1", "n3"), *((f"c{i}", f"c{i + 1}") for i in range(15)), ("c15", None)]
    assert sorted(r["node"] for r in Tr.cycles(spark.createDataFrame(rows, "node string, parent string")).collect()) == sorted(f"n{i}" for i in range(20))


def test_nested_paragraphs():
    """A text box stands in its paragraph, and is one itself."""
    part = "<w xmlns='m'><p><t>A</t><p><t>B</t></p><t>C</t></p><p/><p><t> d </t><t>e</t></p></w>"
    assert files.Package(_zip(x_dot_xml=part)).paragraphs("x.xml") == ["ABC", "B", "d e"]
    assert files.Package(_zip(x_dot_xml="<w><t>no</t><t>paragraph</t></w>")).paragraphs("x.xml") == ["no paragraph"]


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    """A thousand levels, and what hangs on a cycle or on nothing: all nodes are there."""
    rounds, keep = [], Tr.checkpointed
    monkeypatch.setattr(Tr, "checkpointed", lambda df: rounds.append(1) or keep(df))
    rows = [("n0", None, 1)] + [(f"n{i}", f"n{i - 1}", 1) for i in range(1, 1000)] + [("x", "n1", 2), ("a", "b", 1), ("b", "c", 1), ("c", "b", 1), ("s", "s", 1), ("l", "lost", 1), ("m", "l", 1)]
    nodes = spark.createDataFrame(rows, "node string, parent string, position int")
    got = {r["node"]: (r["level"], r["numbering"]) for r in Tr.renumber(nodes).collect()}
    assert len(got) == len(rows) and len(rounds) < 30
    assert got["n999"] == (1000, ".".join(["1"] * 1000)) and got["x"] == (3, "1.1.2")
    assert all(got[n] == (None, None) for n in "abcslm")
    assert {r["node"]: r["reason"] for r in Tr.ancestry(nodes).where("reason IS NOT NULL").collect()} == {"a": "cycle", "b": "cycle", "c": "cycle", "s": "cycle", "l": "missing", "m": "missing"}
    assert sorted(r["node"] for r in Tr.cycles(nodes).collect()) == ["b", "c", "s"]
    assert {r["node"]: r["reason"] for r in Tr.parent_problems(nodes.selectExpr("1 as g", "*"), "g").collect()} == {"a": "cycle", "b": "cycle", "c": "cycle", "s": "self", "l": "missing", "m": "missing"}
    grouped = spark.createDataFrame([(1, "a", None, 1), (2, "b", "a", 1), (2, "a", None, 1), (None, "a", None, 1), (None, "b", "a", 1), (1, "z", "b", 1)], "g int, node string, parent string, position int")
    assert sorted((str(r["g"]), r["node"], r["numbering"]) for r in Tr.renumber(grouped, "g").collect()) == [("1", "a", "1"), ("1", "z", None), ("2", "a", "1"), ("2", "b", "1.1"), ("None", "a", "1"), ("None", "b", "1.1")]


def test_docx_in_pieces(spark, monkeypatch):
    """A batch is taken in pieces of bounded rows and bytes, and each step of a file runs in Python once."""
    import pyarrow as pa

    sizes = [1, 1, 5 << 20, 1, 0, None] + [1] * 600
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), pa.array(sizes, pa.int64())], ["id", "bytes"])
    pieces = list(files._pieces([batch], "bytes"))
    assert [x for p in pieces for x in p.column("id").to_pylist()] == list(range(len(sizes)))
    assert [p.num_rows for p in pieces] == [2, 1, 256, 256, 91] and not list(files._pieces([batch.slice(0, 0)], "bytes"))
    rows = spark.range(700).select(F.col("id").alias("report_id"), F.lit("Name").alias("report_name"), F.lit(1).alias("sort_order"), F.lit("t").alias("created_at"),
                                   F.lit("").alias("numbering"), F.lit(None).cast("string").alias("title"), F.when(F.col("id") > 0, F.concat(F.lit("text "), "id")).alias("content"))
    packed = files.write_docx(rows).select(F.col("report_id").cast("string").alias("name"), F.lit("").alias("content_type"), F.col("docx").alias("content"))
    parsed = files.parse_files(packed)
    assert {r["name"]: r["content"] for r in parsed.collect()} == {str(i): f"Name\ntext {i}" if i else "Name" for i in range(700)}
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("MapInArrow") == 2 and "ArrowEvalPython" not in plan


def test_embedding_is_folded_in_rows(spark):
    """Texts of unique identifiers are not shuffled, and the norm is worked out once a text; repeated identifiers are added up."""
    docs = spark.createDataFrame([(1, "a b b c"), (2, " "), (3, ""), (4, None), (5, "B b x")], "id long, text string")
    rows = K.hash_embedding(docs, "id", "text")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Window" not in plan
    vectors = K.hash_vectors(docs, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in vectors.split("AS weights")[0].rpartition("lambda x_")[2] and "transform(array(" in vectors.split("AS weights")[0]
    again = {(r["id"], r["bucket"]): (r["weight"], round(r["value"], 9)) for r in K.hash_embedding(docs.unionByName(docs), "id", "text").collect()}
    assert again == {(r["id"], r["bucket"]): (2 * r["weight"], round(r["value"], 9)) for r in rows.collect()} and again


def test_set_difference_nulls_and_plan(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "k long") for xs in ([1, 1, 2, None], [2, 3, 3, None]))
    rows = R.set_difference(a, b, "k")
    assert sorted(map(tuple, rows.collect())) == [(1, "missing"), (3, "unexpected")]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
