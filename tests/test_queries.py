"""Every query of the engine's own operators against its SQL, on the smallest tables."""

import math
import os

import pytest

from conftest import SF
from lodeframe.plans.queries import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, float):
        return f"{value:.6g}"
    return value.isoformat()[:26] if hasattr(value, "isoformat") else str(value)


def table(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in at) for r in rows)


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for file in os.listdir(SF):
        if file.endswith(".parquet"):
            con.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, tables, name):
    got = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    want = tables.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got.columns, rows) == table(want.columns, want.fetchall())


ODD = [(0, ""), (1, " \n\t "), (2, None), (3, "a\vb c\fd"), (4, "x\u00A0y\u0085z\u3000\u2028w"), (5, "\u0130STANBUL \u03A3\u0391\u03A3 x"), (6, "same same"), (7, "\f\r\n"), (8, "\v")]


def odd_tables(spark, folder, rows):
    """The rows as a documents table, and what the query and its SQL make of it."""
    path = f"{folder}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")

    def both(name):
        got = QUERIES[name](spark, str(folder))
        want = con.sql(ORACLES[name])
        return table(got.columns, [tuple(r) for r in got.collect()]), table(want.columns, want.fetchall())

    return both


@pytest.mark.parametrize("repeated", [False, True])
def test_hash_embed_sparse_odd_texts(spark, tmp_path, repeated):
    """Texts without words have no rows, words end at the white space of the SQL, and each letter is lowered by itself."""
    got, want = odd_tables(spark, tmp_path, ODD + [(6, "again")] * repeated)("hash_embed_sparse")
    assert got == want and len({r[1] for r in got}) == 5


@pytest.mark.parametrize("repeated", [False, True])
def test_hash_embed_norm_odd_texts(spark, tmp_path, repeated):
    """As above; and the weights of a text whose norm is 640 are rounded as the SQL rounds them."""
    sides, rest = [41], 640 * 640 - 41 * 41
    while rest:
        sides.append(math.isqrt(rest))
        rest -= sides[-1] ** 2
    half = " ".join(f"t{i}x" for i, n in enumerate(sides) for _ in range(n))
    got, want = odd_tables(spark, tmp_path, ODD + [(9, half)] + [(6, "again")] * repeated)("hash_embed_norm")
    assert got == want and len({r[1] for r in got}) == 6 and "-0.064062" in {r[2] for r in got}


def test_docx_round_trip_odd_texts(spark, tmp_path):
    """A report a row, whatever its identifier: texts without lines, with what XML can't hold or a reader folds, escapes and sizes above the reader's limits."""
    odd = ["a\rb\r\n\rc  d", "a\0b \x01\x1f c\x1c d", "\uFFFE\uFFFF _x000B_ _x005F_ <a>&amp;]]>", "_x0041\u00A0x _\u00A0x0041_", "\u00A0q \u00A0 r\u2003 \n \u00A0\n\u2028x \u2028\t \n\u3000\ty\u0085 "]
    rows = ODD + [(20 + i, x) for i, x in enumerate(odd)] + [(6, "again"), (6, ""), (None, "no identifier"), (None, None), (-5, "below zero"), (40, "long text, many lines\n" * 400_000)]
    got, want = odd_tables(spark, tmp_path, rows)("docx_round_trip")
    assert got == want and len(got) == len(rows)
