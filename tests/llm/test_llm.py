"""The training-data operators against brute force, exact round trips and planted cases."""

import hashlib
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from conftest import SF
from lodeframe.llm import common, decontam, exact_dedup, graph, line_dedup, lm, mixing, quality, repeats, simhash, url_filter, warc
from lodeframe.llm.queries import QUERIES

DOCS = "doc_id long, text string, source string, extra string, __id string"
ODD = [(1, "the cat sat on the mat today", "a", None, "x"), (2, None, None, None, None), (3, "", "b", "e", "x"), (4, "the cat sat on the mat today", "a", None, "y"),
       (None, "the cat sat on the mat today", "a", None, "z"), (5, "\t\n ", "b", None, None), (6, "ö" * 3000 + "\n" + "w " * 3000, "c", None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for df in (exact_dedup.exact_dedup(empty), mixing.mix_report(empty), mixing.mix(empty), simhash.near_dedup(empty), simhash.keep_one(empty),
               repeats.removal_report(empty), line_dedup.dedup_lines(empty), decontam.leaks(empty, bench), decontam.keep_clean(empty, bench),
               quality.classify(empty, labels), lm.score_texts(empty), url_filter.judge(pages), warc.archive_pages(pages)):
        assert df.count() == 0


def test_odd_rows_keep_their_number(spark, odd):
    labels = spark.createDataFrame([(1, 1), (3, None), (4, 0)], "doc_id long, quality int")
    bench = spark.createDataFrame([(1, "the cat sat on the mat today"), (2, None), (3, "")], "item_id long, text string")
    for df in (exact_dedup.exact_dedup(odd), mixing.mix_report(odd), simhash.near_dedup(odd), repeats.removal_report(odd), line_dedup.dedup_lines(odd),
               quality.classify(odd, labels), lm.score_texts(odd)):
        assert df.count() == len(ODD)
    assert sorted(r["doc_id"] or 0 for r in decontam.leaks(odd, bench).collect()) == [0, 1, 4]
    assert decontam.keep_clean(odd, bench).columns == odd.columns


def test_exact_dedup(spark, odd):
    got = {r["doc_id"]: r for r in exact_dedup.exact_dedup(odd, keep="largest", fan_in=2).collect()}
    assert (got[1]["keep_id"], got[1]["group_size"], got[1]["kept"], got[4]["kept"]) == (4, 3, False, True)
    assert got[2]["keep_id"] == 3 and got[None]["kept"] is False
    assert got[2]["text_sha256"] == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("leaves, fan_in", [(1, 8), (2, 2), (13, 2), (32, 8), (211, 8)])
def test_runs_meet(leaves, fan_in):
    """Every key's copies meet on one node, whatever leaf they start from, in the stated rounds of at most fan_in runs."""
    rounds, k = exact_dedup.rounds_of(leaves, fan_in)
    assert k <= fan_in and k ** rounds >= leaves
    for key in (bytes(8), b"\xff" * 8, b"abcdefgh", b"12345678"):
        ends = set()
        for node in range(leaves):
            for number in range(rounds):
                node = exact_dedup.target(node, key, number, k)
                assert 0 <= node < k ** rounds
            ends.add(node)
        assert len(ends) == 1


def test_runs_are_merged():
    rows = exact_dedup.merged([iter([(b"a", 3, 1), (b"c", None, 2)]), iter([(b"a", 1, 4), (b"b", None, 1)]), iter([(b"a", None, 1), (b"c", 9, 1)])], min)
    assert list(rows) == [(b"a", 1, 6), (b"b", None, 1), (b"c", 9, 3)]


def test_exact_dedup_over_many_leaves(spark):
    rows = [(f"d{i:04d}" if i % 7 else None, None if i % 10 == 0 else f"text {i % 40}" if i % 3 else "one") for i in range(900)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id string, text string").repartition(13), fan_in=2).collect()
    groups = {}
    for doc, text in rows:
        groups.setdefault(hashlib.sha256((text or "").encode()).hexdigest(), []).append(doc)
    assert len(got) == len(rows)
    for r in got:
        own = groups[r["text_sha256"]]
        assert r["group_size"] == len(own) and r["keep_id"] == min((x for x in own if x), default=None)


def test_mixing_comes_near(spark, docs):
    rows = mixing.mix_report(docs).toPandas()
    per = rows.groupby("target").agg(taken=("taken", "sum"), size=("size", "sum"))
    assert (rows["taken"] <= 2 * rows["size"]).all()
    assert rows["taken"].sum() == pytest.approx(1.5 * rows["size"].sum(), rel=0.05)
    assert len(per) > 1
    again = mixing.mix_report(docs.repartition(3)).toPandas()
    assert sorted(map(tuple, rows.values)) == sorted(map(tuple, again.values))
    assert mixing.mix(docs).groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2


def fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    parts = [b" ".join(w)] if len(w) < 3 else [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def labels_of(fps, bits=3):
    f, label = np.array(fps, np.uint64), np.arange(len(fps))
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= bits
    while True:
        new = np.where(near, label[None, :], len(f)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_simhash_against_brute_force(spark, docs):
    rows = docs.orderBy("doc_id").toPandas()
    fps = [fingerprint(t) for t in rows["text"]]
    got = simhash.near_dedup(docs).toPandas().sort_values("doc_id")
    assert list(got["fingerprint"]) == [f"{x:016x}" for x in fps]
    assert list(got["component_id"]) == list(rows["doc_id"].to_numpy()[labels_of(fps)])


def test_simhash_links_in_blocks(spark):
    """A chain and a crowd of fingerprints in one bucket, cut into small blocks, keep their components."""
    rng = np.random.default_rng(1)
    fps = {int(rng.integers(0, 1 << 62)) for _ in range(20)}
    base = int(rng.integers(0, 1 << 62))
    for _ in range(200):
        fps.add(base ^ sum(1 << int(b) for b in rng.integers(40, 60, 4)))
    fps = sorted(fps)
    links = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), block=16).collect()
    at, label = {x: i for i, x in enumerate(fps)}, list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for r in links:
        a, b = find(at[r["a"]]), find(at[r["b"]])
        label[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == list(labels_of(fps))


def test_components_refuse_to_stop_early(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(64)], "a long, b long")
    assert {r["root"] for r in graph.components(chain).collect()} == {0}
    with pytest.raises(ValueError):
        graph.components(chain, most_rounds=1)


def test_keep_one_decides_by_row(spark):
    """Null and repeated identifiers: one row of each component stays, and no row goes for another's sake."""
    rng = np.random.default_rng(4)
    a, b, c, d, e, f = (" ".join(rng.choice([f"w{i}" for i in range(500)], 60)) for _ in range(6))
    near = [i for i in range(len(a.split())) if (fingerprint(a) ^ fingerprint(" ".join([*a.split(), f"x{i}"]))).bit_count() <= 3]
    a2 = " ".join([*a.split(), f"x{near[0]}"])
    rows = [(3, a), (None, a2), (None, b), (None, c), (None, c), (7, a), (7, d), (8, e), (8, e), (9, e), (None, e), (5, f), (None, None), (None, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, number string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"] or "") for r in kept.collect())
    assert got == Counter([(3, a), (None, b), (None, c), (7, d), (8, e), (5, f), (None, "")])


def repeats_by_hand(texts, length=50):
    """(doc, n_bytes, n_removed, n_spans, kept_sha256) of each row, sorted."""
    seen, out = {}, []
    for doc, text in texts:
        b = (text or "").encode()
        for i in range(len(b) - length + 1) if doc is not None else ():
            w = b[i:i + length]
            seen[w] = min(seen.get(w, doc), doc)
    for doc, text in texts:
        b = (text or "").encode()
        marks = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - length + 1) if doc is not None else ():
            if seen[b[i:i + length]] < doc:
                marks[i] += 1
                marks[i + length] -= 1
        gone = marks[:-1].cumsum() > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int(np.diff(gone.astype(int), prepend=0).clip(0).sum())
        out.append((-1 if doc is None else doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def repeats_of(spark, texts, length=50):
    rows = repeats.removal_report(spark.createDataFrame(texts, "doc_id long, text string"), length=length).collect()
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)


@pytest.mark.parametrize("length", [50, 100, 200, 20])
def test_repeats_against_brute_force(spark, docs, length):
    """One, two and three doublings; periodic texts, repeated and null identifiers, repeated rows."""
    rows = docs.orderBy("doc_id").limit(120).toPandas()
    texts = list(zip(rows["doc_id"].tolist(), rows["text"]))
    texts += [(1000, "ab" * 400), (1001, "x" + "ab" * 100 + "y"), (1002, "q" * 49), (1003, "q" * 49), (1004, None), (1005, ""), (None, texts[0][1]),
              (None, texts[0][1]), (3000, texts[3][1]), (3000, texts[4][1]), (3000, texts[3][1]), (-5, texts[7][1])]
    assert repeats_of(spark, texts, length) == repeats_by_hand(texts, length)


def test_repeats_of_equal_halves(spark):
    """Windows whose halves are equal, of two different periods: neither repeats the other."""
    a, b = "wspjlrebpvbtawpmycjwgeled", "nzpgmasnaasjdpywsvfyctzda"
    texts = [(1, "abcde" + a + a + "fghij"), (2, "klmno" + a + a + "pqrst"), (3, "uvwxy" + b + b + "zabcd"), (4, "efghi" + b + b + "jklmn"),
             (5, "1" + (a + b)[:50] + "2"), (6, "3" + (b + a)[:50] + "4")]
    assert [r[2] for r in repeats_of(spark, texts)] == [0, 50, 0, 50, 0, 0]


def test_repeats_in_long_texts_and_many(spark):
    """Texts that are cut into pieces, and a passage in a third of all documents with different words around it."""
    rng = np.random.default_rng(6)
    letters = np.array(list("abcdefgh "))
    long = "".join(rng.choice(letters, repeats.PIECE + 30_000))
    passage = "".join(rng.choice(letters, 90))
    texts = [(1, long), (2, "x" * 77 + long[repeats.PIECE - 300:repeats.PIECE + 300] + "y"), (3, long[5:]), (4, "z" * 60_000)]
    texts += [(10 + i, "".join(rng.choice(letters, 150)) + (passage if i % 3 == 0 else "") + "".join(rng.choice(letters, 150))) for i in range(600)]
    assert repeats_of(spark, texts) == repeats_by_hand(texts)


def test_repeats_are_verified():
    """A claim that its source's bytes don't bear out raises."""
    packed = repeats._pack_claims(*(np.array([x]) for x in (2, 7, 0, 3, 1, 8, 5)))
    source = lambda text: np.array([1, 8, 5], "<i8").tobytes() + zstandard.ZstdCompressor().compress(text)
    text = bytes(range(53))
    good = repeats._verified({repeats.CLAIM: [packed], repeats.BYTES: [source(text)]}, 50)
    assert [x.tolist() for x in good(2, 7)(text + b"more")] == [[0], [3]] and not len(good(2, 8)(text)[0])
    bad = repeats._verified({repeats.CLAIM: [packed], repeats.BYTES: [source(text[:-1] + b"!")]}, 50)
    with pytest.raises(ValueError):
        bad(2, 7)(text)


def test_line_dedup(spark):
    rows = [(1, "a b c d e f\nx y z\n\nlonely"), (2, "a b c d e g\nq q q q q q q"), (3, "a b c e f\n\n"), (4, "a  b c d e f\nx y w"), (5, "w a b c d e f g"), (6, None),
            (7, " ".join(f"w{i}" for i in range(1500))), (8, " ".join(f"w{i}" for i in range(1500) if i != 777))]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), count_cols=("n", "gone")).collect()}
    assert got[1]["text"] == rows[0][1] and got[1]["gone"] == 0
    assert got[2]["text"] == "q q q q q q q" and got[3]["text"] == "\n" and got[4]["text"] == "x y w"
    assert got[5]["text"] == rows[4][1] and got[6]["text"] is None and got[8]["text"] == "" and got[7]["gone"] == 0


def test_decontamination_finds_edited_items(spark):
    rng = np.random.default_rng(2)
    words = [f"word{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(words, n))) for i, n in enumerate(rng.integers(5, 60, 60))]
    rows, want = [], set()
    for i, text in items:
        w = text.split()
        for edits in (0, len(w) // 10, len(w) // 5):
            x = list(w)
            for _ in range(edits):
                at = int(rng.integers(0, len(x)))
                x[at:at + 1] = [[], ["new"], [x[at], "more"]][int(rng.integers(0, 3))]
            doc = len(rows)
            rows.append((doc, " ".join([*rng.choice(words, 30), *(v.upper() + "," for v in x), *rng.choice(words, 30)])))
            want.add((doc, i))
    rows.append((len(rows), " ".join(rng.choice(words, 3000))))
    got = decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(found & want) >= 0.95 * len(want)
    assert all(r["edits"] <= len(dict(items)[r["item_id"]].split()) // 5 for r in got)


def test_repeated_rows_keep_their_lines(spark):
    """A row that repeats another does not make its lines near duplicates of themselves."""
    rows = [(1, "a b c d e f\nx"), (1, "a b c d e f\nx"), (2, "a b c q r s t"), (3, "a b c d z f")]
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, "a b c d e f\nx"), (1, "a b c d e f\nx"), (2, "a b c q r s t"), (3, "")]


def one_word_apart(x, y):
    if abs(len(x) - len(y)) > 1 or min(len(x), len(y)) < line_dedup.MIN_WORDS:
        return False
    i = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
    return x[i + (len(x) >= len(y)):] == y[i + (len(y) >= len(x)):]


def lines_by_hand(rows):
    """The rows without lines that an earlier line equals or is one word apart from; positions are (identifier, line)."""
    seen = [((doc is None, doc or 0, n), tuple(re.split(line_dedup.SPACES, line.strip(" \t\x0b\x0c\r")))) for doc, text in rows for n, line in enumerate((text or "").split("\n"))]
    seen = [(at, words) for at, words in seen if words != ("",)]
    first = {}
    for at, words in seen:
        first[words] = min(first.get(words, at), at)
    gone = {words for words, at in first.items() if any(other < at and one_word_apart(words, w) for w, other in first.items() if w != words)}
    out = []
    for doc, text in rows:
        kept = []
        for n, line in enumerate((text or "").split("\n")):
            words = tuple(re.split(line_dedup.SPACES, line.strip(" \t\x0b\x0c\r")))
            if words == ("",) or words not in gone and first[words] >= (doc is None, doc or 0, n):
                kept.append(line)
        out.append((doc, None if text is None else "\n".join(kept)))
    return out


@pytest.mark.parametrize("named", ["bigint", "string"])
def test_line_dedup_against_brute_force(spark, named):
    """Lines with up to two edits, repeated lines, blank ones, odd white space, null and repeated identifiers, clashing names."""
    rng = np.random.default_rng(8)
    words, rows, known = [f"w{i}" for i in range(30)], [], []
    for doc in range(90):
        lines = []
        for _ in range(int(rng.integers(1, 9))):
            line = list(rng.choice(words, int(rng.integers(1, 14))))
            if known and rng.random() < 0.6:
                line = list(known[int(rng.integers(len(known)))])
                for _ in range(int(rng.integers(0, 3))):
                    at = int(rng.integers(0, len(line) + 1))
                    line[at:at + int(rng.integers(0, 2))] = [[], ["new"]][int(rng.integers(0, 2))]
            known.append(line or ["x"])
            lines.append(" ".join(line) if rng.random() < 0.9 else "\t" + "  ".join(line) + " ")
        rows.append((doc, "\n".join(lines)))
    rows += [(200, None), (201, ""), (202, "\n\n \n"), (203, rows[0][1]), (204, " ".join(words * 60)), (205, " ".join(words * 60 + ["more"])), (None, rows[5][1])]
    if named == "string":
        rows = [(None if doc is None else f"k{doc:03d}", text) for doc, text in rows]
    table = spark.createDataFrame([(*r, i, "d", "k", "l") for i, r in enumerate(rows)], f"doc_id {named}, text string, __lost int, __drop string, __kept string, doc string")
    got = line_dedup.dedup_lines(table)
    assert got.columns == table.columns
    want = lines_by_hand(rows) if named == "bigint" else [(rows[i][0], t) for i, (_, t) in enumerate(lines_by_hand([(None if d is None else int(d[1:]), t) for d, t in rows]))]
    assert sorted(((r["__lost"], r["doc_id"], r["text"]) for r in got.collect())) == [(i, *w) for i, w in enumerate(want)]


def test_decontamination_against_exhaustive_search(spark):
    """Windows at and around the edit bound: nothing beyond it is found, and nine in ten within it are, of every length."""
    rng = np.random.default_rng(11)
    words = [f"v{i}" for i in range(300)]
    items = [" ".join(rng.choice(words, n)) for n in (5, 8, 10, 20, 35, 60) for _ in range(6)]
    rows = []
    for i, item in enumerate(items):
        for edits in range(0, len(item.split()) // 5 + 2, max(1, len(item.split()) // 10)):
            x = item.split()
            for at in rng.choice(len(x), min(edits, len(x)), replace=False):
                x[at] = f"other{at}"
            rows.append((len(rows), " ".join([*rng.choice(words, 25), *x, *rng.choice(words, 25)])))
    known = decontam.Words()
    ids = [decontam.word_ids(i.encode(), known) for i in items]
    docs = [decontam.word_ids(t.encode(), known) for _, t in rows]
    want = {(d, i) for d, text in enumerate(docs) for i, item in enumerate(ids) if decontam.edit_distance(item, text) <= decontam.allowed(len(item))}
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, __text string, edits string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(table, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert got <= want
    for n in {len(i) for i in ids}:
        own = {(d, i) for d, i in want if len(ids[i]) == n}
        assert len(got & own) >= 0.9 * len(own)


def test_names_that_clash(spark):
    """Columns with the names that operators use inside keep their values."""
    names = ["__cut", "__name", "__copies", "copy_no", "__gone", "number", "fp", "doc", "own", "draw"]
    table = spark.createDataFrame([(i, f"some words of text {i} " * 9, "s", *range(len(names))) for i in range(20)],
                                  "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    for got in (mixing.mix(table), simhash.keep_one(table), line_dedup.dedup_lines(table)):
        assert got.columns[:len(table.columns)] == table.columns
        assert all(tuple(r)[3:3 + len(names)] == tuple(range(len(names))) for r in got.collect())
    assert mixing.mix(table).columns[-1] == "copy_no_"


def test_warc_odd_identifiers(spark, tmp_path):
    """Text identifiers of any characters, the word null and no identifier are told apart."""
    big = "y" * 2000
    rows = [("null", "u", big), ("a\nb\r\nWARC-Type: x", "u", big), (None, "u", "z"), ("", "u", ""), ("<é %20>", None, None)]
    table = spark.createDataFrame([(*r, "e") for r in rows], "page_id string, url string, html string, __html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.archive_pages(table, str(tmp_path)).collect()}
    assert got == {"null": ("response", None, 2000), "a\nb\r\nWARC-Type: x": ("revisit", "null", 2000), None: ("response", None, 1), "": ("response", None, 0), "<é %20>": ("response", None, 0)}


def test_cascade_is_exact(spark, monkeypatch):
    """Small levels, so that several are needed."""
    monkeypatch.setattr(url_filter, "MIN_BITS", 64)
    listed = spark.range(0, 100, 7).select(F.concat(F.lit("k"), "id").alias("key"))
    universe = spark.range(400).select(F.concat(F.lit("k"), "id").alias("key"))
    levels = url_filter.build_cascade(listed, universe, miss=0.3)
    assert len(levels) > 1
    wrong = universe.withColumn("m", url_filter.member(levels, F.col("key"))) \
        .withColumn("n", F.substring("key", 2, 9).cast("int")).where(F.col("m") != ((F.col("n") % 7 == 0) & (F.col("n") < 100)))
    assert wrong.count() == 0


def test_cascade_stays_exact_over_a_large_universe(spark, monkeypatch):
    """72 listed keys, 5,000 in all, and a level 0 that lets nearly a third through."""
    monkeypatch.setattr(url_filter, "MIN_BITS", 64)
    listed = spark.range(72).select(F.concat(F.lit("k"), F.col("id") * 7).alias("key"))
    universe = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    levels = url_filter.build_cascade(listed, universe, miss=0.3)
    assert 2 < len(levels) < 25
    found = {r["key"] for r in universe.where(url_filter.member(levels, F.col("key"))).collect()}
    assert found == {f"k{7 * i}" for i in range(72)}


def test_cascade_refuses_to_stop_early(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MIN_BITS", 64)
    monkeypatch.setattr(url_filter, "MAX_LEVELS", 1)
    with pytest.raises(ValueError):
        url_filter.build_cascade(spark.range(90).select(F.concat(F.lit("k"), "id").alias("key")),
                                 spark.range(900).select(F.concat(F.lit("k"), "id").alias("key")), miss=0.5)


def test_urls(spark):
    rows = [(1, "https://A.Example.org/es/x?q"), (2, "http://example.org/en/12"), (3, "http://x.org"), (4, "http://y.com/de/"), (5, None), (6, "no scheme"), (7, "http://notorg/")]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block") and got[2] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[3] == ("x.org", "", None, "allow") and got[4] == ("y.com", "/de/", "com/de/", "block")
    assert got[5] == got[6] == ("", "", None, "allow") and got[7] == ("notorg", "/", None, "allow")


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "é" * 900
    rows = [(1, "http://a/ b\n", big), (2, "http://b/", big), (3, None, None), (None, "u", big), (4, "v", "small"), (5, "v", "small")]
    got = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path)).collect()
    kinds = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got}
    n = len(big.encode())
    assert kinds == {1: ("revisit", 2, n), 2: ("response", None, n), 3: ("response", None, 0), None: ("revisit", 2, n), 4: ("response", None, 5), 5: ("response", None, 5)}
    stored = [raw for r in warc.archive_table(spark, f"file://{tmp_path}").collect() for raw in warc.read_archive(r["content"])]
    assert len(stored) == len(rows) and all(raw.startswith(b"WARC/1.1\r\n") for raw in stored)


def test_quality_held_out(spark):
    sf = SF.replace("0.001", "0.01")
    got = QUERIES["op10_quality"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > held["quality"].mean() + 0.05
    assert got["score"].between(0, 1).all()


def test_lm_base_and_model(spark, docs):
    rows = docs.toPandas()
    got = lm.score_texts(docs).toPandas().set_index("doc_id")
    tokens = {i: [*t.encode().lower().split(), b""] for i, t in zip(rows["doc_id"], rows["text"])}
    count = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    total, distinct = sum(count.values()), len(count)
    for i, ws in tokens.items():
        assert got["base_score"][i] == pytest.approx(sum(log10((count[w] + .5) / (total + .5 * (distinct + 1))) for w in ws), rel=1e-9)
        assert (got["n_tokens"][i], got["n_known"][i], got["train_tokens"][i]) == (len(ws), sum(w in count for w in ws), total)
    assert np.isfinite(got["score"]).all() and (got["score"] < 0).all()


def test_lm_trains_on_all_training_texts(spark, monkeypatch):
    """Half a million training words, and no text or word is left out, copies neither."""
    rows = [(i, f"only{i // 2} " + "word " * 700) for i in range(900)]
    got = {}

    class Done(Exception):
        pass

    def spy(texts, counts):
        got["ids"] = np.concatenate([np.frombuffer(r["ids"], np.uint16) for r in texts.collect()])
        got["counts"] = counts
        raise Done

    monkeypatch.setattr(lm, "train", spy)
    with pytest.raises(Done):
        lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"))
    own = [t.encode() for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    coder = lm.Coder(lm.load_ranks())
    want = np.bincount(coder.ids(*coder.codes(own))[0], minlength=lm.IDS)
    assert (np.bincount(got["ids"], minlength=lm.IDS) == want).all() and (got["counts"] == want).all()


def test_coder_has_no_cut():
    """Word by word is as the whole text; a long text has as many ids a word as a short one."""
    import tiktoken

    ranks = lm.load_ranks()
    whole = tiktoken.Encoding("whole", pat_str=lm.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = lm.Coder(ranks)
    texts = [b"Word " * 20_000, None, b"", "It's  a\tt\u00e9st, 3\u00bd \u00a0x\u00a0 ***\n\u4e2d\u6587".encode()]
    ids, sizes = coder.ids(*coder.codes(texts))
    assert sizes.tolist()[1:3] == [1, 1] and (sizes[0] - 1) % 20_000 == 0
    for text, part in zip(texts, np.split(ids, np.cumsum(sizes))):
        plain = "".join(" " + w.decode() for w in lm.words_of(text))
        assert part.tolist() == [*whole.encode_ordinary(plain), lm.END]
    coder.MOST = 5
    assert coder.ids(*coder.codes(texts))[0].tolist() == ids.tolist()  # after it has forgotten


def own_model(rng, spread):
    pairs = rng.integers(0, 9, (lm.HEAD + 2, lm.HEAD + 1)).astype(float)
    model = lm.Model.fresh(rng.integers(0, 50, lm.IDS).astype(float), np.arange(lm.IDS), pairs)
    for name in lm.Model.NAMES:
        model.w[name] += rng.normal(0, spread, model.w[name].shape).astype(np.float32)
    return model


def blocks(model, *texts):
    return model.blocks(np.concatenate(texts).astype(np.uint16), np.array([len(t) for t in texts]))[:3]


def test_lm_is_a_distribution_and_causal():
    model = own_model(np.random.default_rng(0), 0.2)
    table, (inputs, _, goes_on) = model.table(), blocks(model, np.arange(20))
    total = 0.0
    for part in np.array_split(np.arange(lm.IDS, dtype=np.int32), 50):  # each id as the target of the same place
        many, target, on = np.repeat(inputs[:1], len(part), 0), np.full((len(part), lm.BLOCK), -1, np.int32), np.zeros(len(part), bool)
        target[:, 3] = part
        found = model.log_probabilities(table, many, target, on)[:, 3].astype(np.float64)
        assert np.isfinite(found).all()
        total += np.exp(found).sum()
    assert total == pytest.approx(1, abs=1e-3)
    later = inputs.copy()
    later[0, 5:] = 7
    targets = np.full(inputs.shape, 3, np.int32)
    a, b = (model.log_probabilities(table, x, targets, goes_on) for x in (inputs, later))
    assert np.allclose(a[0, :5], b[0, :5]) and not np.allclose(a[0, 5:], b[0, 5:])


def test_lm_scores_do_not_depend_on_the_batch():
    model = own_model(np.random.default_rng(1), 0.2)
    texts = [np.arange(5), np.arange(3 * lm.SCORED_BLOCKS * lm.BLOCK + 7) % 999, np.array([lm.END]), np.arange(lm.BLOCK)]
    together = model.scores(np.concatenate(texts).astype(np.uint16), np.array([len(t) for t in texts]))
    alone = [model.scores(t.astype(np.uint16), np.array([len(t)]))[0] for t in texts]
    assert together == pytest.approx(alone, rel=1e-5)


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    model = own_model(rng, 0.3)
    inputs, targets, goes_on = blocks(model, rng.integers(0, lm.HEAD + 40, 300))
    g, n = model.gradient(inputs, targets, goes_on), (targets >= 0).sum()
    for name in lm.Model.NAMES:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old, loss = model.w[name][at], []
        for step in (0.02, -0.02):
            model.w[name][at] = old + step
            loss.append(-model.log_probabilities(model.table(), inputs, targets, goes_on).sum(dtype=np.float64) / n)
        model.w[name][at] = old
        assert (loss[0] - loss[1]) / 0.04 == pytest.approx(float(g[name][at]), rel=0.1, abs=1e-4)


def test_lm_survives_large_weights():
    model = own_model(np.random.default_rng(2), 60.0)
    ids, sizes = np.arange(300, dtype=np.uint16), np.array([300])
    assert np.isfinite(model.scores(ids, sizes)).all()
    model.train(ids, sizes)
    assert all(np.isfinite(w).all() for w in model.w.values()) and np.isfinite(model.scores(ids, sizes)).all()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_lm_beats_the_base_on_held_out_texts(spark, sf):
    got = QUERIES["op1_lm_scoring"](spark, SF.replace("sf0.001", sf)).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.avg((F.col("score") > F.col("base_score")).cast("int"))).first()
    assert got[0] > got[1] and got[2] > 0.5


def test_lm_scores_are_the_words_mixed(spark, monkeypatch):
    """Against a plain pass over whole texts, whether words are counted in place or joined; repeated rows and odd bytes too."""
    rows = [(i, " ".join(f"w{(i * k * k) % (7 + i)}" for k in range(40)) + (" Łódź \x85x" if i % 4 else "")) for i in range(30)] + [(3, "twice over"), (3, "twice over"), (31, None), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.union(spark.sql("select 40L, cast(concat(cast('odd ' as binary), unhex('FFC3'), cast(' bytes' as binary)) as string)"))
    kept, fit = {}, lm.train

    def spy(*args):
        kept["model"] = fit(*args)
        return kept["model"]

    monkeypatch.setattr(lm, "train", spy)
    texts = [(r["doc_id"], bytes(r["t"] or b"")) for r in docs.selectExpr("doc_id", "cast(text as binary) as t").collect()]
    tokens = [[*t.lower().split(), b""] for _, t in texts]
    count = Counter(w for (i, _), ws in zip(texts, tokens) if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for w in ws)
    base = sum(count.values()) + 0.5 * (len(count) + 1)
    for hot in (lm.HOT, 0.02, 2.0):
        monkeypatch.setattr(lm, "HOT", hot)
        got = sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 4)) for r in lm.score_texts(docs).collect())
        coder, want = lm.Coder(lm.load_ranks()), []
        for (i, text), ws in zip(texts, tokens):
            codes, sizes = coder.codes([text])
            ids, many = coder.ids(codes, sizes)
            inputs, targets, goes_on, _ = kept["model"].blocks(ids, many)
            logs = iter(kept["model"].log_probabilities(kept["model"].table(), inputs, targets, goes_on).ravel().astype(np.float64)[:len(ids)])
            p = [np.exp(sum(next(logs) for _ in range(coder.size[c]))) for c in codes]
            want.append((str(i), len(ws), sum(log10(0.5 * (count[w] + 0.5) / base + 0.5 * x) for w, x in zip(ws, p))))
        want.sort()
        assert [g[:2] for g in got] == [w[:2] for w in want] and [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-3)


def test_bytes_that_are_no_utf8(spark):
    """Texts are read with U+FFFD for odd bytes, payloads archived as they are."""
    body = b"caf\xc3 \xff words " * 80
    texts = spark.createDataFrame([(1, body), (2, body.decode("utf-8", "replace").encode()), (3, b"plain words")], "doc_id long, raw binary").selectExpr("doc_id", "cast(raw as string) as text")
    labels = spark.createDataFrame([(2, 1), (3, 0), (1, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in quality.classify(texts, labels).collect()}
    assert got[1] == pytest.approx(got[2]) and len(got) == 3
    kept = quality.keep_good(texts, labels, threshold=0.0)
    assert {bytes(r["b"]) for r in kept.selectExpr("cast(text as binary) as b").collect()} >= {body}
    pages = texts.selectExpr("doc_id as page_id", "text as url", "text as html")
    digests = {r["page_id"]: (r["payload_digest"], r["payload_bytes"]) for r in warc.archive_pages(pages).collect()}
    assert digests[1] == (hashlib.sha1(body).hexdigest(), len(body)) and len(digests) == 3


def test_pipeline_stages(spark):
    """Each stage against a plain version of its rule, on what the stage before kept."""
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    P_ = lambda stage, df: common.written(stage(spark, df, SF), "stage")  # noqa: E731  as between stages
    good = P_(P.good, docs)
    bad = docs.join(good, "doc_id", "left_anti").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("quality = 1").count()
    assert good.columns == columns and bad == 0
    lines = P_(P.fewer_lines, good)
    one = P_(P.one_of_each, lines)
    assert lines.columns == one.columns == columns and lines.count() == good.count()
    rows = lines.orderBy("doc_id").toPandas()
    label = labels_of([fingerprint(t) for t in rows["text"]])
    assert {r["doc_id"] for r in one.collect()} == {int(rows["doc_id"][i]) for i in set(label.tolist())}
    clean = P_(P.clean, one)
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(i in " ".join(r["text"].lower().split()) for r in clean.collect() for i in items)
    assert P.run(spark, SF).groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2


def buckets_by_hand(text):
    """op10's n-grams, one at a time."""
    data, mix, keys = (text or "").encode(), 2654435761, set()
    for i in range(len(data) - 2):
        keys.add(int.from_bytes(data[i:i + 3], "little"))
    for i in range(len(data) - 3):
        keys.add(int.from_bytes(data[i:i + 4], "little") ^ 0x5BD1E995)
    words = data.split()
    mark = [(words[i] == words[i - 1]) + 2 * (words[i] == words[i - 2]) for i in range(2, len(words))]
    for i in range(len(mark) - 2):
        keys.add(mark[i] + 4 * mark[i + 1] + 16 * mark[i + 2] + 0xFFFF0000)
    return sorted({(k * mix % 2**32) >> 15 for k in keys})


def test_quality_against_brute_force(spark, docs):
    """Ratios and scores by hand; the hinge-loss model is the optimum that exhaustive descent over the kernel finds."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    own = docs.join(labels, "doc_id").where(common.crc_mod5(F.col("doc_id")) != 0).select("text", "quality", F.xxhash64(F.lit(72), "doc_id").alias("at")).toPandas()
    own = own[own["quality"].isin([0, 1])].sort_values(["at", "quality"], kind="stable")
    found, y = [buckets_by_hand(t) for t in own["text"]], own["quality"].to_numpy()
    counts = np.ones((2, quality.TABLE))
    for b, label in zip(found, y):
        counts[label, b] += 1
    ratio = np.log(counts[1] / counts[1].sum() / (counts[0] / counts[0].sum()))
    model = quality.fit(docs, labels)
    assert np.allclose(model.ratio, ratio)

    fitted = np.arange(len(y)) % 5 != 4
    x = np.zeros((int(fitted.sum()), quality.TABLE))
    for i, at in enumerate(np.flatnonzero(fitted)):
        x[i, found[at]] = ratio[found[at]]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    sign = np.where(y[fitted] == 1, 1.0, -1.0)
    kernel, a = (x @ x.T) * np.outer(sign, sign), np.zeros(len(sign))
    for _ in range(1000):
        for i in range(len(a)):
            a[i] = min(max(a[i] - (kernel[i] @ a - 1) / max(kernel[i, i], 1e-12), 0.0), quality.C)
    loss = lambda w: w @ w / 2 + quality.C * np.maximum(0, 1 - sign * (x @ w)).sum()
    assert loss(model.weights) <= 1.01 * loss(x.T @ (a * sign)) + 1e-6

    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality.classify(docs, labels).collect():
        b = buckets_by_hand(texts[r["doc_id"]])
        length = np.sqrt((ratio[b] ** 2).sum())
        margin = (ratio[b] * model.weights[b]).sum() / max(length, 1e-9)
        assert abs(r["score"] - 1 / (1 + np.exp(-(model.slope * margin + model.offset)))) < 1e-9
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3)


def targets_by_hand(sizes, weights=(3, 1, 2)):
    """Water-filling over {source: words}: what stands above its cap is clamped, the rest is shared anew, until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, target, rest = {s: weights[i % 3] for i, s in enumerate(names)}, {}, 1.5 * sum(sizes.values())
    while True:
        left = [s for s in names if s not in target]
        share = {s: rest * weight[s] / sum(weight[t] for t in left) for s in left}
        over = [s for s in left if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]


def pipeline_table(spark, folder, rows, bench, labels):
    names = "doc_id long, text string, source string, number int, __fp int, copy_no int, draw int"
    spark.createDataFrame([(*r, i, 1, 2, 3) for i, r in enumerate(rows)], names).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return f"file://{folder}"


def test_pipeline_against_brute_force(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing names: each stage's rows, and the mix, are those of plain loops.

    All labels are 1, so that the classifier, which has a test of its own, rejects nothing.
    """
    import corpus_pipeline as P

    rng = np.random.default_rng(21)
    words = [f"t{i}" for i in range(400)]
    line = lambda n: " ".join(rng.choice(words, n))
    bench, rows = [(1, line(12)), (2, None), (3, "")], []
    for i in range(40):
        rows.append((i, "\n".join(line(int(rng.integers(8, 40))) for _ in range(4)), ["a", "b", None][i % 3]))
    rows += [(50, rows[3][1], "a"), (51, rows[4][1] + "\n" + line(9), "b"), (52, f"{line(20)} {bench[0][1]} {line(20)}", "a"), (53, None, "b"), (54, "", None),
             (55, " \t\n ", "a"), (56, line(20_000), "a"), (57, rows[7][1].split("\n")[0] + " more\n" + line(30), "b"), (None, rows[9][1], "a"), (None, line(25), "b")]
    folder = pipeline_table(spark, tmp_path, rows, bench, [(i, 1) for i in range(40)])

    by = {(i, r[0], r[1]) for i, r in enumerate(rows)}
    left = [(i, doc, text) for (i, _, _), (doc, text) in zip(sorted(by, key=lambda r: r[0]), lines_by_hand([r[:2] for r in rows]))]
    left.sort(key=lambda r: (r[1] is None, r[1] or 0))
    label = labels_of([fingerprint(t) for _, _, t in left])
    left = [r for k, r in enumerate(left) if label[k] == k]
    known = decontam.Words()
    item = decontam.word_ids(bench[0][1].encode(), known)
    far = lambda t: decontam.edit_distance(item, decontam.word_ids((t or "").encode(), known)) > decontam.allowed(len(item))
    left = [r for r in left if far(r[2])]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for _, stage in P.STAGES[:-1]:
        docs = common.written(stage(spark, docs, folder), "stage")
        assert docs.columns == columns
    assert sorted((r["number"], r["doc_id"], r["text"]) for r in docs.collect()) == sorted(left)

    mixed = P.run(spark, folder)
    assert mixed.columns == [*columns, "copy_no_"]
    taken = Counter(r["number"] for r in mixed.collect())
    size = {i: len((text or "").split()) for i, _, text in left}
    assert set(taken) <= set(size) and max(taken.values()) <= 2
    sizes = Counter()
    for i in size:
        sizes[rows[i][2]] += size[i]
    for s, target in targets_by_hand(sizes).items():
        own = [i for i in size if rows[i][2] == s]
        assert abs(sum(taken[i] * size[i] for i in own) - target) <= max(size[i] for i in own)


def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline as P

    folder = pipeline_table(spark, tmp_path, [], [], [])
    assert P.run(spark, folder).count() == 0
