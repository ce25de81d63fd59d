"""Spelling variants and MinHash near-dedup against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF
from lodeframe.llm import minhash, spelling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, word string, n long, key string"


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def variants_of(rows, least=6, most=5, ratio=5, noise=199):
    """word: (form, root, n, n_near, form_n), by comparing every two words."""
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= least and n >= most}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if distance_one(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {w: (form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def found(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def made_up(seed, letters, size, longest):
    """Words over few letters, so that most have near ones, each some times."""
    draw = random.Random(seed)
    words = ["".join(draw.choices(letters, k=draw.randint(6, longest))) for _ in range(size)]
    words += [w[:i] + w[i + 1:] for w in words for i in (0, len(w) // 2, len(w) - 1)] + [w * 2 for w in words[:20]] + ["a" * k for k in range(6, 40)]
    return [(i, " ".join(draw.choices(words, k=400))) for i in range(60)]


@pytest.mark.parametrize("letters, longest, crowd", [("ab", 9, 10 ** 6), ("ab", 12, 40), ("abÿé", 10, 300), ("a", 12, 1)])
def test_variants(spark, letters, longest, crowd):
    rows = made_up(5, letters, 120, longest)
    docs = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], DOCS)
    assert found(spelling.variant_groups(docs, crowd=crowd)) == variants_of(rows)


def test_variants_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(spelling.variant_groups(docs)) == variants_of([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_variants_of_odd_rows(spark):
    rows = [(1, "Éclairs éclairs ÉCLAIRS"), (2, None), (3, ""), (None, "letters " * 30 + "lettters " * 5), (4, "letters_letters1letters"), (4, "x" * 3000 + " " + "word " * 4000)] * 3
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS)
    got = found(spelling.variant_groups(docs, noise=0))
    assert got == variants_of(rows, noise=0)
    assert got["lettters"][:2] == ("letters", "letters")
    assert spelling.variant_groups(docs.limit(0)).count() == 0
    bad = docs.selectExpr("doc_id", "cast(concat(cast(repeat('before ', 9) as binary), unhex('FF'), cast(' behind' as binary)) as string) as text")
    assert set(found(spelling.variant_groups(bad, noise=0))) == {"before", "behind"}
    with pytest.raises(ValueError):
        spelling.variant_groups(docs, ratio=1)


def test_chains_of_forms_end_at_the_last(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125}
    docs = spark.createDataFrame([(1, f"{w} " * n) for w, n in words.items()], "doc_id long, text string")
    got = found(spelling.variant_groups(docs, noise=0))
    assert {w: r[1] for w, r in got.items()} == dict.fromkeys(words, "aabbbb")


@pytest.mark.parametrize("letters", ["ab", "abc", "abcdefgh"])
def test_an_automaton_numbers_its_words(letters):
    draw = random.Random(1)
    words = sorted({"".join(draw.choices(letters, k=draw.randint(0, 8))) for _ in range(300)})
    machine = spelling.Automaton(words)
    for number, word in enumerate(words):
        hit: set = set()
        machine._rest(word, 0, machine.root, 0, hit)
        assert hit == {number}
        for exact in (0, len(word) // 2):
            assert machine.near(word, exact) == {k for k, v in enumerate(words) if distance_one(word, v) and v[:exact] == word[:exact]}
    keys = [(f, tuple(s.items())) for f, s in zip(machine.final, machine.steps)]
    assert len(keys) == len(set(keys))  # no two states go on alike


def shingles(text, width=4):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOW)) if w]
    return {" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def linked(rows, percent=80, width=4):
    """Row: (set size, component, kept), by comparing every two rows."""
    sets = [shingles(t, width) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc, _), s, x in zip(rows, sets, label):
        if doc is not None:
            least[x] = min(least.get(x, doc), doc)
    return sorted((doc is None, doc or 0, len(s), str(c := least.get(x) if s else doc), doc == c) for (doc, _), s, x in zip(rows, sets, label))


def got_of(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], str(r["component_id"]), r["kept"]) for r in df.collect())


def near_copies(seed, n, length, changed, groups=1):
    draw, out = random.Random(seed), []
    for g in range(groups):
        base = [f"w{draw.randint(0, 9999)}" for _ in range(length)]
        for i in range(n):
            words = list(base)
            for at in draw.sample(range(length), draw.randint(0, changed)):
                words[at] = f"n{draw.randint(0, 99999)}"
            out.append((g * n + i, " ".join(words)))
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("rows, block", [(near_copies(1, 120, 150, 6), 400_000), (near_copies(2, 150, 100, 9), 1500), (near_copies(3, 5, 60, 3, 40), 400_000), (near_copies(4, 40, 9, 1, 4), 60)])
def test_near_copies(spark, rows, block):
    """The groups hold pairs on both sides of the bound, and buckets whose least document is linked with none of the others."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_of(minhash.near_dedup(docs, block=block)) == linked(rows)


def test_near_dedup_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got_of(minhash.near_dedup(docs)) == linked([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_near_dedup_of_odd_rows(spark):
    same = "the cat sat on the mat today and slept"
    rows = [(1, same), (2, None), (3, ""), (4, same.upper()), (None, same), (5, "\t\n "), (6, "one two"), (7, "One  two"), (8, "two one"), (None, "alone here for once and all"),
            (1, same), (9, "long " * 3000 + "words " * 3000), (-3, "É é"), (10, "é é")]
    docs = spark.createDataFrame([(d, t, "a", 1, "b") for d, t in rows], "doc_id long, text string, number string, n long, digest string")
    assert got_of(minhash.near_dedup(docs)) == linked(rows)
    assert minhash.near_dedup(docs.limit(0)).count() == 0
    named = spark.createDataFrame([("b", same), ("a", same), (None, "x")], "doc_id string, text string")
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_dedup(named).collect()} == {("b", "a", False), ("a", "a", True), (None, None, True)}


def test_signatures_agree_as_often_as_sets_overlap():
    draw = np.random.default_rng(3)
    values = np.unique(draw.integers(0, 1 << 63, 4000).astype(np.uint64))
    for share in (0.3, 0.6, 0.9):
        k = int(2000 * 2 * share / (1 + share))
        a, b = values[:2000], values[2000 - k:4000 - k]
        agree = np.mean([np.mean(minhash.signature(a + np.uint64(s), 200) == minhash.signature(b + np.uint64(s), 200)) for s in range(0, 60, 6)])
        assert agree == pytest.approx(share, abs=0.05)


def test_blocks_give_the_forest_of_all_links():
    draw = random.Random(8)
    sets = [np.unique(np.array([draw.randint(0, 30) for _ in range(20)], np.uint64)) for _ in range(80)]
    label = list(range(80))
    for a, b in minhash._forest(list(range(80)), list(range(80)), sets, 80):
        assert label[a] != label[b]
        label = [label[a] if x == label[b] else x for x in label]
    for i in range(80):
        for j in range(i):
            inter = len(np.intersect1d(sets[i], sets[j]))
            if 100 * inter >= 80 * len(np.union1d(sets[i], sets[j])):
                assert label[i] == label[j]
