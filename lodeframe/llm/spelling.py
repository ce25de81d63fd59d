"""Spelling variant grouping: words one code point apart, by a forward and a backward automaton.

Of two words one error apart, the shorter with m code points, either the first m div 2 code points are
the same or the last m - m div 2 are. Spark deals the words by that half, once by the first and once by
the last; a task builds minimal acyclic automata of the words it was dealt, one of them spelled forward
and one spelled backward. A look-up walks the half exactly and completes the other half with one error.
A word's number in an automaton is its place among the sorted words, so that counts are an array.

A pair is found in one half only: the length d of its common beginning tells which. A half that very many
words share is halved again, by the same rule on what is left, until it is small or one code point is left.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MIN_LENGTH, MIN_COUNT, RATIO, NOISE = 6, 5, 5, 199
#: Code points of the words that share a half, above which the half is halved again; also those of an automaton.
CROWD = 400_000
#: Distinct words that a task counts before it hands them on.
HELD = 200_000
_LETTERS = "[A-Za-zÀ-ÿ]"


def runs_of(text: bytes, doc: str, least: int = MIN_LENGTH, noise: int = NOISE) -> Counter:
    """The runs of letters, A-Z lower-cased, with their counts; one code point less where crc32 says so, shorter ones left out."""
    seed, out = zlib.crc32(f"{doc}:".encode()), Counter()
    # A run that is too short before a deletion is too short behind it.
    for run, n in Counter(re.findall(f"{_LETTERS}{{{least},}}", text.lower().decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), seed)
        if noise and h % noise == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH, noise: int = NOISE) -> DataFrame:
    """word, n of every run; counted in the tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                if text.is_valid:
                    for word, n in runs_of(text.as_py(), doc.as_py() or "", least, noise).items():
                        held[word] += n
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    texts = docs.select(F.col(id_col).cast("string").alias("__id"), F.col(text_col).cast("string").cast("binary").alias("__text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Automaton:
    """The minimal acyclic automaton of sorted, distinct words. A step is (words before it, next state), so the steps of a word add up to its number."""

    def __init__(self, words: list[str]) -> None:
        self.steps: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self._sizes: list[int] = []
        known: dict = {}
        ends, edges, last = [False], [[]], ""

        def close(depth: int) -> None:
            """Settle the open states deeper than depth: each becomes a known state that goes on alike, or a new one."""
            while len(edges) > depth + 1:
                state = self._state(known, ends.pop(), edges.pop())
                edges[-1].append((last[len(edges) - 1], state))

        for word in words:
            same = 0
            while same < len(last) and same < len(word) and last[same] == word[same]:
                same += 1
            close(same)
            ends += [False] * (len(word) - same)
            edges += [[] for _ in range(len(word) - same)]
            ends[-1], last = True, word
        close(0)
        self.root = self._state(known, ends.pop(), edges.pop())

    def _state(self, known: dict, final: bool, edges: list[tuple[str, int]]) -> int:
        key = (final, *edges)
        if key not in known:
            size, steps = int(final), {}
            for label, target in edges:
                steps[label] = (size, target)
                size += self._sizes[target]
            known[key] = len(self.steps)
            self.steps.append(steps), self.final.append(final), self._sizes.append(size)
        return known[key]

    def _rest(self, word: str, at: int, state: int, number: int, found: set[int]) -> None:
        """Adds the number of the word that goes on from the state with word[at:], if there is one."""
        steps = self.steps
        for i in range(at, len(word)):
            step = steps[state].get(word[i])
            if step is None:
                return
            number += step[0]
            state = step[1]
        if self.final[state]:
            found.add(number)

    def near(self, word: str, exact: int) -> set[int]:
        """Numbers of the words exactly one error from word that begin with its first `exact` code points.

        In a run of one letter an insertion or a deletion is tried at its end only, which gives the same words.
        """
        state, number, found, n = self.root, 0, set(), len(word)
        for i in range(n + 1):
            own, here = word[i] if i < n else None, self.steps[state]
            if i >= exact:
                for label, (before, target) in here.items():
                    if label != own:
                        self._rest(word, i, target, number + before, found)
                        if own is not None:
                            self._rest(word, i + 1, target, number + before, found)
                if own is not None and word[i + 1:i + 2] != own:
                    self._rest(word, i + 1, state, number, found)
            step = here.get(own)
            if step is None:
                break
            number += step[0]
            state = step[1]
        return found


def _same(a: str, b: str) -> int:
    """The length of the common beginning."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


def _answers(rows: list[tuple], back: bool) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, the largest count among them, the word that has it) of rows (word, n, m, p, s, u) dealt by one kind of half."""
    turned = (lambda w: w[::-1]) if back else (lambda w: w)
    count = {turned(r[0]): r[1] for r in rows}
    words = sorted(count)
    machine = Automaton(words)
    for word, _, m, p, s, u in rows:
        n_near, best = 0, None
        for number in machine.near(turned(word), s if back else p):
            other = words[number]
            plain = turned(other)
            if min(len(word), len(plain)) == m and p <= _same(word, plain) < u:
                n_near += 1
                rank = (-count[other], plain)
                best = rank if best is None else min(best, rank)
        if n_near:
            yield word, n_near, -best[0], best[1]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows key, back, word, n, m, p, s, u in the order of the key; an automaton ends where a key does."""
    held: tuple[list, list] = ([], [])
    size, key = 0, None

    def out() -> pa.RecordBatch:
        found = [x for back in (False, True) if held[back] for x in _answers(held[back], back)]
        columns = zip(*found) if found else ([], [], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "n_near", "best_n", "best"])

    for batch in batches:
        for k, back, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key and size > CROWD:
                yield out()
                held[0].clear(), held[1].clear()
                size = 0
            key = k
            held[back].append(tuple(row))
            size += len(row[0])
    if size:
        yield out()


def _keyed(rows: DataFrame) -> DataFrame:
    """rows with the key of the code points that must be the same: the first p and the last s."""
    return rows.withColumn("key", F.xxhash64("m", "p", "s", F.expr("substring(word, 1, p)"), F.expr("right(word, s)")))


def halves(words: DataFrame, least: int = MIN_LENGTH, crowd: int = CROWD) -> DataFrame:
    """key, back, word, n, m, p, s, u: every word under both halves, with partners of its own length and longer, and with shorter ones.

    u: partners of this row have a common beginning shorter than that; longer ones are found under the other half.
    """
    at = words.select("word", "n", F.explode(F.expr(f"filter(array(char_length(word), char_length(word) - 1), x -> x >= {least})")).alias("m"))
    sides = F.array(F.struct(F.lit(False).alias("back"), F.expr("m div 2").cast("int").alias("p"), F.lit(0).alias("s"), (F.col("m") + 1).alias("u")),
                    F.struct(F.lit(True).alias("back"), F.lit(0).alias("p"), F.expr("m - m div 2").cast("int").alias("s"), F.expr("m div 2").cast("int").alias("u")))
    rows = _keyed(at.select("word", "n", "m", F.explode(sides).alias("x")).select("word", "n", "m", "x.*"))
    while True:
        crowded = written(rows.groupBy("key").agg(F.sum(F.char_length("word")).alias("size"), F.max(F.expr("m - p - s")).alias("open"))
                          .where((F.col("size") > crowd) & (F.col("open") > 1)), "crowded")
        if crowded.isEmpty():
            return rows
        finer = rows.join(crowded, "key", "left_semi").withColumn("q", F.expr("(m - p - s) div 2").cast("int"))
        sides = F.array(F.struct((F.col("p") + F.col("q")).alias("p"), F.col("s"), F.col("u")),
                        F.struct(F.col("p"), F.expr("m - p - q").cast("int").alias("s"), (F.col("p") + F.col("q")).alias("u")))
        finer = finer.select("back", "word", "n", "m", F.explode(sides).alias("x")).select("word", "n", "m", "back", "x.*")
        rows = written(rows.join(crowded, "key", "left_anti").unionByName(_keyed(finer)), "halves")


def near_words(words: DataFrame, least: int = MIN_LENGTH, crowd: int = CROWD) -> DataFrame:
    """word, n_near, best_n, best of the words (word, n) that have a near one; best: of the largest count, the first of equal ones."""
    rows = halves(words, least, crowd).select("key", "back", "word", "n", "m", "p", "s", "u")
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("rank"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.rank")).alias("best_n"), F.col("b.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of forms (word, form), by pointer doubling: counts grow along a chain, so chains are short and have an end."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("mid"), F.col("root").alias("further"))
        now = written(now.join(ahead, F.col("root") == F.col("mid"), "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variant_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                   ratio: int = RATIO, noise: int = NOISE, crowd: int = CROWD) -> DataFrame:
    """One row per word of at least `least` letters and `min_count` occurrences: word, n, n_near, form, form_n, root.

    form: the most frequent word one code point away, if it occurs at least `ratio` times as often; root: the last of the chain
    of forms. noise: the share of runs, one in so many, that lose a code point chosen by crc32 of `<identifier>:<run>`; 0: none.

    Defined results: null and empty texts have no words; a null identifier counts as the empty text in the
    crc32; bytes that are no UTF-8 end a run; repeated rows count as often as they occur; of near words of equal count
    the first in code-point order is the form. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    if ratio < 2:
        raise ValueError("a form must occur at least twice as often, or chains of forms need not end")
    words = written(word_counts(docs, id_col, text_col, least, noise).where(F.col("n") >= min_count), "words")
    near = near_words(words, least, crowd)
    form = (F.col("best_n") >= F.col("n") * ratio)
    rows = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                   F.when(form, F.col("best")).alias("form"), F.when(form, F.col("best_n")).alias("form_n"))
    rows = written(rows, "forms")
    roots = _roots(rows.where(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
