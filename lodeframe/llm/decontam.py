"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact edit verification.

An item leaks into a document if some passage of it is within `ratio` of the item's length in word edits
(0.2: similar to 0.8 or more). Words are compared lower-cased and without punctuation at their ends.

A window as long as the item is embedded by the random walk of Chakraborty, Goldenberg and Koucky: step j
copies the word under the pointer and moves on or stays by a coin that depends on (j, word), so that edit
distance becomes Hamming distance. Each of WALKS walks is sampled several times at WIDTH steps: a window is a
candidate if for one sample all WIDTH steps agree with the item's. Where a share AGREE of the steps agrees, as many samples as
`samples_of` says find the window with the probability RECALL. The windows that are embedded are those
that agree with the item in q words in a row, at as many of the same places as a passage within k edits
must keep (see `run_length` and `least_hits`), so this loses none. Candidates are verified by exact edit distance to the best passage.

The benchmark is a stated query set: it is read in blocks of at most BLOCK_BYTES, whose tables are
what executors get; documents are read once a block and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATIO, GRAM = 0.2, 3
#: A walk stays or moves on by a coin, so n words take about 2 n steps; only those before 1.5 n are sampled, where no window has ended.
WALKS, WIDTH, STEPS_PER_WORD = 12, 3, 1.5
#: The probability to find a window of which a share AGREE of the steps agrees. At the full edit bound the share differs from walk to walk:
#: many walks even that out, and AGREE is below their mean for items of 5 to 100 words.
RECALL, AGREE = 0.99, 0.25
BLOCK_BYTES = 16 << 20
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """word -> a 63-bit number, or -1 for punctuation only; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        core = word.strip(PUNCTUATION)
        self[word] = value = xxhash.xxh64_intdigest(core.decode("utf-8", "replace").lower(), 3) >> 1 if core else -1
        return value


def word_ids(text: bytes | None, known: Words) -> np.ndarray:
    """A number a word; words of punctuation only are left out."""
    words = (text or b"").lower().split()
    out = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    return out[out >= 0].astype(np.uint64)


def grams(ids: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q words from each position on."""
    n = len(ids) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, q, np.uint64)
    for i in range(q):
        h = (h ^ ids[i:i + n]) * _FACTOR
        h ^= h >> np.uint64(29)
    return h


def allowed(n: int, ratio: float = RATIO) -> int:
    return int(n * ratio)


def run_length(n: int, k: int) -> int:
    """Words in a row that survive k edits of n words, at most GRAM."""
    return max(1, min(GRAM, -(-(n - k) // (k + 1))))


def least_hits(n: int, k: int, q: int) -> int:
    """Of the n - q + 1 grams of an item, k edits break at most k q; the rest line up in at most k + 1 shifts."""
    return max(1, -(-(n - q + 1 - k * q) // (k + 1)))


def steps_of(n: int) -> int:
    return max(1, int(STEPS_PER_WORD * n))


def samples_of(recall: float = RECALL, agree: float = AGREE) -> int:
    """Samples a walk, so that all walks' samples miss with a probability of at most 1 - recall."""
    return -(-math.ceil(math.log(1 - recall) / math.log(1 - agree ** WIDTH)) // WALKS)


def embed(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int, walk: int) -> np.ndarray:
    """The walk's output for windows of n words from `starts`, cut at `ends`: steps x windows; past the end: 0."""
    padded = np.append(text, np.zeros(1, np.uint64))
    at, out = starts.astype(np.int64), np.empty((steps_of(n), len(starts)), np.uint64)
    end = np.minimum(starts + n, ends)
    for j in range(len(out)):
        symbol = padded[np.where(at < end, at, len(text))]
        out[j] = symbol
        coin = (symbol + np.uint64((walk << 32) + j + 1)) * _FACTOR
        at = at + ((coin >> np.uint64(40)) & np.uint64(1)).astype(np.int64)
    return out


def sampled_positions(n: int) -> list[tuple[int, np.ndarray]]:
    """(walk, its samples' steps) for windows of n words; the same everywhere."""
    rng = np.random.default_rng(n)
    return [(w, rng.integers(0, steps_of(n), (samples_of(), WIDTH))) for w in range(WALKS)]


def edit_distance(item: np.ndarray, text: np.ndarray) -> int:
    """Word edits from the item to the passage of `text` that is nearest to it."""
    row, step = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    for i, w in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (text != w), row[1:] + 1)
        row = np.minimum.accumulate(new - step) + step
    return int(row.min())


class Index:
    """A block of benchmark items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, bytes]], ratio: float) -> None:
        self.items, self.hits, keys, self.known = [], [], {}, Words()
        for item_id, text in items:
            ids = word_ids(text, self.known)
            n = len(ids)
            if not n:
                continue
            k = allowed(n, ratio)
            q, number = run_length(n, k), len(self.items)
            self.items.append((item_id, ids, k, []))
            self.hits.append(least_hits(n, k, q))
            for at, g in enumerate(grams(ids, q).tolist()):
                keys.setdefault(q, []).append((g, number, at))
        self._sample()
        self.tables = {}
        for q, rows in keys.items():
            rows.sort()
            gram, number, at = (np.array(c, t) for c, t in zip(zip(*rows), (np.uint64, np.int64, np.int64)))
            seen = np.zeros(1 << 22, bool)
            seen[gram >> np.uint64(42)] = True
            self.tables[q] = (gram, number, at, seen)

    def _sample(self) -> None:
        """Each item's samples; items of equal length are embedded together."""
        same: dict[int, list[int]] = {}
        for number, (_, ids, _, _) in enumerate(self.items):
            same.setdefault(len(ids), []).append(number)
        for n, numbers in same.items():
            text, starts = np.concatenate([self.items[i][1] for i in numbers]), np.arange(len(numbers)) * n
            for walk, where in sampled_positions(n):
                want = embed(text, starts, starts + n, n, walk)[where]
                for j, number in enumerate(numbers):
                    self.items[number][3].append((walk, where, want[:, :, j]))

    def _windows(self, ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item number, start) of the windows to embed; first, last: the bounds of each word's document."""
        numbers, starts = [], []
        for q, (keys, number, place, seen) in self.tables.items():
            g = grams(ids, q)
            at = np.flatnonzero(seen[g >> np.uint64(42)])
            at = at[at + q <= last[at]]
            low, high = np.searchsorted(keys, g[at]), np.searchsorted(keys, g[at], "right")
            many = high - low
            at, slot = np.repeat(at, many), np.repeat(low, many)
            slot = slot + np.arange(len(slot)) - np.repeat(np.cumsum(many) - many, many)
            numbers.append(number[slot])
            starts.append(np.maximum(at - place[slot], first[at]))
        if not numbers:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        width = np.int64(len(ids) + 1)
        both, times = np.unique(np.concatenate(numbers) * width + np.concatenate(starts), return_counts=True)
        both = both[times >= np.array(self.hits, np.int64)[both // width]]
        return both // width, both % width

    def find(self, texts: list[bytes | None]) -> list[tuple[int, int, int, int]]:
        """(text number, item, edits, word number of the window) of every item that leaks into a text."""
        parts = [word_ids(t, self.known) for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        ids = np.concatenate([*parts, np.zeros(0, np.uint64)])
        ends = np.cumsum(sizes)
        first, last = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
        numbers, starts = self._windows(ids, first, last)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        cut = np.flatnonzero(np.diff(numbers)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(starts)]):
            if a == b:
                continue
            item_id, words, k, samples = self.items[int(numbers[a])]
            n, at = len(words), starts[a:b]
            passed = np.zeros(len(at), bool)
            for walk, where, want in samples:
                left = np.flatnonzero(~passed)
                if not len(left):
                    break
                out = embed(ids, at[left], last[at[left]], n, walk)
                passed[left] = (out[where] == want[:, :, None]).all(axis=1).any(axis=0)
            for s in at[passed].tolist():
                low, high = int(first[s]), int(last[s])
                d = edit_distance(words, ids[max(low, s - k):min(high, s + n + k)])
                row = int(np.searchsorted(ends, s, "right"))
                if d <= k and (d, s - low) < best.get((row, int(numbers[a])), (k + 1, 0)):
                    best[row, int(numbers[a])] = (d, s - low)
        return [(row, self.items[number][0], d, s) for (row, number), (d, s) in sorted(best.items())]


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, most: int = BLOCK_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of at most `most` bytes of text; the driver holds one block at a time."""
    block, size = [], 0
    rows = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("string").cast("binary").alias("t")) \
        .where("t is not null").orderBy("i", "t")
    for row in rows.toLocalIterator():
        if block and size + len(row["t"]) > most:
            yield block
            block, size = [], 0
        block.append((row["i"], bytes(row["t"])))
        size += len(row["t"])
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", ratio: float = RATIO) -> DataFrame:
    """One row for each (row, item) that leaks: id_col, item_col, edits, at (the window's first word).

    Defined results: null and wordless texts and items leak nothing; items whose text repeats are each
    reported; rows that repeat are each reported; a null item identifier stays null. Empty tables give
    no rows. Other columns are ignored, whatever their names.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").cast("binary").alias("__text"))
    schema, out = f"__id {kind}, __item long, edits long, at long", None
    for block in blocks_of(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, ratio)
            for batch in batches:
                rows = index.find(batch.column(1).to_pylist())
                if rows:
                    n, item, edits, at = zip(*rows)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(n)), pa.array(item, pa.int64()),
                                                      pa.array(edits, pa.int64()), pa.array(at, pa.int64())],
                                                     ["__id", "__item", "edits", "at"])

        part = texts.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.select(F.col("__id").alias(id_col), F.col("__item").alias(item_col), "edits", "at")


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_text_col: str = "text",
               item_col: str = "item_id", ratio: float = RATIO) -> DataFrame:
    """The rows, with all their columns, into which no item leaks. Judged where the row is: nothing is shuffled.

    Defined results: null and wordless texts stay, and such items judge nothing; rows that repeat, or whose identifier is
    null, are judged alike; empty tables give no rows, an empty benchmark keeps all. No column's name matters.
    """
    spark, out = docs.sparkSession, docs
    for block in blocks_of(benchmark, item_col, item_text_col):
        leaked = _leaked(spark.sparkContext.broadcast(block), ratio)
        out = out.where(~leaked(F.col(text_col).cast("string").cast("binary")))
    return out


def _leaked(shared, ratio: float):
    @F.pandas_udf("boolean")
    def leaked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(shared.value, ratio)
        for batch in batches:
            out = np.zeros(len(batch), bool)
            out[[row for row, *_ in index.find(list(batch))]] = True
            yield pd.Series(out)

    return leaked
