"""Quality classifier: Naive Bayes support vectors.

n-gram indicators are scaled by the class log-count ratio r = log((p/|p|) / (q/|q|)), brought to unit
length, and a linear hinge-loss model is fitted to them by dual coordinate descent. The n-grams are
character 3- and 4-grams of the UTF-8 bytes and 3-grams over the row of "this word repeats the one
before / before that" marks. All are hashed to TABLE buckets, so every model has the same size.

The classifier is fitted on a bounded sample of the labelled rows, drawn by a hash of the identifier:
the ratios on about COUNT_DOCS rows at most, by one aggregation with map-side sums, and the hinge-loss
model, on the driver, on about SAMPLE_DOCS of those; a fifth of them is held back to turn margins into
probabilities. As the sample's labels have a size bound they are broadcast, and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod5, written

TABLE = 1 << 17
COUNT_DOCS, SAMPLE_DOCS = 16_000, 6000
C, ROUNDS = 1.0, 20
THRESHOLD = 0.3
_MIX = np.uint32(2654435761)  # Knuth's multiplicative hash


class Featurizer:
    """Sorted distinct buckets of a text; holds one scratch table."""

    def __init__(self) -> None:
        self.seen = np.zeros(TABLE, bool)

    def __call__(self, text: str | None) -> np.ndarray:
        data = (text or "").encode("utf-8", "replace")
        seen, raw = self.seen, np.frombuffer(data, np.uint8).astype(np.uint32)
        if len(raw) >= 3:
            three = raw[:-2] | (raw[1:-1] << np.uint32(8)) | (raw[2:] << np.uint32(16))
            seen[(three * _MIX) >> np.uint32(15)] = True
            four = three[:-1] | (raw[3:] << np.uint32(24))
            seen[((four ^ np.uint32(0x5BD1E995)) * _MIX) >> np.uint32(15)] = True
        words = data.split()
        if len(words) >= 3:
            ids = np.fromiter(map(hash, words), np.int64, len(words))
            mark = (ids[2:] == ids[1:-1]) * np.uint32(1) + (ids[2:] == ids[:-2]) * np.uint32(2)
            if len(mark) >= 3:
                marks = mark[:-2] + 4 * mark[1:-1] + 16 * mark[2:]
                seen[((np.unique(marks).astype(np.uint32) + np.uint32(0xFFFF0000)) * _MIX) >> np.uint32(15)] = True
        out = np.flatnonzero(seen)
        seen[out] = False
        return out


@dataclass
class Model:
    ratio: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def margin(self, buckets: np.ndarray) -> float:
        if not len(buckets):
            return 0.0
        r = self.ratio[buckets]
        return float(r @ self.weights[buckets] / max(np.sqrt(r @ r), 1e-9))

    def score(self, buckets: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(buckets) + self.offset, -500, 500))))


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float = C, rounds: int = ROUNDS,
            seed: int = 5) -> np.ndarray:
    """min |w|^2/2 + cost * sum hinge(y w.x), by coordinate descent on the dual; rows hold buckets, values theirs."""
    w, a, rng = np.zeros(TABLE), np.zeros(len(rows)), np.random.default_rng(seed)
    square = np.array([v @ v for v in values]) if rows else np.zeros(0)
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(len(rows)):
            if square[i] <= 0:
                continue
            g = y[i] * (w[rows[i]] @ values[i]) - 1
            new = min(max(a[i] - g / square[i], 0.0), cost)
            if new != a[i]:
                w[rows[i]] += (new - a[i]) * y[i] * values[i]
                most = max(most, abs(new - a[i]))
                a[i] = new
        if most < 1e-3:
            break
    return w


def calibrate(margins: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins, by damped Newton steps."""
    if not len(labels):
        return 1.0, 0.0
    up, down = labels.sum(), len(labels) - labels.sum()
    t = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    ab = np.array([1.0, np.log((up + 1) / (down + 1))])
    x = np.stack([margins, np.ones_like(margins)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(ab @ x, -30, 30)))
        grad, weight = x @ (p - t) + 1e-3 * ab, np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * weight) @ x.T + 1e-3 * np.eye(2), grad)
        ab = ab - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return float(ab[0]), float(ab[1])


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> tuple[DataFrame, int]:
    """__id, __text, __y, __draw of about `most` training rows; labels that are null, or neither 0 nor 1, teach nothing.

    The limit of twice the expected size only guards the broadcast; a draw does not come near it.
    """
    marks = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")) \
        .where(F.col("__y").isin(0, 1) & F.col("__id").isNotNull() & (crc_mod5(F.col("__id")) != 0))
    total = marks.count()
    share = min(1.0, most / max(1, total))
    marks = marks.withColumn("__draw", F.pmod(F.xxhash64(F.lit(71), "__id"), F.lit(1 << 30)) / float(1 << 30)) \
        .where(F.col("__draw") < share).limit(2 * most)
    texts = docs.select(F.col(id_col).alias("__id"), F.make_valid_utf8(F.col(text_col).cast("string")).alias("__text"))
    return texts.join(F.broadcast(marks), "__id").withColumn("__draw", F.col("__draw") / share), min(most, total)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample_docs: int = SAMPLE_DOCS, count_docs: int = COUNT_DOCS) -> Model:
    """Learn from the labelled rows whose crc32(id) mod 5 is not 0. Without such rows every score is 0.5."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, counts, totals, kept = Featurizer(), np.zeros((2, TABLE), np.int64), [0, 0], []
        for batch in batches:
            for text, y, own, doc in zip(*(c.to_pylist() for c in batch.columns)):
                buckets = features(text)
                counts[y, buckets] += 1
                totals[y] += 1
                if own:
                    kept.append((doc, y, buckets.astype("<i4").tobytes()))
            if kept:
                ids, ys, blobs = zip(*kept)
                n = len(ids)
                yield pa.RecordBatch.from_arrays([pa.array([-1] * n, pa.int32()), pa.array(ys, pa.int64()), pa.array(ids, pa.int64()),
                                                  pa.array(blobs, pa.binary())], ["bucket", "down", "up", "x"])
                kept = []
        used = np.flatnonzero(counts.any(axis=0))
        bucket = np.append(used, TABLE).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.append(counts[0, used], totals[0])),
                                          pa.array(np.append(counts[1, used], totals[1])), pa.nulls(len(bucket), pa.binary())],
                                         ["bucket", "down", "up", "x"])

    rows, n = labelled(docs, labels, id_col, text_col, label_col, count_docs)
    rows = rows.select("__text", "__y", (F.col("__draw") < sample_docs / max(1, n)).alias("own"), F.xxhash64(F.lit(72), "__id").alias("__at"))
    found = written(rows.mapInArrow(counted, "bucket int, down long, up long, x binary"), "ngrams")
    sums = found.where("bucket >= 0").groupBy("bucket").agg(F.sum("down").alias("down"), F.sum("up").alias("up")).toPandas()
    counts = np.zeros((2, TABLE + 1))
    counts[0, sums["bucket"]], counts[1, sums["bucket"]] = sums["down"], sums["up"]
    down, up = counts[0, :TABLE] + 1, counts[1, :TABLE] + 1
    ratio = np.log((up / up.sum()) / (down / down.sum()))
    sample = found.where("bucket = -1").select(F.col("down").alias("y"), F.col("up").alias("at"), "x").toPandas()
    sample = sample.sort_values(["at", "y"], kind="stable").reset_index(drop=True)
    if not len(sample) or sample["y"].nunique() < 2:
        share_up = counts[1, TABLE] / max(1.0, counts[:, TABLE].sum()) if counts[:, TABLE].sum() else 0.5
        share_up = min(max(share_up, 1e-3), 1 - 1e-3)
        return Model(ratio, np.zeros(TABLE), 0.0, float(np.log(share_up / (1 - share_up))))
    rows_, values = [np.frombuffer(b, "<i4") for b in sample["x"]], []
    for r in rows_:
        v = ratio[r]
        values.append(v / max(np.sqrt(v @ v), 1e-9))
    y = sample["y"].to_numpy()
    held = np.arange(len(y)) % 5 == 4
    if len(y) < 25 or len(set(y[~held])) < 2:
        held[:] = False
    own = np.flatnonzero(~held)
    weights = descend([rows_[i] for i in own], [values[i] for i in own], np.where(y[own] == 1, 1.0, -1.0))
    judged = np.flatnonzero(held) if held.any() else own
    margins = np.array([weights[rows_[i]] @ values[i] for i in judged])
    return Model(ratio, weights, *calibrate(margins, y[judged]))


def scorer(spark, model: Model):
    """A column function: text -> score. The model is a broadcast of fixed size (two tables of TABLE numbers)."""
    shared = spark.sparkContext.broadcast((model.ratio, model.weights, model.slope, model.offset))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, model = Featurizer(), Model(*shared.value)
        for batch in texts:
            yield pd.Series([model.score(features(t)) for t in batch], dtype="float64")

    return score


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             threshold: float = THRESHOLD, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per input row: id_col, held_out, score, predicted.

    Defined results: a null text equals the empty text, whose score is the curve's value at margin 0; a
    null identifier counts as the empty text in crc32; rows with a null identifier teach nothing.
    Repeated label rows each count; bytes that are no UTF-8 are read as U+FFFD. An empty table gives no rows. Other columns are never read.
    """
    score = scorer(docs.sparkSession, fit(docs, labels, id_col, text_col, label_col, sample_docs))
    rows = docs.select(F.col(id_col).alias("__id"), score(F.make_valid_utf8(F.col(text_col).cast("string"))).alias("score"))
    return rows.select(F.col("__id").alias(id_col), (crc_mod5(F.col("__id")) == 0).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", threshold: float = THRESHOLD, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold.

    Defined results: a null text is judged like an empty one; null identifiers and repeated rows are judged by their texts;
    without labels of both kinds all rows have one score; bytes that are no UTF-8 are read as U+FFFD and kept as they are. An empty
    table gives no rows. No column's name matters.
    """
    score = scorer(docs.sparkSession, fit(docs, labels, id_col, text_col, label_col, sample_docs))
    return docs.where(score(F.make_valid_utf8(F.col(text_col).cast("string"))) >= threshold)
