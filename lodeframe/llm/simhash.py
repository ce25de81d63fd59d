"""SimHash near-dedup by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits, fewer than the usual `bits + 1`. Of two
fingerprints that differ in at most three bits, one segment differs in at most one, so the two share
a variant of that segment with one bit taken for a wildcard. Every distinct fingerprint is indexed under
its 2 x 32 one-wildcard variants; equal variants meet, and each candidate pair is verified on all 64 bits.

A variant that two fingerprints share is settled inside the aggregation. One that more share is dealt in
blocks of about BLOCK fingerprints; each pair of blocks is one bounded group, and gives a spanning forest
of its links, not the links: fewer rows than fingerprints, with the same components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .graph import components

BITS, SEGMENT, SEED, SHINGLE = 3, 32, 42, 3
BLOCK = 1024


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of the UTF-8 text: A-Z lower-cased, shingles of words, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, SEED) for p in parts), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at:at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """__id, __fp of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["__id", "__fp"])

    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").cast("binary").alias("__text"))
    return texts.mapInArrow(run, f"__id {kind}, __fp long")


def variants(fps: DataFrame) -> DataFrame:
    """key, fp: the one-wildcard variants of both segments; the key names segment, wildcard and the other bits."""
    at = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i"))
    return at.select(F.expr("""shiftleft(cast(i as bigint), 32) | (
        (shiftrightunsigned(fp, 32 * (i div 32)) & 4294967295L) & (4294967295L ^ shiftleft(1L, i % 32)))""").alias("key"), "fp")


def _forest(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of `fp` under distance <= bits: (member, its component's first member)."""
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= bits
    label = np.arange(len(fp), dtype=np.int32)
    while True:
        new = np.where(near, label[None, :], len(fp)).min(axis=1).astype(np.int32)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def _block_links(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, bi, bj, fp) in the order of the first three; at most two blocks are held."""

    def groups() -> Iterator[np.ndarray]:
        key, held = None, []
        for batch in batches:
            k, i, j, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cut = np.flatnonzero((k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            edges = [0, *cut.tolist(), len(k)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if (k[a], i[a], j[a]) != key:
                    if held:
                        yield np.concatenate(held)
                    key, held = (k[a], i[a], j[a]), []
                held.append(fp[a:b])
        if held:
            yield np.concatenate(held)

    a, b, n = [], [], 0
    for fp in groups():
        if len(fp) > 1:
            x, y = _forest(fp, bits)
            a.append(x), b.append(y)
            n += len(x)
        if n > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
            a, b, n = [], [], 0
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def links(fps: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): pairs of distinct fingerprints (column fp) with the components of all verified links.

    A pair of a block names a member and the first of its component there, which a path of links joins.
    """
    index = variants(fps)
    shared = written(index.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                     .where("n > 1"), "shared")
    pairs = shared.where("n = 2").select("a", "b").distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
    # A table of its own, so that Spark plans the join by what the crowded keys weigh: far less than all shared ones.
    hot = written(shared.where("n > 2").select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "hot")
    rows = index.join(hot, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks").cast("long")).cast("int"))
    rows = rows.select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("key", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "fp")
    dealt = rows.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    forest = dealt.mapInArrow(lambda batches: _block_links(batches, bits), "a long, b long")
    return pairs.union(forest)


def _rooted(nodes: DataFrame, bits: int, block: int) -> DataFrame:
    """nodes, one row per fingerprint (column fp), with the root of each one's component."""
    if not 0 <= bits <= 3:
        raise ValueError("two segments with one wildcard find at most three differing bits")
    roots = written(components(links(nodes.select("fp"), bits, block)), "roots")
    return nodes.join(roots, F.col("fp") == F.col("node"), "left").drop("node").withColumn("root", F.coalesce("root", "fp"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, shingle: int = SHINGLE,
               block: int = BLOCK) -> DataFrame:
    """One row per input row: id_col, fingerprint (16 hex digits), component_id (least identifier reachable).

    Defined results: null and wordless texts have fingerprint 0, linked like any other; null
    identifiers are in components but never name one, unless all are null. Repeated rows are in one
    component. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(rows.groupBy(F.col("__fp").alias("fp")).agg(F.min("__id").alias("least")), "nodes")
    named = _rooted(nodes, bits, block)
    least = written(named.groupBy(F.col("root").alias("top")).agg(F.min("least").alias("component_id")), "tops")
    named = written(named.join(least, F.col("root") == F.col("top")).select("fp", "component_id"), "named")
    return rows.join(named, F.col("__fp") == F.col("fp")).select(
        F.col("__id").alias(id_col), F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """One row, with all its columns, of each component: that of the least identifier, null ones last.

    Rows are told apart by a number of their own, never by identifier: of repeated rows, and of rows
    that share an identifier or have none, one stays in each component that has no lesser identifier.
    """
    @F.pandas_udf("long")
    def fingerprinted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    text = F.col(text_col).cast("string").cast("binary")
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), fingerprinted(text).alias("fp"), F.xxhash64(text).alias("sig"))
    rows = written(rows.withColumn("number", F.monotonically_increasing_id()), "numbered")
    rank = F.struct(F.col("id").isNull().alias("unnamed"), "id", "fp", "sig", "number")
    nodes = written(rows.groupBy("fp").agg(F.min(rank).alias("first")), "nodes")
    first = _rooted(nodes, bits, BLOCK).groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.number").alias("number"))
    gone = written(rows.select("number").join(first, "number", "left_anti"), "gone")
    return rows.join(gone, "number", "left_anti").select("doc.*")
