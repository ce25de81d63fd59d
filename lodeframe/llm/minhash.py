"""MinHash near-dedup with two permutations, one of them shifted in a circle.

The first permutation spreads a document's shingles over a circle of 2^32 places. The second one orders the
circle; shifted by 1, 2, 3, ... places it gives all coordinates of the signature: coordinate k is the least
rank of (place + k). So one pass of adding and mixing replaces a hash function a coordinate.

BANDS keys of ROWS coordinates each name buckets. Documents of equal sets are one node beforehand. Links are
confirmed on the full sets in two steps, neither of which makes all pairs of a bucket:

1. Each bucket's least node is compared with its other nodes; a pair that many buckets name is compared once.
2. A bucket whose other nodes are still in different components may hide a link between these. Its nodes meet in
   blocks of bounded size; inverted lists of their shingles give the sizes of all intersections, and a block gives a
   spanning forest of its confirmed links.

Two sets of similarity s share no bucket with a probability of (1 - s^ROWS)^BANDS: 1.3e-7 at 0.8, and less above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .graph import components

SHINGLE, PERCENT, BANDS, ROWS = 4, 80, 40, 5
#: Shingles of a block, about; two blocks meet in a task's memory.
BLOCK = 400_000
#: Nodes that one copy of a bucket's least node is compared with.
SHARE = 4096
_AT_ONCE = 256
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_GOLD = 0x9E3779B97F4A7C15


def _odd(n: int, start: int) -> np.ndarray:
    """n odd numbers, spread over 64 bits."""
    return np.array([(_GOLD * (start + 2 * i + 1)) & (1 << 64) - 1 | 1 for i in range(n)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64 bits."""
    x = (x ^ x >> np.uint64(33)) * _M1
    x = (x ^ x >> np.uint64(33)) * _M2
    return x ^ x >> np.uint64(33)


def shingles(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """The sorted set of the text's shingles as 64-bit hashes: A-Z lower-cased; fewer words than width are one shingle, none gives none."""
    words = (text or b"").lower().split()
    if len(words) < width:
        words = [b" ".join(words)] if words else []
        width = 1
    if not words:
        return np.zeros(0, np.uint64)
    hashes = _mix(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
    n = len(words) - width + 1
    total = np.full(n, width, np.uint64)
    for i, factor in enumerate(_odd(width, 1)):
        total += hashes[i:i + n] * factor
    return np.unique(_mix(total))


def signature(values: np.ndarray, size: int) -> np.ndarray:
    """The least ranks of the shingles' places under `size` shifts of one order of the circle."""
    places = (_mix(values ^ np.uint64(_GOLD)) >> np.uint64(32)).astype(np.uint32)
    shifts, least = np.arange(1, size + 1, dtype=np.uint32)[:, None], np.full(size, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(places), _AT_ONCE):
        x = shifts + places[None, at:at + _AT_ONCE]
        t = x >> np.uint32(16)
        x ^= t
        x *= np.uint32(0x21F0AAAD)
        np.right_shift(x, np.uint32(15), out=t)
        x ^= t
        x *= np.uint32(0x735A2D97)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def band_keys(values: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key of each band of the set's signature."""
    own = signature(values, bands * rows).reshape(bands, rows).astype(np.uint64)
    return _mix((_mix(own + np.uint64(1)) * _odd(rows, 101)).sum(axis=1, dtype=np.uint64) + _odd(bands, 1001)).view(np.int64)


def _near(inter, a, b, percent: int):
    return 100 * inter >= percent * (a + b - inter)


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, number (of the row), n (set size), digest (of the set), keys (of the bands), text of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(x.as_py(), width) for x in batch.column(1)]
            keys = [band_keys(s, bands, rows) if len(s) else np.zeros(0, np.int64) for s in sets]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                 lists, batch.column(1)], ["id", "n", "digest", "keys", "text"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    found = texts.mapInArrow(run, f"id {kind}, n long, digest binary, keys array<long>, text binary")
    return found.withColumn("number", F.monotonically_increasing_id())


def _stars(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows lead, share, node, text in the order of the first three; the least node of each group is its lead. Yields the linked pairs."""
    group, own = None, None
    for batch in batches:
        a, b = [], []
        for lead, share, node, text in zip(*(c.to_pylist() for c in batch.columns)):
            values = shingles(text, width)
            if (lead, share) != group:
                group, own = (lead, share), values
            elif _near(len(np.intersect1d(own, values, assume_unique=True)), len(own), len(values), percent):
                a.append(lead), b.append(node)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _forest(nodes: list[int], labels: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join different labels: a spanning forest of all links among the sets."""
    label, sizes = np.array(labels), np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    lists, start = owner[np.argsort(code, kind="stable")], np.cumsum(count) - count
    edges, links = np.cumsum(sizes) - sizes, []
    for x in range(len(sets)):
        if (label == label[0]).all():
            break
        own = code[edges[x]:edges[x] + sizes[x]]
        own = own[count[own] > 1]
        many = count[own]
        at = np.repeat(start[own] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        inter = np.bincount(lists[at], minlength=len(sets))
        for y in np.flatnonzero(_near(inter, sizes[x], sizes, percent) & (label != label[x])):
            if label[y] != label[x]:
                links.append((nodes[x], nodes[y]))
                label[label == label[y]] = label[x]
    return links


def _blocks(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows key, bi, bj, node, label, text in the order of the first three; two blocks at most are held."""
    group, held = None, ([], [], [])

    def out() -> pa.RecordBatch:
        links = _forest(*held, percent) if len(held[0]) > 1 else []
        a, b = zip(*links) if links else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        for key, bi, bj, node, label, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (key, bi, bj) != group:
                yield out()
                group, held = (key, bi, bj), ([], [], [])
            for to, x in zip(held, (node, label, shingles(text, width))):
                to.append(x)
    yield out()


def links(index: DataFrame, texts: DataFrame, width: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """node, root of every node with a link. index: key, node, n of each band of each node; texts: number, text."""
    lead = F.min(F.struct("node", "n")).alias("lead")
    shared = written(index.groupBy("key").agg(lead, F.count(F.lit(1)).alias("c")).where("c > 1").select("key", "lead"), "shared")
    members = written(index.join(shared, "key").select("key", "node", "n", F.col("lead.node").alias("lead"), F.col("lead.n").alias("lead_n")), "members")
    may = 100 * F.least("n", "lead_n") >= percent * F.greatest("n", "lead_n")
    pairs = written(members.where((F.col("node") != F.col("lead")) & may).select("lead", "node").distinct(), "pairs")
    # The other texts are read once; the bulk of documents shares no bucket.
    wanted = members.select("node").distinct()
    texts = written(texts.join(wanted, F.col("number") == F.col("node"), "left_semi"), "texts")

    shares = pairs.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / SHARE).alias("shares"))
    dealt = pairs.join(shares, "lead").select("lead", F.pmod(F.xxhash64("node"), F.col("shares")).alias("share"), "node")
    dealt = dealt.union(dealt.select("lead", "share", F.col("lead").alias("node")).distinct())
    dealt = dealt.join(texts, F.col("node") == F.col("number")).select("lead", "share", "node", "text")
    stars = dealt.repartition("lead", "share").sortWithinPartitions("lead", "share", "node").mapInArrow(lambda x: _stars(x, width, percent), "a long, b long")
    first = written(components(stars), "first")

    labelled = members.join(first.withColumnRenamed("node", "own"), F.col("node") == F.col("own"), "left")
    labelled = written(labelled.select("key", "node", "n", "lead", F.coalesce("root", "node").alias("label")), "labelled")
    rest = F.when(F.col("node") != F.col("lead"), F.col("label"))
    mark = lambda seed: F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(seed), "node"), 24)).alias(f"mark{seed}")
    open_ = labelled.groupBy("key").agg(F.min(rest).alias("x"), F.max(rest).alias("y"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("c"), mark(1), mark(2))
    # Bands whose buckets hold the same nodes are one.
    open_ = open_.where("x != y").groupBy("c", "mark1", "mark2").agg(F.min("key").alias("key"), F.max("total").alias("total"))
    open_ = written(open_.select("key", F.ceil(F.col("total") / block).alias("blocks")), "open")
    if open_.isEmpty():
        return first
    rows = labelled.join(open_, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.select("key", "node", "label", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("key", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "node", "label")
    rows = rows.join(texts, F.col("node") == F.col("number")).select("key", "bi", "bj", "node", "label", "text")
    found = rows.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj").mapInArrow(lambda x: _blocks(x, width, percent), "a long, b long")
    return components(first.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")).union(found))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, width: int = SHINGLE, bands: int = BANDS,
               rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One row per input row: id_col, n_shingles, component_id (least identifier reachable by links), kept (it is that one).

    Two documents are linked if their sets of shingles have a similarity of at least percent / 100.

    Defined results: texts without a word, null ones too, have an empty set and are linked with nothing; null identifiers are
    in components but never name one, unless all are null: then component_id is null and the rows are kept. Repeated rows are in one
    component, and of rows that repeat its identifier all are kept. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    table = written(signed(docs, id_col, text_col, width, bands, rows), "signed")
    top = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id")).alias("top")
    nodes = written(table.where("n > 0").groupBy("digest").agg(top, F.min("number").alias("node")), "nodes")
    index = table.join(nodes.select("node"), F.col("number") == F.col("node"), "left_semi").select(F.explode("keys").alias("key"), F.col("number").alias("node"), "n")
    roots = links(index, table.select("number", "text"), width, percent, block)
    named = written(nodes.join(roots.withColumnRenamed("node", "own"), F.col("node") == F.col("own"), "left").select("digest", "top", F.coalesce("root", "node").alias("root")), "named")
    tops = named.groupBy(F.col("root").alias("at")).agg(F.min("top").alias("least"))
    named = written(named.join(tops, F.col("root") == F.col("at")).select(F.col("digest").alias("own"), F.col("least.id").alias("component")), "tops")
    found = table.select("id", "n", "digest").join(named, (F.col("digest") == F.col("own")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
