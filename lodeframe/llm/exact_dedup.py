"""Exact dedup: a tree-merge of sorted digest runs.

Every input partition is a leaf: it folds its digests to one row each and sorts them into a run. Then the
nodes exchange runs in binomial rounds. In a round the nodes whose numbers differ in one digit form a group of
`k`; each cuts its run into k ranges of digests and sends the j-th to the group's j-th node, which merges the k
sorted runs that it gets, and keeps one row a digest: its smallest (or largest) identifier and its row count.
After as many rounds as node numbers have digits, every digest has met all its copies. A round is one exchange, a
node sends k runs in it, and what it holds is its share of the digests. Texts never move; a digest that a third of the
rows share is one row a leaf before it first moves.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import written

#: Digests that a leaf folds before it sorts them into a run.
LEAF_ROWS = 500_000


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """__id, and __key: SHA-256, verified by the byte count and a second, unrelated hash of eight bytes each."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    eight = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    key = F.concat(F.unhex(F.sha2(text.cast("binary"), 256)), eight(F.octet_length(text).cast("long")), eight(F.xxhash64(text)))
    return docs.select(F.col(id_col).alias("__id"), key.alias("__key"))


def rounds_of(leaves: int, fan_in: int) -> tuple[int, int]:
    """(rounds, k): the fewest rounds of at most `fan_in` runs, and the least k with k ** rounds >= leaves."""
    rounds = max(1, math.ceil(math.log(max(leaves, 2)) / math.log(fan_in) - 1e-9))
    k = max(2, math.ceil(leaves ** (1 / rounds) - 1e-9))
    return rounds, k


def target(node: int, key: bytes, number: int, k: int) -> int:
    """The node that takes the key in round `number`: the node's digit is replaced by the key's."""
    place = k ** number
    digit = int.from_bytes(key[:8], "big") // place % k
    return node + (digit - node // place % k) * place


def merged(runs: list[Iterator[tuple]], best) -> Iterator[tuple]:
    """One row (key, identifier, count) a key, in order, of runs that are in order."""
    for key, rows in groupby(heapq.merge(*runs, key=itemgetter(0)), key=itemgetter(0)):
        _, keep, n = next(rows)
        for _, other, more in rows:
            keep, n = other if keep is None else keep if other is None else best(keep, other), n + more
        yield key, keep, n


def digest_runs(digests: DataFrame, leaves: int, keep: str = "smallest", fan_in: int = 8) -> DataFrame:
    """__key, __keep and __n: one row a digest."""
    rounds, k = rounds_of(leaves, fan_in)
    best = min if keep == "smallest" else max
    kind = digests.schema["__id"].dataType
    fields = pa.schema([("key", pa.binary()), ("keep", _arrow(digests)), ("n", pa.int64())])

    def cut(rows: Iterator[tuple], node: int, number: int) -> pa.RecordBatch:
        """The run's ranges, as rows (node that takes it, run)."""
        parts: dict[int, list[tuple]] = {}
        for row in rows:
            parts.setdefault(target(node, row[0], number, k), []).append(row)
        blobs = []
        for part in parts.values():
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, fields) as stream:
                stream.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), fields)], schema=fields))
            blobs.append(out.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array(blobs, pa.binary())], ["node", "run"])

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        node, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            for key, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                old = held.get(key)
                held[key] = (own, 1) if old is None else (own if old[0] is None else old[0] if own is None else best(old[0], own), old[1] + 1)
            if len(held) > LEAF_ROWS:
                yield cut(((x, *held[x]) for x in sorted(held)), node, 0)
                held = {}
        yield cut(((x, *held[x]) for x in sorted(held)), node, 0)

    def runs_in(batches: Iterator[pa.RecordBatch]) -> tuple[int | None, list[Iterator[tuple]]]:
        node, runs = None, []
        for batch in batches:
            for node, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                table = pa.ipc.open_stream(blob).read_all()
                runs.append(zip(*(c.to_pylist() for c in table.columns)))
        return node, runs

    def meet(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            node, runs = runs_in(batches)
            if runs:
                yield cut(merged(runs, best), node, number)
        return run

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, runs = runs_in(batches)
        rows = list(merged(runs, best))
        columns = list(zip(*rows)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

    keyed = digests.select(F.col("__key").alias("key"), "__id")
    runs = keyed.mapInArrow(leaf, "node int, run binary")
    for number in range(1, rounds):
        runs = runs.repartitionById(k ** rounds, "node").mapInArrow(meet(number), "node int, run binary")
    schema = StructType().add("key", "binary").add("keep", kind).add("n", "long")
    found = runs.repartitionById(k ** rounds, "node").mapInArrow(last, schema)
    return found.select(F.col("key").alias("__key"), F.col("keep").alias("__keep"), F.col("n").alias("__n"))


def _arrow(digests: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(digests.schema["__id"].dataType)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                fan_in: int = 8) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256.

    Defined results: a null text equals the empty text. Null identifiers lose to any other; a group of
    null identifiers only has a null keep_id and keeps its rows. Rows that repeat the kept identifier
    with the same text are all marked kept. Identifiers are numbers or strings. An empty table gives no rows.
    Other columns are ignored, whatever their names.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    digests = written(_digests(docs, id_col, text_col), "digests")
    runs = written(digest_runs(digests, max(1, digests.rdd.getNumPartitions()), keep, fan_in), "runs")
    return digests.join(runs, "__key").select(
        F.col("__id").alias(id_col), F.col("__keep").alias("keep_id"), F.col("__n").alias("group_size"),
        F.col("__id").eqNullSafe(F.col("__keep")).alias("kept"), F.lower(F.hex(F.substring("__key", 1, 32))).alias("text_sha256"))
