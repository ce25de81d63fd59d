"""Chunking, hashed embeddings, vector search and retrieval, as expressions over columns."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.predicates import has_metadata, has_tags
from ..functions.text import attempt_id, lower_each, preview, token_estimate, unicode_trim, words

SIZE, SIZE_LEAST, SIZE_MOST, OVERLAP_MOST, DIMENSIONS = 1600, 64, 8000, 2000, 384
TOP_K, TOP_K_MOST, OVERFETCH, CANDIDATES_MOST, THRESHOLD = 10, 100, 5, 500, 0.35


def chunk_strategy(text: str | None) -> tuple[int, int]:
    """(size, overlap) of a strategy in JSON. Fields that are no whole numbers, and malformed ones, count as absent; all are clamped."""
    try:
        given = json.loads(text or "{}")
    except ValueError:
        given = {}
    given = given if isinstance(given, dict) else {}
    number = lambda k: given[k] if type(given.get(k)) is int else 0
    size = min(max(number("size") or number("chunkSize") or SIZE, SIZE_LEAST), SIZE_MOST)
    overlap = min(max(number("overlap"), 0), OVERLAP_MOST)
    return size, size // 4 if overlap >= size else overlap


def chunk_settings(c: Column) -> Column:
    """struct(size, overlap): `chunk_strategy` for every row of a column."""
    whole = lambda k: F.coalesce(F.when(F.schema_of_variant(F.try_variant_get(F.try_parse_json(c), f"$.{k}", "variant")) == "BIGINT",
                                        F.try_variant_get(F.try_parse_json(c), f"$.{k}", "bigint")), F.lit(0))
    size = F.coalesce(F.nullif(whole("size"), F.lit(0)), F.nullif(whole("chunkSize"), F.lit(0)), F.lit(SIZE))
    size = F.least(F.greatest(size, F.lit(SIZE_LEAST)), F.lit(SIZE_MOST))
    overlap = F.least(F.greatest(whole("overlap"), F.lit(0)), F.lit(OVERLAP_MOST))
    return F.struct(size.cast("int").alias("size"), F.when(overlap >= size, F.floor(size / 4)).otherwise(overlap).cast("int").alias("overlap"))


#: Windows that are cut from one piece of a text: a substring walks from the start of its piece only.
PIECE_WINDOWS = 16


def chunk_texts(text: Column, size: int, overlap: int) -> Column:
    """Trimmed windows of the trimmed text; blank windows are dropped. The text is cut in two steps, so long ones take no quadratic time."""
    body, step = unicode_trim(text), size - overlap
    last = F.when(F.length(body) <= size, F.lit(0)).otherwise(F.ceil((F.length(body) - size) / step)).cast("int")
    groups = F.sequence(F.lit(0), F.floor(last / PIECE_WINDOWS).cast("int"))
    pieces = F.transform(groups, lambda g: F.struct(
        F.substring(body, g * (PIECE_WINDOWS * step) + 1, F.lit(PIECE_WINDOWS * step + size)).alias("t"),
        F.least(last - g * PIECE_WINDOWS, F.lit(PIECE_WINDOWS - 1)).alias("n")))
    windows = F.flatten(F.transform(pieces, lambda p: F.transform(
        F.sequence(F.lit(0), p["n"]), lambda i: unicode_trim(F.substring(p["t"], i * step + 1, F.lit(size))))))
    return F.filter(windows, lambda w: w != "")


def chunks(docs: DataFrame, id_col: str, text_col: str, size: int = SIZE, overlap: int = 200) -> DataFrame:
    """id_col, chunk_index (after blanks are dropped), content, token_count, chunk_type, metadata (empty); texts without any give none."""
    rows = docs.select(id_col, F.posexplode(chunk_texts(F.col(text_col), size, overlap)).alias("chunk_index", "content"))
    return rows.withColumns({"token_count": token_estimate(F.col("content")), "chunk_type": F.lit("text"), "metadata": F.create_map().cast("map<string,string>")})


def _tokens(text_col: str) -> Column:
    """The lower-cased words; a text without any is one itself."""
    body = lower_each(F.col(text_col))
    return F.when(F.size(words(body)) == 0, F.array(body)).otherwise(words(body))


def _bucket(digest: Column, dimensions: int) -> Column:
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % dimensions).cast("int")


def _is_odd(digest: Column) -> Column:
    return F.substring(digest, 10, 1).isin(*"13579bdf")


def hash_embedding(docs: DataFrame, id_col: str, text_col: str, dimensions: int = DIMENSIONS, tokens: Column | None = None) -> DataFrame:
    """Sparse signed feature hashing: id_col, bucket, weight (signed count), value (of the unit vector), a row for each bucket of a text.

    tokens: an array of the text's words, where others than the reference's count; a text without any has no rows then.

    A text is folded in its own row, and nothing is held or shuffled. Only where identifiers repeat, which one narrow pass
    finds, texts are added up by identifier.
    """
    tokens = _tokens(text_col) if tokens is None else tokens
    if docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        entries = _divided(lambda x, norm: F.struct(x["bucket"].alias("bucket"), x["weight"].alias("weight"), (x["weight"] / norm).alias("value")))
        return _folded(docs.select(id_col, text_col), tokens, dimensions).select(id_col, F.inline(entries))
    digest = F.substring(F.sha2(F.col("__w").cast("binary"), 256), 1, 10)
    rows = docs.select(id_col, F.explode(tokens).alias("__w")).select(id_col, digest.alias("__h"))
    sign = F.when(_is_odd(F.col("__h")), -1).otherwise(1).cast("long")
    rows = rows.groupBy(id_col, _bucket(F.col("__h"), dimensions).alias("bucket")).agg(F.sum(sign).alias("weight")).where("weight <> 0")
    squares = F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(id_col))
    return rows.select(id_col, "bucket", "weight", (F.col("weight") / F.sqrt(squares)).alias("value"))


def _folded(rows: DataFrame, tokens: Column, dimensions: int) -> DataFrame:
    """rows with `__v`, the buckets of the text's words with their signed counts, and `__norm`.

    A text is folded in its own row: its buckets are sorted, and a run of one bucket is a weight. Nothing is shuffled.
    """
    own = [F.col(c) for c in rows.columns]
    head = lambda w: F.substring(F.sha2(w.cast("binary"), 256), 1, 10)
    signed = F.transform(F.transform(tokens, head), lambda h: _bucket(h, dimensions) * 2 + _is_odd(h).cast("int"))
    rows = rows.select(*own, F.sort_array(signed).alias("__s")).withColumn("__n", F.size("__s"))
    # Where the place in the sorted row is the last of its bucket, the counts up to there, plus for one sign and minus for the other.
    ends = F.filter(F.sequence(F.lit(0), F.col("__n") - 1), lambda i: (i == F.col("__n") - 1) | (F.get("__s", i) != F.get("__s", i + 1)))
    rows = rows.select(*own, "__s", F.when(F.col("__n") > 0, ends).otherwise(F.array().cast("array<int>")).alias("__e"))
    before = F.concat(F.array(F.lit(-1)), F.slice("__e", 1, F.greatest(F.size("__e") - 1, F.lit(0))))
    counts = F.transform(F.arrays_zip(F.col("__e").alias("e"), before.alias("b")), lambda x: F.struct(
        F.floor(F.get("__s", x["e"]) / 2).cast("int").alias("bucket"), (F.when(F.get("__s", x["e"]) % 2 == 1, -1).otherwise(1) * (x["e"] - x["b"])).cast("long").alias("w")))
    rows = rows.select(*own, counts.alias("__c"))
    # A bucket has one or two neighbouring entries: those of either sign.
    weights = F.transform(F.col("__c"), lambda x, i: F.struct(
        x["bucket"].alias("bucket"), (x["w"] + F.when(F.get("__c", i + 1)["bucket"] == x["bucket"], F.get("__c", i + 1)["w"]).otherwise(0)).alias("weight"),
        F.coalesce((i > 0) & (F.get("__c", i - 1)["bucket"] == x["bucket"]), F.lit(False)).alias("second")))
    rows = rows.select(*own, F.filter(weights, lambda x: ~x["second"] & (x["weight"] != 0)).alias("__v"))
    return rows.withColumn("__norm", F.sqrt(F.aggregate("__v", F.lit(0).cast("long"), lambda a, x: a + x["weight"] * x["weight"])))


def hash_vectors(rows: DataFrame, text_col: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """rows with `buckets` (ascending) and `weights` (of the unit vector) of the text; a text whose counts all cancel out has none."""
    folded = _folded(rows, _tokens(text_col), dimensions)
    return folded.select(*rows.columns, F.transform("__v", lambda x: x["bucket"]).alias("buckets"), _divided(lambda x, norm: x["weight"] / norm).alias("weights"))


def _divided(of: Callable[[Column, Column], Column]) -> Column:
    """`of` each entry of `__v` and the norm, which is bound first: else the optimizer puts its sum over all entries in the place of each."""
    return F.get(F.transform(F.array("__norm"), lambda norm: F.transform("__v", lambda x: of(x, norm))), F.lit(0))


def embedding_problems(vectors: DataFrame, requests: DataFrame, by: str) -> DataFrame:
    """by, reason of each answer that is refused: 'count', 'index' (not 0 to n - 1, each once) or 'dimension' (unequal or none).

    vectors: by, index, vector; requests: by, n (how many texts were sent).
    """
    got = vectors.groupBy(by).agg(F.count(F.lit(1)).alias("c"), F.count_distinct("index").alias("d"), F.min("index").alias("lo"), F.max("index").alias("hi"),
                                  F.min(F.coalesce(F.size("vector"), F.lit(0))).alias("s"), F.max(F.size("vector")).alias("t"))
    rows = requests.select(F.col(by), F.col("n")).join(got, by, "left")
    reason = F.when(F.coalesce("c", F.lit(0)) != F.col("n"), "count").when((F.col("d") != F.col("n")) | (F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1), "index") \
        .when((F.col("s") < 1) | (F.col("s") != F.col("t")), "dimension")
    return rows.select(by, reason.alias("reason")).where("reason is not null")


def valid_embedding(payload: Column, encoding: Column) -> Column:
    """Whether a payload is a JSON list of numbers with a member ('float', also for a blank encoding), or a JSON string of base64, padded or not."""
    kind = F.lower(F.trim(F.coalesce(encoding, F.lit(""))))
    numbers = F.try_variant_get(F.try_parse_json(payload), "$", "array<double>")
    raw = F.trim(F.try_variant_get(F.try_parse_json(payload), "$", "string"))
    padded = F.rpad(raw, (F.ceil(F.length(raw) / 4) * 4).cast("int"), F.lit("="))
    text = F.schema_of_variant(F.try_parse_json(payload)) == "STRING"
    plain = raw.rlike("^[A-Za-z0-9+/]+={0,2}$") & (~raw.contains("=") | (F.length(raw) % 4 == 0))
    ok = F.when(kind.isin("", "float"), F.size(numbers) > 0).when(kind == "base64", text & (raw != "") & plain & F.try_to_binary(padded, F.lit("base64")).isNotNull())
    return F.coalesce(ok, F.lit(False))


def point_payloads(chunk_rows: DataFrame, documents: DataFrame, jobs: DataFrame) -> DataFrame:
    """chunk_id and payload, the struct that a vector point carries.

    chunk_rows: chunk_id, document_id, knowledge_base_id, chunk_index, chunk_type, section_path, metadata; documents: document_id, tags; jobs: document_id, job_id, attempts.
    """
    rows = chunk_rows.join(documents.select("document_id", "tags"), "document_id").join(jobs.select("document_id", "job_id", "attempts"), "document_id")
    blank = lambda c: F.coalesce(c, F.lit(""))
    payload = F.struct("knowledge_base_id", "document_id", "chunk_id", "chunk_index", blank(F.col("chunk_type")).alias("chunk_type"),
                       blank(F.col("section_path")).alias("section_path"), "tags", "metadata", "job_id", F.col("attempts").alias("job_attempt"),
                       attempt_id(F.col("job_id"), F.col("attempts")).alias("ingestion_attempt"))
    return rows.select("chunk_id", payload.alias("payload"))


def delete_attempt(points: DataFrame, document: str, attempt: str) -> DataFrame:
    """Points without those that one attempt wrote for one document."""
    return points.where(~(F.col("document_id").eqNullSafe(F.lit(document)) & F.col("ingestion_attempt").eqNullSafe(F.lit(attempt))))


def dot(a: Column, b: Column) -> Column:
    """Over the shorter length: products of floats, added up in double."""
    n = F.least(F.size(a), F.size(b))
    return F.aggregate(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: (x.cast("float") * y.cast("float")).cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def search(points: DataFrame, query: Sequence[float], k: int, threshold: float | None = None, where: Column | None = None,
           id_col: str = "point_id", vector_col: str = "vector") -> DataFrame:
    """Filtered exact top k: filters, score, threshold, then TakeOrderedAndProject. Ties by id."""
    literal = F.array(*[F.lit(float(x)) for x in query])
    rows = points if where is None else points.where(where)
    rows = rows.withColumn("score", dot(F.col(vector_col), literal))
    if threshold is not None:
        rows = rows.where(F.col("score") >= threshold)
    return rows.orderBy(F.desc("score"), F.asc(id_col)).limit(k)


def candidate_limit(top_k: int) -> int:
    return min(max(top_k * OVERFETCH, top_k), CANDIDATES_MOST)


#: Rows of the blocks that points and queries are dealt in: a task holds one of each at a time, and scores of SCORED queries.
POINT_BLOCK, QUERY_BLOCK, SCORED, POINT_BLOCKS_LEAST = 8192, 4096, 256, 16
#: Vectors with a larger number could overflow a product of floats; their scores are not estimated first.
PLAIN_MOST = 1e18


def _by_length(vectors: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]]:
    """(places, rows, which numbers are null) of the vectors of each length; null vectors have places only."""
    lengths, out = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(), []
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        if n < 0:
            out.append((at, None, None))
            continue
        flat = pa.concat_arrays([c.flatten() for c in vectors.take(pa.array(at)).chunks])
        out.append((at, flat.to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(at), n), flat.is_null().to_numpy(zero_copy_only=False).reshape(len(at), n)))
    return out


def _added(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """`dot` of the rows, one by one: products of floats, added up in double from the first to the last."""
    total = np.zeros(len(p))
    with np.errstate(all="ignore"):
        for j in range(p.shape[1]):
            total += p[:, j] * q[:, j]
    return total


def _cut(q: np.ndarray, p: np.ndarray, score: np.ndarray, known: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The best k of each q: NaN, then falling scores, then unknown ones; equal ones by p."""
    order = np.lexsort((p, np.where(np.isnan(score), 0, -score), np.where(known, np.where(np.isnan(score), 0, 1), 2), q))
    q, p, score, known = q[order], p[order], score[order], known[order]
    starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, int)
    keep = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)])) < k
    return q[keep], p[keep], score[keep], known[keep]


def _scored(q: np.ndarray, p: np.ndarray, qv: np.ndarray, pv: np.ndarray, missing: np.ndarray | None, k: int) -> list[tuple[np.ndarray, ...]]:
    """The pairs (q, p) with the rows' scores, the best k of each q in every piece."""
    out = []
    for i in range(0, len(q), 1 << 16):
        a, b = q[i:i + (1 << 16)], p[i:i + (1 << 16)]
        known = np.ones(len(a), bool) if missing is None else ~missing[i:i + (1 << 16)]
        out.append(_cut(a, b, _added(pv[b], qv[a]), known, k))
    return out


def _best_pairs(p: np.ndarray, p_null: np.ndarray, q: np.ndarray, q_null: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(q, p, score, known) of the best k rows of p for each row of q; both have as many columns.

    A product of matrices in double finds who can be among the best: it is off by less than `off`, as a product of floats is by
    2^-24 of itself. Their own scores decide. Rows with nulls, with numbers that are not finite or are very large are scored in full.
    """
    plain = lambda rows, nulls: ~nulls.any(axis=1) & (np.abs(np.nan_to_num(rows, nan=np.inf)).max(axis=1, initial=0) <= PLAIN_MOST)
    p_at, q_plain, out = plain(p, p_null), plain(q, q_null), []
    p_plain, p_odd = np.flatnonzero(p_at), np.flatnonzero(~p_at)
    wide = p[p_plain].astype(np.float64)
    longest = np.sqrt((wide ** 2).sum(axis=1).max(initial=0))
    for i in range(0, len(q), SCORED):
        rows, own = np.arange(i, min(i + SCORED, len(q))), q_plain[i:i + SCORED]
        asked = rows[own]
        if len(asked) and len(p_plain):
            these = q[asked].astype(np.float64)
            guess = these @ wide.T
            if len(p_plain) > k:
                off = np.sqrt((these ** 2).sum(axis=1)) * longest * 2.0 ** -23 + p.shape[1] * 2.0 ** -149
                least = np.partition(guess, len(p_plain) - k, axis=1)[:, len(p_plain) - k] - 2 * off
                a, b = np.nonzero(guess >= least[:, None])
            else:
                a, b = np.nonzero(np.ones_like(guess, bool))
            out += _scored(asked[a], p_plain[b], q, p, None, k)
        for some, points in ((rows[~own], np.arange(len(p))), (asked, p_odd)):
            for j in range(0, len(points) if len(some) else 0, 1 << 10):  # few rows; all of their pairs
                a, b = np.repeat(some, len(points[j:j + 1024])), np.tile(points[j:j + 1024], len(some))
                out += _scored(a, b, q, p, (p_null[b] | q_null[a]).any(axis=1), k)
    return tuple(map(np.concatenate, zip(*out))) if out else tuple(np.zeros(0, t) for t in (int, int, float, bool))


def _repeats(rows: np.ndarray, nulls: np.ndarray, k: int) -> np.ndarray:
    """Which rows have k equal ones before them: they are among nobody's best."""
    keys = pd.Series([a.tobytes() + b.tobytes() for a, b in zip(rows, nulls)], dtype=object)
    return keys.groupby(keys).cumcount().to_numpy() >= k


def best_of_blocks(points: DataFrame, queries: DataFrame, k: int, id_col: str, query_id: str) -> DataFrame:
    """Top k points of every query over all blocks: query_id, id_col, score, rank; ties by id.

    points: __b (block), __p, __v, __cell; queries: __b, __q, __w, __cells. Within a block a query meets the points of its cells. A block's
    points meet a block of queries as matrices in one task, and leave k points a query; those are what the window ranks.
    """
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    left = points.select("__b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("__qb"), "__p", F.col("__v").cast("array<float>").alias("__v"), "__cell")
    right = queries.select("__b", F.pmod(F.xxhash64("__q"), F.lit(blocks)).cast("int").alias("__qb"), "__q", F.col("__w").cast("array<float>").alias("__w"), "__cells")
    types = {f.name: f.dataType for f in [*points.schema, *queries.schema]}
    schema = StructType([StructField(query_id, types["__q"]), StructField(id_col, types["__p"]), StructField("score", DoubleType())])

    def meet(p: pa.Table, q: pa.Table) -> pa.Table:
        p = p.take(pc.sort_indices(p["__p"], null_placement="at_start"))  # so that places are in the order of ids
        asks = pc.list_parent_indices(q["__cells"]).to_numpy(), pc.list_flatten(q["__cells"]).to_numpy()
        found, cells = [tuple(np.zeros(0, t) for t in (int, int, float, bool))], p["__cell"].to_numpy()
        for cell in np.unique(cells):
            at, asked = np.flatnonzero(cells == cell), asks[0][asks[1] == cell]
            if not len(asked):
                continue
            for qi, qv, q_null in _by_length(q["__w"].take(pa.array(asked))):
                for pi, pv, p_null in _by_length(p["__v"].take(pa.array(at))):
                    if qv is None or pv is None:
                        a, b = np.repeat(np.arange(len(qi)), min(k, len(pi))), np.tile(np.arange(min(k, len(pi))), len(qi))
                        best = a, b, np.zeros(len(a)), np.zeros(len(a), bool)
                    else:
                        n = min(qv.shape[1], pv.shape[1])
                        kept = np.flatnonzero(~_repeats(pv, p_null, k))
                        pi = pi[kept]
                        best = _best_pairs(pv[kept, :n], p_null[kept, :n], qv[:, :n], q_null[:, :n], k)
                    found.append((asked[qi[best[0]]], at[pi[best[1]]], *best[2:]))
        a, b, score, known = _cut(*map(np.concatenate, zip(*found)), k)
        return pa.table([q["__q"].take(pa.array(a)), p["__p"].take(pa.array(b)), pa.array(score, mask=~known)], names=schema.names)

    scored = left.groupBy("__b", "__qb").cogroup(right.groupBy("__b", "__qb")).applyInArrow(meet, schema)
    best = Window.partitionBy(query_id).orderBy(F.desc("score"), F.asc(id_col))
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def batch_search(points: DataFrame, queries: DataFrame, k: int, id_col: str, vector_col: str, query_id: str, query_vector: str) -> DataFrame:
    """Top k points of every query, exactly. The queries are a stated set; every block of them meets every block of points once,
    so the work is their product, in matrices, and what moves is a block for each block it meets."""
    n = max(POINT_BLOCKS_LEAST, -(-points.count() // POINT_BLOCK))
    rows = points.select(F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int").alias("__b"), F.col(id_col).alias("__p"), F.col(vector_col).alias("__v"), F.lit(0).alias("__cell"))
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("__b"), F.col(query_id).alias("__q"), F.col(query_vector).alias("__w"), F.array(F.lit(0)).alias("__cells"))
    return best_of_blocks(rows, asked, k, id_col, query_id)


def upsert(old: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """Last write wins, by version; at the same version the new table's row."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    last = Window.partitionBy(key).orderBy(F.desc(version), F.desc("__new"))
    return both.withColumn("__rn", F.row_number().over(last)).where("__rn = 1").drop("__rn", "__new")


def delete_stale(points: DataFrame, document: Column, attempt: Column, active: Column) -> DataFrame:
    """Points whose attempt is the active one of their document."""
    return points.where(~(document.isNotNull() & (attempt != active)))


def hydrate(hits: DataFrame, chunk_rows: DataFrame, documents: DataFrame, top_k: int, threshold: float = THRESHOLD,
            tags: list[str] | None = None, metadata: dict[str, object] | None = None, visible: Column | None = None) -> DataFrame:
    """hits (chunk_id, score) with their chunk and document: ready, visible, live, matching ones in hit order, cut to top_k."""
    rows = hits.where(F.col("score") >= threshold).join(chunk_rows, "chunk_id").join(documents, "document_id")
    rows = rows.where((F.col("status") == "ready") & has_tags(F.col("tags"), tags or []))
    if metadata:
        rows = rows.where(has_metadata(F.col("metadata"), metadata))
    if visible is not None:
        rows = rows.where(visible)
    return rows.withColumn("preview", preview(F.col("content"))).orderBy(F.desc("score"), F.asc("chunk_id")).limit(top_k)


def rerank_merge(hits: DataFrame, reranked: DataFrame, limit: int, id_col: str = "chunk_id") -> DataFrame:
    """Reranked hits first (unknown ids skipped, first of repeated ones, score replaced), then the rest in vector order."""
    first = Window.partitionBy(id_col).orderBy("rerank_rank")
    ranked = reranked.withColumn("__rn", F.row_number().over(first)).where("__rn = 1").drop("__rn")
    merged = hits.join(ranked.select(id_col, "rerank_rank", "rerank_score"), id_col, "left") \
        .withColumn("final_score", F.coalesce("rerank_score", "score"))
    order = [F.asc_nulls_last("rerank_rank"), F.desc("score"), F.asc(id_col)]
    return merged.orderBy(*order).limit(limit).withColumn("position", F.row_number().over(Window.orderBy(*order)))


def rerank_problems(response: DataFrame, documents: DataFrame) -> DataFrame:
    """Why a provider's rerank rows (index, document_id, score) are refused: index, reason. None: accepted."""
    counted = response.withColumn("times", F.count(F.lit(1)).over(Window.partitionBy("index")))
    rows = counted.join(documents.select(F.col("index").alias("i"), F.col("document_id").alias("d")), F.col("index") == F.col("i"), "left")
    reason = F.when(F.col("i").isNull(), "index").when(F.col("times") > 1, "duplicate") \
        .when(F.col("document_id").isNotNull() & (F.col("document_id") != F.col("d")), "id")
    return rows.select("index", reason.alias("reason")).where("reason is not null").distinct()


def normal_rerank(response: DataFrame, documents: DataFrame) -> DataFrame:
    """(index, document_id, score) of a provider's rows, in either of two shapes: (index, document_id, score) or (index, relevance_score, score).

    Rows: index and any of document_id, relevance_score, score. One row that is refused (see `rerank_problems`, or without a
    score) refuses the whole answer: no rows. The document's own id always counts.
    """
    for name, kind in (("document_id", "string"), ("relevance_score", "double"), ("score", "double")):
        if name not in response.columns:
            response = response.withColumn(name, F.lit(None).cast(kind))
    rows = response.select("index", F.nullif(F.col("document_id").cast("string"), F.lit("")).alias("document_id"), F.coalesce("relevance_score", "score").alias("score"))
    known = documents.select("index", F.col("document_id").cast("string").alias("document_id"))
    bad = rerank_problems(rows, known).select("reason").unionByName(rows.where("score is null").select(F.lit("score").alias("reason"))).limit(1)
    good = rows.select("index", "score").join(known, "index").crossJoin(bad.agg(F.count(F.lit(1)).alias("__bad"))).where("__bad = 0")
    return good.select("index", "document_id", "score")


def rerank_usage(usage: Column, input_tokens: Column, output_tokens: Column) -> Column:
    """struct(prompt, completion, total): the stated usage, else that of the answer's token counts, else null."""
    counted = F.struct(input_tokens.cast("long").alias("prompt"), output_tokens.cast("long").alias("completion"), (input_tokens + output_tokens).cast("long").alias("total"))
    return F.coalesce(usage, F.when(input_tokens.isNotNull() & output_tokens.isNotNull(), counted))


def scope_of(kb_ids: Sequence[str] | None, readable: DataFrame) -> DataFrame:
    """kb_id of a search's scope: the given ids, trimmed and each once, all of which must be readable; without any, all readable ones."""
    ids = list(dict.fromkeys(k.strip() for k in kb_ids or [] if k.strip()))
    if not ids:
        return readable.select("kb_id").distinct()
    found = readable.where(F.col("kb_id").isin(ids)).select("kb_id").distinct()
    lacking = sorted(set(ids) - {r["kb_id"] for r in found.collect()})  # at most as many as the caller gave
    if lacking:
        raise ValueError(f"no such knowledge base: {lacking[0]}")
    return found


COLLECTION, CONFIGURED = "knowledge_chunks", "configured"


def trace_of(hits: DataFrame, top_k: int, threshold: float, rerank_n: int | None = None, rerank: bool = False, provider: str = "", model: str = "",
             dimension: int = 0, collection: str = "") -> DataFrame:
    """One row that says how a search was made and how many hits it had; blanks have defaults."""
    lit = lambda x, default: F.lit(x.strip() or default)
    return hits.agg(F.count(F.lit(1)).alias("hit_count")).select(
        lit(provider, CONFIGURED).alias("embedding_provider"), lit(model, CONFIGURED).alias("embedding_model"), F.lit(max(dimension, 1)).alias("embedding_dimension"),
        lit(collection, COLLECTION).alias("collection"), F.lit(top_k).alias("search_top_k"), F.lit(float(threshold)).alias("score_threshold"), "hit_count",
        F.lit(rerank).alias("rerank"), F.lit(rerank_n).cast("int").alias("rerank_top_n"))


def experiment_log(run_id: str, question: str, hits: DataFrame, order: list[Column], failed: bool = False) -> tuple[DataFrame, DataFrame]:
    """(the run's row, its results numbered from 1 in order) of a search that is kept for comparison."""
    results = hits.withColumn("rank_no", F.row_number().over(Window.partitionBy(F.lit(run_id)).orderBy(*order)).cast("long")).withColumn("run_id", F.lit(run_id))
    run = hits.agg(F.count(F.lit(1)).alias("result_count")).select(
        F.lit(run_id).alias("run_id"), F.lit(question).alias("question"), F.lit("failed" if failed else "completed").alias("status"), "result_count",
        F.lit("knowledge retrieval failed" if failed else None).cast("string").alias("error_message"))
    return run, results


def retrieve(points: DataFrame, chunk_rows: DataFrame, documents: DataFrame, query_vector: Sequence[float], kb_ids: list[str] | None = None,
             readable: DataFrame | None = None, top_k: int = TOP_K, threshold: float = THRESHOLD, tags: list[str] | None = None,
             metadata: dict[str, object] | None = None, reranker: Callable[[DataFrame], DataFrame] | None = None,
             rerank_n: int | None = None) -> DataFrame:
    """The retrieval pipeline as one lazy plan: scope, search, hydrate, cut, rerank.

    points: point_id, chunk_id, kb_id, vector. No kb_ids means all readable ones; an id that is not readable is an error;
    an empty scope gives no rows. `trace_of` and `experiment_log` describe the result.
    """
    if not 1 <= top_k <= TOP_K_MOST:
        raise ValueError(f"top_k must be from 1 to {TOP_K_MOST}")
    if readable is None:
        ids = list(dict.fromkeys(k.strip() for k in kb_ids or [] if k.strip()))
        scoped = points.where(unicode_trim(F.col("kb_id")).isin(ids)) if ids else points
    else:
        scope = scope_of(kb_ids, readable).select(F.col("kb_id").alias("__kb"))
        scoped = points.join(scope, unicode_trim(F.col("kb_id")) == F.col("__kb"), "left_semi")
    hits = search(scoped, query_vector, candidate_limit(top_k), threshold).select("chunk_id", "score")
    rows = hydrate(hits, chunk_rows, documents, top_k, threshold, tags, metadata)
    return rows if reranker is None else rerank_merge(rows, reranker(rows), min(rerank_n or top_k, top_k))
