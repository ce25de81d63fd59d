"""Suffix-array dedup: remove what a document shares with one of a smaller identifier, by prefix doubling.

A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller
identifier. Positions are ranked by the string that starts there, at a growing length; a position whose
rank is unique to a document is settled. The ranks of the first round are hashes of `base` bytes (25 for 50), so equal
strings have equal ranks on every executor; later ranks are the places of the pairs in Spark's sort.

Ranking all positions at once would sort a row a byte. So the first round ranks a sample that loses
nothing: every window of `length` bytes picks the position of its least base-byte hash (its minimizer), which
depends on the window's bytes alone. Windows that share a pick are consecutive and travel as one run: rank
of the base bytes at the pick, rank of all bytes of its windows, bounds. Runs meet by their first rank:

- a first rank of one document only: its windows are unique, settled;
- both ranks also in a smaller document: all its windows repeat;
- one context left for a first rank: settled;
- else its windows are open, and doubled: Spark sorts the rows (rank at p, rank at p + offset, document, p);
  a pair of one document is settled, the place of any other pair is the rank of the next round, at twice the
  length, until `length` is reached. Then of equal pairs all but the smallest document's repeat.

What the ranks claim is verified: every claim names its source, the source's bytes are fetched once for each
bucket that asks for them, and compared. Strings that differ under one rank raise; they never remove a byte.

Equal ranks are folded in each batch before they move, so a passage in a third of the documents is one
row a batch. Texts meet their findings in buckets of (document, text), one text in memory at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shuffle_width, written

LENGTH, MOST_BASE = 50, 32
#: Bytes that are hashed at once; a longer text is cut, and its windows at a cut are doubled.
PIECE = 1 << 20
#: Bytes of text that are ranked together, and bytes beside a pick that narrow the windows down.
CHUNK, SIDE = 128 << 10, 8
#: Bytes of text whose runs are folded together, and rows of a doubling that are, before they move.
FOLD, FOLD_ROWS = 6 << 20, 400_000
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = np.uint64((1 << 48) - 1)
_tables: dict[str, np.ndarray] = {}


def lengths_of(length: int) -> list[int]:
    """The lengths of the rounds: halves of `length` from MOST_BASE bytes or fewer on, then `length`."""
    out = [length]
    while len(out) < 2 and length > 1 or out[0] > MOST_BASE:
        out.insert(0, -(-out[0] // 2))
    return out


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _tables or len(_tables["up"]) < size:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(size, PIECE + 2 * LENGTH), base, np.uint64)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
    return _tables["up"], _tables["down"]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash; one longer than data."""
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=out[1:])
    return out


def _strings(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ranks of the strings data[start:end]."""
    _, down = _powers(len(sums))
    return _mix((sums[end] - sums[start]) * down[start])


def window_picks(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """The runs of windows with one pick, as (first window, last window, pick - first window, rank at the pick, rank of the
    context, rank of the sides). `data` holds texts one after the other, up to each of `ends`; no window crosses one.

    The sides are 8 bits each of the SIDE bytes before the pick's base bytes and of those behind them.
    """
    base = lengths_of(length)[0]
    n, w = len(data) - length + 1, length - base + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, *(none.astype(np.uint64) for _ in range(3))
    sums, (_, down) = _sums(data), _powers(len(data) + 1)
    grams = len(data) - base + 1
    # High bits of the hash, then the place: the least value is the leftmost of the least hashes.
    least = (sums[base:] - sums[:grams]) * down[:grams]
    least &= ~np.uint64(PIECE * 2 - 1)
    least |= np.arange(grams, dtype=np.uint64)
    reach = 1  # `least` is over so many grams from each place on
    while reach < w:
        step = min(reach, w - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    pick = (least & np.uint64(PIECE * 2 - 1)).astype(np.int32)
    for a, b in zip(np.maximum(np.append(0, ends[:-1]), ends - length + 1).tolist(), ends.tolist()):
        pick[a:b] = -1
    lo = np.flatnonzero(np.append(True, pick[1:] != pick[:-1]))
    hi = np.append(lo[1:], n) - 1
    own = pick[lo] >= 0
    lo, hi = lo[own], hi[own]
    at = pick[lo].astype(np.int64)
    context = _strings(sums, lo, hi + length)
    context = _mix(context ^ ((at - lo).astype(np.uint64) << np.uint64(8)) ^ ((hi - lo).astype(np.uint64) << np.uint64(20)))
    left = _strings(sums, np.maximum(at - SIDE, 0), at) & np.uint64(255)
    right = _strings(sums, at + base, np.minimum(at + base + SIDE, len(data))) & np.uint64(255)
    return lo, hi, at - lo, _strings(sums, at, at + base) & _MASK, context & _MASK, left << np.uint64(8) | right


def _pack(*columns: np.ndarray) -> bytes:
    body = b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    return len(columns[0]).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    n, body, at, out = int.from_bytes(blob[:8], "little"), zstandard.ZstdDecompressor().decompress(blob[8:]), 0, []
    for kind in kinds:
        size = np.dtype(kind).itemsize * n
        out.append(np.frombuffer(body, kind, n, at))
        at += size
    return out


def _joined(blobs: list[bytes], unpack: Callable) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*map(unpack, blobs))]


def _six(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8").view("u1").reshape(-1, 8)[:, :6])


def _pack_runs(doc, sig, lo, hi, into, first, context, sides) -> bytes:
    """Hashes keep six bytes; the documents' columns are sorted, so their differences pack small."""
    return _pack(np.diff(doc, prepend=0), np.diff(sig, prepend=0), np.diff(lo, prepend=0).astype("<i4"),
                 (hi - lo).astype("<i4"), into.astype("<i4"), _six(first), _six(context), sides.astype("<u2"))


def _unpack_runs(blob: bytes) -> tuple[np.ndarray, ...]:
    doc, sig, lo, span, into, first, context, sides = _unpack(blob, "<i8", "<i8", "<i4", "<i4", "<i4", "V6", "V6", "<u2")
    wide = lambda v: np.concatenate([v.view("u1").reshape(-1, 6), np.zeros((len(v), 2), np.uint8)], axis=1).view("<u8").ravel()
    lo = np.cumsum(lo, dtype=np.int64)
    return np.cumsum(doc), np.cumsum(sig), lo, lo + span, into, wide(first), wide(context), sides


def _unpack_open(blob: bytes) -> list[np.ndarray]:
    return _unpack(blob, "<i8", "<i8", "<i4", "<i4")


def _pack_claims(doc, sig, lo, hi, own, osig, olo) -> bytes:
    """Windows lo to hi of (doc, sig) are those from olo on of (own, osig)."""
    return _pack(doc, sig, lo.astype("<i4"), hi.astype("<i4"), own, osig, olo.astype("<i4"))


def _unpack_claims(blob: bytes) -> list[np.ndarray]:
    return _unpack(blob, "<i8", "<i8", "<i4", "<i4", "<i8", "<i8", "<i4")


def _sources(doc: np.ndarray, *ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a smaller document has the same ranks, the first place with them); rows in the order of documents."""
    if not len(doc):
        return np.zeros(0, bool), np.zeros(0, np.int64)
    key = ranks[0].view(np.uint64)
    for r in ranks[1:]:
        key = _mix(key + np.uint64(0x9E3779B97F4A7C15)) + r.view(np.uint64)
    order = np.argsort(key)
    start = np.flatnonzero(np.append(True, key[order[1:]] != key[order[:-1]]))
    source = np.empty(len(doc), np.int64)
    source[order] = np.repeat(np.minimum.reduceat(order, start), np.diff(np.append(start, len(doc))))
    if any((r != r[source]).any() for r in ranks):  # different ranks with one key
        order = np.lexsort((np.arange(len(doc)), *ranks))
        new = np.append(True, np.any([r[order[1:]] != r[order[:-1]] for r in ranks], axis=0))
        source[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    return doc > doc[source], source


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, the places that have it, in order)."""
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cut) if len(order) else []:
        yield int(bucket[part[0]]), part


def _bucket(doc: np.ndarray, sig: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a row of the input; as in `remove_repeats`."""
    return np.mod(doc ^ sig, buckets)


def _claimed(known: np.ndarray, source: np.ndarray, buckets: int, doc, sig, lo, hi) -> Iterator[tuple[int, int, bytes]]:
    """Rows (bucket, CLAIM, blob) for the known windows and their sources."""
    at = np.flatnonzero(known)
    for bucket, part in _by_bucket(_bucket(doc[at], sig[at], buckets)):
        own, from_ = at[part], source[at[part]]
        yield bucket, CLAIM, _pack_claims(doc[own], sig[own], lo[own], hi[own], doc[from_], sig[from_], lo[from_])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    bucket, kind, blob = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], ["bucket", "kind", "blob"])


#: Kinds of rows: runs by first rank; claims; open windows; what a bucket asks of a source; a source's bytes; texts.
RUN, CLAIM, OPEN, ASK, BYTES, TEXT = range(6)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def _chunks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[list[int], list[int], list[int], list[bytes]]]:
    """(documents, signatures, places in their texts, parts) of about CHUNK bytes; a text of over PIECE bytes is cut."""
    doc, sig, place, part, size = [], [], [], [], 0
    for d, s, text in _texts(batches):
        if d is None or text is None or len(text) < length:
            continue
        for at in range(0, len(text), PIECE):
            if size and size + len(text) - at > PIECE:
                yield doc, sig, place, part
                doc, sig, place, part, size = [], [], [], [], 0
            doc.append(d), sig.append(s), place.append(at), part.append(text[at:at + PIECE + length - 1])
            size += len(part[-1])
        if size > CHUNK:
            yield doc, sig, place, part
            doc, sig, place, part, size = [], [], [], [], 0
    if part:
        yield doc, sig, place, part


def _first_runs(batches: Iterator[pa.RecordBatch], buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    """Runs of the texts (doc, sig, blob), folded in the batch: RUN rows, and CLAIM rows for what repeats within it."""
    parts, size = [], 0
    for doc, sig, place, chunk in _chunks(batches, length):
        ends = np.cumsum([len(x) for x in chunk])
        data = np.frombuffer(b"".join(chunk), np.uint8)
        lo, hi, *ranks = window_picks(data, ends, length)
        own = np.searchsorted(ends, lo, "right")
        shift = np.array(place) - np.append(0, ends[:-1])
        parts.append((np.array(doc, np.int64)[own], np.array(sig, np.int64)[own], lo + shift[own], hi + shift[own], *ranks))
        size += len(data)
        if size > FOLD:
            yield _folded(parts, buckets)
            parts, size = [], 0
    if parts:
        yield _folded(parts, buckets)


def _in_order(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The columns' rows by the first column; the sort makes use of parts that are in order."""
    order = np.argsort(columns[0], kind="stable")
    return [c[order] for c in columns]


def _folded(parts: list[tuple], buckets: int) -> pa.RecordBatch:
    doc, sig, lo, hi, into, first, context, sides = _in_order([np.concatenate(c) for c in zip(*parts)])
    known, source = _sources(doc, first, context)
    rows = list(_claimed(known, source, buckets, doc, sig, lo, hi))
    left = np.flatnonzero(~known)
    for bucket, at in _by_bucket((first[left] % np.uint64(buckets)).astype(np.int64)):
        at = left[at]
        rows.append((bucket, RUN, _pack_runs(doc[at], sig[at], lo[at], hi[at], into[at], first[at], context[at], sides[at])))
    return _rows(rows)


def _met(batches: Iterator[pa.RecordBatch], buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    """All runs of a bucket of first ranks: what repeats, and what must be doubled. CLAIM rows pass."""
    blobs = []
    for batch in batches:
        kind = batch.column(1).to_numpy()
        yield batch.filter(pa.array(kind == CLAIM))
        blobs += batch.filter(pa.array(kind == RUN)).column(2).to_pylist()
    if not blobs:
        return
    doc, sig, lo, hi, into, first, context, sides = _in_order(_joined(blobs, _unpack_runs))
    del blobs
    known, source = _sources(doc, first, context)
    yield _rows(list(_claimed(known, source, buckets, doc, sig, lo, hi)))
    # Of equal contexts the smallest document's is left: a first rank of several documents has several contexts, and windows may be shared.
    kept = np.flatnonzero(~known)
    kept = kept[_tied(doc[kept], first[kept])]
    kept = kept[np.argsort(first[kept], kind="stable")]
    ranks = np.flatnonzero(np.append(True, first[kept][1:] != first[kept][:-1])) if len(kept) else np.zeros(0, np.int64)
    cut = [*ranks[np.append(0, np.flatnonzero(np.diff(ranks // 50_000)) + 1)].tolist(), len(kept)] if len(kept) else []
    for a, b in zip(cut, cut[1:]):  # whole ranks, about 50,000 runs at once
        at = kept[a:b]
        yield _rows(list(_open(buckets, length, *(c[at] for c in (doc, sig, lo, hi, into, first, sides)))))


def _tied(doc: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Whether another document has the rank."""
    if not len(doc):
        return np.zeros(0, bool)
    order = np.argsort(rank)
    start = np.flatnonzero(np.append(True, rank[order][1:] != rank[order][:-1]))
    several = np.maximum.reduceat(doc[order], start) > np.minimum.reduceat(doc[order], start)
    out = np.empty(len(doc), bool)
    out[order] = np.repeat(several, np.diff(np.append(start, len(doc))))
    return out


def _open(buckets: int, length: int, doc, sig, lo, hi, into, first, sides) -> Iterator[tuple[int, int, bytes]]:
    """OPEN rows: the windows of the runs whose pick another document has as far from a window's start, with the same sides.

    Equal windows have their picks at one place and, where a side of the pick is inside the window, that side too.
    """
    many = hi - lo + 1
    run = np.repeat(np.arange(len(lo)), many)
    at = _spread(lo, hi)
    ahead = (into + lo)[run] - at
    behind = length - lengths_of(length)[0] - ahead
    key = _mix(first[run] + (ahead.astype(np.uint64) << np.uint64(48)))
    left, right = (sides >> 8).astype(np.uint64)[run] + np.uint64(1), (sides & 255).astype(np.uint64)[run] + np.uint64(1)
    key += np.where(ahead >= SIDE, left, 0).astype(np.uint64) * np.uint64(_BASE) + np.where(behind >= SIDE, right, 0).astype(np.uint64)
    left = np.flatnonzero(_tied(doc[run], key))
    run, at = run[left], at[left]
    start = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (at[1:] != at[:-1] + 1))) if len(run) else left
    end = np.append(start[1:], len(run)) - 1
    doc, sig, lo, hi = doc[run[start]], sig[run[start]], at[start], at[end]
    for bucket, x in _by_bucket(_bucket(doc, sig, buckets)):
        yield bucket, OPEN, _pack(doc[x], sig[x], lo[x].astype("<i4"), hi[x].astype("<i4"))


def _beside(batches: Iterator[pa.RecordBatch], load: Callable[[dict[int, list[bytes]]], Callable]) -> Iterator[tuple]:
    """(doc, sig, text, what load's function finds for doc and sig) of rows in the order of bucket and kind: texts come last."""
    bucket, held, find = None, {}, None
    for batch in batches:
        for b, kind, blob, doc, sig in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if b != bucket:
                bucket, held, find = b, {}, None
            if kind != TEXT:
                held.setdefault(kind, []).append(blob)
                continue
            if find is None:
                find, held = load(held), {}
            yield doc, sig, blob, find(doc, sig)


def _table(columns: list[np.ndarray]) -> dict[tuple[int, int], list[np.ndarray]]:
    """The columns' rows by their first two."""
    order = np.lexsort(columns[1::-1])
    columns = [c[order] for c in columns]
    a, b = columns[:2]
    cut = [0, *(np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1).tolist(), len(a)]
    return {(int(a[x]), int(b[x])): [c[x:y] for c in columns[2:]] for x, y in zip(cut, cut[1:]) if y > x}


def _finder(kind: int, unpack: Callable) -> Callable:
    def load(held: dict[int, list[bytes]]) -> Callable:
        found = _table(_joined(held[kind], unpack)) if kind in held else {}
        return lambda doc, sig: found.get((doc, sig))

    return load


def _spread(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All windows of the ranges."""
    many = (hi - lo + 1).astype(np.int64)
    return np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


PAIRS = "r1 long, r2 long, doc long, sig long, at int, bucket int, blob binary"


def _first_pairs(batches: Iterator[pa.RecordBatch], buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    """PAIRS of the open windows: the ranks of the base bytes at `at` and an offset further; one row a pair and batch, the rest claims.

    r1 and r2 are mixed from both ranks in their order; rows with a blob hold claims instead.
    """
    sizes = lengths_of(length)
    step = sizes[1] - sizes[0]
    names = ["r1", "r2", "doc", "sig", "at", "bucket", "blob"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def folded() -> pa.RecordBatch:
        doc, sig, at, r1, r2 = (np.concatenate(c) for c in zip(*parts))
        claims = []
        if len(sizes) == 2:  # a pair is a whole window
            doc, sig, at, r1, r2 = _in_order([doc, sig, at, r1, r2])
            known, source = _sources(doc, r2, r1)
            claims = list(_claimed(known, source, buckets, doc, sig, at, at))
            r1, r2, doc, sig, at = (c[~known] for c in (r1, r2, doc, sig, at))
        n = len(claims)
        none = lambda t, many: pa.nulls(many, t)
        own = [pa.array(c) for c in (r1, r2, doc, sig, at.astype(np.int32))] + [none(pa.int32(), len(r1)), none(pa.binary(), len(r1))]
        more = [pa.array(range(n), pa.int64()), pa.array([zlib.crc32(c[2]) for c in claims], pa.int64()), *(none(t, n) for t in types[2:5]),
                pa.array([c[0] for c in claims], pa.int32()), pa.array([c[2] for c in claims], pa.binary())]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(own, more)], names)

    parts, size = [], 0
    for doc, sig, text, found in _beside(batches, _finder(OPEN, _unpack_open)):
        if not found:
            continue
        data, at = np.frombuffer(text, np.uint8), np.unique(_spread(*found))
        for a, b in zip(sizes[1:-1], sizes[2:]):  # later rounds look further on, too
            at = np.unique(np.concatenate([at, at + (b - a)]))
        at = at[at + sizes[1] <= len(data)]
        for low in range(0, len(data), PIECE):
            own = at[(at >= low) & (at < low + PIECE)] - low
            if not len(own):
                continue
            sums = _sums(data[low:low + PIECE + sizes[1]])
            a, b = _strings(sums, own, own + sizes[0]), _strings(sums, own + step, own + sizes[1])
            n = len(own)
            r2 = _mix(_mix(a + np.uint64(0x9E3779B97F4A7C15)) + b)
            parts.append((np.full(n, doc, np.int64), np.full(n, sig, np.int64), own + low, (a >> np.uint64(32)).view(np.int64), r2.view(np.int64)))
            size += n
        if size > FOLD_ROWS:
            yield folded()
            parts, size = [], 0
    if size:
        yield folded()


def _groups(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[tuple[list[np.ndarray], pa.RecordBatch]]:
    """Batches of PAIRS as (r1, r2, doc, sig, at), and the claims among them as rows."""
    for batch in batches:
        claims = batch.filter(batch.column(6).is_valid())
        rows = _rows([(b, CLAIM, x) for b, x in zip(claims.column(5).to_pylist(), claims.column(6).to_pylist())])
        yield [c.to_numpy(zero_copy_only=False) for c in batch.filter(batch.column(6).is_null()).columns[:5]], rows


def _repeated(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The last round. Rows in the order of (r1, r2, doc, sig, at): claims of the windows whose pair a smaller document has."""
    first = None  # the pair of the last group, and its first document, text and position
    for (r1, r2, doc, sig, at), passed in _groups(batches, buckets):
        yield passed
        if not len(r1):
            continue
        if first is not None:
            r1, r2, doc, sig, at = (np.concatenate([[x], c]) for x, c in zip(first, (r1, r2, doc, sig, at)))
        new = np.ones(len(r1), bool)
        new[1:] = (r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1])
        source = np.maximum.accumulate(np.where(new, np.arange(len(r1)), 0))
        yield _rows(list(_claimed(doc > doc[source], source, buckets, doc, sig, at, at)))
        s = source[-1]
        first = r1[s], r2[s], doc[s], sig[s], at[s]


def _reranked(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """A round before the last. Rows in the order of (r1, r2, doc): those of pairs with several documents, with the pair's place.

    Of a pair that the batch does not end, the rows of its first document are held until a second one comes.
    """
    from pyspark import TaskContext

    place, held, several = TaskContext.get().partitionId() << 40, None, False

    def out(part: list[np.ndarray], numbers: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(numbers), *map(pa.array, part[2:4]), pa.array(part[4].astype(np.int32))], ["r", "doc", "sig", "at"])

    for columns, _ in _groups(batches, buckets):
        if not len(columns[0]):
            continue
        if held is not None:  # `several`: one row, only to go on with its number
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
        r1, r2, doc = columns[:3]
        group = np.concatenate([[0], ((r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1])).cumsum()])
        start = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])
        last = np.append(start[1:], len(doc)) - 1
        tied = doc[last] > doc[start]
        own = np.arange(len(doc)) > 0 if several else np.ones(len(doc), bool)
        tied[0] |= several
        keep = tied[group] & own
        yield out([c[keep] for c in columns], place + group[keep])
        several = bool(tied[-1])
        held = [c[-1:] if several else c[start[-1]:] for c in columns]
        place += int(group[-1])


def _asked(batches: Iterator[pa.RecordBatch], buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    """CLAIM rows by the document's bucket: the claims with neighbours merged, and what is asked of their sources' buckets."""
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            held.setdefault(bucket, []).append(blob)
    for bucket in list(held):
        c = _joined(held.pop(bucket), _unpack_claims)
        order = np.lexsort((c[3], c[2], c[6] - c[2], c[5], c[4], c[1], c[0]))
        doc, sig, lo, hi, own, osig, olo = (x[order].astype(np.int64) for x in c)
        # Windows that go on where the one before ended, at the same distance from the same source.
        same = (doc[1:] == doc[:-1]) & (sig[1:] == sig[:-1]) & (own[1:] == own[:-1]) & (osig[1:] == osig[:-1]) & (olo[1:] - lo[1:] == olo[:-1] - lo[:-1])
        group = np.concatenate([[0], (~same).cumsum()]) << 33
        reach = np.maximum.accumulate(group + hi)
        start = np.flatnonzero(np.concatenate([[True], group[1:] + lo[1:] > reach[:-1] + 1]))
        hi = (reach - group)[np.append(start[1:], len(lo)) - 1]
        doc, sig, lo, own, osig, olo = (x[start] for x in (doc, sig, lo, own, osig, olo))
        rows = [(bucket, CLAIM, _pack_claims(doc, sig, lo, hi, own, osig, olo))]
        # The ranges of each source, merged where they meet.
        order = np.lexsort((olo, osig, own))
        own, osig, a = own[order], osig[order], olo[order]
        b = (olo + hi - lo + length)[order]
        group = np.concatenate([[0], ((own[1:] != own[:-1]) | (osig[1:] != osig[:-1])).cumsum()]) << 33
        reach = np.maximum.accumulate(group + b)
        start = np.flatnonzero(np.concatenate([[True], group[1:] + a[1:] > reach[:-1]]))
        b = (reach - group)[np.append(start[1:], len(a)) - 1]
        own, osig, a = own[start], osig[start], a[start]
        for to, at in _by_bucket(_bucket(own, osig, buckets)):
            rows.append((to, ASK, _pack(own[at], osig[at], np.full(len(at), bucket, "<i4"), a[at].astype("<i4"), b[at].astype("<i4"))))
        yield _rows(rows)


def _fetched(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """BYTES rows: what each bucket asked for."""
    rows, size = [], 0
    for doc, sig, text, found in _beside(batches, _finder(ASK, lambda b: _unpack(b, "<i8", "<i8", "<i4", "<i4", "<i4"))):
        for bucket, a, b in zip(*(c.tolist() for c in found)) if found else ():
            part = text[a:b]
            rows.append((bucket, BYTES, np.array([doc, sig, a], "<i8").tobytes() + zstandard.ZstdCompressor(level=1).compress(part)))
            size += len(rows[-1][2])
        if size > 8 << 20 or len(rows) > 20_000:
            yield _rows(rows)
            rows, size = [], 0
    if rows:
        yield _rows(rows)


def _verified(held: dict[int, list[bytes]], length: int) -> Callable:
    """For `_beside`: (lo, hi) of a text's claims, and a check of them."""
    claims = _table(_joined(held[CLAIM], _unpack_claims)) if CLAIM in held else {}
    sources: dict[tuple[int, int], dict[int, bytes]] = {}
    for blob in held.get(BYTES, ()):
        doc, sig, a = np.frombuffer(blob, "<i8", 3).tolist()
        sources.setdefault((doc, sig), {})[a] = blob[24:]
    starts = {k: np.array(sorted(v)) for k, v in sources.items()}
    last: tuple = None, b""

    def bytes_of(key: tuple[int, int], at: int, size: int) -> bytes:
        nonlocal last
        a = int(starts[key][np.searchsorted(starts[key], at, "right") - 1])
        if last[0] != (key, a):
            last = (key, a), zstandard.ZstdDecompressor().decompress(sources[key][a])
        return last[1][at - a:at - a + size]

    def find(doc: int | None, sig: int) -> Callable[[bytes], tuple]:
        found = claims.get((doc, sig))

        def checked(text: bytes) -> tuple[np.ndarray, np.ndarray]:
            if found is None:
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            for lo, hi, own, osig, olo in zip(*(c.tolist() for c in found)):
                size = hi - lo + length
                if text[lo:lo + size] != bytes_of((own, osig), olo, size):
                    raise ValueError("two different strings share a rank")
            return found[0], found[1]

        return checked

    return find


def _keep(text: bytes | None, lo: np.ndarray, hi: np.ndarray, length: int) -> tuple[bytes, int, int]:
    """What is left, removed bytes, removed spans."""
    text = text or b""
    if not len(lo):
        return text, 0, 0
    marks = np.zeros(len(text) + 1, np.int32)
    np.add.at(marks, lo, 1), np.add.at(marks, hi + length, -1)
    gone = np.cumsum(marks[:-1]) > 0
    spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def _cut(batches: Iterator[pa.RecordBatch], buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    names, types = ["own", "kept", "n_bytes", "n_removed", "n_spans"], (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    out, size = [], 0
    for doc, _, text, checked in _beside(batches, lambda held: _verified(held, length)):
        kept, removed, spans = _keep(text, *checked(text), length)
        out.append((doc, kept, len(text or b""), removed, spans))
        size += len(kept)
        if size > 8 << 20 or len(out) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per input row: id_col, kept (the bytes that are left), n_bytes, n_removed, n_spans.

    Identifiers are integers. Defined results: a null text is empty; rows with a null identifier lose
    nothing and take nothing from others; rows that repeat an identifier take nothing from each other;
    texts under `length` bytes lose nothing. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    buckets, sizes = shuffle_width(spark), lengths_of(length)
    blob = F.col(text_col).cast("string").cast("binary")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(blob).alias("sig"), blob.alias("blob"))
    schema = "bucket int, kind int, blob binary"

    def mapped(df: DataFrame, f: Callable, *rest: int, schema: str = schema) -> DataFrame:
        return df.mapInArrow(lambda batches: f(batches, buckets, *rest), schema)

    def by_bucket(df: DataFrame) -> DataFrame:
        return df.repartitionById(buckets, "bucket")

    def beside(found: DataFrame) -> DataFrame:
        """Findings and texts, by bucket; findings first, texts in one order, so that a second attempt folds alike. `_bucket` deals out the texts."""
        bucket = F.pmod(F.coalesce("doc", F.lit(0)).bitwiseXOR(F.col("sig")), F.lit(buckets).cast("long")).cast("int")
        own = texts.select(bucket.alias("bucket"), F.lit(TEXT).alias("kind"), "blob", "doc", "sig")
        none = F.lit(None).cast("long")
        return by_bucket(found.select("*", none.alias("doc"), none.alias("sig")).unionByName(own)).sortWithinPartitions("bucket", "kind", "doc", "sig")

    met = written(mapped(by_bucket(mapped(texts, _first_runs, length)), _met, length), "met")
    pairs, parts = mapped(beside(met.where(F.col("kind") == OPEN)), _first_pairs, length, schema=PAIRS), [met]

    def ordered() -> DataFrame:
        return pairs.repartition(buckets, "r1", "r2").sortWithinPartitions("r1", "r2", "doc", "sig", "at")

    for a, b in zip(sizes[1:-1], sizes[2:]):
        tied = written(mapped(ordered(), _reranked, schema="r long, doc long, sig long, at int"), "ranks")
        parts.append(tied)
        further = tied.select("doc", "sig", (F.col("at") - (b - a)).alias("at"), F.col("r").alias("r2"))
        pairs = tied.withColumnRenamed("r", "r1").join(further, ["doc", "sig", "at"]) \
            .select("r1", "r2", "doc", "sig", "at", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("blob"))
    doubled = written(mapped(ordered(), _repeated), "doubled")
    claims = met.where(F.col("kind") == CLAIM).union(doubled)
    asked = written(mapped(by_bucket(claims), _asked, length), "asked")
    discard(*parts, doubled)
    sources = written(mapped(beside(asked.where(F.col("kind") == ASK)), _fetched), "sources")
    found = asked.where(F.col("kind") == CLAIM).union(sources)
    done = mapped(beside(found), _cut, length, schema="own long, kept binary, n_bytes long, n_removed long, n_spans long")
    return done.select(F.col("own").alias(id_col), "kept", "n_bytes", "n_removed", "n_spans")


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """id_col, n_bytes, n_removed, n_spans, kept_sha256 of remove_repeats."""
    rows = remove_repeats(docs, id_col, text_col, length)
    return rows.select(id_col, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
