"""Line dedup: exact copies and lines one word apart, by a deletion-neighbourhood join.

Two lines are near duplicates if one word inserted, deleted or replaced makes them equal and both have at
least MIN_WORDS words (so they are at least 0.8 similar); shorter lines only match exactly. White space
and the case of letters: runs of white space count as one space; case counts.

Each candidate line emits its n deletion variants and its n + 1 gaps as hashed keys. A variant's key is
(hash of the words before the hole, hash of the words after it, words left). Two lines that lack the
same word slot are one replacement apart; a line's deletion that equals another line's gap is one
insertion apart. So the least position under a key tells for all its lines what they duplicate: no pairs
within a group are made. What the keys find is verified on the words.

Variants are emitted for candidates only: a line within one word of another shares its first or its
last m words with it (m: the largest power of two up to half the words), and most lines share neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, written

MIN_WORDS = 5
#: Words of a long line are indexed in pieces of this size, so that the work on a line is linear in it.
PIECE = 512
#: Word hashes are cut to 40 bits: sums over 8 million words still fit in 63.
_KEEP_BITS = 40
LAST = (1 << 63) - 1


def _norm(line: Column) -> Column:
    """White space runs as one space, none at the ends; the regular expression only runs where there is work for it."""
    odd = line.contains("  ")
    for control in "\t\x0b\x0c\r":
        odd = odd | line.contains(control)
    return F.trim(F.when(odd, F.regexp_replace(line, SPACES, " ")).otherwise(line))


def _position(doc: Column, line: Column, kind: str) -> Column:
    """Document, then line; null documents come last. A number for whole numbers, which sort fastest."""
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        return F.struct(doc.isNull().alias("none"), doc.alias("doc"), line.alias("line"))
    doc = F.coalesce(doc.cast("decimal(20,0)"), F.lit(LAST).cast("decimal(20,0)"))
    return (doc * F.lit(1 << 32).cast("decimal(10,0)") + line.cast("decimal(10,0)")).cast("decimal(38,0)")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """__id, __sig, __text: a row of the input is named by its identifier and a hash of its text."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__sig"), text.alias("__text"))


def _masks(rows: DataFrame, *by: str, name: str) -> DataFrame:
    """The groups' `__line` numbers as bytes, a 1 at the place of each: looked up in one step, whatever the number of lines."""
    rows = rows.groupBy(*by).agg(F.array_sort(F.collect_set("__line")).alias("lines"))
    before = F.concat(F.array(F.lit(-1)), F.slice("lines", 1, F.size("lines") - 1))
    marks = F.zip_with("lines", before, lambda x, y: F.concat(F.repeat(F.lit("0"), x - y - 1), F.lit("1")))
    return rows.select(*by, F.array_join(marks, "").cast("binary").alias(name))


def _marked(mask: Column, line: Column) -> Column:
    return F.substring(mask, line + 1, F.lit(1)) == F.lit(b"1")


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """__id, __sig, __line, norm, k1, k2, pos, n of every line that has a word."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = _rows(docs, id_col, text_col).select("__id", "__sig", F.posexplode(F.split("__text", "\n")).alias("__line", "raw"))
    rows = rows.select("__id", "__sig", "__line", _norm(F.col("raw")).alias("norm")).where("norm != ''")
    return rows.select("__id", "__sig", "__line", "norm", F.xxhash64("norm").alias("k1"), F.xxhash64(F.lit(1), "norm").alias("k2"),
                       _position(F.col("__id"), F.col("__line"), kind).alias("pos"),
                       (F.octet_length("norm") - F.octet_length(F.replace("norm", F.lit(" "), F.lit(""))) + 1).alias("n"))


def _halves() -> Column:
    """Keys of the first and last m words, for the m of this word count and that of one word less."""
    def ends(size: Column) -> list[Column]:
        return [F.xxhash64(F.lit(side), size, F.call_function("substring_index", F.col("norm"), F.lit(" "), size * side)) for side in (1, -1)]

    own, less = _half(F.col("n")), _half(F.col("n") - 1)
    # The two only differ where the count is a power of two.
    return F.when(F.col("n") >= MIN_WORDS, F.when(own == less, F.array(*ends(own))).otherwise(F.array(*ends(own), *ends(less))))


def _half(n: Column) -> Column:
    """The largest power of two up to n / 2."""
    return F.pow(F.lit(2.0), F.floor(F.log2(n / 2.0))).cast("int")


def _quarters() -> Column:
    """(h, lo, hi): keys of what stays where the words lo to hi hold the one that differs.

    With m words the same at one end, of the next m / 2 words and the last m / 2 one part stays too.
    """
    words, n = F.col("words"), F.col("n")
    head, foot = lambda k: F.slice(words, 1, k), lambda k: F.slice(words, n - k + 1, k)
    none = F.array().cast("array<string>")

    def parts(m: Column) -> list[Column]:
        q = F.greatest((m / 2).cast("int"), F.lit(1))
        return [F.struct(F.xxhash64(F.lit(tag), m, x, y).alias("h"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
                for tag, x, y, lo, hi in ((1, head(m + q), none, m + q + 1, n), (2, head(m), foot(q), m + 1, n - q),
                                          (3, none, foot(m + q), F.lit(1), n - m - q), (4, head(q), foot(m), q + 1, n - m))]

    own, less = _half(n), _half(n - 1)
    return F.when(own == less, F.array(*parts(own))).otherwise(F.array(*parts(own), *parts(less)))


def _variants(candidates: DataFrame) -> DataFrame:
    """cid, kind (0: a deletion, 1: a gap), key: the hashed keys of each candidate's neighbourhood.

    Only holes from `lo` to `hi` count: a partner that shares the first m words differs behind them, one
    that shares the last m words differs before them.
    """
    def word_hash(w: Column, tag: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(w, tag), 64 - _KEEP_BITS)

    pieces = F.transform(F.sequence(F.lit(0), F.expr(f"(n - 1) div {PIECE}").cast("int")),
                         lambda s: F.struct(s.alias("s"), F.slice("words", s * PIECE + 1, PIECE).alias("w")))
    rows = candidates.select("cid", "n", "lo", "hi", F.explode(pieces).alias("p")).select("cid", "n", "lo", "hi", "p.s", "p.w")
    rows = rows.withColumn("ahead", F.transform("w", lambda w, i: word_hash(w, F.col("s") * PIECE + i))) \
        .withColumn("back", F.transform("w", lambda w, i: word_hash(w, F.col("n") - (F.col("s") * PIECE + i) + (1 << 30))))
    zero = F.lit(0).cast("long")
    rows = rows.withColumn("sum_a", F.aggregate("ahead", zero, lambda x, y: x + y)) \
        .withColumn("sum_b", F.aggregate("back", zero, lambda x, y: x + y))
    line = Window.partitionBy("cid").orderBy("s")
    rows = rows.withColumn("before", F.coalesce(F.sum("sum_a").over(line.rowsBetween(Window.unboundedPreceding, -1)), zero)) \
        .withColumn("after", F.coalesce(F.sum("sum_b").over(line.rowsBetween(1, Window.unboundedFollowing)), zero))
    running = lambda values: F.aggregate(  # noqa: E731  the sums of 0, 1, 2, ... values
        values, F.array(zero), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    rows = rows.withColumn("ra", running(F.col("ahead"))).withColumn("rb", running(F.col("back")))
    # Word i of the piece has ra[i] before it in the piece, and sum_b - rb[i + 1] after it.
    base = F.col("s") * PIECE
    last = (F.col("s") == F.expr(f"(n - 1) div {PIECE}")).cast("int")
    first_hole = F.greatest(F.col("lo") - 1 - base, F.lit(0)).cast("int")
    last_hole = F.least(F.col("hi") - 1 - base, F.size("w") - 1).cast("int")
    last_gap = F.least(F.col("hi") - base, F.size("w") - 1 + last).cast("int")

    def keys(kind: int, upto: Column, after: int, left: Column) -> Column:
        return F.when(upto >= first_hole, F.transform(F.sequence(first_hole, upto), lambda i: F.struct(
            F.lit(kind).alias("kind"), F.xxhash64(F.col("before") + F.get("ra", i),
                                                  F.col("after") + F.col("sum_b") - F.get("rb", i + after), left).alias("key")))) \
            .otherwise(F.array().cast("array<struct<kind:int,key:bigint>>"))

    both = F.concat(keys(0, last_hole, 1, F.col("n") - 1), keys(1, last_gap, 0, F.col("n")))
    return rows.select("cid", F.explode(both).alias("v")).select("cid", "v.kind", "v.key")


def _one_word_apart(x: Column, y: Column) -> Column:
    """Whether two different word arrays differ by one word inserted, deleted or replaced."""
    nx, ny = F.size(x), F.size(y)
    short = F.least(nx, ny)
    at = F.coalesce(F.array_position(F.zip_with(F.slice(x, 1, short), F.slice(y, 1, short), lambda a, b: a == b), False), F.lit(0))
    at = F.when(at == 0, short + 1).otherwise(at).cast("int")  # the first word that differs, from 1
    tail = lambda words, start: F.slice(words, start, F.greatest(F.size(words) - start + 1, F.lit(0)))
    return F.when(nx == ny, tail(x, at + 1) == tail(y, at + 1)) \
        .when(nx == ny + 1, tail(x, at + 1) == tail(y, at)) \
        .when(ny == nx + 1, tail(x, at) == tail(y, at + 1)).otherwise(False)


def _candidates(docs: DataFrame, firsts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """cid (in the order of pos), pos, words, n, lo, hi of the distinct lines that share three quarters with another.

    Halves are compared first, as hashes, over all lines; only lines that share one are fetched.
    """
    keyed = firsts.where(F.col("halves").isNotNull()).select("__id", "__sig", "__line", F.explode("halves").alias("h"))
    shared = written(keyed.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h"), "halves")
    wanted = keyed.join(shared, "h", "left_semi").select(F.col("__id").alias("__doc"), F.col("__sig").alias("__own"), "__line")
    by_doc = written(_masks(wanted, "__doc", "__own", name="want"), "wanted")
    # What is wanted grows with the corpus: never a broadcast. Rows that repeat are one.
    texts = _rows(docs, id_col, text_col).join(by_doc.hint("merge"), F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__sig") == F.col("__own")))
    numbered = F.transform(F.split("__text", "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("raw")))
    rows = texts.select("__id", F.explode(F.filter(numbered, lambda s: _marked(F.col("want"), s["i"]))).alias("y"))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = rows.select(_position(F.col("__id"), F.col("y.i"), kind).alias("pos"), F.split(_norm(F.col("y.raw")), " ").alias("words"))
    rough = written(rows.withColumn("n", F.size("words")), "rough")
    finer = written(rough.select("pos", F.explode(_quarters()).alias("x")).select("pos", "x.*"), "quarters")
    shared = finer.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h")
    kept = finer.join(shared, "h", "left_semi").groupBy("pos").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    rows = rough.join(kept, "pos").orderBy("pos").withColumn("cid", F.monotonically_increasing_id())
    return written(rows, "candidates")


def near_lines(docs: DataFrame, firsts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """pos of the distinct lines' first positions that an earlier line is one word apart from."""
    candidates = _candidates(docs, firsts, id_col, text_col)
    index = written(_variants(candidates), "variants")
    where_d, where_g = F.when(F.col("kind") == 0, F.col("cid")), F.when(F.col("kind") == 1, F.col("cid"))
    groups = index.groupBy("key").agg(F.min(where_d).alias("d0"), F.max(where_d).alias("d1"), F.min(where_g).alias("g0"),
                                      F.max(where_g).alias("g1"), F.count(F.lit(1)).alias("c"))
    # A key with gaps alone, or with one line's, says nothing.
    groups = written(groups.where("c > 1 and d0 is not null and (d1 > d0 or g1 is not null)"), "neighbours")
    two = groups.where("c = 2").select(F.when(F.col("g0").isNull(), F.col("d1")).otherwise(F.greatest("d0", "g0")).alias("late"),
                                       F.when(F.col("g0").isNull(), F.col("d0")).otherwise(F.least("d0", "g0")).alias("early"))
    more = index.join(groups.where("c > 2").select("key", "d0", "g0"), "key") \
        .withColumn("early", F.when(F.col("kind") == 0, F.least("d0", "g0")).otherwise(F.col("d0"))) \
        .select(F.col("cid").alias("late"), "early")
    found = written(two.union(more).where("early < late").distinct(), "found")
    checked = found.join(candidates.select(F.col("cid").alias("late"), "pos", F.col("words").alias("x")), "late") \
        .join(candidates.select(F.col("cid").alias("early"), F.col("pos").alias("first"), F.col("words").alias("y")), "early")
    # Rows that repeat an identifier give candidates of equal position, which don't count for each other.
    return checked.where((F.col("first") < F.col("pos")) & _one_word_apart(F.col("x"), F.col("y"))).select("pos").distinct()


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__id, __sig, drop: a mask of the lines that a row loses, for each row that loses any."""
    lines = lines_of(docs, id_col, text_col)
    occurrences = written(lines.withColumn("halves", _halves()).select("__id", "__sig", "__line", "k1", "k2", "pos", "halves"), "lines")
    first = F.min(F.struct("pos", "__id", "__sig", "__line", "halves")).alias("first")
    firsts = written(occurrences.groupBy("k1", "k2").agg(first, F.count(F.lit(1)).alias("c")).select("k1", "k2", "c", "first.*"), "firsts")
    near = written(near_lines(docs, firsts, id_col, text_col), "near")
    marked = firsts.join(near.select(F.col("pos").alias("late")), F.col("pos") == F.col("late"), "left") \
        .where(F.col("late").isNotNull() | (F.col("c") > 1)) \
        .select("k1", "k2", F.when(F.col("late").isNull(), F.col("pos")).alias("first"))
    marked = written(marked, "marked")
    gone = occurrences.join(marked, ["k1", "k2"]).where(F.col("first").isNull() | (F.col("pos") > F.col("first")))
    return _masks(gone, "__id", "__sig", name="drop")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_cols: tuple[str, str] | None = None) -> DataFrame:
    """The rows with all their columns, without the lines that an earlier line duplicates.

    Earlier: in a document with a smaller identifier, or further up in the same. count_cols adds the
    numbers of lines and of removed lines under those names.

    Defined results: a null text stays null; blank lines are kept; a text whose lines are all removed is
    empty. Identifiers are of any type that has an order; null ones come last. Lines of equal position (rows that repeat an
    identifier, or whose identifier is null) don't duplicate each other. An empty table gives no rows. No column's name matters.
    """
    gone = written(dropped_lines(docs, id_col, text_col), "gone").select(F.col("__id").alias("lost"), F.col("__sig").alias("lost_sig"), "drop")
    rows = docs.select(F.struct("*").alias("doc"))
    own = F.col("doc").getField(text_col)
    # What is lost grows with the corpus: never a broadcast.
    joined = rows.join(gone.hint("merge"), F.col("doc").getField(id_col).eqNullSafe(F.col("lost")) & (F.xxhash64(own.cast("string")) == F.col("lost_sig")), "left")
    numbered = F.transform(F.split(own, "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    kept = F.when(F.col("drop").isNotNull(), F.transform(F.filter(numbered, lambda s: ~_marked(F.col("drop"), s["i"])), lambda s: s["x"]))
    named = joined.select("doc", kept.alias("kept"))
    text = F.when(F.col("kept").isNull(), own).otherwise(F.array_join("kept", "\n"))
    out = [text.alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in docs.columns]
    if count_cols:
        lines = F.coalesce(F.length(own) - F.length(F.replace(own, F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long")
        left = F.when(F.col("kept").isNull(), lines).otherwise(F.size("kept").cast("long"))
        out += [lines.alias(count_cols[0]), (lines - left).alias(count_cols[1])]
    return named.select(*out)
