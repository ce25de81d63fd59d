"""Mixing sources to target weights: capped water-filling and seeded repetitions.

The level of the water is found in closed form: with sources in order of (cap / weight), a source is
clamped while the level that the others would share stands above it. All heavy work is two sums with
map-side combine, by source and by (source, slice of the draw); the windows run over one row a source
and over the rows of one slice in `SLICES`, never over a source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, written

#: A draw is a 48-bit number; its leading 12 bits name its slice.
DRAW_HEX, SLICES = 12, 4096


def _draw(id_col: str, seed: int):
    """A seeded number in [0, 2^48) that depends on the identifier alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, DRAW_HEX), 16, 10).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: int = 17) -> DataFrame:
    """__id, __source, __size (words of the text; null: 0), __draw."""
    return docs.select(
        F.col(id_col).alias("__id"), F.col(source_col).alias("__source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("__size"),
        _draw(id_col, seed).alias("__draw"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
                   max_epochs: float = 2.0) -> DataFrame:
    """A row per source: __source, __total, __target. Weights repeat over the sources by code point, null last."""
    by_name = Window.orderBy(F.col("__source").asc_nulls_last())
    per = sizes.groupBy("__source").agg(F.sum("__size").alias("__total")) \
        .withColumn("__rank", F.row_number().over(by_name))
    per = per.withColumn("__w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                             (F.col("__rank") - 1) % len(weights) + 1))
    cap = F.col("__total") * F.lit(float(max_epochs))
    order = Window.orderBy((cap / F.col("__w")).asc(), F.col("__rank").asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    per = per.withColumn("__cap", cap).withColumn(
        "__level", (F.sum("__total").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
        / F.sum("__w").over(after))
    per = per.withColumn("__clamped", F.col("__level") * F.col("__w") > F.col("__cap"))
    level = F.min(F.when(~F.col("__clamped"), F.struct("__cap_w", "__rank", "__level"))).over(whole)
    per = per.withColumn("__cap_w", F.col("__cap") / F.col("__w")).withColumn("__water", level["__level"])
    return per.select("__source", "__total", F.when(F.col("__clamped") | F.col("__water").isNull(), F.col("__cap"))
                      .otherwise(F.least(F.col("__water") * F.col("__w"), F.col("__cap"))).alias("__target"))


def source_cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds __whole (repetitions that every row gets) and __cut (draws below it get one more)."""
    targets = targets.withColumn("__whole", F.when(F.col("__total") > 0, F.floor(F.col("__target") / F.col("__total")))
                                 .otherwise(0).cast("long")) \
        .withColumn("__need", F.col("__target") - F.col("__whole") * F.col("__total"))
    slice_of = F.shiftright(F.col("__draw"), 4 * DRAW_HEX - 12).cast("int")
    slices = sizes.groupBy("__source", slice_of.alias("__slice")).agg(F.sum("__size").alias("__sum"))
    run = Window.partitionBy("__source").orderBy("__slice")
    part = targets.alias("t").join(slices.alias("s"), F.col("t.__source").eqNullSafe(F.col("s.__source"))) \
        .select(F.col("t.__source").alias("__source"), "__need", "__slice", "__sum") \
        .select("__source", "__need", "__slice", F.sum("__sum").over(run.rowsBetween(Window.unboundedPreceding, 0)).alias("__to"), "__sum")
    edge = written(part.where((F.col("__need") > 0) & (F.col("__to") > F.col("__need"))
                              & (F.col("__to") - F.col("__sum") <= F.col("__need")) & (F.col("__sum") > 0))
                   .select("__source", "__slice", (F.col("__need") - (F.col("__to") - F.col("__sum"))).alias("__rest")), "edges")
    rows = sizes.alias("z").join(edge.alias("e"), F.col("z.__source").eqNullSafe(F.col("e.__source")) & (slice_of == F.col("e.__slice"))) \
        .groupBy(F.col("e.__source").alias("__source"), "__rest", "__draw").agg(F.sum("__size").alias("__size"))
    run = Window.partitionBy("__source").orderBy("__draw").rowsBetween(Window.unboundedPreceding, 0)
    cut = rows.withColumn("__to", F.sum("__size").over(run)) \
        .groupBy("__source").agg(F.min(F.when(F.col("__to") - F.col("__size") / 2 > F.col("__rest"), F.col("__draw"))).alias("__first"),
                                 F.max("__draw").alias("__last"))
    cut = cut.select(F.col("__source").alias("__name"), F.coalesce(F.col("__first"), F.col("__last") + 1).alias("__cut"))
    joined = targets.join(cut, F.col("__source").eqNullSafe(F.col("__name")), "left")
    return joined.select("__source", "__total", "__target", "__whole", F.coalesce("__cut", F.lit(0)).cast("long").alias("__cut"))


def plan(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """The rows of `sizes` with __total, __target and __copies (how often the mix takes the row).

    The tables of one row a source are written, so that Spark knows their size when it plans the joins:
    small ones are broadcast by its own threshold, larger ones are not.
    """
    targets = written(source_targets(sizes, weights, share, max_epochs), "targets")
    cuts = written(source_cuts(sizes, targets), "cuts").withColumnRenamed("__source", "__name")
    return sizes.join(cuts, F.col("__source").eqNullSafe(F.col("__name"))).drop("__name") \
        .withColumn("__copies", F.col("__whole") + (F.col("__draw") < F.col("__cut")).cast("long"))


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights=(3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 17) -> DataFrame:
    """One row per input row: id_col, size, source_size, target (of its source), taken (words, repeats counted).

    Defined results: null texts have size 0; a null source is a source like any other and comes last;
    sources without words have target 0; rows that repeat an identifier share its draw. An empty table
    gives no rows. Other columns are ignored, whatever their names.
    """
    rows = plan(written(sized(docs, id_col, text_col, source_col, seed), "sizes"), weights, share, max_epochs)
    return rows.select(F.col("__id").alias(id_col), F.col("__size").alias("size"), F.col("__total").alias("source_size"),
                       F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 17, copy_col: str = "copy_no") -> DataFrame:
    """The mix itself: each input row as often as the plan takes it, numbered from 0 in copy_col.

    The rows keep all their columns. Texts don't move: the plan of a source is a few numbers, and each
    row's draw is computed where the row is. Defined results: rows without words, null texts too, follow their source's
    whole repetitions and draws; a null source is a source like any other; a null identifier draws like an empty text; rows that repeat
    are taken alike; an empty table gives no rows. Where the input has a column copy_col, the number's column gets underscores behind its name.
    """
    sizes = written(sized(docs, id_col, text_col, source_col, seed), "sizes")
    targets = written(source_targets(sizes, weights, share, max_epochs), "targets")
    cuts = written(source_cuts(sizes, targets), "cuts").select(F.col("__source").alias("name"), F.col("__whole").alias("whole"), F.col("__cut").alias("cut"))
    rows = docs.select(F.struct("*").alias("doc"), F.col(source_col).alias("own"), _draw(id_col, seed).alias("draw"))
    copies = (F.col("whole") + (F.col("draw") < F.col("cut")).cast("long")).cast("int")
    rows = rows.join(cuts, F.col("own").eqNullSafe(F.col("name"))).select("doc", copies.alias("copies")).where("copies > 0")
    (number,) = fresh(docs, copy_col)
    return rows.select("doc", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("number")).select("doc.*", F.col("number").alias(number))
