"""Lists, lookups and pages of the relational layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE_SIZE, PAGE_MOST = 20, 200


def page_bounds(page: int = 1, size: int = PAGE_SIZE, lenient: bool = False) -> tuple[int, int]:
    """(offset, limit); out of range: an error, or the nearest valid value."""
    if lenient:
        page, size = max(1, page), min(max(1, size), PAGE_MOST)
    if page < 1 or not 1 <= size <= PAGE_MOST:
        raise ValueError(f"page must be positive and size from 1 to {PAGE_MOST}")
    return (page - 1) * size, size


def page(rows: DataFrame, *order: Column, number: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    offset, limit = page_bounds(number, size)
    return rows.orderBy(*order).offset(offset).limit(limit)


def page_with_total(rows: DataFrame, *order: Column, number: int = 1, size: int = PAGE_SIZE, total: str = "total") -> DataFrame:
    """A page and, in every row, how many rows all pages have: one aggregated row joined to the page's few."""
    return page(rows, *order, number=number, size=size).crossJoin(rows.agg(F.count(F.lit(1)).alias(total)))


#: The orders a list can be asked for; anything else is the first one.
ORDERS = {"-updatedAt": ("updated_at", False), "updatedAt": ("updated_at", True), "-createdAt": ("created_at", False), "createdAt": ("created_at", True)}


def list_order(name: str, key: str = "id") -> list[Column]:
    """The order of that name; the key always falls."""
    column, rising = ORDERS.get(name, ORDERS["-updatedAt"])
    return [F.asc(column) if rising else F.desc(column), F.desc(key)]


def with_first_block(messages: DataFrame, blocks: DataFrame) -> DataFrame:
    """messages (id) with the content of their block number 0, null where there is none; blocks: message_id, block_order, content."""
    first = blocks.where("block_order = 0").select(F.col("message_id").alias("__m"), "content")
    return messages.join(first, F.col("id") == F.col("__m"), "left").drop("__m")


def with_previews(conversations: DataFrame, messages: DataFrame, blocks: DataFrame, size: int = 200) -> DataFrame:
    """conversations (id) with message_count and last_message_preview: the start of the newest message that has a block 0, '' where none has.

    messages: id, conversation_id, sequence_no; blocks: message_id, block_order, content. Both are folded a conversation before the join.
    """
    first = blocks.where("block_order = 0").select(F.col("message_id").alias("__m"), F.coalesce(F.substring("content", 1, size), F.lit("")).alias("__t"))
    rows = messages.join(first, F.col("id") == F.col("__m"), "left")
    there = F.when(F.col("__m").isNotNull(), F.struct("sequence_no", "id"))
    per = rows.groupBy(F.col("conversation_id").alias("__c")).agg(F.count_distinct("id").alias("__n"), F.max_by("__t", there).alias("__last"))
    return conversations.join(per, F.col("id") == F.col("__c"), "left").select(
        *conversations.columns, F.coalesce("__n", F.lit(0)).cast("long").alias("message_count"), F.coalesce("__last", F.lit("")).alias("last_message_preview"))


def insert_looked_up(rows: DataFrame, lookup: DataFrame, on: str, code: str, wanted: list[str]) -> DataFrame:
    """The rows to insert: `rows` with the columns of the lookup rows that they name; rows that name none insert nothing."""
    found = lookup.select(F.col(code).alias("__c"), *wanted)
    return rows.join(found, F.col(on) == F.col("__c")).drop("__c")


def with_counts(rows: DataFrame, key: str, children: DataFrame, child_key: str, name: str) -> DataFrame:
    """Left join to counts of children, which are aggregated before the join; 0 where there are none."""
    counts = children.groupBy(F.col(child_key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    return rows.join(counts, F.col(key) == F.col("__k"), "left").withColumn(name, F.coalesce("__n", F.lit(0)).cast("long")).drop("__k", "__n")


def latest_per(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def in_given_order(rows: DataFrame, key: str, ids: list) -> DataFrame:
    """The rows of the ids, with their place in the list."""
    place = F.array_position(F.array(*[F.lit(i) for i in ids]), F.col(key))
    return rows.where(F.col(key).isin(ids)).withColumn("place", place).orderBy("place", key)


def set_difference(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """What either side lacks: key, side ('missing' or 'unexpected'); nulls are equal.

    Keys are dealt before they are grouped: a task holds those of its part, not all that it reads, and both sides are grouped once.
    """
    both = expected.select(key, F.lit(True).alias("__left")).unionByName(actual.select(key, F.lit(False).alias("__left")))
    rows = both.repartition(key).groupBy(key).agg(F.bool_or("__left").alias("__a"), F.bool_or(~F.col("__left")).alias("__b")).where("__a <> __b")
    return rows.select(key, F.when(F.col("__a"), "missing").otherwise("unexpected").alias("side"))


def append_numbered(old: DataFrame, new: DataFrame, group: str, order: list[str], number: str) -> DataFrame:
    """New rows with numbers that go on from their group's largest."""
    top = old.groupBy(F.col(group).alias("__g")).agg(F.max(number).alias("__top"))
    w = Window.partitionBy(group).orderBy(*order)
    return new.withColumn("__rn", F.row_number().over(w)).join(top, F.col(group) == F.col("__g"), "left") \
        .withColumn(number, (F.coalesce("__top", F.lit(0)) + F.col("__rn")).cast("long")).drop("__g", "__top", "__rn")


#: Rules that are matched against every row by broadcast: a table that people write by hand.
RULES_MOST = 10_000


def ranked_match(rows: DataFrame, kind: str, rules: DataFrame, name: str, *first: Column) -> DataFrame:
    """rows with the id of the best enabled rule (id, enabled, supported_content_types) for their content type, under `name`; null where none fits.

    A rule that names the type itself comes before one that names `major/*`, and that before one that names no type at all; a row
    without a type takes any rule. Among equals `first` decides, then the id. A rule is met by equal keys, never by comparing it with every row.
    """
    used = rules.where("enabled")
    small = used.limit(RULES_MOST + 1).count() <= RULES_MOST
    kinds, any_ = F.col("supported_content_types"), F.lit("\0")
    names = F.when(F.coalesce(F.size(kinds), F.lit(0)) > 0, F.array_distinct(kinds)).otherwise(F.array(F.lit("")))
    keyed = used.select(F.explode(F.concat(names, F.array(any_))).alias("__k"), F.col("id").alias("__id"), *[c.alias(f"__o{i}") for i, c in enumerate(first)])
    own = F.coalesce(F.col(kind), F.lit(""))
    types = rows.select(own.alias("__own")).distinct()
    wild = F.concat(F.split_part("__own", F.lit("/"), F.lit(1)), F.lit("/*"))
    asked = types.withColumn("__key", F.explode(F.when(F.col("__own") == "", F.array(any_)).otherwise(F.array_distinct(F.array(F.col("__own"), wild, F.lit(""))))))
    met = asked.join(F.broadcast(keyed) if small else keyed, F.col("__key") == F.col("__k"))
    rank = F.when(F.col("__own") == "", 0).when(F.col("__k") == "", 2).when(F.col("__k") == F.col("__own"), 0).otherwise(1)
    best = met.withColumn("__r", F.struct(rank.alias("r"), *[f"__o{i}" for i in range(len(first))], "__id")).groupBy("__own").agg(F.min("__r").alias("__b"))
    best = best.select(F.col("__own").alias("__t"), F.col("__b.__id").alias(name))
    return rows.join(best, own == F.col("__t"), "left").drop("__t")
