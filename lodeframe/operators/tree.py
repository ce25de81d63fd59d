"""Hierarchies as adjacency rows (node, parent, position). The logarithm of the depth sets the number of joins: pointers double."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import unicode_trim
from ..shared import checkpointed


def _ahead(state: DataFrame, by: list[str], *carried: str) -> tuple[DataFrame, Column]:
    """The rows that a pointer `up` leads to, under other names, and the condition that it does."""
    far = state.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("node").alias("__at"), *[F.col(c).alias(f"__{c}") for c in carried])
    on = F.col("up") == F.col("__at")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return far, on


def ancestry(nodes: DataFrame, group: str | None = None) -> DataFrame:
    """[group,] node, level (1 without a parent), reason of every node; with `group`, parents are looked up in the node's own group.

    reason is null, or why the node has no level: 'missing' where it or an ancestor names a parent that is no node, 'cycle' where its
    ancestors never end. A round doubles the distance that every pointer covers, so 1,000 levels take ten.
    """
    by = [group] if group else []
    state = checkpointed(nodes.select(*by, "node", F.col("parent").alias("up"), F.lit(1).alias("level"), F.lit(False).alias("lost")))
    for _ in range(math.ceil(math.log2(state.count() + 1)) + 1):
        moving = state.where("up IS NOT NULL AND NOT lost")
        if moving.isEmpty():
            break
        far, on = _ahead(state, by, "up", "level", "lost")
        moved = moving.join(far, on, "left").select(*by, "node", F.col("__up").alias("up"), (F.col("level") + F.coalesce("__level", F.lit(0))).alias("level"),
                                                    F.coalesce("__lost", F.lit(True)).alias("lost"))
        state = checkpointed(state.where("up IS NULL OR lost").unionByName(moved))
    reason = F.when(F.col("lost"), "missing").when(F.col("up").isNotNull(), "cycle")
    return state.select(*by, "node", F.when(reason.isNull(), F.col("level")).alias("level"), reason.alias("reason"))


def renumber(nodes: DataFrame, group: str | None = None) -> DataFrame:
    """[group,] node, level, numbering (dotted, by position among siblings); with `group`, a tree in each. Any depth.

    Nodes that hang on a cycle or on a parent that is no node are there too, without level and numbering (`ancestry` says why).
    """
    by = [group] if group else []
    levels = checkpointed(ancestry(nodes, group).drop("reason"))
    place = F.row_number().over(Window.partitionBy(*by, "parent").orderBy("position", "node")).cast("string")
    names = [F.col(c).alias(f"__{c}") for c in by]
    same = F.col("node") == F.col("__node")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    own = levels.where("level IS NOT NULL").select(*names, F.col("node").alias("__node"), "level")
    # Only what hangs on a root is numbered: a path on a cycle would double without an end.
    state = checkpointed(nodes.select(*by, "node", F.col("parent").alias("up"), place.alias("path")).join(own, same).select(*by, "node", "up", "path", "level"))
    deepest = state.agg(F.max("level")).first()[0] or 1
    for _ in range(math.ceil(math.log2(deepest))):
        far, on = _ahead(state, by, "up", "path")
        moved = state.where("up IS NOT NULL").join(far, on).select(*by, "node", F.col("__up").alias("up"), F.concat_ws(".", "__path", "path").alias("path"), "level")
        state = checkpointed(state.where("up IS NULL").unionByName(moved))
    hanging = levels.where("level IS NULL").select(*by, "node", "level", F.lit(None).cast("string").alias("numbering"))
    return state.select(*by, "node", "level", F.col("path").alias("numbering")).unionByName(hanging)


def without_subtree(nodes: DataFrame, root: str) -> DataFrame:
    """The nodes that are neither `root` nor below it; a cycle below it ends where it closes."""
    gone = checkpointed(nodes.where(F.col("node") == F.lit(root)).select("node").distinct())
    level = gone
    while not level.isEmpty():
        found = nodes.join(level.select(F.col("node").alias("up")), F.col("parent") == F.col("up"), "left_semi").select("node").distinct()
        level = checkpointed(found.join(gone, "node", "left_anti"))
        gone = checkpointed(gone.union(level))
    return nodes.join(gone, "node", "left_anti").select(*nodes.columns)


def cycles(nodes: DataFrame) -> DataFrame:
    """Nodes that are their own ancestor, at any distance. Only nodes whose ancestors never end are followed, until no new ancestor appears."""
    endless = ancestry(nodes).where("reason = 'cycle'").select("node")
    up = checkpointed(nodes.where("parent IS NOT NULL").join(endless, "node", "left_semi").selectExpr("node", "parent AS ancestor").distinct())
    size, seen = up.count(), -1
    while size != seen:
        seen = size
        further = up.alias("a").join(up.alias("b"), F.expr("a.ancestor = b.node")).selectExpr("a.node", "b.ancestor")
        up = checkpointed(up.union(further).distinct())
        size = up.count()
    return up.where("node = ancestor").select("node")


def parent_problems(nodes: DataFrame, group: str) -> DataFrame:
    """node, reason of each node whose parent is refused: 'self', 'missing' (no node of the same group, for it or an ancestor), 'cycle'.

    A blank parent is none. A node below a cycle is refused too: its ancestors never end.
    """
    parent = F.nullif(unicode_trim(F.col("parent")), F.lit(""))
    rows = nodes.select(F.col(group).alias("g"), "node", parent.alias("parent"))
    own = rows.where("parent = node").select(F.col("g").alias("__g"), F.col("node").alias("__own"))
    found = ancestry(rows, "g").where("reason IS NOT NULL").join(own, F.col("g").eqNullSafe(F.col("__g")) & (F.col("node") == F.col("__own")), "left")
    return found.select(F.col("g").alias(group), "node", F.when(F.col("__own").isNotNull(), "self").otherwise(F.col("reason")).alias("reason"))


def node_count(nodes: DataFrame, group: str) -> DataFrame:
    """Nodes of each tree, whatever their depth: the adjacency form has a row a node."""
    return nodes.groupBy(group).agg(F.count(F.lit(1)).alias("nodes"))


def with_ids(nodes: DataFrame, id_col: str = "node", seed: Column | None = None) -> DataFrame:
    """Blank identifiers get new ones: random, or a hash of `seed`, which is the same in a second run."""
    blank = F.coalesce(unicode_trim(F.col(id_col)) == "", F.lit(True))
    new = F.expr("uuid()") if seed is None else F.concat(F.lit("node_"), F.substring(F.sha2(seed.cast("string").cast("binary"), 256), 1, 24))
    return nodes.withColumn(id_col, F.when(blank, new).otherwise(F.col(id_col)))


def new_id() -> str:
    return str(uuid.uuid4())
