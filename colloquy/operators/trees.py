"""Reply trees (J11): every transitive non-empty reply of an anchor message,
depth-first pre-order.

Pointer doubling: every reply holds a pointer to an ancestor and the ids on
the way to it. A round joins each pointer with the row it points at and takes
over that row's pointer, so the way doubles; a chain of n replies is resolved
in about log2(n) rounds, whatever the number of anchors. Anchors on the way
are carried along with their distance, so the final rows are read off a
reply's own row. Rows that have arrived at the top of their tree are set
aside, and the rounds go on with the others only.

Sorting by the ``path`` array gives pre-order with siblings in id order. An
empty reply is not followed, so its subtree is pruned, as in the original.
Replies whose way runs into a cycle (their own id stands on it) are followed
level by level instead, with a visited check on the path.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .filters import non_empty

COLUMNS = ["anchor_id", "id", "depth", "path"]


def reply_tree(messages: DataFrame, anchors: DataFrame) -> DataFrame:
    """messages: id, parent_message_id, content; anchors: id.
    Returns (anchor_id, id, depth, path ARRAY<BIGINT>)."""
    edges = (non_empty(messages)
             .filter(F.col("parent_message_id").isNotNull())
             .select("id", F.col("parent_message_id").alias("top")))
    wanted = anchors.select(F.col("id").cast("bigint").alias("anchor_id")).where("anchor_id IS NOT NULL").distinct()
    ended, cyclic, _ = ways_up(edges, wanted)
    # what a way ends at is an anchor, or is not
    at_top = wanted.withColumnRenamed("anchor_id", "top").withColumn("_a", F.lit(True))
    last = F.when(F.col("_a"), F.array(F.struct(F.col("top").alias("a"), F.size("way").alias("d")))) \
        .otherwise(F.array().cast("array<struct<a:bigint,d:int>>"))
    found = (ended.join(at_top, "top", "left")
             .select("id", "way", F.explode(F.concat("marks", last)).alias("m"))
             .select(F.col("m.a").alias("anchor_id"), "id", F.col("m.d").alias("depth"),
                     F.slice("way", F.size("way") - F.col("m.d") + 1, F.col("m.d")).alias("path")))
    if cyclic is None:
        return found
    loops = edges.join(cyclic.select("id").distinct(), "id", "left_semi")
    return found.unionByName(_by_level(loops, wanted.join(loops, F.col("anchor_id") == loops["id"], "left_semi")))


def ways_up(edges: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows that have arrived, rows that run into a cycle or None, rounds) for
    ``edges`` (id, top: its parent). A row: id, top (the ancestor the way ends
    at), way (ids from below ``top`` down to ``id``), marks (the anchors
    between, with their distance from ``id``), mine (whether id is an anchor)."""
    mine = anchors.select(F.col("anchor_id").alias("id"), F.lit(True).alias("_m"))
    state = edges.select(F.col("id").cast("bigint").alias("id"), F.col("top").cast("bigint").alias("top")).distinct() \
        .join(mine, "id", "left").select("id", "top", F.array("id").alias("way"),
                                         F.array().cast("array<struct<a:bigint,d:int>>").alias("marks"),
                                         F.coalesce("_m", F.lit(False)).alias("mine"), F.lit("on").alias("state"))
    moving, settled, rounds = cut_lineage(state), [], 0
    for rounds in itertools.count(1):  # ends: every way reaches its top or its own id again
        known = moving
        for s in settled:
            known = known.unionByName(s)
        step = _doubled(moving, known)
        step = cut_lineage(step)
        settled.append(step.where("state != 'on'"))
        moving = step.where("state = 'on'")
        if moving.isEmpty():
            break
    every = settled[0]
    for s in settled[1:]:
        every = every.unionByName(s)
    cyclic = every.where("state = 'cycle'")
    return (every.where("state = 'top'").select("id", "top", "way", "marks"),
            None if cyclic.isEmpty() else cyclic, rounds)


def _doubled(moving: DataFrame, known: DataFrame) -> DataFrame:
    """The rows on the move, one jump further: each takes over the way of the
    row that it points at."""
    k = known.select(F.col("id").alias("top"), F.col("top").alias("_top"), F.col("way").alias("_way"),
                     F.col("marks").alias("_marks"), F.col("mine").alias("_mine"), F.col("state").alias("_state"))
    # its own column: a name inside a lambda may resolve to the new ``way`` of the same select
    size = F.col("_n")
    here = F.when(F.col("_mine"), F.array(F.struct(F.col("top").alias("a"), size.alias("d")))) \
        .otherwise(F.array().cast("array<struct<a:bigint,d:int>>"))
    above = F.transform("_marks", lambda m: F.struct(m["a"].alias("a"), (m["d"] + size).alias("d")))
    met = F.col("_top").isNotNull()
    loop = F.array_contains("way", F.col("top")) | (F.col("_state") == "cycle") \
        | F.array_contains(F.concat("_way", "way"), F.col("_top"))
    state = F.when(~met, "top").when(loop, "cycle").when(F.col("_state") == "top", "top").otherwise("on")
    go = met & ~loop
    return moving.withColumn("_n", F.size("way")).join(k, "top", "left").select(
        "id", F.when(go, F.col("_top")).otherwise(F.col("top")).alias("top"),
        F.when(go, F.concat("_way", "way")).otherwise(F.col("way")).alias("way"),
        F.when(go, F.concat("marks", here, above)).otherwise(F.col("marks")).alias("marks"),
        "mine", state.alias("state"))


def _by_level(edges: DataFrame, anchors: DataFrame) -> DataFrame:
    """The reply trees inside cycles, one join per level; a path never visits a
    message twice."""
    child = edges.select(F.col("top").alias("_parent"), F.col("id").alias("_child"))
    frontier = anchors.select("anchor_id", F.col("anchor_id").alias("id"), F.array().cast("array<bigint>").alias("path"))
    levels: list[DataFrame] = []
    for depth in itertools.count(1):
        nxt = (frontier.join(child, frontier.id == child._parent, "inner")
                       .filter(~F.array_contains("path", F.col("_child"))
                               & (F.col("_child") != F.col("anchor_id")))
                       .select("anchor_id", F.col("_child").alias("id"),
                               F.array_append("path", F.col("_child")).alias("path")))
        nxt = cut_lineage(nxt)  # each level is a finished, reliable table
        levels.append(nxt.withColumn("depth", F.lit(depth)).select(*COLUMNS))
        if nxt.isEmpty():
            break
        frontier = nxt
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out
