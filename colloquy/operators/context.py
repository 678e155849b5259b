"""Conversation context around anchor messages (range joins J2, J8, J9, J10).

All of these are "the n nearest rows of the same group in some order that
pass a filter". They share one plan: dense positions per group
(``with_positions``), then tiered equi-join probes (``neighbors``). Only ids
and the columns needed by the filters travel through the probes; message
text is joined once at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .filters import non_empty
from .ordering import neighbors, run_ends, with_positions


def _positioned(rows: DataFrame, key: str, order_col: str, tiebreak=(), runs: str | None = None) -> DataFrame:
    """Dense positions per key, written once: the anchors and every probe
    round read this narrow table instead of re-deriving the positions."""
    from ..session import cut_lineage
    pos = cut_lineage(with_positions(rows, [key], order_col, out="pos", tiebreak=tiebreak))
    return cut_lineage(run_ends(pos, key, runs)) if runs else pos


def conversation_context(messages: DataFrame, anchors: DataFrame, before: int = 10,
                         after: int = 25, exclude_author: bool = True,
                         slack: int = 5) -> DataFrame:
    """Per anchor message, the last ``before`` and first ``after``
    non-empty messages of its channel by id, skipping the anchor's author.

    messages: id, channel_id, author_id, content (+ anything)
    anchors : id (must be a non-empty message)
    Returns (anchor_id, side 'before'/'after', dist, id) where dist counts
    kept rows outward from the anchor."""
    elig = non_empty(messages).select("id", "channel_id", "author_id")
    pos = _positioned(elig, "channel_id", "id", runs="author_id" if exclude_author else None)
    anc = (anchors.select(F.col("id").alias("anchor_id")).join(
        pos.select(F.col("id").alias("anchor_id"), "channel_id",
                   F.col("pos").alias("anchor_pos"), F.col("author_id").alias("a_author")),
        "anchor_id"))
    keep = (lambda: F.col("author_id") != F.col("a_author")) if exclude_author else None
    hits = neighbors(pos, anc, "channel_id", keep=keep, slack=slack, counts={-1: before, 1: after})
    side = F.when(F.col("dir") < 0, F.lit("before")).otherwise(F.lit("after"))
    return hits.select("anchor_id", side.alias("side"), "dist", "id")


def thread_context(messages: DataFrame, anchors: DataFrame, n: int = 25) -> DataFrame:
    """The next ``n`` non-empty messages of the anchor's thread by id.
    Returns (anchor_id, dist, id); anchors without a thread get nothing."""
    elig = non_empty(messages).filter(F.col("thread_id").isNotNull()).select("id", "thread_id")
    pos = _positioned(elig, "thread_id", "id")
    anc = anchors.select(F.col("id").alias("anchor_id")).join(
        pos.select(F.col("id").alias("anchor_id"), "thread_id", F.col("pos").alias("anchor_pos")),
        "anchor_id")
    return neighbors(pos, anc, "thread_id", n, 1).select("anchor_id", "dist", "id")


def next_messages(messages: DataFrame, anchors: DataFrame, n: int = 8,
                  ts_col: str = "ts", slack: int = 5) -> DataFrame:
    """The next ``n`` messages of the same channel with a strictly later
    timestamp, in time order (ties on time broken by id). Returns
    (anchor_id, dist, id)."""
    rows = messages.select("id", "channel_id", ts_col)
    pos = _positioned(rows, "channel_id", ts_col, tiebreak=["id"], runs=ts_col)
    anc = anchors.select(F.col("id").alias("anchor_id")).join(
        pos.select(F.col("id").alias("anchor_id"), "channel_id",
                   F.col("pos").alias("anchor_pos"), F.col(ts_col).alias("a_ts")),
        "anchor_id")
    keep = lambda: F.col(ts_col) > F.col("a_ts")
    hits = neighbors(pos, anc, "channel_id", n, 1, keep=keep, slack=slack)
    w = F.row_number().over(Window.partitionBy("anchor_id").orderBy("dist"))
    return hits.select("anchor_id", w.alias("dist"), "id")
