"""Q&A base composition: from messages to one conversation prompt per
question (flagship), and the answer bookkeeping around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.context import conversation_context, thread_context
from ..operators.trees import reply_tree

NL = "\n"


def _line() -> F.Column:
    return F.concat(F.col("author_tag"), F.lit(": "), F.col("content"), F.lit(NL))


def conversation_prompts(messages: DataFrame, channels: DataFrame, guilds: DataFrame,
                         anchors: DataFrame, before: int = 10, after: int = 25,
                         thread_n: int = 25, slack: int = 5) -> DataFrame:
    """F1 + J8 + J11 + J10 + U5 + A14 + A15 + J12 + X46 for all anchors at once.

    Returns one row per anchor: message_id, guild, channel, n_before, n_after,
    n_replies, reply_ids ARRAY<BIGINT>, conversation_ids ARRAY<BIGINT>, prompt.
    Anchors whose channel or guild is unknown are dropped (see
    ``joins.channel_guild_names`` for the reject output)."""
    text = messages.select("id", "author_tag", "content")
    anchors = anchors.select("id").distinct()

    ctx = conversation_context(messages, anchors, before, after, slack=slack)
    ctx_agg = (ctx.join(text, "id")
                  .groupBy("anchor_id")
                  .agg(F.count_if(F.col("side") == "before").alias("n_before"),
                       F.count_if(F.col("side") == "after").alias("n_after"),
                       F.array_sort(F.collect_list(F.struct("id", _line().alias("line"))))
                        .alias("_ctx")))

    tree = reply_tree(messages, anchors).select(
        "anchor_id", "id", F.lit(0).alias("src"), F.col("path").alias("k"))
    thr = thread_context(messages, anchors, thread_n).select(
        "anchor_id", "id", F.lit(1).alias("src"), F.array(F.col("dist").cast("bigint")).alias("k"))
    rep_agg = (tree.unionByName(thr).join(text, "id")
                   .groupBy("anchor_id")
                   .agg(F.array_sort(F.collect_list(F.struct("src", "k", "id", _line().alias("line"))))
                        .alias("_rep")))

    q = (messages.join(anchors, "id", "left_semi")
                 .join(channels.select("channel_id", F.col("name").alias("channel"), "guild_id"),
                       "channel_id")
                 .join(guilds.select("guild_id", F.col("name").alias("guild")), "guild_id"))
    j = (q.join(ctx_agg, q.id == ctx_agg.anchor_id, "left").drop("anchor_id")
          .join(rep_agg, q.id == rep_agg.anchor_id, "left").drop("anchor_id"))
    rep = F.coalesce(F.col("_rep"), F.array())
    ctxl = F.coalesce(F.col("_ctx"), F.array())
    prompt = F.concat(
        F.lit("Guild: "), F.col("guild"), F.lit(NL),
        F.lit("Channel: "), F.col("channel"), F.lit(NL),
        F.when(F.col("thread_id").isNotNull(),
               F.concat(F.lit("Thread: "), F.coalesce("thread_name", F.lit("")), F.lit(NL)))
         .otherwise(F.lit("")),
        F.lit(NL + "QUESTION:" + NL), F.col("author_tag"), F.lit(": "), F.col("content"), F.lit(NL),
        F.when(F.size(rep) > 0, F.lit(NL + "Direct replies:" + NL)).otherwise(F.lit("")),
        F.array_join(F.transform(rep, lambda x: x["line"]), ""),
        F.lit(NL + "Other messages in conversation:" + NL),
        F.array_join(F.transform(ctxl, lambda x: x["line"]), ""),
        F.lit('"ANSWER:' + NL))
    return j.select(
        F.col("id").alias("message_id"), "guild", "channel",
        F.coalesce("n_before", F.lit(0)).alias("n_before"),
        F.coalesce("n_after", F.lit(0)).alias("n_after"),
        F.size(rep).alias("n_replies"),
        F.transform(rep, lambda x: x["id"]).alias("reply_ids"),
        F.transform(ctxl, lambda x: x["id"]).alias("conversation_ids"),
        prompt.alias("prompt"))
