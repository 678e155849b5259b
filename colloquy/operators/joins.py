"""Joins of the Q&A and graph pipelines.

Dimension tables (channels, guilds, label catalogues) are joined without a
hint: Catalyst broadcasts them when the scan size is under the broadcast
threshold and AQE converts at run time from measured sizes; a dimension that
outgrows the threshold falls back to a sort-merge join instead of failing.
"""

from __future__ import annotations

from collections.abc import Callable  # noqa: F401 - used in annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .product import PIECE, RIGHT, Factorised, lists


def qa_with_content(qa: DataFrame, messages: DataFrame, qa_key: str = "message_id") -> DataFrame:
    """Q&A (or staging) rows with their message content."""
    m = messages.select(F.col("id").alias(qa_key), "content", "channel_id")
    return qa.join(m, qa_key, "inner")


def loggable_messages(messages: DataFrame, channels: DataFrame) -> DataFrame:
    """Messages whose channel has ``log != 0`` and whose parent channel is
    absent or has ``log != 0``. A NULL ``log`` drops the row (SQL semantics)."""
    ch = channels.select("channel_id", "parent_channel_id", F.col("log").alias("_log"))
    par = channels.select(F.col("channel_id").alias("_pid"), F.col("log").alias("_plog"))
    return (messages.join(ch, "channel_id", "inner")
                    .join(par, F.col("parent_channel_id") == F.col("_pid"), "left")
                    .filter((F.col("_log") != 0) & (F.col("_pid").isNull() | (F.col("_plog") != 0)))
                    .drop("parent_channel_id", "_log", "_pid", "_plog"))


def _places(channels: DataFrame, guilds: DataFrame) -> DataFrame:
    """(channel_id, channel_name, guild_id, guild_name) of the channels whose guild is known."""
    return channels.select("channel_id", F.col("name").alias("channel_name"), "guild_id") \
                   .join(guilds.select("guild_id", F.col("name").alias("guild_name")), "guild_id")


def proposal_summaries(links: DataFrame, channels: DataFrame, guilds: DataFrame,
                       summaries: DataFrame) -> Factorised:
    """Links (proposal_id, channel_id?, server_id) to channels where
    ``channel_id = link.channel_id OR (link.channel_id IS NULL AND guild_id =
    link.server_id)``, and the summaries of these channels. The OR would plan
    a cartesian product, so it is two equi-joins whose results are disjoint
    (the second needs a NULL key). The product stays factorised by channel;
    the proposals of a channel, and those of a whole server, are put in lists
    before their lists are joined to the channels."""
    by_server = F.col("channel_id").isNull()
    rest = [c for c in links.columns if c not in ("channel_id", "server_id")]
    held = lists(links.select(by_server.alias("_by_server"), F.coalesce("channel_id", "server_id").alias("_place"), *rest),
                 ["_by_server", "_place"], PIECE)
    ch = _places(channels, guilds).select(F.col("channel_id").alias("dc_channel_id"), F.col("guild_id").alias("dc_guild_id"),
                                          "channel_name", "guild_name")
    by_channel = held.filter(~F.col("_by_server")).join(ch, F.col("_place") == F.col("dc_channel_id"))
    of_server = held.filter(F.col("_by_server")).join(ch, F.col("_place") == F.col("dc_guild_id"))
    both = by_channel.unionByName(of_server).filter(F.col("dc_channel_id").isNotNull()).drop("_by_server", "_place")
    return Factorised(both, lists(summaries.withColumnRenamed("channel_id", "dc_channel_id"), ["dc_channel_id"], RIGHT),
                      ["dc_channel_id"])


def proposal_qa(links: DataFrame, channels: DataFrame, guilds: DataFrame, messages: DataFrame,
                qa: DataFrame, of_text: "Callable[[DataFrame], DataFrame] | None" = None) -> Factorised:
    """Proposal -> channel -> guild -> messages -> Q&A, DISTINCT over
    (proposal_id, channel_id, guild_id, channel_name, guild_name, question,
    answer). A link without a channel matches nothing here (unlike J4).

    Both sides are made distinct for each channel first (the proposals linked
    to it, the Q&A texts posted in it). The channel is part of a row, so their
    product, which stays factorised, holds no row twice. ``of_text`` (e.g. X32)
    is applied to the distinct texts (channel_id, question, answer), each once."""
    ch = _places(channels, guilds).distinct()
    props = links.filter(F.col("channel_id").isNotNull()).select("proposal_id", "channel_id").distinct()
    m = messages.select(F.col("id").alias("message_id"), "channel_id")
    texts = (qa.select("message_id", "question", "answer").join(m, "message_id")
               .select("channel_id", "question", "answer").distinct())
    if of_text is not None:
        texts = of_text(texts)
    return Factorised(lists(props, ["channel_id"], PIECE).join(ch, "channel_id"), lists(texts, ["channel_id"], RIGHT),
                      ["channel_id"])


def unanswered(staging: DataFrame, qa: DataFrame) -> DataFrame:
    """Staging rows with is_relevant=1, answered=0 and no Q&A row
    (NOT EXISTS as an anti join; NOT IN would plan a null-aware broadcast)."""
    s = staging.filter((F.col("is_relevant") == 1) & (F.col("answered") == 0))
    return s.join(qa.select("message_id"), "message_id", "left_anti")


def exclude_existing(candidates: DataFrame, existing: DataFrame, key: str = "id") -> DataFrame:
    """Drop candidates whose key already appears in ``existing``."""
    return candidates.join(existing.select(key), key, "left_anti")


def channel_guild_names(messages: DataFrame, channels: DataFrame, guilds: DataFrame,
                        rejects: bool = False) -> DataFrame:
    """Channel and guild names per message. ``rejects=True`` returns the
    messages whose channel or guild is unknown instead (the original raised)."""
    ch = channels.select("channel_id", F.col("name").alias("channel"), "guild_id")
    g = guilds.select("guild_id", F.col("name").alias("guild"))
    j = messages.join(ch, "channel_id", "left").join(g, "guild_id", "left")
    bad = F.col("channel").isNull() | F.col("guild").isNull()
    return j.filter(bad) if rejects else j.filter(~bad)


def votes_on_qa(votes: DataFrame, qa: DataFrame, threshold: int = 3) -> DataFrame:
    """Votes with ``downvotes >= threshold`` matched to visible Q&A."""
    v = votes.filter(F.col("downvotes") >= threshold)
    q = qa.filter(F.col("hidden") == 0).select("message_id", "hidden")
    return v.join(q, v.similar_question_id == q.message_id, "inner")


def resolve_ids(rows: DataFrame, catalog: DataFrame, name_col: str, scope_col: str | None = None,
                label_col: str = "label", id_col: str = "entity_id", out: str | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """Names -> ids through a label catalogue. Returns (resolved,
    rejects). ``scope_col`` set: one unknown name rejects every row of that
    scope value (the whole subject), otherwise only the row."""
    out = out or f"{name_col}_id"
    cat = catalog.select(F.col(label_col).alias("_lbl"), F.col(id_col).alias(out))
    j = rows.join(cat, F.col(name_col) == F.col("_lbl"), "left").drop("_lbl")
    miss = j.filter(F.col(out).isNull())
    ok = j.filter(F.col(out).isNotNull())
    if scope_col:
        ok = ok.join(miss.select(scope_col).distinct(), scope_col, "left_anti")
        miss = j.join(miss.select(scope_col).distinct(), scope_col, "left_semi")
    return ok, miss


def mention_candidates(messages: DataFrame, profiles: DataFrame,
                       mention: Column) -> DataFrame:
    """Mentioned user ids that have no profile yet, each once."""
    m = (messages.select(mention.alias("user_id")).filter(F.col("user_id").isNotNull())
                 .distinct())
    return m.join(profiles.select("user_id"), "user_id", "left_anti")
