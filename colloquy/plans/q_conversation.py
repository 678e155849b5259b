"""Conversation queries: prompts, context windows, reply trees, threads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import views as V
from . import qa as QA
from .registry import register


def ids_text(col) -> F.Column:
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ",")


CONTEXT_PROMPT_SQL = V.with_views("messages", "channels", "guilds", "questions", recursive=True) + """,
elig AS (SELECT * FROM messages WHERE content IS NOT NULL AND content <> ''),
ctx AS (
  SELECT * FROM (
    SELECT q.id AS qid, m.id, 'before' AS side,
           row_number() OVER (PARTITION BY q.id ORDER BY m.id DESC) AS rk
    FROM questions q JOIN elig m
      ON m.channel_id = q.channel_id AND m.id < q.id AND m.author_id <> q.author_id) b
  WHERE rk <= 10
  UNION ALL
  SELECT * FROM (
    SELECT q.id AS qid, m.id, 'after' AS side,
           row_number() OVER (PARTITION BY q.id ORDER BY m.id) AS rk
    FROM questions q JOIN elig m
      ON m.channel_id = q.channel_id AND m.id > q.id AND m.author_id <> q.author_id) a
  WHERE rk <= 25
),
tree(qid, id, path) AS (
  SELECT q.id, m.id, [m.id] FROM questions q JOIN elig m ON m.parent_message_id = q.id
  UNION ALL
  SELECT t.qid, m.id, list_append(t.path, m.id)
  FROM tree t JOIN elig m ON m.parent_message_id = t.id
  WHERE NOT list_contains(t.path, m.id) AND m.id <> t.qid
),
thr AS (
  SELECT * FROM (
    SELECT q.id AS qid, m.id, row_number() OVER (PARTITION BY q.id ORDER BY m.id) AS rk
    FROM questions q JOIN elig m ON m.thread_id = q.thread_id AND m.id > q.id) t
  WHERE rk <= 25
),
reps AS (
  SELECT qid, id, 0 AS src, path AS k FROM tree
  UNION ALL
  SELECT qid, id, 1 AS src, [rk] AS k FROM thr
),
rep_agg AS (
  SELECT r.qid, count(*) AS n_replies,
         string_agg(m.author_tag || ': ' || m.content || chr(10), '' ORDER BY r.src, r.k) AS rep_text,
         string_agg(CAST(r.id AS VARCHAR), ',' ORDER BY r.src, r.k) AS reply_ids
  FROM reps r JOIN messages m ON m.id = r.id GROUP BY r.qid
),
ctx_agg AS (
  SELECT c.qid,
         count(*) FILTER (WHERE side = 'before') AS n_before,
         count(*) FILTER (WHERE side = 'after') AS n_after,
         string_agg(m.author_tag || ': ' || m.content || chr(10), '' ORDER BY c.id) AS ctx_text,
         string_agg(CAST(c.id AS VARCHAR), ',' ORDER BY c.id) AS conversation_ids
  FROM ctx c JOIN messages m ON m.id = c.id GROUP BY c.qid
)
SELECT q.id AS message_id, g.name AS guild, ch.name AS channel,
       coalesce(x.n_before, 0) AS n_before, coalesce(x.n_after, 0) AS n_after,
       coalesce(r.n_replies, 0) AS n_replies,
       coalesce(r.reply_ids, '') AS reply_ids,
       coalesce(x.conversation_ids, '') AS conversation_ids,
       'Guild: ' || g.name || chr(10) || 'Channel: ' || ch.name || chr(10)
       || CASE WHEN q.thread_id IS NOT NULL THEN 'Thread: ' || coalesce(q.thread_name, '') || chr(10) ELSE '' END
       || chr(10) || 'QUESTION:' || chr(10) || q.author_tag || ': ' || q.content || chr(10)
       || CASE WHEN coalesce(r.n_replies, 0) > 0 THEN chr(10) || 'Direct replies:' || chr(10) ELSE '' END
       || coalesce(r.rep_text, '')
       || chr(10) || 'Other messages in conversation:' || chr(10)
       || coalesce(x.ctx_text, '') || '"ANSWER:' || chr(10) AS prompt
FROM questions q
JOIN channels ch ON ch.channel_id = q.channel_id
JOIN guilds g ON g.guild_id = ch.guild_id
LEFT JOIN ctx_agg x ON x.qid = q.id
LEFT JOIN rep_agg r ON r.qid = q.id
"""


@register("context_prompt", CONTEXT_PROMPT_SQL)
def context_prompt(spark, sf_dir):
    """Flagship: for every question, the conversation prompt (J8 + J11 + J10
    + A14/A15 + X46)."""
    m = V.messages(spark, sf_dir)
    q = V.questions(spark, sf_dir, m).select("id")
    out = QA.conversation_prompts(m, V.channels(spark, sf_dir), V.guilds(spark, sf_dir), q)
    return out.select("message_id", "guild", "channel", "n_before", "n_after", "n_replies",
                      ids_text(F.col("reply_ids")).alias("reply_ids"),
                      ids_text(F.col("conversation_ids")).alias("conversation_ids"),
                      "prompt")


# ---------------------------------------------------------------- J2 / J9 / J10 / W4

def _ranked_sql(select_cols: str, join_on: str, order: str, limit: int, src: str = "questions q",
                rows: str = "messages m") -> str:
    return f"""SELECT * FROM (
    SELECT {select_cols}, row_number() OVER (PARTITION BY q.id ORDER BY {order}) AS rk
    FROM {src} JOIN {rows} ON {join_on}) z WHERE rk <= {limit}"""


NEXT_MESSAGES_SQL = V.with_views("messages", "questions") + f""",
hits AS ({_ranked_sql("q.id AS message_id, m.id, m.ts", "m.channel_id = q.channel_id AND m.ts > q.ts", "m.ts, m.id", 8)})
SELECT message_id, count(*) AS n_next,
       string_agg(CAST(id AS VARCHAR), ',' ORDER BY rk) AS next_ids
FROM hits GROUP BY message_id
"""


def _agg_ids(df, n_name: str, ids_name: str, order_col: str = "dist"):
    return (df.groupBy(F.col("anchor_id").alias("message_id"))
              .agg(F.count(F.lit(1)).alias(n_name),
                   F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("_o"), "id"))).alias("_l"))
              .select("message_id", n_name,
                      ids_text(F.transform("_l", lambda x: x["id"])).alias(ids_name)))


@register("next_messages", NEXT_MESSAGES_SQL)
def next_messages_q(spark, sf_dir):
    """Next 8 messages of the channel with a strictly later timestamp."""
    from ..operators.context import next_messages
    m = V.messages(spark, sf_dir)
    q = V.questions(spark, sf_dir, m).select("id")
    return _agg_ids(next_messages(m, q, 8), "n_next", "next_ids")


FOLLOWING_CONTEXT_SQL = V.with_views("messages", "questions") + f""",
elig AS (SELECT * FROM messages WHERE content IS NOT NULL AND content <> ''),
hits AS ({_ranked_sql("q.id AS message_id, m.id", "m.channel_id = q.channel_id AND m.id > q.id AND m.author_id <> q.author_id", "m.id", 25, rows="elig m")})
SELECT message_id, count(*) AS n_after, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS after_ids
FROM hits GROUP BY message_id
"""


@register("following_context", FOLLOWING_CONTEXT_SQL)
def following_context_q(spark, sf_dir):
    """The 25 following non-empty messages of the channel, asker excluded."""
    from ..operators.context import conversation_context
    m = V.messages(spark, sf_dir)
    q = V.questions(spark, sf_dir, m).select("id")
    ctx = conversation_context(m, q, before=0, after=25)
    return _agg_ids(ctx, "n_after", "after_ids", order_col="id")


THREAD_CONTEXT_SQL = V.with_views("messages", "questions") + f""",
elig AS (SELECT * FROM messages WHERE content IS NOT NULL AND content <> ''),
hits AS ({_ranked_sql("q.id AS message_id, m.id", "m.thread_id = q.thread_id AND m.id > q.id", "m.id", 25, rows="elig m")})
SELECT message_id, count(*) AS n_thread, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS thread_ids
FROM hits GROUP BY message_id
"""


@register("thread_context", THREAD_CONTEXT_SQL)
def thread_context_q(spark, sf_dir):
    """Next 25 non-empty messages of the question's thread."""
    from ..operators.context import thread_context
    m = V.messages(spark, sf_dir)
    q = V.questions(spark, sf_dir, m).select("id")
    return _agg_ids(thread_context(m, q, 25), "n_thread", "thread_ids")


CONTEXT_FRAMES_SQL = V.with_views("messages") + f""",
elig AS (SELECT * FROM messages WHERE content IS NOT NULL AND content <> ''),
hits AS ({_ranked_sql("q.id AS message_id, m.id", "m.channel_id = q.channel_id AND m.id > q.id", "m.id", 5, src="elig q", rows="elig m")})
SELECT message_id, count(*) AS n_frame, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS frame_ids
FROM hits GROUP BY message_id
"""


@register("context_frames", CONTEXT_FRAMES_SQL)
def context_frames_q(spark, sf_dir):
    """``ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING`` frame of every
    non-empty message in its channel, computed with the positional probes."""
    from ..operators.context import conversation_context
    m = V.messages(spark, sf_dir)
    anchors = m.filter(F.col("content").isNotNull() & (F.col("content") != "")).select("id")
    ctx = conversation_context(m, anchors, before=0, after=5, exclude_author=False)
    return _agg_ids(ctx, "n_frame", "frame_ids", order_col="id")


# ---------------------------------------------------------------- J11 / U1 / U5

REPLY_TREE_SQL = V.with_views("messages", "questions", recursive=True) + """,
elig AS (SELECT * FROM messages WHERE content IS NOT NULL AND content <> ''),
tree(qid, id, depth, path) AS (
  SELECT q.id, m.id, 1, [m.id] FROM questions q JOIN elig m ON m.parent_message_id = q.id
  UNION ALL
  SELECT t.qid, m.id, t.depth + 1, list_append(t.path, m.id)
  FROM tree t JOIN elig m ON m.parent_message_id = t.id
  WHERE NOT list_contains(t.path, m.id) AND m.id <> t.qid
)
SELECT qid AS anchor_id, id, depth, array_to_string(path, '/') AS path,
       row_number() OVER (PARTITION BY qid ORDER BY path) AS preorder
FROM tree
"""


@register("reply_tree", REPLY_TREE_SQL)
def reply_tree_q(spark, sf_dir):
    """All transitive non-empty replies of every question, pre-order."""
    from pyspark.sql import Window
    from ..operators.trees import reply_tree
    m = V.messages(spark, sf_dir)
    q = V.questions(spark, sf_dir, m).select("id")
    t = reply_tree(m, q)
    return t.select("anchor_id", "id", "depth",
                    F.array_join(F.transform("path", lambda x: x.cast("string")), "/").alias("path"),
                    F.row_number().over(Window.partitionBy("anchor_id").orderBy("path")).alias("preorder"))


UNION_LIMITS_SQL = V.with_views("messages", "questions") + f""",
elig AS (SELECT * FROM messages WHERE content IS NOT NULL AND content <> ''),
b AS ({_ranked_sql("q.id AS anchor_id, m.id, 'before' AS side", "m.channel_id = q.channel_id AND m.id < q.id AND m.author_id <> q.author_id", "m.id DESC", 10, rows="elig m")}),
a AS ({_ranked_sql("q.id AS anchor_id, m.id, 'after' AS side", "m.channel_id = q.channel_id AND m.id > q.id AND m.author_id <> q.author_id", "m.id", 25, rows="elig m")}),
u AS (SELECT anchor_id, id, side FROM b UNION ALL SELECT anchor_id, id, side FROM a)
SELECT anchor_id, id, side, row_number() OVER (PARTITION BY anchor_id ORDER BY id) AS ord FROM u
"""


@register("union_limits", UNION_LIMITS_SQL)
def union_limits_q(spark, sf_dir):
    """UNION ALL of the 10-before and 25-after limits, re-sorted by id."""
    from pyspark.sql import Window
    from ..operators.context import conversation_context
    m = V.messages(spark, sf_dir)
    q = V.questions(spark, sf_dir, m).select("id")
    ctx = conversation_context(m, q, 10, 25)
    return ctx.select("anchor_id", "id", "side",
                      F.row_number().over(Window.partitionBy("anchor_id").orderBy("id")).alias("ord"))


EXTEND_REPLIES_SQL = V.with_views("messages", "questions", recursive=True) + """,
elig AS (SELECT * FROM messages WHERE content IS NOT NULL AND content <> ''),
tree(qid, id, path) AS (
  SELECT q.id, m.id, [m.id] FROM questions q JOIN elig m ON m.parent_message_id = q.id
  UNION ALL
  SELECT t.qid, m.id, list_append(t.path, m.id)
  FROM tree t JOIN elig m ON m.parent_message_id = t.id
  WHERE NOT list_contains(t.path, m.id) AND m.id <> t.qid
),
thr AS (
  SELECT * FROM (
    SELECT q.id AS qid, m.id, row_number() OVER (PARTITION BY q.id ORDER BY m.id) AS rk
    FROM questions q JOIN elig m ON m.thread_id = q.thread_id AND m.id > q.id) t
  WHERE rk <= 25
),
reps AS (
  SELECT qid, id, 0 AS src, path AS k FROM tree
  UNION ALL SELECT qid, id, 1 AS src, [rk] AS k FROM thr
)
SELECT qid AS anchor_id, id, CASE src WHEN 0 THEN 'reply' ELSE 'thread' END AS source,
       row_number() OVER (PARTITION BY qid ORDER BY src, k) AS ord
FROM reps
"""


@register("extend_replies", EXTEND_REPLIES_SQL)
def extend_replies_q(spark, sf_dir):
    """Reply-tree messages followed by the thread messages; a reply that
    is also in the thread appears twice, as in the original."""
    from pyspark.sql import Window
    from ..operators.context import thread_context
    from ..operators.trees import reply_tree
    m = V.messages(spark, sf_dir)
    q = V.questions(spark, sf_dir, m).select("id")
    t = reply_tree(m, q).select("anchor_id", "id", F.lit(0).alias("src"), F.col("path").alias("k"))
    th = thread_context(m, q, 25).select("anchor_id", "id", F.lit(1).alias("src"),
                                         F.array(F.col("dist").cast("bigint")).alias("k"))
    u = t.unionByName(th)
    return u.select("anchor_id", "id",
                    F.when(F.col("src") == 0, "reply").otherwise("thread").alias("source"),
                    F.row_number().over(Window.partitionBy("anchor_id").orderBy("src", "k")).alias("ord"))


# ---------------------------------------------------------------- J3 / J12

LOGGABLE_SQL = V.with_views("messages", "channels") + """
SELECT dm.id, dm.channel_id
FROM messages dm
JOIN channels dc ON dm.channel_id = dc.channel_id
LEFT JOIN channels dp ON dc.parent_channel_id = dp.channel_id
WHERE dm.content IS NOT NULL AND dm.content <> ''
  AND dc.log <> 0 AND (dp.channel_id IS NULL OR dp.log <> 0)
"""


@register("loggable_messages", LOGGABLE_SQL)
def loggable_messages_q(spark, sf_dir):
    """J3 + F1: non-empty messages of logged channels under logged parents."""
    from ..operators.filters import non_empty
    from ..operators.joins import loggable_messages
    m = non_empty(V.messages(spark, sf_dir)).select("id", "channel_id", "content")
    return loggable_messages(m, V.channels(spark, sf_dir)).select("id", "channel_id")


CHANNEL_GUILD_SQL = V.with_views("messages", "channels", "guilds") + """
SELECT m.id, c.name AS channel, g.name AS guild
FROM messages m JOIN channels c ON c.channel_id = m.channel_id
JOIN guilds g ON g.guild_id = c.guild_id
"""


@register("channel_guild_names", CHANNEL_GUILD_SQL)
def channel_guild_names_q(spark, sf_dir):
    """Channel and guild name of every message."""
    from ..operators.joins import channel_guild_names
    m = V.messages(spark, sf_dir).select("id", "channel_id")
    return channel_guild_names(m, V.channels(spark, sf_dir), V.guilds(spark, sf_dir)).select(
        "id", "channel", "guild")
