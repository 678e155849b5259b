"""Reference-shaped tables derived from the driver tables.

Each view exists twice: as a Spark DataFrame builder and as DuckDB SQL text
(``*_SQL``) used by the oracle queries. Both spell out the same rules, so a
query and its oracle read identical rows.

messages      conversations turn -> chat message (id = conv_id*1000+turn)
channels      nation -> channel (guild = region, parent = nationkey % 5 for >= 5)
guilds        region
questions     non-empty messages written by a ``user`` role
qa            question + the next assistant turn as answer
staging       question ids with relevance / answered flags
votes         events per user: purchases = upvotes, errors = downvotes
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

ROLE_CODE_SQL = "CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END"

MESSAGES_SQL = f"""
messages AS (
  SELECT conv_id * 1000 + turn AS id,
         CASE WHEN (conv_id + turn) % 13 = 0 THEN NULL
              WHEN (conv_id + turn) % 11 = 0 THEN ''
              ELSE text END AS content,
         conv_id % 25 AS channel_id,
         (conv_id % 17) * 3 + {ROLE_CODE_SQL} AS author_id,
         role || '#' || lpad(CAST(conv_id % 17 AS VARCHAR), 4, '0') AS author_tag,
         CASE WHEN turn % 3 <> 0 THEN conv_id * 1000 + turn - 1 END AS parent_message_id,
         CASE WHEN conv_id % 4 = 0 THEN conv_id END AS thread_id,
         CASE WHEN conv_id % 8 = 0 THEN 'thread-' || CAST(conv_id AS VARCHAR) END AS thread_name,
         CAST(TIMESTAMP '2024-01-01 00:00:00'
              + to_minutes(CAST(conv_id * 60 + turn // 2 AS BIGINT)) AS TIMESTAMP) AS ts
  FROM conversations
)"""

CHANNELS_SQL = """
channels AS (
  SELECT CAST(n_nationkey AS BIGINT) AS channel_id, n_name AS name,
         CAST(n_regionkey AS BIGINT) AS guild_id,
         CASE WHEN n_nationkey >= 5 THEN CAST(n_nationkey % 5 AS BIGINT) END AS parent_channel_id,
         CASE WHEN n_nationkey = 23 THEN NULL ELSE n_nationkey % 4 END AS log
  FROM nation
)"""

GUILDS_SQL = """
guilds AS (
  SELECT CAST(r_regionkey AS BIGINT) AS guild_id, r_name AS name FROM region
)"""

QUESTIONS_SQL = """
questions AS (
  SELECT * FROM messages
  WHERE author_id % 3 = 0 AND content IS NOT NULL AND content <> ''
)"""

QA_SQL = """
qa AS (
  SELECT q.id AS id, q.id AS message_id, q.content AS question,
         CASE WHEN a.author_id % 3 = 1 AND a.content <> '' THEN a.content END AS answer,
         'stub-model' AS model,
         CASE WHEN (q.id // 1000) % 5 = 0 THEN 0 ELSE 1 END AS is_relevant,
         0 AS hidden
  FROM questions q LEFT JOIN messages a ON a.id = q.id + 1
)"""

STAGING_SQL = """
staging AS (
  SELECT id AS message_id,
         CASE (id // 1000) % 3 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 0 END AS is_relevant,
         CASE WHEN (id % 1000) % 4 = 0 THEN 1 ELSE 0 END AS answered
  FROM questions
)"""

VOTES_SQL = """
votes AS (
  SELECT v.user_id AS id, q.id AS similar_question_id, q.id AS original_question_id,
         q.content AS original_question_text,
         v.upvotes, v.downvotes
  FROM (SELECT user_id,
               CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS upvotes,
               CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS downvotes
        FROM events GROUP BY user_id) v
  JOIN (SELECT id, content, row_number() OVER (ORDER BY id) AS rn FROM questions) q
    ON q.rn = v.user_id
)"""

VIEW_SQL = {
    "messages": MESSAGES_SQL, "channels": CHANNELS_SQL, "guilds": GUILDS_SQL,
    "questions": QUESTIONS_SQL, "qa": QA_SQL, "staging": STAGING_SQL,
    "votes": VOTES_SQL,
}
# views that other views read
VIEW_DEPS = {"questions": ["messages"], "qa": ["messages", "questions"],
             "staging": ["messages", "questions"],
             "votes": ["messages", "questions"]}


def with_views(*names: str, recursive: bool = False) -> str:
    """``WITH`` clause defining the named views (and what they read)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in VIEW_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(VIEW_SQL[n].strip() for n in order) + "\n"


def _role_code() -> Column:
    return (F.when(F.col("role") == "user", 0)
             .when(F.col("role") == "assistant", 1).otherwise(2))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    mid = conv * 1000 + turn
    minutes = (conv * 60 + F.floor(turn / 2)).cast("int")
    return c.select(
        mid.alias("id"),
        F.when((conv + turn) % 13 == 0, F.lit(None).cast("string"))
         .when((conv + turn) % 11 == 0, F.lit(""))
         .otherwise(F.col("text")).alias("content"),
        (conv % 25).alias("channel_id"),
        ((conv % 17) * 3 + _role_code()).cast("bigint").alias("author_id"),
        F.concat(F.col("role"), F.lit("#"),
                 F.lpad((conv % 17).cast("string"), 4, "0")).alias("author_tag"),
        F.when(turn % 3 != 0, mid - 1).alias("parent_message_id"),
        F.when(conv % 4 == 0, conv).alias("thread_id"),
        F.when(conv % 8 == 0, F.concat(F.lit("thread-"), conv.cast("string"))).alias("thread_name"),
        (F.expr("timestamp_ntz'2024-01-01 00:00:00'")
         + F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0))).alias("ts"),
    )


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.select(
        k.cast("bigint").alias("channel_id"), F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("bigint").alias("guild_id"),
        F.when(k >= 5, (k % 5).cast("bigint")).alias("parent_channel_id"),
        F.when(k == 23, F.lit(None).cast("int")).otherwise(k % 4).alias("log"),
    )


def guilds(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").cast("bigint").alias("guild_id"),
                    F.col("r_name").alias("name"))


def questions(spark: SparkSession, sf_dir: str, msgs: DataFrame | None = None) -> DataFrame:
    m = msgs if msgs is not None else messages(spark, sf_dir)
    return m.filter((F.col("author_id") % 3 == 0) & F.col("content").isNotNull()
                    & (F.col("content") != ""))


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir)
    q = questions(spark, sf_dir, m).alias("q")
    a = m.alias("a")
    return (q.join(a, F.col("a.id") == F.col("q.id") + 1, "left")
             .select(F.col("q.id").alias("id"), F.col("q.id").alias("message_id"),
                     F.col("q.content").alias("question"),
                     F.when((F.col("a.author_id") % 3 == 1) & (F.col("a.content") != ""),
                            F.col("a.content")).alias("answer"),
                     F.lit("stub-model").alias("model"),
                     F.when(F.floor(F.col("q.id") / 1000) % 5 == 0, 0).otherwise(1).alias("is_relevant"),
                     F.lit(0).alias("hidden")))


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = questions(spark, sf_dir)
    conv = F.floor(F.col("id") / 1000)
    return q.select(F.col("id").alias("message_id"),
                    F.when(conv % 3 == 0, F.lit(None).cast("int"))
                     .when(conv % 3 == 1, 1).otherwise(0).alias("is_relevant"),
                    F.when((F.col("id") % 1000) % 4 == 0, 1).otherwise(0).alias("answered"))


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vote rows. The question index is a global ``row_number`` over question
    ids; it is computed with the skew-safe positional helper, not one task."""
    from ..operators.ordering import with_positions
    ev = table(spark, sf_dir, "events")
    v = ev.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "purchase").alias("upvotes"),
        F.count_if(F.col("event_type") == "error").alias("downvotes"))
    q = with_positions(questions(spark, sf_dir).select("id", "content"),
                       keys=[], order_col="id", out="rn")
    q = q.withColumn("rn", F.col("rn") + 1)
    return (v.join(q, q.rn == v.user_id)
             .select(F.col("user_id").alias("id"), F.col("id").alias("similar_question_id"),
                     F.col("id").alias("original_question_id"),
                     F.col("content").alias("original_question_text"),
                     "upvotes", "downvotes"))


# ---------------------------------------------------------------- proposal links, summaries, entities

LINKS_SQL = """
links AS (
  SELECT o_orderkey AS proposal_id,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey % 25 END AS channel_id,
         o_custkey % 5 AS server_id
  FROM orders
  UNION ALL
  SELECT o_orderkey + 1, o_custkey % 25, o_custkey % 5 FROM orders WHERE o_orderkey % 7 = 0
)"""

SUMMARIES_SQL = """
summaries AS (
  SELECT channel_id, strftime(date_trunc(iv, ts), '%Y-%m-%d') AS timestamp, iv AS interval,
         CAST(count(*) AS VARCHAR) || ' messages by ' || CAST(count(DISTINCT author_id) AS VARCHAR)
           || ' authors' AS summary
  FROM messages, (VALUES ('day'), ('week'), ('month'), ('year')) AS ivs(iv)
  WHERE content IS NOT NULL AND content <> ''
  GROUP BY channel_id, iv, date_trunc(iv, ts)
)"""

ENTITIES_SQL = """
entities AS (
  SELECT 'https://kb.example.org/entity/' || CASE WHEN c_custkey % 17 = 0 THEN 'P' ELSE 'Q' END
           || CAST(c_custkey AS VARCHAR) AS uri,
         c_mktsegment || ' ' || CAST(c_custkey % 40 AS VARCHAR) AS label,
         CASE WHEN c_nationkey % 5 = 0 THEN 'de' ELSE 'en' END AS lang,
         c_custkey % 17 = 0 AS is_property,
         c_custkey AS seq
  FROM customer
)"""

VIEW_SQL.update({"links": LINKS_SQL, "summaries": SUMMARIES_SQL, "entities": ENTITIES_SQL})
VIEW_DEPS.update({"summaries": ["messages"]})


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """proposal_channels: a NULL channel means the whole server."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    a = o.select(k.alias("proposal_id"), F.when(k % 3 == 0, F.lit(None).cast("bigint")).otherwise(c % 25)
                 .alias("channel_id"), (c % 5).alias("server_id"))
    b = o.filter(k % 7 == 0).select((k + 1).alias("proposal_id"), (c % 25).alias("channel_id"),
                                    (c % 5).alias("server_id"))
    return a.unionByName(b)


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """summary table: per channel, period and interval (day/week/month and
    an unsupported 'year'), the message and author counts."""
    from ..streaming.rollup import period_rollup
    m = messages(spark, sf_dir).filter(F.col("content").isNotNull() & (F.col("content") != ""))
    r = period_rollup(m, ["day", "week", "month", "year"])
    return r.select("channel_id", F.date_format("period", "yyyy-MM-dd").alias("timestamp"), "interval",
                    F.concat(F.col("n_messages").cast("string"), F.lit(" messages by "),
                             F.col("n_authors").cast("string"), F.lit(" authors")).alias("summary"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uri, label, lang, is_property, seq) label rows of a knowledge base."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("https://kb.example.org/entity/"), F.when(k % 17 == 0, "P").otherwise("Q"),
                 k.cast("string")).alias("uri"),
        F.concat(F.col("c_mktsegment"), F.lit(" "), (k % 40).cast("string")).alias("label"),
        F.when(F.col("c_nationkey") % 5 == 0, "de").otherwise("en").alias("lang"),
        (k % 17 == 0).alias("is_property"), k.alias("seq"))
