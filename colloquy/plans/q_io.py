"""Connector and streaming queries: each writes to a fresh scratch folder in
the shared checkpoint location and reads the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sql_text as S
from ..operators.filters import is_question
from ..sources import io as IO
from ..sources import views as V
from ..sources.tables import table
from ..streaming import stream as ST
from .registry import register


@register("stream_questions", V.with_views("messages", "channels") + """
SELECT dm.id AS message_id, CAST(NULL AS INTEGER) AS is_relevant, 0 AS answered
FROM messages dm
JOIN channels dc ON dm.channel_id = dc.channel_id
LEFT JOIN channels dp ON dc.parent_channel_id = dp.channel_id
WHERE dm.content IS NOT NULL AND dm.content <> '' AND dm.author_id % 3 = 0
  AND dc.log <> 0 AND (dp.channel_id IS NULL OR dp.log <> 0)
""")
def stream_questions(spark, sf_dir):
    """ST1: turns as eight files, newest conversations first -> loggable
    non-empty questions -> staging (D1)."""
    files = ST.split_into_files(spark, sf_dir, "conversations", "conv_id")
    return ST.stream_questions(spark, sf_dir, turns_dir=files).select("message_id", "is_relevant", "answered")


@register("stream_detected_questions", V.with_views("messages", "channels") + f"""
SELECT dm.id AS message_id, CAST(NULL AS INTEGER) AS is_relevant, 0 AS answered
FROM messages dm
JOIN channels dc ON dm.channel_id = dc.channel_id
LEFT JOIN channels dp ON dc.parent_channel_id = dp.channel_id
WHERE dm.content IS NOT NULL AND dm.content <> '' AND {S.is_question('dm.content')}
  AND dc.log <> 0 AND (dp.channel_id IS NULL OR dp.log <> 0)
""")
def stream_detected_questions(spark, sf_dir):
    """ST1 with F4: the loggable messages that ask something, as they arrive."""
    files = ST.split_into_files(spark, sf_dir, "conversations", "conv_id")
    found = ST.stream_questions(spark, sf_dir, turns_dir=files, asked=is_question("content"))
    return found.select("message_id", "is_relevant", "answered")


@register("stream_import", """
SELECT event_id AS message_id, user_id AS author, event_type AS content,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_timestamp
FROM events
""")
def stream_import(spark, sf_dir):
    """ST2: events as eight files, newest first, merged by key."""
    return ST.stream_import(spark, ST.split_into_files(spark, sf_dir, "events", "ts")).select("message_id", "author", "content", "created_timestamp")


@register("period_rollup", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS period, event_type,
       count(*) AS n_events, round(sum(value), 6) AS total_value
FROM events GROUP BY 1, 2
""")
def period_rollup(spark, sf_dir):
    """ST3: daily counts and sums per event type, computed on a stream."""
    r = ST.period_rollup_stream(spark, ST.split_into_files(spark, sf_dir, "events", "ts"))
    return r.select(F.date_format("period", "yyyy-MM-dd HH:mm:ss").alias("period"), "event_type",
                    "n_events", F.round("total_value", 6).alias("total_value"))


@register("io_roundtrip", """
SELECT doc_id, md5(text) AS text_md5, lang FROM documents
""")
def io_roundtrip(spark, sf_dir):
    """S3 + S2: whole documents (newlines, quotes, commas) through CSV and back."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = IO.scratch_path(spark, "csv")
    IO.write_csv(d, path)
    back = IO.read_csv(spark, path, "doc_id long, text string, lang string", multiline=True)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@register("proposals_json", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status,
       count(l_orderkey) AS n_votes, count(l_orderkey) AS n_targets
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_orderkey, o_orderstatus
""")
def proposals_json(spark, sf_dir):
    """Proposal documents written as JSON pages and read back, one row per
    proposal (last duplicate wins)."""
    from ..sources.proposals import proposals
    path = IO.scratch_path(spark, "proposals")
    IO.write_proposals_json(proposals(spark, sf_dir), path)
    p = IO.read_proposals_json(spark, path, multiline=False)
    return p.select("id", "status", F.size("votes").alias("n_votes"), F.size("targets").alias("n_targets"))


@register("import_messages", """
SELECT event_id AS message_id, user_id AS author, event_type AS content,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_timestamp
FROM events
""")
def import_messages(spark, sf_dir):
    """S10 + X37 + D1: records landed as JSON with epoch seconds, renamed,
    times rendered, inserted when their id is new."""
    from ..operators.state import insert_if_absent
    ev = table(spark, sf_dir, "events")
    land = IO.scratch_path(spark, "landing")
    secs = (F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
            + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts")))
    ev.select("event_id", "user_id", "event_type", secs.alias("created")).write.json(land)
    rec = spark.read.schema("event_id long, user_id long, event_type string, created long").json(land)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("created") / 86400).cast("int"))
    rest = F.col("created") % 86400
    stamp = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "),
                     F.lpad(F.floor(rest / 3600).cast("string"), 2, "0"), F.lit(":"),
                     F.lpad(F.floor(rest % 3600 / 60).cast("string"), 2, "0"), F.lit(":"),
                     F.lpad((rest % 60).cast("string"), 2, "0"))
    rows = rec.select(F.col("event_id").alias("message_id"), F.col("user_id").alias("author"),
                      F.col("event_type").alias("content"), stamp.alias("created_timestamp"))
    base = spark.createDataFrame([], "message_id long, author long, content string, created_timestamp string")
    return insert_if_absent(base, rows, "message_id")


@register("table_versions", """
WITH v AS (SELECT o_custkey AS customer, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1),
late AS (SELECT c_custkey AS customer, CAST(0 AS BIGINT) AS n, CAST(0 AS DOUBLE) AS total
         FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)),
copied AS (SELECT * FROM v UNION ALL SELECT * FROM late)
SELECT 'version' AS source, customer, n, total FROM v
UNION ALL SELECT 'copy', customer, n, total FROM copied
UNION ALL SELECT 'lines', customer, n, NULL FROM copied
""")
def table_versions(spark, sf_dir):
    """S14 + S8 + S9 + S7: two versions written side by side, the second
    published and read back; the version copied to another folder, the
    customers without orders appended there and the copy read back; the copy
    written as text lines, which are read and split again."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("customer"))
    base = IO.scratch_path(spark, "versions")
    IO.write_version(o.agg(F.count(F.lit(1)).alias("n")), base)
    path = IO.write_version(o.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")), base)
    version = IO.read_current(spark, base).select("customer", "n", "total")
    target = base + "-copy"
    IO.copy_table(spark, path, target)
    late = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer")).join(
        version.select("customer"), "customer", "left_anti")
    IO.append_rows(late.select("customer", F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("total")), target)
    copied = IO.read_table(spark, target).select("customer", "n", "total")
    IO.write_lines(copied.select(F.format_string("customer %d: %d orders", "customer", "n").alias("line")),
                   "line", base + "-lines")
    part = lambda k: F.regexp_extract("value", r"^customer (\d+): (\d+) orders$", k).cast("bigint")
    lines = spark.read.text(base + "-lines").select(part(1).alias("customer"), part(2).alias("n"),
                                                    F.lit(None).cast("double").alias("total"))
    return (version.withColumn("source", F.lit("version"))
            .unionByName(copied.withColumn("source", F.lit("copy")))
            .unionByName(lines.withColumn("source", F.lit("lines"))).select("source", "customer", "n", "total"))


@register("export_qa_json")
def export_qa_json(spark, sf_dir):
    """S5 + X43: relevant answered Q&A with reply and conversation messages
    expanded in order (logs struct from the conversation-prompt plan)."""
    from ..plans.qa import conversation_prompts
    m = V.messages(spark, sf_dir)
    q = V.qa(spark, sf_dir)
    prom = conversation_prompts(m, V.channels(spark, sf_dir), V.guilds(spark, sf_dir), q.select(F.col("message_id").alias("id")))
    qa = q.join(prom.select("message_id", "reply_ids", "conversation_ids", "prompt"), "message_id").join(
        m.select(F.col("id").alias("message_id"), "thread_id"), "message_id")
    qa = qa.withColumn("logs", F.struct("thread_id", "reply_ids", "conversation_ids",
                                        F.col("prompt").alias("conversation_prompt")))
    out = IO.export_qa_json(qa, m, IO.scratch_path(spark, "qa-json"))
    return out.select("id", "message_id", F.coalesce(F.size("replies"), F.lit(0)).alias("n_replies"),
                      F.coalesce(F.size("conversation"), F.lit(0)).alias("n_conversation"))
