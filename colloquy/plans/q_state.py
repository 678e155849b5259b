"""Q&A bookkeeping queries: watermark, staging, votes, answers, labels, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as FL
from ..operators import joins as J
from ..operators import state as D
from ..sources import views as V
from ..sources.tables import table
from .registry import register

VOTE_THRESHOLD = 12  # the sf0.01 users have 4-23 error events; 3 would hide all


@register("after_watermark", V.with_views("messages", "channels", "questions", "qa") + """
SELECT dm.id, dm.channel_id
FROM messages dm
JOIN channels dc ON dm.channel_id = dc.channel_id
LEFT JOIN channels dp ON dc.parent_channel_id = dp.channel_id
WHERE dm.content IS NOT NULL AND dm.content <> ''
  AND dc.log <> 0 AND (dp.channel_id IS NULL OR dp.log <> 0)
  AND dm.id > (SELECT coalesce(max(CAST(message_id AS BIGINT)), 0) FROM qa WHERE is_relevant = 0)
""")
def after_watermark(spark, sf_dir):
    """A1 + F5 + J3 + F1: loggable non-empty messages above the high-water
    mark of the processed Q&A rows."""
    done = V.qa(spark, sf_dir).filter(F.col("is_relevant") == 0)
    m = FL.non_empty(V.messages(spark, sf_dir)).select("id", "channel_id", "content")
    m = FL.after_watermark(m, done)
    return J.loggable_messages(m, V.channels(spark, sf_dir)).select("id", "channel_id")


@register("unanswered", V.with_views("staging", "qa") + """
SELECT s.message_id FROM staging s
WHERE s.is_relevant = 1 AND s.answered = 0
  AND NOT EXISTS (SELECT 1 FROM qa q WHERE q.message_id = s.message_id AND q.answer IS NOT NULL)
""")
def unanswered(spark, sf_dir):
    """Relevant, unanswered staging rows without a Q&A row (anti join)."""
    qa = V.qa(spark, sf_dir).filter(F.col("answer").isNotNull())
    return J.unanswered(V.staging(spark, sf_dir), qa).select("message_id")


@register("insert_if_absent", V.with_views("staging") + """
SELECT message_id, is_relevant, answered FROM staging WHERE answered = 1
UNION ALL
SELECT message_id, CAST(NULL AS INTEGER), 0 FROM staging
WHERE message_id NOT IN (SELECT message_id FROM staging WHERE answered = 1)
""")
def insert_if_absent(spark, sf_dir):
    """A batch holding every question twice (seq 0 and 1) inserted into
    the answered staging rows; the first row of a repeated key wins."""
    st = V.staging(spark, sf_dir)
    base = st.filter(F.col("answered") == 1)
    ids = st.select("message_id")
    batch = (ids.select("message_id", F.lit(None).cast("int").alias("is_relevant"),
                        F.lit(0).alias("answered"), F.lit(0).alias("seq"))
             .unionByName(ids.select("message_id", F.lit(1).alias("is_relevant"),
                                     F.lit(0).alias("answered"), F.lit(1).alias("seq"))))
    return D.insert_if_absent(base, batch, "message_id", order="seq")


@register("update_by_key", V.with_views("messages", "staging") + """
SELECT s.message_id,
       CASE WHEN s.is_relevant IS NULL THEN (CASE WHEN length(m.content) > 300 THEN 1 ELSE 0 END)
            ELSE s.is_relevant END AS is_relevant,
       s.answered
FROM staging s JOIN messages m ON m.id = s.message_id
""")
def update_by_key(spark, sf_dir):
    """F8 + J1 + D2: classify the staging rows that need it (stand-in rule:
    longer than 300 characters) and write the result back by key."""
    st = V.staging(spark, sf_dir)
    todo = J.qa_with_content(FL.needs_classification(st), V.messages(spark, sf_dir))
    upd = todo.select("message_id", F.when(F.length("content") > 300, 1).otherwise(0).alias("is_relevant"))
    return D.update_by_key(st, upd, "message_id", ["is_relevant"])


@register("delete_where", V.with_views("staging") + """
SELECT message_id, is_relevant, answered FROM staging
WHERE NOT coalesce(is_relevant = 0 OR answered = 1, false)
""")
def delete_where(spark, sf_dir):
    """D3: delete irrelevant or answered staging rows; NULL keeps the row."""
    st = V.staging(spark, sf_dir)
    return D.delete_where(st, (F.col("is_relevant") == 0) | (F.col("answered") == 1))


@register("hide_downvoted", V.with_views("qa", "votes") + f"""
SELECT q.message_id,
       CASE WHEN q.hidden = 0 AND q.message_id IN
                 (SELECT similar_question_id FROM votes WHERE downvotes >= {VOTE_THRESHOLD})
            THEN 1 ELSE q.hidden END AS hidden
FROM qa q
""")
def hide_downvoted(spark, sf_dir):
    """D4 (J13 + A3 + D2): hide Q&A rows with enough downvotes."""
    qa = V.qa(spark, sf_dir)
    return D.hide_downvoted(qa, V.votes(spark, sf_dir), VOTE_THRESHOLD).select("message_id", "hidden")


@register("apply_votes", V.with_views("votes") + f"""
SELECT similar_question_id AS question_id, sum(upvotes) AS upvotes, sum(downvotes) AS downvotes,
       CASE WHEN sum(downvotes) >= {VOTE_THRESHOLD} THEN 1 ELSE 0 END AS hidden
FROM votes GROUP BY similar_question_id
""")
def apply_votes(spark, sf_dir):
    """Vote totals per question and the resulting hidden flag."""
    v = V.votes(spark, sf_dir)
    return (v.groupBy(F.col("similar_question_id").alias("question_id"))
             .agg(F.sum("upvotes").alias("upvotes"), F.sum("downvotes").alias("downvotes"))
             .withColumn("hidden", F.when(F.col("downvotes") >= VOTE_THRESHOLD, 1).otherwise(0)))


@register("visible_qa", V.with_views("messages", "channels", "qa") + """
SELECT q.id FROM qa q
JOIN messages m ON m.id = q.message_id
JOIN channels c ON c.channel_id = m.channel_id
WHERE coalesce(c.log, 1) <> 0 AND c.guild_id <> 4 AND q.hidden = 0
""")
def visible_qa(spark, sf_dir):
    """Q&A rows outside disabled channels (log = 0) and guilds (id 4)."""
    qa = V.qa(spark, sf_dir)
    m = V.messages(spark, sf_dir).select(F.col("id").alias("message_id"), "channel_id")
    ch = V.channels(spark, sf_dir).select("channel_id", "guild_id", "log")
    j = qa.join(m, "message_id").join(ch, "channel_id")
    return j.filter((F.coalesce("log", F.lit(1)) != 0) & (F.col("guild_id") != 4)
                    & (F.col("hidden") == 0)).select("id")


RECORD_SQL = V.with_views("staging", "qa") + """
SELECT s.message_id, s.is_relevant,
       CASE WHEN q.message_id IS NULL THEN s.answered
            WHEN q.answer IS NULL THEN 0 ELSE 1 END AS answered
FROM staging s LEFT JOIN qa q ON q.message_id = s.message_id
"""


def _answers(spark, sf_dir):
    qa = V.qa(spark, sf_dir)
    ans = qa.select("message_id", "question",
                    F.coalesce("answer", F.lit("No answer located.")).alias("answer"), "model")
    return qa, ans


@register("record_answers", RECORD_SQL)
def record_answers(spark, sf_dir):
    """D9 + F19: staging ``answered`` set from the model replies."""
    qa, ans = _answers(spark, sf_dir)
    new_staging, _ = D.record_answers(V.staging(spark, sf_dir), qa.filter(F.lit(False)), ans)
    return new_staging.select("message_id", "is_relevant", "answered")


@register("recorded_qa", V.with_views("qa") + """
SELECT message_id, question, answer, model, 1 AS is_relevant, 0 AS hidden
FROM qa WHERE answer IS NOT NULL
""")
def recorded_qa(spark, sf_dir):
    """D9 + P4: answered replies inserted into an empty Q&A table."""
    qa, ans = _answers(spark, sf_dir)
    _, new_qa = D.record_answers(V.staging(spark, sf_dir), qa.filter(F.lit(False)), ans)
    return new_qa.select("message_id", "question", "answer", "model", "is_relevant", "hidden")


# ---------------------------------------------------------------- labels and samples

@register("label_counts", """
SELECT count(*) FILTER (WHERE l.quality = 1) AS n_pos,
       count(*) FILTER (WHERE l.quality = 0) AS n_neg,
       count(*) AS total,
       count(*) FILTER (WHERE l.quality IS NULL OR l.quality NOT IN (0, 1)) AS n_other
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def label_counts(spark, sf_dir):
    """A10 + F12: counts of '1', '0', total and other/blank labels in one pass."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    l_ = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(l_, "doc_id", "left")
    q = F.col("quality")
    return j.agg(F.count_if(q == 1).alias("n_pos"), F.count_if(q == 0).alias("n_neg"),
                 F.count(F.lit(1)).alias("total"),
                 F.count_if(q.isNull() | ~q.isin(0, 1)).alias("n_other"))


@register("labelled_rows", """
SELECT d.doc_id, l.quality AS label, length(d.text) AS n_chars
FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality IN (0, 1)
""")
def labelled_rows(spark, sf_dir):
    """rows with a 0/1 label, trailing column dropped."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    l_ = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"), "toxic")
    r = FL.labelled_rows(d.join(l_, "doc_id"), "label", drop=["toxic"])
    return r.select("doc_id", "label", F.length("text").alias("n_chars"))


@register("relevance_counts", V.with_views("staging") + """
SELECT is_relevant, count(*) AS n FROM staging GROUP BY is_relevant
""")
def relevance_counts(spark, sf_dir):
    """Rows per predicted class (NULL = not classified yet)."""
    return V.staging(spark, sf_dir).groupBy("is_relevant").agg(F.count(F.lit(1)).alias("n"))


@register("random_sample", """
SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || '-42') LIMIT 10
""")
def random_sample(spark, sf_dir):
    """K rows in a seeded pseudo-random order (md5 of key and seed): the
    same rows in every engine and on every run."""
    from ..operators.ordering_ops import seeded_sample
    return seeded_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 10, seed=42)


@register("exclude_existing", """
SELECT doc_id FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || '-1') LIMIT 20)
ORDER BY md5(CAST(doc_id AS VARCHAR) || '-2') LIMIT 30
""")
def exclude_existing(spark, sf_dir):
    """J7 + T2: a second sample of 30 that skips the ids of a first sample."""
    from ..operators.ordering_ops import seeded_sample
    d = table(spark, sf_dir, "documents").select("doc_id")
    first = seeded_sample(d, "doc_id", 20, seed=1)
    return seeded_sample(J.exclude_existing(d, first, "doc_id"), "doc_id", 30, seed=2)


@register("accuracy", """
SELECT round(avg(CASE WHEN (CASE WHEN length(d.text) > 2000 THEN 1 ELSE 0 END) = l.quality
                      THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       count(*) AS n
FROM documents d JOIN labels l ON l.doc_id = d.doc_id
""")
def accuracy(spark, sf_dir):
    """Share of equal labels (a length rule against the quality label)."""
    from ..operators.aggregates import accuracy as acc
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    l_ = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(l_, "doc_id").withColumn("pred", F.when(F.length("text") > 2000, 1).otherwise(0))
    return acc(j, "pred", "quality")
