"""Retrieval, classifier and model-backed queries (stub models)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import inference as I
from ..operators import learn as L
from ..operators import retrieval as R
from ..sources import views as V
from ..sources.proposals import REPLIES_SQL
from ..sources.tables import spread, table
from .registry import register

PROBES_SQL = """
probes AS (SELECT e.vec_id AS query_id, e.embedding
           FROM embeddings e JOIN (SELECT label, min(vec_id) AS vec_id FROM embeddings GROUP BY label) f
             ON f.vec_id = e.vec_id)"""


def _probes(emb):
    first = emb.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    return emb.join(first.select("vec_id"), "vec_id").select(F.col("vec_id").alias("query_id"), "embedding")


@register("vector_topk", "WITH " + PROBES_SQL.strip() + """
SELECT query_id, vec_id, rank, round(score, 6) AS score FROM (
  SELECT p.query_id, e.vec_id, s AS score,
         row_number() OVER (PARTITION BY p.query_id ORDER BY round(s, 10) DESC, e.vec_id) AS rank
  FROM probes p, embeddings e,
       LATERAL (SELECT list_cosine_similarity(CAST(p.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS s) x
  WHERE isfinite(s))
WHERE rank <= 5
""")
def vector_topk(spark, sf_dir):
    """T5 exact: 5 nearest vectors (cosine) of the first vector of every
    label; a matrix product in blocks, merged per query."""
    emb = table(spark, sf_dir, "embeddings")
    r = R.vector_topk(emb, _probes(emb), 5)
    return r.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


@register("vector_topk_lsh")
def vector_topk_lsh(spark, sf_dir):
    """T5 approximate: random-projection LSH candidates, ranked by distance."""
    emb = table(spark, sf_dir, "embeddings")
    return R.vector_topk_lsh(emb, _probes(emb), 5)


def _every_hundredth(emb):
    return emb.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@register("vector_topk_ivf")
def vector_topk_ivf(spark, sf_dir):
    """T5 approximate: an inverted file over all vectors, asked for every vector
    whose id is divisible by 100; as many cells for each as 95 % recall takes."""
    emb = table(spark, sf_dir, "embeddings")
    index = R.InvertedFile(emb)
    r = index.search(_every_hundredth(emb), 5, index.probes_for(0.95))
    return r.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


@register("vector_ivf_recall", """
SELECT count(*) AS queries, count(*) * (SELECT count(*) FROM embeddings) AS pairs,
       true AS recall_at_least_090, true AS scored_fewer
FROM embeddings WHERE vec_id % 100 = 0
""")
def vector_ivf_recall(spark, sf_dir):
    """T5 approximate, measured: whether the inverted file finds at least nine of
    ten of the exact five nearest vectors while it scores fewer than all pairs
    (queries: every vector whose id is divisible by 100)."""
    emb = table(spark, sf_dir, "embeddings")
    queries, index = _every_hundredth(emb), R.InvertedFile(emb)
    probes = index.probes_for(0.95)
    found = R.recall(index.search(queries, 5, probes), R.vector_topk(emb, queries, 5))
    return index.candidates(queries, probes).join(found).select(
        "queries", "pairs", (F.col("recall") >= 0.9).alias("recall_at_least_090"),
        (F.col("scored") < F.col("pairs")).alias("scored_fewer"))


@register("vector_upsert", """
SELECT vec_id, round(embedding[1], 6) AS first, src FROM (
  SELECT vec_id, embedding, 'old' AS src FROM embeddings WHERE label < 6
     AND vec_id NOT IN (SELECT vec_id FROM embeddings WHERE label > 3)
  UNION ALL
  SELECT vec_id, list_transform(embedding, lambda x: x * 2), 'new' FROM embeddings WHERE label > 3)
""")
def vector_upsert(spark, sf_dir):
    """Two overlapping index loads; the second replaces equal keys."""
    emb = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "message_id")
    old = emb.filter(F.col("label") < 6).select("message_id", "embedding", F.lit("old").alias("src"))
    new = emb.filter(F.col("label") > 3).select("message_id", F.transform("embedding", lambda x: x * 2)
                                                .alias("embedding"), F.lit("new").alias("src"))
    u = R.vector_upsert(old, new, "message_id")
    return u.select(F.col("message_id").alias("vec_id"),
                    F.round(F.try_element_at("embedding", F.lit(1)).cast("double"), 6).alias("first"), "src")


EMBED_SQL = """,
slots AS (SELECT message_id, answer, list_transform(regexp_extract_all(lower(coalesce(question, '')), '[0-9a-z_]+'),
            lambda w: CAST('0x' || left(md5(w), 2) AS INTEGER)) AS s FROM qa),
counts AS (SELECT message_id, answer, list_transform(range(256), lambda d: len(list_filter(s, lambda x: x = d))) AS c FROM slots),
embedded AS (SELECT message_id, answer, sqrt(list_sum(list_transform(c, lambda x: x * x))) AS norm,
               list_transform(c, lambda x: CASE WHEN list_sum(c) > 0 THEN x / sqrt(list_sum(list_transform(c, lambda y: y * y)))
                                                ELSE 0.0 END) AS embedding FROM counts)"""


@register("embed_hash", V.with_views("messages", "questions", "qa") + EMBED_SQL + """
SELECT message_id, embedding FROM embedded
""")
def embed_hash(spark, sf_dir):
    """M5 built-in embedding (hashed words, L2 norm) of every Q&A question."""
    qa = V.qa(spark, sf_dir)
    return R.hashing_embed(qa, "question").select("message_id", "embedding")


@register("embed_batches", V.with_views("messages", "questions", "qa") + EMBED_SQL + """
SELECT message_id, embedding, 'ok' AS status FROM embedded
""")
def embed_batches(spark, sf_dir):
    """M5 with a model: every Q&A question through ``embed_with`` in batches of
    32, the stand-in model loaded once for a worker."""
    model = I.Model("word hasher", R.load_word_hasher)
    return R.embed_with(V.qa(spark, sf_dir), "question", model, "message_id")


@register("retrieve", V.with_views("messages", "questions", "qa") + EMBED_SQL + """,
answered AS (SELECT * FROM embedded WHERE answer IS NOT NULL AND norm > 0),
ranked AS (
  SELECT q.message_id AS query_id, v.message_id, v.answer, s AS score,
         row_number() OVER (PARTITION BY q.message_id ORDER BY round(s, 10) DESC, v.message_id) AS rank
  FROM answered q, answered v, LATERAL (SELECT list_cosine_similarity(q.embedding, v.embedding) AS s) x)
SELECT query_id, message_id, rank, round(score, 6) AS score, answer FROM ranked WHERE rank <= 5
""")
def retrieve(spark, sf_dir):
    """M6 + J17: each answered Q&A question used as a query against the
    embedded Q&A base; top 5 neighbours with their answers."""
    qa = V.qa(spark, sf_dir).filter(F.col("answer").isNotNull())
    idx = R.hashing_embed(qa, "question")
    hits = R.vector_topk(idx.select(F.col("message_id"), "embedding"),
                         idx.select(F.col("message_id").alias("query_id"), "embedding"), 5,
                         id_col="message_id")
    return R.hits_with_answers(hits, qa.select("message_id", "answer")).select(
        "query_id", "message_id", "rank", F.round("score", 6).alias("score"), "answer")


@register("train_relevance")
def train_relevance(spark, sf_dir):
    """M1 + M2 + M3: fit on 90 % of the labelled documents, predict the rest."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    d = d.select("doc_id", "text", F.col("quality").alias("label"))
    train, val = L.split_train_val(d, "doc_id")
    model = L.train_relevance(train)
    return L.predict_relevance(model, val).select("doc_id", "label", "is_relevant", "relevance")


@register("evaluate_relevance")
def evaluate_relevance(spark, sf_dir):
    """M4: accuracy on the hash-split validation share."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    d = d.select("doc_id", "text", F.col("quality").alias("label"))
    train, val = L.split_train_val(d, "doc_id")
    return L.evaluate_relevance(L.train_relevance(train), val)


# Fixed layout of the gate prompt (the template text itself is a parameter).
GATE_TEMPLATE = "Is this a question about the community?\n<<QUESTION>>\nAnswer Pass or Fail."


@register("gate_reply")
def gate_reply(spark, sf_dir):
    """M12 = F2 + S6 + M7 + F20 + D1: URLs holding '?' are gated by the
    model; passing ones are inserted into an (empty) staging table."""
    from ..operators.filters import contains_question_mark, passes_gate
    from ..operators.state import insert_if_absent
    p = table(spark, sf_dir, "pages").filter(contains_question_mark("url"))
    p = p.select(F.col("page_id").alias("message_id"),
                 I.fill_template(GATE_TEMPLATE, QUESTION=F.col("url")).alias("prompt"))
    r = I.complete(p, "message_id", "prompt", I.echo_model)
    ok = r.filter(passes_gate("text")).select("message_id", F.lit(None).cast("int").alias("is_relevant"),
                                               F.lit(0).alias("answered"))
    base = spark.createDataFrame([], "message_id long, is_relevant int, answered int")
    return insert_if_absent(base, ok, "message_id")


@register("complete_stub")
def complete_stub(spark, sf_dir):
    """M7 on every conversation prompt (flagship output), stub model."""
    from .q_conversation import context_prompt
    p = context_prompt(spark, sf_dir)
    return I.complete(p, "message_id", "prompt", I.echo_model)


@register("summarize_rounds")
def summarize_rounds(spark, sf_dir):
    """M8: recursive summarisation of whole documents (max 200 words)."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return I.recursive_summarize(d, "doc_id", "text", 200, I.halving_model)


SUMMARY_TEMPLATE = "Summarize the chat log below.\n<<LOG>>\nSUMMARY:"


@register("summarize_chunks")
def summarize_chunks(spark, sf_dir):
    """M10 = W3 + A19 + S6 + M7: one summary row (start, end, summary,
    channel) per chunk of every channel's log."""
    from ..functions.extract import parse_log_time
    from ..operators import chunks as C
    lines = C.log_lines(V.messages(spark, sf_dir), keep_empty=True).select("channel_id", "ts", "id", "line")
    ch = C.token_chunks(lines).withColumn("_key", F.concat_ws(":", "channel_id", "chunk"))
    first, last = C.chunk_span(F.col("text"))
    ch = ch.withColumn("start_date", parse_log_time(first)).withColumn("end_date", parse_log_time(last))
    r = I.complete(ch.withColumn("prompt", I.fill_template(SUMMARY_TEMPLATE, LOG=F.col("text"))),
                   "_key", "prompt", I.echo_model)
    r = r.select("_key", F.col("text").alias("_summary"), "status")
    return ch.join(r, "_key").select("start_date", "end_date", T.to_ascii(F.col("_summary")).alias("summary"),
                                     F.col("channel_id").alias("channel"), "status")


@register("display_summaries")
def display_summaries(spark, sf_dir):
    """M11 = F6 + S6 + M7 + D2: fill ``display_summary`` where it is NULL."""
    from ..operators.state import update_by_key
    s = V.summaries(spark, sf_dir).withColumn("id", F.xxhash64("channel_id", "timestamp", "interval"))
    s = s.withColumn("display_summary", F.lit(None).cast("string"))
    todo = s.filter(F.col("display_summary").isNull()).withColumn(
        "prompt", I.fill_template("Shorten for audio:\n<<SUMMARY>>", SUMMARY=F.col("summary")))
    r = I.complete(todo, "id", "prompt", I.echo_model).select("id", F.col("text").alias("display_summary"))
    return update_by_key(s, r, "id", ["display_summary"])


def _field_values() -> dict:
    """Per field: the parser for Spark, and that for SQL."""
    from ..functions import extract as X
    from ..functions import sql_extract as E
    joined = lambda c: F.array_join(c.cast("array<string>"), ",")
    return {"budget": (X.get_money, E.get_money("reply")),
            "ptype": (lambda c: joined(X.keywords(c)), f"array_to_string({E.keywords('reply')}, ',')"),
            "duration": (X.duration_months, E.duration_months("reply")),
            "team_size": (X.team_size, f"CAST({E.team_size('reply')} AS VARCHAR)"),
            "team_name": (X.team_name, E.team_name("reply")),
            "previous": (lambda c: joined(X.proposal_refs(c)), f"array_to_string({E.proposal_refs('reply')}, ',')")}


def _described(spark, sf_dir):
    """(pid, description): stand-in proposals. The text holds the stand-in reply of each
    field between marks; every sixteenth goes on beyond the model's limit."""
    from ..sources import proposals as PR
    wide = spread(PR.reply_columns(spark, sf_dir))
    marks = [F.concat(F.lit(f"[{f}]"), F.col(f), F.lit(f"[/{f}]")) for f in _field_values()]
    more = F.when(F.col("pid") % 16 == 0, F.repeat(F.lit(" and so on"), 500))
    return wide.select("pid", F.concat_ws("\n", *marks, more).alias("description"))


@register("extract_fields", "WITH " + REPLIES_SQL.strip() + "\nSELECT pid, field, CASE WHEN pid % 16 = 0 THEN 'short' ELSE 'full' END AS variant, value FROM ("
          + " UNION ALL ".join(f"SELECT pid, field, {sql} AS value FROM replies WHERE field = '{name}'"
                               for name, (_, sql) in _field_values().items())
          + ") WHERE value IS NOT NULL AND value <> ''")
def extract_fields(spark, sf_dir):
    """Six fields of every proposal by prompt, stand-in model and parser; of
    the full description, else of its first 200 words."""
    fields = [I.Field(name, f"Extract the {name}.\n<<TEXT>>", parser, name == "budget")
              for name, (parser, _) in _field_values().items()]
    return I.extract_fields(_described(spark, sf_dir), "pid", "description", fields, I.marked_model,
                            max_prompt_chars=3000, short_words=200)


BATCH_TEMPLATE = "Label each line Y or N.\n<<LOGS>>\nLABELS:"


@register("batch_prompt", """
SELECT replace('""" + BATCH_TEMPLATE.replace("\n", "' || chr(10) || '") + """', '<<LOGS>>',
               string_agg(CAST(doc_id AS VARCHAR) || ': ' || text, chr(10) ORDER BY doc_id)) AS prompt
FROM (SELECT doc_id, text FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || '-42') LIMIT 10)
""")
def batch_prompt(spark, sf_dir):
    """M9 + T2 + A14: ten seeded-sampled documents as ``id: text`` lines in one prompt."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return I.batch_prompt(d, "doc_id", "text", 10, BATCH_TEMPLATE)


@register("parse_labels", """
WITH rep AS (
  SELECT conv_id, string_agg(CAST(conv_id * 1000 + turn AS VARCHAR) || ' - '
           || CASE WHEN turn % 2 = 0 THEN 'Y - ' || split_part(text, ' ', 1) ELSE 'N' END, chr(10) ORDER BY turn) AS reply
  FROM conversations GROUP BY conv_id),
ln AS (SELECT conv_id, unnest(string_split(reply, chr(10))) AS l FROM rep)
SELECT conv_id, regexp_extract(l, '^\\s*(\\d+)\\s*-', 1) AS id,
       regexp_extract(l, '^\\s*\\d+\\s*-\\s*([YyNn])', 1) AS label,
       regexp_replace(regexp_extract(l, '^\\s*\\d+\\s*-\\s*[YyNn]\\s*-\\s*(.*)$', 1), '^\\s+|\\s+$', '', 'g') AS text
FROM ln WHERE regexp_extract(l, '^\\s*(\\d+)\\s*-', 1) <> ''
""")
def parse_labels(spark, sf_dir):
    """Model reply lines ``id - N`` / ``id - Y - text`` parsed into rows
    (replies built from the conversations)."""
    c = table(spark, sf_dir, "conversations")
    line = F.concat((F.col("conv_id") * 1000 + F.col("turn")).cast("string"), F.lit(" - "),
                    F.when(F.col("turn") % 2 == 0, F.concat(F.lit("Y - "), F.split("text", " ")[0]))
                     .otherwise(F.lit("N")))
    rep = (c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))).alias("_l"))
            .select("conv_id", F.array_join(F.transform("_l", lambda x: x["l"]), "\n").alias("reply")))
    p = rep.select("conv_id", F.explode(I.parse_labels(F.col("reply"))).alias("x"))
    return p.select("conv_id", F.col("x.id").alias("id"), F.col("x.label").alias("label"),
                    F.regexp_replace(F.col("x.text"), r"^\s+|\s+$", "").alias("text"))
