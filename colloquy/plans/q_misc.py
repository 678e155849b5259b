"""Chunks, log formats, parsing helpers, ordering and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import sql_extract as E
from ..functions import sql_text as S
from ..functions import text as T
from ..operators import chunks as C
from ..sources import views as V
from ..sources.proposals import LINE_SQL
from ..sources.tables import table
from .registry import register

SIZE, OVERLAP = 3000, 100
STEP = SIZE - OVERLAP

LOG_LINES_SQL = V.with_views("messages") + f""",
cl AS (SELECT *, {S.clean_content(S.replace_empty_strings(S.strip_emojis('content')))} AS cc FROM messages),
ll AS (SELECT channel_id, id, ts,
              strftime(ts, '%m-%d-%Y@%H:%M') || ' ' || split_part(author_tag, '#', 1) || ': ' || cc AS line
       FROM cl WHERE cc IS NOT NULL AND cc <> '')"""

CHUNK_SQL = LOG_LINES_SQL + f""",
tk AS (SELECT *, list_filter(regexp_split_to_array(line, {S.q(T.P.WS + '+')}), lambda w: w <> '') AS tok FROM ll),
tk2 AS (SELECT *, len(tok) AS n FROM tk WHERE len(tok) > 0),
go AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY channel_id ORDER BY ts, id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g0 FROM tk2),
ex AS (SELECT channel_id, g0, n, tok, k AS chunk FROM go,
       generate_series(CAST(greatest(0, floor((g0 - {SIZE}) / {STEP}) + 1) AS BIGINT),
                       CAST(floor((g0 + n - 1) / {STEP}) AS BIGINT)) AS s(k)),
pc AS (SELECT channel_id, chunk, g0,
              least(chunk * {STEP} + {SIZE}, g0 + n) - greatest(chunk * {STEP}, g0) AS cnt,
              array_to_string(tok[greatest(chunk * {STEP}, g0) - g0 + 1 :
                                  least(chunk * {STEP} + {SIZE}, g0 + n) - g0], ' ') AS piece
       FROM ex),
ch AS (SELECT channel_id, chunk, sum(cnt) AS n_tokens, string_agg(piece, chr(10) ORDER BY g0) AS text
       FROM pc GROUP BY channel_id, chunk)"""


@register("token_chunks", CHUNK_SQL + """
SELECT channel_id, chunk, n_tokens, md5(text) AS text_md5 FROM ch
""")
def token_chunks(spark, sf_dir):
    """Per channel, the formatted log split into 3000-token chunks that
    overlap by 100 tokens."""
    lines = C.log_lines(V.messages(spark, sf_dir), keep_empty=True).select("channel_id", "ts", "id", "line")
    ch = C.token_chunks(lines, size=SIZE, overlap=OVERLAP)
    return ch.select("channel_id", "chunk", "n_tokens", F.md5("text").alias("text_md5"))


@register("chunk_span", CHUNK_SQL + f"""
SELECT channel_id, chunk,
       regexp_extract_all(text, {S.q(T.P.LOG_TIME)}, 0)[1] AS first_ts,
       regexp_extract_all(text, {S.q(T.P.LOG_TIME)}, 0)[-1] AS last_ts
FROM ch
""")
def chunk_span(spark, sf_dir):
    """First and last log time stamp found in each chunk."""
    lines = C.log_lines(V.messages(spark, sf_dir), keep_empty=True).select("channel_id", "ts", "id", "line")
    ch = C.token_chunks(lines, size=SIZE, overlap=OVERLAP)
    a, b = C.chunk_span(F.col("text"))
    return ch.select("channel_id", "chunk", a.alias("first_ts"), b.alias("last_ts"))


@register("format_log", LOG_LINES_SQL + """
SELECT id, line, strftime(ts, '%-m/%-d@%-H:%M') AS short_time FROM ll
""")
def format_log(spark, sf_dir):
    """Log lines ``MM-dd-yyyy@HH:mm user: text`` and the short
    ``M/d@H:mm`` time of the numbered variant."""
    lines = C.log_lines(V.messages(spark, sf_dir))
    return lines.select("id", "line", F.date_format("ts", "M/d@H:mm").alias("short_time"))


@register("parse_log_time", LOG_LINES_SQL + """
SELECT id, strftime(try_strptime(split_part(line, ' ', 1), '%m-%d-%Y@%H:%M'), '%Y-%m-%d %H:%M:%S') AS parsed
FROM ll
""")
def parse_log_time(spark, sf_dir):
    """The leading stamp of each log line parsed back to a timestamp."""
    lines = C.log_lines(V.messages(spark, sf_dir))
    p = X.parse_log_time(F.substring_index(F.col("line"), " ", 1))
    return lines.select("id", F.date_format(p, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@register("epoch_date", """
SELECT event_id, CAST(DATE '1970-01-01' + CAST(floor(epoch(ts) / 86400) AS INTEGER) AS VARCHAR) AS day
FROM events
""")
def epoch_date(spark, sf_dir):
    """Epoch seconds -> UTC date, independent of the session time zone."""
    ev = table(spark, sf_dir, "events")
    secs = (F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
            + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts")))
    return ev.select("event_id", X.epoch_to_date(secs).alias("day"))


# ---------------------------------------------------------------- parsers over model-reply text

def _replies(spark, sf_dir, field):
    from ..sources.proposals import reply_columns
    return reply_columns(spark, sf_dir).select("pid", F.col(field).alias("reply")).filter(F.col("reply").isNotNull())


def _replies_sql(field: str) -> str:
    from ..sources.proposals import REPLIES_SQL
    return "WITH " + REPLIES_SQL.strip() + f",\nr AS (SELECT pid, reply FROM replies WHERE field = '{field}')\n"


@register("money", _replies_sql("budget") + f"""
SELECT pid, {E.get_usd('reply')} AS usd, {E.get_eth('reply')} AS eth, {E.get_money('reply')} AS money,
       {E.render_number(E.to_number(E.get_money('reply')))} AS amount
FROM r
""")
def money(spark, sf_dir):
    """X21 + X22 + X23 + X24: USD / ETH amounts found in budget replies."""
    r = _replies(spark, sf_dir, "budget")
    # staged projections: a parsed text is computed once and referenced
    # (one nested expression would repeat it inside every later step)
    r = X.with_money(r, "reply").withColumn("_n", X.to_number(F.col("money")))
    return r.select("pid", "usd", "eth", "money", X.render_number(F.col("_n")).alias("amount"))


@register("duration", _replies_sql("duration") + f"""
SELECT pid, {E.duration_months('reply')} AS months, {E.deadline_months(E.duration_months('reply'))} AS n
FROM r
""")
def duration(spark, sf_dir):
    """X26 + X54: duration replies -> 'N months' -> N."""
    r = _replies(spark, sf_dir, "duration")
    d = X.duration_months(F.col("reply"))
    return r.select("pid", d.alias("months"), X.deadline_months(d).alias("n"))


@register("refs", _replies_sql("previous") + f"""
SELECT pid, array_to_string({E.proposal_refs('reply')}, ',') AS refs FROM r
""")
def refs(spark, sf_dir):
    """Referenced proposal numbers."""
    r = _replies(spark, sf_dir, "previous")
    return r.select("pid", F.array_join(X.proposal_refs(F.col("reply")).cast("array<string>"), ",").alias("refs"))


@register("team_fields", _replies_sql("team_size") + f""",
n AS (SELECT pid, reply FROM replies WHERE field = 'team_name')
SELECT r.pid, {E.team_size('r.reply')} AS team_size, {E.capitalize(E.team_name('n.reply'))} AS team_name
FROM r JOIN n ON n.pid = r.pid
""")
def team_fields(spark, sf_dir):
    """X28 + X29: team size and capitalised team name."""
    r = _replies(spark, sf_dir, "team_size")
    n = _replies(spark, sf_dir, "team_name").withColumnRenamed("reply", "name")
    return r.join(n, "pid").select("pid", X.team_size(F.col("reply")).alias("team_size"),
                                   X.capitalize(X.team_name(F.col("name"))).alias("team_name"))


@register("wei", "WITH " + LINE_SQL.strip() + f"""
SELECT pid, pos, target, {E.wei_to_eth('value')} AS eth,
       CAST({E.calldata_amount('calldata')} AS BIGINT) AS amount,
       {E.action_type('signature')} AS action
FROM lines
""")
def wei(spark, sf_dir):
    """X25 + X39 + X40: wei values in ETH (exact decimal, half-up), calldata
    amounts, action types of every line item."""
    from ..sources.proposals import _lines
    ln = _lines(spark, sf_dir)
    return ln.select("pid", "pos", "target", X.wei_to_eth(F.col("value")).alias("eth"),
                     X.calldata_amount(F.col("calldata")).alias("amount"),
                     X.action_type(F.col("signature")).alias("action"))


@register("text_helpers", f"""
SELECT doc_id, {S.get_title('text')} AS title,
       md5(array_to_string((regexp_split_to_array({S.strip('text')}, {S.q(T.P.WS + '+')}))[1:50], ' ')) AS short_md5,
       TRY_CAST(split_part(text, ' ', 1) AS DOUBLE) IS NOT NULL AS first_is_number,
       md5({S.strip_quotes('text')}) AS quotes_md5,
       md5({S.bounded_text('text')}) AS bounded_md5,
       md5({S.collapse_ws(S.to_ascii('text'))}) AS ascii_md5,
       md5({S.sanitize_string('text')}) AS sanitized_md5
FROM documents
""")
def text_helpers(spark, sf_dir):
    """X18 (first 50 words), X19, X20, X31, X32, X33, X34, X11 over whole documents."""
    d = table(spark, sf_dir, "documents")
    t = F.col("text")
    return d.select("doc_id", T.get_title(t).alias("title"), F.md5(T.shorten_words(t, 50)).alias("short_md5"),
                    T.check_float(F.split(t, " ")[0]).alias("first_is_number"),
                    F.md5(T.strip_quotes(t)).alias("quotes_md5"), F.md5(T.bounded_text(t)).alias("bounded_md5"),
                    F.md5(T.collapse_ws(T.to_ascii(t))).alias("ascii_md5"),
                    F.md5(T.sanitize_string(t)).alias("sanitized_md5"))


@register("relation_names", """
SELECT DISTINCT l_returnflag, l_linestatus,
       CASE WHEN l_returnflag = 'R' THEN 'Supported By' WHEN l_returnflag = 'A' THEN 'Abstained By'
            WHEN l_linestatus = 'O' THEN 'Opposed By' END AS relation,
       array_to_string(list_transform(string_split(lower('sendOrRegisterDebt value to ' || l_shipmode_x), ' '),
                       lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS titled,
       split_part('0x' || CAST(l_suppkey % 9 AS VARCHAR) || '-' || CAST(l_orderkey AS VARCHAR), '-', 1) AS voter
FROM (SELECT *, CAST(l_linenumber AS VARCHAR) AS l_shipmode_x FROM lineitem)
""")
def relation_names(spark, sf_dir):
    """X38 + X41 + X42: vote relations from support flags, title-cased
    relation names and voter ids."""
    li = table(spark, sf_dir, "lineitem")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    detailed = F.when(flag == "R", 1).when(flag == "A", 2).when(status == "O", 0).otherwise(1)
    rel = X.vote_relation(flag == "R", detailed)
    titled = X.title_relation(F.concat(F.lit("sendOrRegisterDebt value to "), F.col("l_linenumber").cast("string")))
    voter = X.voter_id(F.concat(F.lit("0x"), (F.col("l_suppkey") % 9).cast("string"), F.lit("-"),
                                F.col("l_orderkey").cast("string")))
    return li.select("l_returnflag", "l_linestatus", rel.alias("relation"), titled.alias("titled"),
                     voter.alias("voter")).distinct()


# ---------------------------------------------------------------- Q&A helpers

@register("fill_template", V.with_views("messages", "questions", "qa") + f"""
SELECT message_id,
       md5({S.to_ascii("replace(replace('Question: <<QUESTION>>' || chr(10) || 'Answer: <<ANSWER>>', '<<QUESTION>>', coalesce(question, '')), '<<ANSWER>>', coalesce(answer, ''))")}) AS prompt_md5,
       CAST(message_id AS VARCHAR) || ': ' || coalesce(question, '') AS id_line,
       regexp_matches(coalesce(answer, ''), '(?i)^pass') AS gate
FROM qa
""")
def fill_template_q(spark, sf_dir):
    """S6 + X33 + F16 + F20: prompts from a template, ASCII only; id lines
    with PostgreSQL CONCAT NULL handling; the pass gate on answers."""
    from ..operators.filters import concat_id_content, passes_gate
    from ..operators.inference import fill_template
    qa = V.qa(spark, sf_dir)
    p = fill_template("Question: <<QUESTION>>\nAnswer: <<ANSWER>>", QUESTION=F.col("question"), ANSWER=F.col("answer"))
    return qa.select("message_id", F.md5(T.to_ascii(p)).alias("prompt_md5"),
                     concat_id_content("message_id", F.coalesce("question", F.lit(""))).alias("id_line"),
                     F.coalesce(passes_gate(F.coalesce("answer", F.lit(""))), F.lit(False)).alias("gate"))


@register("message_tokens", V.with_views("messages") + f"""
SELECT id, len(regexp_extract_all(coalesce(content, ''), {S.q(T.P.WORD + '+|[^' + T.P.WORD_CHARS + T.P.WS_CHARS + ']')}, 0)) AS n_tokens,
       3 + 3 + len(regexp_extract_all(coalesce(content, ''), {S.q(T.P.WORD + '+|[^' + T.P.WORD_CHARS + T.P.WS_CHARS + ']')}, 0))
         + len(regexp_extract_all(author_tag, {S.q(T.P.WORD + '+|[^' + T.P.WORD_CHARS + T.P.WS_CHARS + ']')}, 0)) + 1 AS n_message_tokens,
       CASE WHEN 3 + 3 + len(regexp_extract_all(coalesce(content, ''), {S.q(T.P.WORD + '+|[^' + T.P.WORD_CHARS + T.P.WS_CHARS + ']')}, 0))
         + len(regexp_extract_all(author_tag, {S.q(T.P.WORD + '+|[^' + T.P.WORD_CHARS + T.P.WS_CHARS + ']')}, 0)) + 1 > 300
            THEN 'long-context-model' ELSE 'base-model' END AS model
FROM messages
""")
def message_tokens(spark, sf_dir):
    """X47 + X48: tokens of a message (default regex tokenizer); the chat
    formula (3 per message + value tokens + 1 for a name + 3 for the reply
    primer) and the model route (threshold 300 here)."""
    from ..functions.extract import route_by_length
    m = V.messages(spark, sf_dir)
    n = T.regex_token_count(F.coalesce("content", F.lit("")))
    total = F.lit(3) + F.lit(3) + n + T.regex_token_count(F.col("author_tag")) + F.lit(1)
    return m.select("id", n.alias("n_tokens"), total.alias("n_message_tokens"),
                    route_by_length(total, 300).alias("model"))


@register("search_qa", V.with_views("messages", "questions", "qa") + """
SELECT id, question, rn FROM (
  SELECT id, question, row_number() OVER (ORDER BY id) AS rn FROM qa
  WHERE contains(lower(question), 'the') AND contains(lower(question), 'er'))
WHERE rn BETWEEN 11 AND 20
""")
def search_qa(spark, sf_dir):
    """Keyword search (every keyword, case-insensitive) with pagination
    (page 2 of 10), positions without a global single-task window."""
    from ..operators.ordering_ops import row_positions
    qa = V.qa(spark, sf_dir)
    hit = qa.filter(F.lower("question").contains("the") & F.lower("question").contains("er"))
    p = row_positions(hit.select("id", "question"), "id").withColumn("rn", F.col("position") + 1)
    return p.filter(F.col("rn").between(11, 20)).select("id", "question", "rn")


@register("compare_answers", V.with_views("messages", "questions", "qa") + """
SELECT coalesce(a.message_id, b.message_id) AS message_id, a.answer AS answer_a, b.answer AS answer_b
FROM (SELECT message_id, answer FROM qa WHERE is_relevant = 1) a
FULL OUTER JOIN (SELECT q.id AS message_id, m.content AS answer FROM questions q
                 JOIN messages m ON m.id = q.id + 2 WHERE m.content IS NOT NULL) b
  ON a.message_id = b.message_id
""")
def compare_answers(spark, sf_dir):
    """P5: two answer generations side by side (full outer join on message)."""
    qa = V.qa(spark, sf_dir).filter(F.col("is_relevant") == 1).select("message_id", F.col("answer").alias("answer_a"))
    m = V.messages(spark, sf_dir)
    q = V.questions(spark, sf_dir, m).select(F.col("id").alias("message_id"))
    b = (q.join(m.select((F.col("id") - 2).alias("message_id"), F.col("content").alias("answer_b")), "message_id")
          .filter(F.col("answer_b").isNotNull()))
    return qa.join(b, "message_id", "full").select("message_id", "answer_a", "answer_b")


@register("lookup_ids", V.with_views("messages", "questions", "qa") + """
SELECT id, channel_id FROM messages WHERE id IN (SELECT message_id + 1 FROM qa WHERE answer IS NOT NULL)
""")
def lookup_ids(spark, sf_dir):
    """messages whose id is in an id set (semi join, never an IN list)."""
    from ..operators.filters import lookup_ids as lk
    ids = V.qa(spark, sf_dir).filter(F.col("answer").isNotNull()).select((F.col("message_id") + 1).alias("id"))
    return lk(V.messages(spark, sf_dir).select("id", "channel_id"), ids)


@register("qa_states", V.with_views("messages", "questions", "qa", "staging") + f"""
SELECT (SELECT count(*) FROM qa WHERE answer IS NULL) AS pending,
       (SELECT count(*) FROM qa WHERE is_relevant = 1 AND hidden = 0 AND answer IS NOT NULL) AS publishable,
       (SELECT count(*) FROM staging WHERE is_relevant IS NULL) AS to_classify,
       (SELECT count(*) FROM messages WHERE len({S.chat_tokens("coalesce(content, '')")}) > 0) AS with_tokens,
       (SELECT count(*) FROM messages WHERE channel_id = 7) AS one_channel,
       (SELECT count(*) FROM messages WHERE TRY_CAST(split_part(coalesce(content, ''), ' ', 1) AS BIGINT) IS NOT NULL) AS numeric_start,
       (SELECT count(*) FROM qa q JOIN messages m ON m.id = q.message_id WHERE q.answer IS NOT NULL) AS with_content
""")
def qa_states(spark, sf_dir):
    """F6, F7, F8, F13, F14, F15, F18 and J1 as one row of counts."""
    from ..operators import filters as FL
    from ..operators.joins import qa_with_content
    from ..operators.stats import with_tokens
    qa, st, m = V.qa(spark, sf_dir), V.staging(spark, sf_dir), V.messages(spark, sf_dir)
    parts = {
        "pending": FL.pending_answers(qa),
        "publishable": FL.publishable(qa),
        "to_classify": FL.needs_classification(st),
        "with_tokens": with_tokens(m, "content", T.chat_tokens(F.coalesce("content", F.lit(""))), drop_empty=True),
        "one_channel": m.filter(F.col("channel_id") == 7),
        "numeric_start": m.filter(FL.project_cast(F.split(F.coalesce("content", F.lit("")), " ")[0]).isNotNull()),
        "with_content": FL.pending_answers(qa_with_content(qa, m), pending=False),
    }
    out = None
    for name, df in parts.items():
        c = df.agg(F.count(F.lit(1)).alias(name))
        out = c if out is None else out.unionByName(c, allowMissingColumns=True)
    return out.agg(*[F.max(n).alias(n) for n in parts])


MENTIONS_SQL = """
WITH mt AS (SELECT conv_id * 1000 + turn AS id,
                   '<@' || CAST(conv_id % 60 AS VARCHAR) || '> ' || text AS content FROM conversations),
prof AS (SELECT CAST(c_custkey % 40 AS VARCHAR) AS user_id FROM customer)
SELECT DISTINCT regexp_extract(content, '<@(\\p{Nd}+)>', 1) AS user_id,
       'user' || regexp_extract(content, '<@(\\p{Nd}+)>', 1) || '#0001' AS tag
FROM mt WHERE regexp_extract(content, '<@(\\p{Nd}+)>', 1) NOT IN (SELECT user_id FROM prof)
"""


@register("mention_candidates", MENTIONS_SQL)
def mention_candidates(spark, sf_dir):
    """J19 + X12 + X13: mentioned users without a profile, each once, with
    the tag they would get."""
    from ..functions.text import extract_mention, user_tag
    from ..operators.joins import mention_candidates as mc
    c = table(spark, sf_dir, "conversations")
    mt = c.select(F.concat(F.lit("<@"), (F.col("conv_id") % 60).cast("string"), F.lit("> "), F.col("text"))
                  .alias("content"))
    prof = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 40).cast("string").alias("user_id")).distinct()
    r = mc(mt, prof, extract_mention(F.col("content")))
    return r.select("user_id", user_tag(F.concat(F.lit("user"), F.col("user_id")), F.lit("0001")).alias("tag"))


# ---------------------------------------------------------------- ordering

@register("row_positions", """
SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position,
       (row_number() OVER (ORDER BY doc_id) - 1) // 32 AS batch
FROM documents
""")
def row_positions(spark, sf_dir):
    """W1 + W2: 0-based positions and batches of 32 in id order."""
    from ..operators.ordering_ops import batches
    d = table(spark, sf_dir, "documents").select("doc_id")
    return batches(d, "doc_id", 32).select("doc_id", "position", "batch")


@register("channel_head", V.with_views("messages") + """
SELECT id, ts_text FROM (SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM messages
                         WHERE channel_id = 7 ORDER BY ts, id LIMIT 500)
""")
def channel_head(spark, sf_dir):
    """T1 + F14: one channel in time order, the first 500 messages."""
    from ..operators.ordering_ops import head_by
    m = V.messages(spark, sf_dir).filter(F.col("channel_id") == 7)
    return head_by(m, ["ts", "id"], 500).select("id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"))


@register("latest_page", """
SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100 OFFSET 100
""")
def latest_page(spark, sf_dir):
    """Newest first, page 2 of 100 (first/skip)."""
    from ..operators.ordering_ops import page
    o = table(spark, sf_dir, "orders")
    return page(o, [F.desc("o_orderdate"), F.desc("o_orderkey")], 100, 100).select("o_orderkey")


@register("chronological", V.with_views("messages") + """
SELECT channel_id, id, row_number() OVER (PARTITION BY channel_id ORDER BY ts, id) - 1 AS position FROM messages
""")
def chronological(spark, sf_dir):
    """Every channel in time order (range-partitioned sort) with each
    message's position in its channel (skew-safe positions)."""
    from ..operators.ordering import with_positions
    from ..operators.ordering_ops import chronological as chrono
    m = chrono(V.messages(spark, sf_dir).select("channel_id", "ts", "id"), "channel_id", ["ts", "id"])
    p = with_positions(m, ["channel_id"], "ts", out="position", tiebreak=["id"])
    return p.select("channel_id", "id", "position")


@register("first_rows", V.with_views("messages") + """
SELECT id FROM messages ORDER BY id LIMIT 3000
""")
def first_rows(spark, sf_dir):
    """LIMIT 3000 (an order is added so the rows are reproducible)."""
    return V.messages(spark, sf_dir).select("id").orderBy("id").limit(3000)
