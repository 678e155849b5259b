"""Text cleaning and term-statistics queries over documents, pages and messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sql_text as S
from ..functions import text as T
from ..functions.stopwords import CLOUD_STOP, chat_stopwords
from ..operators import filters as FL
from ..operators import stats as ST
from ..operators.generate import explode_rows
from ..sources import views as V
from ..sources.tables import spread, table
from .registry import register


def _docs(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


# ---------------------------------------------------------------- cleaning

@register("clean_text", f"""
SELECT doc_id, md5(c) AS clean_md5, length(c) AS clean_len
FROM (SELECT doc_id, {S.clean_nb('text')} AS c FROM documents)
""")
def clean_text(spark, sf_dir):
    """Notebook clean chain (tags, links, brackets, special runs,
    whitespace, URLs) over whole documents."""
    c = T.clean_nb(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.md5(c).alias("clean_md5"), F.length(c).alias("clean_len"))


@register("clean_html", f"""
SELECT page_id, md5(c) AS clean_md5, length(c) AS clean_len
FROM (SELECT page_id, {S.clean('html')} AS c FROM pages)
""")
def clean_html(spark, sf_dir):
    """HTML unescape (full entity table) + clean chain over raw pages."""
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    c = T.clean(F.col("html"))
    return p.select("page_id", F.md5(c).alias("clean_md5"), F.length(c).alias("clean_len"))


@register("clean_lines", f"""
SELECT doc_id, md5(c) AS clean_md5, len(string_split(c, chr(10))) AS n_lines
FROM (SELECT doc_id, {S.clean_content(S.replace_empty_strings(S.strip_emojis('text')))} AS c
      FROM documents)
WHERE c IS NOT NULL
""")
def clean_lines(spark, sf_dir):
    """X1 + X3 + X4 (summary input pipeline), NULL results dropped."""
    c = T.prepare(F.col("text"), [T.strip_emojis, T.replace_empty_strings, T.clean_content])
    # a row of its own for each text: a filter on the column would be pushed below and clean twice
    return (explode_rows(_docs(spark, sf_dir), F.array(c), "c", "doc_id").filter(F.col("c").isNotNull())
            .select("doc_id", F.md5("c").alias("clean_md5"), F.size(F.split("c", "\n")).alias("n_lines")))


@register("strip_emoji", f"""
SELECT doc_id, length({S.strip_emoticons(S.strip_emojis('text'))}) AS stripped_len,
       md5({S.strip_emoticons(S.strip_emojis('text'))}) AS stripped_md5
FROM documents
""")
def strip_emoji(spark, sf_dir):
    """X1 + X2: emoji ranges, animated and plain emoticons removed."""
    c = T.strip_emoticons(T.strip_emojis(F.col("text")))
    return _docs(spark, sf_dir).select("doc_id", F.length(c).alias("stripped_len"),
                                       F.md5(c).alias("stripped_md5"))


@register("strip_html", f"""
SELECT page_id, md5(c) AS clean_md5, length(c) AS clean_len
FROM (SELECT page_id, {S.summary_clean('html')} AS c FROM pages)
""")
def strip_html(spark, sf_dir):
    """X17 + X16 + X15 + X14: the summary-input cleaner over raw pages."""
    c = T.summary_clean(F.col("html"))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.md5(c).alias("clean_md5"), F.length(c).alias("clean_len"))


@register("tokenize", f"""
SELECT doc_id, len(t) AS num_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, {S.chat_tokens('text')} AS t FROM documents)
""")
def tokenize_q(spark, sf_dir):
    """X10 pipeline: lower, X1, X6, X8, X9 per document."""
    t = T.chat_tokens(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.size(t).alias("num_tokens"),
                                       F.md5(F.array_join(t, " ")).alias("tokens_md5"))


@register("question_sentences", f"""
SELECT doc_id, len(s) AS n_sentences, md5(array_to_string(s, '|')) AS sentences_md5
FROM (SELECT doc_id, {S.split_sentences('text')} AS s FROM documents)
""")
def question_sentences(spark, sf_dir):
    """X45 sentence split of whole documents (X44 keeps those ending in '?')."""
    s = T.split_sentences(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.size(s).alias("n_sentences"),
                                       F.md5(F.array_join(s, "|")).alias("sentences_md5"))


@register("question_detected", f"""
SELECT doc_id, CASE WHEN {S.is_question('text')} THEN 1 ELSE 0 END AS asks FROM documents
""")
def question_detected(spark, sf_dir):
    """whether some sentence of a whole document asks something."""
    asks = F.coalesce(FL.is_question("text"), F.lit(False)).cast("int")
    return _docs(spark, sf_dir).select("doc_id", asks.alias("asks"))


@register("question_regex", r"""
SELECT page_id,
       CASE WHEN url ILIKE '%?%' THEN 1 ELSE 0 END AS has_mark,
       CASE WHEN regexp_matches(url, '(?is)[^.!?]*\?')
             AND NOT regexp_matches(url, '(?is)^[^ ]+\?\z')
             AND NOT regexp_matches(url, '(?is)^https?://.*\?.*\z')
             AND url <> '?' THEN 1 ELSE 0 END AS is_question,
       len(list_filter(""" + S.split_sentences("url") + r""", lambda s: suffix(s, '?'))) AS n_q_sentences
FROM pages
""")
def question_regex(spark, sf_dir):
    """F2 + F3 + X44 on page URLs (79 of 250 carry a '?' at sf0.01)."""
    from ..operators.filters import contains_question_mark, question_regex as qre
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return p.select("page_id",
                    F.when(contains_question_mark("url"), 1).otherwise(0).alias("has_mark"),
                    F.when(qre("url"), 1).otherwise(0).alias("is_question"),
                    F.size(T.questions_in(F.col("url"))).alias("n_q_sentences"))


# ---------------------------------------------------------------- statistics

STOP = chat_stopwords()


def _doc_tokens(spark, sf_dir):
    """Token candidates per document; stop words are removed after the
    explode in the statistics (same result as X9 on the arrays)."""
    return ST.with_tokens(_docs(spark, sf_dir), "text", T.chat_token_candidates(F.col("text")))


def _doc_term_stats(spark, sf_dir):
    """((token, freq, df), N) of all documents, from one aggregate."""
    return ST.term_stats(_doc_tokens(spark, sf_dir), stopwords=STOP)


DOC_TOKENS_SQL = f"""
toks AS (SELECT doc_id, t FROM (SELECT doc_id, {S.chat_tokens('text')} AS t FROM documents) WHERE len(t) > 0),
occ AS (SELECT doc_id, unnest(t) AS token FROM toks),
freq AS (SELECT token, count(*) AS freq FROM occ GROUP BY token HAVING count(*) >= 2),
dfreq AS (SELECT token, count(DISTINCT doc_id) AS df FROM occ GROUP BY token HAVING count(DISTINCT doc_id) >= 2),
idf AS (SELECT token, df, ln((SELECT count(*) FROM toks) / df) + 0.1 AS idf FROM dfreq)
"""


@register("token_frequency", "WITH " + DOC_TOKENS_SQL + "SELECT token, freq FROM freq")
def token_frequency(spark, sf_dir):
    """A5: token counts over all documents, freq >= 2."""
    return ST.token_frequency(_doc_tokens(spark, sf_dir), stopwords=STOP).select("token", "freq")


@register("idf", "WITH " + DOC_TOKENS_SQL + "SELECT token, df, round(idf, 6) AS idf FROM idf")
def idf_q(spark, sf_dir):
    """Document frequency >= 2 and ln(N/df) + 0.1."""
    t, n = _doc_term_stats(spark, sf_dir)
    return t.filter(F.col("df") >= 2).select("token", "df", F.round(ST.idf_of("df", n), 6).alias("idf"))


@register("tfidf", "WITH " + DOC_TOKENS_SQL + """
SELECT f.token, f.freq, round(f.freq * i.idf, 6) AS tfidf
FROM freq f LEFT JOIN idf i ON i.token = f.token""")
def tfidf_q(spark, sf_dir):
    """A7 + J14: freq x idf, NULL where the token has no idf."""
    t, n = _doc_term_stats(spark, sf_dir)
    return t.filter(F.col("freq") >= 2).select(
        "token", "freq", F.round(F.col("freq") * ST.idf_of("df", n), 6).alias("tfidf"))


@register("top_terms", "WITH " + DOC_TOKENS_SQL + """
SELECT token, freq, rank FROM (
  SELECT token, freq, row_number() OVER (ORDER BY freq DESC, token) AS rank FROM freq)
WHERE rank <= 15""")
def top_terms(spark, sf_dir):
    """T4: the 15 most frequent tokens (ties by token)."""
    f = ST.token_frequency(_doc_tokens(spark, sf_dir), stopwords=STOP)
    top = ST.top_terms(f, 15)
    from pyspark.sql import Window
    return top.select("token", "freq",
                      F.row_number().over(Window.orderBy(F.desc("freq"), "token")).alias("rank"))


MSG_TOKENS_SQL = V.with_views("messages") + f""",
toks AS (SELECT id, channel_id, t FROM (SELECT id, channel_id, {S.chat_tokens('content')} AS t FROM messages
         WHERE content IS NOT NULL) WHERE len(t) > 0),
occ AS (SELECT id, channel_id, unnest(t) AS token FROM toks),
cfreq AS (SELECT channel_id, token, count(*) AS freq FROM occ GROUP BY channel_id, token HAVING count(*) >= 2),
dfreq AS (SELECT token, count(DISTINCT id) AS df FROM occ GROUP BY token HAVING count(DISTINCT id) >= 2),
idf AS (SELECT token, ln((SELECT count(*) FROM toks) / df) + 0.1 AS idf FROM dfreq)
"""


def _msg_tokens(spark, sf_dir, candidates: bool = False):
    m = V.messages(spark, sf_dir).filter(F.col("content").isNotNull()).select("id", "channel_id", "content")
    fn = T.chat_token_candidates if candidates else T.chat_tokens
    return ST.with_tokens(m, "content", fn(F.col("content")))


@register("channel_tfidf", MSG_TOKENS_SQL + """
SELECT f.channel_id, f.token, f.freq, round(f.freq * i.idf, 6) AS tfidf
FROM cfreq f LEFT JOIN idf i ON i.token = f.token""")
def channel_tfidf(spark, sf_dir):
    """Per-channel frequency (>= 2 within the channel) x global idf,
    every channel in one job."""
    t, n = ST.term_stats(_msg_tokens(spark, sf_dir, candidates=True), by=["channel_id"], stopwords=STOP)
    idf = t.groupBy("token").agg(F.sum("df").alias("df")).select("token", ST.idf_of("df", n).alias("idf"))
    r = ST.tfidf(t.filter(F.col("freq") >= 2), idf)
    return r.select("channel_id", "token", "freq", F.round("tfidf", 6).alias("tfidf"))


_CLOUD = "[" + ", ".join(S.q(w) for w in CLOUD_STOP) + "]"


@register("channel_top_terms", MSG_TOKENS_SQL + f"""
SELECT channel_id, token, freq, rank FROM (
  SELECT channel_id, token, freq,
         row_number() OVER (PARTITION BY channel_id ORDER BY freq DESC, token) AS rank
  FROM cfreq WHERE NOT list_contains({_CLOUD}, token))
WHERE rank <= 10""")
def channel_top_terms(spark, sf_dir):
    """T4 per channel: top 10 tokens by frequency without the cloud stop list."""
    t = _msg_tokens(spark, sf_dir, candidates=True)
    f = ST.token_frequency(t, by=["channel_id"], stopwords=STOP)
    return ST.top_terms(f, 10, by=["channel_id"], exclude=CLOUD_STOP).select(
        "channel_id", "token", "freq", "rank")


@register("channel_sizes", MSG_TOKENS_SQL + """
SELECT channel_id, count(*) AS n FROM toks GROUP BY channel_id ORDER BY n DESC, channel_id LIMIT 5""")
def channel_sizes(spark, sf_dir):
    """A4: the five channels with most (token-bearing) messages."""
    return ST.group_sizes(_msg_tokens(spark, sf_dir), "channel_id", 5, count_if=F.col("num_tokens") > 0)


@register("url_frequency", f"""
SELECT token, count(*) AS freq
FROM (SELECT unnest({S.find_urls('url')}) AS token FROM pages)
GROUP BY token""")
def url_frequency(spark, sf_dir):
    """A9 + X7: frequency of URL matches (min_freq 1: page URLs are unique)."""
    p = table(spark, sf_dir, "pages").select(T.find_urls(F.col("url")).alias("tokens"))
    return ST.token_frequency(p, min_freq=1).select("token", "freq")
