"""Row filters and predicates (F1-F20). All native, all push-down friendly."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_non_empty(col="content") -> Column:
    """F1 predicate: not NULL and not ''."""
    c = _c(col)
    return c.isNotNull() & (c != "")


def non_empty(df: DataFrame, col: str = "content") -> DataFrame:
    """F1."""
    return df.filter(is_non_empty(col))


def contains_question_mark(col="content") -> Column:
    """``ILIKE '%?%'``."""
    return _c(col).contains("?")


def question_regex(col="content") -> Column:
    """has a '?'; is not one space-free token ending in '?'; is not a URL
    with a later '?'; is not exactly '?'. Case-insensitive, dot-all."""
    c = _c(col)
    return (c.rlike(r"(?is)[^.!?]*\?")
            & ~c.rlike(r"(?is)^[^ ]+\?\z")
            & ~c.rlike(r"(?is)^https?://.*\?.*\z")
            & (c != "?"))


# Closed lists standing in for the syntax rules of the question
# detector (question words; auxiliaries / copulas; subject words).
WH_WORDS = ["who", "what", "when", "where", "why", "how"]
AUXILIARIES = ["is", "are", "was", "were", "am", "be", "been", "do", "does", "did",
               "has", "have", "had", "can", "could", "will", "would", "shall",
               "should", "may", "might", "must"]
SUBJECT_WORDS = ["i", "you", "he", "she", "it", "we", "they", "this", "that",
                 "these", "those", "there", "anyone", "someone", "everyone", "the", "a", "an",
                 "my", "your", "his", "her", "its", "our", "their", "any", "some", "all"]
# Short forms after an apostrophe (``what's``), and words before ``n't`` less their n.
CONTRACTED = ["s", "re", "m", "d", "ll", "ve"]
NEGATED = ["isn", "aren", "wasn", "weren", "don", "doesn", "didn", "hasn", "haven", "hadn", "couldn",
           "can", "won", "wouldn", "shouldn", "mustn"]
APOSTROPHES = ["'", "\u2019"]


def is_question(col="content") -> Column:
    """F4 (approximate): some sentence (X45) (a) has more than one token and
    ends with '?', or (b) has more than two tokens, starts with a question
    word followed by an auxiliary, whole or short (``what's``), or (c) has more
    than two tokens (an auxiliary, its subject and a verb or more), starts with an auxiliary, with ``n't`` or without, and continues
    with a subject word. Rules (b) and (c) replace a dependency parse with closed
    word lists."""

    token = f"{P.WORD}++|[^{P.WORD_CHARS}{P.WS_CHARS_J}]"

    def first_tokens(s: Column) -> Column:
        # the rules look at four tokens and tell no counts above three apart
        return F.regexp_extract_all(F.regexp_extract(F.lower(s), f"^(?:{P.WS_J}*+(?:{token})){{0,4}}+", 0), F.lit(token), 0)

    def rule(s: Column, toks: Column) -> Column:
        n = F.size(toks)
        t0, t1, t2, t3 = (F.get(toks, i) for i in range(4))
        has = lambda t, words: F.coalesce(t.isin(words), F.lit(False))
        a = (n > 1) & s.endswith("?")
        short = (n > 3) & has(t1, APOSTROPHES) & has(t2, CONTRACTED)
        b = (n > 2) & has(t0, WH_WORDS) & (has(t1, AUXILIARIES) | short)
        negated = has(t0, NEGATED) & has(t1, APOSTROPHES) & (t2 == "t") & has(t3, SUBJECT_WORDS)
        c = ((n > 2) & has(t0, AUXILIARIES) & has(t1, SUBJECT_WORDS)) | F.coalesce(negated, F.lit(False))
        return a | b | c

    # the inner lambda binds the tokens, which are then found once for a sentence
    return F.exists(T.split_sentences(_c(col)),
                    lambda s: F.exists(F.array(first_tokens(s)), lambda toks: rule(s, toks)))


def high_water_mark(done: DataFrame, done_col: str = "message_id") -> int:
    """A1: ``MAX(CAST(done_col AS BIGINT))``, 0 for an empty table. One
    number travels to the driver."""
    v = done.agg(F.max(F.col(done_col).cast("bigint")).alias("m")).first()["m"]
    return int(v) if v is not None else 0


def after_watermark(df: DataFrame, done: DataFrame, id_col: str = "id",
                    done_col: str = "message_id") -> DataFrame:
    """rows with id above the high-water mark of ``done``. The mark is a
    literal in the plan, so the comparison reaches the scan as a pushed
    filter."""
    return df.filter(F.col(id_col).cast("bigint") > F.lit(high_water_mark(done, done_col)))


def pending_answers(df: DataFrame, col: str = "answer", pending: bool = True) -> DataFrame:
    """answer IS NULL (or IS NOT NULL)."""
    return df.filter(F.col(col).isNull() if pending else F.col(col).isNotNull())


def publishable(df: DataFrame, with_hidden: bool = True) -> DataFrame:
    """is_relevant = 1 AND hidden = 0 AND answer IS NOT NULL."""
    p = (F.col("is_relevant") == 1) & F.col("answer").isNotNull()
    if with_hidden:
        p = p & (F.col("hidden") == 0)
    return df.filter(p)


def needs_classification(df: DataFrame) -> DataFrame:
    """F8: is_relevant IS NULL."""
    return df.filter(F.col("is_relevant").isNull())


def lookup_ids(df: DataFrame, ids: DataFrame, id_col: str = "id", ids_col: str = "id") -> DataFrame:
    """rows whose id is in ``ids`` (a DataFrame, never a literal list):
    semi join, so an empty id set gives an empty result."""
    return df.join(ids.select(F.col(ids_col).alias("_k")).distinct(),
                   F.col(id_col) == F.col("_k"), "left_semi")


def relation_in(df: DataFrame, relations: Iterable[str], keep: bool = True,
                col: str = "relation") -> DataFrame:
    """split triples by membership in a relation list."""
    m = F.col(col).isin(list(relations))
    return df.filter(m if keep else ~m)


def addresses(df: DataFrame, col: str = "object", skip: Iterable[str] = ()) -> DataFrame:
    """distinct objects starting with '0x', minus ``skip``, sorted."""
    c = F.col(col)
    out = df.filter(c.startswith("0x"))
    skip = list(skip)
    if skip:
        out = out.filter(~c.isin(skip))
    return out.select(c.alias("address")).distinct().orderBy("address")


def labelled_rows(df: DataFrame, label_col: str = "label", drop: Iterable[str] = ()) -> DataFrame:
    """keep rows labelled '0' or '1' and drop the trailing columns."""
    out = df.filter(F.col(label_col).cast("string").isin("0", "1"))
    for d in drop:
        out = out.drop(d)
    return out.withColumn(label_col, F.col(label_col).cast("int"))


def drop_no_tokens(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """drop rows with no tokens (or NULL)."""
    return df.filter(F.coalesce(F.size(tokens_col), F.lit(0)) > 0)


def project_cast(col, to: str = "bigint") -> Column:
    """``try_cast`` (ANSI mode makes plain casts raise)."""
    return _c(col).try_cast(to)


def concat_id_content(id_col="id", content_col="content") -> Column:
    """F16: CONCAT(id, ': ', content) with PostgreSQL NULL handling (NULLs
    are skipped, not propagated)."""
    return F.concat_ws("", _c(id_col).cast("string"), F.lit(": "), _c(content_col))


# Model replies meaning "no answer".
NO_ANSWER_REPLIES = ["Not a question.", "No answer located."]


def answer_status(col="answer") -> tuple[Column, Column]:
    """(no_answer flag, answer with the no-answer replies nulled). A NULL
    reply is no answer."""
    c = _c(col)
    no = F.coalesce(c.isin(NO_ANSWER_REPLIES), F.lit(True))
    return (F.when(no, 1).otherwise(0), F.when(no, F.lit(None).cast("string")).otherwise(c))


def passes_gate(col="reply") -> Column:
    """the model reply starts with 'pass', any case."""
    return _c(col).rlike("(?i)^pass")
