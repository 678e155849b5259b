"""Text cleaning, tokens and sentences as native Column expressions.

Every function maps Column -> Column and stays inside whole-stage codegen;
only ``html_unescape(exact=True)`` runs Python (an Arrow-batched pandas UDF
around the standard library unescaper), because the HTML5 entity table has
no native equivalent.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .stopwords import chat_stopwords

ColFn = Callable[[Column], Column]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _re(c, pattern: str, repl: str = "") -> Column:
    return F.regexp_replace(_c(c), pattern, repl)


def strip(c) -> Column:
    """Python ``str.strip()``: Unicode whitespace at both ends (a native
    character-set trim, no regex)."""
    return F.btrim(_c(c), F.lit(P.WS_STRING))


def strip_emojis(c) -> Column:
    """Remove the emoji ranges, then animated emoticons ``<a:name:123>``."""
    return _re(_re(c, P.EMOJI_J), P.ANIMATED_EMOTICON)


def strip_emoticons(c) -> Column:
    """Remove ``:name:`` emoticons."""
    return _re(c, P.EMOTICON)


def replace_empty_strings(c, whitespace_only: bool = True) -> Column:
    """X3: '' (and, by default, all-whitespace) -> NULL."""
    c = _c(c)
    if not whitespace_only:
        return F.when(c != "", c)
    # the input may be a long chain: it stands here once, so it is evaluated once
    return F.get(F.filter(F.array(c), lambda x: x.rlike(P.NOT_WS_J)), 0)


def clean_content(c) -> Column:
    """Strip every line, drop blank lines, re-join with newlines. That is:
    white space that holds a line break becomes one, in one pass; a run of it is
    tried from its first character only."""
    return strip(_re(c, f"(?<!{P.WS_J})[{P.WS_CHARS_J}&&[^\n]]*+\n{P.WS_J}*+", "\n"))


# The named entities decoded natively, '&amp;' last so that
# '&amp;lt;' decodes once, as a single-pass unescaper does.
BASIC_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                  ("&#x27;", "'"), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&middot;", "\u00b7"),
                  ("&copy;", "\u00a9"), ("&amp;", "&")]


@functools.lru_cache(maxsize=1)
def _unescape_udf():
    import html

    import pandas as pd

    def unescape(s):
        return s.map(lambda v: html.unescape(v) if isinstance(v, str) and "&" in v else v)

    unescape.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(unescape, "string")


def html_unescape(c, exact: bool = True) -> Column:
    """HTML entities -> characters. ``exact`` uses the full HTML5 table (pandas
    UDF, Arrow batches); otherwise the common named entities natively."""
    if exact:
        return _unescape_udf()(_c(c))
    out = _c(c)
    for ent, ch in BASIC_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


# The patterns of the cleaning chain, in order.
def _clean_chain(c: Column) -> Column:
    c = _re(c, r"<[^<>]*>", " ")                                  # tags
    c = _re(c, r"\[([^\[\]]*)\]\([^\(\)]*\)", "$1")               # markdown link -> text
    c = _re(c, r"\[[^\[\]]*\]", " ")                              # [bracketed]
    c = _re(c, f"(?:^|{P.WS_J})[&#<>{{}}\\[\\]+|\\\\:-]+(?:{P.WS_J}|\\z)", " ")  # special runs
    c = _re(c, f"(?:^|{P.WS_J})[\\-=\\+]{{2,}}(?:{P.WS_J}|\\z)", " ")   # --- == ++
    return _re(c, f"{P.WS_J}+", " ")


def clean(c, unescape: bool = True, exact_unescape: bool = True) -> Column:
    """Unescape, drop tags / link targets / brackets / standalone special
    runs, collapse whitespace, strip."""
    c = _c(c)
    if unescape:
        c = html_unescape(c, exact=exact_unescape)
    return strip(_clean_chain(c))


def clean_nb(c) -> Column:
    """X5 without unescaping, plus URL removal before the final strip."""
    return strip(_re(_clean_chain(_c(c)), P.URL_J))


def find_urls(c) -> Column:
    """Every ``http(s)://`` or ``www.`` URL."""
    return F.regexp_extract_all(_c(c), F.lit(P.URL_J), 0)


def clean_urls(c, keyword: str) -> Column:
    """A URL whose text reaches ``keyword`` (optionally plural) up to a
    word boundary becomes ``<KEYWORD>URL``."""
    pat = f"(?U)https?://{P.NOT_WS_J}*{keyword}s?\\b"
    return _re(c, pat, keyword.upper() + "URL")


def tokenize(c) -> Column:
    """All runs of word characters / hyphens holding at least one letter."""
    return F.regexp_extract_all(_c(c), F.lit(P.TOKEN), 0)


def remove_stop(tokens, stopwords: Iterable[str] | None = None) -> Column:
    """Drop tokens whose lower case is a stop word. The literal list
    becomes a hash-set membership test (InSet), O(1) per token."""
    stops = list(stopwords if stopwords is not None else chat_stopwords())
    return F.filter(_c(tokens), lambda t: ~F.lower(t).isin(stops))


def prepare(c, steps: Iterable[ColFn]) -> Column:
    """Apply Column functions in order (NULL stays NULL natively)."""
    return functools.reduce(lambda acc, fn: fn(acc), steps, _c(c))


def chat_token_candidates(c) -> Column:
    """The token pipeline before stop-word removal: lower, strip emojis,
    clean (notebook variant), tokenize."""
    return prepare(c, [F.lower, strip_emojis, clean_nb, tokenize])


def chat_tokens(c) -> Column:
    """Token pipeline of the channel analytics: lower, strip emojis, clean
    (notebook variant), tokenize, remove stop words. (Statistics that
    explode the tokens anyway remove stop words after the explode, as a
    hash-set filter inside generated code: ``stats.term_counts``.)"""
    return remove_stop(chat_token_candidates(c))


def sanitize_string(c) -> Column:
    """X11: keep only word characters and whitespace."""
    return _re(c, f"[^{P.WORD_CHARS}{P.WS_CHARS_J}]")


def extract_mention(c) -> Column:
    """The user id of the first ``<@digits>`` mention, NULL if none."""
    v = F.regexp_extract(_c(c), f"<@({P.DIGIT}+)>", 1)
    return F.when(v != "", v)


def all_mentions(c) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(f"<@({P.DIGIT}+)>"), 1)


def user_tag(name, discriminator) -> Column:
    """``sanitized_name#discriminator``."""
    return F.concat(sanitize_string(name), F.lit("#"), _c(discriminator))


# The patterns of the tweet cleaner, in order.
def clean_tweets(c) -> Column:
    """Drop @handles, http links, ://rest, #tags and # runs; strip."""
    for pat in (f"@{P.WORD}+", f"http{P.NOT_WS_J}+", f"://{P.NOT_WS_J}+", f"#{P.WORD}+", "##*"):
        c = _re(c, pat)
    return strip(c)


def remove_html(c) -> Column:
    """Drop ``<...>`` spans that do not cross a newline."""
    return _re(c, r"<[^\n]*?>")


def remove_email(c) -> Column:
    """E-mail-like runs -> one space. A run is tried once, from its first
    character and without going back, so the time is linear in the text."""
    run = f"[{P.WORD_CHARS}.<>]"
    return _re(c, f"(?<!{run}){run}++(?<={P.WORD})@{P.WORD}{run}*+", " ")


def remove_emojis_wide(c) -> Column:
    """The wide emoji set (also removes every supplementary-plane char)."""
    return _re(c, P.WIDE_EMOJI)


def summary_clean(c) -> Column:
    """Input cleaning of the summary / budget extractors: X17, X16, X15, X14."""
    return clean_tweets(remove_html(remove_email(remove_emojis_wide(c))))


def shorten_words(c, max_tokens: int = 3500) -> Column:
    """X18 default: the first ``max_tokens`` whitespace-separated words."""
    words = F.split(strip(c), f"{P.WS_J}+")
    return F.array_join(F.slice(words, 1, max_tokens), " ")


def get_title(c) -> Column:
    """First line without '#', stripped."""
    return strip(F.replace(F.substring_index(_c(c), "\n", 1), F.lit("#"), F.lit("")))


def check_float(c) -> Column:
    """Parses as a floating point number."""
    return _c(c).try_cast("double").isNotNull()


def strip_quotes(c) -> Column:
    """Newline -> space, drop single and double quotes."""
    return F.translate(F.replace(_c(c), F.lit("\n"), F.lit(" ")), "'\"", "")


def bounded_text(c, limit: int = 2499, keep: int = 2400) -> Column:
    """Longer than ``limit`` -> first ``keep`` chars; newline -> '-';
    drop '"'; strip."""
    c = _c(c)
    cut = F.when(F.length(c) > limit, F.substring(c, 1, keep)).otherwise(c)
    return strip(F.translate(F.replace(cut, F.lit("\n"), F.lit("-")), '"', ""))


def to_ascii(c) -> Column:
    """Drop every non-ASCII character."""
    return _re(c, r"[^\x00-\x7F]")


def collapse_ws(c) -> Column:
    """Strip, whitespace runs -> one space."""
    return _re(strip(c), f"{P.WS_J}+", " ")


def split_sentences(c) -> Column:
    """Sentences as runs up to and including terminal punctuation,
    stripped, empty ones dropped."""
    parts = F.transform(F.regexp_extract_all(_c(c), F.lit(P.SENTENCE), 0), lambda s: strip(s))
    return F.filter(parts, lambda s: s != "")


def questions_in(c) -> Column:
    """The sentences that end with '?'."""
    return F.filter(split_sentences(c), lambda s: s.endswith("?"))


def word_count(c) -> Column:
    """Number of whitespace-separated words (0 for NULL / blank)."""
    return F.coalesce(F.size(F.filter(F.split(_c(c), f"{P.WS_J}+"), lambda w: w != "")), F.lit(0))


def regex_token_count(c) -> Column:
    """X47 default tokenizer: runs of word characters plus single punctuation
    marks (a BPE tokenizer can be plugged in through ``inference``)."""
    return F.coalesce(F.size(F.regexp_extract_all(
        _c(c), F.lit(f"{P.WORD}+|[^{P.WORD_CHARS}{P.WS_CHARS_J}]"), 0)), F.lit(0))


def ordered_concat(items: Column, order_field: str, value_field: str, sep: str = "") -> Column:
    """Join ``value_field`` of an array of structs in ``order_field``
    order (use on the result of ``collect_list(struct(..))``)."""
    srt = F.array_sort(items, lambda a, b: F.when(a[order_field] < b[order_field], -1)
                       .when(a[order_field] > b[order_field], 1).otherwise(0))
    return F.array_join(F.transform(srt, lambda x: x[value_field]), sep)
