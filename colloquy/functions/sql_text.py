"""DuckDB spellings of the text functions, for oracle SQL only.

They use the same pattern text as ``functions.text`` (Java regex and RE2
agree on every pattern used), with DuckDB's global-replace flag and ``\\1``
back-references."""

from __future__ import annotations

from . import patterns as P
from .stopwords import chat_stopwords
from .text import BASIC_ENTITIES


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rr(x: str, pattern: str, repl: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(repl)}, 'g')"


def strip(x: str) -> str:
    return rr(x, f"^{P.WS}+|{P.WS}+\\z")


def strip_emojis(x: str) -> str:
    return rr(rr(x, P.EMOJI), P.ANIMATED_EMOTICON)


def strip_emoticons(x: str) -> str:
    return rr(x, P.EMOTICON)


def replace_empty_strings(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR NOT regexp_matches({x}, {q(P.NOT_WS)}) THEN NULL ELSE {x} END"


def clean_content(x: str) -> str:
    lines = f"list_transform(string_split({x}, chr(10)), lambda l: {strip('l')})"
    return f"array_to_string(list_filter({lines}, lambda l: l <> ''), chr(10))"


def unescape_basic(x: str) -> str:
    for ent, ch in BASIC_ENTITIES:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def _clean_chain(x: str) -> str:
    x = rr(x, r"<[^<>]*>", " ")
    x = rr(x, r"\[([^\[\]]*)\]\([^\(\)]*\)", r"\1")
    x = rr(x, r"\[[^\[\]]*\]", " ")
    x = rr(x, f"(?:^|{P.WS})[&#<>{{}}\\[\\]+|\\\\:-]+(?:{P.WS}|\\z)", " ")
    x = rr(x, f"(?:^|{P.WS})[\\-=\\+]{{2,}}(?:{P.WS}|\\z)", " ")
    return rr(x, f"{P.WS}+", " ")


def clean(x: str) -> str:
    return strip(_clean_chain(unescape_basic(x)))


def clean_nb(x: str) -> str:
    return strip(rr(_clean_chain(x), P.URL))


def find_urls(x: str) -> str:
    return f"regexp_extract_all({x}, {q(P.URL)}, 0)"


def tokenize(x: str) -> str:
    return f"regexp_extract_all({x}, {q(P.TOKEN)}, 0)"


def stop_list() -> str:
    return "[" + ", ".join(q(w) for w in chat_stopwords()) + "]"


def remove_stop(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: NOT list_contains({stop_list()}, lower(t)))"


def chat_tokens(x: str) -> str:
    return remove_stop(tokenize(clean_nb(strip_emojis(f"lower({x})"))))


def clean_tweets(x: str) -> str:
    for pat in (f"@{P.WORD}+", f"http{P.NOT_WS}+", f"://{P.NOT_WS}+", f"#{P.WORD}+", "##*"):
        x = rr(x, pat)
    return strip(x)


def remove_html(x: str) -> str:
    return rr(x, r"<[^\n]*?>")


def remove_email(x: str) -> str:
    return rr(x, f"[{P.WORD_CHARS}.<>]*{P.WORD}+@{P.WORD}+[{P.WORD_CHARS}.<>]*", " ")


def remove_emojis_wide(x: str) -> str:
    return rr(x, P.WIDE_EMOJI)


def summary_clean(x: str) -> str:
    return clean_tweets(remove_html(remove_email(remove_emojis_wide(x))))


def split_sentences(x: str) -> str:
    parts = f"list_transform(regexp_extract_all({x}, {q(P.SENTENCE)}, 0), lambda s: {strip('s')})"
    return f"list_filter({parts}, lambda s: s <> '')"


def collapse_ws(x: str) -> str:
    return rr(strip(x), f"{P.WS}+", " ")


def to_ascii(x: str) -> str:
    return rr(x, r"[^\x00-\x7F]")


def sanitize_string(x: str) -> str:
    return rr(x, f"[^{P.WORD_CHARS}{P.WS_CHARS}]")


def strip_quotes(x: str) -> str:
    return f"replace(replace(replace({x}, chr(10), ' '), '''', ''), '\"', '')"


def bounded_text(x: str, limit: int = 2499, keep: int = 2400) -> str:
    cut = f"CASE WHEN length({x}) > {limit} THEN substr({x}, 1, {keep}) ELSE {x} END"
    return strip(f"replace(replace({cut}, chr(10), '-'), '\"', '')")


def get_title(x: str) -> str:
    return strip(f"replace(split_part({x}, chr(10), 1), '#', '')")


def is_question(x: str) -> str:
    """F4 over the sentences of ``x``; false for a NULL text."""
    from ..operators import filters as FL
    has = lambda t, words: f"coalesce({t} IN ({', '.join(q(w) for w in words)}), false)"
    toks = f"regexp_extract_all(lower(s), {q(f'{P.WORD}+|[^{P.WORD_CHARS}{P.WS_CHARS}]')})"
    rule = (f"(len(t) > 1 AND ends_with(s, '?')) "
            f"OR (len(t) > 2 AND {has('t[1]', FL.WH_WORDS)} AND ({has('t[2]', FL.AUXILIARIES)} "
            f"OR (len(t) > 3 AND {has('t[2]', FL.APOSTROPHES)} AND {has('t[3]', FL.CONTRACTED)}))) "
            f"OR (len(t) > 2 AND {has('t[1]', FL.AUXILIARIES)} AND {has('t[2]', FL.SUBJECT_WORDS)}) "
            f"OR ({has('t[1]', FL.NEGATED)} AND {has('t[2]', FL.APOSTROPHES)} AND coalesce(t[3] = 't', false) "
            f"AND {has('t[4]', FL.SUBJECT_WORDS)})")
    pairs = f"list_transform({split_sentences(x)}, lambda s: {{'s': s, 't': {toks}}})"
    rule = rule.replace("t[", "p.t[").replace("len(t)", "len(p.t)").replace("(s, '?')", "(p.s, '?')")
    return f"coalesce(len(list_filter({pairs}, lambda p: {rule})) > 0, false)"
