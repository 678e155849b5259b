"""DuckDB spellings of ``functions.extract`` for oracle SQL only."""

from __future__ import annotations

from . import patterns as P
from .extract import (CURRENCY_MARKERS, HUNDRED, KEYWORD_LEAD_INS, LARGE, NUMBER_RUN, NUMBER_WORDS, TEAM_LEAD_INS,
                      TYPE_REPLY_TAIL, usd_patterns)
from .sql_text import q, strip

D = P.DIGIT


def first_match(x: str, pats: list[str]) -> str:
    parts = ", ".join(f"nullif(regexp_extract({x}, {q(p)}, 0), '')" for p in pats)
    return f"coalesce({parts}, '')"


def get_usd(x: str, compat: bool = False) -> str:
    dollar, words = usd_patterns(compat)
    return first_match(x, dollar + words)


def get_eth(x: str) -> str:
    a = f"array_to_string(regexp_extract_all({x}, {q(f'{D}+.{D}+ *{P.WORD}*ETH')}, 0), ' and ')"
    b = f"array_to_string(regexp_extract_all({x}, {q(f'{D}+ *{P.WORD}*ETH')}, 0), ' and ')"
    return f"(CASE WHEN {a} <> '' THEN {a} ELSE {b} END)"


def get_money(x: str) -> str:
    usd, eth = get_usd(x), get_eth(x)
    words = f"regexp_split_to_array({strip(x)}, {q(P.WS + '+')})"
    both = (f"{usd} <> '' AND {eth} <> '' AND NOT list_contains({words}, 'or') "
            f"AND NOT list_contains({words}, '||') AND NOT contains({x}, '(')")
    return (f"(CASE WHEN {both} THEN {usd} || ' and ' || {eth} WHEN {usd} <> '' THEN {usd} "
            f"WHEN {eth} <> '' THEN {eth} ELSE {x} END)")


def to_number(x: str) -> str:
    for m in CURRENCY_MARKERS:
        x = f"replace({x}, {q(m)}, '')"
    x = strip(f"string_split({x}, '-')[-1]")
    k = f"regexp_extract({x}, '^([0-9]*\\.?[0-9]+)[kK]$', 1)"
    plain = f"replace(replace({x}, 'k', '000'), 'K', '000')"
    return f"(CASE WHEN {k} <> '' THEN TRY_CAST({k} AS DOUBLE) * 1000 ELSE TRY_CAST({plain} AS DOUBLE) END)"


def _tidy(v: str) -> str:
    return f"regexp_replace(regexp_replace({v}, '(\\.[0-9]*[1-9])0+$', '\\1'), '\\.0+$', '.0')"


def render_number(x: str) -> str:
    return _tidy(f"CAST(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)) AS VARCHAR)")


def render_decimal(x: str, scale: int) -> str:
    return _tidy(f"CAST(CAST(round({x}, {scale}) AS DECIMAL(38,{scale})) AS VARCHAR)")


def wei_to_eth(v: str, scale: int = 5) -> str:
    padded = f"(CASE WHEN length({v}) < 19 THEN lpad({v}, 19, '0') ELSE {v} END)"
    dec = f"TRY_CAST(left({padded}, length({padded}) - 18) || '.' || right({padded}, 18) AS DECIMAL(38,18))"
    txt = f"(CASE WHEN length({v}) >= 18 THEN {render_decimal(dec, scale)} ELSE {render_decimal(dec, 18)} END)"
    return f"(CASE WHEN {dec} IS NOT NULL THEN {txt} || ' ETH' END)"


def word_number(run: str) -> str:
    values = "MAP {" + ", ".join(f"{q(w)}: {i}" for w, i in NUMBER_WORDS.items()) + "}"
    large = "MAP {" + ", ".join(f"{q(w)}: {i}" for w, i in LARGE.items()) + "}"
    word = (f"{{'total': 0::BIGINT, 'part': coalesce({values}[w], 0)::BIGINT, 'h': w = {q(HUNDRED)}, "
            f"'m': coalesce({large}[w], 0)::BIGINT}}")
    zero = "{'total': 0::BIGINT, 'part': 0::BIGINT, 'h': false, 'm': 0::BIGINT}"
    step = ("{'total': CASE WHEN x.m > 0 THEN a.total + greatest(a.part, 1) * x.m ELSE a.total END, "
            "'part': CASE WHEN x.m > 0 THEN 0 WHEN x.h THEN greatest(a.part, 1) * 100 ELSE a.part + x.part END, "
            "'h': false, 'm': 0::BIGINT}")
    done = (f"list_reduce(list_prepend({zero}, list_transform(regexp_split_to_array({run}, '[ -]'), "
            f"lambda w: {word})), lambda a, x: {step})")
    return f"(CASE WHEN {run} <> '' THEN ({done}).total + ({done}).part END)"


def duration_months(x: str) -> str:
    months = f"regexp_extract_all({x}, {q(f'({D}+)[ -]month')}, 1)"
    days = f"regexp_extract({x}, {q(f'({D}+) day')}, 1)"
    weeks = f"regexp_extract({x}, {q(f'({D}+)[ -]week')}, 1)"
    wm = word_number(f"regexp_extract(lower({x}), {q(chr(92) + 'b(' + NUMBER_RUN + ')[ -]months?' + chr(92) + 'b')}, 1)")
    ww = word_number(f"regexp_extract(lower({x}), {q(chr(92) + 'b(' + NUMBER_RUN + ')[ -]weeks?' + chr(92) + 'b')}, 1)")
    n = (f"(CASE WHEN len({months}) > 0 THEN list_max(list_transform({months}, lambda m: TRY_CAST(m AS INTEGER))) "
         f"WHEN {days} <> '' THEN CAST(floor(TRY_CAST({days} AS INTEGER) / 30) AS BIGINT) "
         f"WHEN {weeks} <> '' THEN CAST(floor(TRY_CAST({weeks} AS INTEGER) / 4) AS BIGINT) "
         f"WHEN {wm} IS NOT NULL THEN {wm} WHEN {ww} IS NOT NULL THEN CAST(floor({ww} / 4) AS BIGINT) END)")
    return f"(CASE WHEN {n} IS NOT NULL THEN CAST({n} AS VARCHAR) || ' months' ELSE '' END)"


def proposal_refs(x: str) -> str:
    hits = f"regexp_extract_all(lower({x}), {q(f'prop* {D}+')}, 0)"
    return f"list_transform({hits}, lambda h: TRY_CAST(regexp_extract(h, {q(f'({D}+)')}, 1) AS BIGINT))"


def team_size(x: str) -> str:
    nums = f"regexp_extract_all({x}, {q(f'({D}+) ')}, 1)"
    w = word_number(f"regexp_extract(lower({x}), {q(chr(92) + 'b(' + NUMBER_RUN + ')' + chr(92) + 'b')}, 1)")
    return (f"(CASE WHEN len({nums}) > 0 THEN list_max(list_transform({nums}, lambda m: TRY_CAST(m AS INTEGER))) "
            f"ELSE {w} END)")


def team_name(x: str) -> str:
    x = f"replace(replace(replace({x}, '\"', ''), '''', ''), '.', '')"
    for lead in TEAM_LEAD_INS:
        x = strip(f"replace({x}, {q(lead)}, '')")
    return x


def capitalize(x: str) -> str:
    return f"(upper(left({x}, 1)) || lower(substr({x}, 2)))"


def type_reply(x: str) -> str:
    x = f"replace({x}, chr(10), ' ')"
    for lead in TYPE_REPLY_TAIL:
        x = f"replace({x}, {q(lead)}, '')"
    return strip(f"replace(replace({strip(x)}, ':', ''), '-', ',')")


def keywords(x: str) -> str:
    for lead in KEYWORD_LEAD_INS:
        x = f"replace({x}, {q(lead)}, '')"
    parts = f"list_transform(string_split({strip(x)}, ','), lambda p: {capitalize(strip('p'))})"
    return f"list_filter({parts}, lambda p: length(p) > 1)"


def epoch_to_date(x: str) -> str:
    return (f"CAST(DATE '1970-01-01' + CAST(floor(TRY_CAST({x} AS BIGINT) / 86400) AS INTEGER) AS VARCHAR)")


def title_relation(x: str) -> str:
    t = f"array_to_string(list_transform(string_split({x}, ' '), lambda w: {capitalize('w')}), ' ')"
    return f"(CASE WHEN {t} = 'Executioneta' THEN 'ExecutionETA' ELSE {t} END)"


def calldata_amount(x: str) -> str:
    dec = f"CAST(CAST('0x' || right({x}, 16) AS UBIGINT) AS VARCHAR)"
    return f"(CASE WHEN length({dec}) > 6 THEN TRY_CAST(left({dec}, length({dec}) - 6) AS BIGINT) END)"


def action_type(sig: str) -> str:
    t = f"split_part({sig}, '(', 1)"
    return f"(CASE WHEN {sig} IS NULL OR {t} = '' THEN 'Transfer' ELSE {t} END)"


def summary_tail(s: str, src: str) -> str:
    out = (f"(CASE WHEN suffix({s}, '.') THEN {s} WHEN contains({s}, '. ') "
           f"THEN regexp_extract({s}, '(?s)^(.*)\\.', 1) || '.' ELSE {src} END)")
    return f"replace(replace(replace({out}, chr(10), ' '), '''', ''), '\"', '')"


def deadline_months(o: str) -> str:
    return f"(CASE WHEN contains({o}, 'month') THEN regexp_extract({o}, {q(f'({D}+)')}, 1) ELSE {o} END)"


def strip_num(c: str, unit: str) -> str:
    inner = f"replace({c}, {q(unit)}, '')"
    return f"TRY_CAST({strip(inner)} AS DOUBLE)"
