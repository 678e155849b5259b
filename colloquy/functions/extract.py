"""Value extraction from free text: money, durations, references, hex
amounts, vote classes, dates and ids (X21-X30, X35-X42, X50-X56).

All native Column expressions. Where the original relied on a language
model plus a parser, the parser part is here and takes the model's reply
(or any text) as input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P
from .text import strip

D = P.DIGIT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _first(s: Column, pats: list[str]) -> Column:
    """First match of the first pattern that matches anywhere ('' if none)."""
    outs = [F.nullif(F.regexp_extract(s, p, 0), F.lit("")) for p in pats]
    return F.coalesce(*outs, F.lit(""))


def usd_patterns(compat: bool = False) -> tuple[list[str], list[str]]:
    """The dollar-sign patterns, then the USD / USDC patterns,
    in the order they are tried. ``compat`` keeps the single thousands group
    of the original (``$1,050,000`` -> ``$1,050``)."""
    grp = f"{D}+,{D}+" if compat else f"{D}+(?:,{D}+)+"
    dollar = [f"\\${grp}", f"\\${D}+k", f"\\${D}+K", f"\\${D}+.{D}+k", f"\\${D}+.{D}+K"]
    words = []
    for cur in ("USD", "USDC"):
        words += [f"{D}+,{D}+ *{cur}", f"{cur} *{D}+,{D}+",
                  f"{D}+.{D}+ *{cur}", f"{cur} *{D}+.{D}+",
                  f"{D}+.{D}+k *{cur}", f"{cur} *{D}+.{D}+k",
                  f"{D}+.{D}+K *{cur}", f"{cur} *{D}+.{D}+K",
                  f"{D}+k *{cur}", f"{D}+K *{cur}",
                  f"{cur} *{D}+k", f"{cur} *{D}+K"]
    return dollar, words


def get_usd(s, compat: bool = False) -> Column:
    """First USD amount in pattern order ('' if none). The patterns run
    only on texts that hold the sign, or the currency's name."""
    s = _c(s)
    dollar, words = usd_patterns(compat)
    found = F.when(s.contains("$"), F.nullif(_first(s, dollar), F.lit("")))
    return F.coalesce(found, F.when(s.contains("USD"), _first(s, words)), F.lit(""))


def get_eth(s) -> Column:
    """Every ``d.d *\\w*ETH`` joined by ' and ', else every ``d *\\w*ETH``."""
    s = _c(s)
    a = F.array_join(F.regexp_extract_all(s, F.lit(f"{D}+.{D}+ *{P.WORD}*ETH"), 0), " and ")
    b = F.array_join(F.regexp_extract_all(s, F.lit(f"{D}+ *{P.WORD}*ETH"), 0), " and ")
    return F.when(s.contains("ETH"), F.coalesce(F.nullif(a, F.lit("")), b)).when(s.isNotNull(), F.lit(""))


def with_money(df: DataFrame, text: str, usd: str = "usd", eth: str = "eth", money: str = "money",
               compat: bool = False) -> DataFrame:
    """X21 + X22 + X23 as columns, each amount parsed once for a row (a single
    expression for X23 repeats both parsers in each of its branches)."""
    found = df.withColumns({usd: get_usd(text, compat), eth: get_eth(text)})
    return found.withColumn(money, _chosen_money(_c(text), _c(usd), _c(eth)))


def get_money(s, compat: bool = False) -> Column:
    """X23: 'usd and eth' when both exist and the text has no word 'or', no
    word '||' and no '('; else usd, else eth, else the input."""
    s = _c(s)
    return _chosen_money(s, get_usd(s, compat), get_eth(s))


def _chosen_money(s: Column, usd: Column, eth: Column) -> Column:
    words = F.split(strip(s), f"{P.WS_J}+")
    both = ((usd != "") & (eth != "") & ~F.array_contains(words, "or")
            & ~F.array_contains(words, "||") & ~s.contains("("))
    return (F.when(both, F.concat(usd, F.lit(" and "), eth))
             .when(usd != "", usd).when(eth != "", eth).otherwise(s))


# Currency markers removed before parsing a number, in order.
CURRENCY_MARKERS = ["USDC", "USD", "$", "StETH", "stETH", "ETH", ","]


def to_number(s) -> Column:
    """Strip currency markers and commas, keep the text after the last
    '-', expand k/K thousands (``1.05k`` -> 1050, computed arithmetically),
    parse as DOUBLE; NULL when it does not parse."""
    x = _c(s)
    for m in CURRENCY_MARKERS:
        x = F.replace(x, F.lit(m), F.lit(""))
    x = strip(F.substring_index(x, "-", -1))
    k = F.regexp_extract(x, r"^([0-9]*\.?[0-9]+)[kK]$", 1)
    plain = F.replace(F.replace(x, F.lit("k"), F.lit("000")), F.lit("K"), F.lit("000"))
    return F.when(k != "", k.try_cast("double") * 1000).otherwise(plain.try_cast("double"))


def render_number(x) -> Column:
    """Canonical text of a number: the shortest round-trip digits of the
    DOUBLE in plain notation, at least one decimal (``459703.0``, ``0.1``,
    ``0.000000000000012345``). Not a number and infinite values give NULL."""
    v = _c(x).cast("double")
    s = v.cast("string")
    d = s.try_cast("decimal(38,18)").cast("string")
    d = F.regexp_replace(d, r"(\.[0-9]*[1-9])0+$", "$1")
    d = F.regexp_replace(d, r"\.0+$", ".0")
    # beyond DECIMAL(38,18): the digits of the scientific form, moved by its exponent
    sign, digits = F.regexp_extract(s, r"^(-?)", 1), F.regexp_replace(F.regexp_replace(s, r"E.*$", ""), r"[^0-9]", "")
    digits = F.regexp_replace(digits, r"(.)0+$", "$1")
    power = F.regexp_extract(s, r"E(-?[0-9]+)$", 1).try_cast("int")
    large = F.concat(sign, F.rpad(digits, F.greatest(power + 1, F.length(digits)), F.lit("0")), F.lit(".0"))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), F.greatest(-power - 1, F.lit(0))), digits)
    # most numbers need no pattern: plain notation as it is, whole numbers by their integer
    size = F.abs(v)
    return (F.when((size >= 1) & (size < 1e7), s)
             .when((size >= 1e7) & (size < 1e15) & (v == F.floor(v)), F.concat(v.cast("bigint").cast("string"), F.lit(".0")))
             .when(F.isnan(v) | s.contains("Inf"), F.lit(None).cast("string"))
             .when(power >= 20, large).when(power < -18, small).otherwise(d))


def render_decimal(x: Column, scale: int = 5) -> Column:
    """Same layout for an exact DECIMAL input (no DOUBLE round trip)."""
    d = F.round(x, scale).cast(f"decimal(38,{scale})").cast("string")
    if scale < 1:
        return d
    d = F.rtrim(d, F.lit("0"))
    return F.concat(d, F.when(d.endswith("."), F.lit("0")).otherwise(F.lit("")))


def wei_to_eth(value, scale: int = 5) -> Column:
    """18-decimal integer text -> 'N ETH'. Exact DECIMAL arithmetic,
    half-up at ``scale`` places when the text has 18+ digits, as in the
    original; shorter values are shown at 18 places (plain notation). Beyond
    38 digits the text itself is split and rounded, so no amount is lost."""
    v = _c(value)
    padded = F.when(F.length(v) < 19, F.lpad(v, 19, "0")).otherwise(v)
    txt_dec = F.concat(F.left(padded, F.length(padded) - 18), F.lit("."), F.right(padded, F.lit(18)))
    amount = txt_dec.try_cast("decimal(38,18)")
    txt = F.when(F.length(v) >= 18, render_decimal(amount, scale)).otherwise(render_decimal(amount, 18))
    long = (F.length(v) >= 39) & v.rlike("^[0-9]{39,}$")
    txt = F.when(long, _long_wei(v, scale)).when(amount.isNotNull(), txt)
    if 1 <= scale <= 17:  # plain digits: no decimals needed
        txt = F.when(v.rlike(f"^[0-9]{{1,{36 - scale}}}$"), _plain_wei(v, scale)).otherwise(txt)
    return F.concat(txt, F.lit(" ETH"))


def _plain_wei(v: Column, scale: int) -> Column:
    """``wei_to_eth`` of at most 36 - ``scale`` digits, by whole numbers."""
    def shown(whole, digits):
        frac = F.rtrim(digits, F.lit("0"))
        return F.concat(whole, F.lit("."), F.when(frac == "", F.lit("0")).otherwise(frac))

    kept = F.left(v, F.length(v) - 18 + scale).try_cast("bigint")
    n = kept + (F.substring(v, -18 + scale, 1) >= "5").cast("bigint")
    # the decimal places cut off as text, not by a division: exact
    split = F.lpad(n.cast("string"), F.greatest(F.length(n.cast("string")), F.lit(scale + 1)), F.lit("0"))
    large = shown(F.left(split, F.length(split) - scale), F.right(split, F.lit(scale)))
    return F.when(F.length(v) < 18, shown(F.lit("0"), F.lpad(v, 18, "0"))).otherwise(large)


def _long_wei(v: Column, scale: int) -> Column:
    """Digits of any length over 10**18, rounded half-up at ``scale`` places."""
    kept = F.left(v, F.length(v) - 18 + scale)
    up = F.substring(v, -18 + scale, 1) >= "5"
    nines = F.length(F.regexp_extract(kept, "(9*)$", 1))
    head = F.left(kept, F.length(kept) - nines)
    more = F.concat(F.left(head, F.length(head) - 1), (F.right(head, F.lit(1)).try_cast("int") + 1).cast("string"))
    raised = F.concat(F.when(head == "", F.lit("1")).otherwise(more), F.repeat(F.lit("0"), nines))
    digits = F.when(up, raised).otherwise(kept)
    whole = F.regexp_replace(F.left(digits, F.length(digits) - scale), "^0+(?=.)", "")
    d = F.concat(whole, F.lit("."), F.right(digits, F.lit(scale)))
    return F.regexp_replace(F.regexp_replace(d, r"(\.[0-9]*[1-9])0+$", "$1"), r"\.0+$", ".0")


# The words that number words are made of.
SMALL_NUMBERS = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven",
                 "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen"]
TENS = ["twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety"]

HUNDRED, LARGE = "hundred", {"thousand": 1_000, "million": 1_000_000}

#: The value of every word that is added.
NUMBER_WORDS = {w: i for i, w in enumerate(SMALL_NUMBERS)} | {t: 20 + 10 * k for k, t in enumerate(TENS)}
_ONE = "(?:" + "|".join(sorted([*NUMBER_WORDS, HUNDRED, *LARGE], key=len, reverse=True)) + ")"
#: A run of number words, joined by a space or a hyphen, "and" between them.
NUMBER_RUN = rf"{_ONE}(?:[ -](?:and )?{_ONE}\b)*"


def _word_number(run: Column) -> Column:
    """The number that a lower-case run of number words names, NULL for ''. A
    fold over its words: "hundred" multiplies what stands before it, a larger
    word closes a group, every other word is added."""
    values = F.create_map(*[x for w, i in NUMBER_WORDS.items() for x in (F.lit(w), F.lit(i).cast("bigint"))])
    large = F.create_map(*[x for w, i in LARGE.items() for x in (F.lit(w), F.lit(i).cast("bigint"))])
    zero = F.lit(0).cast("bigint")

    def step(a, w):
        group = F.greatest(a["group"], F.lit(1).cast("bigint"))
        return F.struct(
            F.when(large[w].isNotNull(), a["total"] + group * large[w]).otherwise(a["total"]).alias("total"),
            F.when(large[w].isNotNull(), zero).when(w == HUNDRED, group * 100)
             .otherwise(a["group"] + F.coalesce(values[w], zero)).alias("group"))

    done = F.aggregate(F.split(run, "[ -]"), F.struct(zero.alias("total"), zero.alias("group")), step)
    return F.when(run != "", done["total"] + done["group"])


def duration_months(s) -> Column:
    """X26: 'N month(s)'/'N-month' -> max N; else first 'N day' div 30; else
    first 'N week'/'N-week' div 4; else '<number words> month' or
    '<number words> week' div 4; else ''. Result 'N months'; a number beyond
    INT gives ''."""
    s = _c(s)
    months = F.regexp_extract_all(s, F.lit(f"({D}+)[ -]month"), 1)
    days = F.regexp_extract(s, f"({D}+) day", 1)
    weeks = F.regexp_extract(s, f"({D}+)[ -]week", 1)
    wm = F.regexp_extract(F.lower(s), rf"\b({NUMBER_RUN})[ -]months?\b", 1)
    ww = F.regexp_extract(F.lower(s), rf"\b({NUMBER_RUN})[ -]weeks?\b", 1)
    maxm = F.array_max(F.transform(months, lambda x: x.try_cast("int")))
    n = (F.when(F.size(months) > 0, maxm)
          .when(days != "", F.floor(days.try_cast("int") / 30))
          .when(weeks != "", F.floor(weeks.try_cast("int") / 4))
          .when(wm != "", _word_number(wm))
          .when(ww != "", F.floor(_word_number(ww) / 4)))
    return F.when(n.isNotNull(), F.concat(n.cast("string"), F.lit(" months"))).otherwise(F.lit(""))


def proposal_refs(s) -> Column:
    """Numbers of every ``prop* <n>`` in the lower-cased text."""
    hits = F.regexp_extract_all(F.lower(_c(s)), F.lit(f"prop* {D}+"), 0)
    return F.transform(hits, lambda h: F.regexp_extract(h, f"({D}+)", 1).try_cast("bigint"))


def team_size(s) -> Column:
    """Max of integers followed by a space, else the first number in words."""
    s = _c(s)
    nums = F.regexp_extract_all(s, F.lit(f"({D}+) "), 1)
    w = F.regexp_extract(F.lower(s), rf"\b({NUMBER_RUN})\b", 1)
    return F.when(F.size(nums) > 0, F.array_max(F.transform(nums, lambda x: x.try_cast("int")))) \
            .otherwise(_word_number(w))


# Lead-in phrases removed from team names, in order.
TEAM_LEAD_INS = ["The name of the team is", "The name of the proposer team is"]


def team_name(s) -> Column:
    """Drop quotes and dots, then the lead-in phrases, stripping after each."""
    x = F.translate(_c(s), "\"'.", "")
    for lead in TEAM_LEAD_INS:
        x = strip(F.replace(x, F.lit(lead), F.lit("")))
    return x


def capitalize(s) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    s = _c(s)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))


# Phrases removed from keyword replies, in order.
KEYWORD_LEAD_INS = ["Keywords in this proposal include", "-", '"', "I don't know."]


# What the tail of a type reply loses, in order.
TYPE_REPLY_TAIL = ["Keywords in this proposal: -", "Keywords in this proposal:", "Keywords", "Keyword"]


def type_reply(s) -> Column:
    """The type reply as it is kept (before X30): line breaks to spaces, the
    lead-ins and colons removed, hyphens to commas, stripped."""
    x = F.replace(_c(s), F.lit("\n"), F.lit(" "))
    for lead in TYPE_REPLY_TAIL:
        x = F.replace(x, F.lit(lead), F.lit(""))
    return strip(F.translate(strip(x), "-:", ","))


def keywords(s) -> Column:
    """Keyword reply -> array of capitalised keywords (split on ',',
    stripped, length > 1)."""
    x = _c(s)
    for lead in KEYWORD_LEAD_INS:
        x = F.replace(x, F.lit(lead), F.lit(""))
    parts = F.transform(F.split(strip(x), ","), lambda p: capitalize(strip(p)))
    return F.filter(parts, lambda p: F.length(p) > 1)


def format_log(ts, author, content, numbered: Column | None = None) -> Column:
    """``MM-dd-yyyy@HH:mm user: text`` with user = author before '#'.
    With ``numbered`` the notebook variant ``idx. M/d@H:mm author: text``."""
    if numbered is not None:
        return F.concat(numbered.cast("string"), F.lit(". "), F.date_format(_c(ts), "M/d@H:mm"),
                        F.lit(" "), _c(author), F.lit(": "), _c(content))
    return F.concat(F.date_format(_c(ts), "MM-dd-yyyy@HH:mm"), F.lit(" "),
                    F.substring_index(_c(author), "#", 1), F.lit(": "), _c(content))


def parse_log_time(s) -> Column:
    """``MM-dd-yyyy@HH:mm`` -> TIMESTAMP_NTZ (NULL if invalid)."""
    return F.try_to_timestamp(_c(s), F.lit("MM-dd-yyyy@HH:mm")).cast("timestamp_ntz")


def epoch_to_date(s) -> Column:
    """Epoch seconds -> UTC ``yyyy-MM-dd`` (time-zone independent); NULL
    for text that is no number and beyond the calendar (year 9909)."""
    days = F.floor(_c(s).try_cast("bigint") / 86400)
    dated = F.date_add(F.lit("1970-01-01").cast("date"), F.when(F.abs(days) < 2_900_000, days).cast("int"))
    return F.date_format(dated, "yyyy-MM-dd")


def title_relation(s) -> Column:
    """Title case a relation name; 'Executioneta' -> 'ExecutionETA'."""
    return from_title(F.initcap(_c(s)))


def from_title(t: Column) -> Column:
    """X38 for a name that is in title case already."""
    return F.when(t == "Executioneta", F.lit("ExecutionETA")).otherwise(t)


def calldata_amount(s) -> Column:
    """Last 16 hex digits -> unsigned integer -> drop the last 6 decimal
    digits. Fewer than 7 digits -> NULL."""
    dec = F.conv(F.substring(_c(s), -16, 16), 16, 10)
    return F.when(F.length(dec) > 6, F.left(dec, F.length(dec) - 6)).try_cast("bigint")


def action_type(signature) -> Column:
    """Signature text before '(' ('' or NULL -> 'Transfer')."""
    t = F.substring_index(_c(signature), "(", 1)
    return F.when(t.isNull() | (t == ""), F.lit("Transfer")).otherwise(t)


def bps_value(s) -> Column:
    """The first ``\\d+bps`` in the text ('' if none)."""
    return F.regexp_extract(_c(s), f"{D}+bps", 0)


def voter_id(s) -> Column:
    """Vote id before the first '-'."""
    return F.substring_index(_c(s), "-", 1)


# Vote relations.
SUPPORTED, OPPOSED, ABSTAINED = "Supported By", "Opposed By", "Abstained By"


def vote_relation(support, detailed) -> Column:
    """Support true -> Supported By; detailed 0 -> Opposed By;
    2 -> Abstained By; anything else -> NULL (rejected vote)."""
    return (F.when(_c(support) == F.lit(True), F.lit(SUPPORTED))
             .when(_c(detailed) == 0, F.lit(OPPOSED))
             .when(_c(detailed) == 2, F.lit(ABSTAINED)))


def vote_weight(votes) -> Column:
    """max(int(votes), 1); a missing count weighs 1."""
    return F.greatest(F.coalesce(_c(votes).try_cast("bigint"), F.lit(1)), F.lit(1))


def statement_time(date_text) -> Column:
    """``yyyy-MM-dd`` -> ``+yyyy-MM-ddT00:00:00Z``."""
    d = F.try_to_date(_c(date_text), "yyyy-MM-dd")
    return F.concat(F.lit("+"), F.date_format(d, "yyyy-MM-dd"), F.lit("T00:00:00Z"))


def summary_property(interval) -> Column:
    """month/week/day -> Monthly/Weekly/Daily Summary, else NULL (skip)."""
    i = _c(interval)
    return (F.when(i == "month", "Monthly Summary").when(i == "week", "Weekly Summary")
             .when(i == "day", "Daily Summary"))


def id_from_uri(uri) -> Column:
    """Last '/' segment of an entity URI."""
    return F.substring_index(_c(uri), "/", -1)


def item_id_in(text) -> Column:
    """The first ``Q<digits>`` id inside an error message."""
    v = F.regexp_extract(_c(text), r"(Q[0-9]+)", 1)
    return F.when(v != "", v)


def deadline_months(obj) -> Column:
    """X54 text arm: 'N months' -> the first number; other text unchanged."""
    o = _c(obj)
    return F.when(o.contains("month"), F.regexp_extract(o, f"({D}+)", 1)).otherwise(o)


def deadline_months_from_date(deadline, submitted) -> Column:
    """X54 date arm: months between submission and a DATE deadline,
    rounded (days / 30)."""
    return F.round(F.datediff(_c(deadline), _c(submitted)) / 30).cast("bigint")


def summary_tail(summary, source) -> Column:
    """Ends with '.' -> as is; contains '. ' -> up to the last '.';
    else the source text; then X31 (newlines -> space, quotes dropped)."""
    s = _c(summary)
    cut = F.regexp_extract(s, r"(?s)^(.*)\.", 1)
    out = (F.when(s.endswith("."), s).when(s.contains(". "), F.concat(cut, F.lit(".")))
            .otherwise(_c(source)))
    return F.translate(F.replace(out, F.lit("\n"), F.lit(" ")), "'\"", "")


def channel_label(server, channel) -> Column:
    """``server - channel``."""
    return F.concat_ws(" - ", _c(server), _c(channel))


def route_by_length(tokens, limit: int = 3846, small: str = "base-model",
                    large: str = "long-context-model") -> Column:
    """The larger-context model when the prompt has more than ``limit``
    tokens."""
    return F.when(_c(tokens) > limit, F.lit(large)).otherwise(F.lit(small))


QA_LOGS_SCHEMA = ("struct<thread_id:bigint,reply_ids:array<bigint>,conversation_ids:array<bigint>,"
                  "conversation_prompt:string>")


def qa_logs_json(thread_id, reply_ids, conversation_ids, prompt) -> Column:
    """The Q&A logs document; NULL fields are written (not dropped)."""
    s = F.struct(_c(thread_id).alias("thread_id"), _c(reply_ids).alias("reply_ids"),
                 _c(conversation_ids).alias("conversation_ids"), _c(prompt).alias("conversation_prompt"))
    return F.to_json(s, {"ignoreNullFields": "false"})


def read_qa_logs(js) -> Column:
    """Parse the logs document back (``logs.reply_ids`` etc.)."""
    return F.from_json(_c(js), QA_LOGS_SCHEMA)
