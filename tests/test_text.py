"""Scalar text functions on hand-written value lists."""

import itertools
import re
import time

from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import filters as FL


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_clean_chain(spark):
    c = lambda v: one(spark, T.clean(F.col("s"), exact_unescape=False), v)
    assert c("&amp; x") == "x"          # a standalone "&" is a special run
    assert c("<b>t</b>") == "t"
    assert c("see [text](https://u) now") == "see text now"
    assert c("a [0] b") == "a b"
    assert c("a --- b") == "a b"
    assert c("keep #cool tag") == "keep #cool tag"
    assert c("a  b\t\tc") == "a b c"


def test_clean_nb_removes_urls(spark):
    assert one(spark, T.clean_nb(F.col("s")), "go to https://x.y/z now") == "go to  now"  # URLs go after the collapse


def test_html_unescape_exact(spark):
    assert one(spark, T.html_unescape(F.col("s")), "&copy; &#233; &amp;lt;") == "© é &lt;"


def test_emoji_and_emoticons(spark):
    v = "hi \U0001F600 \U0001F1FA\U0001F1F8 ✂ <a:wave:123> :smile: x"
    assert one(spark, T.strip_emoticons(T.strip_emojis(F.col("s"))), v) == "hi" + " " * 6 + "x"


def test_replace_empty_and_clean_content(spark):
    assert one(spark, T.replace_empty_strings(F.col("s")), "  \t") is None
    assert one(spark, T.replace_empty_strings(F.col("s"), whitespace_only=False), " ") == " "
    assert one(spark, T.clean_content(F.col("s")), "  a \n\n \t\n b  ") == "a\nb"


def test_tokenize_and_stop_words(spark):
    toks = one(spark, T.chat_tokens(F.col("s")), "GM friends, the well-known 2nd x2 test_case 123 against lol")
    assert toks == ["friends", "well-known", "2nd", "x2", "test_case", "against"]


def test_sentences_and_questions(spark):
    assert one(spark, T.split_sentences(F.col("s")), "Is it ok? Yes. Fine!") == ["Is it ok?", "Yes.", "Fine!"]
    assert one(spark, T.questions_in(F.col("s")), "Is it ok? Yes.") == ["Is it ok?"]


def test_question_regex(spark):
    expected = {"?": False, "what?": False, "is it ok?": True, "https://x.y/z?a=1": False,
                "see https://x.y?a": True, "no": False, "a?\n": True}
    rows = spark.createDataFrame([(k,) for k in expected], "s string")
    got = {r["s"]: r["q"] for r in rows.select("s", FL.question_regex("s").alias("q")).collect()}
    assert got == expected


def test_question_rule(spark):
    expected = {"Is it ok? Yes.": True, "what is this": True, "why not": False,
                "do you agree": True, "thanks": False, "?": False}
    rows = spark.createDataFrame([(k,) for k in expected], "s string")
    got = {r["s"]: r["q"] for r in rows.select("s", FL.is_question("s").alias("q")).collect()}
    assert got == expected


def test_small_helpers(spark):
    assert one(spark, T.collapse_ws(F.col("s")), "  a \n b  ") == "a b"
    assert one(spark, T.to_ascii(F.col("s")), "café ok") == "caf ok"
    assert one(spark, T.strip_quotes(F.col("s")), "it's \"x\"\ny") == "its x y"
    assert one(spark, T.get_title(F.col("s")), "## Title here \nbody") == "Title here"
    assert one(spark, T.sanitize_string(F.col("s")), "na-me!_1 é") == "name_1 é"
    assert one(spark, T.extract_mention(F.col("s")), "<@123> hi <@456>") == "123"
    assert one(spark, T.extract_mention(F.col("s")), "<@!123> hi") is None
    assert one(spark, T.remove_html(F.col("s")), "a<b>c</b>d") == "acd"
    assert one(spark, T.remove_email(F.col("s")), "mail me: bob.x@mail.com now") == "mail me:   now"
    long = "x" * 2500
    assert one(spark, T.bounded_text(F.col("s")), long) == "x" * 2400
    assert one(spark, T.bounded_text(F.col("s")), "a\n\"b\" ") == "a-b"
    assert one(spark, FL.concat_id_content(F.col("s"), F.lit(None).cast("string")), "7") == "7: "


def test_clean_is_idempotent(spark):
    rows = spark.createDataFrame([("a  b\n\nc",), ("  x --- y ",), ("[z](q) w",)], "s string")
    once = rows.select(T.clean_nb(F.col("s")).alias("s"))
    twice = once.select(T.clean_nb(F.col("s")).alias("s"))
    assert sorted(r["s"] for r in once.collect()) == sorted(r["s"] for r in twice.collect())


def test_remove_email_equals_the_plain_pattern_in_linear_time(spark):
    word = r"[^\W]"
    plain = re.compile(rf"[\w.<>]*{word}+@{word}+[\w.<>]*")
    texts = ["a@b@c", "x.@y z@w.<>", "<bob.x@mail.com> now", "@a b@ c@d", "a.b.c@d..e@f g", "é@ü.1", "a@@b", "..a@b"]
    texts += ["".join(t) for t in itertools.product("a.@ ", repeat=5)]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select("s", T.remove_email(F.col("s")).alias("r")).collect()
    assert all(r["r"] == plain.sub(" ", r["s"]) for r in got)
    began = time.monotonic()
    for piece in ("x", ".", "x.", "@", "x@", "<"):
        one(spark, T.remove_email(F.col("s")), piece * (1_000_000 // len(piece)))
    assert time.monotonic() - began < 60
