"""Chat formatting with typed content parts, in DataFrame functions only.

A message's content is an array of parts (type, text, ref, tokens). A visitor
turns every part into a piece of text: a text part into itself with control
strings escaped, an image, audio or document part into an ordered placeholder
repeated for its expanded tokens, whose reference is recorded. The pieces of
a message, then the messages of a conversation, are concatenated in order.

Template of one turn::

    <|im_start|>ROLE
    <|content|>
    TEXT
    <|im_end|>

The formatted text is read back by splitting at the marks. A control string
inside a role or a text gets one backslash before it (and before backslashes
that already stand there), which reading back removes; marks never follow a
backslash, because a line break stands before each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of common chat templates, and the template's own.
CONTROL = ["<|im_start|>", "<|content|>", "<|im_end|>", "<|endoftext|>", "<|image|>", "<|audio|>", "<|document|>",
           "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_ANY = "(" + "|".join("".join("\\" + ch if ch in "|[]/<>" else ch for ch in c) for c in CONTROL) + ")"

PART = "struct<type:string,text:string,ref:string,tokens:int>"
#: Turns put together at once; conversations are built from such runs.
RUN = 64


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\*)" + _ANY, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\*)" + _ANY, "$1$2")


def visit(part: Column) -> Column:
    """One part as text: a placeholder for each expanded token of an
    attachment (one at least), the escaped text of any other part."""
    mark = F.concat(F.lit("<|"), part["type"], F.lit("|>"))
    times = F.greatest(F.coalesce(part["tokens"], F.lit(1)), F.lit(1))
    return F.when(part["type"].isin("image", "audio", "document"), F.repeat(mark, times)) \
        .otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def flatten(messages: DataFrame, parts: str = "parts") -> DataFrame:
    """``messages`` with ``body`` (its parts as text, in order), ``refs`` (its
    attachments in order: type, ref, tokens) and ``attachment_tokens``. Null or
    empty parts give an empty body."""
    p = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    held = F.filter(p, lambda x: x["type"].isin("image", "audio", "document"))
    refs = F.transform(held, lambda x: F.struct(
        x["type"].alias("type"), x["ref"].alias("ref"),
        F.greatest(F.coalesce(x["tokens"], F.lit(1)), F.lit(1)).alias("tokens")))
    return (messages.withColumn("body", F.array_join(F.transform(p, visit), ""))
            .withColumn("refs", refs)
            .withColumn("attachment_tokens", F.aggregate(F.col("refs"), F.lit(0), lambda a, x: a + x["tokens"])))


def text_part(text: Column) -> Column:
    """A plain text as content: one text part (a null text: an empty one)."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens")))


def render(messages: DataFrame, train_role: str = "assistant") -> DataFrame:
    """One row per conversation of ``messages`` (conv_id, turn, role, parts):
    conv_id, n_turns, formatted, loss_spans (start and length, in code points,
    of every ``train_role`` body in ``formatted``), refs, attachment_tokens.

    Order: turn, then role, then body; repeated rows are repeated turns. Null
    roles count as "", null turns come first, null conv_ids are one
    conversation. The turns are put together in runs of 64 before the runs of
    a conversation meet, so a long conversation is pre-aggregated over many
    tasks. An empty table gives no rows."""
    role = F.coalesce(F.col("role"), F.lit(""))
    start = F.concat(F.lit("<|im_start|>"), escape(role), F.lit("\n<|content|>\n"))
    m = flatten(messages).select(
        "conv_id", "turn", F.floor(F.col("turn") / RUN).alias("run"), role.alias("role"),
        "body", "refs", "attachment_tokens", F.length(start).alias("lead"),
        F.concat(start, F.col("body"), F.lit("\n<|im_end|>\n")).alias("piece"))
    rows = F.array_sort(F.collect_list(F.struct(
        "turn", "role", "body", "piece", "lead", "refs")))
    runs = m.groupBy("conv_id", "run").agg(rows.alias("r"), F.sum("attachment_tokens").alias("t")).select(
        "conv_id", "run", "t",
        F.size("r").cast("long").alias("n"),
        F.array_join(F.transform("r", lambda x: x["piece"]), "").alias("text"),
        F.flatten(F.transform("r", lambda x: x["refs"])).alias("refs"),
        F.transform("r", lambda x: F.struct(
            F.length(x["piece"]).alias("all"), x["lead"].alias("lead"),
            F.when(x["role"] == train_role, F.length(x["body"])).alias("loss"))).alias("pieces"))
    whole = runs.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("run", "text", "pieces", "refs"))).alias("r"),
        F.sum("n").alias("n_turns"), F.sum("t").alias("attachment_tokens"))
    pieces = F.flatten(F.transform("r", lambda x: x["pieces"]))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    walk = F.aggregate(pieces, empty, lambda a, x: F.struct(
        (a["at"] + x["all"]).alias("at"),
        F.when(x["loss"].isNull(), a["spans"]).otherwise(F.concat(a["spans"], F.array(F.struct(
            (a["at"] + x["lead"]).alias("start"), x["loss"].alias("length"))))).alias("spans")))
    return whole.select(
        "conv_id", "n_turns",
        F.array_join(F.transform("r", lambda x: x["text"]), "").alias("formatted"),
        walk["spans"].alias("loss_spans"),
        F.flatten(F.transform("r", lambda x: x["refs"])).alias("refs"), "attachment_tokens")


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation, unescaped."""
    turns = F.filter(F.split(formatted, r"(?<!\\)<\|im_start\|>"), lambda t: t != "")

    def turn(t):
        fields = F.split(t, r"\n(?<!\\)<\|content\|>\n", 2)
        body = F.regexp_replace(fields[1], r"\n<\|im_end\|>\n$", "")
        return F.struct(unescape(fields[0]).alias("role"), unescape(body).alias("text"))
    return F.transform(turns, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, nothing between the spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, s["start"] + 1, s["length"]))), "")
