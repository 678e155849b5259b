"""Model-backed operators with a pluggable function.

``complete`` runs any ``fn(prompt) -> str`` inside the tasks
(``mapInArrow``, slices of Arrow batches), with bounded retries, so model calls are
spread over the cluster and never funnelled through the driver. Every
reply row carries ``status`` ('ok', 'too_long', 'error') and ``attempts``
instead of error text or exceptions. The stub models here are
deterministic so pipelines can be tested without a service.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut_lineage

ModelFn = Callable[[str], str]

#: Most bytes of prompts, and with them of replies, that a worker holds as Python strings.
PROMPT_BYTES = 1 << 20

_LOADED: dict[str, Any] = {}


@dataclass(frozen=True)
class Model:
    """A model that each Python worker loads once, however many tasks and
    batches it runs: ``load()`` gives the function to call. ``name`` tells
    models apart inside a worker."""
    name: str
    load: Callable[[], Callable]

    def get(self) -> Callable:
        if self.name not in _LOADED:
            _LOADED[self.name] = self.load()
        return _LOADED[self.name]


def function_of(fn: Callable | Model) -> Callable:
    """What to call, inside a task."""
    return fn.get() if isinstance(fn, Model) else fn


def retried(call: Callable[[], Any], retries: int, pause: float, most: float = 30.0) -> tuple[Any, int]:
    """(result, attempts): the call is tried up to ``retries`` times; after each
    failure but the last it waits ``pause`` seconds, doubled each time up to
    ``most``. The result of a call that always failed is None."""
    for n in range(1, retries + 1):
        try:
            return call(), n
        except Exception:  # noqa: BLE001 - a model may fail in any way
            if pause and n < retries:
                time.sleep(min(pause * 2 ** (n - 1), most))
    return None, retries


def echo_model(prompt: str) -> str:
    """Deterministic stand-in: the last non-empty line of the prompt, with
    'Pass.' prefixed when the prompt has an even number of words."""
    lines = [ln.strip() for ln in prompt.splitlines() if ln.strip()]
    last = lines[-1] if lines else ""
    return ("Pass. " if len(prompt.split()) % 2 == 0 else "") + last


def halving_model(prompt: str) -> str:
    """Deterministic stand-in summariser: keeps every other word."""
    return " ".join(prompt.split()[::2])


def prompt_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` (key, prompt) in slices of PROMPT_BYTES of prompts or one row, so
    that a worker holds a batch's texts as Python strings, with their replies, a few at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + PROMPT_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def complete(df: DataFrame, key_col: str, prompt_col: str, fn: ModelFn | Model = echo_model,
             retries: int = 5, max_prompt_chars: int | None = None, pause: float = 0.0) -> DataFrame:
    """M7: (key, text, status, attempts). Too-long prompts are not sent;
    failures after ``retries`` attempts give NULL text and status 'error';
    replies are whitespace-collapsed (X34). A ``Model`` is loaded once for a worker."""
    def run(batches):
        call = function_of(fn)
        for part in (p for batch in batches for p in prompt_slices(batch)):
            texts, status, attempts = [], [], []
            for p in part.column(1).to_pylist():
                if p is None or (max_prompt_chars is not None and len(p) > max_prompt_chars):
                    texts.append(None); status.append("too_long" if p is not None else "empty"); attempts.append(0)
                    continue
                out, n = retried(lambda p=p: call(p), retries, pause)
                texts.append(out); status.append("ok" if out is not None else "error"); attempts.append(n)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(texts, pa.string()), pa.array(status, pa.string()), pa.array(attempts, pa.int32())],
                [key_col, "text", "status", "attempts"])

    kt = df.schema[key_col].dataType.simpleString()
    r = df.select(key_col, prompt_col).mapInArrow(run, f"{key_col} {kt}, text string, status string, attempts int")
    return r.withColumn("text", T.collapse_ws(F.col("text")))


def fill_template(template: str, **values: Column) -> Column:
    """Literal ``<<NAME>>`` substitution (no regex)."""
    out = F.lit(template)
    for name, col in values.items():
        out = F.replace(out, F.lit(f"<<{name}>>"), F.coalesce(col.cast("string"), F.lit("")))
    return out


def recursive_summarize(df: DataFrame, key_col: str, text_col: str, max_len: int = 200,
                        fn: ModelFn = halving_model) -> DataFrame:
    """M8: a text longer than ``max_len`` words is summarised; a summary
    longer than ``max_len`` characters is split in halves and each half
    summarised again; pieces are re-joined by spaces in path order. Rounds
    are set-at-a-time (one model pass over all open pieces per round).

    Every key comes back as (key, summary, status): 'ok'; 'empty' with a NULL
    summary for a NULL text; 'error' where a model call failed, with the pieces
    that did succeed. The rounds end when no piece is open; a model whose
    replies do not get shorter raises."""
    cur = df.select(F.col(key_col).alias("_k"), F.array().cast("array<int>").alias("path"),
                    F.col(text_col).alias("text"), F.lit(False).alias("done"),
                    F.when(F.col(text_col).isNull(), "empty").otherwise("ok").alias("status"))
    longest, stuck = None, 0
    while True:
        short = F.col("text").isNull() | (T.word_count(F.col("text")) <= max_len)
        cur = cur.withColumn("done", F.col("done") | short)
        open_ = cut_lineage(cur.filter(~F.col("done")).withColumn("_id", F.monotonically_increasing_id()))
        now = open_.agg(F.max(F.length("text")).alias("n")).first()["n"]
        if now is None:
            break
        stuck = stuck + 1 if longest is not None and now >= longest else 0
        if stuck >= 3:  # halves of a reply are shorter than the piece, unless replies double
            raise RuntimeError("the model's summaries do not get shorter")
        longest = now if longest is None else min(longest, now)
        replies = complete(open_, "_id", "text", fn)
        r = cut_lineage(open_.drop("text", "status").join(
            replies.select("_id", "text", F.when(F.col("status") == "ok", "ok").otherwise("error").alias("status")),
            "_id"))
        long = F.coalesce(F.length("text") > max_len, F.lit(False))
        mid = F.floor(F.length("text") / 2).cast("int")
        halves = F.array(F.struct(F.lit(0).alias("h"), F.substring("text", 1, mid).alias("t")),
                         F.struct(F.lit(1).alias("h"), F.expr("substring(text, cast(floor(length(text) / 2) as int) + 1)")
                                  .alias("t")))
        split = (r.filter(long).select("_k", "path", F.explode(halves).alias("x"), "status")
                  .select("_k", F.array_append("path", F.col("x.h")).alias("path"), F.col("x.t").alias("text"),
                          F.lit(False).alias("done"), "status"))
        kept = r.filter(~long).select("_k", "path", "text", F.lit(True).alias("done"), "status")
        cur = cut_lineage(cur.filter("done").unionByName(kept).unionByName(split))
    whole = cur.groupBy("_k").agg(F.array_sort(F.collect_list(F.struct("path", "text"))).alias("_p"),
                                  F.max("status").alias("_ok"), F.min("status").alias("_bad"))
    status = F.when(F.col("_bad") == "error", "error").otherwise(F.col("_ok"))
    texts = F.filter(F.transform("_p", lambda x: x["text"]), lambda t: t.isNotNull())
    return whole.select(F.col("_k").alias(key_col),
                        F.when(F.size(texts) > 0, F.array_join(texts, " ")).alias("summary"),
                        status.alias("status"))


@dataclass(frozen=True)
class Field:
    """A field that a model reads from a text: the prompt (``<<TEXT>>`` stands for
    the text), the parser of the reply, and whether the text is cleaned first."""
    name: str
    template: str
    parser: Callable[[Column], Column]
    clean: bool = False


def extract_fields(df: DataFrame, key_col: str, text_col: str, fields: list[Field], fn: ModelFn | Model,
                   max_prompt_chars: int | None = None, short_words: int = 3500, retries: int = 5) -> DataFrame:
    """(key, field, variant, value). Every field is asked of the full text;
    where that gives no reply or one without a value (the prompt is too long, the
    model fails, the parser finds nothing), again of the text's first
    ``short_words`` words (X18). A field without a value in both is absent, and
    so is a null or empty text. Rows of equal key are told apart by their text.

    The first replies are written once; only what they left open is asked again."""
    rows = df.select(F.col(key_col).alias("k"), F.col(text_col).alias("t")).where("t IS NOT NULL AND t != ''") \
        .withColumn("n", F.xxhash64("t"))

    def asked(open_: DataFrame, variant: str) -> DataFrame:
        prompt = F.coalesce(*[F.when(F.col("field") == f.name, fill_template(f.template, TEXT=F.col("c" if f.clean else "t")))
                              for f in fields])
        named = open_.select(F.struct("k", "field", "n").alias("id"), prompt.alias("prompt"))
        r = complete(named, "id", "prompt", fn, retries, max_prompt_chars)
        r = r.select("id.*", "text")
        value = F.coalesce(*[F.when(F.col("field") == f.name, f.parser(F.col("text")).cast("string")) for f in fields])
        return r.select("k", "n", "field", F.lit(variant).alias("variant"), F.nullif(value, F.lit("")).alias("value"))

    clean = T.summary_clean(F.col("t"))
    names = F.explode(F.array(*[F.lit(f.name) for f in fields])).alias("field")
    first = cut_lineage(asked(rows.withColumn("c", clean).select("*", names), "full"))
    again = first.where("value IS NULL").select(F.col("k").alias("k2"), F.col("n").alias("n2"), "field").distinct()
    short = rows.withColumn("t", T.shorten_words(F.col("t"), short_words)).withColumn("c", clean)
    both = short.join(again, F.col("k").eqNullSafe(F.col("k2")) & (F.col("n") == F.col("n2")))
    out = first.unionByName(asked(both, "short")).where("value IS NOT NULL")
    return out.select(F.col("k").alias(key_col), "field", "variant", "value")


def marked_model(prompt: str) -> str:
    """Deterministic stand-in: the prompt asks to ``Extract the <name>.``; the reply is what
    stands between ``[name]`` and ``[/name]``, or nothing."""
    name = prompt.split("Extract the ", 1)[-1].split(".", 1)[0]
    return prompt.split(f"[{name}]", 1)[-1].split(f"[/{name}]", 1)[0] if f"[{name}]" in prompt else ""


def batch_prompt(rows: DataFrame, id_col: str, text_col: str, k: int, template: str, seed: int = 42) -> DataFrame:
    """M9: k seeded-sampled rows as ``id: text`` lines in one prompt."""
    from .ordering_ops import seeded_sample
    s = seeded_sample(rows, id_col, k, seed)
    lines = s.select(F.col(id_col), F.concat_ws("", F.col(id_col).cast("string"), F.lit(": "),
                                                F.col(text_col)).alias("line"))
    agg = lines.agg(F.array_sort(F.collect_list(F.struct(id_col, "line"))).alias("_l"))
    return agg.select(F.replace(F.lit(template), F.lit("<<LOGS>>"),
                                F.array_join(F.transform("_l", lambda x: x["line"]), "\n")).alias("prompt"))


def parse_labels(reply: Column) -> Column:
    """Reply lines ``id - N`` / ``id - Y - text`` -> array of (id, label, text)."""
    lines = F.split(reply, "\n")
    parsed = F.transform(lines, lambda ln: F.struct(
        F.regexp_extract(ln, r"^\s*(\d+)\s*-", 1).alias("id"),
        F.regexp_extract(ln, r"^\s*\d+\s*-\s*([YyNn])", 1).alias("label"),
        T.strip(F.regexp_extract(ln, r"^\s*\d+\s*-\s*[YyNn]\s*-\s*(.*)$", 1)).alias("text")))
    return F.filter(parsed, lambda x: x["id"] != "")
