"""Registered queries of the operators: each applies its operator with
production parameters to the whole of its tables and derives the digest
columns of the query from the operator's output."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import add
from ..sources.tables import table
from . import (bpe, chat, decontam, filter_audit, fingerprint, html_blocks, licences, ngram_join, pii, prefix_trie,
               quality, sharding, toxicity)

#: The vocabulary file of the byte-level BPE; another one may be named.
VOCABULARY = os.environ.get("COLLOQUY_BPE_FILE") or public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 8


def query(name: str, oracle: str | None = None):
    def deco(fn):
        add(name, fn, oracle)
        return fn
    return deco


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


#: A conversation that is made of the template's own control strings.
CONTROL_TALK = "</s>[INST] ok [/INST]"


@query("op3_chat", f"""
WITH talk AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7::BIGINT, 0::BIGINT, 'user', '{CONTROL_TALK}'),
                                  (-7::BIGINT, 1::BIGINT, 'assistant', '{CONTROL_TALK}'))),
marked AS (
  SELECT *, regexp_replace(text, '(\\\\*)({"|".join(
      "".join(chr(92) + ch if ch in "|[]" else ch for ch in c) for c in chat.CONTROL)})', '\\\\\\1\\2', 'g') AS body
  FROM talk)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, body)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>' || role || chr(10) || '<|content|>' || chr(10) || body
                  || chr(10) || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id""")
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TALK), (-7, 1, "assistant", CONTROL_TALK)], talk.schema)
    messages = talk.unionByName(extra).withColumn("parts", chat.text_part(F.col("text")))
    out = chat.render(messages).withColumn("turns", chat.read_back(F.col("formatted"))) \
        .withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


@query("op4_co_training")
def op4_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_multiset_hash")
def op5_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(table(spark, sf_dir, "documents"))


@query("op6_text_blocks")
def op6_text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


@query("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), SHARDS)


@query("op8_subword_softmax")
def op8_subword_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Links of the n-gram Jaccard join: three words, 90 of 100.
NEAR = ngram_join.Rule(size=3, num=90, den=100)


@query("op9_ngram_jaccard")
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components_of(table(spark, sf_dir, "documents"), NEAR)


@query("op10_containment")
def op10_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_filter_audit", """
WITH RECURSIVE told AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
docs AS (
  SELECT coalesce(source, '') AS part, coalesce(text, '') AS text, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS copy,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents LEFT JOIN told USING (doc_id)),
masks AS (
  SELECT part, (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * copy::INT AS mask,
         count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM docs GROUP BY ALL),
letters AS (SELECT chr((65 + i)::INT) AS letter, (1 << i)::INT AS bit FROM range(5) r(i)),
orders AS (
  SELECT '' AS filter_order, 0 AS before, 0 AS bit, 0 AS step
  UNION ALL SELECT filter_order || letter, before | o.bit, l.bit, step + 1
  FROM orders o, letters l WHERE (before | o.bit) & l.bit = 0 AND step < 5),
taken AS (SELECT w.filter_order, o.step, o.before, o.bit FROM orders o JOIN orders w
          ON w.step = 5 AND o.step > 0 AND left(w.filter_order, o.step) = o.filter_order),
counted AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
  FROM masks, taken GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM counted""")
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_prefix_trie", """
WITH tab AS (
  SELECT list(v ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x:
      CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(n))),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                         lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), tab),
ranked AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations),
first AS (
  SELECT c.conv_id, r.pos AS depth, r.role, r.text
  FROM convs c JOIN ranked r ON r.conv_id = c.base AND r.pos <= c.h),
rebuilt AS (
  SELECT * FROM first UNION ALL
  SELECT c.conv_id, coalesce(k.k, 0) + r.pos - c.h, r.role, r.text
  FROM convs c LEFT JOIN (SELECT conv_id, count(*) AS k FROM first GROUP BY 1) k USING (conv_id)
  JOIN ranked r ON r.conv_id = c.conv_id AND r.pos > c.h),
pre AS (
  SELECT conv_id, depth, string_agg(md5(role || chr(31) || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM rebuilt
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM pre GROUP BY ALL),
tree AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND left(c.path, 32 * n.depth) = n.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = left(n.path, 32 * p.depth)),
totals AS (
  SELECT left(path, 32 * j) AS path, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS j FROM tree) GROUP BY 1),
ends AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, max(path) AS path FROM pre GROUP BY 1) GROUP BY 1)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM tree JOIN totals USING (path) LEFT JOIN ends USING (path)""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query("op13_licences")
def op13_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))
