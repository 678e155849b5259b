"""Queries over versioned tables, and over operators of the graph and Q&A
work that stand beside the main path: budget raise, subject scope, logs, ids, deadlines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import text as T
from ..operators import graph as G
from ..operators import statements as ST
from ..sources import buckets as B
from ..sources import io as IO
from ..sources import views as V
from ..sources.tables import table
from .registry import register

#: Proposal numbers that a bucket holds at least, and about how many buckets there are at most.
NUMBERS, BUCKETS = 128, 1024


def by_proposal(orders) -> str:
    """The bucket of a statement. Buckets get wider with the largest number, so
    that their folders and files do not grow in number with the table."""
    most = orders.agg(F.max("o_orderkey").alias("m")).first()["m"] or 0
    return f"cast(substring_index(entity, ' ', -1) as bigint) div {max(NUMBERS, -(-(most + 1) // BUCKETS))}"


def _proposal(number) -> F.Column:
    return F.concat(F.lit("Proposal "), number.cast("string"))


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        _proposal(F.col("o_orderkey")).alias("entity"), "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


def _as_statements(orders):
    """Three statements of each order: status, price class, day."""
    each = F.array(*[F.struct(F.lit(p).alias("property"), v.alias("value")) for p, v in (
        ("Status", F.col("o_orderstatus")), ("Priority", F.col("o_orderpriority")), ("Day", F.col("day")))])
    return orders.select("entity", F.inline(each))


# The newest hundredth of the numbers is stated again, as an incremental pull above a
# high-water mark would; two of their three properties change.
BUCKETED_SQL = """
WITH st AS (
  SELECT 'Proposal ' || o_orderkey AS entity, u.property, u.value, o_orderkey
  FROM orders, LATERAL (VALUES ('Status', o_orderstatus), ('Priority', o_orderpriority),
                               ('Day', strftime(o_orderdate, '%Y-%m-%d'))) u(property, value)),
nw AS (
  SELECT 'Proposal ' || o_orderkey AS entity, u.property, u.value
  FROM orders, LATERAL (VALUES ('Status', o_orderstatus || '?'), ('Priority', o_orderpriority)) u(property, value)
  WHERE o_orderkey > (SELECT max(o_orderkey) * 99 // 100 FROM orders))
"""


def _restated(orders):
    mark = orders.agg(F.expr("max(o_orderkey) * 99 div 100").alias("m")).first()["m"]
    each = F.array(*[F.struct(F.lit(p).alias("property"), v.alias("value")) for p, v in (
        ("Status", F.concat("o_orderstatus", F.lit("?"))), ("Priority", F.col("o_orderpriority")))])
    return orders.filter(F.col("o_orderkey") > F.lit(mark)).select("entity", F.inline(each))


def _merged(spark, sf_dir, mode):
    orders = _orders(spark, sf_dir)
    base = IO.scratch_path(spark, "statements")
    B.create(_as_statements(orders), base, by_proposal(orders))
    B.merge(_restated(orders), base, lambda old, new: ST.merge_statements(old, new, mode))
    return B.read(spark, base).select("entity", "property", "value")


@register("bucketed_merge", BUCKETED_SQL + """
SELECT entity, property, value FROM st WHERE (entity, property) NOT IN (SELECT entity, property FROM nw)
UNION ALL SELECT * FROM nw
""")
def bucketed_merge(spark, sf_dir):
    """S14 + D7 (replace_all): the statements of all proposals kept in buckets
    of their number; the newest hundredth is stated again, and only its
    buckets are rewritten. Returns the table read back through its manifest."""
    return _merged(spark, sf_dir, "replace_all")


@register("bucketed_append", BUCKETED_SQL + """
SELECT entity, property, value FROM st WHERE (entity, property, value) NOT IN (SELECT * FROM nw)
UNION ALL SELECT * FROM nw
""")
def bucketed_append(spark, sf_dir):
    """S14 + D7 (append_or_replace): as ``bucketed_merge``, but old values stay
    beside new ones and equal statements collapse."""
    return _merged(spark, sf_dir, "append_or_replace")


@register("bucketed_insert", """
SELECT event_id, user_id, event_type FROM events
""")
def bucketed_insert(spark, sf_dir):
    """D1 on a table in buckets: all events of one type first, then the whole
    table as a batch that repeats them; only new keys are added."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    base = IO.scratch_path(spark, "events")
    B.create(ev.filter(F.col("event_type") == "click"), base, "event_id div 65536")
    B.insert_absent(ev, base, "event_id")
    return B.read(spark, base).select("event_id", "user_id", "event_type")


@register("raise_budget", """
WITH t AS (
  SELECT l_orderkey, min_by(price, seq) AS first_value FROM (
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey AS seq, min(l_extendedprice) AS price
    FROM lineitem GROUP BY 1, 2) GROUP BY 1)
SELECT 'Proposal ' || o_orderkey AS subject,
       CASE WHEN first_value > floor(o_totalprice / 4) THEN floor(first_value) ELSE floor(o_totalprice / 4) END::BIGINT AS budget
FROM orders LEFT JOIN t ON l_orderkey = o_orderkey
""")
def raise_budget(spark, sf_dir):
    """A quarter of an order's price as its budget, its line items as
    transfers in order of line and part; a budget below the first transfer is raised to it."""
    o = table(spark, sf_dir, "orders")
    budget = o.select(_proposal(F.col("o_orderkey")).alias("subject"), F.lit("Proposal Budget in ETH").alias("relation"),
                      F.floor(F.col("o_totalprice") / 4).cast("string").alias("object"), F.lit(0).cast("bigint").alias("seq"))
    seq = (F.col("l_linenumber").cast("bigint") * 1000000000 + F.col("l_partkey")).alias("seq")
    li = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey", seq)
          .agg(F.min("l_extendedprice").alias("price")))     # one amount for each line and part
    moved = li.select(_proposal(F.col("l_orderkey")).alias("subject"), F.lit("Transfer Value in ETH").alias("relation"),
                      F.col("price").cast("string").alias("object"), "seq")
    raised = G.raise_budget(budget.unionByName(moved))
    return (raised.filter(F.col("relation") == "Proposal Budget in ETH")
                  .select("subject", F.floor(F.col("object").cast("double")).cast("bigint").alias("budget")))


SCOPE_SQL = """
WITH cat AS (SELECT p_name AS label, 'Q' || min(p_partkey) AS entity_id FROM part WHERE p_size <= 45 GROUP BY 1),
r AS (SELECT DISTINCT l_orderkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey),
j AS (SELECT r.*, entity_id FROM r LEFT JOIN cat ON label = p_name),
bad AS (SELECT DISTINCT l_orderkey FROM j WHERE entity_id IS NULL)
SELECT l_orderkey AS entity, p_name AS name, entity_id AS name_id,
       l_orderkey IN (SELECT l_orderkey FROM bad) AS rejected
FROM j
"""


@register("resolve_subject_scope", SCOPE_SQL)
def resolve_subject_scope(spark, sf_dir):
    """J18 (subject scope): part names of each order looked up in a catalogue
    that lacks the names of large parts only; one unknown name rejects
    every row of its order, and the rejects are listed."""
    from ..operators.joins import resolve_ids
    part = table(spark, sf_dir, "part")
    cat = (part.filter(F.col("p_size") <= 45).groupBy(F.col("p_name").alias("label"))
               .agg(F.concat(F.lit("Q"), F.min("p_partkey").cast("string")).alias("entity_id")))
    rows = (table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
            .join(part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
            .select(F.col("l_orderkey").alias("entity"), F.col("p_name").alias("name")).distinct())
    ok, rejects = resolve_ids(rows, cat, "name", scope_col="entity")
    return (ok.withColumn("rejected", F.lit(False)).unionByName(rejects.withColumn("rejected", F.lit(True)))
              .select("entity", "name", "name_id", "rejected"))


@register("qa_logs_json", V.with_views("messages", "questions", "qa") + """
SELECT q.message_id, m.thread_id, [q.message_id + 1] AS reply_ids, CAST([] AS BIGINT[]) AS conversation_ids, q.question AS prompt
FROM qa q JOIN messages m ON m.id = q.message_id
""")
def qa_logs_json(spark, sf_dir):
    """The logs document of every Q&A row written as JSON text (NULL
    thread kept) and parsed back."""
    m = V.messages(spark, sf_dir).select(F.col("id").alias("message_id"), "thread_id")
    q = V.qa(spark, sf_dir).join(m, "message_id")
    none = F.array().cast("array<bigint>")
    js = X.qa_logs_json(F.col("thread_id"), F.array(F.col("message_id") + 1), none, F.col("question"))
    back = q.select("message_id", X.read_qa_logs(js).alias("l"))
    return back.select("message_id", "l.thread_id", "l.reply_ids", "l.conversation_ids",
                       F.col("l.conversation_prompt").alias("prompt"))


@register("item_id_in", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_returnflag = 'A' THEN NULL ELSE 'Q' || l_partkey END AS item_id
FROM lineitem
""")
def item_id_in(spark, sf_dir):
    """The item id inside an error text (none where the text names none)."""
    li = table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_returnflag") == "A", F.lit("Label missing for Query")).otherwise(
        F.concat(F.lit("Item [[Item:Q"), F.col("l_partkey").cast("string"), F.lit("|Q1]] already has label \"x\"")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", X.item_id_in(text).alias("item_id"))


@register("deadline_from_date", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(round(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) / 30.0) AS BIGINT) AS months
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def deadline_from_date(spark, sf_dir):
    """X54 (date arm): months between an order's day and its shipping days."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").join(o, "l_orderkey")
    return j.select("l_orderkey", "l_linenumber", "l_partkey",
                    X.deadline_months_from_date(F.col("l_shipdate"), F.col("o_orderdate")).alias("months"))


@register("clean_urls", r"""
SELECT page_id, regexp_replace('see ' || url || ', then ' || upper(url), 'https?://[^\s]*page\b', 'PAGEURL', 'g')
       AS cleaned FROM pages
""")
def clean_urls(spark, sf_dir):
    """URLs that reach the keyword become its token; others stay."""
    u = table(spark, sf_dir, "pages").select("page_id", F.concat(
        F.lit("see "), F.col("url"), F.lit(", then "), F.upper("url")).alias("t"))
    return u.select("page_id", T.clean_urls(F.col("t"), "page").alias("cleaned"))


@register("sort_by_subject", """
SELECT 'Proposal ' || o_orderkey AS subject, o_orderstatus AS status FROM orders
""")
def sort_by_subject(spark, sf_dir):
    """Rows in order of their subject."""
    from ..operators.ordering_ops import sort_by
    return sort_by(_orders(spark, sf_dir).select(F.col("entity").alias("subject"), F.col("o_orderstatus").alias("status")),
                   ["subject"])
