"""Governance-style proposals derived from orders and line items.

One proposal per order; its line items become the parallel action arrays
(targets / values / signatures / calldatas) and the votes; order fields
become the scalar fields. ``replies`` holds, per proposal and field, the
text a model would have returned (budget, type, duration, team, previous
proposals, summary); the graph parsers read it like a model reply.

The SQL text (``*_SQL``) spells out the same rows flat for DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# line item -> action / vote fields (shared by Spark and SQL below)
LINE_SQL = """
lines AS (
  SELECT l_orderkey AS pid, l_linenumber AS pos,
         '0x' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS target,
         CASE WHEN l_linenumber = 7 THEN '12345'
              WHEN l_linenumber % 3 = 1
              THEN CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) || '0000000000000000'
              ELSE '0' END AS value,
         CASE WHEN l_linenumber = 4 THEN 'transfer(address,uint256)'
              WHEN l_linenumber % 3 = 1 THEN ''
              WHEN l_linenumber % 3 = 2 THEN 'sendOrRegisterDebt(address,uint256)'
              WHEN l_linenumber = 6 THEN '_setProposalThresholdBPS(uint256)'
              ELSE 'createEdition(string)' END AS signature,
         '0x' || lpad(hex(CAST(l_quantity AS BIGINT) * 1000000 + l_partkey % 1000000), 64, '0') AS calldata,
         '0x' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') || '-' || CAST(l_orderkey AS VARCHAR) AS vote_id,
         l_returnflag = 'R' AS support,
         CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN 2
              WHEN l_linestatus = 'O' THEN 0 ELSE 1 END AS support_detailed,
         CASE WHEN l_linenumber = 5 THEN '0' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS votes,
         CASE WHEN l_linenumber % 2 = 0 THEN NULL
              ELSE 'line ' || CAST(l_linenumber AS VARCHAR) || ' "ok"' || chr(10) || 'shipped ' || l_shipmode_stub END AS reason
  FROM (SELECT *, CAST(l_partkey % 7 AS VARCHAR) AS l_shipmode_stub FROM lineitem) li
)"""

PROPOSALS_SQL = """
props AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS pid,
         '0x' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS proposer,
         CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS created,
         CAST(o_custkey % 200 AS VARCHAR) AS quorum_votes,
         o_orderstatus AS status,
         CASE WHEN o_orderstatus = 'F'
              THEN CAST(CAST(epoch(o_orderdate) AS BIGINT) + 7 * 86400 AS VARCHAR) END AS execution_eta,
         'Order ' || CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority AS title,
         o_custkey, o_orderpriority, o_totalprice
  FROM orders
)"""

REPLIES_SQL = """
replies AS (
  SELECT pid, field, reply FROM (
    SELECT o_orderkey AS pid,
      CASE o_orderkey % 5
        WHEN 0 THEN '$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
        WHEN 1 THEN CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || ' ETH'
        WHEN 2 THEN '$' || CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || 'k and '
                    || CAST(o_orderkey % 50 AS VARCHAR) || ' ETH'
        WHEN 3 THEN CAST(o_orderkey % 90 + 10 AS VARCHAR) || 'bps'
        ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || ' USDC' END AS budget,
      'Keywords in this proposal include art, ' || lower(substr(o_orderpriority, 3)) || ', x' AS ptype,
      CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey % 12 + 1 AS VARCHAR) || ' months'
                          WHEN 1 THEN CAST(o_custkey % 90 + 1 AS VARCHAR) || ' days'
                          WHEN 2 THEN CASE o_custkey % 3 WHEN 0 THEN 'soon' WHEN 1 THEN 'one hundred and twenty months'
                                                         ELSE 'Twenty-four weeks' END END AS duration,
      CASE WHEN o_custkey % 7 = 0 THEN 'One hundred and twenty-five people'
           ELSE 'We are ' || CAST(o_custkey % 7 AS VARCHAR) || ' people' END AS team_size,
      'The name of the team is "Crew ' || CAST(o_custkey % 50 AS VARCHAR) || '."' AS team_name,
      CASE WHEN o_orderkey % 6 = 0 THEN 'Previous proposals are prop ' || CAST(o_orderkey - 32 AS VARCHAR)
                || ', prop ' || CAST(o_orderkey - 64 AS VARCHAR) END AS previous,
      'Order ' || CAST(o_orderkey AS VARCHAR) || ' of customer ' || CAST(o_custkey AS VARCHAR)
        || '. Priority ' || o_orderpriority AS summary
    FROM orders)
  UNPIVOT (reply FOR field IN (budget, ptype, duration, team_size, team_name, previous, summary))
)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ln, price = F.col("l_linenumber"), F.col("l_extendedprice")
    target = F.concat(F.lit("0x"), F.lpad(F.col("l_suppkey").cast("string"), 8, "0"))
    value = (F.when(ln == 7, F.lit("12345"))
              .when(ln % 3 == 1, F.concat(F.round(price * 100).cast("bigint").cast("string"),
                                          F.lit("0000000000000000")))
              .otherwise(F.lit("0")))
    sig = (F.when(ln == 4, F.lit("transfer(address,uint256)")).when(ln % 3 == 1, F.lit(""))
            .when(ln % 3 == 2, F.lit("sendOrRegisterDebt(address,uint256)"))
            .when(ln == 6, F.lit("_setProposalThresholdBPS(uint256)"))
            .otherwise(F.lit("createEdition(string)")))
    calldata = F.concat(F.lit("0x"), F.lpad(F.hex(F.col("l_quantity").cast("bigint") * 1000000
                                                  + F.col("l_partkey") % 1000000), 64, "0"))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    detailed = (F.when(flag == "R", 1).when(flag == "A", 2).when(status == "O", 0).otherwise(1))
    votes = F.when(ln == 5, F.lit("0")).otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    reason = F.when(ln % 2 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("line "), ln.cast("string"), F.lit(' "ok"\nshipped '),
                 (F.col("l_partkey") % 7).cast("string")))
    return li.select(
        F.col("l_orderkey").alias("pid"), ln.alias("pos"), target.alias("target"), value.alias("value"),
        sig.alias("signature"), calldata.alias("calldata"),
        F.concat(target, F.lit("-"), F.col("l_orderkey").cast("string")).alias("vote_id"),
        (flag == "R").alias("support"), detailed.alias("support_detailed"),
        votes.alias("votes"), reason.alias("reason"),
        F.col("l_quantity").cast("bigint").alias("qty"), flag.alias("flag"))


def proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested proposal rows (schema of the proposal JSON documents)."""
    o = table(spark, sf_dir, "orders")
    lines = _lines(spark, sf_dir)
    # one list for each proposal is moved; actions and votes are sorted out of it
    agg = lines.groupBy("pid").agg(
        F.collect_list(F.struct("pos", "target", "value", "signature", "calldata", F.col("vote_id").alias("id"), "support",
                                F.col("support_detailed").alias("supportDetailed"), "votes", "reason")).alias("_lines"),
        F.sum(F.when(F.col("flag") == "R", F.col("qty")).otherwise(0)).alias("_for"),
        F.sum(F.when(F.col("flag") == "N", F.col("qty")).otherwise(0)).alias("_against"),
        F.sum(F.when(F.col("flag") == "A", F.col("qty")).otherwise(0)).alias("_abstain"))
    # compiled forms: a lambda is evaluated element by element (no element is null, so both sorts agree)
    pick = lambda *names: F.sort_array(F.arrays_zip(*[F.col(f"_lines.{n}").alias(n) for n in names]))
    agg = agg.withColumns({"_acts": pick("pos", "target", "value", "signature", "calldata"),
                           "_votes": pick("pos", "id", "support", "supportDetailed", "votes", "reason")})
    days = F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("bigint")
    created = days * 86400
    p = o.join(agg, o.o_orderkey == agg.pid, "left")
    return p.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderkey").alias("pid"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" "),
                 F.col("o_orderpriority")).alias("title"),
        F.col("o_orderstatus").alias("status"),
        created.cast("string").alias("createdTimestamp"),
        F.when(F.col("o_orderstatus") == "F", (created + 7 * 86400).cast("string")).alias("executionETA"),
        (F.col("o_custkey") % 200).cast("string").alias("quorumVotes"),
        F.col("_for").cast("string").alias("forVotes"),
        F.col("_against").cast("string").alias("againstVotes"),
        F.col("_abstain").cast("string").alias("abstainVotes"),
        F.struct(F.concat(F.lit("0x"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("id"))
         .alias("proposer"),
        F.coalesce(F.transform("_acts", lambda a: a["target"]), F.array().cast("array<string>")).alias("targets"),
        F.coalesce(F.transform("_acts", lambda a: a["value"]), F.array().cast("array<string>")).alias("values"),
        F.coalesce(F.transform("_acts", lambda a: a["signature"]), F.array().cast("array<string>")).alias("signatures"),
        F.coalesce(F.transform("_acts", lambda a: a["calldata"]), F.array().cast("array<string>")).alias("calldatas"),
        F.coalesce(F.transform("_votes", lambda v: F.struct(
            v["id"].alias("id"), v["support"].alias("support"), v["supportDetailed"].alias("supportDetailed"),
            v["votes"].alias("votes"), v["reason"].alias("reason"))),
            F.array().cast("array<struct<id:string,support:boolean,supportDetailed:int,votes:string,reason:string>>"))
         .alias("votes"))


REPLY_FIELDS = ["budget", "ptype", "duration", "team_size", "team_name", "previous", "summary"]


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, field, reply): the stand-in model replies per proposal field."""
    wide = reply_columns(spark, sf_dir)
    return (wide.unpivot("pid", REPLY_FIELDS, "field", "reply")
                .filter(F.col("reply").isNotNull()))


def reply_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same replies, one column per field (pid, budget, ptype, ...)."""
    o = table(spark, sf_dir, "orders")
    k, c, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    s = lambda x: x.cast("string")
    fl = lambda x: F.floor(x).cast("bigint").cast("string")
    budget = (F.when(k % 5 == 0, F.concat(F.lit("$"), fl(price)))
               .when(k % 5 == 1, F.concat(fl(price / 1000), F.lit(" ETH")))
               .when(k % 5 == 2, F.concat(F.lit("$"), fl(price / 1000), F.lit("k and "), s(k % 50), F.lit(" ETH")))
               .when(k % 5 == 3, F.concat(s(k % 90 + 10), F.lit("bps")))
               .otherwise(F.concat(fl(price), F.lit(" USDC"))))
    ptype = F.concat(F.lit("Keywords in this proposal include art, "),
                     F.lower(F.substring("o_orderpriority", 3, 1 << 20)), F.lit(", x"))
    duration = (F.when(k % 4 == 0, F.concat(s(c % 12 + 1), F.lit(" months")))
                 .when(k % 4 == 1, F.concat(s(c % 90 + 1), F.lit(" days")))
                 .when((k % 4 == 2) & (c % 3 == 0), F.lit("soon"))
                 .when((k % 4 == 2) & (c % 3 == 1), F.lit("one hundred and twenty months"))
                 .when(k % 4 == 2, F.lit("Twenty-four weeks")))
    team_size = F.when(c % 7 == 0, F.lit("One hundred and twenty-five people")) \
        .otherwise(F.concat(F.lit("We are "), s(c % 7), F.lit(" people")))
    team_name = F.concat(F.lit('The name of the team is "Crew '), s(c % 50), F.lit('."'))
    previous = F.when(k % 6 == 0, F.concat(F.lit("Previous proposals are prop "), s(k - 32),
                                           F.lit(", prop "), s(k - 64)))
    summary = F.concat(F.lit("Order "), s(k), F.lit(" of customer "), s(c), F.lit(". Priority "),
                       F.col("o_orderpriority"))
    fields = {"budget": budget, "ptype": ptype, "duration": duration, "team_size": team_size,
              "team_name": team_name, "previous": previous, "summary": summary}
    return o.select(k.alias("pid"), *[v.alias(n) for n, v in fields.items()])
