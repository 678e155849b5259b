"""Knowledge-graph queries over proposals derived from orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sql_extract as E
from ..functions import sql_text as S
from ..operators import graph as G
from ..operators.state import keep_by_order
from ..sources import proposals as PR
from ..sources.views import ENTITIES_SQL
from .registry import register

TREASURY = "Treasury"


def _p(spark, sf_dir, shared: bool = False):
    """The proposal documents. ``shared=True`` when a query reads them more
    than once: they are then built once and materialised in the shared
    checkpoint folder instead of being re-derived for every use."""
    p = PR.proposals(spark, sf_dir)
    if shared:
        from ..session import cut_lineage
        p = cut_lineage(p)
    return p


def _r(spark, sf_dir):
    return PR.reply_columns(spark, sf_dir)


# ---------------------------------------------------------------- SQL builders

def base_ctes() -> str:
    return "WITH " + ",\n".join([PR.LINE_SQL.strip(), PR.PROPOSALS_SQL.strip(), PR.REPLIES_SQL.strip()]) + """,
lv AS (SELECT pid,
              sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS for_votes,
              sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS against_votes,
              sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS abstain_votes
       FROM (SELECT l_orderkey AS pid, * FROM lineitem) GROUP BY pid),
rw AS (SELECT pid,
              max(reply) FILTER (WHERE field = 'budget') AS budget,
              max(reply) FILTER (WHERE field = 'ptype') AS ptype,
              max(reply) FILTER (WHERE field = 'duration') AS duration,
              max(reply) FILTER (WHERE field = 'team_size') AS team_size,
              max(reply) FILTER (WHERE field = 'team_name') AS team_name,
              max(reply) FILTER (WHERE field = 'previous') AS previous,
              max(reply) FILTER (WHERE field = 'summary') AS summary
       FROM replies GROUP BY pid)
"""


def k1_sql(replies: bool, name: str = "k1", title: str = "p.title") -> str:
    """K1 as UNION ALL of one SELECT per field: (pid, i, j, relation, object)."""
    src = "props p LEFT JOIN lv ON lv.pid = p.pid" + (" LEFT JOIN rw ON rw.pid = p.pid" if replies else "")
    fields = [("ID", "p.id"), ("Proposer", "p.proposer"),
              ("Proposal Submission Date", E.epoch_to_date("p.created")),
              ("quorumVotes", "CAST(TRY_CAST(p.quorum_votes AS BIGINT) AS VARCHAR)"),
              ("Status", "p.status"), ("executionETA", "p.execution_eta"), ("Label", title)]
    if replies:
        fields += [("Summary", E.summary_tail("rw.summary", "rw.summary")),
                   ("Proposal Budget", E.get_money("rw.budget")),
                   ("Proposal Type", E.type_reply("rw.ptype")),
                   ("Proposal Duration", E.duration_months("rw.duration")),
                   ("Team Name", E.team_name("rw.team_name")),
                   ("Previous Proposal", None),
                   ("Team Size", f"CAST(nullif({E.team_size('rw.team_size')}, 0) AS VARCHAR)")]
    fields += [("Supporter Count", "CAST(lv.for_votes AS VARCHAR)"),
               ("Abstain Count", "CAST(lv.abstain_votes AS VARCHAR)"),
               ("Opposer Count", "CAST(lv.against_votes AS VARCHAR)")]
    parts = []
    for i, (rel, expr) in enumerate(fields):
        if expr is None:
            refs = E.proposal_refs("rw.previous")
            parts.append(f"SELECT p.pid, {i} AS i, CAST(u.j - 1 AS BIGINT) AS j, {S.q(rel)} AS relation, "
                         f"'Proposal ' || CAST(u.r AS VARCHAR) AS object FROM {src}, "
                         f"unnest({refs}) WITH ORDINALITY AS u(r, j)")
        else:
            parts.append(f"SELECT p.pid, {i} AS i, CAST(0 AS BIGINT) AS j, {S.q(rel)} AS relation, "
                         f"{expr} AS object FROM {src}")
    body = "\nUNION ALL\n".join(parts)
    return f"""{name} AS (
  SELECT 'Proposal ' || CAST(pid AS VARCHAR) AS subject, relation, object, pid * 1000 + i * 10 + j AS seq
  FROM ({body}) z WHERE object IS NOT NULL AND object <> ''
)"""


def k2_sql(replies: bool, treasury: str = TREASURY, name: str = "k2") -> str:
    budget = f"coalesce({E.get_money('rw.budget')}, '')" if replies else "''"
    join = " LEFT JOIN rw ON rw.pid = l.pid" if replies else ""
    has_and = f"list_contains(regexp_split_to_array(b, '\\s+'), 'and')"
    to_n, val_n = G.debt_relations(treasury)
    typ = E.action_type("signature")
    debt = "starts_with(signature, 'sendOrRegisterDebt')"
    bps = "regexp_extract(b, '\\p{Nd}+bps', 0)"
    c_tr = f"value <> '0' AND {typ} = 'Transfer'"
    c_d1 = f"value = '0' AND {debt} AND NOT {has_and}"
    c_d2 = f"value = '0' AND {debt} AND {has_and}"
    c_ce = f"value = '0' AND NOT {debt} AND starts_with(signature, 'createEdition')"
    c_bp = f"value = '0' AND NOT {debt} AND NOT starts_with(signature, 'createEdition') AND {bps} <> ''"
    rows = [(c_tr, 0, "Transfer To", "target"), (c_tr, 1, "Transfer Value", E.wei_to_eth("value")),
            (c_d1, 0, to_n, "target"), (c_d1, 1, val_n, f"CAST({E.calldata_amount('calldata')} AS VARCHAR)"),
            (c_d2, 0, "sendOrRegisterDebt To", "target"),
            (c_d2, 1, "sendOrRegisterDebt Value", f"CAST({E.calldata_amount('calldata')} AS VARCHAR)"),
            (c_ce, 0, "createEdition To", "target"),
            (c_bp, 0, "setProposalThresholdBPS To", "target"), (c_bp, 1, "setProposalThresholdBPS Value", bps)]
    parts = [f"SELECT pid, k, {j} AS j, {S.q(rel)} AS relation, {expr} AS object FROM la WHERE {cond}"
             for cond, j, rel, expr in rows]
    body = "\nUNION ALL\n".join(parts)
    return f"""{name} AS (
  WITH la AS (SELECT l.*, {budget} AS b,
                     row_number() OVER (PARTITION BY l.pid ORDER BY pos, target, value, signature, calldata) - 1 AS k
              FROM lines l{join})
  SELECT 'Proposal ' || CAST(pid AS VARCHAR) AS subject, relation, object,
         pid * 1000 + 500 + k * 2 + j AS seq
  FROM ({body}) z WHERE object IS NOT NULL
)"""


def view1_sql(replies: bool = True, treasury: str = TREASURY, p: str = "") -> str:
    """CTEs ``{p}k1 .. {p}v1`` computing the normalised view 1 (K8)."""
    tv = "object"
    return ",\n".join([
        k1_sql(replies, f"{p}k1"), k2_sql(replies, treasury, f"{p}k2"),
        f"""{p}k12 AS (SELECT * FROM {p}k1 UNION ALL SELECT * FROM {p}k2)""",
        f"""{p}k4 AS (
  SELECT subject, relation, u.o AS object, seq * 100 + u.j - 1 AS seq
  FROM {p}k12, unnest({E.keywords('object')}) WITH ORDINALITY AS u(o, j)
  WHERE relation = 'Proposal Type'
  UNION ALL
  SELECT subject,
         CASE WHEN {E.title_relation('relation')} = 'Proposal Duration' THEN 'Proposal Duration in Months'
              ELSE {E.title_relation('relation')} END AS relation,
         CASE WHEN {E.title_relation('relation')} = 'ExecutionETA' THEN {E.epoch_to_date('object')}
              WHEN {E.title_relation('relation')} = 'Proposal Duration' THEN {E.deadline_months('object')}
              ELSE object END AS object,
         seq * 100 AS seq
  FROM {p}k12 WHERE relation <> 'Proposal Type')""",
        f"""{p}k5 AS (
  SELECT * FROM {p}k4 WHERE relation <> 'Proposal Budget'
  UNION ALL
  SELECT subject, relation, {E.render_number('n')} AS object, seq FROM (
    SELECT subject,
           CASE WHEN contains(piece, '$') OR contains(piece, 'USD') THEN 'Proposal Budget in USD'
                WHEN contains(piece, 'ETH') AND NOT contains(piece, 'stETH') THEN 'Proposal Budget in ETH'
                WHEN contains(piece, 'stETH') THEN 'Proposal Budget in stETH' END AS relation,
           {E.to_number('piece')} AS n, seq + u.j - 1 AS seq
    FROM {p}k4, unnest(string_split(object, ' and ')) WITH ORDINALITY AS u(piece, j)
    WHERE relation = 'Proposal Budget') b
  WHERE relation IS NOT NULL AND n IS NOT NULL)""",
        f"""{p}k6a AS (
  SELECT subject,
         max(CASE WHEN relation = 'Proposal Budget in ETH' THEN 1 END) AS has_eth,
         arg_min({tv}, seq) FILTER (WHERE relation = 'Transfer Value') AS tv,
         max(seq) AS mseq
  FROM {p}k5 GROUP BY subject)""",
        f"""{p}k6b AS (
  SELECT * FROM {p}k5
  UNION ALL
  SELECT subject,
         CASE WHEN contains(tv, 'ETH') THEN 'Proposal Budget in ETH' ELSE 'Proposal Budget in USD' END,
         CASE WHEN contains(tv, 'ETH') THEN {E.render_number(E.strip_num('tv', 'ETH'))}
              ELSE {E.render_number(E.strip_num('tv', 'USD'))} END,
         mseq + 1
  FROM {p}k6a WHERE has_eth IS NULL AND tv IS NOT NULL AND (contains(tv, 'ETH') OR contains(tv, 'USD')))""",
        f"""{p}k6 AS (
  SELECT * FROM {p}k6b WHERE relation NOT IN ('Proposal Budget in USD', 'Proposal Budget in ETH')
  UNION ALL
  SELECT subject, relation, arg_max(object, CAST(object AS DOUBLE)), 0
  FROM {p}k6b WHERE relation IN ('Proposal Budget in USD', 'Proposal Budget in ETH')
  GROUP BY subject, relation)""",
        f"""{p}k7 AS (
  SELECT subject,
         CASE WHEN relation = 'Transfer Value' THEN 'Transfer Value in ETH' ELSE relation END AS relation,
         CASE WHEN relation = 'Setproposalthresholdbps Value' THEN {E.render_number(E.strip_num('object', 'bps'))}
              WHEN relation = 'Transfer Value' THEN {E.render_number(E.strip_num('object', 'ETH'))}
              WHEN relation = 'Team Name' THEN {E.capitalize('object')}
              ELSE object END AS object, seq
  FROM {p}k6)""",
        f"""{p}a16 AS (
  SELECT * FROM {p}k7
  UNION ALL
  SELECT subject, 'Team Size', '1', max(seq) + 2 FROM {p}k7 GROUP BY subject
  HAVING max(CASE WHEN relation = 'Team Size' THEN 1 END) IS NULL)""",
        f"""{p}v1 AS (
  SELECT subject, relation, {S.strip_quotes('object')} AS object, min(seq) AS seq
  FROM {p}a16 GROUP BY ALL)""",
    ])


# ---------------------------------------------------------------- queries

@register("proposal_triples", base_ctes() + "," + k1_sql(True) + "\nSELECT subject, relation, object FROM k1")
def proposal_triples(spark, sf_dir):
    """K1 + M13 parsers: one triple per present proposal field."""
    return G.proposal_triples(_p(spark, sf_dir), _r(spark, sf_dir)).select("subject", "relation", "object")


@register("paged_triples", base_ctes() + "," + k1_sql(False) + "\nSELECT subject, relation, object FROM k1")
def paged_triples(spark, sf_dir):
    """S4 -> K1: proposals landed as JSON pages, read back, and their triples."""
    from ..sources import io as IO
    path = IO.scratch_path(spark, "pages")
    IO.write_proposals_json(_p(spark, sf_dir), path)
    return G.proposal_triples(IO.read_proposals_json(spark, path)).select("subject", "relation", "object")


@register("action_triples", base_ctes() + "," + k2_sql(True) + "\nSELECT subject, relation, object FROM k2")
def action_triples(spark, sf_dir):
    """K2: transfer / debt / edition / threshold triples from zipped actions."""
    budget = _r(spark, sf_dir).select("pid", G.X.get_money(F.col("budget")).alias("budget"))
    return G.action_triples(_p(spark, sf_dir), budget, TREASURY).select("subject", "relation", "object")


VOTE_EDGES_SQL = "WITH " + PR.LINE_SQL.strip() + f"""
SELECT DISTINCT 'Proposal ' || CAST(pid AS VARCHAR) AS subject,
       CASE WHEN support THEN 'Supported By' WHEN support_detailed = 0 THEN 'Opposed By'
            WHEN support_detailed = 2 THEN 'Abstained By' END AS relation,
       split_part(vote_id, '-', 1) AS object,
       greatest(coalesce(TRY_CAST(votes AS BIGINT), 1), 1) AS weight,
       {S.strip_quotes("coalesce(reason, 'Reason not provided')")} AS reason
FROM lines
WHERE support OR support_detailed IN (0, 2)
"""


@register("vote_edges", VOTE_EDGES_SQL)
def vote_edges(spark, sf_dir):
    """K3: weighted vote edges with reasons; unclassifiable votes dropped."""
    return G.vote_edges(_p(spark, sf_dir)).select("subject", "relation", "object", "weight", "reason")


@register("normalise_graph", base_ctes() + "," + view1_sql() + "\nSELECT subject, relation, object FROM v1")
def normalise_graph(spark, sf_dir):
    """K8: K1 + K2 -> K4 -> K5 -> K6 -> K7 -> A16 -> X31 -> distinct."""
    return G.graph_view1(_p(spark, sf_dir, shared=True), _r(spark, sf_dir), TREASURY).select(
        "subject", "relation", "object")


# ---------------------------------------------------------------- light view 1 (no model fields)

def basic_view1(spark, sf_dir, treasury: str = TREASURY, upper_title: bool = False, p=None):
    """K1 + K2 + K4 without model replies: ids, dates, status, label, vote
    totals and actions, relations title-cased."""
    p = p if p is not None else _p(spark, sf_dir, shared=True)
    if upper_title:
        p = p.withColumn("title", F.upper("title"))
    t = G.proposal_triples(p).unionByName(G.action_triples(p, None, treasury))
    return G.normalise_types(t)


def basic_sql(p: str = "b", treasury: str = TREASURY, upper_title: bool = False) -> str:
    title = "upper(p.title)" if upper_title else "p.title"
    return ",\n".join([
        k1_sql(False, f"{p}k1", title), k2_sql(False, treasury, f"{p}k2"),
        f"""{p}k12 AS (SELECT * FROM {p}k1 UNION ALL SELECT * FROM {p}k2)""",
        f"""{p}v AS (
  SELECT subject,
         CASE WHEN {E.title_relation('relation')} = 'Proposal Duration' THEN 'Proposal Duration in Months'
              ELSE {E.title_relation('relation')} END AS relation,
         CASE WHEN {E.title_relation('relation')} = 'ExecutionETA' THEN {E.epoch_to_date('object')}
              WHEN {E.title_relation('relation')} = 'Proposal Duration' THEN {E.deadline_months('object')}
              ELSE object END AS object,
         seq * 100 AS seq
  FROM {p}k12)"""])


def edges_sql(name: str = "ve") -> str:
    return f"""{name} AS (
  SELECT DISTINCT 'Proposal ' || CAST(pid AS VARCHAR) AS subject,
         CASE WHEN support THEN 'Supported By' WHEN support_detailed = 0 THEN 'Opposed By'
              WHEN support_detailed = 2 THEN 'Abstained By' END AS relation,
         split_part(vote_id, '-', 1) AS object,
         greatest(coalesce(TRY_CAST(votes AS BIGINT), 1), 1) AS weight,
         {S.strip_quotes("coalesce(reason, 'Reason not provided')")} AS reason
  FROM lines WHERE support OR support_detailed IN (0, 2))"""


def _dt_values(treasury: str = TREASURY) -> str:
    from ..operators.statements import relation_sets
    rows = [f"({S.q(r)}, {S.q(dt)})" for dt, rels in relation_sets(treasury).items() for r in rels]
    return "dtypes(relation, datatype) AS (VALUES " + ", ".join(rows) + ")"


def _quals_sql(rel: str, weight: str, reason: str) -> str:
    bounded = S.bounded_text(reason)
    return (f"CASE WHEN {rel} IN ('Supported By', 'Opposed By', 'Abstained By') THEN "
            f"'Vote Weight=' || CAST({weight} AS VARCHAR) || "
            f"CASE WHEN {reason} IS NOT NULL AND {reason} <> 'Reason not provided' "
            f"THEN ';Vote Reason=' || {bounded} ELSE '' END ELSE '' END")


def quals_text(col):
    return F.array_join(F.transform(col, lambda x: F.concat(x["prop"], F.lit("="), x["value"])), ";")


TYPED_SQL = base_ctes() + ",\n" + basic_sql() + ",\n" + edges_sql() + ",\n" + _dt_values() + f""",
t AS (SELECT subject, relation, object, CAST(NULL AS BIGINT) AS weight, CAST(NULL AS VARCHAR) AS reason FROM bv
      UNION ALL SELECT subject, relation, object, weight, reason FROM ve),
j AS (SELECT t.*, d.datatype FROM t JOIN dtypes d ON d.relation = t.relation WHERE t.object IS NOT NULL)
SELECT subject AS entity, relation AS property, datatype,
       CASE WHEN datatype = 'string' THEN replace(object, chr(10), ' --- ')
            WHEN datatype = 'time' THEN '+' || strftime(TRY_CAST(object AS DATE), '%Y-%m-%d') || 'T00:00:00Z'
            WHEN datatype = 'quantity' THEN {E.render_number('TRY_CAST(object AS DOUBLE)')}
            ELSE object END AS value,
       {_quals_sql('relation', 'weight', 'reason')} AS qualifiers
FROM j
UNION ALL
SELECT subject, 'Url', 'url', 'https://example.org/vote/' || object, '' FROM j WHERE relation = 'Id'
"""


@register("typed_statements", TYPED_SQL)
def typed_statements(spark, sf_dir):
    """K9 + X49 + X50 + X51 + X32: typed statements with vote qualifiers."""
    from ..operators import statements as ST
    p = _p(spark, sf_dir, shared=True)
    st = ST.typed_statements(basic_view1(spark, sf_dir, p=p), G.vote_edges(p), ST.datatype_table(spark, TREASURY))
    return st.select("entity", "property", "datatype", "value", quals_text(F.col("qualifiers")).alias("qualifiers"))


INVERSE_SQL = base_ctes() + ",\n" + basic_sql() + ",\n" + edges_sql() + f""",
inv(relation, inverse) AS (VALUES ('Supported By', 'Supported'), ('Opposed By', 'Opposed'),
                                  ('Abstained By', 'Abstained'), ('Proposer', 'Proposed')),
t AS (SELECT subject, relation, object, CAST(NULL AS BIGINT) AS weight, CAST(NULL AS VARCHAR) AS reason FROM bv
      UNION ALL SELECT subject, relation, object, weight, reason FROM ve)
SELECT t.object AS entity, i.inverse AS property, t.subject AS value,
       {_quals_sql('t.relation', 't.weight', 't.reason')} AS qualifiers
FROM t JOIN inv i ON i.relation = t.relation WHERE starts_with(t.object, '0x')
"""


@register("inverse_statements", INVERSE_SQL)
def inverse_statements(spark, sf_dir):
    """Inverse statements on individuals (addresses)."""
    from ..operators import statements as ST
    p = _p(spark, sf_dir, shared=True)
    st = ST.inverse_statements(spark, basic_view1(spark, sf_dir, p=p), G.vote_edges(p))
    return st.select("entity", "property", "value", quals_text(F.col("qualifiers")).alias("qualifiers"))


def _range_values(treasury: str = TREASURY) -> str:
    from ..operators.statements import range_map
    rows = [f"({S.q(r)}, {S.q(t)})" for r, t in range_map(treasury).items()]
    return "rng(relation, type) AS (VALUES " + ", ".join(rows) + ")"


CATALOG_SQL = base_ctes() + ",\n" + basic_sql() + ",\n" + edges_sql() + ",\n" + _dt_values() + ",\n" + \
    _range_values() + """,
t AS (SELECT subject, relation, object FROM bv UNION ALL SELECT subject, relation, object FROM ve)
SELECT 'property' AS kind, r.relation AS label, coalesce(d.datatype, 'string') AS type
FROM (SELECT DISTINCT relation FROM t) r LEFT JOIN dtypes d ON d.relation = r.relation
UNION ALL
SELECT kind, label, min(type) FROM (
  SELECT 'item' AS kind, subject AS label, 'Proposal' AS type FROM t
  UNION ALL
  SELECT 'item', t.object, g.type FROM t JOIN rng g ON g.relation = t.relation) x
GROUP BY kind, label
"""


@register("entity_catalog", CATALOG_SQL)
def entity_catalog(spark, sf_dir):
    """Properties with datatypes and typed items to exist."""
    from ..operators import statements as ST
    p = _p(spark, sf_dir, shared=True)
    return ST.entity_catalog(spark, basic_view1(spark, sf_dir, p=p), G.vote_edges(p),
                             ST.datatype_table(spark, TREASURY), TREASURY)


TYPED_CATALOG_SQL = CATALOG_SQL.replace("\nSELECT 'property' AS kind", ",\ncat AS (SELECT 'property' AS kind", 1) + """),
types(label) AS (SELECT 'Proposal' UNION SELECT type FROM rng),
inv(relation, inverse) AS (VALUES ('Supported By', 'Supported'), ('Opposed By', 'Opposed'),
                                  ('Abstained By', 'Abstained'), ('Proposer', 'Proposed'))
SELECT 'type' AS kind, label, 'Entity' AS type, 'A node type.' AS description, CAST(NULL AS VARCHAR) AS inverse_of FROM types
UNION ALL SELECT kind, label, type, CASE WHEN kind = 'item' THEN type END, NULL FROM cat
WHERE kind = 'property' OR label NOT IN (SELECT label FROM types)
UNION ALL SELECT 'property', inverse, 'wikibase-item', 'inverse of ' || relation, relation FROM inv
WHERE relation IN (SELECT label FROM cat WHERE kind = 'property')
  AND inverse NOT IN (SELECT label FROM cat WHERE kind = 'property')
"""


@register("typed_catalog", TYPED_CATALOG_SQL)
def typed_catalog(spark, sf_dir):
    """K11 with the type root, the range types and the inverse properties."""
    from ..operators import statements as ST
    from ..session import cut_lineage
    # read for the items, the properties and the inverse properties: written once
    return ST.typed_catalog(cut_lineage(entity_catalog(spark, sf_dir)), TREASURY)


ENSURE_SQL = base_ctes() + ",\n" + basic_sql() + ",\n" + edges_sql() + ",\n" + _range_values() + """,
t AS (SELECT subject, relation, object FROM bv UNION ALL SELECT subject, relation, object FROM ve),
items AS (SELECT DISTINCT subject AS label FROM t
          UNION SELECT t.object FROM t JOIN rng g ON g.relation = t.relation),
existing AS (SELECT label, row_number() OVER (ORDER BY CAST(('0x' || substr(md5(label), 1, 15)) AS BIGINT), label) AS number
             FROM (SELECT DISTINCT subject AS label FROM t)),
top AS (SELECT coalesce(max(number), 0) AS m FROM existing),
fresh AS (SELECT label, (SELECT m FROM top)
                 + row_number() OVER (ORDER BY CAST(('0x' || substr(md5(label), 1, 15)) AS BIGINT), label) AS number
          FROM items WHERE label NOT IN (SELECT label FROM existing))
SELECT label, 'Q' || CAST(number AS VARCHAR) AS entity_id, number FROM existing
UNION ALL SELECT label, 'Q' || CAST(number AS VARCHAR), number FROM fresh
"""


@register("ensure_entities", ENSURE_SQL)
def ensure_entities(spark, sf_dir):
    """Proposals are catalogued first; individuals, statuses and other
    ranged objects get the next ids, in md5 order of their labels."""
    from ..operators import statements as ST
    p = _p(spark, sf_dir, shared=True)
    v1, v2 = basic_view1(spark, sf_dir, p=p), G.vote_edges(p)
    cat = ST.entity_catalog(spark, v1, v2, ST.datatype_table(spark, TREASURY), TREASURY)
    items = cat.filter(F.col("kind") == "item")
    subj = v1.select(F.col("subject").alias("label")).unionByName(v2.select(F.col("subject").alias("label")))
    empty = spark.createDataFrame([], "label string, entity_id string, number long")
    existing = ST.ensure_entities(empty, subj)
    return ST.ensure_entities(existing, items.select("label"))


PATTERN_SQL = base_ctes() + ",\n" + basic_sql() + """,
g AS (SELECT subject,
             bool_or(CASE WHEN relation = 'Status' THEN object = 'F' END) AS is_f,
             max(object) FILTER (WHERE relation = 'Id') AS id,
             max(object) FILTER (WHERE relation = 'Proposer') AS proposer,
             max(object) FILTER (WHERE relation = 'Label') AS label
      FROM bv GROUP BY subject)
SELECT subject, id, proposer, label FROM g
WHERE is_f AND id IS NOT NULL AND proposer IS NOT NULL AND label IS NOT NULL
"""


@register("triple_pattern", PATTERN_SQL)
def triple_pattern(spark, sf_dir):
    """Proposals with Status = F that have an id, a proposer and a label."""
    from ..operators import statements as ST
    return ST.triple_pattern(basic_view1(spark, sf_dir), "Status", "F", ["Id", "Proposer", "Label"])


WIKI_SQL = PATTERN_SQL.replace("SELECT subject, id, proposer, label FROM g\n", """, rowsq AS (SELECT subject, id, proposer, label FROM g
""", 1) + """)
SELECT 0 AS line_no, 'Last updated: 2024-01-01' AS line
UNION ALL SELECT 1, '{| class="wikitable sortable"'
UNION ALL SELECT 2, '! Id !! Label !! Proposer'
UNION ALL SELECT 2 + row_number() OVER (ORDER BY CAST(id AS BIGINT), subject),
                 '|-' || chr(10) || '| ' || id || ' || ' || label || ' || ' || proposer FROM rowsq
UNION ALL SELECT 3 + (SELECT count(*) FROM rowsq), '|}'
"""


@register("wiki_table", WIKI_SQL)
def wiki_table(spark, sf_dir):
    """The J15 rows as wiki-table markup lines, ordered by numeric id."""
    from ..operators import statements as ST
    rows = ST.triple_pattern(basic_view1(spark, sf_dir), "Status", "F", ["Id", "Proposer", "Label"])
    rows = rows.withColumn("_n", F.col("id").cast("bigint"))
    return ST.wiki_table_lines(rows, ["id", "label", "proposer"], ["_n", "subject"], "2024-01-01")


@register("vote_totals", "WITH " + PR.LINE_SQL.strip() + ",\n" + edges_sql() + """
SELECT subject, relation, sum(weight) AS total_weight, count(*) AS n_votes FROM ve GROUP BY subject, relation
""")
def vote_totals(spark, sf_dir):
    """Summed vote weight per proposal and vote relation."""
    return G.vote_totals(G.vote_edges(_p(spark, sf_dir)))


@register("addresses", "WITH " + PR.LINE_SQL.strip() + ",\n" + edges_sql() + """
SELECT DISTINCT object AS address FROM ve WHERE starts_with(object, '0x') AND object <> '0x00000000'
""")
def addresses(spark, sf_dir):
    """distinct voter addresses, one literal skipped."""
    from ..operators.filters import addresses as addr
    return addr(G.vote_edges(_p(spark, sf_dir)), skip=["0x00000000"])


@register("relation_in", base_ctes() + ",\n" + basic_sql() + """
SELECT relation IN ('Transfer To', 'Transfer Value', 'Previous Proposal') AS multi, count(*) AS n
FROM bv GROUP BY 1
""")
def relation_in(spark, sf_dir):
    """triples split by membership in a relation list (counted)."""
    from ..operators.filters import relation_in as rin
    from ..session import cut_lineage
    v = basic_view1(spark, sf_dir)
    rels = ["Transfer To", "Transfer Value", "Previous Proposal"]
    # the triples are made and counted once, by relation; the two sides of the split read these counts
    v = cut_lineage(v.groupBy("relation").agg(F.count(F.lit(1)).alias("n")))
    total = F.coalesce(F.sum("n"), F.lit(0)).alias("n")
    a = rin(v, rels).agg(total).withColumn("multi", F.lit(True))
    b = rin(v, rels, keep=False).agg(total).withColumn("multi", F.lit(False))
    return a.unionByName(b).select("multi", "n")


# ---------------------------------------------------------------- versions: D5 / D6 / D7 / A12 / U3

MERGE_SQL = base_ctes() + ",\n" + basic_sql("o") + ",\n" + basic_sql("n", upper_title=True) + f""",
u AS (SELECT *, 0 AS version FROM ov UNION ALL SELECT *, 1 AS version FROM nv),
multi AS (SELECT * FROM u WHERE relation IN ({", ".join(S.q(r) for r in G.MULTI_VALUED + [G.debt_relations(TREASURY)[1].title()])})),
single AS (SELECT * FROM u WHERE relation NOT IN ({", ".join(S.q(r) for r in G.MULTI_VALUED + [G.debt_relations(TREASURY)[1].title()])}))
SELECT subject, relation, object FROM (
  SELECT *, row_number() OVER (PARTITION BY subject, relation, object ORDER BY version DESC, seq DESC) AS rk FROM multi)
WHERE rk = 1
UNION ALL
SELECT subject, relation, object FROM (
  SELECT *, row_number() OVER (PARTITION BY subject, relation ORDER BY version DESC, seq DESC) AS rk FROM single)
WHERE rk = 1
"""


@register("merge_graph", MERGE_SQL)
def merge_graph(spark, sf_dir):
    """D5 + U3: previous graph then a new version (labels re-extracted);
    multi-valued relations keep the last row per (subject, relation,
    object), the others the last per (subject, relation)."""
    p = _p(spark, sf_dir, shared=True)
    old = basic_view1(spark, sf_dir, p=p)
    new = basic_view1(spark, sf_dir, upper_title=True, p=p)
    return G.merge_graph(old, new, treasury=TREASURY).select("subject", "relation", "object")


def edges_seq_sql(name: str = "ves") -> str:
    return f"""{name} AS (
  SELECT subject, relation, object, weight, reason, min(seq) AS seq FROM (
    SELECT 'Proposal ' || CAST(pid AS VARCHAR) AS subject,
           CASE WHEN support THEN 'Supported By' WHEN support_detailed = 0 THEN 'Opposed By'
                WHEN support_detailed = 2 THEN 'Abstained By' END AS relation,
           split_part(vote_id, '-', 1) AS object,
           greatest(coalesce(TRY_CAST(votes AS BIGINT), 1), 1) AS weight,
           {S.strip_quotes("coalesce(reason, 'Reason not provided')")} AS reason,
           pid * 1000 + row_number() OVER (PARTITION BY pid ORDER BY pos, vote_id, support, support_detailed,
                                           votes, reason NULLS FIRST) - 1 AS seq
    FROM lines) x
  WHERE relation IS NOT NULL
  GROUP BY subject, relation, object, weight, reason)"""


@register("merge_edges", "WITH " + PR.LINE_SQL.strip() + ",\n" + edges_seq_sql() + """,
u AS (SELECT *, 0 AS version FROM ves UNION ALL
      SELECT subject, relation, object, weight * 2, reason, seq, 1 FROM ves)
SELECT subject, relation, object, weight, reason FROM (
  SELECT *, row_number() OVER (PARTITION BY subject, object ORDER BY version DESC, seq DESC) AS rk FROM u)
WHERE rk = 1
""")
def merge_edges(spark, sf_dir):
    """D5 view 2 / A12: the last edge per (proposal, voter) across an old and
    a re-weighted new version."""
    e = G.vote_edges(_p(spark, sf_dir, shared=True))
    new = e.withColumn("weight", F.col("weight") * 2)
    return G.merge_edges(e, new).select("subject", "relation", "object", "weight", "reason")


@register("keep_last", "WITH " + PR.LINE_SQL.strip() + ",\n" + edges_seq_sql() + """
SELECT subject, object, relation, weight FROM (
  SELECT *, row_number() OVER (PARTITION BY subject, object ORDER BY seq DESC) AS rk FROM ves)
WHERE rk = 1
""")
def keep_last(spark, sf_dir):
    """One edge per (proposal, voter), the last by arrival order
    (max_by aggregate, not a window over the key)."""
    e = G.vote_edges(_p(spark, sf_dir))
    return keep_by_order(e, ["subject", "object"], "seq").select("subject", "object", "relation", "weight")


@register("stack_versions", base_ctes() + ",\n" + basic_sql("o") + ",\n" + basic_sql("n", upper_title=True) + """
SELECT version, relation, count(*) AS n FROM (
  SELECT *, 0 AS version FROM ov UNION ALL SELECT *, 1 AS version FROM nv) GROUP BY version, relation
""")
def stack_versions(spark, sf_dir):
    """Old graph then new graph tagged with versions (counted per relation)."""
    from ..operators.ordering_ops import stack_versions as sv
    p = _p(spark, sf_dir, shared=True)
    u = sv(basic_view1(spark, sf_dir, p=p), basic_view1(spark, sf_dir, upper_title=True, p=p))
    return u.groupBy("version", "relation").agg(F.count(F.lit(1)).alias("n"))


SNAP_COLS = ["title", "status", "quorum", "eta", "start_block"]
SNAPSHOT_SQL = """
WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Order ' || CAST(o_orderkey AS VARCHAR) AS title,
                  o_orderstatus AS status, CAST(o_custkey % 200 AS VARCHAR) AS quorum,
                  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS eta
           FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
n AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Order ' || CAST(o_orderkey AS VARCHAR) AS title,
             CASE WHEN o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END AS status,
             CAST(o_custkey % 200 AS VARCHAR) AS quorum,
             CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS eta,
             CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey * 10 AS VARCHAR) END AS start_block
      FROM orders),
j AS (SELECT n.*, o.id AS oid, o.title AS o_title, o.status AS o_status, o.quorum AS o_quorum, o.eta AS o_eta,
             CAST(NULL AS VARCHAR) AS o_start_block FROM n LEFT JOIN o ON o.id = n.id),
d AS (SELECT *, concat_ws(',', """ + ", ".join(
    f"CASE WHEN oid IS NULL OR {c} IS DISTINCT FROM o_{c} THEN '{c}' END" for c in SNAP_COLS) + """) AS changed FROM j)
SELECT id, """ + ", ".join(f"CASE WHEN oid IS NULL OR {c} IS DISTINCT FROM o_{c} THEN {c} END AS {c}" for c in SNAP_COLS) + """,
       changed, CASE WHEN oid IS NULL THEN 'insert' ELSE 'update' END AS kind
FROM d WHERE changed <> ''
"""


@register("snapshot_diff", SNAPSHOT_SQL)
def snapshot_diff(spark, sf_dir):
    """D6 + J16: new ids give the full row; known ids give only the changed
    fields and their names; a field absent from the old version is NULL there."""
    from ..operators.state import changed_rows
    from ..sources.tables import table
    o = table(spark, sf_dir, "orders")
    old = (o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
            .select(F.col("o_orderkey").cast("string").alias("id"),
                    F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
                    F.col("o_orderstatus").alias("status"), (F.col("o_custkey") % 200).cast("string").alias("quorum"),
                    F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("eta")))
    new = o.select(F.col("o_orderkey").cast("string").alias("id"),
                   F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
                   F.when(F.col("o_totalprice") > 300000, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("status"),
                   (F.col("o_custkey") % 200).cast("string").alias("quorum"),
                   F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("eta"),
                   F.when(F.col("o_orderkey") % 2 == 0, (F.col("o_orderkey") * 10).cast("string")).alias("start_block"))
    d = changed_rows(new, old, "id")
    return d.select("id", *SNAP_COLS, F.array_join("changed", ",").alias("changed"), "kind")


MERGE_ST_SQL = TYPED_SQL.replace("SELECT subject AS entity, relation AS property, datatype,", """, st AS (
SELECT subject AS entity, relation AS property, datatype,""", 1) + """),
nw AS (SELECT 'Proposal ' || CAST(o_orderkey AS VARCHAR) AS entity, 'Status' AS property, 'wikibase-item' AS datatype,
              substr(o_orderpriority, 3) AS value, '' AS qualifiers FROM orders),
merged AS (SELECT * FROM st WHERE (entity, property) NOT IN (SELECT entity, property FROM nw)
           UNION ALL SELECT * FROM nw),
chg AS (SELECT entity FROM (SELECT * FROM st EXCEPT ALL SELECT * FROM merged)
        UNION SELECT entity FROM (SELECT * FROM merged EXCEPT ALL SELECT * FROM st))
SELECT m.entity, count(*) AS n_statements, bool_or(m.entity IN (SELECT entity FROM chg)) AS changed
FROM merged m GROUP BY m.entity
"""


@register("merge_statements", MERGE_ST_SQL)
def merge_statements(spark, sf_dir):
    """New 'Status' statements replace all old ones of that property
    (replace_all); entities whose statement set changed are flagged by an
    order-independent digest comparison of what goes with what comes."""
    from ..operators import statements as ST
    from ..sources.tables import table
    p = _p(spark, sf_dir, shared=True)
    st = ST.typed_statements(basic_view1(spark, sf_dir, p=p), G.vote_edges(p), ST.datatype_table(spark, TREASURY))
    st = st.select("entity", "property", "datatype", "value", quals_text(F.col("qualifiers")).alias("q"))
    st = st.withColumn("qualifiers", F.array(F.struct(F.lit("q").alias("prop"), F.lit("s").alias("datatype"),
                                                      F.col("q").alias("value")))).drop("q")
    from ..session import cut_lineage
    st = cut_lineage(st)   # read by the merge and for what it replaces
    o = table(spark, sf_dir, "orders")
    nw = o.select(F.concat(F.lit("Proposal "), F.col("o_orderkey").cast("string")).alias("entity"),
                  F.lit("Status").alias("property"), F.lit("wikibase-item").alias("datatype"),
                  F.substring("o_orderpriority", 3, 1 << 20).alias("value"),
                  F.array(F.struct(F.lit("q").alias("prop"), F.lit("s").alias("datatype"),
                                   F.lit("").alias("value"))).alias("qualifiers"))
    merged = ST.merge_statements(st, nw, "replace_all")
    # the statements that stay are in both digests and need none
    chg = ST.changed_entities(ST.replaced_statements(st, nw), nw).withColumn("changed", F.lit(True))
    return (merged.groupBy("entity").agg(F.count(F.lit(1)).alias("n_statements"))
                  .join(chg, "entity", "left")
                  .select("entity", "n_statements", F.coalesce("changed", F.lit(False)).alias("changed")))


@register("label_lookup", "WITH " + ENTITIES_SQL.strip() + """,
e AS (SELECT *, split_part(uri, '/', -1) AS entity_id FROM entities WHERE lang = 'en'),
p AS (SELECT label, entity_id FROM (
        SELECT *, row_number() OVER (PARTITION BY label ORDER BY seq DESC) AS rk FROM e WHERE is_property) WHERE rk = 1),
i AS (SELECT label, entity_id FROM (
        SELECT *, row_number() OVER (PARTITION BY label ORDER BY seq DESC) AS rk FROM e
        WHERE NOT is_property AND label NOT IN (SELECT label FROM p)) WHERE rk = 1)
SELECT 'property' AS kind, label, entity_id FROM p UNION ALL SELECT 'item', label, entity_id FROM i
""")
def label_lookup(spark, sf_dir):
    """S12 + U4 + X53: English label catalogues of items and properties."""
    from ..operators import statements as ST
    from ..sources import views as V
    return ST.label_lookup(V.entities(spark, sf_dir))


# ---------------------------------------------------------------- proposals <-> channels

def _links_ctx(spark, sf_dir):
    from ..sources import views as V
    return V.links(spark, sf_dir), V.channels(spark, sf_dir), V.guilds(spark, sf_dir)


def _views(*names):
    from ..sources import views as V
    return V.with_views(*names)


J4_SQL_BODY = """
j4 AS (
  SELECT pc.proposal_id, dc.channel_id AS dc_channel_id, dc.guild_id AS dc_guild_id, dc.name AS channel_name,
         dg.name AS guild_name, s.timestamp, s.interval, s.summary
  FROM links pc
  JOIN channels dc ON pc.channel_id = dc.channel_id OR (pc.channel_id IS NULL AND pc.server_id = dc.guild_id)
  JOIN guilds dg ON dg.guild_id = dc.guild_id
  JOIN summaries s ON s.channel_id = dc.channel_id
)"""


@register("disjunctive_join", _views("links", "channels", "guilds", "summaries") + "," + J4_SQL_BODY + """
SELECT proposal_id, dc_channel_id AS channel_id, channel_name, guild_name, timestamp, interval, summary FROM j4
""")
def disjunctive_join(spark, sf_dir):
    """Links to channels by channel id, or by server when the link has no
    channel - two equi-joins instead of an OR join (no cartesian product)."""
    from ..operators.joins import proposal_summaries
    from ..sources import views as V
    lk, ch, g = _links_ctx(spark, sf_dir)
    r = proposal_summaries(lk, ch, g, V.summaries(spark, sf_dir)).rows()
    return r.select("proposal_id", F.col("dc_channel_id").alias("channel_id"), "channel_name", "guild_name",
                    "timestamp", "interval", "summary")


J5_SQL_BODY = """
j5 AS (
  SELECT DISTINCT pc.proposal_id, dc.channel_id, dg.guild_id, dc.name AS channel_name, dg.name AS guild_name,
         q.question, q.answer
  FROM links pc
  JOIN channels dc ON dc.channel_id = pc.channel_id
  JOIN guilds dg ON dg.guild_id = dc.guild_id
  JOIN messages m ON m.channel_id = dc.channel_id
  JOIN qa q ON q.message_id = m.id
)"""


def _proposal_qa(spark, sf_dir, of_text=None):
    from ..operators.joins import proposal_qa
    from ..sources import views as V
    lk, ch, g = _links_ctx(spark, sf_dir)
    return proposal_qa(lk, ch, g, V.messages(spark, sf_dir), V.qa(spark, sf_dir), of_text)


@register("distinct_join", _views("links", "channels", "guilds", "messages", "questions", "qa") + "," + J5_SQL_BODY + """
SELECT * FROM j5
""")
def distinct_join(spark, sf_dir):
    """Proposal -> channel -> guild -> messages -> Q&A, DISTINCT (a NULL
    channel matches nothing here, unlike J4)."""
    return _proposal_qa(spark, sf_dir).rows().select(
        "proposal_id", "channel_id", "guild_id", "channel_name", "guild_name", "question", "answer")


K16_SQL = _views("links", "channels", "guilds", "summaries", "messages", "questions", "qa") \
    + "," + J4_SQL_BODY + "," + J5_SQL_BODY + """
SELECT proposal_id, dc_channel_id AS channel_id, dc_guild_id AS guild_id, channel_name, guild_name, timestamp, interval,
       summary, CAST(NULL AS VARCHAR) AS question, CAST(NULL AS VARCHAR) AS answer FROM j4
UNION ALL
SELECT proposal_id, channel_id, guild_id, channel_name, guild_name, NULL, NULL, NULL, question, answer FROM j5
"""


@register("union_ragged", K16_SQL)
def union_ragged(spark, sf_dir):
    """K16 + U2: the J4 and J5 frames stacked, NULL for absent columns (the
    proposal-channel export)."""
    from ..operators.joins import proposal_summaries
    from ..operators.ordering_ops import union_ragged as ur
    from ..sources import views as V
    lk, ch, g = _links_ctx(spark, sf_dir)
    a = proposal_summaries(lk, ch, g, V.summaries(spark, sf_dir)).rows().select(
        "proposal_id", F.col("dc_channel_id").alias("channel_id"), F.col("dc_guild_id").alias("guild_id"), "channel_name",
        "guild_name", "timestamp", "interval", "summary")
    return ur(a, distinct_join(spark, sf_dir))


@register("proposal_channel_export", K16_SQL)
def proposal_channel_export(spark, sf_dir):
    """The stacked frames written as CSV (S3) and read back (S2). The files
    are compressed: a text stands in them once for each proposal of its channel."""
    from ..sources import io as IO
    rows = union_ragged(spark, sf_dir)
    path = IO.scratch_path(spark, "proposal-channels")
    IO.write_csv(rows, path, compression="lz4")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return IO.read_csv(spark, path, schema, multiline=True)


@register("channel_product_sizes", _views("links", "channels", "guilds", "summaries") + "," + J4_SQL_BODY + """
SELECT dc_channel_id AS channel_id, count(*) AS pairs FROM j4 GROUP BY 1
""")
def channel_product_sizes(spark, sf_dir):
    """J4 counted for each channel from the factorised product, without a pair."""
    from ..operators.joins import proposal_summaries
    from ..sources import views as V
    lk, ch, g = _links_ctx(spark, sf_dir)
    return proposal_summaries(lk, ch, g, V.summaries(spark, sf_dir)).count() \
        .select(F.col("dc_channel_id").alias("channel_id"), "pairs")


CHANNEL_LABEL = "dg.name || ' - ' || dc.name"


@register("channel_links", _views("links", "channels", "guilds") + f""",
pl AS (SELECT DISTINCT pc.proposal_id, {CHANNEL_LABEL} AS channel_label
       FROM links pc
       JOIN channels dc ON pc.channel_id = dc.channel_id OR (pc.channel_id IS NULL AND pc.server_id = dc.guild_id)
       JOIN guilds dg ON dg.guild_id = dc.guild_id
       WHERE pc.proposal_id IN (SELECT o_orderkey FROM orders))
SELECT 'Proposal ' || CAST(proposal_id AS VARCHAR) AS entity, 'Discussion Channel' AS property, channel_label AS value
FROM pl
UNION ALL
SELECT channel_label, 'Proposal', 'Proposal ' || CAST(proposal_id AS VARCHAR) FROM pl
""")
def channel_links(spark, sf_dir):
    """K12 (+ A2, J18): proposal <-> channel statements in both directions;
    links to unknown proposals are skipped (J18 row scope)."""
    from ..functions.extract import channel_label
    from ..operators.joins import resolve_ids
    from ..sources.tables import table
    lk, ch, g = _links_ctx(spark, sf_dir)
    chl = (ch.join(g.select("guild_id", F.col("name").alias("guild")), "guild_id")
             .select("channel_id", "guild_id", channel_label(F.col("guild"), F.col("name")).alias("channel_label")))
    by_c = lk.filter(F.col("channel_id").isNotNull()).join(chl.drop("guild_id"), "channel_id")
    by_s = lk.filter(F.col("channel_id").isNull()).join(
        chl.drop("channel_id").withColumnRenamed("guild_id", "server_id"), "server_id")
    pl = by_c.select("proposal_id", "channel_label").unionByName(by_s.select("proposal_id", "channel_label")).distinct()
    known = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("entity_id"),
                                                  F.col("o_orderkey").alias("label"))
    ok, _ = resolve_ids(pl, known, "proposal_id", id_col="entity_id", out="pid")
    p = F.concat(F.lit("Proposal "), F.col("proposal_id").cast("string"))
    a = ok.select(p.alias("entity"), F.lit("Discussion Channel").alias("property"), F.col("channel_label").alias("value"))
    b = ok.select(F.col("channel_label").alias("entity"), F.lit("Proposal").alias("property"), p.alias("value"))
    return a.unionByName(b)


@register("qa_statements", _views("links", "channels", "guilds", "messages", "questions", "qa") + "," + J5_SQL_BODY + f"""
SELECT 'Proposal ' || CAST(proposal_id AS VARCHAR) AS entity, 'Question' AS property,
       {S.bounded_text('question')} AS value,
       'Channel=' || guild_name || ' - ' || channel_name
         || CASE WHEN answer IS NOT NULL THEN ';Answer=' || {S.bounded_text('answer')} ELSE '' END AS qualifiers
FROM j5 WHERE question IS NOT NULL
""")
def qa_statements(spark, sf_dir):
    """Per proposal a 'Question' statement with a channel qualifier and,
    when answered, an answer qualifier; both texts bounded (X32)."""
    from ..functions import text as T
    from ..functions.extract import channel_label

    def bounded(texts):
        answer = F.when(F.col("answer").isNotNull(), F.concat(F.lit(";Answer="), T.bounded_text(F.col("answer"))))
        return texts.filter(F.col("question").isNotNull()).select(
            "channel_id", T.bounded_text(F.col("question")).alias("value"), F.coalesce(answer, F.lit("")).alias("answered"))

    qual = F.concat(F.lit("Channel="), channel_label(F.col("guild_name"), F.col("channel_name")), F.col("answered"))
    pq = _proposal_qa(spark, sf_dir, bounded).rows({"value": F.col("value"), "qualifiers": qual})
    return pq.select(F.concat(F.lit("Proposal "), F.col("proposal_id").cast("string")).alias("entity"),
                     F.lit("Question").alias("property"), "value", "qualifiers")


@register("summary_statements", _views("channels", "guilds", "summaries") + f"""
SELECT {CHANNEL_LABEL} AS entity,
       CASE s.interval WHEN 'month' THEN 'Monthly Summary' WHEN 'week' THEN 'Weekly Summary'
                       WHEN 'day' THEN 'Daily Summary' END AS property,
       {S.bounded_text('s.summary')} AS value,
       'Channel=' || {CHANNEL_LABEL} || ';Time=+' || s.timestamp || 'T00:00:00Z' AS qualifiers
FROM summaries s JOIN channels dc ON dc.channel_id = s.channel_id JOIN guilds dg ON dg.guild_id = dc.guild_id
WHERE s.interval IN ('month', 'week', 'day')
""")
def summary_statements(spark, sf_dir):
    """K14 + X52 + X50: period summaries as statements on the channel with
    channel and time qualifiers; unknown intervals ('year') skipped."""
    from ..functions import text as T
    from ..functions.extract import channel_label, statement_time, summary_property
    from ..sources import views as V
    _, ch, g = _links_ctx(spark, sf_dir)
    s = V.summaries(spark, sf_dir).withColumn("property", summary_property(F.col("interval")))
    s = s.filter(F.col("property").isNotNull())
    j = s.join(ch.select("channel_id", F.col("name").alias("channel"), "guild_id"), "channel_id") \
         .join(g.select("guild_id", F.col("name").alias("guild")), "guild_id")
    lbl = channel_label(F.col("guild"), F.col("channel"))
    return j.select(lbl.alias("entity"), "property", T.bounded_text(F.col("summary")).alias("value"),
                    F.concat(F.lit("Channel="), lbl, F.lit(";Time="), statement_time(F.col("timestamp")))
                     .alias("qualifiers"))


@register("channel_url_statements", _views("messages", "channels", "guilds") + f"""
SELECT DISTINCT {CHANNEL_LABEL} AS entity, 'Url' AS property,
       'https://chat.example.com/channels/' || CAST(dc.guild_id AS VARCHAR) || '/' || CAST(dc.channel_id AS VARCHAR) AS value
FROM messages m JOIN channels dc ON dc.channel_id = m.channel_id JOIN guilds dg ON dg.guild_id = dc.guild_id
""")
def channel_url_statements(spark, sf_dir):
    """K15 + X51: one URL statement per distinct channel in use."""
    from ..functions.extract import channel_label
    from ..sources import views as V
    _, ch, g = _links_ctx(spark, sf_dir)
    used = V.messages(spark, sf_dir).select("channel_id").distinct()
    j = used.join(ch, "channel_id").join(g.select("guild_id", F.col("name").alias("guild")), "guild_id")
    return j.select(channel_label(F.col("guild"), F.col("name")).alias("entity"), F.lit("Url").alias("property"),
                    F.concat(F.lit("https://chat.example.com/channels/"), F.col("guild_id").cast("string"),
                             F.lit("/"), F.col("channel_id").cast("string")).alias("value"))
