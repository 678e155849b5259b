"""Knowledge graph from proposals: triples, vote edges, normalisation and
merging (K1-K8, D5, A12, A13, A16-A18, A21).

View 1 is ``(subject, relation, object STRING, seq BIGINT)``: ``seq`` is the
arrival order (proposal key * 1000 + position inside the proposal) that
"keep last" rules need. View 2 (vote edges) is ``(subject, relation,
object, weight, reason, seq)``. Numbers are rendered once, by
``extract.render_number``, so keys compare equal across stages and versions.

Every step is a projection, ``explode`` or a keyed aggregate (``max_by`` /
``min_by`` / ``max``): no window over a subject, so a subject with a huge
number of triples still aggregates partially on the map side.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import text as T
from .generate import explode_rows, posexplode_rows
from .state import keep_by_order

TRIPLE_COLS = ["subject", "relation", "object", "seq"]

# Relations kept multi-valued when graph versions are merged
# (after title casing); every other relation keeps one value per subject.
MULTI_VALUED = ["Previous Proposal", "Transfer To", "Proposal Type", "Transfer Value in ETH"]


def debt_relations(treasury: str) -> tuple[str, str]:
    """Relation names of debt actions when the budget has no word 'and'
    (``treasury`` names the receiving treasury)."""
    return f"sendOrRegisterDebt To {treasury}", f"sendOrRegisterDebt Value To {treasury}"


def _subject(pid: Column) -> Column:
    return F.concat(F.lit("Proposal "), pid.cast("string"))


def _triples(items: list[tuple[str, Column]], lists: Iterable[str] = ()) -> Column:
    """array<struct<i, j, relation, object>> in field order: one for each field,
    one for each element of the fields named in ``lists``."""
    def triple(i, j, rel, val):
        return F.struct(F.lit(i).alias("i"), j.cast("int").alias("j"), F.lit(rel).alias("relation"),
                        val.cast("string").alias("object"))

    single = F.array(*[triple(i, F.lit(0), rel, val) for i, (rel, val) in enumerate(items) if rel not in lists])
    def each(i, rel):
        return lambda x, j: triple(i, j, rel, x)

    many = [F.transform(val, each(i, rel))
            for i, (rel, val) in enumerate(items) if rel in lists]
    none = F.array().cast("array<struct<i:int,j:int,relation:string,object:string>>")
    return F.concat(single, *[F.coalesce(m, none) for m in many]) if many else single


REPLY_FIELDS = ["budget", "ptype", "duration", "team_size", "team_name", "previous", "summary"]


def wide_replies(replies: DataFrame) -> DataFrame:
    """Model replies as one column per field; accepts the long form
    (pid, field, reply) or an already wide frame."""
    if "field" not in replies.columns:
        return replies
    return replies.groupBy("pid").pivot("field", REPLY_FIELDS).agg(F.first("reply"))


def proposal_triples(proposals: DataFrame, replies: DataFrame | None = None) -> DataFrame:
    """K1 (+ M13 parsers): wide proposal rows -> triples. A NULL or empty
    value means "absent field" and gives no triple. Field order follows the
    original: ID, Proposer, Submission Date, quorumVotes, Status,
    executionETA, Label, model fields, then the three vote totals."""
    p = proposals
    if replies is not None:
        p = p.join(wide_replies(replies), "pid", "left")
    items: list[tuple[str, Column]] = [
        ("ID", F.col("id")),
        ("Proposer", F.col("proposer.id")),
        ("Proposal Submission Date", X.epoch_to_date(F.col("createdTimestamp"))),
        ("quorumVotes", F.col("quorumVotes").try_cast("bigint")),
        ("Status", F.col("status")),
        ("executionETA", F.col("executionETA")),
        ("Label", F.col("title")),
    ]
    if replies is not None:
        refs = X.proposal_refs(F.col("previous"))
        items += [
            ("Summary", X.summary_tail(F.col("summary"), F.col("summary"))),
            ("Proposal Budget", X.get_money(F.col("budget"))),
            ("Proposal Type", X.type_reply(F.col("ptype"))),
            ("Proposal Duration", X.duration_months(F.col("duration"))),
            ("Team Name", X.team_name(F.col("team_name"))),
            ("Previous Proposal", F.transform(refs, lambda r: F.concat(F.lit("Proposal "), r.cast("string")))),
            ("Team Size", F.nullif(X.team_size(F.col("team_size")), F.lit(0))),
        ]
    items += [("Supporter Count", F.col("forVotes").try_cast("bigint")),
              ("Abstain Count", F.col("abstainVotes").try_cast("bigint")),
              ("Opposer Count", F.col("againstVotes").try_cast("bigint"))]
    t = explode_rows(p, _triples(items, ["Previous Proposal"]), "t", "pid").select("pid", "t.*")
    t = t.filter(F.col("object").isNotNull() & (F.col("object") != ""))
    return t.select(_subject(F.col("pid")).alias("subject"), "relation", "object",
                    (F.col("pid") * 1000 + F.col("i") * 10 + F.col("j")).alias("seq"))


def action_triples(proposals: DataFrame, budget: DataFrame | None = None,
                   treasury: str = "Treasury") -> DataFrame:
    """K2: zipped actions -> triples. Value != '0' and a Transfer signature:
    'Transfer To' + 'Transfer Value' (X25). Value '0': sendOrRegisterDebt ->
    To/Value (with ``debt_suffix`` unless the budget text has the word
    'and'), createEdition -> To, a budget with ``\\d+bps`` -> threshold
    To/Value. ``budget``: (pid, budget) model budget text, '' when absent."""
    p = proposals.select("pid", "targets", "values", "signatures", "calldatas")
    if budget is not None:
        p = p.join(budget.select("pid", "budget"), "pid", "left")
    else:
        p = p.withColumn("budget", F.lit(""))
    a = p.select("pid", F.coalesce("budget", F.lit("")).alias("budget"),
                 F.posexplode(F.arrays_zip("targets", "values", "signatures", "calldatas")).alias("k", "a"))
    tgt, val, sig, cd = (F.col("a.targets"), F.col("a.values"), F.col("a.signatures"), F.col("a.calldatas"))
    typ = X.action_type(sig)
    has_and = F.array_contains(F.split(F.col("budget"), r"\s+"), "and")
    bps = X.bps_value(F.col("budget"))
    to_n, val_n = debt_relations(treasury)

    def pair(r1, o1, r2=None, o2=None):
        items = [F.struct(F.lit(0).alias("j"), F.lit(r1).alias("relation"), o1.cast("string").alias("object"))]
        if r2 is not None:
            items.append(F.struct(F.lit(1).alias("j"), F.lit(r2).alias("relation"), o2.cast("string").alias("object")))
        return F.array(*items)

    empty = F.array().cast("array<struct<j:int,relation:string,object:string>>")
    debt = sig.startswith("sendOrRegisterDebt")
    out = (F.when((val != "0") & (typ == "Transfer"),
                  pair("Transfer To", tgt, "Transfer Value", X.wei_to_eth(val)))
            .when((val == "0") & debt & ~has_and, pair(to_n, tgt, val_n, X.calldata_amount(cd)))
            .when((val == "0") & debt & has_and,
                  pair("sendOrRegisterDebt To", tgt, "sendOrRegisterDebt Value", X.calldata_amount(cd)))
            .when((val == "0") & sig.startswith("createEdition"), pair("createEdition To", tgt))
            .when((val == "0") & (bps != ""), pair("setProposalThresholdBPS To", tgt,
                                                  "setProposalThresholdBPS Value", bps))
            .otherwise(empty))
    t = explode_rows(a, out, "t", "pid", "k").filter(F.col("t.object").isNotNull())
    return t.select(_subject(F.col("pid")).alias("subject"), F.col("t.relation").alias("relation"),
                    F.col("t.object").alias("object"),
                    (F.col("pid") * 1000 + 500 + F.col("k") * 2 + F.col("t.j")).alias("seq"))


def vote_edges(proposals: DataFrame, rejects: bool = False) -> DataFrame:
    """K3: votes -> weighted edges (X41 voter id, X42 relation and weight,
    NULL reason -> 'Reason not provided', X31 on the reason), duplicates
    dropped. ``rejects=True`` returns the votes that match no class."""
    v = proposals.select("pid", F.posexplode("votes").alias("k", "v"))
    rel = X.vote_relation(F.col("v.support"), F.col("v.supportDetailed"))
    v = v.withColumn("relation", rel)
    if rejects:
        return v.filter(F.col("relation").isNull()).select("pid", F.col("v.id").alias("vote_id"))
    v = v.filter(F.col("relation").isNotNull())
    e = v.select(_subject(F.col("pid")).alias("subject"), "relation",
                 X.voter_id(F.col("v.id")).alias("object"),
                 X.vote_weight(F.col("v.votes")).alias("weight"),
                 T.strip_quotes(F.coalesce(F.col("v.reason"), F.lit("Reason not provided"))).alias("reason"),
                 (F.col("pid") * 1000 + F.col("k")).alias("seq"))
    return keep_by_order(e, ["subject", "relation", "object", "weight", "reason"], "seq", last=False)


def normalise_types(pairs: DataFrame) -> DataFrame:
    """K4: 'Proposal Type' -> one triple per keyword (X30); other relations
    title-cased (X38), executionETA epoch -> date, 'Proposal Duration' ->
    months number (X54) renamed 'Proposal Duration in Months'. One pass:
    every row yields an array of objects (keywords, or its one value)."""
    is_pt = F.col("relation") == "Proposal Type"
    # a column of its own: title casing is slow, and used in every branch below
    pairs = pairs.withColumn("_title", F.initcap("relation")).withColumn("_rel", X.from_title(F.col("_title")))
    rel = F.col("_rel")
    one = (F.when(rel == "ExecutionETA", X.epoch_to_date(F.col("object")))
            .when(rel == "Proposal Duration", X.deadline_months(F.col("object")))
            .otherwise(F.col("object")))
    objs = F.when(is_pt, X.keywords(F.col("object"))).otherwise(F.array(one))
    new_rel = (F.when(is_pt, F.lit("Proposal Type"))
                .when(rel == "Proposal Duration", F.lit("Proposal Duration in Months")).otherwise(rel))
    x = posexplode_rows(pairs, objs, "j", "object", "subject", new_rel.alias("relation"), "seq")
    return x.select("subject", "relation", "object", (F.col("seq") * 100 + F.col("j")).alias("seq"))


def split_budgets(pairs: DataFrame) -> DataFrame:
    """K5: 'Proposal Budget' text -> USD / ETH / stETH triples. The text is
    split on the word ' and '; each piece is classified ('$'/'USD' -> USD,
    'ETH' without 'stETH' -> ETH, 'stETH' -> stETH) and parsed (X24);
    unparseable pieces are dropped. Other triples pass through (one pass)."""
    is_b = F.col("relation") == "Proposal Budget"
    pieces = F.when(is_b, F.split(F.col("object"), " and ")).otherwise(F.array(F.col("object")))
    x = posexplode_rows(pairs, pieces, "j", "piece", "subject", "relation", "seq", is_b.alias("_b"))
    pc = F.col("piece")
    cls = (F.when(pc.contains("$") | pc.contains("USD"), F.lit("Proposal Budget in USD"))
            .when(pc.contains("ETH") & ~pc.contains("stETH"), F.lit("Proposal Budget in ETH"))
            .when(pc.contains("stETH"), F.lit("Proposal Budget in stETH")))
    x = x.withColumn("_n", F.when(F.col("_b"), X.to_number(pc)))
    out = x.select("subject",
                   F.when(F.col("_b"), cls).otherwise(F.col("relation")).alias("relation"),
                   F.when(F.col("_b"), X.render_number(F.col("_n"))).otherwise(pc).alias("object"),
                   (F.col("seq") + F.col("j")).alias("seq"), "_b", "_n")
    keep = ~F.col("_b") | (F.col("relation").isNotNull() & F.col("_n").isNotNull())
    return out.filter(keep).drop("_b", "_n")


def complete_budgets(pairs: DataFrame) -> DataFrame:
    """K6: A17 then A13. A subject without 'Proposal Budget in ETH' that has
    a 'Transfer Value' gets a budget from its first transfer (ETH, else
    USD); then USD and ETH budgets keep their largest value per subject."""
    per = pairs.groupBy("subject").agg(
        F.max(F.when(F.col("relation") == "Proposal Budget in ETH", 1)).alias("_has_eth"),
        F.min_by(F.col("object"), F.when(F.col("relation") == "Transfer Value", F.col("seq"))).alias("_tv"),
        F.max("seq").alias("_seq"))
    tv = F.col("_tv")
    add = (per.filter(F.col("_has_eth").isNull() & tv.isNotNull())
              .select("subject",
                      F.when(tv.contains("ETH"), F.lit("Proposal Budget in ETH"))
                       .when(tv.contains("USD"), F.lit("Proposal Budget in USD")).alias("relation"),
                      F.when(tv.contains("ETH"), X.render_number(strip_num(tv, "ETH")))
                       .when(tv.contains("USD"), X.render_number(strip_num(tv, "USD"))).alias("object"),
                      (F.col("_seq") + 1).alias("seq"))
              .filter(F.col("relation").isNotNull()))
    allp = pairs.unionByName(add)
    budget_rel = F.col("relation").isin("Proposal Budget in USD", "Proposal Budget in ETH")
    top = (allp.filter(budget_rel).groupBy("subject", "relation")
               .agg(F.max_by(F.struct("object", "seq"), F.col("object").cast("double")).alias("_b"))
               .select("subject", "relation", F.col("_b.object").alias("object"), F.col("_b.seq").alias("seq")))
    return allp.filter(~budget_rel).unionByName(top)


def strip_num(c: Column, unit: str) -> Column:
    return T.strip(F.replace(c, F.lit(unit), F.lit(""))).try_cast("double")


def numeric_values(pairs: DataFrame) -> DataFrame:
    """K7: threshold values without 'bps' and transfer values without 'ETH'
    become numbers ('Transfer Value' is renamed 'Transfer Value in ETH');
    team names are capitalised."""
    r, o = F.col("relation"), F.col("object")
    obj = (F.when(r == "Setproposalthresholdbps Value", X.render_number(strip_num(o, "bps")))
            .when(r == "Transfer Value", X.render_number(strip_num(o, "ETH")))
            .when(r == "Team Name", X.capitalize(o)).otherwise(o))
    rel = F.when(r == "Transfer Value", F.lit("Transfer Value in ETH")).otherwise(r)
    return pairs.select("subject", rel.alias("relation"), obj.alias("object"), "seq")


def default_relation(pairs: DataFrame, relation: str = "Team Size", value: str = "1") -> DataFrame:
    """Add (subject, relation, value) for subjects lacking the relation."""
    subj = pairs.groupBy("subject").agg(F.max(F.when(F.col("relation") == relation, 1)).alias("_h"),
                                        F.max("seq").alias("_s"))
    add = subj.filter(F.col("_h").isNull()).select(
        "subject", F.lit(relation).alias("relation"), F.lit(value).alias("object"), (F.col("_s") + 2).alias("seq"))
    return pairs.unionByName(add)


def raise_budget(pairs: DataFrame) -> DataFrame:
    """A18 (opt-in; had no effect in the original): a budget smaller than the
    first transfer value of the same currency is raised to it."""
    per = pairs.groupBy("subject").agg(
        F.min_by(F.col("object"), F.when(F.col("relation") == "Transfer Value in ETH", F.col("seq"))).alias("_te"),
        F.min_by(F.col("object"), F.when(F.col("relation") == "Transfer Value in USD", F.col("seq"))).alias("_tu"))
    j = pairs.join(per, "subject", "left")
    o = F.col("object").cast("double")
    obj = (F.when((F.col("relation") == "Proposal Budget in ETH") & (F.col("_te").cast("double") > o), F.col("_te"))
            .when((F.col("relation") == "Proposal Budget in USD") & (F.col("_tu").cast("double") > o), F.col("_tu"))
            .otherwise(F.col("object")))
    return j.select("subject", "relation", obj.alias("object"), "seq")


def graph_view1(proposals: DataFrame, replies: DataFrame | None = None,
                treasury: str = "Treasury", with_raise: bool = False,
                materialize: bool = True) -> DataFrame:
    """K8: K1 + K2, then K4, K5, K6, K7, A16, X31 on objects, A2 distinct.

    The per-subject steps (K6, A16) aggregate the triple table and join the
    result back; without a cut, every such step would re-plan and re-run
    everything upstream. With ``materialize`` the triple table is written to
    the shared checkpoint folder after K5 and after K6 (reliable, survives
    executor loss), so each stage reads a finished table."""
    from ..session import cut_lineage
    budget = None
    if replies is not None:
        budget = X.with_money(wide_replies(replies), "budget", "_usd", "_eth", "_money").select(
            "pid", F.col("_money").alias("budget"))
    t = proposal_triples(proposals, replies).unionByName(action_triples(proposals, budget, treasury))
    t = split_budgets(normalise_types(t))
    if materialize:
        t = cut_lineage(t)
    t = complete_budgets(t)
    if materialize:
        t = cut_lineage(t)
    t = default_relation(numeric_values(t))
    if with_raise:
        t = raise_budget(t)
    t = t.withColumn("object", T.strip_quotes(F.col("object")))
    return keep_by_order(t, ["subject", "relation", "object"], "seq", last=False)


def merge_graph(old: DataFrame, new: DataFrame, multi: Iterable[str] | None = None,
                treasury: str = "Treasury") -> DataFrame:
    """D5 (view 1): old then new (U3). Multi-valued relations keep the last
    row per (subject, relation, object); the others the last per (subject,
    relation). Order = (version, seq). One keyed aggregate: the object is
    part of the key only for multi-valued relations. The triples of one
    subject meet in one task."""
    multi = list(multi) if multi is not None else (
        MULTI_VALUED + [debt_relations(treasury)[1].title()])
    u = (old.withColumn("version", F.lit(0)).unionByName(new.withColumn("version", F.lit(1))))
    # plain rows are moved, by subject: those of one subject stand together then and compress well. Sorted by a hash for
    # partial aggregates, of which few rows meet, and doubled as such, they took three times the disk
    u = u.repartition("subject").withColumn("_k", F.when(F.col("relation").isin(multi), F.col("object")))
    return keep_by_order(u, ["subject", "relation", "_k"], ["version", "seq"], by_hash=True).drop("_k")


def merge_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    """D5 (view 2): last edge per (subject, object) across versions."""
    u = old.withColumn("version", F.lit(0)).unionByName(new.withColumn("version", F.lit(1)))
    return keep_by_order(u, ["subject", "object"], ["version", "seq"], by_hash=True)


def vote_totals(edges: DataFrame) -> DataFrame:
    """A21 check: summed weight per subject and vote relation."""
    return edges.groupBy("subject", "relation").agg(F.sum("weight").alias("total_weight"),
                                                    F.count(F.lit(1)).alias("n_votes"))
