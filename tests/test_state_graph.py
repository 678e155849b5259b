"""Table changes and graph steps."""

from pyspark.sql import functions as F

from colloquy.operators import graph as G
from colloquy.operators import state as D


def test_insert_if_absent_is_idempotent(spark):
    base = spark.createDataFrame([(1, "a")], "k long, v string")
    batch = spark.createDataFrame([(1, "x", 0), (2, "b", 0), (2, "c", 1)], "k long, v string, seq int")
    once = D.insert_if_absent(base, batch, "k", order="seq")
    twice = D.insert_if_absent(once, batch, "k", order="seq")
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "b")]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_update_writes_null_and_delete_keeps_null(spark):
    base = spark.createDataFrame([(1, 5), (2, 6)], "k long, v int")
    upd = spark.createDataFrame([(1, None)], "k long, v int")
    assert sorted(map(tuple, D.update_by_key(base, upd, "k").collect())) == [(1, None), (2, 6)]
    df = spark.createDataFrame([(1, None), (2, 1), (3, 0)], "k long, flag int")
    kept = D.delete_where(df, F.col("flag") == 1).collect()
    assert sorted(r["k"] for r in kept) == [1, 3]


def test_changed_rows(spark):
    old = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], "id string, t string, s string")
    new = spark.createDataFrame([("1", "a", "x", None), ("2", "b", "z", None), ("3", "c", "w", "n")],
                                "id string, t string, s string, extra string")
    got = {r["id"]: r for r in D.changed_rows(new, old, "id").collect()}
    assert set(got) == {"2", "3"}
    assert got["2"]["changed"] == ["s"] and got["2"]["t"] is None and got["2"]["s"] == "z"
    assert got["3"]["kind"] == "insert" and got["3"]["extra"] == "n"


def _proposal(spark):
    schema = ("pid long, id string, title string, status string, createdTimestamp string, executionETA string, "
              "quorumVotes string, forVotes string, againstVotes string, abstainVotes string, "
              "proposer struct<id:string>, targets array<string>, values array<string>, "
              "signatures array<string>, calldatas array<string>, "
              "votes array<struct<id:string,support:boolean,supportDetailed:int,votes:string,reason:string>>")
    row = (7, "7", "T", "Executed", "86400", None, "10", "5", "1", "0", ("0xabc",),
           ["0xa", "0xb", "0xc", "0xd"], ["2000000000000000000", "0", "0", "5"],
           ["", "sendOrRegisterDebt(address,uint256)", "createEdition(x)", "transfer(a)"],
           ["0x", "0x" + "0" * 48 + "00000002540be400", "0x", "0x"],
           [("0x1-7", True, 1, "5", None), ("0x2-7", False, 0, "0", "no"), ("0x3-7", False, 1, "3", "odd")])
    return spark.createDataFrame([row], schema)


def test_proposal_action_and_vote_triples(spark):
    p = _proposal(spark)
    k1 = {(r["relation"], r["object"]) for r in G.proposal_triples(p).collect()}
    assert ("Proposal Submission Date", "1970-01-02") in k1 and ("quorumVotes", "10") in k1
    assert not any(r == "executionETA" for r, _ in k1)
    k2 = [(r["relation"], r["object"]) for r in G.action_triples(p, None, "Treasury").orderBy("seq").collect()]
    assert k2 == [("Transfer To", "0xa"), ("Transfer Value", "2.0 ETH"),
                  ("sendOrRegisterDebt To Treasury", "0xb"), ("sendOrRegisterDebt Value To Treasury", "10000"),
                  ("createEdition To", "0xc")]
    e = G.vote_edges(p).orderBy("seq").collect()
    assert [(r["relation"], r["object"], r["weight"], r["reason"]) for r in e] == [
        ("Supported By", "0x1", 5, "Reason not provided"), ("Opposed By", "0x2", 1, "no")]
    assert [r["vote_id"] for r in G.vote_edges(p, rejects=True).collect()] == ["0x3-7"]


def test_budget_completion_and_defaults(spark):
    t = spark.createDataFrame([("P1", "Transfer Value", "2.5 ETH", 1), ("P1", "Transfer Value", "9.0 ETH", 2),
                               ("P2", "Proposal Budget in USD", "10.0", 1), ("P2", "Proposal Budget in USD", "30.0", 2),
                               ("P2", "Team Size", "4", 3)], "subject string, relation string, object string, seq long")
    c = G.default_relation(G.complete_budgets(t))
    got = {(r["subject"], r["relation"], r["object"]) for r in c.collect()}
    assert ("P1", "Proposal Budget in ETH", "2.5") in got          # first transfer
    assert ("P2", "Proposal Budget in USD", "30.0") in got and ("P2", "Proposal Budget in USD", "10.0") not in got
    assert ("P1", "Team Size", "1") in got and ("P2", "Team Size", "1") not in got


def test_merge_graph_keeps_last(spark):
    old = spark.createDataFrame([("P", "Status", "A", 1), ("P", "Transfer To", "0x1", 2)],
                                "subject string, relation string, object string, seq long")
    new = spark.createDataFrame([("P", "Status", "B", 1), ("P", "Transfer To", "0x2", 2)],
                                "subject string, relation string, object string, seq long")
    got = {(r["relation"], r["object"]) for r in G.merge_graph(old, new).collect()}
    assert got == {("Status", "B"), ("Transfer To", "0x1"), ("Transfer To", "0x2")}


def test_normalise_and_split_budgets_single_pass(spark):
    t = spark.createDataFrame([
        ("P1", "Proposal Type", "Keywords in this proposal include art, x, Open-Source", 1),
        ("P1", "executionETA", "86400", 2),
        ("P1", "Proposal Duration", "3 months", 3),
        ("P1", "Proposal Budget", "$12k and 5 ETH and 2 stETH and nothing", 4),
        ("P1", "quorumVotes", "10", 5)], "subject string, relation string, object string, seq long")
    got = {(r["relation"], r["object"]) for r in G.split_budgets(G.normalise_types(t)).collect()}
    assert got == {("Proposal Type", "Art"), ("Proposal Type", "Opensource"),
                   ("ExecutionETA", "1970-01-02"), ("Proposal Duration in Months", "3"),
                   ("Proposal Budget in USD", "12000.0"), ("Proposal Budget in ETH", "5.0"),
                   ("Proposal Budget in stETH", "2.0"), ("Quorumvotes", "10")}


def test_typed_catalog(spark):
    from colloquy.operators.statements import typed_catalog
    cat = spark.createDataFrame([
        ("property", "Proposer", "wikibase-item"), ("property", "Supported By", "wikibase-item"),
        ("property", "Supported", "string"), ("item", "Proposal 1", "Proposal"), ("item", "Status", "Individual"),
        ("item", "0xa", "Individual")], "kind string, label string, type string")
    got = {tuple(r) for r in typed_catalog(cat).collect()}
    types = {("type", x, "Entity", "A node type.", None) for x in ("Proposal", "Individual", "Status", "Proposal Type")}
    assert got == types | {
        ("property", "Proposer", "wikibase-item", None, None), ("property", "Supported By", "wikibase-item", None, None),
        ("property", "Supported", "string", None, None), ("property", "Proposed", "wikibase-item", "inverse of Proposer", "Proposer"),
        ("item", "Proposal 1", "Proposal", "Proposal", None), ("item", "0xa", "Individual", "Individual", None)}
