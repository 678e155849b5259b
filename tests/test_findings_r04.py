"""Findings of round 4: each test failed on the code before."""

from pyspark.sql import functions as F

from colloquy.operators import graph as G
from colloquy.operators import product as P
from colloquy.operators import statements as ST
from colloquy.operators.joins import proposal_qa, proposal_summaries


def _fields(lists):
    return lists.schema["rows"].dataType.elementType.names


def _places(spark):
    channels = spark.createDataFrame([(10, "gen", 1), (11, "dev", 1), (12, "ops", 2), (13, "odd", 9), (None, "none", 1)],
                                     "channel_id long, name string, guild_id long")
    return channels, spark.createDataFrame([(1, "A"), (2, "B")], "guild_id long, name string")


def test_left_lists_are_long_and_few_bytes_are_moved(spark):
    """each list of texts met 512 left rows at a time"""
    left = spark.range(9000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 9 != 0, F.col("id")).alias("a"))
    right = spark.range(600).select((F.col("id") % 3).alias("k"), F.repeat(F.lit("x"), 1000).alias("b"), F.col("id").alias("c"))
    f = P.factorise(left, right, "k")
    assert f.left.count() == 2
    moved = f.left.join(f.right.withColumnRenamed("bytes", "r"), "k").agg(F.sum("r")).first()[0]
    assert moved == 400 * 1000  # every text of a key that is on both sides, once
    rows = f.rows()
    assert rows.columns == ["k", "a", "b", "c"]
    got = rows.groupBy("k").agg(F.count("*"), F.count("a"), F.countDistinct("a", "c")).collect()
    assert sorted(map(tuple, got)) == [(0, 900_000, 800_000, 800_000), (1, 900_000, 800_000, 800_000)]


def test_a_left_list_is_cut_where_a_text_is_long(spark, monkeypatch):
    """F2"""
    monkeypatch.setattr(P, "HELD_BYTES", 10_000)
    left = spark.range(50).select(F.lit(1).alias("k"), F.col("id").alias("a"), F.lit("é").alias("t"))
    right = spark.createDataFrame([(1, "x" * 3000), (1, "y"), (2, "z")], "k int, b string")
    rows = P.factorise(left, right, "k").rows()
    assert sorted((r.a, r.t, r.b[0]) for r in rows.collect()) == sorted((a, "é", b) for a in range(50) for b in "xy")
    assert "slice(" in rows._jdf.queryExecution().optimizedPlan().toString()


def test_links_of_a_server_are_held_once(spark):
    """they were copied to every channel of the server, names and all"""
    links = spark.createDataFrame([(1, 10, 2), (1, 10, 2), (2, None, 1), (3, None, None), (4, 13, 1), (5, None, 9), (6, 12, 2),
                                   (None, 11, 1), (7, None, 2)], "proposal_id long, channel_id long, server_id long")
    channels, guilds = _places(spark)
    summaries = spark.createDataFrame([(10, "d1", "s1"), (10, "d2", None), (11, "d1", "s3"), (12, "d1", "s4"), (13, "d1", "s5"),
                                       (None, "d1", "s6")], "channel_id long, timestamp string, summary string")
    f = proposal_summaries(links, channels, guilds, summaries)
    assert _fields(f.left) == ["proposal_id"]
    assert {"channel_name", "guild_name", "dc_guild_id"} <= set(f.left.columns)
    links.createOrReplaceTempView("r04_links")
    channels.createOrReplaceTempView("r04_channels")
    guilds.createOrReplaceTempView("r04_guilds")
    summaries.createOrReplaceTempView("r04_summaries")
    want = spark.sql("""SELECT proposal_id, dc.channel_id, dc.name, dg.guild_id, dg.name, timestamp, summary FROM r04_links pc
        JOIN r04_channels dc ON pc.channel_id = dc.channel_id OR (pc.channel_id IS NULL AND pc.server_id = dc.guild_id)
        JOIN r04_guilds dg ON dg.guild_id = dc.guild_id JOIN r04_summaries s ON s.channel_id = dc.channel_id""")
    got = f.rows().select("proposal_id", "dc_channel_id", "channel_name", "dc_guild_id", "guild_name", "timestamp", "summary")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
    assert {r.dc_channel_id: r.pairs for r in f.count().collect()} == {10: 6, 11: 2, 12: 2}


def test_statement_texts_are_made_once_for_a_text(spark):
    """raw and bounded texts went through the product, the qualifiers were put together for each pair"""
    links = spark.createDataFrame([(p, c, 1) for p in range(4) for c in (10, 12, None)],
                                  "proposal_id long, channel_id long, server_id long")
    channels, guilds = _places(spark)
    messages = spark.createDataFrame([(100, 10), (101, 10), (102, 12), (103, 12)], "id long, channel_id long")
    qa = spark.createDataFrame([(100, "q1", "a1"), (101, "q1", "a2"), (102, "q2", None), (103, None, "a3")],
                               "message_id long, question string, answer string")

    def made(texts):
        return texts.where("question is not null").select("channel_id", F.upper("question").alias("v"), F.lit("!").alias("w"))

    f = proposal_qa(links, channels, guilds, messages, qa, made)
    assert _fields(f.left) == ["proposal_id"] and _fields(f.right) == ["v", "w"]
    rows = f.rows({"v": F.col("v"), "said": F.concat("guild_name", F.lit(" "), "channel_name", "w")})
    assert rows.columns == ["channel_id", "guild_id", "channel_name", "guild_name", "proposal_id", "v", "said"]
    # texts that are made alike stay rows of their own
    assert sorted((r.proposal_id, r.v, r.said) for r in rows.collect()) == sorted(
        (p, *x) for p in range(4) for x in (("Q1", "A gen!"), ("Q1", "A gen!"), ("Q2", "B ops!")))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("explode(l") < plan.index("Coalesce") < plan.index("concat(guild_name")


def test_merged_graph_moves_plain_rows_by_subject(spark):
    """keys and buffers of partial aggregates were moved, in the order of a hash"""
    triples = "subject string, relation string, object string, seq long"
    old = spark.createDataFrame([("p1", "Label", "a", 1), ("p1", "Transfer To", "x", 2), ("p2", "Label", None, 1), (None, "Label", "n", 1)],
                                triples)
    new = spark.createDataFrame([("p1", "Label", "A", 1), ("p1", "Label", "B", 2), ("p1", "Transfer To", "y", 2),
                                 ("p1", "Transfer To", "x", 9), (None, "Label", "N", 0)], triples)
    m = G.merge_graph(old, new)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(subject#" in plan
    assert plan.index("partial_max_by") < plan.index("Exchange")  # the plan is read from its end
    assert sorted(map(tuple, m.select("subject", "relation", "object", "seq").collect()), key=str) == sorted(
        [("p1", "Label", "B", 2), ("p1", "Transfer To", "x", 9), ("p1", "Transfer To", "y", 2), ("p2", "Label", None, 1),
         (None, "Label", "N", 0)], key=str)


def test_replaced_statements_tell_what_a_merge_changes(spark):
    """F8: all statements were digested, before and after the merge"""
    cols = "entity string, property string, value string, qualifiers array<struct<prop:string,datatype:string,value:string>>"
    old = spark.createDataFrame([("a", "s", "1", []), ("a", "t", "9", []), ("b", "s", "1", []), ("c", "s", "1", []),
                                 ("c", "s", "1", []), ("d", "t", "1", []), ("e", "s", None, [])], cols)
    new = spark.createDataFrame([("a", "s", "2", []), ("b", "s", "1", []), ("c", "s", "1", []), ("e", "s", None, []),
                                 ("f", "s", "1", [])], cols)
    gone = ST.replaced_statements(old, new)
    assert sorted((r.entity, r.value) for r in gone.collect()) == sorted(
        [("a", "1"), ("b", "1"), ("c", "1"), ("c", "1"), ("e", None)], key=str)
    whole = ST.changed_entities(old, ST.merge_statements(old, new))
    names = lambda df: sorted(r.entity for r in df.collect())
    assert names(ST.changed_entities(gone, new)) == names(whole) == ["a", "c", "f"]
