"""Regression tests for the round-1 performance rewrites."""

from pyspark.sql import functions as F

from colloquy.operators.chunks import chunk_span
from colloquy.operators.joins import proposal_qa
from colloquy.session import cut_lineage


def test_proposal_qa_equals_distinct_over_the_product(spark):
    links = spark.createDataFrame([(1, 10, 0), (1, 10, 0), (2, 11, 0), (3, None, 0), (4, 12, 0)],
                                  "proposal_id long, channel_id long, server_id long")
    # channels 10 and 11 share a name in the same guild: they are two channels all the same
    channels = spark.createDataFrame([(10, "gen", 1), (11, "gen", 1), (12, "dev", 2)],
                                     "channel_id long, name string, guild_id long")
    guilds = spark.createDataFrame([(1, "A"), (2, "B")], "guild_id long, name string")
    messages = spark.createDataFrame([(100, 10), (101, 11), (102, 12), (103, 10)], "id long, channel_id long")
    qa = spark.createDataFrame([(100, "q?", "a"), (101, "q?", "a"), (102, "x", None), (103, "q2", "b")],
                               "message_id long, question string, answer string")
    got = [tuple(r) for r in proposal_qa(links, channels, guilds, messages, qa).rows()
           .select("proposal_id", "channel_id", "guild_id", "channel_name", "guild_name", "question", "answer").collect()]
    brute = (links.filter(F.col("channel_id").isNotNull())
             .join(channels.withColumnRenamed("name", "channel_name"), "channel_id")
             .join(guilds.withColumnRenamed("name", "guild_name"), "guild_id")
             .join(messages, "channel_id").join(qa.withColumnRenamed("message_id", "id"), "id")
             .select("proposal_id", "channel_id", "guild_id", "channel_name", "guild_name", "question", "answer").distinct())
    exp = [tuple(r) for r in brute.collect()]
    assert len(got) == len(set(got)) and set(got) == set(exp)


def test_chunk_without_stamp_has_null_span(spark):
    df = spark.createDataFrame([("no stamps here",), ("01-02-2024@03:04 a: x 05-06-2024@07:08",)], "t string")
    a, b = chunk_span(F.col("t"))
    rows = df.select(a.alias("a"), b.alias("b")).collect()
    assert (rows[0]["a"], rows[0]["b"]) == (None, None)
    assert (rows[1]["a"], rows[1]["b"]) == ("01-02-2024@03:04", "05-06-2024@07:08")


def test_cut_lineage_writes_into_the_checkpoint_folder(spark):
    df = spark.range(10).withColumn("y", F.col("id") * 2)
    cut = cut_lineage(df)
    base = spark.sparkContext.getCheckpointDir().replace("file:", "")
    files = cut.inputFiles()
    assert files and all(base in f for f in files)
    assert sorted(r["y"] for r in cut.collect()) == [2 * i for i in range(10)]
