"""Value parsers (money, numbers, wei, calldata, durations, references, logs)."""

from pyspark.sql import functions as F

from colloquy.functions import extract as X


def vals(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r["r"] for r in df.select(fn(F.col("s")).alias("r")).collect()]


def test_money(spark):
    got = vals(spark, X.get_money, ["$19,050", "$1,050,000", "$12k", "$1.5k", "19,050 USD", "USDC 12K",
                                    "50 ETH", "1.5 stETH", "50 ETH (100 USD)", "$12k and 5 ETH",
                                    "$12k or 5 ETH", "none"])
    assert got == ["$19,050", "$1,050,000", "$12k", "$1.5k", "19,050 USD", "USDC 12K", "50 ETH",
                   "1.5 stETH", "100 USD", "$12k and 5 ETH", "$12k", "none"]
    assert vals(spark, lambda c: X.get_usd(c, compat=True), ["$1,050,000"]) == ["$1,050"]


def test_to_number(spark):
    got = vals(spark, X.to_number, ["1.5k", "1.05k", "12K", "1,050", "10-20", "abc", "$12k"])
    assert got == [1500.0, 1050.0, 12000.0, 1050.0, 20.0, None, 12000.0]


def test_wei(spark):
    got = vals(spark, X.wei_to_eth, ["0", "1", "1" + "0" * 17, "1" + "0" * 18, "123455000000000000",
                                     "9" * 38])
    assert got[0] == "0.0 ETH"
    assert got[1] == "0.000000000000000001 ETH"
    assert got[2] == "0.1 ETH"
    assert got[3] == "1.0 ETH"
    assert got[4] == "0.12346 ETH"          # decimal half-up, documented
    assert got[5].startswith("99999999999999999999.") or got[5].endswith(" ETH")


def test_calldata(spark):
    got = vals(spark, X.calldata_amount, ["0x" + "0" * 48 + "00000002540be400", "0xffffffffffffffff", "0x10"])
    assert got == [10000, 18446744073709, None]


def test_duration(spark):
    got = vals(spark, X.duration_months, ["3 months", "a 3-month plan", "45 days", "8 weeks", "four weeks",
                                          "three months", "soon"])
    assert got == ["3 months", "3 months", "1 months", "2 months", "1 months", "3 months", ""]


def test_refs_and_team(spark):
    assert vals(spark, X.proposal_refs, ["prop 42, prop 23", "Prop 7", "proposal 9"]) == [[42, 23], [7], []]
    assert vals(spark, X.team_size, ["We are 3 people and 12 friends", "a team of two", "none"]) == [12, 2, None]
    assert vals(spark, X.team_name, ['The name of the team is "Archives.wtf".']) == ["Archiveswtf"]


def test_keywords_and_title(spark):
    assert vals(spark, X.keywords, ["Keywords in this proposal include art, x, Open-Source"]) == \
        [["Art", "Opensource"]]
    assert vals(spark, X.title_relation, ["executionETA", "sendOrRegisterDebt Value", "ID"]) == \
        ["ExecutionETA", "Sendorregisterdebt Value", "Id"]


def test_log_lines(spark):
    df = spark.createDataFrame([("2023-05-07 09:10:00", "bob#1234", "hi")], "ts string, a string, c string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    line = df.select(X.format_log(F.col("ts"), F.col("a"), F.col("c")).alias("l")).first()["l"]
    assert line == "05-07-2023@09:10 bob: hi"
    assert vals(spark, X.parse_log_time, ["13-07-2023@09:10"]) == [None]
    assert vals(spark, X.epoch_to_date, ["86399", "86400"]) == ["1970-01-01", "1970-01-02"]


def test_vote_relation(spark):
    df = spark.createDataFrame([(True, 1, "5"), (False, 0, None), (False, 2, "0"), (False, 1, "3")],
                               "s boolean, d int, v string")
    rows = df.select(X.vote_relation(F.col("s"), F.col("d")).alias("r"), X.vote_weight(F.col("v")).alias("w")).collect()
    assert [(r["r"], r["w"]) for r in rows] == [("Supported By", 5), ("Opposed By", 1), ("Abstained By", 1), (None, 3)]


def test_parsers_do_not_raise_and_read_number_words(spark):
    from colloquy.functions import extract as X
    from pyspark.sql import functions as F
    one = lambda v, f: spark.createDataFrame([(v,)], "s string").select(f(F.col("s"))).first()[0]
    for text, want in [("eighteen months", "18 months"), ("twenty four months", "24 months"),
                       ("thirty-six months", "36 months"), ("next month we plan, three months total", "3 months"),
                       ("12345678901 months", ""), ("eight weeks", "2 months"), ("a month", "")]:
        assert one(text, X.duration_months) == want, text
    for text, want in [("a team of twenty one people", 21), ("12345678901 people", None), ("5 to 7 people", 7)]:
        assert one(text, X.team_size) == want, text
    assert one("99999999999999999", X.epoch_to_date) is None and one("86400", X.epoch_to_date) == "1970-01-02"
    assert one("prop 99999999999999999999999 prop 12", X.proposal_refs) == [None, 12]
    for text, want in [("NaN", None), ("Infinity", None), ("1e25", "10000000000000000000000000.0"),
                       ("-1.5e30", "-1500000000000000000000000000000.0"), ("1.25e-20", "0.0000000000000000000125"),
                       ("459703", "459703.0"), ("0.000000000000012345", "0.000000000000012345"), ("0", "0.0")]:
        assert one(text, X.render_number) == want, text


def test_type_reply_tail_before_keywords(spark):
    from colloquy.functions import extract as X
    from pyspark.sql import functions as F
    got = spark.createDataFrame([("Keywords: art-dev, x-ray\ndesign",)], "s string").select(
        X.type_reply(F.col("s")).alias("t"), X.keywords(X.type_reply(F.col("s"))).alias("k")).first()
    assert got["t"] == "art,dev, x,ray design" and got["k"] == ["Art", "Dev", "Ray design"]


def test_skipped_address_has_no_inverse_statement(spark):
    from colloquy.operators.statements import inverse_statements
    v1 = spark.createDataFrame([("p1", "Proposed By", "0xbobatea"), ("p1", "Proposed By", "0x12")],
                               "subject string, relation string, object string")
    v2 = spark.createDataFrame([], "subject string, relation string, object string, weight long, reason string")
    assert {r["entity"] for r in inverse_statements(spark, v1, v2).collect()} <= {"0x12"}


def test_numbers_in_words_of_any_size(spark):
    for text, n in [("one hundred and twenty people", 120), ("We are Twenty-five", 25), ("two thousand three hundred and four", 2304),
                    ("one million two hundred thousand", 1_200_000), ("a hundred", 100), ("nobody", None), ("zero", 0),
                    ("ninety-nine hundred", 9900), ("we are one", 1), ("5 people, one hundred", 5)]:
        assert spark.createDataFrame([(text,)], "s string").select(X.team_size(F.col("s"))).first()[0] == n, text
    for text, m in [("one hundred months", "100 months"), ("in one hundred and four weeks", "26 months"), ("weeks", "")]:
        assert spark.createDataFrame([(text,)], "s string").select(X.duration_months(F.col("s"))).first()[0] == m, text


def test_wei_beyond_any_type(spark):
    from decimal import ROUND_HALF_UP, Decimal, getcontext
    getcontext().prec = 80
    for v in ["9" * 41, "1" * 41, "12345678901234567890123" + "499995" + "0" * 12, "9" * 28 + "999994" + "9" * 12, "0" * 30 + "1" * 15,
              "1" + "0" * 50]:
        d = (Decimal(v) / 10 ** 18).quantize(Decimal("0.00001"), ROUND_HALF_UP)
        text = f"{d:f}".rstrip("0")
        want = (text + "0" if text.endswith(".") else text) + " ETH"
        assert spark.createDataFrame([(v,)], "s string").select(X.wei_to_eth(F.col("s"))).first()[0] == want, v
