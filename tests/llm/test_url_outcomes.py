"""Hosts judged by outcomes of their own pages, of their domains and from elsewhere."""

from pyspark.sql import functions as F

from ledgerlane.llm.queries import BAD_WORDS, RULES, page_outcome
from ledgerlane.llm.url_filter import run_judge, run_reputation

OUTCOMES = "host string, good boolean"


def verdicts(found):
    return {r["host"]: r["verdict"] for r in found.collect()}


def test_a_bad_host_under_a_good_domain_is_blocked(spark):
    rows = [(f"h{n}.fine.net", True) for n in range(30) for _ in range(8)] + [("bad.fine.net", False)] * 8 + [("bad.fine.net", True)]
    rows += [("a.poor.net", False)] * 20 + [("b.poor.net", False)] * 20
    urls = ["x://h1.fine.net/p", "x://bad.fine.net/p", "x://new.fine.net/p", "x://new.poor.net/p", "x://a.poor.net/p"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = verdicts(run_judge(pages, [], outcomes=spark.createDataFrame(rows, OUTCOMES)))
    assert found == {
        "h1.fine.net": "allow", "bad.fine.net": "block", "new.fine.net": "allow", "new.poor.net": "block", "a.poor.net": "block",
    }


def test_outcomes_of_the_pages_themselves(spark):
    rows = [(n, f"http://site{n % 9}.example.com/a/{n}", "<title>Some story</title>") for n in range(90)]
    rows += [(100 + n, f"http://www.cheap-pills.example.com/{n}", "<TITLE lang=x>\nOther</TITLE>") for n in range(5)]
    rows += [(200, "http://spam-farm.example.org/x", None), (201, None, "<title>Casino!</title>"), (202, None, None)]
    rows += [(203, "http://adulthood.example.com/", None), (204, "http://alphabets.example.com/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    labels = {r["page_id"]: r["good"] for r in pages.select("page_id", page_outcome().alias("good")).collect()}
    assert labels[0] and not labels[100] and not labels[200] and labels[201] is False and labels[202] is None and labels[203] and labels[204]
    found = verdicts(run_judge(pages, RULES, good=page_outcome()))
    assert found["site3.example.com"] == "allow" and found["www.cheap-pills.example.com"] == "block"
    assert found["spam-farm.example.org"] == "allow"  # by its rule
    assert all(word == word.lower() for word in BAD_WORDS)


def test_every_bad_host_of_the_pages_is_blocked(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = run_judge(pages, RULES, good=page_outcome()).where("rule IS NULL")
    bad = F.col("host").rlike("pills|adult|bets|spam")
    assert found.where(bad & (F.col("verdict") == "allow")).count() == 0
    assert found.where(~bad & (F.col("verdict") == "block") & (F.col("host") != "")).count() == 0


def test_suffixes_and_addresses(spark):
    rows = [(h, True) for h in ("a.b.co.uk", "c.b.co.uk", "1.2.3.4", "1.2.3.5", "u:p@x.y.com.au:80", "[::1]", "localhost", "")]
    df = spark.createDataFrame(rows, OUTCOMES)
    from ledgerlane.llm.url_filter import LONG_SUFFIXES, _domain, _suffix

    parts = df.select("host", _suffix(F.col("host"), LONG_SUFFIXES).alias("s")).withColumn("d", _domain(F.col("host"), F.col("s")))
    found = {r["host"]: (r["s"], r["d"]) for r in parts.collect()}
    assert found["a.b.co.uk"] == ("co.uk", "b.co.uk") and found["1.2.3.4"] == ("", "1.2.3.4") and found["[::1]"] == ("", "[::1]")
    assert found["u:p@x.y.com.au:80"] == ("com.au", "y.com.au") and found["localhost"] == ("localhost", "localhost")
    assert run_reputation(df, suffixes=()).count() == len(rows)
    assert parts.select(_suffix(F.col("host"), ()).alias("s")).first()["s"] == "uk"
