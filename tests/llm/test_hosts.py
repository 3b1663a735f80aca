import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import hosts
from gaugeline.llm.hosts import judge, levels, reputations, url_parts
from tests.llm.corpora import TABLES


def test_parts_of_urls(spark):
    cases = {
        "http://A.Example.ORG/Es/x?y#z": ("a.example.org", "/Es/x"),
        "https://h?q=/a": ("h", ""), "https://h#f": ("h", ""), "x://h:80/p://q": ("h:80", "/p://q"),
        "no scheme/path": ("", ""), "://": ("", ""), "http:///p": ("", "/p"), None: ("", ""), "": ("", ""), "s://É.com/": ("É.com", "/"),
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    host, path = url_parts(df["url"])
    assert {r["url"]: (r["h"], r["p"]) for r in df.select("url", host.alias("h"), path.alias("p")).collect()} == cases


def test_longest_rule_wins(spark):
    cases = {
        "http://example.org/es/1": ("example.org/es/", "block"), "http://a.b.example.org/en/17": ("example.org/en/1", "block"),
        "http://example.org/en/2": ("org/", "allow"), "http://xexample.org/es/1": ("org/", "allow"), "http://org/": ("org/", "allow"),
        "http://a.com/fr/": ("com/fr/", "allow"), "http://com/de/x": ("com/de/", "block"), "http://a.com/de": (None, None),
        "http://borg/x": (None, None), "http://example.org": (None, None),
    }
    pages = spark.createDataFrame([(n, u) for n, u in enumerate(cases)], "page_id bigint, url string")
    none = spark.createDataFrame([], "page_id bigint, good int")
    found = {r["page_id"]: r for r in judge(pages, none).collect()}
    for n, (rule, verdict) in enumerate(cases.values()):
        assert found[n]["rule"] == rule
        assert verdict is None or found[n]["verdict"] == verdict


def test_levels(spark):
    cases = {"a.b.example.org": ("example.org", "org"), "x.co.uk": ("x.co.uk", "co.uk"), "a.x.co.uk:8080": ("x.co.uk", "co.uk"),
             "localhost": ("localhost", "localhost"), "u@h.de": ("h.de", "de")}
    df = spark.createDataFrame([(h,) for h in cases], "host string")
    domain, suffix = levels(df["host"])
    assert {r[0]: (r[1], r[2]) for r in df.select("host", domain, suffix).collect()} == cases


def test_hosts_are_drawn_towards_their_domain(spark):
    rows = [("a.good.org", "good.org", "org", 95, 100), ("b.good.org", "good.org", "org", 1, 1), ("new.good.org", "good.org", "org", 0, 0),
            ("a.bad.org", "bad.org", "org", 5, 100), ("new.bad.org", "bad.org", "org", 0, 0), ("c.mid.net", "mid.net", "net", 50, 100)]
    found = {r["host"]: r["a"] / (r["a"] + r["b"]) for r in reputations(
        spark.createDataFrame(rows, "host string, domain string, suffix string, k bigint, n bigint")).collect()}
    assert found["a.bad.org"] < found["new.bad.org"] < found["c.mid.net"] < found["new.good.org"] < 0.97
    assert found["a.bad.org"] < 0.15 and found["new.good.org"] > 0.7


def test_bad_host_is_blocked_and_unknown_follows_its_domain(spark):
    pages = [(n, f"http://bad.example.net/{n}") for n in range(100)] + [(100 + n, f"http://fine.example.net/{n}") for n in range(100)]
    pages += [(300, None), (301, "nothing"), (302, "http://other.example.net/"), (302, "http://other.example.net/")]
    good = [(n, int(n >= 100 or n % 10 == 0)) for n in range(200)] + [(None, 0), (5, None), (999, 0)]
    df = judge(spark.createDataFrame(pages, "page_id bigint, url string"), spark.createDataFrame(good, "page_id bigint, good int"))
    verdicts = {r["page_id"]: r["verdict"] for r in df.collect()}
    assert df.count() == len(pages)
    assert {verdicts[n] for n in range(100)} == {"block"} and {verdicts[n] for n in range(100, 200)} == {"allow"}
    assert verdicts[300] == verdicts[301] == "block"


def test_empty(spark):
    assert judge(spark.createDataFrame([], "page_id bigint, url string"), spark.createDataFrame([], "page_id bigint, good int")).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_rows_equal_sql(spark, sf):
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    outcomes = spark.read.parquet(f"{TABLES}/labels.parquet").selectExpr("doc_id AS page_id", "quality AS good")
    found = judge(spark.read.parquet(f"{TABLES}/pages.parquet"), outcomes).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, con.execute(hosts.SQL).fetchall()))


def test_rows_equal_sql_where_hosts_are_blocked(spark):
    """Hosts of every quality, clashing column names, null ids and several outcomes of one page."""
    chance = random.Random(4)
    pages = [(n, f"http://h{n % 40}.d{n % 9}.{('net', 'de', 'co.uk')[n % 3]}/{n}") for n in range(1500)] + [
        (None, "http://h1.d1.net/x"), (None, None), (7, "http://h0.d0.net/again"), (8, "x")]
    labels = [(n, int(chance.random() < (n % 40) / 40)) for n in range(1500) if n % 4] + [(3, 0), (3, 1), (None, 1), (9, None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR)")
    con.execute("CREATE TABLE labels(doc_id BIGINT, quality INTEGER)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", pages)
    con.executemany("INSERT INTO labels VALUES (?, ?)", labels)
    named = spark.createDataFrame(
        [(*row, "h", "p", "r", "v", 1, 2, 3.0) for row in pages],
        "page_id bigint, url string, host string, path string, rule string, verdict string, k int, n int, good_upper double")
    found = judge(named, spark.createDataFrame(labels, "page_id bigint, good int").withColumn("host", F.lit("x"))).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, con.execute(hosts.SQL).fetchall()))
    verdicts = Counter(r["verdict"] for r in found)
    assert verdicts["block"] > 300 and verdicts["allow"] > 300
