import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from check_queries import compare, connect
from pulsemill.llm.url_filter import (
    URL_SQL, allowed_pages, blocks_for, bloom_blocks, canonical_url, judge_urls, listed_by_name, passes_filter,
)

COLUMNS = ["page_id", "host", "path", "rule", "verdict"]
PAGES = "page_id long, url string, host string, verdict string, listed string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "v", "l") for i, u in enumerate(urls)], PAGES)


def judged(spark, urls, listed=(), **more):
    rows = judge_urls(spark, pages(spark, urls), spark.createDataFrame([(u,) for u in listed], "u string"), **more)
    return {r["page_id"]: (r["host_"], r["path"], r["rule"], r["verdict_"]) for r in rows.collect()}


URLS = [
    None, "", "no scheme/en/", "https://www.example.com/en/a", "http://EXAMPLE.com/en/a?x=1", "http://sub.example.com/de/", "http://a.net/es/x",
    "http://a.net/fr", "http://a.net/fr/", "ftp://net/fr/", "http://notnet/fr/", "http://a.com", "http://a.com#/x", "http://x.org/a://b",
    "http://İ.ORG/É?#", "http://u@casino-x.example.org:443/a/?utm_source=f&b=2&a=1#t", "https://www.casino-x.example.org/a?a=1&b=2",
    "http://casino-x.example.org/a?a=1", "http://casino-x.example.net/fr/1", "://", "http://casino-x.example.org/a?ref=1&&b=2&a=1",
    "http://long.org/" + "p/" * 100_000, "http://" + "a." * 20_000 + "org/x", "http://x.org/line\nbreak?\nq",
]


def test_against_sql(spark):
    for sf_dir in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        got = e.queries()["op11_url_filter"](spark, sf_dir).toPandas()
        assert compare(got, connect(sf_dir).sql(e.oracle_sql()["op11_url_filter"]).df()) == "ok"
    assert set(got[got["rule"].isna()]["verdict"]) == {"allow", "block"}


def test_odd_urls_against_sql(spark):
    con = duckdb.connect()
    con.register("pages", pd.DataFrame([(i, u) for i, u in enumerate(URLS * 2)], columns=["page_id", "url"]))
    rows = pages(spark, URLS * 2)
    got = judge_urls(spark, rows, listed_by_name(rows)).select("page_id", F.col("host_").alias("host"), "path", "rule", F.col("verdict_").alias("verdict"))
    assert compare(got.toPandas(), con.sql(URL_SQL.format(table="pages")).df()) == "ok"


def test_longest_rule(spark):
    got = judged(spark, URLS)
    assert [got[i][2:] for i in (3, 4, 5, 6, 7, 8, 9, 10)] == [
        ("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("com/", "allow"), ("net/es/", "block"), (None, "allow"),
        ("net/fr/", "block"), ("net/fr/", "block"), (None, "allow"),
    ]
    assert got[0] == got[1] == got[2] == ("", "", None, "allow") and got[12][:2] == ("a.com", "") and got[13][:2] == ("x.org", "/a://b")


def test_list_decides_where_no_rule_fits(spark):
    listed = ["casino-x.example.org/a?a=1&b=2", "a.net/fr/", "a.com", None, "casino-x.example.org/a?a=1&b=2"]
    got = judged(spark, URLS, listed)
    assert {i for i in got if got[i][3] == "block" and got[i][2] is None} == {11, 12, 15, 16, 20}  # a.com has no path, so com/ does not fit
    assert judged(spark, URLS, listed, rules=[])[11][3] == "block"


def test_filter_loses_nothing_and_the_join_removes_false_positives(spark):
    listed = spark.range(3_000).select(F.concat(F.lit("listed.org/"), "id").alias("listed"))
    tried = listed.select(F.col("listed").alias("key")).unionByName(spark.range(3_000).select(F.concat(F.lit("free.org/"), "id").alias("key")))
    for blocks in (1, 64, blocks_for(3_000)):
        rows = passes_filter(tried, "key", "possible", listed, blocks)
        n = {r["hit"]: r["n"] for r in rows.groupBy(F.col("key").startswith("listed").alias("hit")).agg(F.count_if("possible").alias("n")).collect()}
        assert n[True] == 3_000 and bloom_blocks(listed, blocks).count() <= blocks
    assert n[False] < 60  # about 16 bits a URL
    # A filter of one block passes nearly all; the verdicts stay exact.
    few = pages(spark, [f"http://free.org/{i}" for i in range(50)] + [f"http://listed.org/{i}" for i in range(50)])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("pulsemill.llm.url_filter.blocks_for", lambda n: 1)
        assert judge_urls(spark, few, listed).where("verdict_ = 'block'").agg(F.min("page_id"), F.count("*")).first()[:] == (50, 50)


def test_allowed_pages_and_empty_tables(spark):
    rows, none = pages(spark, URLS), spark.createDataFrame([], "u string")
    assert allowed_pages(spark, rows, none).columns == rows.columns
    assert allowed_pages(spark, rows, none).count() == judge_urls(spark, rows, none).where("verdict_ = 'allow'").count()
    assert judge_urls(spark, rows.limit(0), none).collect() == []


def test_one_spelling(spark):
    same = ["http://www.A.org:80/x/?b=2&utm_campaign=z&a=1#f", "https://a.org/x?a=1&b=2", "ftp://u:p@a.org/x//?a=1&&b=2&ref=q"]
    df = spark.createDataFrame([(u,) for u in same], "url string")
    assert {r[0] for r in df.select(canonical_url(F.col("url"))).collect()} == {"a.org/x?a=1&b=2"}


def test_stays_in_the_jvm(spark, plan_of):
    plan = plan_of(e.queries()["op11_url_filter"](spark, "/root/testdata/sf0.001"))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian"))
