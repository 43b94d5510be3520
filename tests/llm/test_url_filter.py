"""URL filters: parts and rules against plain Python, joined rules against inline ones, features, odd tables."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scholarspark.llm import url_filter as uf
from scholarspark.llm.common import literal_table
from scholarspark.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.01"
ODD = [None, "", "no scheme", "http://", "HTTPS://WWW.Example.COM/en/a?x=1#f", "http://a.b.net/es/1", "http://net/es/", "http://xnet/es/",
       "http://example.com", "http://example.com/", "http://example.com?x=/en/", "a://b://c.com/en/", "http://example.com/EN/", "x\n://y.com/\n/z",
       "http://www.example.com/en", "http://www.example.com/en/", "http://u.example.com/en/", "http://ÉX.com/é😀"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def rule_of(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r["host"] or host.endswith("." + r["host"])) and path.startswith(r["path"])]
    best = max(fits, key=lambda r: (len(r["host"] + r["path"]), len(r["host"])), default=None)
    return (host, path, best and best["host"] + best["path"], best and best["verdict"])


@pytest.mark.parametrize("inline", [uf.INLINE_RULES, 0])
def test_parts_and_rules(spark, inline):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(ODD)], "page_id int, url string, rule string")
    rules = literal_table(spark, URL_RULES, "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["rule_verdict"]) for r in uf.match_rules(df, rules, inline=inline).collect()}
    assert got == {i: rule_of(u, URL_RULES) for i, u in enumerate(ODD)}


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    got = {r["page_id"]: r for r in QUERIES["op13_url_filter"](spark, SF).collect()}
    assert len(got) == len(pages)
    for p in pages:
        host, path, rule, verdict = rule_of(p["url"], URL_RULES)
        r = got[p["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ("allow", "block")
        assert verdict is None or r["verdict"] == verdict


def test_features(spark):
    urls = ["http://a-1.example.com/x/y.html?p=1&q=22#f", "", "https://ééé.org"]
    df = spark.createDataFrame([(u,) for u in urls], "text string").withColumns({"host": uf.url_host(F.col("text")), "path": uf.url_path(F.col("text"))})
    for r in df.select("text", *[c.alias(k) for k, c in uf.lexical_features().items()]).collect():
        t, n = r["text"], max(1, len(r["text"]))
        want = -sum(c / n * math.log2(c / n) for c in Counter(t).values())
        assert math.isclose(r["entropy"], want, abs_tol=1e-9) and math.isclose(r["digit_ratio"], sum(c in "0123456789" for c in t) / n)
    first = df.select(*[c.alias(k) for k, c in uf.lexical_features().items()]).first()
    assert (first["depth"], first["params"], first["extension"], first["fragment"], first["host_labels"]) == (2, 2, 4, 1, 3)


def test_suffix_statistics(spark):
    hosts = ["a.x.com"] * 5 + ["b.x.com"] * 2 + ["y.com", ""]
    rows = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r["host"]: [round(math.expm1(r[c])) for c in uf.SUFFIX] for r in uf.suffix_statistics(rows).collect()}
    assert got == {"a.x.com": [5, 7, 2, 8, 3], "b.x.com": [2, 7, 2, 8, 3], "y.com": [1, 1, 1, 8, 3], "": [1, 1, 1, 1, 1]}


def test_learns_held_out_labels(spark):
    """Long paths of digits are blocked, short words are not; half of the URLs are labelled."""
    rows = [(i, f"http://h{i % 7}.example.org/" + (f"{i:08d}/{i * 7:08d}?a=1&b=2" if i % 3 == 0 else "story/of-words"[: 5 + i % 9])) for i in range(600)]
    df = spark.createDataFrame(rows, "page_id int, url string")
    labels = df.where("page_id % 2 = 0").withColumn("label", (F.col("page_id") % 3 == 0).cast("int"))
    none = literal_table(spark, [], "host string, path string, verdict string")
    got = uf.judge_urls(df, none, labels=labels).where("page_id % 2 = 1").collect()
    assert sum((r["verdict"] == "block") == (r["page_id"] % 3 == 0) for r in got) >= 0.99 * len(got)


def test_odd_tables(spark):
    rules = literal_table(spark, URL_RULES, "host string, path string, verdict string")
    df = spark.createDataFrame([(i % 3 if i % 3 else None, u, 1.0, "v", "w", "f") for i, u in enumerate(ODD * 2)],
                               "page_id int, url string, score double, verdict string, text string, features string")
    out = uf.judge_urls(df, rules)
    assert out.count() == 2 * len(ODD) and {"text", "features", "page_id"} <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    assert uf.judge_urls(df.limit(0), rules).count() == 0
    long = spark.createDataFrame([(1, "http://x.org/" + "ab/" * 200_000)], "page_id int, url string")
    assert uf.judge_urls(long, rules).first()["verdict"] == "allow"              # no label at all
