"""URL filter: parts of urls, rules, templates and odd input."""

import random

import duckdb
from pyspark.sql import functions as F

from compare import differences
from tierflow.llm.queries import QUERIES, RULES, SQL
from tierflow.llm.url_templates import Rule, host_of, judged, path_of

SCHEMA = "page_id bigint, url string, host string, template int"


def test_hosts_and_paths(spark):
    cases = {
        "http://A.Example.COM/x/Y?q#f": ("a.example.com", "/x/Y"), "https://h": ("h", ""), "h.com/a": ("", ""), None: ("", ""),
        "": ("", ""), "://": ("", ""), "x://h?://b": ("h", ""), "x://h#/p": ("h", ""), "ftp://É.com:80/p#x?y": ("É.com:80", "/p"),
        "http://u://v/w": ("u:", "//v/w"), "http://h/a\nb": ("h", "/a\nb"),
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    got = {r.url: (r.h, r.p) for r in df.select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p")).collect()}
    assert got == cases


def test_the_longest_fitting_rule_decides(spark):
    want = {
        "http://example.com/en/1": "example.com/en/", "http://www.example.com/en/1": "www.example.com/en/",
        "http://m.www.example.com/en/": "www.example.com/en/", "http://notexample.com/en/1": "com/", "http://example.com": None,
        "http://a.net/es/9": "net/es/", "http://a.net/en/9": None, "http://net/fr/": "net/fr/", "http://a.xnet/fr/": None,
    }
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(want)], SCHEMA)
    got = {r.row.url: (r.rule, r.verdict) for r in judged(df, RULES).collect()}
    verdict = {r.text: r.verdict for r in RULES}
    assert {u: r for u, (r, _) in got.items()} == want
    assert all(v == verdict[r] for r, v in got.values() if r)


def test_templates_generalise_merge_and_reject(spark):
    rules = [Rule("h.org", "/bad/", "block"), Rule("h.org", "/worse/", "block"), Rule("h.org", "/good/", "allow"),
             Rule("h.org", "/mixed/0", "block")]
    urls = [f"http://h.org/{part}/{word}" for part in ("bad", "worse", "good") for word in ("x1", "y2", "z3", "w4") for _ in range(5)]
    urls += [f"http://h.org/mixed/{i}" for i in range(10)] + [f"http://h.org/new/{i}" for i in range(10)]
    urls += [f"http://h.org/slug/{chr(97 + i)}{chr(97 + j)}" for i in range(5) for j in range(6)]
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], SCHEMA)
    rows = judged(df, rules).collect()
    templates = {u: {r.template for r in rows if f"/{u}/" in r.row.url} for u in ("bad", "worse", "good", "new", "slug", "mixed")}
    assert templates["bad"] == templates["worse"] == {"/~block/*"} and templates["good"] == {"/~allow/*"}
    assert templates["new"] == {"/new/*"} and templates["slug"] == {"/slug/*"}
    assert {r.verdict for r in rows if "/new/" in r.row.url} == {"allow"}
    # Blocked pages of a template weigh against its unlabelled ones.
    more = spark.createDataFrame([(i, f"http://h.org/mixed/0{i}", "h", 1) for i in range(40)] + [(99, "http://h.org/mixed/7", "h", 1)], SCHEMA)
    assert {r.verdict for r in judged(more, rules).collect()} == {"block"}


def test_segments_count_at_any_depth(spark):
    rules = [Rule("h.org", "/a/b/c/d/bad/", "block")]
    urls = [f"http://h.org/a/b/c/d/bad/{w}" for w in ("x", "y", "z") for _ in range(10)] + ["http://h.org/a/b/c/d/fine/page"]
    rows = judged(spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], SCHEMA), rules).collect()
    assert {r.verdict for r in rows if "/bad/" in r.row.url} == {"block"}
    assert [(r.verdict, r.template) for r in rows if "/fine/" in r.row.url] == [("allow", "/~block/~block/~block/~block/fine/page")]


def test_literal_segments_are_no_wildcards_or_labels(spark):
    rules = [Rule("h.org", "/bad/", "block")]
    urls = [f"http://h.org/bad/{i}" for i in range(30)] + [
        "http://h.org/~block/1", "http://h.org/*/x", "http://h.org/7/x", "http://h.org/=*/x", "http://h.org/a//b", "http://h.org/a/b",
        "http://h.org/a/b/", "http://h.org", "http://h.org/"]
    rows = judged(spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], SCHEMA), rules).collect()
    found = {r.row.url.removeprefix("http://h.org"): (r.template, r.verdict) for r in rows}
    assert found["/bad/3"] == ("/~block/*", "block") and found["/~block/1"] == ("/=~block/*", "allow")
    assert [found[u][0] for u in ("/*/x", "/7/x", "/=*/x", "/a//b", "/a/b", "/a/b/", "", "/")] == [
        "/=*/x", "/*/x", "/==*/x", "/a/=/b", "/a/b", "/a/b/=", "", ""]


def test_deep_and_branching_paths_give_the_stated_result(spark, area):
    """Random trees of up to nine levels under the registered rules, against the SQL that takes them level by level."""
    rng = random.Random(11)
    words = ["en", "es", "fr", "a", "b", "", "~block", "*", "=", "x1", "2", "long"]
    urls = [None, "no scheme", "http://", "http://m.net"] + [
        f"http://{rng.choice(['m.net', 'net', 'www.example.com', 'a.org'])}/" + "/".join(
            rng.choice(words[: rng.choice([3, 12])]) for _ in range(rng.randrange(10))) for _ in range(500)]
    urls += [f"http://a.net/{rng.choice(['es', 'fr', 'de'])}/{'x/' * 6}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], SCHEMA).repartition(3).write.parquet(f"{area}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{area}/pages.parquet/*.parquet')")
    assert differences(QUERIES["op9_url_templates"](spark, area), SQL["op9_url_templates"], con) == []


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "x", 0), (1, None, "x", 0), (None, "", "x", 0), (2, "http://" + "a/" * 20_000, "x", 0)], SCHEMA)
    out = judged(df, RULES)
    assert out.select("row.*").columns == df.columns and out.count() == 4
    assert {r.verdict for r in out.collect()} == {"allow"}
    assert judged(df.limit(0), RULES).collect() == [] and judged(df, []).count() == 4
