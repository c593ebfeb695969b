"""Rules by a plain reading, and trees that learn from labelled URLs."""

import pytest

from subjectloom.llm import url_filter
from subjectloom.llm.url_filter import RULES, Rule, fit, judge


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:end], rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return host.translate(str.maketrans(upper, upper.lower())), tail[:stop]


def rule_of(host, path):
    best = None
    for rule in RULES:
        fits = (host == rule.host or host.endswith("." + rule.host)) and path.startswith(
            "/" + rule.path)
        if fits and (best is None or len(rule.text) > len(best.text)):
            best = rule
    return best


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.ORG/es/1", "https://example.org/en/12?x#y",
    "https://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/", "http://com/de/a",
    "http://x.com/de", "http://a.org", "http://a.org?q=/", "http://org/", "ftp://h/a://b.org/",
    "http://x.net/a\nb", "http://É.COM/de/", "http://example.org./es/", "x://y.com/fr/" * 3000,
    "http://x.com/fr/1", "http://x.com/fr/1",
]


def test_rules(spark, frame):
    rows = [(i, u, "h", "v", 1.0) for i, u in enumerate(URLS)]
    df = frame(rows, "page_id long, url string, host string, rule string, entropy double")
    got = judge(df, "url", RULES).collect()
    assert len(got) == len(URLS)
    for row in got:
        host, path = parts(row["url"])
        rule = rule_of(host, path)
        assert (row["host"], row["path"]) == (host, path), row["url"]
        assert row["rule"] == (rule.text if rule else None)
        assert row["entropy"] == 1.0
        if rule:
            assert row["verdict"] == rule.verdict
        else:
            assert row["verdict"] == ("block" if row["block_score"] >= 0.5 else "allow")


def test_trees_learn(spark):
    word = lambda i: "abcdefgh" * (i % 5) + "xyz"[: i % 4]
    bad = [(f"http://{word(i)}m{i}.buy.xyz/{word(i + 1)}{i * 97}?a=1&b={i}&c=3", 1.0)
           for i in range(300)]
    good = [(f"https://www.{word(i)}{'n' * (i % 9)}.net/{word(i + 2)}/story{'q' * (i % 13)}.html", 0.0)
            for i in range(300)]
    df = spark.createDataFrame(bad + good, "url string, label double")
    model = fit(df, "url", "label")
    unseen = [("http://zab9.buy.xyz/abcde4444?a=1&b=2&c=1",), ("https://www.other.net/news/x.html",)]
    got = model.score(spark.createDataFrame(unseen, "url string"), "url", "p").collect()
    scores = {r["url"]: r["p"] for r in got}
    assert scores[unseen[0][0]] > 0.8 > 0.2 > scores[unseen[1][0]]


@pytest.mark.parametrize("labels", [[], [1.0, 1.0], [None, 0.0]])
def test_without_two_classes(spark, labels):
    df = spark.createDataFrame([("http://a.b/c", x) for x in labels], "url string, label double")
    model = fit(df, "url", "label")
    got = model.score(spark.createDataFrame([("x",), (None,)], "url string"), "url", "p").collect()
    known = [x for x in labels if x is not None]
    assert {r["p"] for r in got} == {sum(known) / len(known) if known else 0.0}


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert judge(df, "url", [Rule("org", "", "allow")]).count() == 0


def test_entropy(spark):
    df = spark.createDataFrame([("aabb",), ("",), ("a.b/",)], "t string")
    got = [r[0] for r in df.select(url_filter._entropy(df["t"])).collect()]
    assert got == pytest.approx([1.0, 0.0, 2.0])


def test_query(spark, small):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = url_filter.op6_url_filter(spark, small).collect()
    assert len(got) == len(pages)
    for row in got:
        host, path = parts(pages[row["page_id"]])
        rule = rule_of(host, path)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule and rule.text)
        assert row["verdict"] in ("allow", "block")


def test_of_equally_long_rules_the_first_listed_counts(spark, frame):
    df = frame([("http://b.org/abc",)], "url string")
    rules = [Rule("b.org", "", "block"), Rule("org", "ab", "allow")]
    for listed in (rules, rules[::-1]):
        got = judge(df, "url", listed).first()
        assert (got["rule"], got["verdict"]) == (listed[0].text, listed[0].verdict)
