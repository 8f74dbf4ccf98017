import pytest

from checks.compare import connect, difference
from grainsieve.llm.oracles import ORACLES
from grainsieve.llm.queries import QUERIES, URL_RULES
from grainsieve.llm.urls import judge_urls, rule_table

URLS = [
    None, "", "no scheme", "http://", "http:///x", "HTTP://EXAMPLE.ORG/en/1", "http://example.org", "http://a.b.example.org/en/12?x#y",
    "http://notexample.org/es/1", "http://example.org/es/", "http://example.org?/es/", "x://y.com/fr/://z.org/", "http://fr.com/de/",
    "http://com/de/1", "http://..org/a", "http://example.org./en/1", "http://example.org/en/1", "http://example.org/en/1",
    "http://user@example.org:80/en/1", "http://\u00c9XAMPLE.org/", "http://x.net/" + "y" * 5000, "http://" + "a." * 20_000 + "example.org/es/1", "http://example.com/de/#a",
    "a\nb://c.org/d\ne",
]


def brute(url, rules, default="allow"):
    url = url or ""
    if "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [
        (len(h + p), h.count("."), verdict, h + p)
        for verdict, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


def _check(spark, urls, rules):
    rows = [(i, u, "host", "rule") for i, u in enumerate(urls)] + [(None, "http://example.org/", "h", "r")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(df, rule_table(spark, rules)).collect()}
    assert found == {r[0]: brute(r[1], rules) for r in rows}


def test_contract_rules(spark):
    _check(spark, URLS, URL_RULES)


def test_nested_and_odd_rules(spark):
    rules = [
        ("allow", "org", ""), ("block", "org", "/"), ("allow", "example.org", "/en"), ("block", "example.org", "/en/1"),
        ("block", "b.example.org", "/en/12"), ("allow", "a.b.example.org", ""), ("block", "com", "/fr"), ("allow", "com", "/fr"),
    ]
    _check(spark, URLS, rules)


def test_no_rules_and_no_rows(spark):
    rules = spark.createDataFrame([], "verdict string, host string, path string")
    df = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    assert judge_urls(df, rules).first()["verdict"] == "allow"
    assert judge_urls(df, rules, default="block").first()["verdict"] == "block"
    assert judge_urls(df.filter("false"), rules).count() == 0


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_oracle(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    assert difference(QUERIES["op6_urls"](spark, sf_dir), connect(sf_dir), ORACLES["op6_urls"]) is None
