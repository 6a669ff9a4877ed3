import re

import pytest

from geoloom.llm import urlfilter as U
from geoloom.llm.query_urlfilter import LABELLED, RULES


@pytest.fixture(scope="module")
def model(spark):
    return U.train(U.labelled_urls(spark, LABELLED))


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    m = re.match(r"(?s)([^/?#]*)([^?#]*)", rest)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]


def longest(host, path):
    best = None
    for rule, verdict in RULES:
        own, _, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1?x#y", "https://example.com", "https://example.com/en/", "http://xexample.com/en/a",
    "http://a.net/es/1", "http://net/fr/", "http://a.net/ES/", "x://É.net/fr/ü\n#", "http://a://b/c", "http://org", "https://casino-win.example.org/en/3",
    "https://m.cheap-pills.example.net/de/3", "https://www.city-garden.example.org/en/3", "http://" + "a" * 30_000 + ".org/" + "b" * 30_000,
]


def test_hosts_paths_rules_and_verdicts(spark, model):
    df = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(URLS)], "page_id bigint, url string, host string, verdict string")
    got = {r["page_id"]: r for r in U.judge(df.union(df), model, RULES).collect()}
    assert len(got) == len(URLS)
    for k, u in enumerate(URLS):
        r, (host, path) = got[k], split(u)
        assert (r["host"], r["path"]) == (host, path)
        best = longest(host, path)
        assert r["rule"] == (best[0] if best else None)
        assert r["verdict"] in ("allow", "block")
        if best:
            assert r["verdict"] == best[1]
    assert [got[k]["verdict"] for k in (14, 15, 16)] == ["block", "block", "allow"]
    assert U.judge(df.limit(0), model, RULES).count() == 0


def test_model_separates_unseen_hosts(spark, model):
    bad = [f"https://{s}{h}.example.org/fr/{k}" for k, (s, h) in enumerate([("", "casino-royal"), ("m.", "pills-shop"), ("www.", "adult-club"), ("blog.", "bets-now")])]
    good = [f"https://{s}{h}.example.org/de/{k}" for k, (s, h) in enumerate([("", "thereading"), ("m.", "mountain-school"), ("www.", "tionther"), ("blog.", "handther")])]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(bad + good)], "page_id bigint, url string")
    got = [r["verdict"] for r in U.judge(df, model, ()).orderBy("page_id").collect()]
    assert got == ["block"] * 4 + ["allow"] * 4


def test_no_python_on_the_main_path(spark, model, capsys):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    plan = U.judge(df, model, RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow(?!Eval)", plan.replace("Scan ExistingRDD", ""))
