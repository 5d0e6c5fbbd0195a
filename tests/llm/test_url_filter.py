from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from casebook.llm import url_filter
from casebook.llm.common import Scratch

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(UPPER), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path):
    best = None
    for verdict, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return best


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, URL string")


def test_rules_agree_with_brute_force(spark):
    random.seed(1)
    hosts = ["com", "example.com", "www.EXAMPLE.com", "a.www.example.com", "notexample.com", "x.net", "net", "b.org", "", "com:80", "É.com"]
    paths = ["", "/", "/en/", "/en", "/EN/a", "/en/a/b", "/es/1", "/fr/2?x=/en/", "?q=/en/", "#/en/", "/a#b://c", "/fr/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "example.com/en/", "://com/", "a://b://com/", "http://x.net\n/es/"]
    found = url_filter.judge(frame(spark, urls)).collect()
    assert len(found) == len(urls)
    for r in found:
        host, path = split_url(urls[r.page_id])
        rule = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule[0] if rule else None)
        assert r.verdict == rule[1] if rule else r.verdict in ("allow", "block")


def paths(spark, rows):
    return spark.createDataFrame(rows, "host string, path string, n long, blocked long, labelled long")


def test_variable_segments_become_wildcards(spark):
    rows = [("h", f"/item/{i}/view", 1, 0, 0) for i in range(30)] + [("h", f"/{p}", 40, 0, 0) for p in ("about", "item/list")]
    found = {r.path: r.template for r in url_filter.templates(Scratch(spark, "t"), paths(spark, rows), 8).collect()}
    assert len({found[f"/item/{i}/view"] for i in range(30)}) == 1
    assert "*" in found["/item/3/view"]


def test_branches_with_other_labels_stay_apart(spark):
    rows = [("h", f"/good{k}/{i}", 1, 0, 1) for k in range(4) for i in range(30)]
    rows += [("h", f"/bad/{i}", 1, 1, 1) for i in range(30)] + [("h", f"/bad/new{i}", 1, 0, 0) for i in range(5)]
    found = {r.path: r.template for r in url_filter.templates(Scratch(spark, "t"), paths(spark, rows), 8).collect()}
    assert found["/bad/1"] == found["/bad/new1"]
    assert found["/bad/1"] != found["/good1/1"]


def test_purity_rejects_what_the_rules_leave_open(spark):
    urls = [f"http://s.net/es/{i}" for i in range(30)] + [f"http://s.net/other/{i}" for i in range(30)] + ["http://o.org/x"]
    rules = [("block", "net", "/es/1"), ("block", "net", "/es/2")]
    found = {r.path: r for r in url_filter.judge(frame(spark, urls), rules=rules).collect()}
    assert found["/es/7"].rule is None and found["/es/7"].verdict == "block"
    assert found["/other/7"].verdict == "allow" and found["/x"].verdict == "allow"


def test_edge_rows(spark):
    urls = [None, "", "http://h/" + "/".join("abcdefghijklmnop"), "http://h/" + "x" * 100_000] * 2
    found = url_filter.judge(frame(spark, urls)).collect()
    assert len(found) == 8
    assert any(r.template.endswith("/**") for r in found)
    assert url_filter.judge(frame(spark, urls).limit(0)).count() == 0
    assert found[0].verdict == "allow"


def test_query_and_plan(spark):
    result = url_filter.op3_url_filter(spark, "/root/testdata/sf0.001")
    assert not [w for w in ("Python", "Pandas", "Arrow") if w in result._jdf.queryExecution().toString()]
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert result.count() == pages.count()
    assert result.where(F.col("verdict").isNull() | ~F.col("verdict").isin("allow", "block")).count() == 0


def test_repeated_urls_are_judged_like_single_ones(spark):
    rules = [("block", "net", "/es/1"), ("block", "net", "/es/2")]
    for times in (1, 6):
        found = url_filter.judge(frame(spark, [f"http://s.net/es/{i}" for i in range(30)] * times), rules=rules)
        assert {(r.template, r.verdict) for r in found.collect()} == {("/es/*", "block")}


def test_branches_without_labels_are_judged_by_their_siblings(spark):
    blocked = [("block", "net", f"/b{k}/") for k in range(6)]
    urls = [f"http://s.net/b{k}/x{i}" for k in range(6) for i in range(5)] + [f"http://s.net/new/y{i}/z" for i in range(5)] + ["http://t.net/new/1"]
    found = {(r.host, r.path): r for r in url_filter.judge(frame(spark, urls), rules=blocked).collect()}
    assert found["s.net", "/new/y1/z"].rule is None and found["s.net", "/new/y1/z"].verdict == "block"
    assert found["s.net", "/new/y1/z"].purity == 7 / 8
    assert found["t.net", "/new/1"].verdict == "allow" and found["t.net", "/new/1"].purity == 0.5
    mixed = blocked[:3] + [("allow", "net", f"/b{k}/") for k in range(3, 6)]
    found = {(r.host, r.path): r for r in url_filter.judge(frame(spark, urls), rules=mixed).collect()}
    assert found["s.net", "/new/y1/z"].purity == 0.5 and found["s.net", "/new/y1/z"].verdict == "allow"
