import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmill.llm.queries import URL_RULES
from docmill.llm.url_cascade import Bloom, Rule, build_cascade, hashed, judge_urls


def split(url):
    before, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:end], rest[end:]
    stop = min([path.find(c) for c in "?#" if c in path], default=len(path))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host.translate(lower), path[:stop]


def judge(url, rules, default="allow"):
    host, path = split(url)
    fitting = [
        r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fitting, key=lambda r: (len(r.key), len(r.host), r.verdict == "block"), default=None)
    return host, path, best and best.key, best.verdict if best else default


URLS = [
    None, "", "no mark", "http://", "http://ORG/", "https://Example.ORG/en/1?x=/", "http://a.example.org/en/12",
    "http://example.org/es/", "http://example.org/es", "http://example.org#/es/", "http://xexample.org/es/a",
    "ftp://com/fr/x://y", "http://a.b.com/de/é", "http://com./fr/", "http://..com/de/", "http://org?/", "a://org/\nb",
    "http://ORG.com/fr", "http://é.org/", "http://example.org/en/1" + "9" * 5000,
]


def test_urls_and_rules(spark):
    rng = random.Random(3)
    hosts = ["org", "a.org", "example.org", "b.example.org", "com", "x.com", "net"]
    urls = URLS + [
        f"http://{rng.choice(hosts)}/{rng.choice(['es', 'en', 'fr', 'de', ''])}/{rng.randrange(30)}" for _ in range(400)
    ]
    rows = [(i if i % 17 else None, u, "x", "y") for i, u in enumerate(urls)] + [(3, urls[3], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, _keys string")
    found = judge_urls(pages, URL_RULES).collect()
    got = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in found)
    want = []
    for i, u, *_ in rows:
        host, path, rule, verdict = judge(u, URL_RULES)
        want.append((str(i), host, path, str(rule), verdict))
    assert got == sorted(want)


def test_many_rules_and_no_rules(spark):
    rng = random.Random(5)
    rules = list({(v, f"h{rng.randrange(60)}.com", f"/{rng.randrange(9)}") for v in ("allow", "block") for _ in range(150)})
    listed = {}
    for v, h, p in sorted(rules):
        listed[h, p] = Rule(v, h, p)  # no key on both lists
    urls = [(i, f"http://w.h{rng.randrange(80)}.com/{rng.randrange(99)}") for i in range(2000)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, list(listed.values()), default="block").collect()}
    assert found == {i: judge(u, list(listed.values()), "block") for i, u in urls}
    assert {r.verdict for r in judge_urls(pages, []).collect()} == {"allow"}
    assert judge_urls(pages.filter("false"), URL_RULES).collect() == []


def test_cascade_is_exact_over_its_universe(spark):
    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63, (20_000, 2))
    universe = spark.createDataFrame([tuple(map(int, k)) for k in keys], "_h1 long, _h2 long")
    listed = spark.createDataFrame([tuple(map(int, k)) for k in keys[:700]], "_h1 long, _h2 long")
    cascade = build_cascade(listed, universe)
    found = cascade.contains(np.ascontiguousarray(keys).view(np.uint64))
    assert found[:700].all() and not found[700:].any()
    assert len(cascade.levels) > 1
    assert sum(b.bits for b in cascade.levels) < 20 * 700


def test_filter_has_no_false_negatives():
    pairs = np.random.default_rng(2).integers(0, 2**64 - 1, (500, 2), dtype=np.uint64)
    bloom = Bloom(500, 0.01, 0)
    bloom.add(pairs)
    assert bloom.passes(pairs).all()


def test_too_many_rules(spark, monkeypatch):
    monkeypatch.setattr("docmill.llm.url_cascade.MAX_RULES", 2)
    with pytest.raises(ValueError):
        judge_urls(spark.createDataFrame([(1, "http://a/")], "page_id long, url string"), URL_RULES)


def test_hosts_of_very_many_labels(spark):
    """A host of a megabyte costs about what its reading costs."""
    host = "a." * 500_000 + "example.org"
    rows = [(1, f"https://{host}/es/x"), (2, f"https://{'b.' * 4000}com/de/"), (3, "https://org/"), (4, "https://.../")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    rules = [Rule("block", "example.org", "/es/"), Rule("block", "com", "/de/"), Rule("allow", "org", "/")]
    judge_urls(df.filter("page_id = 3"), rules).collect()  # warm
    start = time.perf_counter()
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(df, rules).collect()}
    assert got == {
        1: ("example.org/es/", "block"), 2: ("com/de/", "block"), 3: ("org/", "allow"), 4: (None, "allow")
    }
    assert time.perf_counter() - start < 30


def test_the_second_hash_is_no_function_of_the_first(spark):
    one, two = spark.range(1).select(*hashed(F.lit("k"))).first()
    assert two != spark.range(1).select(F.xxhash64(F.lit("k"), F.lit(1))).first()[0] and one != two
