"""URL filters against a plain version that looks for each term by itself."""

import random
import re

from slotweave.llm import url_filters as U
from slotweave.llm.queries import QUERIES

from .conftest import FOLDER


def plain_version(url):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in U.RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.host + r.path), default=None)
    found = {t for t in U.VOCABULARY if re.search(rf"(?<![a-z0-9]){re.escape(t.text)}(?![a-z0-9])", low)}
    n_strict, n_soft = sum(t.strict for t in found), sum(not t.strict for t in found)
    verdict = rule.verdict if rule else "block" if n_strict or n_soft >= 2 else "allow"
    return host, path, rule and rule.host + rule.path, verdict, n_strict, n_soft, ",".join(sorted(t.text for t in found))


def test_op12(spark):
    rows = QUERIES["op12_url_filters"](spark, FOLDER).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    assert len(rows) == len(urls) and {r.verdict for r in rows} == {"allow", "block"}
    for r in rows:
        assert tuple(r)[1:] == plain_version(urls[r.page_id])


def test_odd_urls(spark):
    rng = random.Random(2)
    words = [t.text for t in U.VOCABULARY] + ["net", "example", "com", "en", "de", "org", "fr", "é", "İ", "x1"]
    urls = [None, "", "://", "a://", "example.net/en/", "http://EXAMPLE.NET/en/x", "http://xexample.net/en/", "http://net", "http://net/",
            "http://a.net?x=/en/", "http://a.example.com/de", "http://a.example.com/de/#casino", "http://b.org/fr/casino", "x://a://b/c",
            "http://u:p@h.net:80/", "http://a/\nb?c", "http://casino1.com/", "http://1casino.com", "http://x-casino-y.com", "HTTP://A.COM/CASINO",
            "http://a.com/cheap/cheap", "http://a.com/cheap/free", "http://a.com/cheap-pills2", "y" * 200_000 + " casino"]
    urls += ["".join(rng.choice(words) + rng.choice(["", ".", "/", "-", "://", "?", "#"]) for _ in range(rng.randint(1, 9))) for _ in range(500)]
    urls += urls[:3]
    table = spark.createDataFrame(
        [(k if k % 7 else None, u, "x", 1, "h") for k, u in enumerate(urls)], "page_id long, url string, host string, fitting int, hits string")
    rows = U.judge(table).drop("n_hits").collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, (tuple(r)[1:] for r in rows))) == sorted(map(key, map(plain_version, urls)))
    assert sorted(str(r.page_id) for r in rows) == sorted(str(k if k % 7 else None) for k in range(len(urls)))
    assert U.judge(table.where("false")).collect() == []


def test_hits_of_all_places_and_other_vocabularies(spark):
    table = spark.createDataFrame([(1, "http://a/bad-bad/badly"), (2, "http://a/Bad")], "page_id int, url string")
    got = U.judge(table, rules=(), vocabulary=(U.Term("BAD", False), U.Term("bad-bad", True)), soft_limit=3).collect()
    assert [(r.verdict, r.n_strict, r.n_soft, r.n_hits) for r in sorted(got)] == [("block", 1, 1, 3), ("allow", 0, 1, 1)]
    assert [r.verdict for r in U.judge(table, rules=(), vocabulary=()).collect()] == ["allow", "allow"]
    tie = (U.Rule("block", "a.b", "/"), U.Rule("allow", "b", "/xx"), U.Rule("allow", "b", "/x"))
    got = U.judge(spark.createDataFrame([(1, "q://a.b/xx")], "page_id int, url string"), rules=tie).collect()
    assert (got[0].rule, got[0].verdict) == ("a.b/", "block")
