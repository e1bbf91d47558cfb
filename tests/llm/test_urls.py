import random
import re

from cases import ASCII_LOWER
from conftest import SF_DIR

from contrail.llm import urls

SCHEMA = "page_id long, url string, host string, path string, rule string, verdict string, row string, part string"


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host, best = host.translate(ASCII_LOWER), None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = len(h) + len(p), len(h), v == "block"
            best = max(best, (rank, h + p, v)) if best else (rank, h + p, v)
    return host, path, *(best[1:] if best else (None, default))


def judge(spark, rows, rules):
    pages = spark.createDataFrame([(i, u, "h", "p", "r", "v", "w", "x") for i, u in rows], SCHEMA)
    found = urls.judged(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    return sorted((str(r["row"]["page_id"]), r["host"], r["path"], r["rule"] or "", r["verdict"]) for r in found.collect())


def test_random_urls_match_brute_force(spark):
    generator = random.Random(1)
    host = lambda: ".".join(generator.choice("abc") for _ in range(generator.randrange(1, 5)))
    path = lambda: "/" + "".join(generator.choice("xy/") for _ in range(generator.randrange(4)))
    rules = list({(host(), path()): generator.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules] + [("a", "/x", "allow"), ("a", "/x", "block")]
    rows = [(i, f"http://{host()}{path()}{generator.choice(['', '?q=/x', '#f'])}") for i in range(500)]
    rows += [(1000 + i, "https://HOT.a.b/x/y") for i in range(400)]
    odd = [None, "", "a.b/x", "://", "http:///x", "http://a", "http://a?x", "http://a./x", "http://.a/x", "HTTP://A.B:80/x"]
    odd += ["http://x.a.b/x" + "y" * 200_000, "http://é.A/x", "http://a\u0001.b/x", "http://ab.a/x", "x://y://a/x"]
    rows += [(2000 + i, u) for i, u in enumerate(odd)] + [(None, "http://a/x"), (2000, None)]
    want = sorted((str(i), h, p, r or "", v) for i, u in rows for h, p, r, v in [brute(u, rules)])
    assert judge(spark, rows, rules) == want


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    want = sorted((r["page_id"], *(x or "" for x in brute(r["url"], urls.RULES))) for r in pages)
    found = urls.op9_url_rules(spark, SF_DIR).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"] or "", r["verdict"]) for r in found) == want


def test_empty_tables_and_null_rules(spark):
    assert judge(spark, [], [("a", "/", "block")]) == []
    rules = [(None, "/", "block"), ("a", None, "block"), ("a", "/", None)]
    assert judge(spark, [(1, "http://a/")], rules) == [("1", "a", "/", "", "allow")]
    assert judge(spark, [(1, "http://a/")], []) == [("1", "a", "/", "", "allow")]
