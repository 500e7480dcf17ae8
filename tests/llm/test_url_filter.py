import random

from tessera.llm.url_filter import judge_urls, rules_frame


def _judge(url, rules, default):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        path = tail[:min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in rules:
        if h and p and (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h) + len(p), h.count("."), v == "block")
            if best is None or key > best[0]:
                best = (key, h + p, v)
    return host, path, best[1] if best else None, best[2] if best else default


def test_random_nested_rules(spark):
    rng = random.Random(5)
    hosts = ["org", "example.org", "a.example.org", "com", "b.com", "x.b.com", "org.com", "ample.org"]
    paths = ["/", "/e", "/es/", "/es/1", "/es/1/x", "/fr/"]
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h in hosts for p in paths if rng.random() < 0.6}.values())
    urls = [f"http://{rng.choice(['', 'www.', 'M.', 'a.'])}{rng.choice(hosts)}{rng.choice(['', '/', '/es/', '/es/1/x/y', '/e', '/fr/2'])}"
            f"{rng.choice(['', '?q=/es/', '#/fr/'])}" for _ in range(400)]
    urls += [None, "", "no scheme/es/", "x://", "://org/", "http://org", "http://ORG/?", "a://b://org/es/", "http://org/\n/é", "http://.org/",
             "http://" + "d." * 300 + "org/es/"]
    rows = [(i, u, "h", "v") for i, u in enumerate(urls + urls[:5])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, Host string, `verdict` string").repartition(4)
    got = judge_urls(pages, rules_frame(spark, rules), default="block").collect()
    assert len(got) == len(rows)
    by = dict((i, u) for i, u, *_ in rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == _judge(by[r["page_id"]], rules, "block"), r


def test_one_hot_url(spark):
    pages = spark.range(3000).selectExpr("id as page_id", "'http://www.hot.org/a/b' as url")
    rules = rules_frame(spark, [("hot.org", "/a/", "block"), ("org", "/", "allow"), ("hot.org", "/a/", "allow"), (None, "/", "allow"), ("org", None, "block"), ("org", "x", "block"), ("", "/", "block"), ("org", "/a", None)])
    rows = judge_urls(pages, rules, partitions=16).groupBy("rule", "verdict").count().collect()
    assert [tuple(r) for r in rows] == [("hot.org/a/", "block", 3000)]


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert judge_urls(pages, rules_frame(spark, [("org", "/", "allow")])).collect() == []
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    assert judge_urls(one, rules_frame(spark, [])).first()["verdict"] == "allow"


def test_long_urls_and_deep_hosts(spark):
    """A path of a million characters, a host of 5,000 labels, and a rule of 3,000."""
    deep = ".".join(["d"] * 3000) + ".org"
    rules = [("org", "/a", "allow"), ("b.org", "/" + "a" * 300, "block"), (deep, "/", "block")]
    urls = ["http://b.org/" + "a" * 1_000_000, "http://b.org/" + "a" * 299, "http://org/a" + "/x" * 300_000, "http://" + "d." * 5000 + "org/a",
            "http://" + "d." * 2999 + "org/a", "http://" + "x." * 5000 + "net/"] + [f"http://b{k}.org/a" for k in range(50)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(3)
    for r in judge_urls(pages, rules_frame(spark, rules), partitions=16).collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == _judge(urls[r["page_id"]], rules, "allow")
