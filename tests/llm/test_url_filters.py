import random

from pyspark.sql import functions as F

from sentrylake.llm import url_filters


def plain_verdict(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min([path.index(c) for c in "?#" if c in path] + [len(path)])]
    fit = [(h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fit:
        return host, path, None, default
    h, p, v = max(fit, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2]))
    return host, path, h + p, v


def check(spark, urls, rules, parts=None):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    pages = pages.withColumns({"host": F.lit("clash"), "key": F.lit(1)}).repartition(3)
    table = spark.createDataFrame(rules, "host string, path string, verdict string").withColumn("top", F.lit(0))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts or before)
        got = url_filters.judge(pages, table)
        rows = {r.page_id: tuple(r)[1:] for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = {i: plain_verdict(u, [r for r in rules if None not in r]) for i, u in enumerate(urls)}
    assert rows == want
    return want


def test_nested_rules_against_every_rule(spark):
    rng = random.Random(1)

    def host():
        return ".".join(rng.choices(["a", "b", "ab", "com", "é"], k=rng.randrange(1, 5)))

    def path(most):
        return "".join(rng.choices(["/", "a", "b", "/a", "ü", "%"], k=rng.randrange(most)))

    rules = [(host(), path(4), rng.choice(["allow", "block"])) for _ in range(150)]
    rules += [(None, "/", "block"), ("a", None, "block"), ("a", "/", None), ("b.com", "/a", "allow"), ("b.com", "/a", "block")]
    urls = [f"http://{host()}{path(6)}{rng.choice(['', '?q=/a', '#x'])}" for _ in range(1500)]
    urls += ["https://A.COM/ab", "http://É.com/a", None, "", "a.com/a", "://", "x://a.com", "x://a.com?/a", "x://a.com.",
             "x://.com/a", "x://a..com/", "x://a.com:80/a", "x://u@a.com/a", "x:///a", "x://b.com://a.com/a", "x://a\nb/\n"]
    for parts in (1, 4, 13):
        want = check(spark, urls, rules, parts)
    assert len({w[2] for w in want.values()}) > 30


def test_hot_host_and_repeated_urls(spark):
    rules = [("com", "", "block"), ("hot.com", "/a", "allow"), ("hot.com", "/a/b", "block")]
    urls = ["http://www.hot.com/a/b/c"] * 700 + [f"http://hot.com/a/{i}" for i in range(700)] + ["http://com"] * 100
    check(spark, urls, rules, 11)


def test_rule_side_edges(spark):
    urls = ["http://a.com/x", None, "http://a.com/x"]
    assert {w[3] for w in check(spark, urls, []).values()} == {"allow"}
    check(spark, [], [("com", "/", "block")])
    check(spark, urls + ["http://x./", "y"], [("", "", "block")])
    check(spark, ["http://a.com/" + "x" * 100_000 + "/y"], [("com", "/" + "x" * 99_999, "block"), ("com", "/x", "allow")])


def test_many_pages_of_the_query_rules(spark):
    rng = random.Random(4)
    hosts = ["example.com", "www.example.com", "m.example.com", "b.org", "x.net", "net", "com", "notexample.com"]
    urls = [f"https://{rng.choice(hosts)}{rng.choice(['', '/'])}{rng.choice(['en/', 'es/', 'fr', 'fr/1', 'de/'])}" for _ in range(400)]
    check(spark, urls, list(url_filters.RULES))
