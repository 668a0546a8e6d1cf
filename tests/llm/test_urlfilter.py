import random

from linedocs.llm import urlfilter


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[:min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    best = None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0, 0, "", ""), (len(h + p), h.count("."), h + p, v))
    return (host, path, best[2] if best else None, best[3] if best else default)


def rules_frame(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def test_nested_rules_as_brute_force(spark):
    rng = random.Random(2)
    labels, segments = ["a", "b", "org", "x-y", "é"], ["", "/", "/p", "/p/", "/p/q", "/p/q/r", "/é", "/\U0010ffffz"]
    rules = {}
    for _ in range(60):
        host = ".".join(rng.choice(labels) for _ in range(rng.randint(1, 3)))
        rules[host, rng.choice(segments)] = rng.choice(["allow", "block"])
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [(i, "http" + "://" + ".".join(rng.choice([*labels, "ORG"]) for _ in range(rng.randint(1, 4))) + rng.choice(segments)
             + rng.choice(["", "s", "?q=/p", "#/p", "/\n"])) for i in range(800)]
    urls += [(900, None), (901, "no scheme"), (902, "://"), (903, "http://"), (904, "ftp://a?b://org/p"), (904, "ftp://a?b://org/p")]
    frame = spark.createDataFrame(urls, "page_id long, url string").repartition(5)
    got = urlfilter.judge(spark, frame, rules_frame(spark, rules)).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"], rules), r["url"]


def test_odd_tables(spark, odd_docs):
    none = rules_frame(spark, [])
    frame = odd_docs.withColumnRenamed("text", "url")
    out = urlfilter.judge(spark, frame, none, default="block")
    assert {(r["rule"], r["verdict"]) for r in out.collect()} == {(None, "block")} and out.count() == frame.count()
    assert urlfilter.judge(spark, frame.where("false"), rules_frame(spark, [("a", "/", "allow")])).count() == 0
    both = rules_frame(spark, [("a", "/", "allow"), ("A", "/", "block"), (None, "/", "allow"), ("b", None, "allow")])
    page = spark.createDataFrame([("http://a/x",)], "url string")
    assert urlfilter.judge(spark, page, both).first()["verdict"] == "block"
