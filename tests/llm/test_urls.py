import random

from picsift.llm import urls

SF = "/root/testdata/sf0.001"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


def verdict(url, rules, default="allow"):
    host, path = parts(url)
    best = None
    for v, rule in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (v, rule)
    return (host, path, best[1], best[0]) if best else (host, path, None, default)


ODD = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.NeT/x", "http://xnet/", "http://a.com/b.net/c", "x://example.net/en",
       "x://example.net/en/", "x://www.example.net/en/1?q=://org/fr/", "x://a.org/fr/#t", "x://org/fr/", "x://a.org?x/fr/", "a://b://c.net/d", "x://é.net/ü",
       "x://.net/", "x://example.com/de/x", "x://sub.example.com/DE/x", "x://u:p@h.net:80/", "x://h.net\n/y", "x://h.net/" + "p" * 70_000]


def test_odd_urls(spark):
    rows = urls.judge(spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(ODD)], "page_id long, url string, host string, rule string")).collect()
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == verdict(ODD[r.page_id], urls.RULES), ODD[r.page_id]
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_many_rules_over_several_words():
    rng = random.Random(4)
    names = ["a", "b", "aa", "ab", "net", "org"]
    hosts = [".".join(rng.choice(names) for _ in range(rng.randint(1, 3))) for _ in range(60)]
    rules = tuple((rng.choice(["block", "allow"]), f"{h}/{rng.choice(['', 'a/', 'ab', 'b/a/'])}") for h in hosts)
    machine = urls.compile_rules(rules)
    assert machine.take.shape[1] > 8
    asked = ["x://" + ".".join(rng.choice(names) for _ in range(rng.randint(1, 4))) + rng.choice(["", "/", "/a/", "/ab/c", "/b/a/x", "/a.net/"]) for _ in range(800)]
    won = machine.fitting(["".join(parts(u)).encode() for u in asked])
    for u, w in zip(asked, won.tolist()):
        want = verdict(u, rules)[2]
        assert (machine.rules[w] if w >= 0 else None) == want


def test_no_rules():
    assert urls.compile_rules(()).fitting([b"a/b", b""]).tolist() == [-1, -1]


def test_registered_query(spark):
    want = {r.page_id: verdict(r.url, urls.RULES) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.op9_url_filters(spark, SF).collect()}
    assert got == want and len({v[2] for v in want.values()}) > 2


def test_slices_of_a_batch(spark, monkeypatch):
    """A few URLs at a time, as with very many rules."""
    df = spark.createDataFrame(list(enumerate(ODD)), "page_id long, url string")
    whole = urls.judge(df).collect()
    monkeypatch.setattr(urls, "SLICE_WORDS", 3 * len(urls.compile_rules(urls.RULES).start))
    assert urls.judge(df).collect() == whole
    machine = urls.compile_rules(tuple(("block", f"h{i}.com/{'p' * 900}") for i in range(500)))
    assert len(machine.start) > 10_000 and (urls.SLICE_WORDS // len(machine.start) or 1) == 1
