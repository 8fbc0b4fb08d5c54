from __future__ import annotations

import itertools

from ledgerlake.llm import url_rules as u

RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
URLS = [
    "http://Sub.Example.ORG/en/12?x#y", "https://example.org/es/", "https://example.org/ES/", "http://notexample.org/es/1", "http://a.com/fr/x",
    "http://a.com/de/", "http://a.com/de", "http://com/de/1", "//a.com/de/1", "mailto:x", None, "", "x://y://z.org/a", "http://org", "http://org?x=1",
    "http://org/", "http://a.org:80/", "ftp://a.net/q?A=1&b=2&&c", "http://É.ORG/é/1", "http://user@b.org/en/1\n2", "http://b.com#f/de/", "http://b.com/de/?q",
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = []
    for rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(rule)
    return host, path, max(fits, key=len) if fits else None


def test_given_rules_equal_plain_ones(spark):
    frame = spark.createDataFrame([(i, x, "c") for i, x in enumerate(URLS)], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "url string, label string")
    for r in u.judge(frame, labels).collect():
        host, path, rule = plain(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
        assert r.verdict == (RULES[rule] if rule else "allow")


def labelled_urls():
    for n in range(60):
        yield f"http://casino{n % 3}.example.net/win/{n}?page={n}", "block" if n % 10 else "allow"
        yield f"http://news{n % 5}.example.net/story/{n}", "allow"
        yield f"http://news{n % 5}.example.net/win/{n}", "allow" if n % 2 else "block"


def test_mined_rules_equal_counting(spark):
    labelled = spark.createDataFrame(list(labelled_urls()), "url string, label string")
    host, path = u.host_and_path(labelled["url"])
    rows = labelled.select(u.url_tokens(labelled["url"], host, path).alias("tokens"), "label")
    mining = u.Mining(support=0.01, rows=20, confidence=0.8, lift=1.1)
    got = {(tuple(r.tokens), r.verdict): (r.n_rows, round(r.confidence, 9)) for r in u.mine_rules(rows, mining).collect()}
    data = [(set(r.tokens), r.label) for r in rows.collect()]
    wanted = {}
    every = sorted({t for s, _ in data for t in s})
    for size in range(1, len(every) + 1):
        for combination in itertools.combinations(every, size):
            has = [label for s, label in data if s.issuperset(combination)]
            for label in ("allow", "block"):
                n = has.count(label)
                share = sum(x == label for _, x in data) / len(data)
                if n >= 20 and n / len(has) >= 0.8 and n / len(has) / share >= 1.1:
                    wanted[combination, label] = (n, round(n / len(has), 9))
    assert got == wanted and got


def test_mined_rules_decide_where_no_given_one_fits(spark):
    labelled = spark.createDataFrame(list(labelled_urls()), "url string, label string")
    pages = spark.createDataFrame(
        [(1, "http://casino1.example.net/win/77?page=4"), (2, "http://news1.example.net/story/9"), (3, "http://casino1.example.com/fr/win/1?page=1"), (1, "http://casino1.example.net/win/77?page=4"), (None, None)],
        "page_id long, url string",
    )
    got = sorted([(r.page_id, r.verdict, r.mined_rule is not None) for r in u.judge(pages, labelled).collect()], key=repr)
    assert got == sorted([(1, "block", True), (1, "block", True), (2, "allow", True), (3, "allow", False), (None, "allow", False)], key=repr)


def test_a_rare_host_is_blocked_in_a_large_label_table(spark):
    rare = [(f"http://casino.example.net/win/{n}", "block") for n in range(25)]
    other = [(f"http://news{n % 7}.example.net/story/{n}", "allow") for n in range(6000)]
    labelled = spark.createDataFrame(rare + other, "url string, label string")
    pages = spark.createDataFrame([(1, "http://casino.example.net/win/99"), (2, "http://news1.example.net/story/1")], "page_id long, url string")
    got = {r.page_id: (r.verdict, r.mined_rule) for r in u.judge(pages, labelled).collect()}
    assert got[1][0] == "block" and got[1][1] is not None and got[2][0] == "allow"


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert u.judge(pages, spark.createDataFrame(list(labelled_urls()), "url string, label string")).collect() == []
