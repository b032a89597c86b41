from paperlake.llm import url_graph as U

PAGES = "page_id long, url string, html string"


def test_hosts_paths_and_rules(spark):
    urls = ["http://a.COM/x?y#z", "https://Example.com/en/1", "http://www.example.com/en/2", "http://sub.example.com/en/3",
            "http://a.net/es/", "http://b.net/de/1", "no address", None, "http://com", "http://x.com?y=/en/", "a://b://c.com/d", "http://notcom/x"]
    rows = U.judge_urls(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)).orderBy("page_id").collect()
    assert [(r["host"], r["path"]) for r in rows[:4]] == [("a.com", "/x"), ("example.com", "/en/1"), ("www.example.com", "/en/2"), ("sub.example.com", "/en/3")]
    assert [r["rule"] for r in rows] == ["com/", "example.com/en/", "www.example.com/en/", "example.com/en/", "net/es/", None, None, None, None, None, None, None]
    assert [r["verdict"] for r in rows[:5]] == ["allow", "block", "allow", "block", "block"]
    assert [(r["host"], r["path"]) for r in rows[6:]] == [("", ""), ("", ""), ("com", ""), ("x.com", ""), ("b:", "//c.com/d"), ("notcom", "/x")]


def scores_by_hand(edges, seeds, steps):
    out = {}
    for s, d, n in edges:
        out[s] = out.get(s, 0) + n
    score = dict(seeds)
    for _ in range(steps):
        new = {h: v * (1 - U.DAMPING) for h, v in seeds.items()}
        for s, d, n in edges:
            if s in score:
                new[d] = new.get(d, 0) + score[s] * n / out[s] * U.DAMPING
        score = new
    return score


def test_distrust_goes_against_the_links(spark):
    def page(*targets):
        return "".join(f"<a href='http://{t}/p'>x</a><img src=//{t}/i>" for t in targets)

    pages = [(1, "http://good.com/", page("friend.org", "hub.org")), (2, "http://friend.org/", page("good.com")), (3, "http://spam.net/es/", page("good.com")),
             (4, "http://lure.org/", page("spam.net")), (5, "http://lure.org/2", page("SPAM.net")), (6, "http://far.org/", None), (7, "http://hub.org/", "")]
    frame = spark.createDataFrame(pages, PAGES)
    links = sorted(map(tuple, U.host_links(frame).collect()))
    assert links == [("friend.org", "good.com", 1), ("good.com", "friend.org", 1), ("good.com", "hub.org", 1), ("lure.org", "spam.net", 2), ("spam.net", "good.com", 1)]
    got = {r["host"]: r for r in U.host_verdicts(frame).collect()}
    trust = scores_by_hand(links, {"good.com": 1.0}, U.STEPS)
    distrust = scores_by_hand([(d, s, n) for s, d, n in links], {"spam.net": 1.0}, U.STEPS)
    for host, r in got.items():
        assert abs(r["trust"] - trust.get(host, 0)) < 1e-9 and abs(r["distrust"] - distrust.get(host, 0)) < 1e-9
    assert {h for h, r in got.items() if r["blocked"]} == {"spam.net", "lure.org"}
    verdicts = {r["page_id"]: r["verdict"] for r in U.judge_urls(frame).collect()}
    assert verdicts == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow"}


def test_hosts_of_one_domain_meet(spark):
    urls = ["http://shop.bad.net/es/1", "http://www.blog.bad.net/x", "http://bad.net.org/", "http://www.good.net/y", "http://10.1.2.3/", "http://10.1.2.4:80/"]
    frame = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)
    up = [("shop.bad.net", "bad.net"), ("www.blog.bad.net", "blog.bad.net"), ("blog.bad.net", "bad.net"), ("bad.net.org", "net.org"), ("www.good.net", "good.net")]
    links = sorted(map(tuple, U.host_links(frame).collect()))
    assert links == sorted([(a, b, 1) for a, b in up] + [(b, a, 1) for a, b in up])
    distrust = scores_by_hand(links, {"shop.bad.net": 1.0}, U.STEPS)
    got = {r["host"]: r for r in U.host_verdicts(frame).collect()}
    assert all(abs(r["distrust"] - distrust.get(h, 0)) < 1e-9 for h, r in got.items()) and "bad.net" not in got
    # no rule and no page links the second host: only the domain nodes explain it
    assert {h for h, r in got.items() if r["blocked"]} == {"shop.bad.net", "www.blog.bad.net"}
    assert [r["verdict"] for r in U.judge_urls(frame).orderBy("page_id").collect()] == ["block", "block"] + ["allow"] * 4
    deep = spark.createDataFrame([(1, "http://" + ".".join("a" * 20000) + ".net/", None)], PAGES)
    assert U.host_links(deep).count() == 0 and U.judge_urls(deep).first()["verdict"] == "allow"


def test_the_given_pages_have_edges(spark):
    links = U.host_links(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    assert links.count() > 0


def test_odd_pages(spark):
    rows = [(None, None, None), (1, "http://a.com/", None), (1, "http://a.com/", None), (2, "", "<a href=>")]
    frame = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' host", "'y' path", "'z' rule", "1 n", "'v' verdict")
    got = U.judge_urls(frame)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"] or set(got.columns) == {"page_id", "host", "path", "rule", "verdict"}
    assert sorted((r["page_id"] or 0, r["host"], r["verdict"]) for r in got.collect()) == [(0, "", "allow"), (1, "a.com", "allow"), (1, "a.com", "allow"), (2, "", "allow")]
    assert U.judge_urls(frame.limit(0)).count() == 0
