from weftline.functions import html as H
from weftline.functions.registry import register_sql
from weftline.operators import extract, graph, robots

LONG = "word " * 60


def parse(html, **kw):
    return H.parse_page(html, **kw)


def test_title_rules():
    assert H.page_title(parse("<title> T </title><h1>H</h1>")) == "T"
    assert H.page_title(parse("<title>  </title><h1>H</h1>")) == ""
    assert H.page_title(parse("<title></title><h1>H<b>x</b></h1>")) == "H"
    assert H.page_title(parse("<p>x</p>")) == "No Title"


def test_main_text_tests_the_immediate_parent():
    page = f"<body><nav><a>Home</a>bare</nav><p>{LONG}</p><script>s()</script></body>"
    assert H.page_text(parse(page)) == ("Home " + LONG).strip()
    assert H.page_text(parse(page, exclude_subtrees=True)) == LONG.strip()


def test_main_text_leaves_out_the_areas_own_text():
    page = f"<body><article>direct<p>{LONG}</p></article><p>after</p></body>"
    assert H.page_text(parse(page)) == LONG.strip()


def test_main_text_prefers_areas_in_order_and_falls_back():
    page = f"<body><main><p>short</p></main><div class='x content'><p>{LONG}</p></div></body>"
    assert H.page_text(parse(page)) == LONG.strip()
    assert H.page_text(parse("<body><p>short</p></body>")) == ""
    assert H.page_text(parse(f"<p>{LONG}</p>")) == LONG.strip()  # no body tag


def test_comments_split_text_and_entities_are_decoded():
    page = parse(f"<body><p>a<!-- x -->b &amp; c{LONG}</p></body>")
    assert H.page_text(page).startswith("a b & c")


def test_links():
    hrefs = ["c", "/d", "#x", "e#f", "mailto:q@z", "c", "http://[bad"]
    page = parse("".join(f"<a href='{h}'>x</a>" for h in hrefs))
    assert H.page_links(page, "https://h/a/b") == ["https://h/a/c", "https://h/d"]


def test_areas_are_followed_and_not_listed(spark):
    page = "<map><area href='/m'><area></map><a href='/a'>x</a>"
    assert H.page_links(parse(page), "https://h/") == ["https://h/a"]
    pages = spark.createDataFrame([("https://h/", page)], "url string, html string")
    assert {r["dst"] for r in graph.link_edges(pages, areas=True).collect()} == {"https://h/a", "https://h/m"}


def test_unclosed_paragraphs_stay_shallow():
    page = parse("<body>" + "<p>x" * 50_000)
    assert len(page.stack) < 5


def test_page_to_document(spark):
    pages = spark.createDataFrame([
        ("https://a.b/x", f"<title>T</title><body><p>{LONG}</p><a href='/y'>y</a></body>", 2, 200),
        ("https://a.b/short", "<p>tiny</p>", 1, 200), ("https://a.b/null", None, 1, 500),
    ], "url string, html string, depth int, status_code int")
    (doc,) = extract.page_to_document(pages, "2024-01-01T00:00:00").collect()
    assert doc["id"].startswith("crawl_1704067200_") and doc["domain"] == "a.b" and doc["title"] == "T"
    assert doc["content_length"] == len(doc["content"]) and doc["links"] == ["https://a.b/y"] and doc["depth"] == 2
    assert [r["url"] for r in extract.unparsed_pages(pages).collect()] == ["https://a.b/null"]


def test_explode_links_in_sql(spark):
    register_sql(spark)
    spark.createDataFrame([("http://h/", "<a href=a></a><a href=b></a>")], "url string, html string").createOrReplaceTempView("pg")
    rows = spark.sql("SELECT l.dst FROM pg, LATERAL explode_links(pg.url, pg.html) l").collect()
    assert sorted(r["dst"] for r in rows) == ["http://h/a", "http://h/b"]


def test_reachability_depths(spark):
    edges = spark.createDataFrame([("s", "a"), ("a", "b"), ("b", "c"), ("a", "s"), ("c", "d")], "src string, dst string")
    seeds = spark.createDataFrame([("s",)], "url string")
    reach = {r["url"]: r["depth"] for r in graph.crawl_reachability(edges, seeds, 1).collect()}
    assert reach == {"s": 0, "a": 1, "b": 2}
    strict = graph.crawl_reachability(edges, seeds, 1, strict=True).collect()
    assert {r["url"] for r in strict} == {"s", "a"}
    assert graph.crawl_reachability(edges, seeds, 50).count() == 5


def test_robots_longest_rule_wins_and_allow_breaks_ties(spark):
    rules = spark.createDataFrame([("h", "/a", False), ("h", "/a/b", True), ("h", "/c", False), ("h", "/c", True)],
                                  "host string, path string, allow boolean")
    urls = spark.createDataFrame([(f"http://h{p}",) for p in ("/a", "/a/b/c", "/c/x", "/z")] + [("http://other/a",)], "url string")
    got = {r["url"] for r in robots.robots_allowed(urls, rules).collect()}
    assert got == {"http://h/a/b/c", "http://h/c/x", "http://h/z", "http://other/a"}


def test_follow_filter(spark):
    edges = spark.createDataFrame([("s", u) for u in (
        "http://a.b/x?b=1&a=2#f", "http://a.b/x?a=2&b=1", "http://c.a.b/y.pdf", "http://xa.b/z")], "src string, dst string")
    assert [r["dst"] for r in graph.follow_filter(edges, ["a.b"]).collect()] == ["http://a.b/x?a=2&b=1"]


def test_only_the_frontier_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(graph, "HUB_LINKS", 10)
    hub = [("s", f"n{i}") for i in range(200)] + [(f"n{i}", f"m{i}") for i in range(200)] + [("n3", None)]
    edges = spark.createDataFrame(hub, "src string, dst string")
    seeds = spark.createDataFrame([("s",), ("s",), (None,)], "url string")
    levels, step = [], graph.next_level

    def watched(*args):
        level = step(*args)
        levels.append(level._jdf.queryExecution().toString())
        return level

    monkeypatch.setattr(graph, "next_level", watched)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reach = {r["url"]: r["depth"] for r in graph.crawl_reachability(edges, seeds, 1).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert reach == {"s": 0} | {f"n{i}": 1 for i in range(200)} | {f"m{i}": 2 for i in range(200)}
    assert spark.sql("SHOW TABLES LIKE 'weftline_adjacency*'").count() == 0
    for plan in levels:
        lines = plan.split("== Physical Plan ==")[1].splitlines()
        for at, line in enumerate(lines):
            if "FileScan parquet" in line and "dsts" in line:
                depth = line.index("FileScan")
                above = []
                for upper in reversed(lines[:at]):  # the nodes that enclose the scan
                    indent = len(upper) - len(upper.lstrip(" :+-*()0123456789"))
                    if indent < depth:
                        above.append(upper)
                        depth = indent
                    if "Join" in upper:
                        break
                assert not any("Exchange" in node for node in above), plan


def test_robots_patterns():
    trie = robots.build_trie([("/a*b*c$", False), ("/a", True), ("/x$", False), ("/*.pdf", False), ("/y$z", False), ("*", True)])
    for target, want in (("/a1b2c", (7, False)), ("/a1b2cd", (2, True)), ("/abcc", (7, False)), ("/ac", (2, True)),
                         ("/x", (3, False)), ("/xy", (1, True)), ("/q/r.pdf?x", (6, False)), ("/y$z1", (4, False))):
        assert robots.strongest(trie, target) == want, target
    assert robots.strongest(robots.build_trie([]), "/a") is None
    assert robots.fits("ab", 0, ["ab", "b"], True) is False  # the pieces may not overlap


def test_robots_of_a_host_with_many_rules_and_urls(spark):
    rules = spark.range(10_000).selectExpr("'big' AS host", "concat('/s', id, '/*x$') AS path", "false AS allow").unionByName(
        spark.createDataFrame([("small", "/", False), ("small", "/?ok", True), ("small", "", False), (None, "/", False), ("big", "/s7/", None)],
                              "host string, path string, allow boolean"))
    big = spark.range(3000).selectExpr("concat('http://big/s', id * 4, '/', id % 3, if(id % 2 = 0, 'x', 'y')) AS url", "1 AS host")
    urls = big.unionByName(spark.createDataFrame([("http://small", 2), ("http://small?ok", 2), ("http://none/", 2), (None, 2)], "url string, host int"))
    got = {r["url"] for r in robots.robots_allowed(urls, rules, trie_rules=3000, slice_urls=500).collect()}
    gone = {f"http://big/s{i * 4}/{i % 3}x" for i in range(0, 2500, 2)} | {"http://small"}
    assert got == {r["url"] for r in urls.collect()} - gone
    assert robots.robots_allowed(urls.limit(0), rules).count() == 0
    assert robots.robots_allowed(urls, rules.limit(0)).count() == urls.count()
