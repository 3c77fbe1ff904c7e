from siltstone.operators import html

PAGE = '<html><body><article class="node--view-mode-full"><h1>A &amp; B</h1>{}</article></body></html>'
BASE = "https://h.org/c"


def record(body, url=BASE):
    return html.page_record(PAGE.format(body), url)


def test_selectors():
    tree = html.parse('<div id="a" class="x y"><p data-k="v w"><b>t</b><br>u</p></div><p>z</p>')
    assert [n.name for n in tree.select(".x.y b")] == ["b"]
    assert len(tree.select("p")) == 2 and len(tree.select("#a p")) == 1
    assert tree.first('[data-k~="w"]').text() == "t u" and tree.first('[data-k*="v w"]') and not tree.first('[data-k="v"]')
    assert len(tree.select("b, br")) == 2


def test_text_leaves_scripts_out():
    assert html.parse("<p> a <script>x</script><i> b</i>\n</p>").text() == "a b"


def test_media_of_cards_are_not_the_pages():
    card = '<div class="node--view-mode-teaser"><source src="/x.mp3" type="audio/mp3"></div>'
    r = record(card + '<source src="/y.mp3" type="Audio/MPEG ; q"><source src=" " type="audio/mp3"><source src="/y.mp3" type="audio/mp3">')
    assert r["audios"] == ["https://h.org/y.mp3"] and r["status"] == "exploitable"


def test_validity_order():
    kind = lambda h: html.page_record(h, BASE)["error"]
    assert kind('<html><h1>Just a moment...</h1></html>') == "refused"
    assert kind("<h1>Challenge accepted</h1><main>x</main>") is None
    assert kind('<img src="/q/bot_challenge.png?1"><h1>x</h1><main></main>') == "refused"
    assert kind("<main>x</main>") == "no title" and kind("<h1>x</h1>") == "no content"
    assert kind("<html><h1>x</h1><main></main>") == "truncated" and kind("<html><h1>x</h1><main></main></HTML >") is None
    assert kind(None) == "no title"


def test_roots():
    for root in ('<div class="taxonomy-term">', '<div role="main">', "<main>"):
        assert html.page_record(f"<h1>t</h1>{root}</div></main>", BASE)["status"] == "sans_contenu"
    assert record("<iframe></iframe>")["error_kind"] == "unrecognized"


def test_children_internal_and_once():
    card = '<div class="wrapper-content"><h3><a href="{}">t</a></h3></div>'
    links = ["/p#x", "/p", "https://o.org/q", "/c", "mailto:a@b", " "]
    r = record('<div id="videos">' + "".join(card.format(x) for x in links) + '</div><a rel="nofollow next" href="/c?page=2">n</a><a rel="next" href="/d?page=2">n</a>')
    assert [(p["url"], p["type_"]) for p in r["pages"]] == [("https://h.org/p", ""), ("https://h.org/c?page=2", "pagination")]


def test_headed_sections_end_at_next_heading():
    card = '<div><div class="wrapper-content"><h2><a href="{}">t</a></h2></div></div>'
    r = record("<h2>Podcasts</h2>" + card.format("/a") + card.format("/b") + "<h2>Suggestions</h2>" + card.format("/z"))
    assert [p["url"] for p in r["pages"]] == ["https://h.org/a", "https://h.org/b"]


def test_search_items_keep_first_place_and_last_label():
    card = '<article><div class="field--name-field-type-production">{}</div><div class="wrapper-content"><h3><a href="{}">t</a></h3></div></article>'
    got = html.search_items('<div class="search-results">' + card.format("A", "/1") + card.format("B", "/2") + card.format("C", "/1") + "</div>", BASE)
    assert [(x["url"][-2:], x["type_"]) for x in got] == [("/1", "c"), ("/2", "b")]


def test_index_finds_what_a_walk_finds():
    import random

    rng, tags = random.Random(1), ["div", "p", "a", "h2", "span"]
    for _ in range(60):
        text = "".join(rng.choice([f'<{rng.choice(tags)} class="{rng.choice("xyz")} {rng.choice("xyz")}" id="i{rng.randrange(4)}" href="{rng.choice("uv")}">', f"</{rng.choice(tags)}>", "<br>", "t"]) for _ in range(40))
        tree = html.parse(text)

        def below(node):
            for c in node.children:
                if isinstance(c, html.Node):
                    yield c
                    yield from below(c)

        for selector in (".x", "p .y", "#i1 a[href]", "div, .z span", 'a[href="u"]', "[href] p", "h2.x.y"):
            groups = [g for _, g in html.compiled(selector)]
            for root in [tree, *tree.select("div")]:
                want = [n for n in below(root) if any(html._matches(n, g) for g in groups)]
                assert root.select(selector) == want and root.first(selector) is (want[0] if want else None)


def test_links_of_anchors():
    got = html.page_links('<a href="/x?q#f">1</a><a name="n">2</a><A HREF>3</A><p href="/no"><a href="http://[">4</a>', "https://h.org/c")
    assert [(x["href"], x["plain"]) for x in got["links"]] == [("/x?q#f", "https://h.org/x?q"), ("", "https://h.org/c"), ("http://[", None)]
    assert got["base"]["netloc"] == "h.org" and html.page_links(None, None) == {"base": dict.fromkeys(("url", "plain", "scheme", "netloc", "path")), "links": []}
    tree = html.parse('<a href="/a" href="/b">1</a>')
    assert html.page_links('<a href="/a" href="/b">1</a>', "https://h.org")["links"][0]["href"] == tree.first("a").attrs["href"]


def test_challenge():
    page = '<html><head><meta http-equiv="Refresh" content="{}"></head><body><img src="/sites/default/files/bot_challenge.png{}">{}</body></html>'
    shape = lambda *x, url="https://h.org/a": html.page_record(page.format(*x), url)["challenge"]
    assert shape("5", "?1", "") and shape(" 2.5 ", "?k=v", "")
    assert not shape("61", "?1", "") and not shape("x", "?1", "") and not shape("5", "", "") and not shape("5", "?1", "<script></script>") and not shape("5", "?1", "", url="http://h.org/a")


def test_pages_are_read_once_in_bounded_batches(spark):
    rows = spark.createDataFrame([(i, f"{BASE}/{i}", PAGE.format('<video><source src="/a.mp3" type="audio/mp3"></video>')) for i in range(150)] + [(150, None, None)], "no int, url string, html string")
    media = html.media_rows(html.parse_page(html.parse_pages(rows)).where("has_audio"))
    plan = media._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 500
    assert media.count() == 150 and html.parse_pages(rows).columns == ["no", "url", "page"]


def test_trees_go_without_garbage_collection():
    import gc

    gc.collect()
    gc.disable()
    try:
        html.page_record(PAGE.format("<p>a</p>" * 50), BASE)
        html.search_items("<main><p>a</p></main>", BASE)
        assert not any(isinstance(x, html.Node) for x in gc.get_objects())
    finally:
        gc.enable()
