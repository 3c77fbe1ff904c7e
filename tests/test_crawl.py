import json

from siltstone import cli
from siltstone.operators import frontier, state
from siltstone.plans import crawl, flows
from siltstone.sources import files

HEAD = '<html><body><article class="node--view-mode-full node--type-dossier"><h1>{}</h1>'
CARD = '<div id="videos"><div class="wrapper-content"><h3><a href="{}">t</a></h3></div></div>'
END = "</article></body></html>"
AUDIO = '<video><source src="/{}.mp3" type="audio/mp3"></video>'
SITE = "https://h.org"


def write_pages(spark, folder):
    cycle = lambda name, *to: HEAD.format(name) + "".join(CARD.format(t) for t in to) + END
    rows = [
        (f"{SITE}/p1", cycle("one", "/s", "/p1", "/p2")), (f"{SITE}/p2", cycle("two", "/s", "/p1")), (f"{SITE}/s", HEAD.format("s") + AUDIO.format("m") + CARD.format("/p1") + CARD.format("/bad") + CARD.format("/odd") + END),
        (f"{SITE}/bad", "<html><h1>cut</h1><main>"), (f"{SITE}/odd", "<html><main><h1>o</h1><iframe></iframe></main></html>"), (f"{SITE}/far", cycle("far")),
    ]
    spark.createDataFrame(rows, "url string, html string").write.parquet(f"{folder}/pages")
    (folder / "urls.txt").write_text(f"{SITE}/p1\n\n{SITE}/p1\n{SITE}/none\n")


def test_crawl(spark, tmp_path, capsys):
    write_pages(spark, tmp_path)
    args = ["--now", "1000", "crawl", "--pages", f"{tmp_path}/pages", "--state", f"{tmp_path}/state", "--urls", f"{tmp_path}/urls.txt"]
    assert cli.main(args) == 0
    held = crawl.tables(spark, f"{tmp_path}/state")
    assert {r.url.rpartition("/")[2] for r in held["visited"].collect()} == {"p1", "p2", "s", "odd"}
    assert {r.url.rpartition("/")[2] for r in held["queue"].collect()} == {"bad", "none"}
    assert [(r.url, r.attempts, r.next_attempt) for r in held["retry_schedule"].collect()] == [(f"{SITE}/bad", 1, 1060.0)]
    assert {r.url.rpartition("/")[2]: r.status for r in held["page_outcomes"].collect()} == {"p1": "exploitable", "p2": "exploitable", "s": "exploitable", "odd": "a_verifier"}
    assert [(r.url, r.audio_url) for r in held["audios"].collect()] == [(f"{SITE}/s", f"{SITE}/m.mp3")]
    assert cli.main(args) == 0 and crawl.tables(spark, f"{tmp_path}/state")["retry_schedule"].first().attempts == 1
    capsys.readouterr()
    cli.main(["sizes", "--state", f"{tmp_path}/state"])
    assert json.loads(capsys.readouterr().out)["statuses"] == {"pending": 1}
    cli.main(["downloads", "--state", f"{tmp_path}/state", "--limit", "5"])
    assert json.loads(capsys.readouterr().out) == [] and spark.read.json(f"{tmp_path}/state/jobs").first().audio_url == f"{SITE}/m.mp3"


def test_audit(spark, tmp_path):
    write_pages(spark, tmp_path)
    cli.main(["audit", "--pages", f"{tmp_path}/pages", "--urls", f"{tmp_path}/urls.txt", "--output", f"{tmp_path}/out"])
    got = {r.url: (r.status, r.html_name is not None) for r in spark.read.json(f"{tmp_path}/out").collect()}
    assert got == {f"{SITE}/p1": ("exploitable", True), f"{SITE}/none": ("a_reessayer", False)}
    assert files.url_list(spark, f"{tmp_path}/urls.txt").count() == 2


def test_whole_site(spark, tmp_path, capsys):
    """Count, search pages, pages in the queue's order, sizes; then downloads by root, and a pause that holds all work."""
    item = '<article><div class="wrapper-bundle">Film</div><div class="wrapper-content"><h3><a href="{}">t</a></h3></div></article>'
    search = lambda *to: '<html><main>' + "".join(item.format(t) for t in to) + '<li class="pager__item--last"><a href="?page=2">l</a></li></main></html>'
    page = lambda name, *audio: HEAD.format(name) + "".join(AUDIO.format(a) for a in audio) + END
    rows = [
        (f"{SITE}/q?page=0", search("/b", "/a", "/b")), (f"{SITE}/q?page=1", search("/c", "/a")), (f"{SITE}/a", page("a", "m1", "m2")), (f"{SITE}/b", page("b", "m2")),
        (f"{SITE}/c", '<html><head><meta http-equiv="refresh" content="5"></head><img src="/sites/default/files/bot_challenge.png?1"><h1>x</h1></html>'),
    ]
    spark.createDataFrame(rows, "url string, html string").write.parquet(f"{tmp_path}/pages")
    probe = "audio_url string, method string, status int, headers map<string,string>"
    probes = [(f"{SITE}/m1.mp3", "HEAD", 404, {}), (f"{SITE}/m1.mp3", "GET", 206, {"Content-Type": "audio/mpeg", "Content-Range": "bytes 0-0/77"}), (f"{SITE}/m2.mp3", "HEAD", 429, {"Retry-After": "900"})]
    spark.createDataFrame(probes, probe).write.parquet(f"{tmp_path}/probes")
    args = ["--now", "1000", "crawl", "--pages", f"{tmp_path}/pages", "--state", f"{tmp_path}/state", "--search", f"{SITE}/q?page=", "--probes", f"{tmp_path}/probes"]
    assert cli.main([*args, "--max-search-pages", "1"]) == 0
    first = crawl.tables(spark, f"{tmp_path}/state")
    assert [(r.id, r.url[len(SITE):]) for r in first["visited"].orderBy("id").collect()] == [(1, "/q?page=0"), (2, "/a"), (3, "/b")] and first["queue"].count() == 0
    assert [(r.id, r.url[-1], r.audio_url[-6:]) for r in first["audios"].orderBy("id").collect()] == [(1, "a", "m1.mp3"), (2, "a", "m2.mp3"), (3, "b", "m2.mp3")]
    sizes = {r.audio_url[-6:-4]: r for r in first["audio_sizes"].collect()}
    assert (sizes["m1"].status, sizes["m1"].size_bytes, sizes["m1"].method, sizes["m1"].final_url) == ("known", 77, "GET", f"{SITE}/m1.mp3")
    assert (sizes["m2"].status, sizes["m2"].attempts, sizes["m2"].next_attempt) == ("retry", 1, 1900.0)
    said = json.loads(capsys.readouterr().out)
    assert said["ran"] and said["next"] == 1900.0 and first["crawl_state"].first().value == 1900.0
    cli.main(args)
    assert json.loads(capsys.readouterr().out) == {"ran": False, "rounds": 0, "next": 1900.0}
    args[1] = "2000"
    cli.main(args)
    later = crawl.tables(spark, f"{tmp_path}/state")
    assert json.loads(capsys.readouterr().out)["ran"] and [(r.id, r.url[-1]) for r in later["queue"].collect()] == [(1, "c")]  # ids begin anew only when the queue is empty
    assert [(r.attempts, r.next_attempt) for r in later["retry_schedule"].collect()] == [(1, 2060.0)]


def test_queue_order(spark):
    queue = spark.createDataFrame([(4, "x", "")], "id long, url string, type_ string")
    items = spark.createDataFrame([(p, u, "t") for p, u in enumerate(["k", "x", "b", "k", "v", "a"])], "pos long, url string, type_ string")
    got = frontier.enqueue(queue, items, spark.createDataFrame([("v",)], "url string"))
    assert [(r.id, r.url) for r in frontier.in_order(got).collect()] == [(4, "x"), (5, "k"), (6, "b"), (7, "a")]


def test_sizes_follow_redirects(spark):
    probe = "audio_url string, method string, status int, headers map<string,string>"
    audio = {"Content-Type": "audio/mpeg", "Content-Length": "5"}
    rows = [("http://a/1", "HEAD", 200, audio), ("http://a/2", "HEAD", 200, audio), ("http://a/3", "GET", 404, {}), ("http://a/4", "GET", 200, {"Content-Type": "text/html"}), ("http://a/5", "GET", 200, {"Content-Type": "text/plain"})]
    moves = spark.createDataFrame([("http://a/1", 301, "/to"), ("http://a/2", 302, None)], "url string, status int, location string")
    held = crawl.tables(spark, "/nowhere") | {"audios": spark.createDataFrame([(i, u) for i, u in enumerate([f"http://a/{k}" for k in range(1, 7)])], "id long, audio_url string")}
    after = flows.size_stage(held, spark.createDataFrame(rows, probe), moves, 50.0)
    got = {r.audio_url[-1]: (r.status, r.size_bytes, r.final_url, r.next_attempt) for r in after["audio_sizes"].collect()}
    assert got == {
        "1": ("known", 5, "http://a/to", None), "2": ("retry", None, None, 110.0), "3": ("missing", None, "http://a/3", None),
        "4": ("retry", None, None, 350.0), "5": ("unknown", None, "http://a/5", None),
    }
    assert after["crawl_state"].count() == 0


def test_downloads_by_root(spark):
    held = crawl.tables(spark, "/nowhere")
    held["audios"] = spark.createDataFrame([(i, f"p{i}", u, "", "fr") for i, u in enumerate(["a", "b", "c", "d", "e"])], "id long, url string, audio_url string, file_name string, lang string")
    held["audios"] = files.conform(held["audios"], files.SCHEMAS["audios"])
    rows = [("r2", "a", "done", "x", 9, 0, None, "", 1.0), ("r1", "b", "retry", None, None, 3, 5.0, "old", 1.0)]
    held["downloads"] = spark.createDataFrame(rows, files.SCHEMAS["downloads"])
    response = "audio_url string, status int, headers map<string,string>, sample string, challenge boolean, offset long, etag string, same_url boolean, first string, extension string, size long, final_url string, file string"
    audio = {"Content-Type": "audio/mpeg", "Content-Length": "7"}
    got = [("a", 200, audio, "", False, 0, None, True, "ID3", "mp3", 7, "fa", "a.mp3"), ("b", 503, {"Content-Type": "text/html"}, "", True, 0, None, True, "", None, 0, "fb", ""), ("c", 404, {}, "", False, 0, None, True, "", None, 0, "fc", ""), ("d", 416, audio, "", False, 3, None, True, "", "mp3", 3, "fd", "d.mp3")]
    after = flows.download_stage(held, spark.createDataFrame(got, response), "r1", 100.0)
    rows = {(r.output_root, r.audio_url): (r.status, r.file_path, r.attempts, r.next_attempt) for r in after["downloads"].collect()}
    assert rows[("r2", "a")] == ("done", "x", 0, None) and rows[("r1", "a")] == ("done", "r1/a.mp3", 0, None) and ("r1", "d") not in rows
    assert rows[("r1", "c")][0] == "missing" and rows[("r1", "b")][0] == "retry" and rows[("r1", "b")][2] == 4
    assert {r.audio_url: r.file_name for r in after["audios"].collect()} == {"a": "r1/a.mp3", "b": "", "c": "", "d": "", "e": ""}
    assert after["audio_sizes"].first().final_url == "fa" and after["crawl_state"].first().value == rows[("r1", "b")][3]
    again, named = state.repair_downloads(after["downloads"], spark.createDataFrame([("r2", "a")], "output_root string, audio_url string"), after["audios"])
    assert again.where("output_root = 'r1' and audio_url = 'a'").first().status == "pending" and named.where("file_name <> ''").count() == 0


def test_parser_upgrade_runs_once(spark):
    schedule = spark.createDataFrame([("page", "a", 1, 5.0, "Old error 1"), ("page", "b", 1, 5.0, "other"), ("page", "z", 1, 5.0, "old error"), ("search", "a", 1, 5.0, "old error")], files.SCHEMAS["retry_schedule"])
    queue = spark.createDataFrame([(1, "a", ""), (2, "b", "")], files.SCHEMAS["queue"])
    left, flags, n = state.upgrade_parser(schedule, queue, spark.createDataFrame([], files.SCHEMAS["crawl_state"]), "old error")
    assert n.first()[0] == 1 and sorted((r.kind, r.url) for r in left.collect()) == [("page", "b"), ("page", "z"), ("search", "a")] and flags.first()[:] == ("parser_v2", 1.0)
    left, flags, n = state.upgrade_parser(schedule, queue, flags, "old error")
    assert n.first()[0] == 0 and left.count() == 4 and flags.count() == 1
