"""State by buckets, numbers at size, snapshots, receipts against files, and pauses."""

import collections
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators import frontier
from siltstone.plans import crawl
from siltstone.sources import files, receipts
from siltstone.sources.versions import Taken, Versions, bucket_of

QUEUE = files.SCHEMAS["queue"]


def queue(spark, rows):
    return spark.createDataFrame(rows, QUEUE)


def test_a_version_writes_what_it_changes(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "s"), buckets=32)
    rows = spark.range(3000).select("id", F.concat(F.lit("http://h/"), F.sha2(F.col("id").cast("string"), 256)).alias("url"), F.lit("t").alias("type_"))
    first = store.commit(store.latest(), {"queue": (None, rows), "crawl_state": (None, spark.createDataFrame([("pause_until", 5.0)], files.SCHEMAS["crawl_state"]))})
    assert first.version == 1 and first.read("queue").count() == 3000 and first.read("visited").count() == 0 and first.top("queue") == 2999
    one = rows.where("id = 7").select("url")
    own = first.touched(one)
    assert len(own) == 1
    second = store.commit(first, {"queue": (own, first.read("queue", own).join(one, "url", "left_anti").unionByName(queue(spark, [(9000, "elsewhere", "x")])))})
    gone = {r.id for r in rows.collect()} - {r.id for r in second.read("queue").collect()}
    stray = "elsewhere" if own == second.touched(queue(spark, [(1, "elsewhere", "")]).select("url")) else None
    assert gone == {7} and (second.read("queue").where("id = 9000").count() == 1) == (stray is not None)  # a row of another bucket is not written
    assert store.bytes_of(2) < store.bytes_of(1) / 8 and second.read("crawl_state").first().value == 5.0
    assert first.read("queue").count() == 3000  # a reader keeps its version
    third = store.commit(second, {"queue": (own, second.read("queue", own).limit(0))})
    assert third.read("queue", own).count() == 0 and third.read("queue").count() == second.read("queue").where(~bucket_of(F.col("url"), 32).isin(list(own))).count()
    assert store.vacuum(keep=1) >= 1 and store.latest().read("queue").count() == third.read("queue").count() and store._numbers() == [3]


def test_a_failing_writer_changes_nothing(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "s"), buckets=4)
    first = store.commit(store.latest(), {"queue": (None, queue(spark, [(1, "a", ""), (2, "b", "")]))})
    bad = spark.createDataFrame([(1, "c")], "id long, url string").select("id", "url", F.expr("raise_error('broken')").cast("string").alias("type_"))
    with pytest.raises(Exception, match="broken"):
        store.commit(first, {"visited": (None, queue(spark, [(1, "v", "")]).select("id", "url")), "queue": (None, bad)})
    now = store.latest()
    assert now.version == 1 and now.read("queue").count() == 2 and now.read("visited").count() == 0
    store.commit(first, {"queue": (None, queue(spark, [(5, "e", "")]))})
    with pytest.raises(Taken):  # the other writer began from the same version
        store.commit(first, {"queue": (None, queue(spark, [(6, "f", "")]))})
    assert [r.url for r in store.latest().read("queue").collect()] == ["e"]
    assert store.vacuum() == 2 and store.latest().read("queue").count() == 1


@pytest.mark.parametrize("parts", ["3", "8"])
def test_two_million_numbers(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = spark.range(2_000_000).select(F.xxhash64("id").alias("k"), (F.col("id") % 3 == 0).alias("hot"), F.col("id").alias("v"))
        got = frontier.numbered(rows.withColumn("k", F.when(F.col("hot"), 0).otherwise(F.col("k"))), ["k"], "n", first=10)
        low, high, n, distinct = got.agg(F.min("n"), F.max("n"), F.count("*"), F.count_distinct("n")).first()
        assert (low, high, n, distinct) == (10, 2_000_009, 2_000_000, 2_000_000)
        ordered = got.select(F.lag("k").over(frontier.Window.partitionBy(F.floor(F.col("n") / 50_000)).orderBy("n")).alias("b"), "k")
        assert ordered.where("b > k").isEmpty() and got.groupBy("v").count().where("count > 1").isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ids_of_a_large_queue(spark):
    held = queue(spark, [(70, "u5", "")])
    items = spark.range(300_000).repartition(7).select(F.col("id").alias("pos"), F.concat(F.lit("u"), F.col("id") % 200_000).alias("url"), F.lit("t").alias("type_"))
    got = frontier.enqueue(held, items, queue(spark, [(1, "u3", "")]).select("url"))
    assert got.agg(F.count("*"), F.count_distinct("id"), F.min("id"), F.max("id")).first()[:] == (199_999, 199_999, 70, 200_068)
    assert [r.url for r in frontier.in_order(got).limit(5).collect()] == ["u5", "u0", "u1", "u2", "u4"]


def test_snapshots_are_written_once(spark, tmp_path):
    folder, name = str(tmp_path / "snap"), lambda u: hashlib.sha256(u.encode()).hexdigest() + ".html"
    pages = spark.createDataFrame([(f"u{i}", f"<p>{i}") for i in range(20)] + [("u1", "<p>1")], "url string, html string")
    assert files.write_snapshots(pages, folder) == 20 and files.write_snapshots(pages, folder) == 0
    assert files.write_snapshots(spark.createDataFrame([("u3", "other"), ("new", "x")], "url string, html string"), folder) == 1
    got = {r.name: (r.url, r.html, r.prefix) for r in files.read_snapshots(spark, folder).collect()}
    assert len(got) == 21 and got[name("u3")] == ("u3", "<p>3", name("u3")[:2]) and got[name("new")][1] == "x"
    assert files.write_snapshots(pages.limit(0), str(tmp_path / "none")) == 0 and not (tmp_path / "none").exists()


ODD = "<html><main><h1>o</h1><iframe></iframe></main></html>"
CHALLENGE = '<html><head><meta http-equiv="refresh" content="5"></head><img src="/sites/default/files/bot_challenge.png?1"><h1>x</h1></html>'
PAGE = '<html><body><article class="node--view-mode-full node--type-dossier"><h1>t</h1><video><source src="/m.mp3" type="audio/mp3"></video><div id="videos"><div class="wrapper-content"><h3><a href="{}">t</a></h3></div></div></article></body></html>'


def test_a_blocked_page_ends_the_rounds(spark, tmp_path):
    """After a blocked page no other round begins, and searches, url lists, sizes and downloads wait for the pause's end; the review's snapshot is kept."""
    site, folder = "https://h.org", str(tmp_path / "state")
    pages = spark.createDataFrame([(f"{site}/a", PAGE.format("/b")), (f"{site}/b", PAGE.format("/a")), (f"{site}/c", CHALLENGE), (f"{site}/odd", ODD)], "url string, html string")
    start = spark.createDataFrame([(0, f"{site}/a"), (1, f"{site}/c"), (2, f"{site}/odd")], "pos long, url string")
    assert crawl.crawl(spark, pages, folder, start, 1000.0) == 1
    held = crawl.tables(spark, folder)
    assert sorted((r.id, r.url[-2:]) for r in held["queue"].collect()) == [(2, "/c"), (4, "/b")]  # b was found, and is not read
    assert held["crawl_state"].first().value > 1000 and held["retry_schedule"].first().url == f"{site}/c"
    review = held["page_outcomes"].where("status = 'a_verifier'").first()
    path = review.detail.rpartition(" ; HTML : ")[2]
    assert path.startswith(f"{folder}/pages_a_verifier/prefix=") and path.rpartition("/")[2] == hashlib.sha256(f"{site}/odd".encode()).hexdigest() + ".html"
    assert [r.html for r in files.read_snapshots(spark, f"{folder}/pages_a_verifier").collect()] == [ODD]
    version = Versions(spark, folder).latest().version
    probes = spark.createDataFrame([(f"{site}/m.mp3", "HEAD", 200, {"Content-Type": "audio/mpeg", "Content-Length": "5"})], "audio_url string, method string, status int, headers map<string,string>")
    response = spark.createDataFrame([], "audio_url string, status int, headers map<string,string>, sample string, challenge boolean, offset long, etag string, same_url boolean, first string, extension string, size long, final_url string, file string")
    assert crawl.crawl(spark, pages, folder, start, 1001.0) == 0 and not crawl.size_pass(spark, probes, folder, 1001.0) and not crawl.download_pass(spark, response, folder, "r", 1001.0)
    assert crawl.crawl_site(spark, pages, folder, f"{site}/q?page=", 1001.0, probes=probes) == {"ran": False, "rounds": 0, "next": held["crawl_state"].first().value}
    assert Versions(spark, folder).latest().version == version  # nothing was written
    later = held["crawl_state"].first().value
    assert crawl.crawl(spark, pages.where("url not like '%/c'"), folder, start.limit(0), later) == 1 and crawl.size_pass(spark, probes, folder, later)
    held = crawl.tables(spark, folder)
    assert {r.url[-2:] for r in held["visited"].collect()} == {"/a", "/b", "dd"} and held["audio_sizes"].first().size_bytes == 5
    assert collections.Counter(r.id for r in held["visited"].collect()).most_common(1)[0][1] == 1


def receipt(root, url, file, size, complete=True, of=None):
    key = hashlib.sha256(url.encode()).hexdigest()
    (root / "_state").mkdir(parents=True, exist_ok=True)
    (root / "_state" / f"{key}.json").write_text(json.dumps({"audio_url": of or url, "file": file, "size_bytes": size, "complete": complete}))


def test_receipts_against_files(spark, tmp_path):
    root = tmp_path / "out"
    (root / "fr").mkdir(parents=True)
    audio = b"ID3" + b"\0" * 5000
    for name, data in (("good.mp3", audio), ("short.mp3", audio[:-1]), ("page.mp3", b"<html>" + b" " * 4994 + b"xyz"), ("odd name é.mp3", audio), ("tiny.mp3", b"")):
        (root / "fr" / name).write_bytes(data)
    (tmp_path / "outside.mp3").write_bytes(audio)
    for url, *rest in (("good", "fr/good.mp3", 5003), ("short", "fr/short.mp3", 5003), ("page", "fr/page.mp3", 5003), ("odd", "fr/odd name é.mp3", 5003), ("outside", "../outside.mp3", 5003),
                       ("missing", "fr/none.mp3", 5003), ("open", "fr/good.mp3", 5003, False), ("other", "fr/good.mp3", 5003, True, "someone else"), ("tiny", "fr/tiny.mp3", 0)):
        receipt(root, url, *rest)
    (root / "_state" / (hashlib.sha256(b"torn").hexdigest() + ".json")).write_text('{"audio_url": "torn", "fi')
    (root / "_state" / (hashlib.sha256(b"good").hexdigest() + ".partial.json")).write_text('{"audio_url": "good"}')
    names = ["good", "short", "page", "odd", "outside", "missing", "open", "other", "tiny", "torn", "never"]
    media = spark.createDataFrame([(n,) for n in names], "audio_url string")
    listing, said = receipts.listed_files(spark, str(root)), receipts.read_receipts(spark, str(root))
    assert {r.file for r in listing.collect()} == {"fr/" + n for n in ("good.mp3", "short.mp3", "page.mp3", "odd name é.mp3")}  # Spark lists no empty files
    assert {r.audio_url for r in receipts.valid_receipts(media, said, listing).collect()} == {"good", "odd"}
    assert receipts.listed_files(spark, str(tmp_path / "no")).count() == 0 and receipts.read_receipts(spark, str(tmp_path / "no")).count() == 0

    folder = str(tmp_path / "state")
    store = Versions(spark, folder)
    rows = [(str(root), n, "done", f"{root}/x", 5003, 2, None, "", 1.0) for n in names[:4]] + [("elsewhere", "short", "done", "y", 1, 0, None, "", 1.0), (str(root), "tiny", "retry", None, None, 3, 9.0, "", 1.0)]
    audios = [(i, f"p{i}", n, "held", "t", "", "fr", "", "", "", "") for i, n in enumerate(names)]
    store.commit(store.latest(), {"downloads": (None, spark.createDataFrame(rows, files.SCHEMAS["downloads"])), "audios": (None, spark.createDataFrame(audios, files.SCHEMAS["audios"]))})
    assert crawl.repair_pass(spark, listing, said, folder, str(root)) == 2
    held = crawl.tables(spark, folder)
    got = {(r.output_root == str(root), r.audio_url): (r.status, r.attempts) for r in held["downloads"].collect()}
    assert got == {(True, "good"): ("done", 2), (True, "odd"): ("done", 2), (True, "short"): ("pending", 0), (True, "page"): ("pending", 0), (False, "short"): ("done", 0), (True, "tiny"): ("retry", 3)}
    assert {r.audio_url for r in held["audios"].where("file_name = ''").collect()} == {"short", "page"}
    assert crawl.repair_pass(spark, listing, said, folder, str(root)) == 0


def test_watching_passes(monkeypatch):
    """A watched command waits for what is due and goes on at that time, until nothing is due any more."""
    from siltstone import cli

    slept, clock = [], [100.0]
    monkeypatch.setattr(cli.time, "time", lambda: clock[0])
    monkeypatch.setattr(cli.time, "sleep", lambda s: (slept.append(s), clock.__setitem__(0, clock[0] + s)))
    seen = []
    for at in cli.passes(True, 100.0):
        seen.append(at.now)
        at.next = {100.0: 160.0, 160.0: 150.0}.get(at.now)
        clock[0] += 5
    assert seen == [100.0, 160.0, 165.0] and slept == [55.0, 0.0]
    assert [at.now for at in cli.passes(False, 7.0)] == [7.0]


def test_sizes_and_downloads_from_the_command_line(spark, tmp_path, capsys):
    from siltstone import cli

    folder, root = str(tmp_path / "state"), tmp_path / "out"
    (root / "fr").mkdir(parents=True)
    (root / "fr" / "a.mp3").write_bytes(b"ID3" + b"\0" * 10)
    receipt(root, "a", "fr/a.mp3", 13)
    audios = [(i, f"p{i}", n, "x", "t", "", lang, "", "", "", "") for i, (n, lang) in enumerate([("a", "fr"), ("b", "fr"), ("c", "en")])]
    rows = [(str(root), "a", "done", "x", 13, 0, None, "", 1.0), (str(root), "b", "done", "y", 9, 1, None, "", 1.0), (str(root), "c", "suspended", None, None, 5, None, "", 1.0)]
    store = Versions(spark, folder, buckets=4)
    store.commit(store.latest(), {"audios": (None, spark.createDataFrame(audios, files.SCHEMAS["audios"])), "downloads": (None, spark.createDataFrame(rows, files.SCHEMAS["downloads"]))})
    shown = lambda *args: (cli.main(["--now", "50", *args]), json.loads(capsys.readouterr().out))[1]
    assert {r["status"]: r["n"] for r in shown("downloads", "--state", folder, "--output", str(root))} == {"done": 1, "pending": 1, "suspended": 1}  # b's file is not there
    assert {r["status"]: r["n"] for r in shown("downloads", "--state", folder, "--output", str(root), "--retry-failed", "--languages", "en")} == {"done": 1, "pending": 2}
    assert {r.audio_url for r in spark.read.json(f"{folder}/jobs").collect()} == {"c"}
    probes = [("a", "HEAD", 200, {"Content-Type": "audio/mpeg", "Content-Length": "5"}), ("b", "HEAD", 503, {})]
    spark.createDataFrame(probes, "audio_url string, method string, status int, headers map<string,string>").write.parquet(f"{tmp_path}/probes")
    assert shown("sizes", "--state", folder, "--probes", f"{tmp_path}/probes", "--summary")["statuses"] == {"pending": 3}
    assert shown("sizes", "--state", folder, "--probes", f"{tmp_path}/probes")["statuses"] == {"known": 1, "retry": 1, "pending": 1}
    held = crawl.tables(spark, folder)
    assert crawl.next_size(held) == 110.0 and crawl.next_download(held, str(root)) is None and crawl.next_deadline(spark, folder) == 110.0
