import json
import sqlite3

import pandas as pd
import pytest
from pyspark.sql import functions as F

from siltstone.functions import backoff, media
from siltstone.operators import frontier, reports, state
from siltstone.sources import files

AUDIOS = [(1, "fr", "Français"), (2, "en", "Anglais"), (3, "blank", ""), (4, "null", None), (5, "spaces", "  "), (6, "shared", "Français"), (7, "shared", "Anglais"), (8, "multi", "Français; Anglais")]


@pytest.fixture(scope="module")
def audios(spark):
    return spark.createDataFrame([(i, f"p{i}", u, "", lang) for i, u, lang in AUDIOS], "id long, url string, audio_url string, title string, lang string")


def test_waits(spark):
    rows = spark.createDataFrame([(d, n) for d in (60, 300, 7200) for n in range(1, 6)], "d int, n int")
    own = backoff.next_attempt(F.lit(0), F.col("d"), F.col("n"))
    fixed = backoff.next_attempt(F.lit(0), F.col("d"), F.col("n"), F.lit(60))
    got = rows.groupBy("d").agg(F.sort_array(F.collect_list(F.struct("n", own.alias("o"), fixed.alias("f")))).alias("x")).collect()
    waits = {r.d: ([x.o for x in r.x], [x.f for x in r.x]) for r in got}
    assert waits[300] == ([300, 600, 1200, 2400, None], [300, 300, 300, 480, None])
    assert waits[60][0] == [60, 120, 240, 480, None] and waits[7200][0] == [7200] * 4 + [None]


def test_languages(audios):
    chosen = lambda x: {r.audio_url for r in reports.download_jobs(audios, x).collect()}
    assert chosen(["Français", ""]) == {"fr", "blank", "null", "spaces", "shared"}
    assert len(chosen(None)) == 7 and chosen(["Français; Anglais"]) == {"multi"} and chosen([]) == set()
    job = reports.download_jobs(audios, ["Français"]).where("audio_url = 'shared'").first()
    assert (job.title, job.pages, job.languages) == ("audio", ["p6", "p7"], ["Français", "Anglais"])


def test_limit_counts_eligible_jobs(spark, audios):
    downloads = spark.createDataFrame([("fr", "done", None), ("en", "retry", 50.0), ("blank", "retry", 5.0), ("null", "suspended", None)], "audio_url string, status string, next_attempt double")
    got = [r.audio_url for r in reports.eligible_jobs(reports.download_jobs(audios), downloads, F.lit(10.0), 2).collect()]
    assert got == ["blank", "spaces"]
    with pytest.raises(ValueError):
        reports.eligible_jobs(reports.download_jobs(audios), downloads, F.lit(10.0), 0)


def test_replayed_failure_counts_once(spark):
    empty = spark.createDataFrame([], files.SCHEMAS["retry_schedule"])
    fails = spark.createDataFrame([("page", "u", 10.0, 60, "a", 1), ("page", "u", 20.0, 60, "b" * 3000, 2), ("page", "u", 20.0, 60, "b" * 3000, 2)], "kind string, url string, at double, delay int, error string, e int")
    row = state.defer(empty, fails, event_id="e").first()
    assert (row.attempts, row.next_attempt, len(row.error)) == (2, 140.0, 2000)


def test_null_keys_are_inserted_again(spark):
    old = spark.createDataFrame([(1, None)], "id int, k string")
    new = spark.createDataFrame([(2, None), (3, "a"), (4, "a")], "id int, k string")
    assert sorted(r.id for r in state.first_wins(old, new, ["k"], "id").collect()) == [1, 2, 3]


def test_frontier(spark):
    items = spark.createDataFrame([(0, "a", "x"), (1, "b", "y"), (2, "a", "z"), (3, "v", "w"), (4, "q", "w"), (5, None, "w")], "pos int, url string, type_ string")
    one = lambda u: spark.createDataFrame([(u,)], "url string")
    assert sorted(map(tuple, frontier.new_urls(items, one("v"), one("q")).collect())) == [("a", "x"), ("b", "y")]
    schedule = spark.createDataFrame([("page", "a", None), ("page", "b", 10.0), ("search", "c", 99.0)], "kind string, url string, next_attempt double")
    work = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    assert sorted(r.url for r in frontier.ready(work, schedule, "page", F.lit(10.0)).collect()) == ["b", "c"]


def test_reachable_in_cycles(spark, tmp_path):
    links = spark.createDataFrame([("p1", "s"), ("p1", "p1"), ("p1", "p2"), ("p2", "s"), ("p2", "p1"), ("s", "p1")], "src string, dst string")
    got = {r.url: r.depth for r in frontier.reachable(spark.createDataFrame([("p1",)], "url string"), links, str(tmp_path)).collect()}
    assert got == {"p1": 0, "s": 1, "p2": 1}


def test_size_rows_keep_attempts(spark):
    old = spark.createDataFrame([("m", None, "retry", 1.0, 3, 9.0)], "audio_url string, size_bytes long, status string, checked_at double, attempts int, next_attempt double")
    found = spark.createDataFrame([("m", 5, "known", 2.0)], "audio_url string, size_bytes long, status string, checked_at double")
    row = state.save_sizes(old, found).first()
    assert (row.size_bytes, row.status, row.attempts, row.next_attempt) == (5, "known", 3, None)


def test_downloads_done(spark, audios):
    empty = spark.createDataFrame([], files.SCHEMAS["downloads"])
    sizes = spark.createDataFrame([], files.SCHEMAS["audio_sizes"])
    done = spark.createDataFrame([("shared", "f.mp3", 7, 1.0)], "audio_url string, file string, size_bytes long, at double")
    rows, named, known = state.save_downloads(empty, audios.withColumn("file_name", F.lit("")), sizes, done)
    assert rows.first().status == "done" and named.where("file_name = 'f.mp3'").count() == 2 and known.first().method == "DOWNLOAD"


def test_versions_are_whole(spark, tmp_path):
    a = spark.createDataFrame([(1,)], "x int")
    first = state.apply_all({"a": a, "b": a}, str(tmp_path))
    assert json.loads(spark.read.text(f"{tmp_path}/current").first()[0])["version"] == first.rpartition("/")[2]
    assert spark.read.parquet(f"{first}/b").count() == 1


def test_files(spark, tmp_path):
    (tmp_path / "urls.txt").write_text(" a \n\nb\na\n")
    assert sorted(map(tuple, files.url_list(spark, str(tmp_path / "urls.txt")).collect())) == [(0, "a"), (2, "b")]
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "1.json").write_text('{"audio_url": "u",\n "complete": true}')
    (tmp_path / "j" / "2.json").write_text("not json")
    assert [r.audio_url for r in files.read_json(spark, str(tmp_path / "j"), files.RECEIPT, "audio_url").collect()] == ["u"]
    assert files.read_state(spark, str(tmp_path), "queue").columns == ["id", "url", "type_"]
    old = spark.createDataFrame([(1, "u")], "id long, url string")
    assert files.conform(old, files.SCHEMAS["audios"]).first().doi is None


def test_sqlite(spark, tmp_path):
    from siltstone.sources.sqlite import SqliteSource

    with sqlite3.connect(tmp_path / "x.db") as db:
        db.execute("create table t (id integer primary key, s text, r real)")
        db.executemany("insert into t values (?, ?, ?)", [(i, f"s{i}" if i % 2 else None, i / 2) for i in range(1, 101)])
    spark.dataSource.register(SqliteSource)
    df = spark.read.format("sqlite").option("path", str(tmp_path / "x.db")).option("table", "t").load()
    assert dict(df.dtypes) == {"id": "bigint", "s": "string", "r": "double"} and df.agg(F.sum("id"), F.count("s"), F.sum("r")).first()[:] == (5050, 50, 2525.0)


def test_frames():
    assert media.has_mpeg_header(b"\x00\x00\xff\xfb\x90\xc4") and not media.has_mpeg_header(b"\xff\xfb\x90") and not media.has_mpeg_header(None)
    assert not media.has_mpeg_header(b"\x00" * 4096 + b"\xff\xfb\x90\xc4")


def test_retry_stream(spark, tmp_path):
    from siltstone.streaming import retries

    schema = "kind string, url string, at double, delay long, error string"
    spark.createDataFrame([("page", "u", float(i), 60, "e") for i in range(3)] + [("page", "v", 1.0, 300, "e")], schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    out = retries.defer_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    keep = lambda batch, i: batch.write.mode("append").parquet(f"{tmp_path}/out")
    out.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination(120)
    got = {r.url: (r.attempts, r.next_attempt) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {"u": (3, 242.0), "v": (1, 301.0)}


def test_replayed_batches_upsert_once(spark, tmp_path):
    from siltstone.streaming import retries

    write = retries.versioned_upsert(str(tmp_path / "t"), ["k"], "at")
    one = spark.createDataFrame(pd.DataFrame({"k": ["a", "a", "b"], "at": [1, 2, 1]}))
    two = spark.createDataFrame(pd.DataFrame({"k": ["a"], "at": [5]}))
    write(one, 0)
    write(two, 1)
    write(two, 1)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t" / "1")).collect())) == [("a", 5), ("b", 1)]
