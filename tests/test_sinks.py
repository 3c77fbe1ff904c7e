"""Tables written to SQLite files and documents written one by one, and read back."""

import datetime
import sqlite3

import pytest
from pyspark.sql import functions as F

from siltstone.sources import files
from siltstone.sources.sqlite import SqliteSource


def save(df, path, mode="append"):
    df.write.format("sqlite").option("path", str(path)).option("table", "a table").mode(mode).save()


def test_sqlite_round_trip(spark, tmp_path):
    spark.dataSource.register(SqliteSource)
    path = tmp_path / "x.db"
    rows = spark.range(1000, numPartitions=5).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("ü'\""), "id")).alias("s"), (F.col("id") / 8).alias("r"), F.encode(F.col("id").cast("string"), "utf-8").alias("b"))
    save(rows, path)
    back = spark.read.format("sqlite").option("path", str(path)).option("table", "a table").load()
    assert dict(back.dtypes) == {"id": "bigint", "s": "string", "r": "double", "b": "binary"}
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    save(spark.createDataFrame([(5000, "new", 7)], "id long, s string, `more \"x\"` int"), path)  # a column that the table lacks
    with sqlite3.connect(path) as db:
        assert db.execute('select id, s, r, "more ""x""" from "a table" where id >= 5000').fetchall() == [(5000, "new", None, 7)] and db.execute('select count(*) from "a table"').fetchone() == (1001,)
    save(rows.limit(0), path)
    save(spark.createDataFrame([(datetime.datetime(2024, 1, 2, 3), True, [1])], "t timestamp, f boolean, l array<int>"), tmp_path / "y.db")
    with sqlite3.connect(tmp_path / "y.db") as db:
        assert db.execute('select * from "a table"').fetchone() == ("2024-01-02 03:00:00", 1, "[1]")
    save(rows.where("id < 3"), path, "overwrite")
    with sqlite3.connect(path) as db:
        assert db.execute('select count(*) from "a table"').fetchone() == (3,)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["x.db", "y.db"]


def test_sqlite_job_that_fails_leaves_nothing(spark, tmp_path):
    spark.dataSource.register(SqliteSource)
    path = tmp_path / "x.db"
    save(spark.range(10), path)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        save(broken, path)
    with sqlite3.connect(path) as db:
        assert db.execute('select count(*) from "a table"').fetchone() == (10,)
    assert [p.name for p in tmp_path.iterdir()] == ["x.db"]


def test_documents_round_trip(spark, tmp_path):
    folder = str(tmp_path / "docs")
    schema = "name string, " + files.RECEIPT
    rows = [(f"_state/{i}.json", f"u{i}", "fr/é.mp3", i, None, True, 'a "title"\n', ["fr"], []) for i in range(30)] + [(None, "u", "f", 1, "", False, "", [], [])]
    df = spark.createDataFrame(rows, schema).repartition(4)
    assert files.write_documents(df, folder) == 30 and files.write_documents(df, folder) == 30
    assert len(list((tmp_path / "docs" / "_state").glob("*.json"))) == 30 and not list((tmp_path / "docs" / "_state").glob(".*draft*"))
    back = files.read_json(spark, f"{folder}/_state", files.RECEIPT, "audio_url")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.where("name is not null").drop("name").collect()))
    assert files.write_documents(df.limit(0), str(tmp_path / "none")) == 0
