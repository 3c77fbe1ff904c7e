"""Every registered query of the engine against its oracle SQL."""

import math
import os

import duckdb
import pytest

from siltstone.plans import catalog, literal_queries

QUERIES, ORACLE_SQL = catalog.QUERIES | literal_queries.QUERIES, catalog.ORACLE_SQL | literal_queries.ORACLE_SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    db = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        db.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return db


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    return round(float(x), 6) if isinstance(x, (int, float)) and not (isinstance(x, float) and math.isnan(x)) else str(x)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([[plain(r[i]) for i in order] for r in values], key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, oracle):
    df = QUERIES[name](spark, sf_dir)
    got = rows(df.columns, df.collect())
    want = oracle.sql(ORACLE_SQL[name])
    assert got == rows(want.columns, want.fetchall())


def test_entry_names():
    import __spark_entry__ as entry

    assert not set(literal_queries.QUERIES) & set(entry.queries())  # they read no table
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_slug_of_whole_texts(spark, tmp_path):
    whole = {1: "和平" * 40 + "Élan vital", 2: "*" * 70 + "ﬁn ß ²", 3: "ß" * 50 + "Straße", 4: "a" * 30 + " . " * 20 + "b" * 30, 5: "!" * 100, 6: None, 7: "-" * 99 + "con"}
    spark.createDataFrame(list(whole.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.slug for r in catalog.QUERIES["slug_texts"](spark, str(tmp_path)).collect()}
    assert got == {1: "elan-vital", 2: "fin-2", 3: "strae", 4: "a" * 30 + "-" + "b" * 17, 5: "inconnue", 6: None, 7: "lang-con"}


def test_whole_tables_are_read(spark, tmp_path):
    # Customer c leads to 40 others by orders that are no multiples of 5, to more than 997 nodes in two rounds.
    orders = [(10 * (40 * c + k) + 1, c) for c in range(1, 80) for k in range(40)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    want = {1, *range(40, 80), *range(1600, 3200)}
    assert catalog.QUERIES["reachability_orders"](spark, str(tmp_path)).first()[:] == (len(want), sum(want))
    spark.createDataFrame([(i, f"u{i}") for i in range(60)], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    assert catalog.QUERIES["add_visited_pages"](spark, str(tmp_path)).first().n == 60


def equals_sql(spark, folder, name):
    """Whether a query equals its SQL on the tables in the folder."""
    db = duckdb.connect()
    for t in os.listdir(folder):
        db.execute(f"create view {t.removesuffix('.parquet')} as select * from '{folder}/{t}/*.parquet'")
    df, want = QUERIES[name](spark, str(folder)), db.sql(ORACLE_SQL[name])
    return rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


PAGES = "page_id long, url string, html string"


def test_visited_pages_that_share_a_url(spark, tmp_path):
    pages = [(2, "a", ""), (4, "a", ""), (6, "b", ""), (1, "b", ""), (3, "c", ""), (9, "c", ""), (5, None, ""), (8, None, ""), (None, "d", "")]
    spark.createDataFrame(pages, PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    assert QUERIES["add_visited_pages"](spark, str(tmp_path)).first().n == 5
    assert equals_sql(spark, tmp_path, "add_visited_pages")


def test_titles_with_references_cut_short(spark, tmp_path):
    titles = ["a &amp;&amp;amp; b&amp", "x &lt y &lt;&gt", "&quot;q&quot &#x27;s&#x27", "cut &am", "&amp;lt;"]
    spark.createDataFrame([(i, f"u{i}", f"<html><h1>{t}</h1></html>") for i, t in enumerate(titles)], PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.title for r in QUERIES["page_title"](spark, str(tmp_path)).collect()}
    assert got == {0: "a &&amp; b&", 1: "x < y <>", 2: "\"q\" 's'", 3: "cut &am", 4: "&lt;"}
    assert equals_sql(spark, tmp_path, "page_title")


def test_slugs_of_devices_and_compatible_letters(spark, tmp_path):
    texts = ["Con.", "ñ COM1 ß", "com10", "ﬁn ² ½", "ｃｏｎ", "Ⅷ＇ẞ STRAẞE", "á b", "ﬁ\nｅ", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.slug for r in QUERIES["slug_texts"](spark, str(tmp_path)).collect()}
    assert got == {0: "lang-con", 1: "n-com1", 2: "com10", 3: "fin-2-12", 4: "lang-con", 5: "viii-strae", 6: "a-b", 7: "fi-e", 8: "inconnue", 9: None}
    assert equals_sql(spark, tmp_path, "slug_texts")


def test_outcomes_of_pages_that_share_a_url(spark, tmp_path):
    pages = [(1, "a", "</html>"), (3, "a", ""), (4, "a", ""), (2, "b", ""), (7, "b", "</html>"), (6, "c", ""), (9, "c", ""), (5, "d", ""), (None, "d", ""), (8, None, ""), (11, None, ""), (10, "e", ""), (10, "e", "</html>")]
    spark.createDataFrame(pages, PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.url: r.checked_at for r in QUERIES["upsert_last_wins"](spark, str(tmp_path)).collect()}
    assert got == {"a": 1_000_003.0, "b": 7.0, "c": 1_000_009.0, "d": 5.0, None: 11.0, "e": 10.0}
    assert equals_sql(spark, tmp_path, "upsert_last_wins")
