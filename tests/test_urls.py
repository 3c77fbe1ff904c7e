"""Resolution of references by Spark expressions against the standard library's."""

import random

from pyspark.sql import functions as F

from siltstone.functions import urls
from siltstone.operators import html
from siltstone.plans import table_queries

BASE = "http://a/b/c/d;p?q"
# The examples of RFC 3986, 5.4.1 and 5.4.2.
REFERENCES = (
    "g:h g ./g g/ /g //g ?y g?y #s g#s g?y#s ;x g;x g;x?y#s . ./ .. ../ ../g ../.. ../../ ../../g ../../../g ../../../../g /./g /../g g. .g g.. ..g ./../g ./g/. g/./h g/../h "
    "g;x=1/./y g;x=1/../y g?y/./x g?y/../x g#s/./x g#s/../x http:g"
).split() + [""]
ODD = [
    ("http://h", "x"), ("http://h", ""), ("http://h/", "?"), ("http://h/a?b", "#"), ("http://h/a//b/", "c//d"), ("http://h/a//b/c", "../x"), ("HTTP://H/a", "HTTP:b"), ("http://h/a", "HTTPS://G"), ("http://h/a", "//g"),
    ("http://h/a", "mailto:x@y"), ("http://h/a", "javascript:void(0)"), ("http://h/a", " b c "), ("http://h/a", "b\n\tc"), ("", "x"), ("x", ""), ("x/y", "../z"), ("http://h/a", "///p"), ("http://h/a", "//"), ("file:///a/b", "c"),
    ("http://h/a", "http://[::1]/x"), ("http://h/a", "http://[::1/x"), ("http://h/a", "a:b:c"), ("http://h/a", "1:2"), ("http://h/a#f", "b"), ("http://h/a?x#f", "#g"), ("http://h/a", "é/ü?ß#ñ"), ("http://h/a;p", ";x"), ("http://h/a/b;p=1", "c;q"),
    ("ftp://h/a", "/b/./c/../d"), ("http://u:p@h:80/a", "b"), ("http://h/a", ".."), ("http://h/a", "../.."), ("http://h", ".."), ("http://h?q", "x"), ("http://h/a/", "."), ("tel:1", "x"), ("http://h/a", "?a=b?c#d?e#f"), ("http://h/%7Ea", "%2E%2E/x"),
]


def compared(spark, pairs):
    rows = spark.createDataFrame([(i, b, h) for i, (b, h) in enumerate(pairs)], "i long, b string, h string").withColumn("r", urls.resolve("b", "h"))
    got = {r.i: (tuple(r.r) if r.r is not None else None) for r in rows.collect()}
    return [(p, got[i], urls.split_resolved(*p)) for i, p in enumerate(pairs) if got[i] != urls.split_resolved(*p)]


def test_resolution(spark):
    assert compared(spark, [(BASE, r) for r in REFERENCES] + ODD) == []
    none = spark.createDataFrame([(None, "a"), ("a", None)], "b string, h string").select(urls.resolve("b", "h").alias("r"))
    assert [r.r for r in none.collect()] == [None, None]


def test_resolution_of_made_references(spark):
    rng = random.Random(21)
    piece = lambda: "".join(rng.choice(["a", "b", "/", "/", ".", "..", "../", "./", "?", "#", ";", ":", "=", "//", "%20", "é", "http:", "https://g", " "]) for _ in range(rng.randint(0, 7)))
    bases = ["http://h/a/b/c", "https://h.org", "http://h//x/../y/?q#f", "http://h/a/./b/..", "//h/p", "p/q"]
    assert compared(spark, list(dict.fromkeys((rng.choice(bases), piece()) for _ in range(4000)))) == []


def test_links_of_pages(spark, sf_dir):
    """Every link of the pages resolves as in Python, and only the anchors are read there."""
    rows = table_queries.page_links(spark, sf_dir)
    got = {(r.page_id, r.pos): (r.href, r.to.url, r.to.plain, r.to.netloc) for r in rows.collect()}
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    want = {(i, k): (h, *(urls.split_resolved(p.url, h)[j] for j in (0, 1, 3))) for i, p in pages.items() for k, h in enumerate(html.anchors(p.html))}
    assert got == want and len(got) > 200
    counted = rows.groupBy(F.col("to.netloc")).count()._jdf.queryExecution().executedPlan().toString()
    assert counted.count("ArrowEvalPython") == 1 and "pythonUDF" in counted
