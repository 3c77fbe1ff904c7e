"""Cases given as literals, the same in Spark and in the oracle: run by the tests, and over all orders by case_queries. None reads a table, so none is registered."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import http, media, text, urls
from siltstone.operators import classify, frontier, html, state

QUERIES: dict = {}
ORACLE_SQL: dict = {}
NOW = 1_700_000_000


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _values(name: str, columns: str, rows: list[tuple]) -> str:
    show = lambda x: "null" if x is None else "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x).lower() if isinstance(x, bool) else str(x)
    return f"{name}({columns}) as (values {', '.join('(' + ', '.join(map(show, r)) + ')' for r in rows)})"


COUNTS = [(None, 0), (None, 1), (None, 12), (None, 13), (None, 24), (None, 62254), ("?page=7", 5), ("?a=1&page=10&b", 0), ("?p=1", 25)]


def paged(rows):
    return rows.select("href", "total", urls.search_pages(F.col("href"), F.col("total")).alias("pages"))


@query(f"with {_values('t', 'href, total', COUNTS)} select href, total::bigint as total, coalesce(try_cast(nullif(regexp_extract(href, '[?&]page=([0-9]+)', 1), '') as bigint) + 1, (total + 11) // 12)::bigint as pages from t")
def page_count_boundaries(spark, d):
    return paged(spark.createDataFrame(COUNTS, "href string, total long"))


@query("select i as pos, 'https://media.example.org/search?page=' || i as url from range(40) r(i)")
def search_urls(spark, d):
    return frontier.search_urls(spark, "https://media.example.org/search?page=", 62254, 40)


WAITS = [("",), ("30",), ("900",), (" 1200 ",), ("soon",), (None,), ("Tue, 14 Nov 2023 23:13:20 GMT",), ("Tue, 14 Nov 2023 22:14:20 GMT",), ("-5",)]
_DATED = f"""case when {{0}} like '%GMT' then greatest({{1}}, epoch(strptime(regexp_replace({{0}}, '^[A-Za-z]+, ', ''), '%d %b %Y %H:%M:%S GMT'))::bigint - {NOW} + 1)
 when try_cast(trim({{0}}) as bigint) is not null then greatest({{1}}, try_cast(trim({{0}}) as bigint)) else {{1}} end"""


@query(f"with {_values('t', 'wait', WAITS)} select wait, ({_DATED.format('wait', 300)})::bigint as seconds from t")
def retry_after(spark, d):
    rows = spark.createDataFrame(WAITS, "wait string")
    return rows.select("wait", http.retry_after(F.col("wait"), F.lit(float(NOW))).alias("seconds"))


RANGES = [("bytes 0-0/1234", 0), ("BYTES 0-0/9", 0), ("bytes 0-0/*", 0), ("bytes 100-199/200", 100), ("bytes 100-200/200", 100), ("bytes 50-99/200", 100), ("", 0), ("bytes 0-0/99999999999999999999", 0)]
_PART = "try_cast(nullif(regexp_extract(r, '^bytes ([0-9]+)-([0-9]+)/([0-9]+)$', {}, 'i'), '') as bigint)"


def ranged(rows):
    return rows.select("r", "o", http.probe_range(F.col("r")).alias("probe"), http.resume_range(F.col("r"), F.col("o")).alias("resume"))


@query(f"""with {_values('t', 'r, o', RANGES)} select r, o::bigint as o, try_cast(nullif(regexp_extract(r, '^bytes 0-0/([0-9]+)$', 1, 'i'), '') as bigint) as probe,
case when {_PART.format(1)} = o and o <= {_PART.format(2)} and {_PART.format(2)} < {_PART.format(3)} then {_PART.format(3)} end as resume from t""")
def content_range(spark, d):
    return ranged(spark.createDataFrame(RANGES, "r string, o long"))


LENGTHS = [("100", ""), ("0", ""), ("-1", ""), ("1e3", ""), ("", ""), ("100", "chunked"), ("9223372036854775807", ""), ("9223372036854775808", "")]


def lengths(rows):
    return rows.select("n", "e", http.content_length(F.col("n"), F.col("e")).alias("size"))


@query(f"with {_values('t', 'n, e', LENGTHS)} select n, e, case when regexp_matches(n, '^[0-9]+$') and e = '' and try_cast(n as bigint) > 0 then try_cast(n as bigint) end as size from t")
def content_length(spark, d):
    return lengths(spark.createDataFrame(LENGTHS, "n string, e string"))


TYPES = [("audio/MPEG; q=1", '"a"'), (" Text/HTML ;x", 'W/"a"'), ("", ""), ("application/octet-stream", '"'), ("audio/mp3", "x")]


@query(f"with {_values('t', 'c, e', TYPES)} select c, e, lower(trim(split_part(c, ';', 1))) as mime, (length(e) > 1 and e like '\"%\"') as strong from t")
def mime_and_etag(spark, d):
    return spark.createDataFrame(TYPES, "c string, e string").select("c", "e", http.essence(F.col("c")).alias("mime"), http.strong_etag(F.col("e")).alias("strong"))


FETCHES = [(s, w, c) for s in (200, 204, 301, 400, 403, 404, 410, 418, 429, 500, 503) for w in ("", "1000") for c in (False, True)]


def fetched(rows):
    return rows.withColumn("v", classify.fetch_class(F.col("status"), F.col("wait"), F.col("challenge"), F.lit(float(NOW)))).select("status", "wait", "challenge", "v.label", "v.blocked", "v.delay")


@query(f"""with {_values('t', 'status, wait, challenge', FETCHES)}, w as (select *, (case when wait = '' then 0 else 1000 end) as asked from t)
select status::int as status, wait, challenge,
case when status in (404, 410) then 'permanent' when status = 429 or (status in (200, 403, 503) and challenge) or status = 403 or status >= 500 then 'retry' when status >= 400 then 'error' else 'ok' end as label,
case when status in (404, 410) then null when status = 429 or (status in (200, 403, 503) and challenge) or status = 403 then true when status >= 500 then wait <> '' when status >= 400 then false end as blocked,
(case when status in (404, 410) then null when status = 429 then greatest(300, asked) when status in (200, 403, 503) and challenge and wait <> '' then greatest(300, asked) when status in (200, 403, 503) and challenge then 900
 when status = 403 then greatest(900, asked) when status >= 500 then greatest(300, asked) when status >= 400 then 60 end)::bigint as delay from w""")
def fetch_class(spark, d):
    return fetched(spark.createDataFrame(FETCHES, "status int, wait string, challenge boolean"))


PROBES = [(m, s, t, n, r, w) for m in ("HEAD", "GET") for s in (200, 206, 404, 401, 429, 500, 501) for t, n, r in (("audio/mpeg", "1234", ""), ("audio/mpeg", "1", "bytes 0-0/777"), ("text/html", "99", ""), ("application/octet-stream", "", "")) for w in ("", "500")]
_PROBE = _values("t", "method, status, type, n, r, wait", PROBES)
_SIZE = """case when type = 'text/html' then null when status = 200 then nullif(try_cast(nullif(n, '') as bigint), 0) when status = 206 and method = 'GET' and r <> '' then 777 end"""


def probed(rows):
    heads = F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in ("content-type", F.col("type"), "Content-Length", F.col("n"), "Content-Range", F.col("r"), "Retry-After", F.col("wait"))])
    v = classify.probe_class(F.col("method"), F.col("status"), heads, F.lit(float(NOW)))
    return rows.withColumn("v", v).select(*rows.columns, "v.label", "v.size_bytes")


@query(f"""with {_PROBE}, z as (select *, {_SIZE} as size from t)
select method, status::int as status, type, n, r, wait,
case when status in (401, 403, 429) or wait <> '' then 'retry' when status >= 500 and not (method = 'HEAD' and status = 501) then 'retry' when method = 'GET' and status in (404, 410) then 'missing'
 when size is not null then 'known' when method = 'HEAD' then 'next' when type = 'text/html' then 'retry' else 'unknown' end as label,
case when status in (401, 403, 429) or wait <> '' then null when status >= 500 and not (method = 'HEAD' and status = 501) then null when method = 'GET' and status in (404, 410) then null else size::bigint end as size_bytes from z""")
def probe_class(spark, d):
    return probed(spark.createDataFrame(PROBES, "method string, status int, type string, n string, r string, wait string"))


MEDIA = [(s, t, w, x) for s in (200, 206, 401, 403, 404, 408, 416, 425, 429, 500, 503) for t in ("audio/mpeg", "text/html; charset=utf-8") for w in ("", "60") for x in ("", "Unexpected Error", "just a moment")]


def classified(rows):
    heads = F.create_map(F.lit("Content-Type"), F.col("type"), F.lit("Retry-After"), F.col("wait"))
    puzzled = classify.challenge_text(F.col("sample"), F.col("sample"))
    v = classify.media_class(F.col("status"), heads, F.col("sample"), puzzled, F.lit(float(NOW)))
    return rows.withColumn("v", v).select(*rows.columns, "v.label", "v.delay")


@query(f"""with {_values('t', 'status, type, wait, sample', MEDIA)}, p as (select *, (type like '%html%' or status in (401, 403, 503)) as page, sample = 'just a moment' as challenge, sample = 'Unexpected Error' as broken from t)
select status::int as status, type, wait, sample,
case when wait <> '' or status = 429 then 'retry' when status in (404, 410) then 'missing' when page and (status in (401, 403) or challenge) then 'retry' when page and (status >= 500 or broken) then 'retry' when page then 'invalid'
 when status >= 500 or status in (408, 425) then 'retry' else 'usable' end as label,
(case when wait <> '' or status = 429 then 300 when status in (404, 410) then null when page and (status in (401, 403) or challenge) then 300 when page and (status >= 500 or broken) then 60 when page then null
 when status >= 500 or status in (408, 425) then 60 end)::bigint as delay from p""")
def media_class(spark, d):
    return classified(spark.createDataFrame(MEDIA, "status int, type string, wait string, sample string"))


TRANSFERS = [
    (200, 0, "", "", True, "ID3", ".mp3", 100, "100", "", "done"), (200, 0, "", "", True, "ID3", ".mp3", 90, "100", "", "retry"), (200, 0, "", "", True, "ID3", ".mp3", 0, "", "", "retry"),
    (206, 50, '"a"', '"a"', True, "ID3", ".mp3", 100, "", "bytes 50-99/100", "done"), (206, 50, '"b"', '"a"', True, "ID3", ".mp3", 100, "", "bytes 50-99/100", "restart"),
    (206, 50, '"a"', '"a"', False, "ID3", ".mp3", 100, "", "bytes 50-99/100", "restart"), (416, 50, "", '"a"', True, "", None, 50, "", "", "restart"), (206, 50, '"a"', '"a"', True, "ID3", ".mp3", 100, "", "bytes 40-99/100", "invalid"),
    (404, 0, "", "", True, "", None, 0, "", "", "invalid"), (200, 0, "", "", True, "<html>", None, 10, "10", "", "invalid"), (200, 0, "", "", True, "<p>try again later", None, 10, "10", "", "retry"), (200, 0, "", "", True, "zzz", None, 3, "3", "", "invalid"),
]


@query(f"with {_values('t', 'status, o, etag, old, same, head, ext, size, n, r, label', TRANSFERS)} select status::int as status, head, r, label from t")
def transfer_class(spark, d):
    rows = spark.createDataFrame(TRANSFERS, "status int, o long, etag string, old string, same boolean, head string, ext string, size long, n string, r string, want string")
    heads = F.create_map(F.lit("ETag"), F.col("etag"), F.lit("Content-Length"), F.col("n"), F.lit("Content-Range"), F.col("r"))
    v = classify.transfer_class(F.col("status"), heads, F.col("o"), F.col("old"), F.col("same"), F.col("head"), F.col("ext"), F.col("size"))
    return rows.select("status", "head", "r", v["label"].alias("label"))


RECEIPTS = [(True, True, "fr/a.mp3", 5, 5, ".mp3", True), (True, True, "../a.mp3", 5, 5, ".mp3", False), (True, False, "fr/a.mp3", 5, 5, ".mp3", False), (False, True, "fr/a.mp3", 5, 5, ".mp3", False), (True, True, "fr/a.mp3", 4, 5, ".mp3", False), (True, True, "fr/a.mp3", 5, 5, None, False), (True, True, "/etc/a.mp3", 5, 5, ".mp3", False), (True, None, "fr/a.mp3", 5, 5, ".mp3", False), (True, True, "fr/b.mp3", None, 5, ".mp3", False)]


@query(f"with {_values('t', 'm, c, f, a, b, e, valid', RECEIPTS)} select m, c, f, a::bigint as a, e, valid from t")
def receipt_check(spark, d):
    rows = spark.createDataFrame(RECEIPTS, "m boolean, c boolean, f string, a long, b long, e string, want boolean")
    return rows.select("m", "c", "f", "a", "e", classify.receipt_valid(*map(F.col, "mcfabe")).alias("valid"))


AUDITS = [(True, None, None, "non_testee"), (False, None, "exploitable", "exploitable"), (False, None, "sans_contenu", "sans_contenu"), (False, "unrecognized", None, "a_verifier"), (False, "permanent", None, "introuvable"), (False, "incomplete", None, "a_reessayer")]


@query(f"with {_values('t', 's, k, o, status', AUDITS)} select s, k, status from t")
def audit_status(spark, d):
    rows = spark.createDataFrame(AUDITS, "s boolean, k string, o string, want string")
    return rows.select("s", "k", classify.audit_status(F.col("s"), F.col("k"), F.col("o")).alias("status"))


FAILS = [("page", "unrecognized", None, False, "outcome", "a_verifier", False), ("page", "http", 404, False, "outcome", "introuvable", False), ("page", "http", 410, True, "outcome", "introuvable", False), ("page", "http", 503, True, "defer", None, True), ("search", "http", 404, False, "defer", None, False), ("count", "http", 500, False, "defer", None, False)]


@query(f"with {_values('t', 'kind, error_kind, status, blocked, action, outcome, stops', FAILS)} select kind, error_kind, status::int as status, action, outcome, stops from t")
def defer_dispatch(spark, d):
    rows = spark.createDataFrame([r[:4] for r in FAILS], "kind string, error_kind string, status int, blocked boolean")
    return state.dispatch_failures(rows).select("kind", "error_kind", "status", "action", "outcome", "stops")


OLD = [("page", "u1", "Sans audio ni dossier x", True), ("page", "u2", "sans audio NI dossier", True), ("page", "u3", "other", False), ("search", "u1", "Sans audio ni dossier", False), ("page", "u9", "Sans audio ni dossier", False)]


@query(f"with {_values('t', 'kind, url, error, gone', OLD)} select kind, url from t where not gone")
def upgrade_parser(spark, d):
    rows = spark.createDataFrame([r[:3] for r in OLD], "kind string, url string, error string")
    queue = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string")
    return state.upgrade_schedule(rows, queue, "Sans audio ni dossier", False).select("kind", "url")


HOPS = [("http://a/1", 301, "/2"), ("http://a/2", 302, "http://b/x"), ("http://b/x", 200, None), ("http://a/l", 307, "/l"), ("http://a/n", 302, None), ("http://a/f", 303, "ftp://c/z")]


@query("select * from (values ('http://a/1', 'http://b/x', 2, null), ('http://a/l', null, 9, 'too many redirects'), ('http://a/n', null, 0, 'no location'), ('http://a/f', null, 0, 'not http'), ('http://q/', 'http://q/', 0, null)) t(url, final_url, hops, error)")
def redirects(spark, d):
    asked = spark.createDataFrame([("http://a/1",), ("http://a/l",), ("http://a/n",), ("http://a/f",), ("http://q/",)], "url string")
    return classify.follow_redirects(asked, spark.createDataFrame(HOPS, "url string, status int, location string"))


MAGIC = [("ID3x", "49443300"), ("frame", "00fffb90c4"), ("flac", "664c6143"), ("ogg", "4f676753"), ("wav", "524946460000000057415645"), ("m4a", "00000020667479704d344120"), ("m4v", "00000020667479704d345620"), ("text", "3c68746d6c3e"), ("short", "ff"), ("bad rate", "fffbf0c4"), ("reserved", "ffeb90c4")]


@query("select * from (values ('ID3x', '.mp3'), ('frame', '.mp3'), ('flac', '.flac'), ('ogg', '.ogg'), ('wav', '.wav'), ('m4a', '.m4a'), ('m4v', null), ('text', null), ('short', null), ('bad rate', null), ('reserved', null)) t(name, extension)")
def audio_magic(spark, d):
    rows = spark.createDataFrame(MAGIC, "name string, hex string")
    return rows.select("name", media.audio_extension(F.unhex("hex")).alias("extension"))


FOLDERS = [("1", "Français,Anglais, Anglais "), ("2", ""), ("3", "a/b:c"), ("4", "CON"), ("5", "lpt1.x"), ("6", " ,\t"), ("7", "x. ")]


@query("select * from (values ('1', 'Anglais + Français'), ('2', 'langue_inconnue'), ('3', 'a_b_c'), ('4', '_CON'), ('5', '_lpt1.x'), ('6', 'langue_inconnue'), ('7', 'x')) t(id, folder)")
def language_folder(spark, d):
    rows = spark.createDataFrame(FOLDERS, "id string, labels string")
    return rows.select("id", text.language_folder(F.split("labels", ",")).alias("folder"))


SLUGS = [("1", "Éléphant & Cie — n°5"), ("2", "CON"), ("3", "中文"), ("4", "  --a--  "), ("5", "x" * 60), ("6", "com3"), ("7", "a" * 47 + " b")]


@query(f"select * from (values ('1', 'elephant-cie-n5'), ('2', 'lang-con'), ('3', 'inconnue'), ('4', 'a'), ('5', '{'x' * 48}'), ('6', 'lang-com3'), ('7', '{'a' * 47}')) t(id, slug)")
def slug_cases(spark, d):
    return spark.createDataFrame(SLUGS, "id string, t string").select("id", text.slug(F.col("t")).alias("slug"))


def _card(href: str, title: str, label: str, kind: str = "page-media") -> str:
    return f'<article class="node--type-{kind} node--view-mode-teaser"><div class="wrapper-bundle">{label}</div><div class="wrapper-content"><h3><a href="{href}">{title}</a></h3></div></article>'


SITE = "https://media.example.org"
PAGES = [
    ("/list", f'<html><body><div class="search-results">{_card("/p1", "One", "Vidéo")}{_card("/p2", "Two", "Dossier")}{_card("/p1", "Again", "PODCAST")}{_card(" ", "none", "x")}</div></body></html>'),
    ("/c", f'<html><body><article class="node--view-mode-full node--type-dossier"><h1>Set</h1><video><source src="/a.mp3" type="audio/mp3; x"><source src="b.mp3" type="AUDIO/MPEG"><source src="v.mp4" type="video/mp4"></video><div id="videos">{_card("/p1#t", "One", "Vidéo")}{_card("https://other.org/x", "Out", "")}</div><h2>Podcasts</h2><div>{_card("/p3", "Three", "Son")}</div><h2>Suggestions</h2><div>{_card("/p9", "Nine", "")}</div><div class="wrapper-langues"><span class="wrapper-langue">Français</span><span class="wrapper-langue"> Anglais </span></div><ul><li class="pager__item--next"><a href="?page=1">next</a></li></ul></article></body></html>'),
    ("/empty", '<html><body><main><h1>Nothing</h1><p>text</p></main></body></html>'),
    ("/cut", '<html><body><main><h1>Cut</h1>'),
    ("/frame", '<html><body><main><h1>F</h1><iframe src="x"></iframe></main></body></html>'),
    ("/denied", '<html><head><title>Access Denied</title></head><body><main><h1>x</h1></main></body></html>'),
    ("/no", "<p>nothing</p>"),
]


def _pages(spark):
    return spark.createDataFrame([(SITE + p, h) for p, h in PAGES], "url string, html string")


@query(f"select * from (values (0, '{SITE}/p1', 'podcast'), (1, '{SITE}/p2', 'dossier')) t(pos, url, type_)")
def search_items(spark, d):
    return html.parse_searches(_pages(spark).where("url like '%/list'")).select("pos", "url", "type_")


@query(f"select * from (values (0, '{SITE}/p1', 'Vidéo'), (1, '{SITE}/p3', 'Son'), (2, '{SITE}/p9', ''), (3, '{SITE}/c?page=1', 'pagination')) t(pos, url, type_)")
def collection_children(spark, d):
    return html.parse_pages(_pages(spark).where("url like '%/c'")).select(F.inline("page.pages"))


@query(f"select * from (values ('{SITE}/a.mp3', 'Set', 'Français; Anglais'), ('{SITE}/b.mp3', 'Set', 'Français; Anglais')) t(audio_url, title, lang)")
def page_media(spark, d):
    return html.media_rows(html.parse_pages(_pages(spark))).select("audio_url", "title", "lang")


@query(f"select '{SITE}' || p as url, status, kind from (values ('/list', null, 'incomplete'), ('/c', 'exploitable', null), ('/empty', 'sans_contenu', null), ('/cut', null, 'incomplete'), ('/frame', null, 'unrecognized'), ('/denied', null, 'incomplete'), ('/no', null, 'incomplete')) t(p, status, kind)")
def page_status(spark, d):
    return html.parse_pages(_pages(spark)).select("url", F.col("page.status").alias("status"), F.col("page.error_kind").alias("kind"))


@query(f"select * from (values ('audios', 2), ('visited', 2), ('queue', 4), ('page_outcomes', 2), ('retry_schedule', 1)) t(name, n)")
def save_page(spark, d):
    make = spark.createDataFrame
    tables = {
        "audios": make([], "id long, url string, audio_url string, file_name string, title string, desc_ string, lang string, cite string, license string, lieu string, doi string"),
        "visited": make([(SITE + "/c",)], "url string"), "queue": make([(SITE + "/c", "x"), (SITE + "/p1", "y")], "url string, type_ string"),
        "page_outcomes": make([(SITE + "/c", "a_verifier", "", 1.0)], "url string, status string, detail string, checked_at double"),
        "retry_schedule": make([("page", SITE + "/c", 1, 5.0, "e"), ("page", SITE + "/cut", 1, 5.0, "e")], "kind string, url string, attempts int, next_attempt double, error string"),
    }
    after = state.save_pages(html.parse_pages(_pages(spark)), tables, 2.0)
    counts = [df.agg(F.count("*").cast("int").alias("n")).select(F.lit(n).alias("name"), "n") for n, df in after.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
