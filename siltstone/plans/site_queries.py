"""Extraction, decisions and state over a site, responses and logs that Spark makes of whole tables.

``site`` renders a page of every document: its fields, media and cards follow from the document's columns, so
that SQL knows from the same columns what a page says. Responses are made of line items and events likewise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import http, media, text
from siltstone.operators import classify, frontier, html, reports, state
from siltstone.plans import crawl
from siltstone.plans import views as v
from siltstone.sources import files
from siltstone.sources.files import load
from siltstone.streaming.retries import windowed_counts

QUERIES: dict = {}
ORACLE_SQL: dict = {}
SITE, NOW = "https://media.example.org", 1_704_240_000


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _escaped(c: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def _url(n: Column) -> Column:
    return F.concat(F.lit(f"{SITE}/d"), n.cast("string"))


def _each(n: Column, render) -> Column:
    """What render makes of 1 to n, one after another."""
    return F.array_join(F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), render), "")


def _card(href: Column, label: Column) -> Column:
    return F.concat(F.lit('<article class="node--type-page-media node--view-mode-teaser"><div class="wrapper-bundle">'), label, F.lit('</div><div class="wrapper-content"><h3><a href="'), href, F.lit('">t</a></h3></div></article>'))


def documents(spark, d) -> DataFrame:
    rows = load(spark, d, "documents")
    plain = {c: F.coalesce(c, F.lit("")) for c in ("text", "lang", "source")}
    return rows.select("doc_id", *[c.alias(n) for n, c in plain.items()], F.coalesce("n_chars", F.lit(0)).alias("n_chars"))


def site(spark, d) -> DataFrame:
    """doc_id, url, html: a page of every document. It has as many media as n_chars % 3 says and cards of as many of the next documents as n_chars % 4 says; every seventh length cuts it short."""
    doc, n = F.col("doc_id").cast("string"), F.col("n_chars")
    field = lambda classes, inner, c: F.concat(F.lit(f'<div class="{classes}"><div class="{inner}">'), c, F.lit("</div></div>"))
    media_tags = _each((n % 3).cast("int"), lambda j: F.concat(F.lit('<source src="/a'), doc, F.lit("-"), j.cast("string"), F.lit('.mp3" type="audio/mp3; x">')))
    cards = _each((n % 4).cast("int"), lambda j: _card(F.concat(F.lit("/d"), (F.col("doc_id") + j).cast("string"), F.lit("#top")), F.col("source")))
    page = F.concat(
        F.lit('<html><body><article class="node--view-mode-full node--type-page-media"><h1>'), F.col("source"), F.lit(" "), doc, F.lit("</h1>"),
        field("field--name-field-description", "x", _escaped(F.col("text"))), field("field--name-field-lieu", "field__item", F.col("source")), field("field-condition-utilisation", "field__item", F.concat(F.lit("L"), n.cast("string"))),
        field("field-citation-ressource", "field__item", F.concat(F.lit("C"), doc)), field("id-doi-datacite", "field__items", F.concat(F.lit("10.1/"), doc)),
        F.lit('<div class="wrapper-langues"><span class="wrapper-langue">'), F.col("lang"), F.lit('</span><span class="wrapper-langue">'), F.col("lang"), F.lit("</span></div><video>"), media_tags, F.lit('</video><div id="videos">'), cards,
        F.lit("</div></article></body>"), F.when(n % 7 == 0, "").otherwise("</html>"),
    )
    return documents(spark, d).select("doc_id", _url(F.col("doc_id")).alias("url"), page.alias("html"))


_DOCS = f"""docs as (select doc_id, '{SITE}/d' || doc_id as url, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(n_chars, 0) as n_chars, coalesce(n_chars, 0) % 7 = 0 as cut from documents)"""
_KEY = "md5(regexp_replace({}, '[^A-Za-z0-9]', '', 'g'))"


@query(f"""with {_DOCS} select url, case when cut then '' else source || ' ' || doc_id end as titre, case when cut then {_KEY.format("''")} else {_KEY.format('text')} end as desc_key, case when cut then '' else source end as lieu,
case when cut then '' else 'L' || n_chars end as cdt, case when cut then '' else 'C' || doc_id end as citation, case when cut then '' else '10.1/' || doc_id end as doi, case when cut then '' else lang end as langues from docs""")
def site_fields(spark, d):
    p = F.col("page")
    key = F.md5(F.regexp_replace(p["desc"], "[^A-Za-z0-9]", ""))
    return html.parse_pages(site(spark, d)).select("url", p["titre"].alias("titre"), key.alias("desc_key"), *[p[c].alias(c) for c in ("lieu", "cdt", "citation", "doi")], F.array_join(p["langues"], "; ").alias("langues"))


@query(f"""with {_DOCS} select url, cast(j - 1 as int) as pos, '{SITE}/a' || doc_id || '-' || j as audio, source || ' ' || doc_id as title, lang, 'L' || n_chars as license from docs, range(1, 3) r(j) where not cut and j <= n_chars % 3""")
def site_media(spark, d):
    rows = html.media_rows(html.parse_page(html.parse_pages(site(spark, d))).where("has_audio"))
    return rows.select("url", "pos", F.regexp_replace("audio_url", r"\.mp3$", "").alias("audio"), "title", "lang", "license")


@query(f"with {_DOCS} select url, cast(j - 1 as int) as pos, '{SITE}/d' || (doc_id + j) as child, source as type_ from docs, range(1, 4) r(j) where not cut and j <= n_chars % 4")
def site_children(spark, d):
    return html.parse_pages(site(spark, d)).select(F.col("url").alias("page_url"), F.inline("page.pages")).select(F.col("page_url").alias("url"), "pos", F.col("url").alias("child"), "type_")


@query(f"with {_DOCS} select url, case when cut then null when n_chars % 3 > 0 or n_chars % 4 > 0 then 'exploitable' else 'sans_contenu' end as status, case when cut then 'incomplete' end as error_kind, case when cut then 'truncated' end as error from docs")
def site_status(spark, d):
    return html.parse_pages(site(spark, d)).select("url", "page.status", "page.error_kind", "page.error")


@query(f"""with {_DOCS}, cards as (select doc_id, j, doc_id + j as child, upper(source) as label from docs, range(1, 4) r(j) where j <= n_chars % 4 union all select doc_id, 9, doc_id + 1, 'Again' from docs where n_chars % 2 = 1)
select '{SITE}/s' || doc_id as source, cast(row_number() over (partition by doc_id order by min(j)) - 1 as int) as pos, '{SITE}/d' || child as url, lower(arg_max(label, j)) as type_ from cards group by doc_id, child""")
def site_searches(spark, d):
    """A search page of each document: its cards, the first of them once more in every second."""
    n, child = F.col("n_chars"), lambda j: F.concat(F.lit("/d"), (F.col("doc_id") + j).cast("string"))
    cards = _each((n % 4).cast("int"), lambda j: _card(child(j), F.upper("source")))
    page = F.concat(F.lit('<html><main><div class="search-results">'), cards, F.when(n % 2 == 1, _card(child(F.lit(1)), F.lit("Again"))).otherwise(""), F.lit("</div></main></html>"))
    rows = documents(spark, d).select(F.concat(F.lit(f"{SITE}/s"), F.col("doc_id").cast("string")).alias("url"), page.alias("html"))
    return html.parse_searches(rows).select("source", "pos", "url", "type_")


def _saved(spark, d) -> dict[str, DataFrame]:
    """All tables after the whole site was read for the first time."""
    empty = {t: spark.createDataFrame([], files.SCHEMAS[t]) for t in crawl.TABLES}
    return state.save_pages(files.stored(html.parse_pages(site(spark, d)), "site-parsed"), empty, 5.0)


@query(f"""with {_DOCS}, links as (select url as page, j, doc_id + j as child, source from docs, range(1, 4) r(j) where not cut and j <= n_chars % 4),
fresh as (select '{SITE}/d' || child as url, arg_min(source, struct_pack(page, j)) as type_, min(struct_pack(page, j)) as pos from links group by 1)
select row_number() over (order by pos) as id, url, type_ from fresh where url not in (select url from docs where not cut)""")
def site_queue(spark, d):
    return _saved(spark, d)["queue"]


@query(f"""with {_DOCS} select row_number() over (order by url, j) as id, url, '{SITE}/a' || doc_id || '-' || j || '.mp3' as audio_url, 'C' || doc_id as cite, '10.1/' || doc_id as doi from docs, range(1, 3) r(j) where not cut and j <= n_chars % 3""")
def site_audios(spark, d):
    return _saved(spark, d)["audios"].select("id", "url", "audio_url", "cite", "doi")


@query(f"with {_DOCS} select url, case when n_chars % 3 > 0 or n_chars % 4 > 0 then 'exploitable' else 'sans_contenu' end as status, (n_chars % 3) || ' audio(s), ' || (n_chars % 4) || ' lien(s)' as detail, 5e0 as checked_at from docs where not cut")
def site_outcomes(spark, d):
    return _saved(spark, d)["page_outcomes"]


@query(f"""with {_DOCS}, listed as (select doc_id as pos, '{SITE}/d' || 2 * doc_id as url from documents)
select pos, listed.url, case when docs.url is null or cut then 'a_reessayer' when n_chars % 3 > 0 or n_chars % 4 > 0 then 'exploitable' else 'sans_contenu' end as status,
case when docs.url is null then null when cut then 0 else n_chars % 3 end::int as audios, case when docs.url is null then null when cut then 0 else n_chars % 4 end::int as pages, case when docs.url is not null then sha256(listed.url) || '.html' end as html_name
from listed left join docs on docs.url = listed.url""")
def site_audit(spark, d):
    listed = load(spark, d, "documents").select(F.col("doc_id").alias("pos"), _url(2 * F.col("doc_id")).alias("url"))
    rows = crawl.audit(listed, site(spark, d))
    here = F.col("html_name").isNotNull()
    return rows.select("pos", "url", "status", F.when(here, F.col("audios")).alias("audios"), F.when(here, F.col("pages")).alias("pages"), "html_name")


@query(f"select i as pos, '{SITE}/q?page=' || i as url from (select unnest(range((count(*) + 11) // 12)) as i from documents)")
def search_urls_of_documents(spark, d):
    return frontier.search_urls(spark, f"{SITE}/q?page=", -(-load(spark, d, "documents").count() // 12))


_MAGIC = {"en": ("494433", ".mp3"), "fr": ("664c6143", ".flac"), "de": ("4f676753", ".ogg"), "es": ("000000206674797" + "04d344120", ".m4a")}


@query("select doc_id, case lang " + " ".join(f"when '{k}' then '{e}'" for k, (_, e) in _MAGIC.items()) + " end as extension from documents")
def signatures(spark, d):
    """Whole texts behind the signature that their language stands for, or behind none."""
    begin = F.lit("")
    for lang, (magic, _) in _MAGIC.items():
        begin = F.when(F.col("lang") == lang, magic).otherwise(begin)
    content = F.concat(F.unhex(begin), F.encode(F.concat(F.lit("x"), F.coalesce("text", F.lit(""))), "utf-8"))
    return load(spark, d, "documents").select("doc_id", media.audio_extension(content).alias("extension"))


@query("""select doc_id, lower('Text/' || coalesce(lang, '')) as mime, n_chars % 3 = 0 as strong from documents""")
def content_types(spark, d):
    kind = F.concat(F.lit(" Text/"), F.upper(F.coalesce("lang", F.lit(""))), F.lit(" ; charset="), F.coalesce("source", F.lit("")))
    tag = F.concat(F.when(F.col("n_chars") % 3 == 1, "W/").otherwise(""), F.lit('"'), F.col("n_chars").cast("string"), F.when(F.col("n_chars") % 3 == 2, "").otherwise('"'))
    return load(spark, d, "documents").select("doc_id", http.essence(kind).alias("mime"), http.strong_etag(tag).alias("strong"))


@query("""select doc_id, coalesce(lang, 'langue_inconnue') || '/' || lower(source) || '-' || doc_id || '__' || substr(sha256('m' || doc_id), 1, 32) as path, '_state/' || sha256('m' || doc_id) || '.partial.json' as checkpoint, '_state/' || sha256('m' || doc_id) || '.json' as receipt
from documents where source is not null""")
def media_paths(spark, d):
    url, labels = F.concat(F.lit("m"), F.col("doc_id").cast("string")), F.when(F.col("lang").isNotNull(), F.array("lang")).otherwise(F.array().cast("array<string>"))
    checkpoint, receipt = text.state_paths(url)
    rows = load(spark, d, "documents").where("source is not null")
    return rows.select("doc_id", text.media_path(url, F.concat("source", F.lit(" "), F.col("doc_id").cast("string")), labels).alias("path"), checkpoint.alias("checkpoint"), receipt.alias("receipt"))


@query(f"""with w as (select event_id, case event_type when 'error' then cast(cast(floor(value * 60) as bigint) as varchar) when 'view' then strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') when 'click' then 'soon' end as wait, event_type, value, ts from events)
select event_id, cast(case event_type when 'error' then greatest(300, floor(value * 60)) when 'view' then greatest(300, epoch(date_trunc('second', ts)) - {NOW} + 1) else 300 end as bigint) as seconds from w""")
def waits_of_events(spark, d):
    """Retry-After as a number of seconds, as a date, as nonsense and missing."""
    date = F.date_format(F.col("ts").cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    wait = F.when(F.col("event_type") == "error", F.floor(F.col("value") * 60).cast("string")).when(F.col("event_type") == "view", date).when(F.col("event_type") == "click", "soon")
    return load(spark, d, "events").select("event_id", http.retry_after(wait, F.lit(float(NOW))).alias("seconds"))


@query("""with t as (select event_id, cast(400 + floor(value) % 130 as int) as status, user_id % 3 = 0 as challenge, event_type = 'error' as asked from events)
select event_id, case when status in (404, 410) then 'permanent' when status = 429 or status >= 500 or (status >= 400 and not challenge) then 'retry' else 'ok' end as label,
case when status in (404, 410) then null when status = 429 then true when status >= 500 then asked when not challenge then true end as blocked,
case when status in (404, 410) then null when status = 429 or status >= 500 then case when asked then 1000 else 300 end when not challenge then 900 end::bigint as delay from t""")
def browsed_events(spark, d):
    status, wait = (400 + F.floor(F.col("value")) % 130).cast("int"), F.when(F.col("event_type") == "error", "1000").otherwise("")
    seen = classify.browser_class(status, wait, F.col("user_id") % 3 == 0, F.lit(float(NOW)))
    return load(spark, d, "events").select("event_id", seen.alias("v")).select("event_id", "v.label", "v.blocked", "v.delay")


@query("""with t as (select event_id, case when event_type in ('error', 'view') then 'page' else 'search' end as kind, case when event_type = 'view' then 'unrecognized' else 'http' end as error_kind, cast(400 + user_id % 15 as int) as status, value > 20 as blocked from events),
o as (select *, case when kind = 'page' and error_kind = 'unrecognized' then 'a_verifier' when kind = 'page' and status in (404, 410) then 'introuvable' end as outcome from t)
select event_id, outcome, case when outcome is null then 'defer' else 'outcome' end as action, outcome is null and blocked as stops from o""")
def dispatched_events(spark, d):
    kind, error = F.when(F.col("event_type").isin("error", "view"), "page").otherwise("search"), F.when(F.col("event_type") == "view", "unrecognized").otherwise("http")
    rows = load(spark, d, "events").select("event_id", kind.alias("kind"), error.alias("error_kind"), (400 + F.col("user_id") % 15).cast("int").alias("status"), (F.col("value") > 20).alias("blocked"))
    return state.dispatch_failures(rows).select("event_id", "outcome", "action", "stops")


_LINE = "l_orderkey, l_linenumber, cast(l_quantity as bigint) as q, cast(l_partkey as bigint) + 60 as total, l_suppkey % 4 = 0 as moved, l_linestatus = 'O' as whole, l_returnflag = 'R' as short, l_linenumber % 4 as head"


@query(f"""with t as (select {_LINE} from lineitem), u as (select *, case when short then total - 1 else total end as size from t)
select l_orderkey, l_linenumber, case when not whole and q > 0 and moved then 'restart' when head = 1 then 'invalid' when head = 2 then 'retry' when head = 3 then 'invalid' when short then 'retry' else 'done' end as label from u""")
def transfers_of_lines(spark, d):
    """A transfer of each line item: whole or resumed, moved meanwhile or not, cut short or not, audio, page, error or neither at its head."""
    rows = load(spark, d, "lineitem").selectExpr(*[x.strip() for x in _LINE.split(", ")])
    size = F.when(F.col("short"), F.col("total") - 1).otherwise(F.col("total"))
    span = F.concat(F.lit("bytes "), F.col("q").cast("string"), F.lit("-"), (F.col("total") - 1).cast("string"), F.lit("/"), F.col("total").cast("string"))
    heads = F.create_map(F.lit("ETag"), F.when(F.col("moved"), '"b"').otherwise('"a"'), F.lit("Content-Length"), F.when(F.col("whole"), F.col("total").cast("string")).otherwise(""), F.lit("Content-Range"), F.when(F.col("whole"), "").otherwise(span))
    first = F.element_at(F.array(*[F.lit(x) for x in ("ID3", "<html>", "<p>Try again later", "zzz")]), (F.col("head") + 1).cast("int"))
    v = classify.transfer_class(F.when(F.col("whole"), 200).otherwise(206), heads, F.when(F.col("whole"), 0).otherwise(F.col("q")), F.lit('"a"'), F.lit(True), first, F.when(F.col("head") == 0, ".mp3"), size)
    return rows.select("l_orderkey", "l_linenumber", v["label"].alias("label"))


@query("select l_orderkey, l_linenumber, l_suppkey % 2 = 0 as resumable from lineitem where l_quantity > 0")
def resumable_lines(spark, d):
    tag = F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit('"'), F.col("l_suppkey").cast("string"), F.lit('"'))).otherwise(F.concat(F.lit('W/"'), F.col("l_suppkey").cast("string"), F.lit('"')))
    return load(spark, d, "lineitem").where("l_quantity > 0").select("l_orderkey", "l_linenumber", classify.resumable(F.col("l_quantity"), F.lit(True), tag).alias("resumable"))


@query("select l_orderkey, l_linenumber, l_returnflag <> 'R' and l_linestatus = 'O' and l_linenumber <> 2 and l_linenumber <> 3 and l_suppkey % 5 > 0 and l_partkey % 7 > 0 as valid from lineitem")
def receipts_of_lines(spark, d):
    """A receipt of each line item: of another url, not complete, outside the root, of another size, or of no audio file."""
    file = F.when(F.col("l_linenumber") == 2, "../a.mp3").when(F.col("l_linenumber") == 3, "/a.mp3").otherwise(F.concat(F.col("l_orderkey").cast("string"), F.lit("/a..mp3")))
    size = F.col("l_partkey") + F.when(F.col("l_suppkey") % 5 == 0, 1).otherwise(0)
    ok = classify.receipt_valid(F.col("l_returnflag") != "R", F.col("l_linestatus") == "O", file, size, F.col("l_partkey"), F.when(F.col("l_partkey") % 7 > 0, ".mp3"))
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", ok.alias("valid"))


def _moves(spark, d) -> DataFrame:
    """A redirect of each order to the order that has its customer's number, unless it is of every fifth number."""
    to = F.concat(F.lit("/o"), F.col("o_custkey").cast("string"))
    return load(spark, d, "orders").select(F.concat(F.lit("http://h/o"), F.col("o_orderkey").cast("string")).alias("url"), F.when(F.col("o_orderkey") % 5 == 0, 200).otherwise(302).alias("status"), F.when(F.col("o_orderkey") % 7 > 0, to).alias("location"))


@query("""with recursive w as (select o_orderkey as start, o_orderkey as node, 0 as hops from orders
  union all select w.start, o.o_custkey, hops + 1 from w join orders o on o.o_orderkey = w.node where hops < 9 and o.o_orderkey % 5 > 0 and o.o_orderkey % 7 > 0),
tops as (select start, arg_max(node, hops) as node, max(hops) as hops from w group by start),
e as (select tops.*, case when hops >= 9 then 'too many redirects' when o.o_orderkey % 5 > 0 and o.o_orderkey % 7 = 0 then 'no location' end as error from tops left join orders o on o.o_orderkey = tops.node)
select 'http://h/o' || start as url, case when error is null then 'http://h/o' || node end as final_url, hops, error from e""")
def redirects_of_orders(spark, d):
    moves = _moves(spark, d)
    return classify.follow_redirects(moves.select("url"), moves)


@query("select ts.start as start, ts.start + interval 1 hour as \"end\", event_type, count(*) as n from (select struct_pack(start := date_trunc('hour', ts)) as ts, event_type from events) group by all")
def hourly_events(spark, d):
    return windowed_counts(load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type").select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "event_type", "n")


@query(f"""with {v.SCHEDULE}, marked as (select *, case when attempts > 1 then 'Sans AUDIO' else 'other' end as error from retry_schedule where url is not null)
select kind, url, attempts from (select 'page' as kind, kind || '|' || url as url, cast(attempts as int) as attempts, error from marked) where not (error = 'Sans AUDIO' and split_part(url, '|', 2) in (select cast(user_id as varchar) from events where event_type = 'purchase' and value > 10))""")
def upgraded_schedule(spark, d):
    """Once after a new parser: old errors of queued pages are forgotten. The queue is of the pages of users that have bought."""
    error = F.when(F.col("attempts") > 1, "Sans AUDIO").otherwise("other")
    rows = v.retry_schedule(spark, d).select(F.lit("page").alias("kind"), F.concat_ws("|", "kind", "url").alias("url"), "attempts", "next_attempt", error.alias("error"))
    buyers = load(spark, d, "events").where("event_type = 'purchase' and value > 10").select(F.col("user_id").cast("string").alias("user")).distinct()
    queue = rows.join(buyers, F.split_part("url", F.lit("|"), F.lit(2)) == F.col("user"), "left_semi").select("url")
    return state.upgrade_parser(rows, queue, spark.createDataFrame([], files.SCHEMAS["crawl_state"]), "sans audio")[0].select("kind", "url", "attempts")


def _logged(spark, d) -> DataFrame:
    """Errors are failures of a user's day, purchases and signups clear it."""
    rows = load(spark, d, "events").where("event_type in ('error', 'purchase', 'signup')")
    return rows.select("event_id", F.lit("page").alias("kind"), F.col("user_id").cast("string").alias("url"), F.expr(v.EPOCH).alias("at"), (F.col("event_type") != "error").alias("cleared"), F.lit(60).cast("long").alias("delay"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("error"))


_LOG = """log as (select event_id, cast(user_id as varchar) as url, epoch_us(ts) / 1e6 as seen, event_type <> 'error' as cleared from events where event_type in ('error', 'purchase', 'signup')),
parts as (select *, count(*) filter (cleared) over (partition by url order by seen, event_id) as segment from log),
history as (select *, count(*) filter (not cleared) over (partition by url, segment order by seen, event_id) as attempts from parts)"""


@query(f"with {_LOG} select event_id, segment, attempts from history")
def retry_history(spark, d):
    return state.attempts_history(_logged(spark, d)).select("event_id", "segment", "attempts")


@query(f"""with {_LOG}, tops as (select url, arg_max(attempts, struct_pack(seen, event_id)) as attempts, arg_max(seen, struct_pack(seen, event_id)) filter (not cleared) as seen, arg_max(event_id, struct_pack(seen, event_id)) filter (not cleared) as id from history group by url)
select url, cast(attempts as int) as attempts, case when attempts < 5 then seen + greatest(60, least(3600, 60 * power(2, attempts - 1))) end as next_attempt, 'e' || id as error from tops where attempts > 0""")
def retry_log(spark, d):
    """All events, and then all of them once more: what a batch repeats counts nothing."""
    events = _logged(spark, d)
    log, seen = spark.createDataFrame([], state.LOG), spark.createDataFrame([], state.SEEN)
    for _ in range(2):
        log, seen = state.fold_log(log, seen, events)
    return state.log_schedule(log).select("url", "attempts", "next_attempt", "error")


@query(f"with {v.AUDIOS} select audio_url, min(id) as id from audios group by audio_url having count(*) > 1")
def shared_media(spark, d):
    """Media that several pages name, with the first of them."""
    rows = reports.download_jobs(v.audios(spark, d))
    return rows.where(F.size("pages") > 1).select("audio_url", F.col("first_id").alias("id"))
