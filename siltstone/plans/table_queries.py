"""Queries over the driver's tables."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from siltstone.functions import text, urls
from siltstone.operators import frontier, html, reports, state
from siltstone.plans import views as v
from siltstone.sources.files import load, shared_folder

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def page_links(spark, d):
    """page_id, source, place and reference of every anchor of the pages, the url that it resolves to, and the page's own."""
    rows = html.parse_anchors(load(spark, d, "pages").select("page_id", "url", "html"))
    # Outer, since an inner explode would have the pages parsed once more, to leave out those without links.
    rows = rows.select("page_id", F.col("url").alias("source"), F.posexplode_outer("hrefs").alias("pos", "href")).where("href is not null")
    return rows.select("*", urls.resolve("source", "href").alias("to"), urls.resolve("source", F.lit("")).alias("base"))


_LINKS = """links as (select page_id, url as source, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) as site,
  unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as href from pages)"""


@query(f"with {_LINKS} select regexp_extract(t, '://([^/?#]*)', 1) as host, count(*) as n from (select distinct site || href as t from links) where t not in (select url from pages) group by 1")
def frontier_new_urls(spark, d):
    items = page_links(spark, d).select(F.struct("page_id", "pos").alias("pos"), F.col("to.plain").alias("url"), F.lit("").alias("type_"), F.col("to.netloc").alias("host"))
    pages = load(spark, d, "pages").select("url")
    fresh = frontier.new_urls(items, pages, pages.limit(0))
    return fresh.groupBy(F.regexp_extract("url", "://([^/?#]*)", 1).alias("host")).agg(F.count("*").alias("n"))


@query(f"with {_LINKS} select page_id, count(*) as links, count(distinct href) as different from links group by page_id")
def link_counts(spark, d):
    return page_links(spark, d).groupBy("page_id").agg(F.count("*").alias("links"), F.countDistinct("to.url").alias("different"))


@query(f"with {_LINKS} select count(*) as n, count(*) as same from links")
def frontier_same_host(spark, d):
    return page_links(spark, d).agg(F.count("*").alias("n"), F.sum(urls.same_site(F.col("to"), F.col("base")).cast("long")).alias("same"))


@query("select page_id, regexp_extract(url, '^([a-z]+)://', 1) as scheme, regexp_extract(url, '://([^/?#]*)', 1) as netloc, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) as path, regexp_replace(url, '#.*', '') as plain from pages")
def url_parts(spark, d):
    at = urls.resolve("url", F.lit(""))
    return load(spark, d, "pages").select("page_id", "url").select("page_id", at.alias("at")).select("page_id", "at.scheme", "at.netloc", "at.path", "at.plain")


# References as HTML reads them: the semicolon may be missing, as where a page cut one short; that of & comes last.
_TITLE = "regexp_extract(html, '<h1>([^<]*)</h1>', 1)"
for _ref, _sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#x27", "''"), ("amp", "&")):
    _TITLE = f"regexp_replace({_TITLE}, '&{_ref};?', '{_sign}', 'g')"


@query(f"select page_id, trim({_TITLE}) as title from pages")
def page_title(spark, d):
    return html.parse_pages(load(spark, d, "pages")).select("page_id", F.col("page.h1").alias("title"))


@query("select page_id, not regexp_matches(html, '</html\\s*>', 'i') as truncated from pages")
def page_truncation(spark, d):
    return load(spark, d, "pages").select("page_id", (~F.col("html").rlike(r"(?i)</html\s*>")).alias("truncated"))


@query("select 'incomplete' as error_kind, 'no content' as error, count(*) as n from pages")
def page_validity(spark, d):
    parsed = html.parse_pages(load(spark, d, "pages"))
    return parsed.groupBy(F.col("page.error_kind").alias("error_kind"), F.col("page.error").alias("error")).agg(F.count("*").alias("n"))


@query(f"with {v.OUTCOMES} select status, count(*) as n from page_outcomes group by status")
def outcome_counts(spark, d):
    return reports.outcome_counts(v.page_outcomes(spark, d))


_SUMMARY = f"""with {v.AUDIOS}, {v.SIZES},
summary as (select coalesce(s.status, 'pending') as status, count(*) as n, cast(coalesce(sum(case when s.status = 'known' then s.size_bytes end), 0) as bigint) as known_bytes
from (select distinct audio_url from audios where trim(audio_url) <> '') a left join audio_sizes s on s.audio_url = a.audio_url group by 1)"""


@query(_SUMMARY + " select * from summary")
def size_summary(spark, d):
    return reports.size_summary(v.audios(spark, d), v.audio_sizes(spark, d))


@query(_SUMMARY + """, t as (select cast(sum(n) as bigint) as total, cast(sum(case when status = 'known' then n else 0 end) as bigint) as known, cast(sum(known_bytes) as bigint) as known_bytes from summary)
select *, case when known > 0 and known < total then cast(round_even(known_bytes / known * total, 0) as bigint) end as estimate from t""")
def coverage_projection(spark, d):
    return reports.coverage(reports.size_summary(v.audios(spark, d), v.audio_sizes(spark, d)))


@query(f"""with {v.AUDIOS}, {v.SIZES} select distinct a.audio_url from audios a left join audio_sizes s on s.audio_url = a.audio_url
where trim(a.audio_url) <> '' and (s.audio_url is null or (s.status = 'retry' and s.next_attempt <= {v.NOW}))""")
def pending_sizes(spark, d):
    return reports.pending_sizes(v.audios(spark, d), v.audio_sizes(spark, d), F.lit(v.NOW))


@query(f"with {v.SCHEDULE} select count(*) as queued, count(*) filter (where next_attempt is null) as suspended from retry_schedule")
def queue_size(spark, d):
    rows = v.retry_schedule(spark, d)
    return rows.agg(F.count("*").alias("queued"), F.count_if(F.col("next_attempt").isNull()).alias("suspended"))


@query(f"with {v.SCHEDULE} select greatest(min(next_attempt), 0) as deadline from retry_schedule")
def next_retry(spark, d):
    return reports.next_deadline(v.retry_schedule(spark, d), F.lit(0.0))


@query(f"with {v.SIZES} select greatest(min(next_attempt), {v.NOW}) as deadline from audio_sizes where status = 'retry'")
def next_size_retry(spark, d):
    return reports.next_deadline(v.audio_sizes(spark, d).where("status = 'retry'"), F.lit(v.NOW))


@query(f"with {v.AUDIOS}, {v.DOWNLOADS} select min(greatest(next_attempt, {v.NOW}e0)) as deadline from downloads where output_root = 'r0' and status = 'retry' and audio_url in (select audio_url from audios where lang = 'fr')")
def next_download_retry(spark, d):
    chosen = reports.language_media(v.audios(spark, d), ["fr"])
    rows = reports.of_root(v.downloads(spark, d), "r0").where("status = 'retry'").join(chosen, "audio_url", "left_semi")
    return reports.next_deadline(rows, F.lit(v.NOW))


@query(f"with {v.SCHEDULE}, {v.SIZES}, x as (select (select min(greatest(next_attempt, {v.NOW + 900}e0)) from retry_schedule) as a, (select min(greatest(next_attempt, {v.NOW + 900}e0)) from audio_sizes where status = 'retry') as b) select least(a, b) as deadline from x")
def global_deadline(spark, d):
    pause = F.lit(v.NOW + 900)
    a = reports.next_deadline(v.retry_schedule(spark, d), pause)
    b = reports.next_deadline(v.audio_sizes(spark, d).where("status = 'retry'"), pause)
    return spark.range(1).select(reports.earliest(a.scalar(), b.scalar()).alias("deadline"))


@query(f"with {v.SCHEDULE} select kind, url, cast(attempts as int) as attempts, next_attempt from retry_schedule")
def backoff_schedule(spark, d):
    return v.retry_schedule(spark, d).select("kind", "url", "attempts", "next_attempt")


@query(f"with {v.SCHEDULE} select url, count(*) as n from retry_schedule where next_attempt is null group by url")
def suspended_users(spark, d):
    return reports.suspended(v.retry_schedule(spark, d)).groupBy("url").agg(F.count("*").alias("n"))


@query(f"with {v.SCHEDULE} select max(seen + greatest(60, least(3600, 60 * power(2, least(attempts - 1, 10))))) as pause_until from schedule0")
def pause_until(spark, d):
    rows = state.folded(v.failures(spark, d), ["kind", "url"]).select(F.col("n").alias("attempts"), F.col("last.at").alias("at"), F.lit(60).alias("delay"), F.lit(True).alias("blocked"))
    return state.pause_until(F.lit(0.0), rows)


@query(f"""with {v.SCHEDULE} select w.url, w.kind from (select distinct url, kind from failures union all select 'new', 'k') w
left join retry_schedule r on r.url = w.url and r.kind = w.kind where r.url is null or r.next_attempt <= 1.8e9""")
def retry_ready(spark, d):
    schedule = v.retry_schedule(spark, d)
    work = schedule.select("kind", "url").union(spark.createDataFrame([("k", "new")], "kind string, url string"))
    keyed = lambda df: df.withColumn("url", F.concat_ws("|", "kind", "url")).withColumn("kind", F.lit("all"))
    due = frontier.ready(keyed(work).drop("kind"), keyed(schedule), "all", F.lit(1.8e9))
    return due.select(F.split_part("url", F.lit("|"), F.lit(2)).alias("url"), F.split_part("url", F.lit("|"), F.lit(1)).alias("kind"))


_JOBS = """, jobs as (select audio_url, min(id) as first_id, arg_min(title, id) as t from audios {where} group by audio_url),
p as (select audio_url, string_agg(url, ',' order by seen) as pages from (select audio_url, url, min(id) as seen from audios group by 1, 2) group by 1),
l as (select audio_url, string_agg(lang, ',' order by seen) as languages from (select audio_url, lang, min(id) as seen from audios where lang <> '' group by 1, 2) group by 1)
select jobs.audio_url, first_id, case when coalesce(t, '') = '' then 'audio' else t end as title, pages, coalesce(languages, '') as languages
from jobs join p on p.audio_url = jobs.audio_url left join l on l.audio_url = jobs.audio_url"""


def _flat(jobs):
    return jobs.withColumns({"pages": F.array_join("pages", ","), "languages": F.array_join("languages", ",")})


@query(f"with {v.AUDIOS}" + _JOBS.format(where=""))
def jobs_grouped(spark, d):
    return _flat(reports.download_jobs(v.audios(spark, d)))


@query(f"with {v.AUDIOS}" + _JOBS.format(where="where audio_url in (select audio_url from audios where trim(coalesce(lang, '')) in ('fr', ''))"))
def jobs_language_filter(spark, d):
    return _flat(reports.download_jobs(v.audios(spark, d), ["fr", ""]))


@query(f"""with {v.AUDIOS}, {v.DOWNLOADS}, j as (select audio_url, min(id) as first_id from audios group by 1)
select j.audio_url, first_id from j left join (select * from downloads where output_root = 'r0') s on s.audio_url = j.audio_url
where coalesce(s.status, 'pending') = 'pending' or (s.status = 'retry' and s.next_attempt <= {v.NOW}) order by first_id limit 20""")
def jobs_limited(spark, d):
    return reports.eligible_jobs(reports.download_jobs(v.audios(spark, d)), v.downloads(spark, d), F.lit(v.NOW), 20, "r0").select("audio_url", "first_id")


@query(f"with {v.DOWNLOADS}, mine as (select * from downloads where output_root = 'r0') select status, count(*) as n, cast(coalesce(sum(size_bytes), 0) as bigint) as bytes, (select cast(coalesce(sum(size_bytes), 0) as bigint) from mine where status = 'done') as bytes_done from mine group by status")
def download_report(spark, d):
    return reports.download_report(v.downloads(spark, d), "r0")


@query(f"with {v.AUDIOS} select count(*) as n, cast(sum(id) as bigint) as ids from (select min(id) as id from audios group by lang, audio_url)")
def dedupe_media(spark, d):
    rows = v.audios(spark, d).select("id", F.col("lang").alias("url"), "audio_url")
    return state.first_wins(rows.limit(0), rows, ["url", "audio_url"], "id").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


# One row of each url: a new one if there is any, of several the last checked, of equal times the larger status.
@query(f"""with {v.OUTCOMES}, written as (select url, status, '' as detail, cast(page_id as double) as checked_at, 0 as new from page_outcomes
union all select url, 'exploitable', '', page_id + 1e6, 1 from page_outcomes where page_id % 3 = 0)
select url, status, detail, checked_at from (select *, row_number() over (partition by url order by new desc, checked_at desc nulls last, status desc) as n from written) where n = 1""")
def upsert_last_wins(spark, d):
    old = v.page_outcomes(spark, d)
    new = old.where("checked_at % 3 = 0").withColumns({"status": F.lit("exploitable"), "checked_at": F.col("checked_at") + 1e6})
    return state.last_wins(old, new, ["url"], "checked_at")


@query("select count(*) as n from (select distinct url from pages)")
def add_visited_pages(spark, d):
    """Even pages are visited first, each url once; then the others, and every third page once more. Null urls, which equal nothing, count as one."""
    pages = load(spark, d, "pages")
    even = F.coalesce(F.col("page_id") % 2 == 0, F.lit(False))
    visited = state.first_wins(pages.select("url").limit(0), pages.where(even).select("url"), ["url"], "url")
    rows = state.first_wins(visited, pages.where(~even | (F.col("page_id") % 3 == 0)).select("url"), ["url"], "url")
    return rows.agg((F.count("url") + F.coalesce(F.max(F.col("url").isNull().cast("long")), F.lit(0))).alias("n"))


@query(f"""with {v.AUDIOS}, {v.DOWNLOADS}, x as (select *, output_root = 'r0' and status in ('retry', 'suspended', 'invalid') and audio_url in (select audio_url from audios where lang = 'de') as again from downloads)
select output_root, audio_url, case when again then 'pending' else status end as status, file_path, size_bytes, case when again then 0 else attempts end as attempts, case when not again then next_attempt end as next_attempt, detail, updated_at from x""")
def reset_failed(spark, d):
    return state.reset_failed(v.downloads(spark, d), reports.language_media(v.audios(spark, d), ["de"]), "r0")


@query(f"""with {v.DOWNLOADS}, x as (select *, status = 'done' and size_bytes % 2 = 1 as lost from downloads)
select output_root, audio_url, case when lost then 'pending' else status end as status, file_path, size_bytes, case when lost then 0 else attempts end as attempts, case when not lost then next_attempt end as next_attempt, detail, updated_at from x""")
def repair_downloads(spark, d):
    rows = v.downloads(spark, d)
    return state.repair_downloads(rows, rows.where("size_bytes % 2 = 0"))


@query(f"with {v.AUDIOS}, {v.DOWNLOADS} select id, audio_url, case when audio_url in (select audio_url from downloads where status = 'done' and size_bytes % 2 = 1) then '' else 'old' end as file_name from audios")
def repaired_names(spark, d):
    rows, named = v.downloads(spark, d), v.audios(spark, d).withColumn("file_name", F.lit("old"))
    return state.repair_downloads(rows, rows.where("size_bytes % 2 = 0"), named)[1].select("id", "audio_url", "file_name")


@query(f"""with {v.SIZES}, x as (select *, status = 'retry' as failed from audio_sizes)
select audio_url, size_bytes, final_url, case when not failed then status when attempts + 1 < 5 then 'retry' else 'suspended' end as status, method, case when failed then 'late' else detail end as detail,
case when failed then {v.NOW + 1}e0 else checked_at end as checked_at, cast(case when failed then attempts + 1 else attempts end as int) as attempts,
case when not failed then next_attempt when attempts + 1 < 5 then {v.NOW + 1}e0 + greatest(300, least(3600, 60 * power(2, attempts))) end as next_attempt from x""")
def defer_sizes(spark, d):
    sizes = v.audio_sizes(spark, d)
    fails = sizes.where("status = 'retry'").select("audio_url", F.lit(v.NOW + 1).alias("at"), F.lit(300).alias("delay"), F.lit("late").alias("error"))
    return state.defer_sizes(sizes, fails)


@query(f"""with {v.SIZES} select audio_url, case when attempts = 4 then 7 else size_bytes end as size_bytes, case when attempts = 4 then 'to' else final_url end as final_url, case when attempts = 4 then 'known' else status end as status,
method, case when attempts = 4 then 'found' else detail end as detail, case when attempts = 4 then {v.NOW + 1}e0 else checked_at end as checked_at, attempts, case when attempts <> 4 then next_attempt end as next_attempt from audio_sizes""")
def save_sizes(spark, d):
    sizes = v.audio_sizes(spark, d)
    found = sizes.where("attempts = 4").select("audio_url", F.lit(7).cast("long").alias("size_bytes"), F.lit("to").alias("final_url"), F.lit("known").alias("status"), F.lit("found").alias("detail"), F.lit(v.NOW + 1).alias("checked_at"))
    return state.save_sizes(sizes, found)


@query(f"""with {v.DOWNLOADS} select output_root, audio_url, case when attempts = 0 then 'missing' when attempts = 1 then 'invalid' when attempts + 1 < 5 then 'retry' else 'suspended' end as status, file_path, size_bytes, cast(attempts + 1 as int) as attempts,
case when attempts not in (0, 1) and attempts + 1 < 5 then {v.NOW + 1}e0 + greatest(60, least(3600, 60 * power(2, attempts))) end as next_attempt, 'x' as detail, {v.NOW + 1}e0 as updated_at from downloads""")
def fail_downloads(spark, d):
    rows = v.downloads(spark, d)
    kind = F.when(F.col("attempts") == 0, "missing").when(F.col("attempts") == 1, "invalid").otherwise("retry")
    fails = rows.select("output_root", "audio_url", F.lit(v.NOW + 1).alias("at"), F.lit(60).alias("delay"), F.lit("x").alias("error"), kind.alias("kind"))
    return state.fail_downloads(rows, fails)


def _finished(spark, d):
    rows = v.downloads(spark, d).where("attempts = 2")
    return rows.select("output_root", "audio_url", F.concat(F.lit("n/"), "audio_url").alias("file"), F.lit(9).cast("long").alias("size_bytes"), F.concat(F.lit("to-"), "audio_url").alias("final_url"), F.lit(v.NOW + 1).alias("at"))


@query(f"""with {v.DOWNLOADS}, x as (select *, attempts = 2 as fresh from downloads)
select output_root, audio_url, case when fresh then 'done' else status end as status, case when fresh then 'n/' || audio_url else file_path end as file_path, case when fresh then 9 else size_bytes end as size_bytes, attempts,
case when not fresh then next_attempt end as next_attempt, case when fresh then '' else detail end as detail, case when fresh then {v.NOW + 1}e0 else updated_at end as updated_at from x""")
def save_downloads(spark, d):
    return state.save_downloads(v.downloads(spark, d), v.audios(spark, d), v.audio_sizes(spark, d), _finished(spark, d))[0]


@query(f"with {v.AUDIOS}, {v.DOWNLOADS} select id, audio_url, case when audio_url in (select audio_url from downloads where attempts = 2) then 'n/' || audio_url else '' end as file_name from audios")
def saved_names(spark, d):
    return state.save_downloads(v.downloads(spark, d), v.audios(spark, d), v.audio_sizes(spark, d), _finished(spark, d))[1].select("id", "audio_url", "file_name")


@query(f"""with {v.SIZES}, x as (select *, attempts = 2 as fresh from audio_sizes)
select audio_url, case when fresh then 9 else size_bytes end as size_bytes, case when fresh then 'to-' || audio_url else final_url end as final_url, case when fresh then 'known' else status end as status, case when fresh then 'DOWNLOAD' else method end as method,
case when fresh then 'Fichier téléchargé' else detail end as detail, case when fresh then {v.NOW + 1}e0 else checked_at end as checked_at, attempts, case when not fresh then next_attempt end as next_attempt from x""")
def saved_sizes(spark, d):
    return state.save_downloads(v.downloads(spark, d), v.audios(spark, d), v.audio_sizes(spark, d), _finished(spark, d))[2]


@query(f"with {v.SCHEDULE}, f as (select *, row_number() over (partition by kind, url order by seen) as attempts from failures) select 'pause_until' as key, greatest(1e6, max(seen + greatest(60, least(3600, 60 * power(2, least(attempts - 1, 10)))))) as value from f where cast(url as bigint) % 2 = 0")
def pause_written(spark, d):
    fails = v.failures(spark, d).withColumn("blocked", F.col("url").cast("long") % 2 == 0)
    empty = spark.createDataFrame([], "kind string, url string, attempts int")
    return state.paused(spark.createDataFrame([("pause_until", 1e6)], "key string, value double"), state.numbered(fails, empty, ["kind", "url"]))


@query(f"with {v.AUDIOS} select count(*) as n, 0 as unpaused from audios")
def pause_gate_closed(spark, d):
    rows = v.audios(spark, d)
    crawl = spark.createDataFrame([("pause_until", v.NOW + 1)], "key string, value double")
    shown = reports.when_running(rows, crawl, F.lit(v.NOW)).agg(F.count("*").alias("unpaused"))
    return rows.agg(F.count("*").alias("n")).select("n", shown.scalar().cast("int").alias("unpaused"))


# The graph of all orders: it grows with the table, and each node is a customer that ten orders lead to.
@query("with recursive edges as (select distinct o_custkey as a, o_orderkey // 10 as b from orders), r as (select 1 as n union select e.b from r join edges e on e.a = r.n) select count(*) as reached, cast(sum(n) as bigint) as total from r")
def reachability_orders(spark, d):
    edges = load(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("src"), F.expr("cast(o_orderkey div 10 as string)").alias("dst"))
    rows = frontier.reachable(spark.createDataFrame([("1",)], "url string"), edges, shared_folder(spark))
    return rows.agg(F.count("*").alias("reached"), F.sum(F.col("url").cast("long")).alias("total"))


@query("select page_id, sha256(url) || '.html' as name, substr(sha256(url), 1, 32) as key from pages")
def sha_names(spark, d):
    return load(spark, d, "pages").select("page_id", text.snapshot_name(F.col("url")).alias("name"), F.substring(F.sha2("url", 256), 1, 32).alias("key"))


def _compatible() -> tuple[str, str]:
    """SQL: a class of the characters that NFKD, but not the removal of accents, takes to ASCII; and a map to what it makes of them."""
    ascii_of = lambda form, c: unicodedata.normalize(form, c).encode("ascii", "ignore").decode()
    made = {c: ascii_of("NFKD", c) for c in map(chr, range(0x80, 0x20000)) if not 0xD800 <= ord(c) < 0xE000}
    made = {c: x for c, x in made.items() if x != ascii_of("NFD", c)}
    return "[" + "".join(rf"\x{{{ord(c):x}}}" for c in made) + "]", "map {" + ", ".join(f"'{c}': '{x.replace(chr(39), chr(39) * 2)}'" for c, x in made.items()) + "}"


_COMPATIBLE, _ASCII = _compatible()
_PLAIN = rf"""case when regexp_matches(text, '{_COMPATIBLE}') then array_to_string(list_transform(regexp_extract_all(text, '(?s).'), lambda c: coalesce(({_ASCII})[c], c)), '') else text end"""


# Whole texts, compatible letters spelt out and accents removed; slug drops every sharp s, which strip_accents would spell out. Names of devices get a prefix.
@query(rf"""select doc_id, case when s = '' then 'inconnue' when regexp_full_match(s, '{text.DEVICES}') then 'lang-' || s else s end as slug from (select doc_id,
regexp_replace(substr(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(regexp_replace({_PLAIN}, '[ßẞ]', '', 'g')), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 48), '-+$', '') as s from documents)""")
def slug_texts(spark, d):
    return load(spark, d, "documents").select("doc_id", text.slug(F.col("text")).alias("slug"))


@query(f"with {v.AUDIOS} select audio_url, string_agg(distinct lang, ' + ' order by lang) as folder from audios where lang is not null group by audio_url")
def language_folders(spark, d):
    jobs = reports.download_jobs(v.audios(spark, d))
    return jobs.select("audio_url", text.language_folder(F.col("languages")).alias("folder"))


@query("select event_id, printf('%dj %02d:%02d:%02d', s // 86400, s // 3600 % 24, s // 60 % 60, s % 60) as shown from (select event_id, greatest(0, cast(floor(value * 1000) as bigint)) as s from events)")
def duration_fmt(spark, d):
    return load(spark, d, "events").select("event_id", text.duration(F.floor(F.col("value") * 1000)).alias("shown"))


@query("select l_orderkey, l_linenumber, printf('%.3f Go (%.3f Gio)', n / 1e9, n / 1073741824) as shown from (select l_orderkey, l_linenumber, cast(l_partkey * 1000003 as double) as n from lineitem)")
def bytes_fmt(spark, d):
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.format_bytes(F.col("l_partkey") * 1000003).alias("shown"))


@query("""select o_orderkey, case when o_custkey % 50 = 0 then 100e0 else least(100e0, 100e0 * (o_orderkey % 40) / (o_custkey % 50)) end as percent,
case when greatest(0, o_custkey % 50 - o_orderkey % 40) = 0 then 0e0 when o_orderkey % 40 > 0 then 90e0 / (o_orderkey % 40) * (o_custkey % 50 - o_orderkey % 40) end as eta, (o_orderkey % 40) / 90e0 as rate from orders""")
def progress_report(spark, d):
    done, total = F.col("o_orderkey") % 40, F.col("o_custkey") % 50
    cols = text.progress(done.cast("double"), total.cast("double"), F.lit(90.0))
    return load(spark, d, "orders").select("o_orderkey", *[c.alias(n) for n, c in cols.items()])


@query("with t as (select url, page_id as seen, 'page' as kind from pages union all select 'm' || doc_id, doc_id, 'size' from labels) select kind, url, row_number() over (order by kind desc, case when kind = 'size' then -seen else seen end) as place from (select kind, url, min(seen) as seen from t group by 1, 2)")
def task_order(spark, d):
    pages = load(spark, d, "pages").select("url", F.col("page_id").alias("pos"))
    sizes = load(spark, d, "labels").select(F.concat(F.lit("m"), "doc_id").alias("url"), F.col("doc_id").alias("pos"))
    return frontier.placed_tasks(pages, sizes)


@query("select count(*) as n, cast(sum(seen) as bigint) as places from (select lang, source, min(doc_id) as seen from documents group by 1, 2)")
def ordered_distinct(spark, d):
    rows = frontier.ordered_distinct(load(spark, d, "documents"), "doc_id", "lang", "source")
    return rows.agg(F.count("*").alias("n"), F.sum("doc_id").alias("places"))


@query("select source, string_agg(lang, '|' order by lang) as labels from (select distinct source, lang from documents where lang is not null) group by source")
def label_sets(spark, d):
    rows = load(spark, d, "documents").select("source", "lang").distinct().groupBy("source").agg(F.collect_list("lang").alias("langs"))
    return rows.select("source", F.array_join(text.sorted_labels(F.col("langs")), "|").alias("labels"))


@query(f"with {v.SCHEDULE} select count(*) as n from retry_schedule where not (attempts >= 2 and kind like '2024%')")
def clear_retry(spark, d):
    rows = v.retry_schedule(spark, d)
    return state.clear(rows, rows.where("attempts >= 2 and kind like '2024%'"), ["kind", "url"]).agg(F.count("*").alias("n"))


@query(f"with {v.AUDIOS} select count(*) as n, count(*) as unpaused from audios")
def pause_gate(spark, d):
    rows = v.audios(spark, d)
    crawl = spark.createDataFrame([("pause_until", v.NOW)], "key string, value double")
    shown = reports.when_running(rows, crawl, F.lit(v.NOW)).agg(F.count("*").alias("unpaused"))
    return rows.agg(F.count("*").alias("n")).select("n", shown.scalar().alias("unpaused"))
