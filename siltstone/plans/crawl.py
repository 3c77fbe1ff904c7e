"""A crawl over stored pages: what the frontier names and the page table holds is read, round by round."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import urls
from siltstone.operators import classify, frontier, html, reports, state
from siltstone.plans import flows
from siltstone.sources import files, receipts as receipt_files
from siltstone.sources.versions import Snapshot, Versions

TABLES = ("audios", "visited", "queue", "page_outcomes", "retry_schedule", "crawl_state", "audio_sizes", "downloads")


def tables(spark: SparkSession, folder: str, names=TABLES) -> dict[str, DataFrame]:
    """The tables of the current version."""
    held = Versions(spark, folder).latest()
    return {n: held.read(n) for n in names}


def is_paused(held: Snapshot, now: float) -> bool:
    return reports.when_running(held.spark.range(1), held.read("crawl_state"), F.lit(now)).isEmpty()


def _tops(held: Snapshot, *names: str) -> dict[str, int]:
    return {n: held.top(n) for n in names}


def crawl(spark: SparkSession, pages: DataFrame, folder: str, start: DataFrame, now: float, rounds: int = 100) -> int:
    """Reads pages (url, html) from the start urls (pos, url) on; returns the rounds that found something to read. Nothing while a pause lasts.

    Pages that cannot be read yet stay queued with a retry; those to be reviewed are done with.
    """
    store = Versions(spark, folder)
    held = store.latest()
    if is_paused(held, now):
        return 0
    items = start.select("pos", "url", F.lit("").alias("type_"))
    near = held.touched(items.select("url"))
    fresh = files.stored(frontier.new_items(items, held.read("visited", near), held.read("queue", near)), "start")
    own = held.touched(fresh.select("url"))
    queue = frontier.enqueue(held.read("queue", own), fresh, held.read("visited", own), held.top("queue"))
    held = store.commit(held, {"queue": (own, queue)})
    return page_rounds(spark, pages, store, held, now, rounds)


def page_rounds(spark: SparkSession, pages: DataFrame, store: Versions, held: Snapshot, now: float, rounds: int = 100) -> int:
    """Rounds over the queue, until one has nothing to read that is stored, or the last one was blocked. A round parses each of its pages once."""
    for n in range(rounds):
        if is_paused(held, now):
            return n
        due = frontier.ready(held.read("queue").select("url").distinct(), held.read("retry_schedule"), "page", F.lit(now))
        parsed = files.stored(html.parse_pages(pages.select("url", "html").join(due, "url", "left_semi")), "parsed")
        if parsed.isEmpty():
            return n
        held = store.commit(held, page_changes(held, parsed, pages, now, f"{store.folder}/pages_a_verifier"))
    return rounds


def page_changes(held: Snapshot, parsed: DataFrame, pages: DataFrame, now: float, snapshots: str) -> dict:
    """What a round's parsed pages change: of each table the buckets that they touch, and the rows in these. Pages to be reviewed are kept as snapshots."""
    own = held.touched(parsed.select("url"))
    links = files.stored(state.page_children(parsed), "links")
    near = own | held.touched(links.select("url"))
    visited, queue = held.read("visited", near), held.read("queue", near)
    read = parsed.where("page.error_kind is null").select("url")
    links = files.stored(frontier.new_items(links, visited.select("url").union(read), queue), "children")
    queued = own | held.touched(links.select("url"))
    before = {t: held.read(t, own) for t in ("audios", "visited", "page_outcomes", "retry_schedule")} | {"queue": held.read("queue", queued)}
    after = state.save_pages(parsed, before, now, _tops(held, "audios", "visited", "queue"), links)
    bad = parsed.where("page.error_kind is not null").select(
        F.lit("page").alias("kind"), "url", F.lit(now).alias("at"), F.lit(60).alias("delay"), F.col("page.error").alias("error"), F.col("page.error_kind").alias("error_kind"), F.lit(200).alias("status"), F.col("page.challenge").alias("blocked")
    )
    sent = state.dispatch_failures(bad)
    done, deferred = sent.where("action = 'outcome'"), sent.where("action = 'defer'")
    review = done.where("outcome = 'a_verifier'").select("url")
    files.write_snapshots(pages.select("url", "html").join(review, "url", "left_semi"), snapshots)
    where = F.when(F.col("outcome") == "a_verifier", F.concat(F.lit(f" ; HTML : {snapshots}/"), files.snapshot_path(F.col("url")))).otherwise("")
    rows = done.select("url", F.col("outcome").alias("status"), F.concat("error", where).alias("detail"), F.col("at").alias("checked_at"))
    after["page_outcomes"] = state.last_wins(after["page_outcomes"], rows, ["url"], "checked_at")
    after["visited"] = state.visit(before["visited"], read.union(done.select("url")), held.top("visited"))
    after["queue"] = state.clear(after["queue"], done, ["url"])
    after["retry_schedule"] = state.defer(after["retry_schedule"], deferred.select("kind", "url", "at", "delay", "error"))
    changes = {t: (queued if t == "queue" else own, rows) for t, rows in after.items()}
    if not sent.where("stops").isEmpty():
        blocked = state.numbered(deferred.select("kind", "url", "at", "delay", "blocked"), before["retry_schedule"], ["kind", "url"])
        changes["crawl_state"] = (None, state.paused(held.read("crawl_state"), blocked))
    return changes


def search_count(pages: DataFrame, first_url: str) -> DataFrame:
    """pages, the number of search pages, by the first one: its last pager link, else its counter; null if it is not stored or says neither."""
    page = html.parse_pages(pages.select("url", "html").where(F.col("url") == first_url)).select("page.last_page", "page.counter")
    return page.select(urls.search_pages(F.col("last_page"), urls.number_text(F.col("counter"))).alias("pages"))


def search_stage(spark: SparkSession, pages: DataFrame, store: Versions, held: Snapshot, prefix: str, now: float, cap: int | None = None) -> Snapshot:
    """Queues what the stored search pages list: those that are not visited and whose retry, if there is one, is due."""
    row = None if cap == 0 else search_count(pages, prefix + "0").first()
    todo = frontier.search_urls(spark, prefix, (row and row["pages"]) or 0, cap)
    near = held.touched(todo.select("url"))
    todo = frontier.eligible_searches(todo, held.read("visited", near), held.read("retry_schedule", near), F.lit(now))
    found = pages.select("url", "html").join(todo, "url")
    items = html.parse_searches(found).join(todo.select(F.col("url").alias("source"), F.col("pos").alias("page")), "source")
    items = files.stored(items.select("source", F.struct("page", "pos").alias("pos"), "url", "type_"), "search")
    source = files.stored(found.select("url"), "searched")
    own, near = held.touched(source), held.touched(items.select("url"))
    fresh = files.stored(frontier.new_items(items, held.read("visited", near), held.read("queue", near)), "found")
    queued = held.touched(fresh.select("url"))
    both = own | queued
    before = {t: held.read(t, both) for t in ("visited", "queue", "retry_schedule")}
    after = state.save_search(fresh, source, before, _tops(held, "visited", "queue"))
    return store.commit(held, {"visited": (own, after["visited"]), "queue": (queued, after["queue"]), "retry_schedule": (own, after["retry_schedule"])})


def crawl_site(spark: SparkSession, pages: DataFrame, folder: str, prefix: str, now: float, cap: int | None = None, rounds: int = 100, probes: DataFrame | None = None, redirects: DataFrame | None = None) -> dict:
    """The whole crawl over stored responses: count, search pages, pages and, where probes are given, sizes; nothing while a pause lasts, also one that a stage has begun.

    Returns whether it ran, the rounds over the queue, and the next deadline.
    """
    store = Versions(spark, folder)
    held, n = store.latest(), 0
    running = not is_paused(held, now)
    if running:
        held = search_stage(spark, pages, store, held, prefix, now, cap)
        n = page_rounds(spark, pages, store, held, now, rounds)
        if probes is not None:
            size_pass(spark, probes, folder, now, redirects)
    return {"ran": running, "rounds": n, "next": next_deadline(spark, folder)}


def size_pass(spark: SparkSession, probes: DataFrame, folder: str, now: float, redirects: DataFrame | None = None) -> bool:
    """One pass over stored probes of the media whose size is pending; whether it ran, which it does not while a pause lasts."""
    store = Versions(spark, folder)
    held = store.latest()
    if is_paused(held, now):
        return False
    none = spark.createDataFrame([], "url string, status int, location string")
    own = held.touched(probes.select("audio_url"))
    before = {t: held.read(t) for t in ("audios", "crawl_state")} | {"audio_sizes": held.read("audio_sizes", own)}
    after = flows.size_stage(before, probes, redirects if redirects is not None else none, now)
    store.commit(held, {"audio_sizes": (own, after["audio_sizes"]), "crawl_state": (None, after["crawl_state"])})
    return True


def _pause(held: dict[str, DataFrame]) -> Column:
    return F.lit(held["crawl_state"].where("key = 'pause_until'").agg(F.max("value")).first()[0]).cast("double")


def next_size(held: dict[str, DataFrame]) -> float | None:
    return reports.next_deadline(held["audio_sizes"].where("status = 'retry'"), _pause(held)).first()[0]


def next_download(held: dict[str, DataFrame], root: str | None = None, languages: list[str] | None = None) -> float | None:
    rows = reports.of_root(held["downloads"], root).where("status = 'retry'")
    if languages is not None:
        rows = rows.join(reports.language_media(held["audios"], languages), "audio_url", "left_semi")
    return reports.next_deadline(rows, _pause(held)).first()[0]


def next_deadline(spark: SparkSession, folder: str) -> float | None:
    """When there is something to try again, a pause considered; None if there is nothing."""
    held = tables(spark, folder)
    found = [reports.next_deadline(held["retry_schedule"], _pause(held)).first()[0], next_size(held), next_download(held)]
    return min((x for x in found if x is not None), default=None)


def reset_pass(spark: SparkSession, folder: str, root: str, languages: list[str] | None = None) -> None:
    """Failed downloads of the root, of the languages if given, are pending again."""
    store = Versions(spark, folder)
    held = store.latest()
    chosen = reports.language_media(held.read("audios"), languages)
    failed = reports.of_root(held.read("downloads"), root).where("status in ('retry', 'suspended', 'invalid')")
    own = held.touched((failed if chosen is None else failed.join(chosen, "audio_url", "left_semi")).select("audio_url"))
    if own:
        store.commit(held, {"downloads": (own, state.reset_failed(held.read("downloads", own), chosen, root))})


def download_pass(spark: SparkSession, responses: DataFrame, folder: str, root: str, now: float, languages: list[str] | None = None, limit: int | None = None) -> bool:
    """One pass over stored media responses, for the jobs that are pending or due in the root; whether it ran, which it does not while a pause lasts."""
    store = Versions(spark, folder)
    held = store.latest()
    if is_paused(held, now):
        return False
    before = {t: held.read(t) for t in ("audios", "audio_sizes", "downloads", "crawl_state")}
    after = flows.download_stage(before, responses, root, now, languages, limit)
    own = held.touched(responses.select("audio_url"))
    pages = held.touched(before["audios"].join(responses.select("audio_url"), "audio_url", "left_semi").select("url"))
    touched = {"audios": pages, "audio_sizes": own, "downloads": own, "crawl_state": None}
    store.commit(held, {t: (touched[t], rows) for t, rows in after.items()})
    return True


def repair_pass(spark: SparkSession, listing: DataFrame, receipts: DataFrame, folder: str, root: str) -> int:
    """Finished downloads of the root whose file is not there as its receipt says are pending again; returns how many."""
    store = Versions(spark, folder)
    held = store.latest()
    downloads = held.read("downloads")
    done = downloads.where((F.col("output_root") == root) & (F.col("status") == "done"))
    valid = files.stored(receipt_files.valid_receipts(done.select("audio_url"), receipts, listing).select(F.lit(root).alias("output_root"), "audio_url"), "valid")
    lost = files.stored(done.join(valid, "audio_url", "left_anti").select("audio_url"), "lost")
    own = held.touched(lost)
    if own:
        pages = held.touched(held.read("audios").join(lost, "audio_url", "left_semi").select("url"))
        others = downloads.where((F.col("output_root") != root) & (F.col("status") == "done")).select("output_root", "audio_url")
        rows, audios = state.repair_downloads(held.read("downloads", own), valid.union(others), held.read("audios", pages))
        store.commit(held, {"downloads": (own, rows), "audios": (pages, audios)})
    return lost.count()


def audit(listed: DataFrame, pages: DataFrame) -> DataFrame:
    """url, html_name, ancien_selecteur_present, status, titre, audios, pages, detail for a list of urls, whether stored or not."""
    from siltstone.functions.text import snapshot_name

    parsed = html.parse_pages(pages.select("url", "html").join(listed.select("url"), "url", "left_semi"))
    rows = listed.select("pos", "url").join(parsed, "url", "left")
    p, missing = F.col("page"), F.col("page").isNull()
    status = classify.audit_status(F.lit(False), F.when(missing, "absent").otherwise(p["error_kind"]), p["status"])
    return rows.select(
        "pos", "url", F.when(~missing, snapshot_name(F.col("url"))).alias("html_name"), p["old_selector"].alias("ancien_selecteur_present"), status.alias("status"),
        p["titre"].alias("titre"), F.size(p["audios"]).alias("audios"), F.size(p["pages"]).alias("pages"), p["error"].alias("detail"),
    )


def size_report(spark: SparkSession, folder: str) -> dict:
    """Totals, sizes by status, and the projection where some sizes are known."""
    from siltstone.functions.text import format_bytes

    held = tables(spark, folder, ("audios", "audio_sizes"))
    summary = reports.size_summary(held["audios"], held["audio_sizes"])
    row = reports.coverage(summary).select("*", format_bytes(F.col("known_bytes")).alias("shown")).first().asDict()
    return row | {"statuses": {r["status"]: r["n"] for r in summary.collect()}}
