"""Keyed state as DataFrames: upserts are unions of which the last row of a key counts.

Every transition takes the table and the events and gives the next table; ``now`` is a parameter.
Transitions that count attempts take events with an id, and a replayed id counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import backoff
from siltstone.functions.text import cut_error


def last_wins(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of new replace those of old; among the rows of one key the largest order counts, and of equal ones the larger values."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_new"), F.desc(order), *[F.desc(c) for c, kind in both.dtypes if c not in ("_new", order) and not kind.startswith("map")]))
    return both.withColumn("_n", first).where("_n = 1").drop("_n", "_new")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The columns of new replace those of old; the others stay as they are. Of new rows of one key the largest order counts."""
    columns = [c for c in new.columns if c not in keys]
    last = new.groupBy(*keys).agg(F.max_by(F.struct(*columns, F.lit(True).alias("_new")), F.col(order)).alias("_last"))
    both = old.join(last, keys, "full_outer")
    seen = F.col("_last")["_new"]
    out = {c: F.col(c) for c in old.columns} | {c: F.when(seen, F.col("_last")[c]).otherwise(F.col(c) if c in old.columns else F.lit(None)) for c in columns}
    return both.select(*[c.alias(n) for n, c in out.items()])


def first_wins(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds the keys that old does not have; a null key equals nothing and is always added."""
    some_null = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x)
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    fresh = new.where(~some_null).withColumn("_n", n).where("_n = 1").drop("_n").join(old.select(*keys), keys, "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True).unionByName(new.where(some_null), allowMissingColumns=True)


def clear(table: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(gone.select(*keys), keys, "left_anti")


def folded(events: DataFrame, keys: list[str], at: str = "at", event_id: str | None = None) -> DataFrame:
    """Failures of each key: how many, and the last one's values; a repeated event id counts once."""
    if event_id:
        events = events.dropDuplicates([event_id])
    # Of equal times the larger event id is the later one; without ids, the larger values, so that the result does not hang on places.
    values = F.struct(*[c for c in events.columns if c not in keys])
    return events.groupBy(*keys).agg(F.count("*").alias("n"), F.max_by(values, F.struct(F.col(at), F.col(event_id) if event_id else values)).alias("last"))


LOG = "kind string, url string, attempts long, at double, last_id long, delay long, error string, cleared_at double, cleared_id long"
SEEN = "event_id long"


def fold_log(log: DataFrame, seen: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The next log and seen event ids after events (event_id, kind, url, at, cleared, delay, error), in the order of (at, event_id).

    A clearing forgets a key's failures before it; log has, of each key, how many there were since, the last one's values, and the last
    clearing. Events whose id was seen, in this batch or an earlier one, and failures from before the last clearing count nothing, so that
    batches may be repeated or come late; only a clearing that falls among failures already counted leaves them all counted. Both steps
    are aggregates: no key's events come together in one place.
    """
    keys = ["kind", "url"]
    events = events.dropDuplicates(["event_id"]).join(seen, "event_id", "left_anti")
    when = F.struct(F.col("at").cast("double").alias("at"), F.col("event_id").cast("long").alias("id"))
    clearings = events.where("cleared").groupBy(*keys).agg(F.max(when).alias("c"))
    held = log.where("cleared_at is not null").select(*keys, F.struct(F.col("cleared_at").alias("at"), F.col("cleared_id").alias("id")).alias("c"))
    last = clearings.unionByName(held).groupBy(*keys).agg(F.max("c").alias("c"))
    failed = events.where("not cleared").join(last, keys, "left").where(F.col("c").isNull() | (when > F.col("c")))
    counted = failed.groupBy(*keys).agg(F.count("*").alias("n"), F.max_by(F.struct(F.col("at").cast("double").alias("at"), F.col("event_id").cast("long").alias("last_id"), F.col("delay").cast("long").alias("delay"), "error"), when).alias("f"))
    both = counted.join(last.withColumnRenamed("c", "new"), keys, "full_outer").join(log, keys, "full_outer")
    at_last = F.struct(F.col("at"), F.col("last_id").alias("id"))
    # What the log counted before goes if a clearing has come after its last failure.
    stays = F.col("at").isNotNull() & ~F.coalesce(F.col("new") > at_last, F.lit(False))
    before = F.when(stays, F.col("attempts")).otherwise(0)
    later = F.col("f").isNotNull() & (~stays | (F.struct(F.col("f")["at"].alias("at"), F.col("f")["last_id"].alias("id")) > at_last))
    pick = lambda c: F.when(later, F.col("f")[c]).when(stays, F.col(c)).alias(c)
    out = both.select(*keys, (before + F.coalesce("n", F.lit(0))).cast("long").alias("attempts"), pick("at"), pick("last_id"), pick("delay"), pick("error"), F.coalesce(F.col("new")["at"], F.col("cleared_at")).alias("cleared_at"), F.coalesce(F.col("new")["id"], F.col("cleared_id")).alias("cleared_id"))
    return out, seen.select("event_id").unionByName(events.select("event_id"))


def log_schedule(log: DataFrame, base: Column | None = None) -> DataFrame:
    """The retry schedule (kind, url, attempts, next_attempt, error) that a log stands for."""
    due = backoff.next_attempt(F.col("at"), F.col("delay"), F.col("attempts"), base)
    return log.where("attempts > 0").select("kind", "url", F.col("attempts").cast("int").alias("attempts"), due.alias("next_attempt"), cut_error(F.col("error")).alias("error"))


def attempts_history(events: DataFrame) -> DataFrame:
    """Every event (event_id, kind, url, at, cleared) with segment, how many clearings its key has had up to it, and attempts, the failures since the last one."""
    every = Window.partitionBy("kind", "url").orderBy("at", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = events.dropDuplicates(["event_id"]).withColumn("segment", F.sum(F.col("cleared").cast("long")).over(every))
    since = Window.partitionBy("kind", "url", "segment").orderBy("at", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("attempts", F.sum((~F.col("cleared")).cast("long")).over(since))


def defer(schedule: DataFrame, failures: DataFrame, base: Column | None = None, event_id: str | None = None) -> DataFrame:
    """Schedule (kind, url, attempts, next_attempt, error) after failures (kind, url, at, delay, error)."""
    keys = ["kind", "url"]
    both = folded(failures, keys, event_id=event_id).join(schedule, keys, "full_outer")
    attempts = F.coalesce("attempts", F.lit(0)) + F.coalesce("n", F.lit(0))
    failed, last = F.col("n").isNotNull(), F.col("last")
    due = backoff.next_attempt(last["at"], last["delay"], attempts, base)
    return both.select(
        *keys, attempts.cast("int").alias("attempts"), F.when(failed, due).otherwise(F.col("next_attempt")).alias("next_attempt"),
        F.when(failed, cut_error(last["error"])).otherwise(F.col("error")).alias("error"),
    )


def pause_until(old: Column, failures: DataFrame) -> DataFrame:
    """The end of the global pause after blocked failures (attempts, at, delay): also of those that are suspended."""
    end = F.col("at") + backoff.seconds(F.col("delay"), F.col("attempts"))
    return failures.where("blocked").agg(F.greatest(old, F.max(end)).alias("pause_until"))


def numbered(failures: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Failures with the number of attempts that each one brings its key to."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("at"))
    held = table.select(*keys, F.col("attempts").alias("_before"))
    return failures.withColumn("_nth", nth).join(held, keys, "left").withColumn("attempts", F.coalesce("_before", F.lit(0)) + F.col("_nth")).drop("_nth", "_before")


def paused(crawl_state: DataFrame, failures: DataFrame, base: Column | None = None) -> DataFrame:
    """crawl_state after failures (attempts, at, delay, blocked): a blocked one moves the end of the pause on, never back."""
    wait = backoff.seconds(F.col("delay"), F.col("attempts"), base)
    ends = failures.where("blocked").agg(F.max(F.col("at") + wait).alias("value")).where("value is not null").select(F.lit("pause_until").alias("key"), "value")
    both = crawl_state.select("key", "value").unionByName(ends)
    return both.groupBy("key").agg(F.max("value").alias("value"))


def save_sizes(sizes: DataFrame, found: DataFrame) -> DataFrame:
    """Found sizes overwrite what they name; the next attempt is cleared, attempts stay as they were."""
    rows = upsert(sizes, found.withColumn("next_attempt", F.lit(None).cast("double")), ["audio_url"], "checked_at")
    return rows.withColumn("attempts", F.coalesce("attempts", F.lit(0)))


def defer_sizes(sizes: DataFrame, failures: DataFrame) -> DataFrame:
    """Size rows after failures (audio_url, at, delay, error): retry, or suspended at the last attempt; sizes found before stay."""
    both = folded(failures, ["audio_url"]).join(sizes.select("audio_url", "attempts"), "audio_url", "left")
    attempts = F.coalesce("attempts", F.lit(0)) + F.col("n")
    due = backoff.next_attempt(F.col("last.at"), F.col("last.delay"), attempts, F.lit(backoff.SIZE_BASE))
    rows = both.select(
        "audio_url", F.when(due.isNull(), "suspended").otherwise("retry").alias("status"), cut_error(F.col("last.error")).alias("detail"),
        F.col("last.at").alias("checked_at"), attempts.cast("int").alias("attempts"), due.alias("next_attempt"),
    )
    return upsert(sizes, rows, ["audio_url"], "checked_at")


def _rooted(df: DataFrame) -> DataFrame:
    """Downloads are kept for each output root; events without one belong to the root without a name."""
    return df if "output_root" in df.columns else df.withColumn("output_root", F.lit(""))


_DOWNLOAD = ["output_root", "audio_url"]


def fail_downloads(downloads: DataFrame, failures: DataFrame) -> DataFrame:
    """Downloads after failures (output_root, audio_url, at, delay, error, kind): missing and invalid are final."""
    downloads, failures = _rooted(downloads), _rooted(failures)
    both = folded(failures, _DOWNLOAD).join(downloads.select(*_DOWNLOAD, "attempts"), _DOWNLOAD, "left")
    attempts = F.coalesce("attempts", F.lit(0)) + F.col("n")
    final = F.coalesce(F.col("last.kind").isin("missing", "invalid"), F.lit(False))
    due = F.when(~final, backoff.next_attempt(F.col("last.at"), F.col("last.delay"), attempts, F.lit(backoff.SIZE_BASE)))
    rows = both.select(
        *_DOWNLOAD, F.when(final, F.col("last.kind")).when(due.isNull(), "suspended").otherwise("retry").alias("status"),
        attempts.cast("int").alias("attempts"), due.alias("next_attempt"), cut_error(F.col("last.error")).alias("detail"), F.col("last.at").alias("updated_at"),
    )
    return upsert(downloads, rows, _DOWNLOAD, "updated_at")


#: How a size that a download has shown is recorded.
DOWNLOADED = {"status": "known", "method": "DOWNLOAD", "detail": "Fichier téléchargé"}


def save_downloads(downloads: DataFrame, audios: DataFrame, sizes: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """After finished downloads (output_root, audio_url, file, size_bytes, final_url, at): downloads, audios with file names, sizes."""
    downloads, done = _rooted(downloads), _rooted(done)
    if "final_url" not in done.columns:
        done = done.withColumn("final_url", F.lit(None).cast("string"))
    rows = done.select(
        *_DOWNLOAD, F.lit("done").alias("status"), F.col("file").alias("file_path"), "size_bytes",
        F.lit(None).cast("double").alias("next_attempt"), F.lit("").alias("detail"), F.col("at").alias("updated_at"),
    )
    last = done.groupBy("audio_url").agg(F.max_by("file", "at").alias("_file"))
    audios = audios.join(last, "audio_url", "left").withColumn("file_name", F.coalesce("_file", "file_name")).select(audios.columns)
    known = done.select("audio_url", "size_bytes", "final_url", *[F.lit(x).alias(c) for c, x in DOWNLOADED.items()], F.col("at").alias("checked_at"))
    downloads = upsert(downloads, rows, _DOWNLOAD, "updated_at").withColumn("attempts", F.coalesce("attempts", F.lit(0)))
    return downloads, audios, save_sizes(sizes, known)


def repair_downloads(downloads: DataFrame, valid: DataFrame, audios: DataFrame | None = None):
    """Done downloads without a valid file (output_root, audio_url of valid) are pending again; with audios, also those, their lost files' names removed."""
    downloads, valid = _rooted(downloads), _rooted(valid)
    mark = valid.select(*_DOWNLOAD, F.lit(True).alias("_ok")).distinct()
    rows = downloads.join(mark, _DOWNLOAD, "left").withColumn("_lost", (F.col("status") == "done") & F.col("_ok").isNull())
    lost = F.col("_lost")
    fixed = {"attempts": F.when(lost, 0).otherwise(F.col("attempts")), "next_attempt": F.when(~lost, F.col("next_attempt")), "status": F.when(lost, "pending").otherwise(F.col("status"))}
    out = rows.select(*[(fixed[c] if c in fixed else F.col(c)).alias(c) for c in downloads.columns])
    if audios is None:
        return out
    gone = rows.where(lost).select("audio_url", F.lit("").alias("_none")).distinct()
    return out, audios.join(gone, "audio_url", "left").withColumn("file_name", F.coalesce("_none", "file_name")).select(audios.columns)


def reset_failed(downloads: DataFrame, chosen: DataFrame | None = None, root: str | None = None) -> DataFrame:
    """Retry, suspended and invalid (never missing) are pending again, of the chosen audio urls and of the root only if given."""
    again = F.col("status").isin("retry", "suspended", "invalid")
    rows = downloads
    if root is not None:
        again = again & (F.col("output_root") == root)
    if chosen is not None:
        rows = rows.join(chosen.select("audio_url", F.lit(True).alias("_c")).distinct(), "audio_url", "left")
        again = again & F.col("_c").isNotNull()
    fresh = {"attempts": F.when(again, 0).otherwise(F.col("attempts")), "next_attempt": F.when(~again, F.col("next_attempt")), "status": F.when(again, "pending").otherwise(F.col("status"))}
    return rows.withColumns(fresh).select(downloads.columns)


def upgrade_schedule(schedule: DataFrame, queue: DataFrame, prefix: str, done: bool) -> DataFrame:
    """Once: forgets page retries of queued urls whose error begins with the prefix (ASCII case does not matter)."""
    if done:
        return schedule
    return clear(schedule, outdated(schedule, queue, prefix), ["kind", "url"])


def outdated(schedule: DataFrame, queue: DataFrame, prefix: str) -> DataFrame:
    begins = F.col("error").ilike(prefix.replace("%", r"\%").replace("_", r"\_") + "%")
    return schedule.where((F.col("kind") == "page") & begins).join(queue.select("url"), "url", "left_semi")


def upgrade_parser(schedule: DataFrame, queue: DataFrame, crawl_state: DataFrame, prefix: str, flag: str = "parser_v2") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The next schedule and crawl_state, and how many rows were forgotten; where the flag is set nothing changes."""
    ran = crawl_state.where(F.col("key") == flag).select(F.lit(True).alias("_ran")).limit(1)
    old = outdated(schedule, queue, prefix).join(F.broadcast(ran), F.lit(True), "left_anti")
    fresh = schedule.sparkSession.createDataFrame([(flag, 1.0)], "key string, value double")
    return clear(schedule, old, ["kind", "url"]), first_wins(crawl_state, fresh, ["key"], "value"), old.agg(F.count("*").alias("forgotten"))


def dispatch_failures(failures: DataFrame) -> DataFrame:
    """Adds action: outcome (review or gone: the page is done with) or defer, and whether all work stops."""
    page = F.col("kind") == "page"
    outcome = F.when(page & (F.col("error_kind") == "unrecognized"), "a_verifier").when(page & F.col("status").isin(404, 410), "introuvable")
    return failures.withColumns({"outcome": outcome, "action": F.when(outcome.isNotNull(), "outcome").otherwise("defer"), "stops": outcome.isNull() & F.coalesce("blocked", F.lit(False))})


def page_children(parsed: DataFrame) -> DataFrame:
    """pos, url, type_ of what readable pages link to, in the order of the pages' urls and of the links in each."""
    links = parsed.where("page.error_kind is null").select(F.posexplode("page.pages").alias("_p", "c"), F.col("url").alias("_u"))
    return links.select(F.struct("_u", "_p").alias("pos"), "c.url", "c.type_")


def save_pages(parsed: DataFrame, tables: dict[str, DataFrame], now: float, tops: dict[str, int] | None = None, children: DataFrame | None = None) -> dict[str, DataFrame]:
    """The next audios, visited, queue, outcomes and retry tables after readable pages: written together or not at all.

    parsed is read for each table, so it should be stored. New rows are numbered in the order of the pages' urls, after tops where the
    tables are parts of larger ones; children are the new ones of the pages' links, where they are known.
    """
    from siltstone.operators import frontier, html

    tops = tops or {}
    done = parsed.where("page.error_kind is null")
    urls = done.select("url")
    rows = html.media_rows(done).withColumn("id", F.lit(None).cast("long"))
    audios = first_wins(tables["audios"].withColumn("pos", F.lit(None).cast("int")), rows, ["url", "audio_url"], "pos")
    visited = visit(tables["visited"], urls, tops.get("visited"))
    children = page_children(parsed) if children is None else children
    return {
        "audios": frontier.with_ids(audios, ["url", "pos"], tops.get("audios")).drop("pos"), "visited": visited,
        "queue": clear(frontier.enqueue(tables["queue"], children, visited, tops.get("queue")), urls, ["url"]),
        "page_outcomes": last_wins(tables["page_outcomes"], html.outcome_rows(done, now), ["url"], "checked_at"),
        "retry_schedule": clear(tables["retry_schedule"], urls.withColumn("kind", F.lit("page")), ["kind", "url"]),
    }


def visit(visited: DataFrame, urls: DataFrame, top: int | None = None) -> DataFrame:
    """visited with the urls that it does not have, numbered in their order."""
    from siltstone.operators import frontier

    return frontier.with_ids(first_wins(visited, urls.select(F.lit(None).cast("long").alias("id"), "url"), ["url"], "url"), ["url"], top)


def save_search(items: DataFrame, source: DataFrame, tables: dict[str, DataFrame], tops: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """The next visited, queue and retry tables after search pages (source: url) with items (pos, url, type_)."""
    from siltstone.operators import frontier

    tops = tops or {}
    return {
        "visited": visit(tables["visited"], source.select("url"), tops.get("visited")),
        "queue": frontier.enqueue(tables["queue"], items, tables["visited"], tops.get("queue")),
        "retry_schedule": clear(tables["retry_schedule"], source.select("url", F.lit("search").alias("kind")), ["kind", "url"]),
    }


def apply_all(writers: dict[str, DataFrame], folder: str) -> str:
    """Writes every table under one new folder and then names it current: readers see all tables of one version, or none."""
    import uuid

    version, spark = uuid.uuid4().hex, next(iter(writers.values())).sparkSession
    for name, df in writers.items():
        df.write.parquet(f"{folder}/{version}/{name}")
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").json(f"{folder}/current")
    return f"{folder}/{version}"
