"""Counts, summaries and next deadlines over the state tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import backoff


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status").agg(F.count("*").alias("n"))


def nonblank(url: Column) -> Column:
    """As SQL judges it: spaces only count as blank."""
    return F.coalesce(F.trim(url) != "", F.lit(False))


def distinct_media(audios: DataFrame) -> DataFrame:
    return audios.where(nonblank(F.col("audio_url"))).select("audio_url").distinct()


def size_summary(audios: DataFrame, sizes: DataFrame) -> DataFrame:
    """status, n, known_bytes of the distinct media; media without a row are pending."""
    rows = distinct_media(audios).join(sizes.select("audio_url", "status", "size_bytes"), "audio_url", "left")
    known = F.sum(F.when(F.col("status") == "known", F.col("size_bytes")))
    return rows.groupBy(F.coalesce("status", F.lit("pending")).alias("status")).agg(F.count("*").alias("n"), F.coalesce(known, F.lit(0)).alias("known_bytes"))


def coverage(summary: DataFrame) -> DataFrame:
    """total, known, known_bytes, estimate: the estimate only where some sizes are known and some are not."""
    known = F.sum(F.when(F.col("status") == "known", F.col("n")).otherwise(0))
    rows = summary.agg(F.sum("n").alias("total"), known.alias("known"), F.sum("known_bytes").alias("known_bytes"))
    part = (F.col("known") > 0) & (F.col("known") < F.col("total"))
    return rows.withColumn("estimate", F.when(part, F.bround(F.col("known_bytes") / F.col("known") * F.col("total"), 0).cast("long")))


def pending_sizes(audios: DataFrame, sizes: DataFrame, now: Column) -> DataFrame:
    """Distinct media without a size row, or with a retry that is due, in order."""
    due = (F.col("status") == "retry") & F.coalesce(F.col("next_attempt") <= now, F.lit(False))
    rows = distinct_media(audios).join(sizes.select("audio_url", "status", "next_attempt"), "audio_url", "left")
    return rows.where(F.col("status").isNull() | due).select("audio_url").orderBy("audio_url")


def next_deadline(rows: DataFrame, pause: Column) -> DataFrame:
    """The earliest next attempt, or the pause's end if later; null without any."""
    return rows.agg(F.min("next_attempt").alias("m")).select(backoff.later_of(F.col("m"), pause).alias("deadline"))


def earliest(*deadlines: Column) -> Column:
    """Of deadlines, any of which may be null, the first to come."""
    return F.least(*deadlines)


def of_root(downloads: DataFrame, root: str | None) -> DataFrame:
    """One output root's downloads, or all where none is named."""
    return downloads if root is None else downloads.where(F.col("output_root") == root)


def download_report(downloads: DataFrame, root: str | None = None) -> DataFrame:
    """status, n, bytes of one output root's downloads; bytes_done is what its finished ones hold, the same on each row."""
    rows = of_root(downloads, root).groupBy("status").agg(F.count("*").alias("n"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"))
    done = rows.where("status = 'done'").agg(F.coalesce(F.sum("bytes"), F.lit(0))).scalar()
    return rows.withColumn("bytes_done", done)


def language_media(audios: DataFrame, languages: list[str] | None) -> DataFrame | None:
    """Media urls one of whose rows has exactly one of the labels; '' stands for no label; None for all."""
    if languages is None:
        return None
    return audios.where(F.trim(F.coalesce("lang", F.lit(""))).isin([x.strip() for x in languages])).select("audio_url").distinct()


def download_jobs(audios: DataFrame, languages: list[str] | None = None) -> DataFrame:
    """A row for each media url: first_id, title (of its first row), pages and languages in the order first seen."""
    rows = audios.where(F.regexp_replace(F.coalesce("audio_url", F.lit("")), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "") != "")
    chosen = language_media(audios, languages)
    if chosen is not None:
        rows = rows.join(chosen, "audio_url", "left_semi")
    seen = lambda c: rows.where(F.coalesce(F.col(c), F.lit("")) != "").groupBy("audio_url", c).agg(F.min("id").alias("at")).groupBy("audio_url").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", F.col(c).alias("x")))), lambda s: s["x"]).alias(c)
    )
    jobs = rows.groupBy("audio_url").agg(F.min("id").alias("first_id"), F.min_by("title", "id").alias("title"))
    jobs = jobs.join(seen("url").withColumnRenamed("url", "pages"), "audio_url", "left").join(seen("lang").withColumnRenamed("lang", "languages"), "audio_url", "left")
    none = F.array().cast("array<string>")
    title = F.when(F.coalesce("title", F.lit("")) == "", "audio").otherwise(F.col("title"))
    return jobs.select("audio_url", "first_id", title.alias("title"), F.coalesce("pages", none).alias("pages"), F.coalesce("languages", none).alias("languages"))


def eligible_jobs(jobs: DataFrame, downloads: DataFrame, now: Column, limit: int | None = None, root: str | None = None) -> DataFrame:
    """Jobs that are pending or due in the output root, in order of their first rows; the limit counts eligible ones."""
    if limit is not None and (isinstance(limit, bool) or not isinstance(limit, int) or limit < 1):
        raise ValueError("limit must be a whole number of at least 1")
    state = jobs.join(of_root(downloads, root).select("audio_url", "status", "next_attempt"), "audio_url", "left")
    status = F.coalesce("status", F.lit("pending"))
    due = (status == "retry") & F.coalesce(F.col("next_attempt") <= now, F.lit(False))
    rows = state.where((status == "pending") | due).drop("status", "next_attempt").orderBy("first_id")
    return rows.limit(limit) if limit is not None else rows


def suspended(schedule: DataFrame) -> DataFrame:
    return schedule.where("next_attempt is null")


def when_running(work: DataFrame, crawl_state: DataFrame, now: Column) -> DataFrame:
    """The work, or none of it while the pause lasts."""
    paused = crawl_state.where((F.col("key") == "pause_until") & (F.col("value") > now)).agg(F.count("*").alias("n")).scalar()
    return work.where(paused == 0)
