"""Responses to state: the size and the download stage, each from stored responses to the next tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators import classify, reports, state

#: What is recorded where a response tells no size, and why a response is no media file.
NO_SIZE, HTML_FOR_AUDIO, NO_MEDIA = "HTTP {}, taille non disponible", "Réponse HTML au lieu de l’audio", {"missing": "Audio introuvable", "invalid": "Réponse non audio"}


def probe_verdicts(responses: DataFrame, redirects: DataFrame, now: float) -> DataFrame:
    """Of probes (audio_url, method, status, headers): one verdict each audio_url. A GET counts where the HEAD says nothing."""
    judged = responses.withColumn("v", classify.probe_class(F.col("method"), F.col("status"), F.col("headers"), F.lit(now)))
    told = judged.where("v.label <> 'next'")
    # HEAD comes before GET in the order of their names reversed.
    first = told.groupBy("audio_url").agg(F.max_by(F.struct("method", "status", "v"), "method").alias("r")).select("audio_url", "r.*")
    places = classify.follow_redirects(first.select(F.col("audio_url").alias("url")), redirects)
    return first.join(places.withColumnsRenamed({"url": "audio_url", "error": "lost"}), "audio_url")


def size_stage(tables: dict[str, DataFrame], responses: DataFrame, redirects: DataFrame, now: float) -> dict[str, DataFrame]:
    """The next audio_sizes and crawl_state after probes of the media whose size is pending."""
    due = reports.pending_sizes(tables["audios"], tables["audio_sizes"], F.lit(now))
    rows = probe_verdicts(responses.join(due, "audio_url", "left_semi"), redirects, now)
    failed = F.col("lost").isNotNull() | (F.col("v.label") == "retry")
    found = rows.where(~failed).select(
        "audio_url", F.col("v.size_bytes").alias("size_bytes"), "final_url", F.col("v.label").alias("status"), "method",
        F.when(F.col("v.label") == "known", "").otherwise(F.concat(F.lit(NO_SIZE.split("{}")[0]), F.col("status"), F.lit(NO_SIZE.split("{}")[1]))).alias("detail"), F.lit(now).alias("checked_at"),
    )
    html = F.coalesce(F.col("v.delay") == 300, F.lit(False)) & ~F.coalesce(F.col("v.blocked"), F.lit(False))
    error = F.coalesce("lost", F.when(html, F.lit(HTML_FOR_AUDIO)), F.concat(F.lit("Mesure audio : HTTP "), F.col("status")))
    fails = rows.where(failed).select("audio_url", F.lit(now).alias("at"), F.coalesce("v.delay", F.lit(60)).alias("delay"), error.alias("error"), F.coalesce(F.col("lost").isNull() & F.col("v.blocked"), F.lit(False)).alias("blocked"))
    return {
        "audio_sizes": state.defer_sizes(state.save_sizes(tables["audio_sizes"], found), fails.drop("blocked")),
        "crawl_state": _paused(tables["crawl_state"], fails, tables["audio_sizes"], ["audio_url"]),
    }


def _paused(crawl_state: DataFrame, fails: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    return state.paused(crawl_state, state.numbered(fails, table, keys), F.lit(60))


def transfer_verdicts(responses: DataFrame, now: float) -> DataFrame:
    """Of media responses (status, headers, sample, challenge, offset, etag, same_url, first, extension, size): the verdict on each, v."""
    media = classify.media_class(F.col("status"), F.col("headers"), F.col("sample"), F.col("challenge"), F.lit(now))
    moved = classify.transfer_class(*[F.col(c) for c in ("status", "headers", "offset", "etag", "same_url", "first", "extension", "size")])
    rows = responses.withColumns({"m": media, "t": moved})
    return rows.withColumn("v", F.when(F.col("m.label") == "usable", F.col("t")).otherwise(F.col("m"))).drop("m", "t")


def download_stage(tables: dict[str, DataFrame], responses: DataFrame, root: str, now: float, languages: list[str] | None = None, limit: int | None = None) -> dict[str, DataFrame]:
    """The next downloads, audios, audio_sizes and crawl_state after responses to the jobs that are pending or due in the root.

    A transfer that has to begin again changes nothing: its job stays as it was.
    """
    jobs = reports.eligible_jobs(reports.download_jobs(tables["audios"], languages), tables["downloads"], F.lit(now), limit, root)
    rows = transfer_verdicts(responses.join(jobs.select("audio_url"), "audio_url", "left_semi"), now).withColumn("output_root", F.lit(root))
    label: Column = F.col("v.label")
    done = rows.where(label == "done").select("output_root", "audio_url", F.concat(F.lit(root.rstrip("/") + "/"), F.col("file")).alias("file"), F.col("v.size_bytes").alias("size_bytes"), "final_url", F.lit(now).alias("at"))
    why = F.coalesce(*[F.when(label == k, x) for k, x in NO_MEDIA.items()], F.concat(F.lit("HTTP "), F.col("status")))
    fails = rows.where(label.isin("missing", "invalid", "retry")).select(
        "output_root", "audio_url", F.lit(now).alias("at"), F.coalesce("v.delay", F.lit(60)).alias("delay"), why.alias("error"), label.alias("kind"), F.coalesce("v.blocked", F.lit(False)).alias("blocked")
    )
    downloads, audios, sizes = state.save_downloads(tables["downloads"], tables["audios"], tables["audio_sizes"], done)
    return {
        "downloads": state.fail_downloads(downloads, fails.drop("blocked")), "audios": audios, "audio_sizes": sizes,
        "crawl_state": _paused(tables["crawl_state"], fails, tables["downloads"], ["output_root", "audio_url"]),
    }
