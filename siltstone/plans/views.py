"""Reference-shaped tables over the driver's tables, as DataFrames and as the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import state
from siltstone.sources.files import load

NOW = 1_000_500.0
EPOCH = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) / 1e6D"


def audios(spark: SparkSession, d: str) -> DataFrame:
    even = F.col("doc_id") - F.col("doc_id") % 2
    cols = {"id": F.col("doc_id"), "url": F.concat(F.lit("p"), "doc_id"), "audio_url": F.concat(F.lit("m"), even), "file_name": F.lit(""), "title": F.col("text"), "lang": F.col("lang")}
    return load(spark, d, "documents").select(*[c.alias(n) for n, c in cols.items()])


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    """A row for each media url that has labels: two documents, and so their labels, share one."""
    rows = load(spark, d, "documents").select("doc_id", "n_chars").join(load(spark, d, "labels"), "doc_id")
    rows = rows.groupBy((F.col("doc_id") - F.col("doc_id") % 2).alias("doc_id")).agg(F.sum("n_chars").alias("n_chars"), F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return rows.withColumn("audio_url", F.concat(F.lit("m"), "doc_id"))


def audio_sizes(spark: SparkSession, d: str) -> DataFrame:
    known, due = F.col("quality") == 1, (F.col("quality") == 0) & (F.col("doc_id") % 4 == 0)
    status = F.when(known, "known").when(F.col("doc_id") % 4 == 0, "retry").otherwise("unknown")
    return _labelled(spark, d).select(
        "audio_url", F.when(known, F.col("n_chars")).alias("size_bytes"), F.when(known, F.concat(F.lit("f"), "doc_id")).alias("final_url"), status.alias("status"),
        F.lit("HEAD").alias("method"), F.lit("").alias("detail"), F.lit(NOW).alias("checked_at"), (F.col("doc_id") % 5).cast("int").alias("attempts"), F.when(due, F.lit(NOW - 300) + F.col("doc_id")).alias("next_attempt"),
    )


def downloads(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("toxic") == 1, "suspended").when(F.col("quality") == 1, "done").otherwise("retry")
    due, done = F.when(status == "retry", F.lit(NOW - 300) + F.col("doc_id")), status == "done"
    return _labelled(spark, d).select(
        F.when(F.col("doc_id") % 3 == 0, "r1").otherwise("r0").alias("output_root"), "audio_url", status.alias("status"), F.when(done, F.concat(F.lit("r/"), "doc_id")).alias("file_path"),
        F.when(done, F.col("n_chars")).alias("size_bytes"), (F.col("doc_id") % 5).cast("int").alias("attempts"), due.alias("next_attempt"), F.lit("").alias("detail"), F.lit(NOW).alias("updated_at"),
    )


def failures(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "events").where("event_type = 'error'")
    return rows.select(F.expr("cast(cast(ts as date) as string)").alias("kind"), F.col("user_id").cast("string").alias("url"), F.expr(EPOCH).alias("at"), F.lit(60).alias("delay"), F.lit("error").alias("error"), "event_id")


def retry_schedule(spark: SparkSession, d: str) -> DataFrame:
    return state.defer(spark.createDataFrame([], "kind string, url string, attempts int, next_attempt double, error string"), failures(spark, d), event_id="event_id")


def page_outcomes(spark: SparkSession, d: str) -> DataFrame:
    whole = F.col("html").rlike(r"(?i)</html\s*>")
    return load(spark, d, "pages").select("url", F.when(whole, "sans_contenu").otherwise("a_verifier").alias("status"), F.lit("").alias("detail"), F.col("page_id").cast("double").alias("checked_at"))


AUDIOS = "audios as (select doc_id as id, 'p' || doc_id as url, 'm' || (doc_id - doc_id % 2) as audio_url, '' as file_name, text as title, lang from documents)"
_LABELLED = """labelled as (select *, 'm' || doc_id as audio_url from (select d.doc_id - d.doc_id % 2 as doc_id, cast(sum(d.n_chars) as bigint) as n_chars, max(l.quality) as quality, max(l.toxic) as toxic
  from documents d join labels l on l.doc_id = d.doc_id group by 1))"""
SIZES = _LABELLED + f""",
audio_sizes as (select audio_url, case when quality = 1 then n_chars end as size_bytes, case when quality = 1 then 'f' || doc_id end as final_url,
  case when quality = 1 then 'known' when doc_id % 4 = 0 then 'retry' else 'unknown' end as status, 'HEAD' as method, '' as detail, {NOW}e0 as checked_at, cast(doc_id % 5 as int) as attempts,
  case when quality = 0 and doc_id % 4 = 0 then {NOW - 300}e0 + doc_id end as next_attempt from labelled)"""
DOWNLOADS = _LABELLED + f""",
downloads0 as (select *, case when toxic = 1 then 'suspended' when quality = 1 then 'done' else 'retry' end as status from labelled),
downloads as (select case when doc_id % 3 = 0 then 'r1' else 'r0' end as output_root, audio_url, status, case when status = 'done' then 'r/' || doc_id end as file_path, case when status = 'done' then n_chars end as size_bytes,
  cast(doc_id % 5 as int) as attempts, case when status = 'retry' then {NOW - 300}e0 + doc_id end as next_attempt, '' as detail, {NOW}e0 as updated_at from downloads0)"""
SCHEDULE = """failures as (select cast(cast(ts as date) as varchar) as kind, cast(user_id as varchar) as url, epoch_us(ts) / 1e6 as seen from events where event_type = 'error'),
schedule0 as (select kind, url, count(*) as attempts, max(seen) as seen from failures group by kind, url),
retry_schedule as (select kind, url, attempts, case when attempts < 5 then seen + greatest(60, least(3600, 60 * power(2, least(attempts - 1, 10)))) end as next_attempt from schedule0)"""
OUTCOMES = "page_outcomes as (select url, case when regexp_matches(html, '</html\\s*>', 'i') then 'sans_contenu' else 'a_verifier' end as status, page_id from pages)"
