"""The crawl frontier: what is new, what is ready, and what can be reached."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import backoff
from siltstone.sources import files


def search_urls(spark, prefix: str, count: int, cap: int | None = None) -> DataFrame:
    """pos, url of the first search pages."""
    n = count if cap is None else min(count, max(0, cap))
    return spark.range(n).select(F.col("id").alias("pos"), F.concat(F.lit(prefix), F.col("id").cast("string")).alias("url"))


def ordered_distinct(rows: DataFrame, pos: str, *keys: str) -> DataFrame:
    """Each key once, at its first place."""
    return rows.groupBy(*keys).agg(F.min(pos).alias(pos))


def new_items(items: DataFrame, visited: DataFrame, queue: DataFrame) -> DataFrame:
    """pos, url, type_ of items that are neither visited nor queued, each url once; of a repeated url the first place and label count."""
    first = items.groupBy("url").agg(F.min_by("type_", "pos").alias("type_"), F.min("pos").alias("pos")).where("url is not null")
    return first.join(visited.select("url"), "url", "left_anti").join(queue.select("url"), "url", "left_anti").select("pos", "url", "type_")


def new_urls(items: DataFrame, visited: DataFrame, queue: DataFrame) -> DataFrame:
    """url, type_ of the new items."""
    return new_items(items, visited, queue).select("url", "type_")


def with_ids(table: DataFrame, order: list[str], top: int | None = None) -> DataFrame:
    """Rows without id get the numbers after the largest one (top, where the table is only part of one), in the order of the columns."""
    if "id" not in table.columns:
        table = table.withColumn("id", F.lit(None).cast("long"))
    if top is None:
        top = table.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    fresh = numbered(table.where("id is null").drop("id"), order, "id", top + 1)
    return table.where("id is not null").unionByName(fresh)


def enqueue(queue: DataFrame, items: DataFrame, visited: DataFrame, top: int | None = None) -> DataFrame:
    """The queue with new items (pos, url, type_) behind it, in their order."""
    fresh = new_items(items, visited, queue)
    return with_ids(queue.unionByName(fresh, allowMissingColumns=True), ["pos"], top).select(queue.columns)


def in_order(queue: DataFrame) -> DataFrame:
    return queue.orderBy("id")


def ready(work: DataFrame, schedule: DataFrame, kind: str, now: Column) -> DataFrame:
    """Work (url) without a retry row of the kind, or with one that is due."""
    rows = schedule.where(F.col("kind") == kind).select("url", F.col("next_attempt").alias("_next"), F.lit(True).alias("_row"))
    return work.join(rows, "url", "left").where(backoff.ready(F.col("_row"), F.col("_next"), now)).drop("_next", "_row")


def eligible_searches(urls: DataFrame, visited: DataFrame, schedule: DataFrame, now: Column) -> DataFrame:
    return ready(urls.join(visited.select("url"), "url", "left_anti"), schedule, "search", now)


def _ranked_tasks(pages: DataFrame, sizes: DataFrame) -> DataFrame:
    tasks = pages.select(F.lit("page").alias("kind"), "url", "pos").unionByName(sizes.select(F.lit("size").alias("kind"), "url", "pos"))
    tasks = ordered_distinct(tasks, "pos", "kind", "url")
    front = F.when(F.col("kind") == "size", -F.col("pos")).otherwise(F.col("pos"))
    return tasks.select("kind", "url", (F.col("kind") == "page").cast("int").alias("a"), front.alias("b"))


def ordered_tasks(pages: DataFrame, sizes: DataFrame) -> DataFrame:
    """kind, url: sizes first, the latest of them first; then pages in order. Each takes (pos, url)."""
    return _ranked_tasks(pages, sizes).orderBy("a", "b").select("kind", "url")


def placed_tasks(pages: DataFrame, sizes: DataFrame) -> DataFrame:
    """The tasks with their place, from 1."""
    return numbered(_ranked_tasks(pages, sizes), ["a", "b"], "place").select("kind", "url", "place")


def numbered(rows: DataFrame, order: list[str], to: str, first: int = 1) -> DataFrame:
    """Adds consecutive numbers in the order of the columns: rows are dealt by ranges once and stored in order, and each range's count moves those after it.

    Counts and numbers are read from the same stored rows, since another deal would sample other ranges. Rows of equal order are told
    apart by where they stood, so that they too may be dealt to several ranges. No task sees all rows; what is broadcast is one count for each range.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    # The number of the range, then the place in it.
    dealt = files.stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    low = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).select("_part", before.alias("_before"))
    both = dealt.withColumn("_part", part).join(F.broadcast(low), "_part")
    return both.withColumn(to, (F.col("_before") + place + first).cast("long")).select(*rows.columns, to)


def reachable(start: DataFrame, links: DataFrame, folder: str, most: int = 1000) -> DataFrame:
    """url, depth of everything that links (src, dst) reach from start (url), each once, however the links turn round.

    Each round's frontier is an anti-join of its links with what is known, written to the folder so that lineage ends.
    """
    spark, name = start.sparkSession, uuid.uuid4().hex
    links = links.select("src", "dst").distinct()
    path = f"{folder}/reach-{name}"
    start.select("url", F.lit(0).alias("depth")).distinct().write.parquet(f"{path}/0")
    for depth in range(1, most + 1):
        known = spark.read.schema("url string, depth int").parquet(*[f"{path}/{d}" for d in range(depth)])
        latest = spark.read.schema("url string, depth int").parquet(f"{path}/{depth - 1}")
        found = latest.join(links, latest["url"] == links["src"]).select(F.col("dst").alias("url")).distinct()
        found = found.join(known.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth))
        found.write.parquet(f"{path}/{depth}")
        if spark.read.schema("url string, depth int").parquet(f"{path}/{depth}").isEmpty():
            return known
    raise RuntimeError("the frontier is not empty after the last round")

