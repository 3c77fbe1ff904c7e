"""Command line: ``python -m siltstone.cli crawl | downloads | sizes | audit``. Nothing is fetched."""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siltstone.operators import reports
from siltstone.plans import crawl
from siltstone.sources import files, receipts


def build_parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siltstone", description=__doc__)
    top.add_argument("--now", type=float, default=None, help="seconds since 1970 that count as now")
    sub = top.add_subparsers(dest="command", required=True)
    one = sub.add_parser("crawl", help="read stored pages from start urls on")
    one.add_argument("--pages", required=True, help="parquet with url and html")
    one.add_argument("--state", required=True)
    start = one.add_mutually_exclusive_group(required=True)
    start.add_argument("--urls", help="text file of start urls")
    start.add_argument("--search", help="what the urls of search pages begin with; their numbers follow")
    one.add_argument("--max-search-pages", type=int, default=None)
    one.add_argument("--probes", help="parquet with audio_url, method, status and headers: sizes are measured by it")
    one.add_argument("--watch", action="store_true", help="wait for what is due later, and go on")
    one.add_argument("--rounds", type=int, default=100)
    one = sub.add_parser("downloads", help="eligible downloads and counts")
    one.add_argument("--state", required=True)
    one.add_argument("--output", default="", help="the root that downloads are kept for")
    one.add_argument("--responses", help="parquet of media responses: a pass over them")
    one.add_argument("--watch", action="store_true", help="wait for what is due later, and go on")
    one.add_argument("--limit", type=int, default=None)
    one.add_argument("--retry-failed", action="store_true")
    one.add_argument("--languages", "--lang", action="append", default=None, help="a label as it is in the table; '' for none; may be repeated")
    one = sub.add_parser("sizes", help="known and missing sizes")
    one.add_argument("--state", required=True)
    one.add_argument("--probes", help="parquet with audio_url, method, status and headers: a pass over them")
    one.add_argument("--watch", action="store_true", help="wait for what is due later, and go on")
    one.add_argument("--summary", action="store_true", help="what is recorded, without a pass")
    one = sub.add_parser("audit", help="how each url of a list reads")
    one.add_argument("--urls", required=True)
    one.add_argument("--pages", required=True)
    one.add_argument("--output", required=True)
    return top


@dataclass
class Pass:
    """When a pass is, and, set by it, when there is something to do again."""

    now: float
    next: float | None = None


def passes(watch: bool, now: float) -> Iterator[Pass]:
    """One pass or, when watching, passes until nothing is due later any more; in between the clock is waited for."""
    while True:
        at = Pass(now)
        yield at
        if not watch or at.next is None:
            return
        time.sleep(max(0.0, at.next - time.time()))
        now = max(time.time(), at.next)


def main(args: list[str] | None = None) -> int:
    asked = build_parser().parse_args(args)
    if getattr(asked, "limit", None) is not None and asked.limit < 1:
        raise ValueError("--limit must be at least 1")
    spark, now = SparkSession.builder.getOrCreate(), asked.now if asked.now is not None else time.time()
    read = lambda path: spark.read.parquet(path) if path else None
    if asked.command == "crawl" and asked.search:
        for at in passes(asked.watch, now):
            said = crawl.crawl_site(spark, read(asked.pages), asked.state, asked.search, at.now, asked.max_search_pages, asked.rounds, read(asked.probes))
            print(json.dumps(said))
            at.next = said["next"]
    elif asked.command == "crawl":
        for at in passes(asked.watch, now):
            print(crawl.crawl(spark, read(asked.pages), asked.state, files.url_list(spark, asked.urls), at.now, asked.rounds))
            if asked.probes:
                crawl.size_pass(spark, read(asked.probes), asked.state, at.now)
            at.next = crawl.next_deadline(spark, asked.state)
    elif asked.command == "downloads":
        if asked.retry_failed:
            crawl.reset_pass(spark, asked.state, asked.output, asked.languages)
        for at in passes(asked.watch and asked.responses is not None, now):
            if asked.output and files.path_exists(spark, asked.output):
                crawl.repair_pass(spark, receipts.listed_files(spark, asked.output), receipts.read_receipts(spark, asked.output), asked.state, asked.output)
            if asked.responses:
                crawl.download_pass(spark, read(asked.responses), asked.state, asked.output, at.now, asked.languages, asked.limit)
            held = crawl.tables(spark, asked.state, ("audios", "downloads", "crawl_state"))
            jobs = reports.eligible_jobs(reports.download_jobs(held["audios"], asked.languages), held["downloads"], F.lit(at.now), asked.limit, asked.output)
            jobs.write.mode("overwrite").json(f"{asked.state}/jobs")
            print(json.dumps([r.asDict() for r in reports.download_report(held["downloads"], asked.output).orderBy("status").collect()]))
            at.next = crawl.next_download(held, asked.output, asked.languages)
    elif asked.command == "sizes":
        for at in passes(asked.watch and asked.probes is not None and not asked.summary, now):
            if asked.probes and not asked.summary:
                crawl.size_pass(spark, read(asked.probes), asked.state, at.now)
            print(json.dumps(crawl.size_report(spark, asked.state)))
            at.next = crawl.next_size(crawl.tables(spark, asked.state, ("audio_sizes", "crawl_state")))
    else:
        files.write_json(crawl.audit(files.url_list(spark, asked.urls), spark.read.parquet(asked.pages)), asked.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
