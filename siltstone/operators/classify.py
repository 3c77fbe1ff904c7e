"""Decision tables over responses. The order of the conditions is the specification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import http
from siltstone.sources import files

# Phrases of challenge pages, and of error pages sent instead of media.
CHALLENGES = ("challenge", "verify you are human", "checking your browser", "just a moment")
ERRORS = ("unexpected error", "try again later")
REAL_CONTENT = ("global-search-results-counter", "node--view-mode-full", "taxonomy-term")
GENERIC, BLOCKED, NO_BROWSER = 60, 300, 900


def _any(text: Column, phrases) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(text, F.lit(p))
    return out


def verdict(label: str, blocked=None, delay=None, size=None) -> Column:
    lift = lambda x, kind: (x if isinstance(x, Column) else F.lit(x)).cast(kind)
    return F.struct(F.lit(label).alias("label"), lift(blocked, "boolean").alias("blocked"), lift(delay, "long").alias("delay"), lift(size, "long").alias("size_bytes"))


def challenge_text(html: Column, text: Column) -> Column:
    """Whether a page's visible text is a challenge's; pages with real content are none."""
    return ~_any(html, REAL_CONTENT) & _any(F.lower(F.substring(text, 1, 1500)), CHALLENGES)


def fetch_class(status: Column, wait: Column, challenge: Column, now: Column, browser: bool = False) -> Column:
    """A page response: ok, permanent, retry, browser or error."""
    asked = F.coalesce(wait, F.lit("")) != ""
    delay = lambda d: http.retry_after(wait, now, d)
    puzzled = status.isin(200, 403, 503) & challenge
    return (
        F.when(status.isin(404, 410), verdict("permanent"))
        .when(status == 429, verdict("retry", True, delay(300)))
        .when(puzzled & asked, verdict("retry", True, delay(300)))
        .when(puzzled, verdict("browser") if browser else verdict("retry", True, NO_BROWSER))
        .when(status == 403, verdict("retry", True, delay(NO_BROWSER)))
        .when(status >= 500, verdict("retry", asked, delay(300)))
        .when(status >= 400, verdict("error", False, GENERIC))
        .otherwise(verdict("ok"))
    )


def browser_class(status: Column, wait: Column, challenge: Column, now: Column) -> Column:
    """The same response as a browser would label it."""
    asked = F.coalesce(wait, F.lit("")) != ""
    return (
        F.when(status.isin(404, 410), verdict("permanent"))
        .when((status == 429) | (status >= 500), verdict("retry", (status == 429) | asked, http.retry_after(wait, now, 300)))
        .when((status >= 400) & ~challenge, verdict("retry", True, NO_BROWSER))
        .otherwise(verdict("ok"))
    )


def probe_class(method: Column, status: Column, headers: Column, now: Column) -> Column:
    """A size probe's response: known, missing, unknown, retry, or next (a HEAD that says nothing)."""
    wait, kind = http.header(headers, "Retry-After"), http.header(headers, "Content-Type")
    encoding = F.lower(http.header(headers, "Content-Encoding"))
    mime = http.essence(kind)
    audio = (F.startswith(mime, F.lit("audio/")) | mime.isin("application/octet-stream", "binary/octet-stream")) & encoding.isin("", "identity")
    whole = http.content_length(http.header(headers, "Content-Length"), http.header(headers, "Transfer-Encoding"))
    size = F.when(audio & (status == 200), whole).when(audio & (status == 206) & (method == "GET"), http.probe_range(http.header(headers, "Content-Range")))
    return (
        F.when(status.isin(401, 403, 429) | (wait != ""), verdict("retry", True, http.retry_after(wait, now)))
        .when((status >= 500) & ~((method == "HEAD") & (status == 501)), verdict("retry", False, 60))
        .when((method == "GET") & status.isin(404, 410), verdict("missing"))
        .when(size.isNotNull(), verdict("known", size=size))
        .when(method == "HEAD", verdict("next"))
        .when(F.contains(F.lower(kind), F.lit("html")), verdict("retry", False, 300))
        .otherwise(verdict("unknown"))
    )


def media_class(status: Column, headers: Column, sample: Column, challenge: Column, now: Column) -> Column:
    """A media response: usable, missing, invalid or retry. sample: at most 64 KiB of an error's text."""
    wait, kind = http.header(headers, "Retry-After"), F.lower(http.header(headers, "Content-Type"))
    page = F.contains(kind, F.lit("html")) | status.isin(401, 403, 503)
    return (
        F.when((wait != "") | (status == 429), verdict("retry", True, http.retry_after(wait, now)))
        .when(status.isin(404, 410), verdict("missing"))
        .when(page & (status.isin(401, 403) | challenge), verdict("retry", True, BLOCKED))
        .when(page & ((status >= 500) | _any(F.lower(sample), ERRORS)), verdict("retry", False, GENERIC))
        .when(page, verdict("invalid"))
        .when((status >= 500) | status.isin(408, 425), verdict("retry", False, GENERIC))
        .otherwise(verdict("usable"))
    )


def transfer_class(status: Column, headers: Column, offset: Column, etag: Column, same_url: Column, first: Column, extension: Column, size: Column) -> Column:
    """A transfer: done, restart, invalid or retry. first: the first bytes as text; size: bytes on disk at the end."""
    changed = (status == 206) & ((http.header(headers, "ETag") != F.coalesce(etag, F.lit(""))) | ~same_url)
    total = F.when(status == 206, http.resume_range(http.header(headers, "Content-Range"), offset)).otherwise(
        http.content_length(http.header(headers, "Content-Length"), http.header(headers, "Transfer-Encoding"))
    )
    coded = ~F.lower(http.header(headers, "Content-Encoding")).isin("", "identity")
    head = F.lower(F.ltrim(first))
    page = F.startswith(head, F.lit("<")) | F.startswith(head, F.lit("the website encountered"))
    return (
        F.when((offset > 0) & ((status == 416) | changed), verdict("restart"))
        .when(~status.isin(200, 206) | coded, verdict("invalid"))
        .when((status == 206) & total.isNull(), verdict("invalid"))
        .when(page & _any(head, ERRORS), verdict("retry", False, GENERIC))
        .when(page | extension.isNull(), verdict("invalid"))
        .when((size == 0) | F.coalesce(size != total, F.lit(False)), verdict("retry", False, GENERIC))
        .otherwise(verdict("done", size=size))
    )


def resumable(part_size: Column, same_url: Column, etag: Column) -> Column:
    return (part_size > 0) & same_url & http.strong_etag(etag)


def receipt_valid(url_matches: Column, complete: Column, file: Column, size_there: Column, size_written: Column, extension: Column) -> Column:
    """Whether a receipt stands for a whole file under the root."""
    inside = ~F.startswith(file, F.lit("/")) & ~F.concat(F.lit("/"), file, F.lit("/")).rlike(r"/\.\./")
    return F.coalesce(url_matches & complete & inside & (size_there == size_written) & extension.isNotNull(), F.lit(False))


def audit_status(stopped: Column, error_kind: Column, status: Column) -> Column:
    return (
        F.when(stopped, "non_testee").when(error_kind.isNull(), status)
        .when(error_kind == "unrecognized", "a_verifier").when(error_kind == "permanent", "introuvable").otherwise("a_reessayer")
    )


def follow_redirects(requests, redirects, most: int = 9):
    """Of (url) and (url, status, location): url, final_url, hops, error; most requests in all.

    By doubling: where one hop leads from each redirect is known from the table, two hops are one hop after one hop, and so on, so that
    the joins grow as the logarithm of the hops. Loops run on until they have taken too many; a redirect that leads nowhere keeps why.
    """
    from siltstone.functions.urls import resolve

    table = redirects.where(F.col("status").isin(301, 302, 303, 307, 308)).groupBy("url").agg(F.max("location").alias("location"))
    table = table.withColumn("to", F.when(F.col("location").isNotNull(), resolve("url", "location")["url"]))
    error = F.when(F.col("location").isNull(), "no location").when(~F.coalesce(F.col("to").rlike("^https?://"), F.lit(False)), "not http")
    jump = table.select("url", F.when(error.isNull(), F.col("to")).otherwise(F.col("url")).alias("at"), error.isNull().cast("int").alias("hops"), error.alias("error"))

    def after(first, second):
        """Where rows of first lead when second goes on from there; who has met an error stays."""
        next_ = second.select(F.col("url").alias("_from"), F.col("at").alias("_at"), F.col("hops").alias("_hops"), F.col("error").alias("_error"))
        both = first.join(next_, first["at"] == next_["_from"], "left")
        goes = F.col("error").isNull() & F.col("_from").isNotNull()
        return both.select(
            "url", F.when(goes, F.col("_at")).otherwise(F.col("at")).alias("at"), (F.col("hops") + F.when(goes, F.col("_hops")).otherwise(0)).alias("hops"),
            F.when(goes, F.col("_error")).otherwise(F.col("error")).alias("error"),
        )

    # Each doubling is stored, as it is read twice by the next one; where no redirect leads to another any more, the rest is spared.
    jump = files.stored(jump, "jumps")
    hops = lambda: jump.agg(F.sum("hops")).first()[0]
    taken = hops()
    for _ in range(max(1, (most - 1).bit_length()) if taken else 0):
        jump, before = files.stored(after(jump, jump), "jumps"), taken
        taken = hops()
        if taken == before:
            break
    start = requests.select("url", F.col("url").alias("at"), F.lit(0).alias("hops"), F.lit(None).cast("string").alias("error"))
    found = after(start, jump)
    error = F.when(F.col("hops") >= most, "too many redirects").otherwise(F.col("error"))
    return found.select("url", F.when(error.isNull(), F.col("at")).alias("final_url"), F.least("hops", F.lit(most)).alias("hops"), error.alias("error"))
