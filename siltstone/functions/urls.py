"""Url columns: references are resolved by Spark expressions, so that filters and joins on them stay compiled and need no Python.

``split_resolved`` does the same for one pair, for code that runs in Python anyway. Both keep to the joining of urls that browsers
and libraries agree on: a reference with the base's scheme and no authority is relative, empty queries and fragments fall away, and a
reference of a scheme that has no paths stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import urldefrag, urljoin, urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Schemes whose references may be relative; those with an authority are the same here but for mms, rtsp and the like.
RELATIVE = ("", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss")
AUTHORITY = (
    "", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp", "nfs",
    "git", "git+ssh", "ws", "wss", "itms-services",
)
PARAMETERS = ("", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel")
_PARTS = r"(?s)^(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, where x is worked out once however often f names it."""
    return F.get(F.transform(F.array_repeat(x, 1), f), 0)  # of a literal array the optimizer would write f out


def _clean(url: Column) -> Column:
    """Without control characters and spaces before it, and without tabs and line ends."""
    return F.translate(F.regexp_replace(url, "^[\\x00-\\x20]+", ""), "\t\r\n", "")


def pieces(url: Column) -> Column:
    """struct of scheme, netloc, path (its last segment without parameters), params, query and fragment, empty where there is none, and whole, the path as it is."""

    def of(kind: Column, rest: Column) -> Column:
        at = lambda k: F.regexp_extract(rest, _PARTS, k)

        def split(whole: Column) -> Column:
            cut = F.contains(whole, F.lit(";")) & kind.isin(*PARAMETERS)
            path = F.when(cut, F.regexp_extract(whole, "(?s)^((.*/)?[^/;]*)", 1)).otherwise(whole)
            params = F.when(cut, F.regexp_extract(whole, "(?s)^(.*/)?[^/;]*;([^/]*)$", 2)).otherwise("")
            return F.struct(kind.alias("scheme"), at(2).alias("netloc"), path.alias("path"), params.alias("params"), at(5).alias("query"), at(7).alias("fragment"), whole.alias("whole"))

        return _let(at(3), split)

    def named(clean: Column) -> Column:
        scheme = F.regexp_extract(clean, "(?s)^([A-Za-z][A-Za-z0-9+.-]*):", 1)
        return _let(scheme, lambda k: _let(F.when(k == "", clean).otherwise(F.substr(clean, F.length(k) + 2)), lambda rest: of(F.lower(k), rest)))

    return _let(_clean(url), named)


def joined(scheme: Column, netloc: Column, path: Column, params: Column, query: Column, fragment: Column) -> Column:
    """The url of its parts."""

    def of(path: Column) -> Column:
        rooted = F.when((path != "") & ~F.startswith(path, F.lit("/")), F.concat(F.lit("/"), path)).otherwise(path)
        slashes = F.startswith(path, F.lit("//")) | ((scheme != "") & scheme.isin(*AUTHORITY) & ((path == "") | F.startswith(path, F.lit("/"))))
        head = F.when(netloc != "", F.concat(F.lit("//"), netloc, rooted)).when(slashes, F.concat(F.lit("//"), path)).otherwise(path)
        mark = lambda sign, x: F.when(x != "", F.concat(F.lit(sign), x)).otherwise("")
        return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), head, mark("?", query), mark("#", fragment))

    return _let(F.when(params != "", F.concat(path, F.lit(";"), params)).otherwise(path), of)


def _merged(base: Column, path: Column) -> Column:
    """The path of a reference below that of its base, without dot segments."""
    none = F.array().cast("array<string>")

    def below(of: Column) -> Column:
        # The base's last segment is replaced; empty segments between the first and the last go.
        above = F.when(F.element_at(of, -1) != "", F.slice(of, 1, F.size(of) - 1)).otherwise(of)
        inner = lambda both: F.filter(F.slice(both, 2, F.greatest(F.size(both) - 2, F.lit(0))), lambda x: x != "")
        last = lambda both: F.slice(both, F.greatest(F.size(both), F.lit(1)), F.when(F.size(both) > 1, 1).otherwise(0))
        return _let(F.concat(above, F.split(path, "/")), lambda both: F.concat(F.slice(both, 1, 1), inner(both), last(both)))

    def without_dots(segments: Column) -> Column:
        step = lambda done, x: F.when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.concat(done, F.array(x)))
        end = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(none)
        return F.array_join(F.concat(F.aggregate(segments, none, step), end), "/")

    # A rooted reference keeps its empty segments.
    segments = F.when(F.startswith(path, F.lit("/")), F.split(path, "/")).otherwise(_let(F.split(base, "/"), below))
    return _let(_let(segments, without_dots), lambda text: F.when(text == "", "/").otherwise(text))


def _bad(netloc: Column) -> Column:
    """Whether brackets are not those of an address."""
    return netloc.rlike(r"[\[\]]") & ~netloc.rlike(r"^([^\[\]@]*@)?\[[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*\](:[0-9]*)?$")


def resolve(base: Column | str, href: Column | str) -> Column:
    """The reference's absolute url, the same without fragment (plain), and that one's scheme, netloc and path; null parts if it is no url."""
    base, href = (F.col(x) if isinstance(x, str) else x for x in (base, href))

    def final(url: Column) -> Column:
        def parts(p: Column) -> Column:
            marked = F.contains(url, F.lit("#"))
            plain = F.when(marked, joined(p["scheme"], p["netloc"], p["path"], p["params"], p["query"], F.lit(""))).otherwise(url)
            path = F.when(marked & (p["params"] == ""), p["path"]).otherwise(p["whole"])
            return F.when(~_bad(p["netloc"]), F.struct(url.alias("url"), plain.alias("plain"), p["scheme"].alias("scheme"), p["netloc"].alias("netloc"), path.alias("path")))

        return _let(pieces(url), parts)

    def over(b: Column, r: Column) -> Column:
        def of(scheme: Column) -> Column:
            located, same = scheme.isin(*AUTHORITY), (r["path"] == "") & (r["params"] == "")
            own = (r["netloc"] != "") & located  # the reference names an authority: only the scheme is the base's
            path = F.when(own, r["path"]).when(same, b["path"]).otherwise(_merged(b["path"], r["path"]))
            params = F.when(same & ~own, b["params"]).otherwise(r["params"])
            query = F.when(same & ~own & (r["query"] == ""), b["query"]).otherwise(r["query"])
            netloc = F.when(own | ~located, r["netloc"]).otherwise(b["netloc"])
            whole = _let(path, lambda p: joined(scheme, netloc, p, params, query, r["fragment"]))
            foreign = (scheme != b["scheme"]) | ~scheme.isin(*RELATIVE)
            return F.when(_bad(r["netloc"]) | _bad(b["netloc"]), F.lit(None).cast("string")).when(foreign, href).otherwise(whole)

        return _let(F.when(r["scheme"] == "", b["scheme"]).otherwise(r["scheme"]), of)

    both = _let(pieces(base), lambda b: _let(pieces(href), lambda r: over(b, r)))
    url = F.when(base == "", href).when(href == "", base).otherwise(both)
    return F.when(base.isNotNull() & href.isNotNull(), _let(url, final))


def split_resolved(base: str, href: str) -> tuple[str, str, str, str, str] | None:
    """The reference's absolute url, the same without fragment, and that one's parts; None if it is no url."""
    try:
        url = urljoin(base, href)
        plain = urldefrag(url)[0]
        parts = urlsplit(plain)
    except ValueError:
        return None
    return url, plain, parts.scheme, parts.netloc, parts.path


def same_site(link: Column, base: Column) -> Column:
    """Whether a resolved link is http and of the (resolved) base's host."""
    return link["scheme"].isin("http", "https") & (link["netloc"] == base["netloc"])


def page_number(href: Column) -> Column:
    """The number in the query parameter ``page``; null if there is none."""
    return F.regexp_extract(href, r"[?&]page=([0-9]+)", 1).try_cast("long")


def search_pages(last_href: Column, total: Column, per_page: int = 12) -> Column:
    """Search pages: by the last pager link, else by the number of results."""
    return F.coalesce(page_number(last_href) + 1, F.floor((total + (per_page - 1)) / per_page))


def number_text(text: Column) -> Column:
    """A count as written, with any white space between its digits."""
    return F.regexp_replace(text, r"(?U)\s+", "").try_cast("long")
