"""URL filtering by mined association rules, with DataFrame functions and Spark's FP-growth only.

Listed rules (host and path prefix) decide first. Other urls are judged by rules that FP-growth
mines from labelled urls: an url's items are its host's labels, path segments (digits as ``#``) and
query keys, all of them, and its label is an item too. Rules that conclude on a label are pruned by
support, by confidence, with a threshold of its own for each label, and by how sure it is that the
confidence is above the label's share of all labelled urls, which must be the surer the more sets of items
were looked at; then by rules that say the same with fewer items. Items that only ever come together in the
labelled urls are one item for mining, the first of them, and any of them stands for it in an url: a template
of many items does not multiply the sets. Rules are matched through an inverted index: each rule stands in the bucket of its rarest item,
so an url looks at the buckets of its own items alone, checks that all items of a rule are there, and
takes the rule of the largest lift: its confidence as a multiple of its label's share.

Defined cases: a null url or one without ``://`` has an empty host and path, fits no listed rule and
has no items, so it is allowed; a null label takes no part in mining; repeated rows are judged alike
and each count in mining; of rules of equal lift the one of larger confidence, then support, then block,
wins; without labelled urls no rules are mined and all other urls are allowed; an empty table gives an
empty result; very long urls are mined and judged whole; other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from itertools import combinations, product
from statistics import NormalDist

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, table

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Of a mined rule: least support, least urls, least confidence by label, least standard deviations above the
#: label's share, and most items. Rules that chance alone may be expected to make; labelled urls that mining reads, about; buckets of the rule index.
MIN_SUPPORT, MIN_URLS, BLOCK_CONFIDENCE, ALLOW_CONFIDENCE, SURE, RULE_ITEMS, CHANCE, SAMPLE, BUCKETS = 0.002, 20, 0.4, 0.75, 2.0, 4, 0.05, 200_000, 512
BLOCK, ALLOW = "=block", "=allow"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` up to ``/ ? #`` or the end, then up to ``? #`` or the end."""
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def items(url: Column, host: Column, path: Column) -> Column:
    """An url's tokens: host labels from the end, path segments, query keys."""
    kept = lambda parts, kind: F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(kind), p))
    shape = F.regexp_replace(path, "[0-9]+", "#")
    query = F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1), "=[^&]*", "")
    return F.array_distinct(F.concat(kept(F.reverse(F.split(host, r"\.")), "h:"), kept(F.split(shape, "/"), "p:"), kept(F.split(query, "&"), "q:")))


def _literal(value, schema: str) -> Column:
    """A constant that the optimizer folds; for what has a bounded size."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def listed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest listed rule that fits, as struct<rule, verdict>; null if none does.

    Rules stand in an array of buckets by host; an url looks up its host and the ends of it.
    """
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    n = max(1, len(rules))
    table: list[list[dict]] = [[] for _ in range(n)]
    for h, p, verdict in rules:
        table[_bucket(h, n)].append({"host": h, "path": p, "rule": h + p, "verdict": verdict})
    index = _literal(table, "array<array<struct<host:string,path:string,rule:string,verdict:string>>>")
    labels = F.split(host, r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.flatten(F.transform(ends, lambda e: F.filter(
        F.get(index, F.pmod(F.crc32(e.cast("binary")), F.lit(n)).cast("int")), lambda r: (r["host"] == e) & F.startswith(path, r["path"])
    )))
    best = F.array_max(F.transform(fits, lambda r: F.struct(F.length(r["rule"]).alias("n"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    return F.when(F.size(fits) > 0, F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def _bucket(text: str, n: int) -> int:
    import zlib

    return zlib.crc32(text.encode()) % n


def baskets(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """items of (url, blocked) rows that have both, the label among them; of many rows, about as many as sample, drawn by a hash of all the row's columns (an id makes rows differ)."""
    rows = labelled.where("blocked is not null and url is not null")
    n = rows.count()
    if n > sample:
        rows = rows.where(F.pmod(F.xxhash64(F.lit("basket"), *sorted(rows.columns)), F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    host, path = url_parts(F.col("url"))
    return rows.select(F.concat(items(F.col("url"), host, path), F.array(F.when(F.col("blocked"), BLOCK).otherwise(ALLOW))).alias("items"))


def together(rows: DataFrame, least: int) -> dict[str, list[str]]:
    """Of baskets: the items of as many rows as least, by the first of those that come in the same rows; labels aside.

    Rows are compared by their number and two sums of hashes. There are at most as many such items as a row has in the mean, times the rows, divided by least.
    """
    # In a step of its own: beside the explode, each item would be numbered.
    numbered = rows.select(F.monotonically_increasing_id().alias("r"), "items")
    each = numbered.select("r", F.explode("items").alias("item")).where(~F.col("item").isin(BLOCK, ALLOW))
    sums = [F.sum(F.xxhash64(F.lit(k), "r").cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)]
    marks = each.groupBy("item").agg(F.count("*").alias("n"), *sums).where(F.col("n") >= least)
    groups = marks.groupBy("n", "s1", "s2").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return {r["items"][0]: r["items"] for r in groups.select("items").collect()}


def as_groups(tokens: Column, groups: dict[str, list[str]], buckets: int = BUCKETS) -> Column:
    """The tokens with the first of their group in place of each."""
    others = [(i, first) for first, items in groups.items() for i in items if i != first]
    if not others:
        return tokens
    table: list[list[dict]] = [[] for _ in range(buckets)]
    for i, first in others:
        table[_bucket(i, buckets)].append({"i": i, "f": first})
    index = _literal(table, "array<array<struct<i:string,f:string>>>")
    found = lambda t: F.filter(F.get(index, F.pmod(F.crc32(t.cast("binary")), F.lit(buckets)).cast("int")), lambda r: r["i"] == t)
    return F.array_distinct(F.transform(tokens, lambda t: F.coalesce(F.get(found(t), 0)["f"], t)))


def least_deviations(sets: int, sure: float = SURE, chance: float = CHANCE) -> float:
    """So many standard deviations that, of so many sets looked at, about chance are expected to reach them by chance."""
    return max(sure, NormalDist().inv_cdf(1 - chance / max(1, sets))) if sets else sure


def mine_rules(labelled: DataFrame, min_support=MIN_SUPPORT, min_urls=MIN_URLS, block_confidence=BLOCK_CONFIDENCE, allow_confidence=ALLOW_CONFIDENCE, sure=SURE, most_items=RULE_ITEMS, sample=SAMPLE) -> list[dict]:
    """Of (url, blocked) rows, which may have an id besides: rules with items, block, confidence, support, lift and key, the rarest item; groups has, of each item that stands for several, all of them."""
    rows = materialize(baskets(labelled, sample), "url-baskets")
    n = rows.count()
    if not n:
        return []
    least = max(min_support, min_urls / n)
    groups = together(rows, math.ceil(least * n - 1e-9))
    rows = materialize(rows.select(as_groups(F.col("items"), groups).alias("items")), "url-groups")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least), minConfidence=min(block_confidence, allow_confidence)).fit(rows)
    single = {r["items"][0]: r["freq"] for r in model.freqItemsets.where("size(items) = 1").collect()}
    share = {c: single.get(c, 0) / n or rows.where(F.array_contains("items", c)).count() / n for c in (BLOCK, ALLOW)}
    labels = F.size(F.array_intersect("items", F.array(F.lit(BLOCK), F.lit(ALLOW))))
    sets = model.freqItemsets.where((labels == 1) & F.size("items").between(2, most_items + 1)).count()
    sure = least_deviations(sets, sure)
    found = model.associationRules.where(F.element_at("consequent", 1).isin(BLOCK, ALLOW)).where(F.size("antecedent") <= most_items)
    found = found.where(~F.exists("antecedent", lambda i: i.isin(BLOCK, ALLOW)))
    block, base = F.element_at("consequent", 1) == BLOCK, F.when(F.element_at("consequent", 1) == BLOCK, share[BLOCK]).otherwise(share[ALLOW])
    urls = F.round(F.col("support") * n / F.col("confidence"))
    above = (F.col("confidence") - base) * F.sqrt(urls) >= sure * F.sqrt(base * (1 - base))
    enough = F.col("confidence") >= F.when(block, block_confidence).otherwise(allow_confidence)
    found = found.where(above & enough & (F.col("confidence") > base)).select(F.array_sort("antecedent").alias("items"), block.alias("block"), "confidence", "support", (F.col("confidence") / base).alias("lift"))
    best: dict[bool, dict[tuple, float]] = {True: {}, False: {}}
    out = []
    # Shorter rules first; best is the largest confidence of a set's own rule and of its subsets' rules.
    for r in sorted(found.collect(), key=lambda r: (len(r["items"]), r["items"])):
        own, b = tuple(r["items"]), r["block"]
        below = max((best[b].get(s, 0.0) for k in range(1, len(own)) for s in combinations(own, k)), default=0.0)
        best[b][own] = max(below, r["confidence"])
        if r["confidence"] > below:
            out.append(r.asDict() | {"key": min(own, key=lambda i: (single.get(i, 0), i)), "groups": {i: groups[i] for i in own if len(groups.get(i, ())) > 1}})
    return out


def spelled_out(rules: list[dict]) -> Iterator[dict]:
    """The rules with every choice of an item in place of one that stands for several."""
    for r in rules:
        for choice in product(*[r["groups"].get(i, [i]) for i in r["items"]]):
            yield r | {"items": sorted(choice), "groups": {}}


def mined_verdict(tokens: Column, rules: list[dict], buckets: int = BUCKETS) -> Column:
    """block or allow by the rule of the largest lift all of whose items are tokens; null if there is none."""
    if not rules:
        return F.lit(None).cast("string")
    table: list[list[dict]] = [[] for _ in range(buckets)]
    for r in rules:
        table[_bucket(r["key"], buckets)].append({k: x for k, x in r.items() if k != "groups"})
    tokens = as_groups(tokens, {i: g for r in rules for i, g in r["groups"].items()}, buckets)
    index = _literal(table, "array<array<struct<key:string,items:array<string>,block:boolean,confidence:double,support:double,lift:double>>>")

    def posted(t: Column) -> Column:
        at = F.pmod(F.crc32(t.cast("binary")), F.lit(buckets)).cast("int")
        return F.filter(F.get(index, at), lambda r: (r["key"] == t) & (F.size(F.array_except(r["items"], tokens)) == 0))

    hits = F.flatten(F.transform(tokens, posted))
    best = F.array_max(F.transform(hits, lambda r: F.struct(r["lift"].alias("l"), r["confidence"].alias("c"), r["support"].alias("s"), r["block"].alias("b"))))
    return F.when(F.size(hits) > 0, F.when(best["b"], "block").otherwise("allow"))


def judge(pages: DataFrame, rules: list[dict], listed=RULES, id_col="page_id", url_col="url") -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    url = F.col("url")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    host, path = url_parts(url)
    rows = rows.withColumns({"host": host, "path": path})
    rows = rows.withColumns({"hit": listed_rule(F.col("host"), F.col("path"), listed), "tokens": items(url, F.col("host"), F.col("path"))})
    verdict = F.coalesce(F.col("hit")["verdict"], mined_verdict(F.col("tokens"), rules), F.lit("allow"))
    return rows.select("page_id", "host", "path", F.col("hit")["rule"].alias("rule"), verdict.alias("verdict"))


def op1(spark, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    judged = labels.where("toxic is not null or quality is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("blocked"))
    return judge(pages, mine_rules(pages.select("page_id", "url").join(judged, "page_id").select("page_id", "url", "blocked")))


QUERIES = {"op1_url_filter": op1}
