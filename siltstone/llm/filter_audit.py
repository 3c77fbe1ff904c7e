"""What filters remove together: an audit of every order of them, by inclusion and exclusion.

For each part of the documents and each set of filters the documents that fail *all* filters of the set
are counted (the joint failures: products of the filters' flags; rows of one part and one combination of
flags are added up before). All else follows from these 2^k counts of a part, so that no order of the
filters is ever run over documents:

- survivors of a set: the signed sum of the joint failures of its subsets (Moebius inversion downwards);
  what a step removes is the difference of two of them;
- documents that fail exactly one set: the signed sum over its supersets (inversion upwards), of which
  the sets of one filter are the unique failures;
- Shapley values: joint failures with alternating signs are the Harsanyi dividends of the game "how many
  documents are removed by a set of filters"; a dividend is shared equally by the filters of its set.

Whether an earlier document has the same text is told by a digest of 256 bits: the smallest id of each
digest is counted before it is exchanged, and rows meet it by digest *and* id, so that the copies of one
text never come together in one task.

Defined cases: null text is empty, and empty texts are identical to each other; an empty text has no words
(fails A, passes B to D); a null part is the empty string, and goes together with it; rows without id are
nobody's copies and have no labels; rows that repeat an id and text are not copies of one another, and each
counts; of several labels of one id, one of 1 suffices; labels without a document count nothing; very long
texts are judged whole; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, materialize, prepare, table

FILTERS = "ABCDE"
FEWEST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SIGNS = 100, 80, 10, "[#$%&*|]"
MEASURES = ("n", "good", "toxic")


def text_flags(text: Column, words: Column) -> dict[str, Column]:
    """The filters that look at one text alone: name to failure."""
    upper = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < FEWEST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        "C": 100 * upper.cast("long") > UPPER_PERCENT * F.length(text),
        "D": text.rlike(SIGNS),
    }


def failures(docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: part, doc_id, A to E (1 if it fails), good and toxic (0 or 1)."""
    rows = docs.select(
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    rows = rows.withColumn("words", F.array_remove(F.split("text", f"[{SPACE}]+"), ""))
    flags = [f.cast("int").alias(c) for c, f in text_flags(F.col("text"), F.col("words")).items()]
    rows = materialize(rows.select("part", "doc_id", *flags, F.unhex(F.sha2("text", 256)).alias("digest")), "audit-rows")
    known = rows.where("doc_id is not null")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("E", F.lit(0))
    is_one = lambda c: F.max((F.col(c) == 1).cast("int"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    judged = known.join(first, ["digest", "doc_id"], "left").withColumn("E", F.coalesce("E", F.lit(1))).join(marks, "doc_id", "left")
    rest = rows.where("doc_id is null").withColumn("E", F.lit(0))
    return judged.unionByName(rest, allowMissingColumns=True).select("part", "doc_id", *FILTERS, *[F.coalesce(c, F.lit(0)).alias(c) for c in MEASURES[1:]])


def joint_failures(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Of failures: a row for each part, with arrays n, good and toxic; place m counts the documents that fail all filters whose bits m has."""
    few = rows.groupBy("part", *filters).agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in MEASURES[1:]])

    def product(mask: int) -> Column:
        out = F.lit(1).cast("long")
        for k, f in enumerate(filters):
            if mask >> k & 1:
                out = out * F.col(f)
        return out

    masks = range(1 << len(filters))
    sums = few.groupBy("part").agg(*[F.sum(F.col(c) * product(m)).alias(f"{c}_{m}") for c in MEASURES for m in masks])
    return sums.select("part", *[F.array(*[F.col(f"{c}_{m}") for m in masks]).alias(c) for c in MEASURES])


def _inverted(joint: np.ndarray, upwards: bool) -> np.ndarray:
    """Moebius inversion of joint failures: of every set its survivors or, upwards, those that fail exactly it."""
    out, size = joint.astype(np.int64), len(joint)
    for bit in (1 << k for k in range(size.bit_length() - 1)):
        has = np.arange(size) & bit > 0
        if upwards:
            out[~has] -= out[has]
        else:
            out[has] = out[~has] - out[has]
    return out


def shapley(joint: np.ndarray) -> np.ndarray:
    """Of each filter its removals, summed over all orders: k! times its shares of the dividends."""
    k = len(joint).bit_length() - 1
    size = np.array([m.bit_count() for m in range(len(joint))])
    share = np.where(size % 2 == 1, 1, -1) * joint.astype(np.int64) * (factorial(k) // np.maximum(size, 1))
    return np.array([share[[m for m in range(len(joint)) if m >> f & 1]].sum() for f in range(k)])


ORDERS = "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Of failures: a row for each part, order of the filters and step of it."""
    prepare(rows.sparkSession)
    k = len(filters)
    steps = []  # order, step, filter, filters before it
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            steps.append(("".join(filters[x] for x in order), step, f, before))
            before |= 1 << f

    def of_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = np.array([s[0] for s in steps])
        step, f, before = (np.array([s[c] for s in steps]) for c in (1, 2, 3))
        for batch in batches:
            for row in batch.itertuples(index=False):
                n, good, toxic = (np.asarray(getattr(row, c)) for c in MEASURES)
                lost = {c: (left := _inverted(x, False))[before] - left[before | 1 << f] for c, x in zip(MEASURES, (n, good, toxic), strict=True)}
                one = 1 << f
                yield pd.DataFrame(
                    {
                        "part": row.part, "filter_order": names, "step": step, "filter": np.array(list(filters))[f],
                        "kept": _inverted(n, False)[before | one], "removed": lost["n"], "redundant": n[one] - lost["n"], "unique_fails": _inverted(n, True)[one],
                        "good_lost": lost["good"], "toxic_lost": lost["toxic"], "shapley": shapley(n)[f],
                    }
                )

    return joint_failures(rows, filters).mapInPandas(of_part, ORDERS)


def op11(spark, sf_dir: str) -> DataFrame:
    return audit(failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


QUERIES = {"op11_filter_audit": op11}

ORACLE_SQL = {
    "op11_filter_audit": r"""
with words as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
first_id as (select text, min(doc_id) as least from words group by text),
good as (select distinct doc_id from labels where quality = 1), toxic as (select distinct doc_id from labels where toxic = 1),
docs as (select part, {'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w), 'C': 100 * len(regexp_replace(words.text, '[^A-Z]', '', 'g')) > 10 * length(words.text),
    'D': regexp_matches(words.text, '[#$%&*|]'), 'E': coalesce(words.doc_id > least, false)} as f, g.doc_id is not null as is_good, t.doc_id is not null as is_toxic
  from words join first_id on first_id.text = words.text left join good g on g.doc_id = words.doc_id left join toxic t on t.doc_id = words.doc_id),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (select a.x || b.x || c.x || d.x || e.x as filter_order from letters a, letters b, letters c, letters d, letters e where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (select filter_order, s::int as step, substr(filter_order, s::int, 1) as filter, substr(filter_order, 1, s::int - 1) as before from orders, range(1, 6) as r(s)),
failed as (select part, is_good, is_toxic, (case when f.A then 'A' else '' end) || (case when f.B then 'B' else '' end) || (case when f.C then 'C' else '' end)
    || (case when f.D then 'D' else '' end) || (case when f.E then 'E' else '' end) as fails from docs),
runs as (select part, filter_order, step, filter, fails = filter as only_this, is_good, is_toxic, contains(fails, filter) as bad,
    before <> '' and fails <> '' and regexp_matches(fails, '[' || before || '_]') as gone from failed, steps),
counted as (select part, filter_order, step, filter, count(*) filter (not gone and not bad) as kept, count(*) filter (not gone and bad) as removed, count(*) filter (gone and bad) as redundant,
    count(*) filter (only_this) as unique_fails, count(*) filter (not gone and bad and is_good) as good_lost, count(*) filter (not gone and bad and is_toxic) as toxic_lost
  from runs group by all)
select *, cast(sum(removed) over (partition by part, filter) as bigint) as shapley from counted""",
}
