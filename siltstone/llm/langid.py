"""Language identification in two levels: the family first, then the languages within it.

Features are hashed letter bigrams and trigrams of the lower-cased text, with one sign for all that is
no letter, as shares of the text's n-grams. Families are separated by one-versus-one linear support
vector machines (squared hinge), and so are the languages of each family, on that family's texts
alone. Languages of no known family are put together by their texts, ``MEMBERS`` to a family at most, so
that the machines grow about as the languages do. They are fitted on the driver, on a bounded sample of
labelled texts (the ``MOST_LANGS`` commonest languages, about ``PER_LANG`` texts of each, ``SAMPLE_CHARS``
characters of a text from a pseudorandom place, whole and in snippets); the model's size is bounded by
these. A prediction reads the whole text.

Defined cases: a null text, or one without letters, is ``und`` with score 0; rows without a language or
a text take no part in fitting; with one language only it is predicted with score 1, with none every
text is ``und``; texts of any length and repeated rows are treated alike; an empty table gives an
empty result; other columns are ignored by ``identify``, whatever their names, and kept by ``annotate``,
which refuses names of its own that the documents have already.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, table

UNKNOWN = "und"
#: Families of common language codes; others are put together by their texts.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "indo-aryan": ("hi", "bn", "ur", "mr", "gu", "pa", "ne"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he", "mt"),
}
PER_LANG, MOST_LANGS, MEMBERS, SAMPLE_CHARS, SNIPPETS, BUCKET_BITS, ROUNDS = 500, 256, 12, 800, (12, 40, 120), 15, 60
#: Characters of texts that are looked at together: some 100 bytes each are held for them.
GROUP_CHARS = 1 << 17
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


def family_of(lang: str) -> str | None:
    return next((name for name, codes in FAMILIES.items() if lang.partition("-")[0].lower() in codes), None)


def other_families(langs: list[str], centres: dict[str, np.ndarray], members: int = MEMBERS) -> dict[str, str]:
    """The families of languages of no known one: a language and those whose n-gram shares are nearest to its own, named after it."""
    left, out = list(langs), {}
    while left:
        first = centres[left[0]]
        near = sorted(left, key=lambda x: (-float(first @ centres[x]), x)) if len(left) > 1 else left
        near = [left[0], *[x for x in near if x != left[0]]][:members]
        out |= dict.fromkeys(near, f"like {near[0]}")
        left = [x for x in left if x not in out]
    return out


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def ngrams(texts: list[str], bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all texts' n-grams, the text of each, and whether a text has letters."""
    lowered = [f" {t.lower()} " for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    keep = letter.copy()  # of signs in a row that are no letters one stays
    keep[1:] |= letter[:-1]
    keep[np.cumsum(sizes) - sizes] = True  # and a text's first, whatever text stands before it
    c, doc = np.where(letter, codes, np.uint32(0))[keep], doc[keep]
    has = np.bincount(doc[c > 0], minlength=len(texts)) > 0
    shift = np.uint32(32 - bits)
    two = (c[:-1] * _MIX[0] + c[1:] * _MIX[1]) * _MIX[2] >> shift
    ok2 = (doc[:-1] == doc[1:]) & ((c[:-1] > 0) | (c[1:] > 0))
    mid = (c[:-2] * _MIX[1] + c[1:-1] * _MIX[2] + c[2:] * _MIX[0] + np.uint32(1)) * _MIX[1] >> shift
    ok3 = (doc[:-2] == doc[2:]) & (c[1:-1] > 0)
    return np.concatenate([two[ok2], mid[ok3]]), np.concatenate([doc[:-1][ok2], doc[:-2][ok3]]), has


def fit_machine(bucket: np.ndarray, doc: np.ndarray, y: np.ndarray, size: int, rounds: int = ROUNDS, decay: float = 1e-5) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss on n-gram shares; classes weigh alike. Accelerated gradient."""
    n = len(y)
    share = 10.0 / np.maximum(np.bincount(doc, minlength=n), 1)
    cell, times = np.unique(doc.astype(np.int64) * size + bucket, return_counts=True)
    doc, bucket = cell // size, cell % size
    val = share[doc] * times
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    forward = lambda w: np.bincount(doc, val * w[bucket], minlength=n)
    back = lambda g: np.bincount(bucket, val * g[doc], minlength=size)
    v = np.ones(size)
    for _ in range(8):  # the largest curvature
        v = back(weight * forward(v))
        v /= (top := np.linalg.norm(v)) or 1.0
    step = 1.0 / (2.2 * top + decay)
    w, ahead = np.zeros(size), np.zeros(size)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * forward(ahead))
        new = ahead - step * (decay * ahead - 2 * back(weight * y * slack))
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return (w * 10).astype(np.float32)


class LanguageModel:
    """Machines of the families and of the pairs of languages within each."""

    def __init__(self, texts: list[str], langs: list[str], bits: int = BUCKET_BITS):
        self.bits, self.langs = bits, sorted(set(langs))
        families = {lang: family_of(lang) for lang in self.langs}
        if others := [x for x in self.langs if families[x] is None]:
            families |= other_families(others, self._centres(texts, langs, others))
        self.families = {f: [x for x in self.langs if families[x] == f] for f in sorted(set(families.values()))}
        self.pairs: list[tuple[str, str]] = []
        weights = []
        bucket, doc, _ = ngrams(texts, bits) if texts else (np.zeros(0, np.uint32), np.zeros(0, np.int32), None)
        lang, fam = np.array(langs), np.array([families[x] for x in langs])
        levels = [(fam, a, b) for a, b in combinations(self.families, 2)]
        levels += [(lang, a, b) for members in self.families.values() for a, b in combinations(members, 2)]
        for names, a, b in levels:
            rows = np.flatnonzero((names == a) | (names == b))
            at = np.full(len(names), -1)
            at[rows] = np.arange(len(rows))
            mine = at[doc] >= 0
            y = np.where(names[rows] == a, 1.0, -1.0)
            weights.append(fit_machine(bucket[mine], at[doc[mine]], y, 1 << bits))
            self.pairs.append((a, b))
        self.weights = np.stack(weights, 1) if weights else np.zeros((1 << bits, 0), np.float32)

    def _centres(self, texts: list[str], langs: list[str], others: list[str]) -> dict[str, np.ndarray]:
        out = {}
        for lang in others:
            bucket, _, _ = ngrams([t for t, x in zip(texts, langs, strict=True) if x == lang], self.bits)
            v = np.sqrt(np.bincount(bucket, minlength=1 << self.bits).astype(np.float64))
            out[lang] = v / (np.linalg.norm(v) or 1.0)
        return out

    def _vote(self, names: list[str], margins: dict, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The winner of each row by one-versus-one votes (then by margins), and its smallest margin over another."""
        votes, lead = np.zeros((len(names), len(rows))), np.full((len(names), len(rows)), np.inf)
        for (i, a), (j, b) in combinations(enumerate(names), 2):
            m = margins[a, b][rows]
            votes[i] += (m > 0) + 1e-3 * np.tanh(m)
            votes[j] += (m <= 0) - 1e-3 * np.tanh(m)
            lead[i], lead[j] = np.minimum(lead[i], m), np.minimum(lead[j], -m)
        best = votes.argmax(0)
        return best, lead[best, np.arange(len(rows))]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score in 0 to 1 of each text; texts are looked at in groups of bounded size."""
        langs, scores, at = [], [np.zeros(0)], 0
        while at < len(texts):
            end, chars = at + 1, len(texts[at])
            while end < len(texts) and chars + len(texts[end]) <= GROUP_CHARS:
                chars, end = chars + len(texts[end]), end + 1
            some, score = self._predict(texts[at:end])
            langs, scores, at = langs + some, [*scores, score], end
        return langs, np.concatenate(scores)

    def _predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        langs, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        if not texts or not self.langs:
            return langs.tolist(), score
        bucket, doc, has = ngrams(texts, self.bits)
        count = np.maximum(np.bincount(doc, minlength=len(texts)), 1)
        margin = lambda p, bucket, doc: np.bincount(doc, self.weights[bucket, self.pairs.index(p)], minlength=len(texts)) / count
        rows = np.flatnonzero(has)
        names = list(self.families)
        family, lead = self._vote(names, {p: margin(p, bucket, doc) for p in combinations(names, 2)}, rows)
        for k, f in enumerate(names):
            own = family == k
            its = np.isin(doc, rows[own])  # the machines of a family look at the texts that it has won
            best, inner = self._vote(self.families[f], {p: margin(p, bucket[its], doc[its]) for p in combinations(self.families[f], 2)}, rows[own])
            langs[rows[own]] = np.array(self.families[f], object)[best]
            score[rows[own]] = 1 / (1 + np.exp(-4 * np.clip(np.minimum(lead[own], inner), -10, 10)))
        return langs.tolist(), score


def training_sample(docs: DataFrame, may_learn: Column, id_col: str, text_col: str, lang_col: str, per_lang: int = PER_LANG) -> tuple[list[str], list[str]]:
    """Texts and languages: a pseudorandom share of each language's rows, bounded in rows and characters."""
    rows = docs.where(may_learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(MOST_LANGS).collect()}
    if not counts:
        return [], []
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col).cast("string")), F.lit(1 << 30)) / (1 << 30)
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, per_lang / n))])
    start = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.greatest(F.lit(1), F.length(text_col) - SAMPLE_CHARS)) + 1
    picked = rows.where(draw < share[F.col(lang_col)]).select(F.substr(F.col(text_col), start.cast("int"), F.lit(SAMPLE_CHARS)).alias("t"), F.col(lang_col).alias("l"))
    texts, langs = [], []
    for n, r in enumerate(sorted(picked.collect())):
        cuts = [r.t] + [r.t[(k * 37 + n * 11) % max(1, len(r.t) - k) :][:k] for k in SNIPPETS]
        cuts = [c for c in cuts if any(map(str.isalpha, c))]
        texts += cuts
        langs += [r.l] * len(cuts)
    return texts, langs


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def annotate(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", pred_col="lang_pred", score_col="score") -> DataFrame:
    """The documents, all columns, with the predicted language and its score; fitted on the rows that are not held out."""
    if {pred_col, score_col} & set(docs.columns):
        raise ValueError(f"the documents have a column {pred_col} or {score_col} already")
    spark = docs.sparkSession
    prepare(spark)
    model = LanguageModel(*training_sample(docs, ~held_out(id_col), id_col, text_col, lang_col))
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            langs, score = shared.value.predict([t or "" for t in b.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=[*b.schema.names, pred_col, score_col])

    schema = T.StructType([*docs.schema.fields, T.StructField(pred_col, T.StringType()), T.StructField(score_col, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    return annotate(rows, "doc_id", "text", "lang").select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op3(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


QUERIES = {"op3_langid": op3}
