"""Secret scanning: wide candidate patterns, and a random forest that removes false positives.

A candidate is a run of key characters of ``SHORTEST`` or more that holds a digit and a letter, or a run
of any length that is assigned to a name. Runs are split at each ``=`` first, padding apart. The forest sees its length, the transitions between its characters' classes
and how unlike words' their pairs are, how much of it dictionary words cover, its path, and the words
beside it. It is trained by Spark on labelled findings: rows of a text, the finding's place in it, its
path, and whether it is a secret. What words beside it and parts of its path say is learned from the
findings: the log odds of secrets with them. Where no findings are given, ``example_findings`` makes some by rule.

The dictionary counts the words of all documents: those that occur ``DICTIONARY_LEAST`` times and
``DICTIONARY_SHARE`` times as often as the commonest, of ``DICTIONARY_MOST`` words at most.

Defined cases: null or empty text has no candidates, a null path is the empty path; very long texts are
scanned whole, and a candidate may be as long as they are; each occurrence of a
repeated value is a finding of its own, as are those of repeated rows; a null id is kept; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import uuid
from collections import Counter

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources.files import shared_folder

from .common import discard, materialize, prepare, table

#: A dictionary word occurs so often at least, and makes up such a share of all words: there are 1 / DICTIONARY_SHARE of them at most.
SHORTEST, DICTIONARY_LEAST, DICTIONARY_SHARE, TREES, DEPTH, SEED = 16, 3, 5e-6, 40, 8, 11
_RUN = re.compile(r"[A-Za-z0-9_+/.=~-]{%d,}" % SHORTEST)
_GIVEN = re.compile(r"""[=:>]\s{0,3}["']?([A-Za-z0-9_+/.~-]+=*)""")
_PART = re.compile(r"[^=]+=*")
_ASSIGNED = re.compile(r"""([A-Za-z_][\w.-]*)["']?\s{0,3}(?::=|=>|[=:])\s{0,3}["']?$""")
_DIGIT, _LETTER, _WORD = re.compile("[0-9]"), re.compile("[A-Za-z]"), re.compile(r"[^\W\d_]+")

# Words that example_findings puts beside a finding, or in a path, of a secret or of something else.
FOR_WORDS = ("token", "secret", "password", "passwd", "pwd", "key", "apikey", "auth", "authorization", "bearer", "credential", "credentials", "private", "access")
AGAINST_WORDS = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "digest", "hash", "uuid", "guid", "revision", "etag", "integrity", "version", "id", "example", "sample", "dummy", "placeholder", "fake", "test")
AGAINST_PATHS = ("test", "tests", "example", "examples", "sample", "fixture", "fixtures", "doc", "docs", "lock", "mock", "vendor")
PLACEHOLDERS = ("example", "changeme", "your", "xxxx", "placeholder", "dummy", "redacted", "0000", "1234567", "abcdef")

FEATURES = (
    "length", "class_changes", "digits", "upper", "symbols", "hex", "entropy", "odd_pairs", "odd_pair_mean", "dictionary", "placeholder",
    "assigned", "name_odds", "words_for", "words_against", "path_odds", "path_depth", "quoted", "dotted", "grouped",
)


class Lexicon:
    """Dictionary words and how often letters follow each other in them."""

    def __init__(self, words: Counter):
        self.words = {w for w, n in words.items() if n >= DICTIONARY_LEAST and len(w) >= 3}
        self.longest = max(map(len, self.words), default=0)
        pairs = Counter(a + b for w in self.words for a, b in zip(w, w[1:], strict=False))
        first = Counter(p[0] for p in pairs.elements())
        self.pairs = {p: math.log((n + 0.1) / (first[p[0]] + 3)) for p, n in pairs.items()}

    def coverage(self, value: str) -> float:
        """Share of the value's letters that dictionary words of four letters or more cover, the longest first."""
        low, covered, letters = value.lower(), 0, sum(map(str.isalpha, value))
        at = 0
        while at < len(low):
            for size in range(min(self.longest, len(low) - at), 3, -1):
                if low[at : at + size] in self.words:
                    covered += size
                    at += size
                    break
            else:
                at += 1
        return covered / letters if letters else 0.0


class Context:
    """What neighbouring words and path parts say, learned from labelled findings: the log odds of a secret with them."""

    def __init__(self, findings: list[tuple[str, int, int, str, bool]]):
        secrets = sum(f[4] for f in findings)
        self.base = (secrets + 1) / (len(findings) - secrets + 1)
        self.words, self.parts = self._odds((neighbours(t, a, b), s) for t, a, b, _, s in findings), self._odds((path_parts(p), s) for *_, p, s in findings)

    def _odds(self, rows) -> dict[str, float]:
        yes, no = Counter(), Counter()
        for words, secret in rows:
            (yes if secret else no).update(set(words))
        # A word that occurs a few times says little, whatever it occurs with.
        return {w: math.log((yes[w] + 2 * self.base) / (no[w] + 2) / self.base) for w in yes | no if yes[w] + no[w] >= 3}

    def said(self, words: set[str]) -> list[float]:
        """What the parts of the name say in all, and the most that a word beside says for a secret, and against one."""
        odds = {w: self.words[w] for w in words if w in self.words}
        beside = [x for w, x in odds.items() if w[0] != "="]
        return [sum((x for w, x in odds.items() if w[0] == "="), 0.0), max([0.0, *beside]), min([0.0, *beside])]


def neighbours(text: str, start: int, end: int) -> set[str]:
    """The words beside a finding, in small letters: those before it after a <, those behind it after a >, and the parts of a name that it is assigned to after a =."""
    before, after = text[max(0, start - 80) : start], text[end : end + 20]
    name = _ASSIGNED.search(before)
    tagged = (("<", before[-40:]), (">", after), ("=", name.group(1) if name else ""))
    return {tag + w.lower() for tag, part in tagged for w in _WORD.findall(part)}


def path_parts(path: str | None) -> list[str]:
    return [p.lower() for p in re.split(r"[/\\._-]+", path or "") if p]


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(text: str, start: int, end: int, path: str, lexicon: Lexicon, context: Context) -> list[float]:
    value, before = text[start:end], text[max(0, start - 80) : start]
    n, low = len(value), value.lower()
    kinds = [_kind(c) for c in value]
    count = Counter(value)
    odd = [lexicon.pairs.get(a + b, -9.0) for a, b in zip(low, low[1:], strict=False) if a.isalpha() and b.isalpha()]
    name = _ASSIGNED.search(before)
    parts = path_parts(path)
    known = [context.parts[p] for p in parts if p in context.parts]
    return [
        float(n), sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1), kinds.count(2) / n, kinds.count(1) / n, kinds.count(3) / n,
        float(all(c in "0123456789abcdef-" for c in low)), -sum(k / n * math.log2(k / n) for k in count.values()),
        sum(x < -6 for x in odd) / max(1, n - 1), sum(odd) / len(odd) if odd else -9.0, lexicon.coverage(value), float(any(p in low for p in PLACEHOLDERS)),
        float(name is not None), *context.said(neighbours(text, start, end)), min(known, default=0.0) + max(known, default=0.0), float(len(parts)), float(before[-1:] in "\"'" and before != ""), value.count(".") / n,
        float(bool(re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", value))),
    ]


def candidates(text: str) -> list[tuple[int, int]]:
    """Places of candidates in the whole text."""
    found = {}
    for m in _RUN.finditer(text):
        for part in _PART.finditer(text, m.start(), m.end()):
            value = _trimmed(part.group()[:-1] if part.end() < m.end() else part.group())
            start = part.start()
            named = start > m.start() and text[start - 1] == "=" or _ASSIGNED.search(text, max(0, start - 80), start)
            if value and (named or (len(value) >= SHORTEST and _DIGIT.search(value) and _LETTER.search(value))):
                found[start] = start + len(value)
    for m in _GIVEN.finditer(text):
        value, start = _trimmed(m.group(1)), m.start(1)
        if value and _ASSIGNED.search(text, max(0, start - 80), start):
            found.setdefault(start, start + len(value))
    return sorted(found.items())


def _trimmed(part: str) -> str:
    """Without what ends a sentence or a name; empty if nothing but signs is left."""
    value = part.rstrip(".-~") if part.endswith("=") else part.rstrip(".=-~")
    return value if _DIGIT.search(value) or _LETTER.search(value) else ""


def example_findings(words: list[str], n: int = 3000, seed: int = SEED) -> list[tuple[str, int, int, str, bool]]:
    """Labelled findings by rule: (text, start, end, path, secret)."""
    rng, out = random.Random(seed), []
    hexes, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = words or ["lorem", "ipsum", "dolor", "amet"]
    draw = lambda letters, k: "".join(rng.choice(letters) for _ in range(k))
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    while len(out) < n:
        secret, path = rng.random() < 0.5, rng.choice(["src0", "src/app/config", "deploy/env", "lib/client", "notes"])
        name = rng.choice([w for w in FOR_WORDS if w not in ("authorization", "bearer")])
        if secret:
            value = rng.choice([draw(hexes, rng.choice([32, 40, 64])), draw(mixed, rng.randint(20, 48)), draw(mixed + "+/", 40) + "=", rng.choice(["pk_", "key-", "tk_"]) + draw(mixed, 32)])
            lead = rng.choice([f'{name} = "', f"{name}={''}", f'"{rng.choice(words)}_{name}": "', f"{name}: ", "Bearer ", f"export {rng.choice(words).upper()}_{name.upper()}="])
        else:
            kind = rng.randrange(7)
            value = [
                draw(hexes, rng.choice([32, 40, 64])), "-".join(draw(hexes, k) for k in (8, 4, 4, 4, 12)), "_".join(rng.choice(words) for _ in range(4)) + str(rng.randint(0, 99)),
                rng.choice(PLACEHOLDERS) + "_" + rng.choice(PLACEHOLDERS) + "_" + rng.choice(words) + "1", ".".join(rng.choice(words) for _ in range(3)) + f".v{rng.randint(1, 20)}.tar.gz",
                "/".join(rng.choice(words) for _ in range(4)) + f"/{rng.randint(1, 9999)}.html", draw(hexes, 40),
            ][kind]
            against = rng.choice(AGAINST_WORDS)
            lead = {0: f"{against} ", 1: rng.choice(["uuid ", "id = ", 'guid: "']), 3: f'{name} = "', 6: f"{against}: "}.get(kind, rng.choice(["see ", "in ", "https ", 'name = "', "file "]))
            if rng.random() < 0.3:
                path = rng.choice(["tests/fixtures/data", "docs/examples/page", "vendor/package.lock"])
        if len(value) < SHORTEST:
            continue
        if rng.random() < 0.15:
            lead, value = lead.upper(), value.upper()
        before = prose(rng.randint(0, 8)) + " " + lead
        out.append((before + value + ('" ' if lead.endswith('"') else " ") + prose(rng.randint(0, 5)), len(before), len(before) + len(value), path, secret))
    for k in range(n // 5):  # short values of a name, and long runs
        secret, short = k % 2 == 0, rng.random() < 0.6
        if secret:
            value = draw(mixed, rng.randint(6, 15)) if short else draw(mixed + "+/", rng.randint(500, 1800))
        else:
            value = rng.choice([rng.choice(words), str(rng.randint(0, 99999)), rng.choice(words) + str(rng.randint(0, 99))]) if short else rng.choice("/_.").join(rng.choice(words) for _ in range(120)) + "7"
        name = rng.choice(FOR_WORDS if secret else ["name", "note", "page", "title", "lang", rng.choice(words)])
        before = prose(rng.randint(0, 8)) + " " + rng.choice([f'{name} = "', f"{name}=", f"{name}: "])
        out.append((before + value + " " + prose(rng.randint(0, 5)), len(before), len(before) + len(value), "notes", secret))
    return out


def learn_lexicon(docs: DataFrame, text_col: str) -> Lexicon:
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"(\p{L}{3,})"), 1)).alias("w"))
    counts = materialize(words.groupBy("w").agg(F.count("*").alias("n")), "secret-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where(F.col("n") >= max(float(DICTIONARY_LEAST), total * DICTIONARY_SHARE)).collect()
    discard(counts)
    return Lexicon(Counter({r["w"]: r["n"] for r in found}))


def train(spark: SparkSession, findings: list[tuple[str, int, int, str, bool]], lexicon: Lexicon, context: Context):
    rows = [(features(t, a, b, p or "", lexicon, context), float(s)) for t, a, b, p, s in findings]
    data = spark.createDataFrame(rows, "f array<double>, label double").select(array_to_vector("f").alias("features"), "label")
    fitted = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(data)
    # Stored and loaded again the model has no training summary: that one refers to the session, which tasks cannot be sent.
    path = f"{shared_folder(spark)}/secret-forest-{uuid.uuid4().hex}"
    fitted.save(path)
    return RandomForestClassificationModel.load(path)


def scan(docs: DataFrame, findings: list[tuple[str, int, int, str, bool]] | None = None, id_col="doc_id", text_col="text", path_col="source", threshold: float = 0.5) -> DataFrame:
    """doc_id, start, length, value_sha256, score, secret: a row for each candidate, in characters of the text."""
    spark = docs.sparkSession
    prepare(spark)
    lexicon = learn_lexicon(docs, text_col)
    findings = findings if findings is not None else example_findings(sorted(lexicon.words))
    context = Context(findings)
    model = train(spark, findings, lexicon, context)
    shared = spark.sparkContext.broadcast((lexicon, context))
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("value_sha256", pa.string()), ("f", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            rows = []
            for i, t, p in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                t = t.as_py() or ""
                for a, e in candidates(t):
                    rows.append((i, a, e - a, hashlib.sha256(t[a:e].encode("utf-8", "replace")).hexdigest(), features(t, a, e, p or "", *shared.value)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(path_col).cast("string").alias("path"))
    found = narrow.mapInArrow(run, "doc_id long, start long, length long, value_sha256 string, f array<double>")
    judged = model.transform(found.withColumn("features", array_to_vector("f")))
    score = F.element_at(vector_to_array("probability"), 2)
    return judged.select("doc_id", "start", "length", "value_sha256", score.alias("score"), (score >= threshold).alias("secret"))


def op2(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


QUERIES = {"op2_secrets": op2}
