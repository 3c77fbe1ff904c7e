"""The operators against brute force, exact round trips and held-out accuracy, and their defined cases."""

import collections
import hashlib
import os
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import ann, bpe, chat, components, exact_dedup, langid, line_dedup, mixing, ngram_join, registry, secrets, url_filter

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score int, size long"


def docs(spark, texts, sources=None, ids=None, langs=None):
    rows = [(ids[i] if ids else i, t, (langs or ["en"] * len(texts))[i], (sources or ["s"] * len(texts))[i], len(t or ""), "x", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


def empty(spark):
    return spark.createDataFrame([], DOCS)


# Exact dedup


def test_exact_dedup(spark, documents, texts):
    first = {}
    for i in sorted(texts):
        first.setdefault(SPACE.sub(" ", texts[i]), i)
    sizes = collections.Counter(SPACE.sub(" ", t) for t in texts.values())
    for r in exact_dedup.dedup_groups(documents).collect():
        t = SPACE.sub(" ", texts[r.doc_id])
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (first[t], sizes[t], first[t] == r.doc_id, hashlib.sha256(t.encode()).hexdigest())


def test_exact_dedup_cases(spark):
    df = docs(spark, [None, "", " ", "\t\n", "a b", "a\u00a0b", "a \n b", "a b", "a b"], ids=[5, 4, 3, 2, 9, 8, 7, 7, None])
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup_groups(df).collect()]
    assert sum(k for *_, k in got) == 4 and len(got) == 9
    assert (5, 4, 2, False) in got and (3, 2, 2, False) in got and (None, 7, 4, False) in got and (8, 8, 1, True) in got
    assert sorted(g for g in got if g[0] == 7) == [(7, 7, 4, False), (7, 7, 4, True)]
    assert exact_dedup.dedup_groups(empty(spark)).count() == 0
    assert exact_dedup.dedup(docs(spark, ["a", "a ", "a"])).columns == DOCS.replace(",", "").split()[::2]


def test_grace_spills_and_compares_contents():
    rng = random.Random(1)
    records = [(bytes(rng.choices(b"abc", k=rng.randint(0, 4))), str(i).encode()) for i in range(3000)]
    want = collections.defaultdict(list)
    for c, p in records:
        want[c].append(p)
    got = list(exact_dedup.grace_groups(iter(records), limit=20, fanout=3))
    assert len(got) == len(want) and {c: sorted(p) for c, p in got} == {c: sorted(p) for c, p in want.items()}
    table = exact_dedup.OpenTable(4)
    assert [table.find(7, c, True) for c in (b"x", b"y", b"x", b"z")] == [0, 1, 0, 2]  # one hash, different contents


# Byte-level BPE


@pytest.fixture(scope="module")
def coder():
    import public_tokenizers

    return bpe.PrefixCoder(bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY)), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_bpe_equals_library(spark, documents, texts, library):
    import public_tokenizers

    got = bpe.encode_documents(documents, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN, ids=True).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_texts_appends_and_edits(coder, library):
    rng = random.Random(2)
    signs = "ab cdeé中🙂\n\t  'sll1234!?.,\x1c ß"
    draw = lambda n: "".join(rng.choice(signs) for _ in range(rng.randint(0, n)))
    for _ in range(400):
        text = draw(40)
        held = bpe.EncodedText(coder, text)
        for _ in range(3):
            i = rng.randint(0, len(text))
            j, new = rng.randint(i, min(len(text), i + 5)), draw(6)
            held.edit(i, j, new)
            text = text[:i] + new + text[j:]
            assert held.ids() == library.encode_ordinary(text) and coder.encode_joined(text) == ",".join(map(str, held.ids()))
        held.append("xyz")
        assert held.ids() == library.encode_ordinary(text + "xyz")
        assert coder.decode(held.ids()) == (text + "xyz").encode()
    long = "abc" * 20_000
    assert coder.encode(long) == library.encode_ordinary(long)


def test_bpe_cases(spark):
    import public_tokenizers

    run = lambda df: bpe.encode_documents(df, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)
    got = {r.doc_id: r.n_tokens for r in run(docs(spark, [None, "", "<|endoftext|>", " "])).collect()}
    assert got[0] == got[1] == 0 and got[2] > 1 and got[3] == 1 and run(empty(spark)).count() == 0


# Language identification


def test_langid_held_out(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(rows).join(rows.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 250 and right > 0.97


def test_langid_family_comes_first():
    """Machines of the families, then of the languages within each; a language wins only if its family has won."""
    texts = ["the house and the sea"] * 9 + ["das Haus und die See"] * 9 + ["la maison et la mer"] * 9 + ["la casa y el mar"] * 9
    langs = ["en"] * 9 + ["de"] * 9 + ["fr"] * 9 + ["es"] * 9
    model = langid.LanguageModel(texts, langs)
    assert set(model.pairs) == {("germanic", "romance"), ("de", "en"), ("es", "fr")}
    assert model.predict(["the house", "die See und das Haus", "la mer", "el mar y la casa", "12"])[0] == ["en", "de", "fr", "es", "und"]
    model.weights[:, model.pairs.index(("germanic", "romance"))] = -1.0  # romance always wins
    assert set(model.predict(texts)[0]) <= {"fr", "es"}
    votes = langid.LanguageModel([], [])._vote(["a", "b", "c"], {("a", "b"): np.array([1.0, -1.0]), ("a", "c"): np.array([2.0, 3.0]), ("b", "c"): np.array([1.0, 1.0])}, np.array([0, 1]))
    assert votes[0].tolist() == [0, 1] and votes[1].tolist() == [1.0, 1.0]


def test_langid_equals_plain_voting(spark):
    """Predictions of whole texts against loops over their n-grams and machines."""
    import unicodedata

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    model = langid.LanguageModel([r.text[:400] for r in rows[:120] if r.text], [r.lang or "xx" for r in rows[:120] if r.text])
    mix, mask = [int(x) for x in langid._MIX], (1 << 32) - 1

    def shares(text):
        codes, out = [], collections.Counter()
        for c in f" {text.lower()} ":
            c = ord(c) if unicodedata.category(c)[0] == "L" else 0
            if c or not codes or codes[-1]:
                codes.append(c)
        for a, b in zip(codes, codes[1:], strict=False):
            if a or b:
                out[((a * mix[0] + b * mix[1]) * mix[2] & mask) >> (32 - model.bits)] += 1
        for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
            if b:
                out[((a * mix[1] + b * mix[2] + c * mix[0] + 1) * mix[1] & mask) >> (32 - model.bits)] += 1
        return {k: n / sum(out.values()) for k, n in out.items()} if any(codes) else None

    def winner(names, x):
        votes = collections.Counter()
        for a, b in zip(*[iter(p for pair in model.pairs for p in pair)] * 2, strict=True):
            if a in names and b in names:
                m = sum(float(model.weights[k, model.pairs.index((a, b))]) * v for k, v in x.items())
                votes[a if m > 0 else b] += 1
                votes[a] += 1e-3 * np.tanh(m)
                votes[b] -= 1e-3 * np.tanh(m)
        return max(sorted(names), key=lambda n: votes[n])

    texts = [r.text or "" for r in rows] + ["", "12 !", "Zwei Häuser"]
    for text, got in zip(texts, model.predict(texts)[0], strict=True):
        x = shares(text)
        assert got == (langid.UNKNOWN if x is None else winner(model.families[winner(list(model.families), x)], x)), text[:80]


def test_langid_families_need_no_number_of_languages():
    """A language of no known family joins the nearest ones at any number of languages."""
    v = lambda *x: np.array(x) / np.linalg.norm(x)
    centres = {"xa": v(1, 0.1), "xb": v(1, 0.2), "xc": v(1, 0.3)}
    assert len(set(langid.other_families(["xa", "xb"], centres).values())) == 1 and len(set(langid.other_families(["xa", "xb", "xc"], centres).values())) == 1
    assert len(set(langid.other_families(["xa", "xb", "xc"], centres, members=2).values())) == 2


def test_langid_machines_grow_as_languages():
    rng = random.Random(15)
    codes = [f"x{a}{b}" for a in "abcdefghij" for b in "abcdef"]
    letters = {c: rng.sample("abcdefghijklmnopqrstuvwxyz", 8) for c in codes}
    texts, langs = zip(*[("".join(rng.choice(letters[c] + [" "]) for _ in range(60)), c) for c in codes for _ in range(3)], strict=True)
    model = langid.LanguageModel(list(texts), list(langs), bits=10)
    assert len(model.pairs) <= langid.MEMBERS * len(codes) / 2 + (len(codes) / langid.MEMBERS + 1) ** 2
    right = sum(a == b for a, b in zip(model.predict(list(texts))[0], langs, strict=True))
    assert right > 0.8 * len(texts)
    long = ["der Haus " * 300_000, "x"]
    assert len(langid.LanguageModel(["a b"], ["en"]).predict(long)[0]) == 2


def test_langid_cases(spark):
    texts = ["the house of the king and the sea"] * 20 + ["der König und das Haus über die Straße"] * 20 + ["le roi et la maison où il était"] * 20 + [None, "", "123 !?", "und das ist die Straße"]
    langs = ["en"] * 20 + ["de"] * 20 + ["fr"] * 20 + [None] * 4
    got = {r.doc_id: r for r in langid.identify(docs(spark, texts, langs=langs)).collect()}
    assert [got[i].lang_pred for i in (60, 61, 62, 63)] == ["und", "und", "und", "de"] and got[60].score == 0
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == 64
    assert {r.lang_pred for r in langid.identify(docs(spark, ["a", None])).collect()} <= {"en", "und"}
    assert langid.identify(docs(spark, ["a"], langs=[None])).first().lang_pred == "und"
    assert langid.identify(empty(spark)).count() == 0


# N-gram join


def sets_of(text, n):
    w = [x.encode().lower() for x in WORD.findall(text or "")]
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < n else frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def brute_components(texts, n, num, den):
    sets = {i: sets_of(t, n) for i, t in texts.items()}
    root = {i: i for i in texts}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_ngram_join(spark, documents, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(documents, 4, 85, 100).collect()}
    assert got == brute_components(texts, 4, 85, 100)


def test_ngram_join_variants(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(150):
        base = [words[(i % 5 + k * 7) % 60] for k in range(rng.choice([3, 4, 20, 40]))]
        for _ in range(rng.randint(0, 2)):
            base[rng.randrange(len(base))] = rng.choice(words)
        texts[i] = " ".join(base).upper() if i % 7 == 0 else "\t".join(base)
    texts |= {150: None, 151: "", 152: " \n", 153: "One two", 154: "one  TWO", 155: "É é"}
    ids = sorted(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(docs(spark, [texts[i] for i in ids]), 4, 85, 100).collect()}
    assert got == brute_components(texts, 4, 85, 100)
    assert ngram_join.ngram_components(empty(spark)).count() == 0
    kept = ngram_join.distinct_documents(docs(spark, [" ".join(words)] * 3 + ["other"]))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3] and kept.columns == DOCS.replace(",", "").split()[::2]


def near_copies(n, seed, length=70, most=9):
    """Texts with some words changed: many pairs lie just below the similarity asked for, and no text is the one they come from."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(length)]
    out = {}
    for i in range(n):
        words = list(base)
        for k in range(rng.randint(0, most)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[f"x{i}-{k}"], [], [rng.choice(base)], [f"y{rng.randrange(5)}", words[at]]])
        out[i] = " ".join(words)
    return out


def test_ngram_join_of_many_near_copies(spark):
    texts = near_copies(300, 11) | {1000 + i: t + " tail" for i, t in near_copies(60, 12, 24, 3).items()} | {2000 + i: "the same words " * 30 for i in range(40)}
    ids = sorted(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(docs(spark, [texts[i] for i in ids], ids=ids), 4, 85, 100).collect()}
    want = brute_components(texts, 4, 85, 100)
    assert got == want and 60 < len({c for _, c in want.values()}) < 300


def test_ngram_join_pairs_grow_with_the_group(spark, monkeypatch):
    """Pairs that are compared: a few for each near copy, and of all pairs of a group, few even where many lie just below the similarity."""
    seen = []
    for name in ("_verified", "_derived"):
        monkeypatch.setattr(ngram_join, name, lambda pairs, *a, f=getattr(ngram_join, name): (seen.append(pairs.count()), f(pairs, *a))[1])
    for n in (100, 400):
        seen.clear()
        texts = near_copies(n, 13, 90, 4)
        got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(docs(spark, list(texts.values())), 4, 85, 100).collect()}
        assert got == {i: c for i, (_, c) in brute_components(texts, 4, 85, 100).items()}
        assert sum(seen) <= 3 * n + n * n / 200, seen


def test_distinct_documents_cases(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = docs(spark, [text, text, text, "other words here", None, "", text, "only here"], ids=[3, 3, 5, 5, 6, 7, None, 8]).withColumn("first", F.lit(1)).withColumn("component_id", F.lit(2))
    got = ngram_join.distinct_documents(df)
    # Rows of one id stay or go together: one text of 5 is nobody's copy. Rows without id stay.
    assert got.columns == df.columns and sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == [(False, 3), (False, 3), (False, 5), (False, 5), (False, 6), (False, 7), (False, 8), (True, 0)]
    assert ngram_join.distinct_documents(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 560)]
    root = {x: x for u in links for x in u}
    for _ in range(400):
        for u, v in links:
            root[u] = root[v] = min(root[u], root[v])
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    alone = {u for u, v in links if u == v} - {x for u, v in links if u != v for x in (u, v)}
    assert got == {k: v for k, v in root.items() if k not in alone}


# Nearest neighbours


def test_ann_recall(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = collections.defaultdict(list)
    for r in ann.nearest(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    rows = df.toPandas()
    x, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        want = [i for i in np.lexsort((ids, -score.round(9))) if i != q][:20]
        mine = got[ids[q]]
        assert [r.rank for r in mine] == list(range(1, 21)) and all(abs(r.score - (x[np.flatnonzero(ids == r.vec_id)[0]] * x[q]).sum()) < 1e-12 for r in mine)
        hit, total = hit + len({ids[i] for i in want} & {r.vec_id for r in mine}), total + 20
    assert hit / total >= 0.9


def test_ann_cases(spark):
    v = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0, None]), (20, [0.5, 1.0]), (None, [1.0, 1.0]), (7, [1.0]), (8, [-1.0, -5.0])]
    got = ann.nearest(spark.createDataFrame(v, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 0.5), (0, 4, 8, -1.0), (20, 1, 1, 1.0), (20, 2, 2, 1.0), (20, 3, 0, 0.5), (20, 4, 8, -5.5)]
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    same = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(3000)], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in ann.nearest(same, every=3000).orderBy("rank").collect()] == list(range(1, 21))


# Chat


def test_chat_round_trip(spark):
    odd = ["### ", "</turn>", "<+>", "\\", "\\h", ": ", "a\n", "\\### Assistant: </turn> ok", "", None, "<", "</tur", "###"]
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "a: b", "sys\\", None]), "".join(rng.choice(odd) or "" for _ in range(3)) if rng.random() < 0.9 else None) for c in (1, 2, None) for t in range(150)]
    rows += [(9, None, "assistant", "z"), (9, 1, "assistant", "x"), (9, 1, "assistant", "x"), (9, 0, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = chat.collect_turns(df)
    made = chat.format_turns(turns)
    back = chat.parse_formatted(made).join(turns.withColumnRenamed("turns", "want"), made["conv_id"].eqNullSafe(turns["conv_id"]))
    assert back.where("turns = want").count() == 4 == back.count()
    runs = made.select(F.aggregate("loss_runs", F.lit(0), lambda a, r: a + r["chars"]).alias("n"), F.length("formatted").alias("m"))
    assert runs.where("n <> m").count() == 0
    nine = made.where("conv_id = 9").first().formatted
    assert nine == "### assistant: y<+>x<+>x<+>z</turn>\n"
    assert chat.digests(chat.format_turns(chat.collect_turns(df.limit(0)))).count() == 0


def test_chat_loss_is_read_through_the_mask(spark):
    rows = [(c, t, ["user", "assistant", "assistant", "sys"][(t + c) % 4], f"{t}\\### Assistant: </turn> ok <+> é🙂 \\h" * (t % 3)) for c in (1, 2) for t in range(700)]
    made = chat.format_turns(chat.collect_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = {r.conv_id: r for r in chat.digests(made).collect()}
    for c in (1, 2):
        loss = "".join(t for k, _, role, t in rows if k == c and role == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    # A mask that says otherwise is what counts.
    other = made.withColumn("loss_runs", F.transform("loss_runs", lambda r: r.withField("in_loss", F.lit(False))))
    assert {r.loss_chars for r in chat.digests(other).collect()} == {0}
    clash = spark.createDataFrame([(1, 0, "user", "x", 1, "y")], "conv_id long, turn long, role string, text string, turns int, formatted string")
    assert chat.digests(chat.format_turns(chat.collect_turns(clash))).first().formatted_chars == len("### user: x</turn>\n")


# URL filter


def test_url_rules(spark):
    cases = [
        ("https://WWW.Example.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"), ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        ("http://a.net/fr/1", "a.net", "/fr/1", "net/fr/", "block"), ("http://anet/fr/1", "anet", "/fr/1", None, "allow"), ("http://b.com", "b.com", "", None, "allow"), ("http://b.com/#x", "b.com", "/", "com/", "allow"),
        (None, "", "", None, "allow"), ("b.com/x", "", "", None, "allow"), ("x://É.com/a://b?c", "É.com", "/a://b", "com/", "allow"), ("http://net/es/", "net", "/es/", "net/es/", "block"), ("http://b.com?x=/en/", "b.com", "", None, "allow"),
    ]
    df = spark.createDataFrame([(i, c[0], "h", "p", "r") for i, c in enumerate(cases)], "page_id long, url string, host string, path string, rule string")
    got = url_filter.judge(df, []).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [c[1:] for c in cases]


def url_items(url):
    rest = url.split("://", 1)[1]
    host, path, query = re.match(r"([^/?#]*)([^?#]*)(?:\?([^#]*))?", rest).groups()
    out = {"h:" + x for x in host.lower().split(".") if x} | {"p:" + re.sub("[0-9]+", "#", x) for x in path.split("/") if x}
    return out | {"q:" + x.split("=")[0] for x in (query or "").split("&") if x.split("=")[0]}


def brute_rules(rows, min_urls, block, allow, sure, most):
    """Every rule by counting every set of items of every url."""
    import itertools

    held = [(url_items(u), b) for u, b in rows if u is not None and b is not None]
    n, count, hit = len(held), collections.Counter(), collections.Counter()
    for x, b in held:
        for k in range(1, most + 1):
            for s in itertools.combinations(sorted(x), k):
                count[s] += 1
                hit[s, b] += 1
    share, out = {b: sum(y == b for _, y in held) / n for b in (True, False)}, {}
    for (s, b), m in hit.items():
        c = m / count[s]
        if m >= max(min_urls, 0.002 * n) and c >= (block if b else allow) and c > share[b] and (c - share[b]) * count[s] ** 0.5 >= sure * (share[b] * (1 - share[b])) ** 0.5:
            out[s, b] = (c, m / n, c / share[b])
    return {k: v for k, v in out.items() if not any(b == k[1] and set(s) < set(k[0]) and w[0] >= v[0] for (s, b), w in out.items())}


def sets_looked_at(rows, min_urls, most):
    """How many sets of items, with either label, are frequent; items that only come together count as one."""
    import itertools

    held = [(url_items(u), b) for u, b in rows if u is not None and b is not None]
    where = collections.defaultdict(set)
    for k, (x, _) in enumerate(held):
        for i in x:
            where[i].add(k)
    first = {}
    for i in sorted(where):
        first.setdefault(frozenset(where[i]), i)
    count = collections.Counter()
    for x, b in held:
        for k in range(1, most + 1):
            count.update((s, b) for s in itertools.combinations(sorted({first[frozenset(where[i])] for i in x}), k))
    return sum(m >= max(min_urls, 0.002 * len(held)) for m in count.values())


def test_url_mining_equals_enumeration(spark):
    rng = random.Random(10)
    rows = []
    for i in range(600):
        host, bad = rng.choice(["a.org", "b.org", "c.net", "www.d.com"]), rng.random() < 0.2
        path = "/".join(rng.choice(["x", "y", "win", "read", str(i)]) for _ in range(rng.randint(0, 3)))
        rows.append((f"http://{host}/{path}" + rng.choice(["", "?ref=1", "?id=2&ref=3"]), bad or ("win" in path and rng.random() < 0.6)))
    rows += [(f"http://e.edu/{'y' * (i % 2)}", False) for i in range(150)]  # an allow rule that is no chance
    rows += [(None, True), ("http://x.org/", None)]
    rules = url_filter.mine_rules(spark.createDataFrame(rows, "url string, blocked boolean"))
    want = brute_rules(rows, 20, url_filter.BLOCK_CONFIDENCE, url_filter.ALLOW_CONFIDENCE, url_filter.least_deviations(sets_looked_at(rows, 20, url_filter.RULE_ITEMS)), url_filter.RULE_ITEMS)
    got = {(tuple(r["items"]), r["block"]): (r["confidence"], r["support"], r["lift"]) for r in url_filter.spelled_out(rules)}
    assert set(got) == set(want) and any(b for _, b in got) and any(not b for _, b in got)
    assert all(abs(x - y) < 1e-9 for k in got for x, y in zip(got[k], want[k], strict=True))
    urls = [u for u, _ in rows[:300]] + [None, "no url", "http://other.example/q?z"]
    judged = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules, listed=()).collect()
    verdicts = set()
    for r in judged:
        u = urls[r.page_id]
        hits = [(v[2], v[0], v[1], k[1]) for k, v in want.items() if u and "://" in u and set(k[0]) <= url_items(u)]
        assert r.verdict == ("block" if hits and max(hits)[3] else "allow"), u
        verdicts.add(r.verdict)
    assert verdicts == {"allow", "block"}


def test_url_mining_reads_long_urls_whole(spark):
    long = "/".join(f"s{i}" for i in range(3))
    rows = [(f"http://h{i}.org/a{i}/b{i}/c{i}/d{i}/e{i}/f{i}/g{i}/{long}/{'bad' if i % 4 == 0 else 'good'}?k{i}=1&last={i}", i % 4 == 0) for i in range(200)]
    rules = url_filter.mine_rules(spark.createDataFrame(rows, "url string, blocked boolean"))
    assert {tuple(r["items"]) for r in rules if r["block"]} == {("p:bad",)}


def test_url_mining_of_a_template(spark):
    """Thirty keys that come together are one item, and any of them stands for all."""
    keys = "&".join(f"k{i}=1" for i in range(30))
    rows = [(f"http://h{i % 7}.org/{'shop?' + keys if i % 2 else 'read'}", i % 2 == 1 and i % 10 > 1) for i in range(400)]
    rules = url_filter.mine_rules(spark.createDataFrame(rows, "url string, blocked boolean"))
    (group,) = {tuple(g) for r in rules if r["block"] for g in r["groups"].values()}  # several rules may name it
    assert len(group) == 31 and "q:k7" in group and "p:shop" in group
    urls = [f"http://x.org/a?k{i}=5" for i in range(30)] + ["http://x.org/read?z=1"]
    verdicts = [r.verdict for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules, listed=()).orderBy("page_id").collect()]
    assert verdicts == ["block"] * 30 + ["allow"]


def test_url_mining_of_shuffled_labels(spark):
    """Labels that have nothing to do with urls make next to no rules, however many sets are looked at."""
    made = []
    for seed in range(3):
        rng = random.Random(seed)
        rows = [("http://{}.org/{}/{}?{}=1&{}=2".format(*(rng.choice("abcdefgh") + str(k) * 2 for k in range(5))).replace("00", "x").replace("11", "y").replace("22", "z"), rng.random() < 0.35) for _ in range(1500)]
        made += url_filter.mine_rules(spark.createDataFrame(rows, "url string, blocked boolean"), allow_confidence=0.5)
    assert len(made) <= 1


def test_url_sample_is_drawn_by_row(spark):
    rows = spark.range(4000).select(F.col("id").alias("page_id"), F.lit("http://a.org/x").alias("url"), (F.col("id") % 2 == 0).alias("blocked"))
    got = [sorted(map(tuple, (r["items"] for r in url_filter.baskets(df, 1000).collect()))) for df in (rows, rows.repartition(7))]
    assert got[0] == got[1] and 800 < len(got[0]) < 1200


def test_url_cases(spark):
    none = spark.createDataFrame([], "url string, blocked boolean")
    assert url_filter.mine_rules(none) == []
    pages = spark.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/"), (None, None)], "page_id long, url string")
    pages = pages.withColumns({c: F.lit("x") for c in ("host", "path", "rule", "verdict", "tokens", "hit")})
    got = url_filter.judge(pages, []).collect()
    assert sorted((r.page_id or 0, r.host, r.verdict) for r in got) == [(0, "", "allow"), (1, "a.org", "allow"), (1, "a.org", "allow")]
    assert url_filter.judge(pages.limit(0), []).count() == 0


# Line dedup


def brute_lines(texts):
    seen, sets, out = {}, [], {}
    for i in sorted(texts):
        keep = []
        for line in (texts[i] or "").split("\n"):
            w = WORD.findall(line)
            if not w:
                keep.append(line)
                continue
            s = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
            gone = line in seen or any(100 * len(s & z) >= 80 * len(s | z) for z in sets)
            if line not in seen:
                sets.append(s)
            seen[line] = True
            if not gone:
                keep.append(line)
        out[i] = "\n".join(keep)
    return out


def test_line_dedup(spark, documents, texts):
    some = {i: texts[i] for i in sorted(texts)[:120]}
    got = {r.doc_id: r.text for r in line_dedup.clean_documents(documents.where(F.col("doc_id").isin(list(some)))).collect()}
    assert got == brute_lines(some)


def test_line_dedup_cases(spark):
    rng = random.Random(6)
    words = [f"v{i}" for i in range(30)]
    lines = []
    for _ in range(60):
        base = [words[(k * 3) % 30] for k in range(rng.choice([4, 5, 12, 24]))]
        if rng.random() < 0.5:
            base[rng.randrange(len(base))] = rng.choice(words)
        lines.append((" " if rng.random() < 0.7 else "  \t").join(base))
    texts = {i: "\n".join(rng.choices(lines, k=4)) for i in range(40)} | {40: None, 41: "", 42: "\n\n", 43: "a b c d\na b c d"}
    df = docs(spark, [texts[i] for i in sorted(texts)])
    got = line_dedup.clean_documents(df)
    assert {r.doc_id: r.text or "" for r in got.collect()} == brute_lines(texts) and got.columns == df.columns
    twice = docs(spark, ["one two three four five six", "one two three four five six"], ids=[None, 3])
    assert [r.text for r in line_dedup.clean_documents(twice).collect()] == ["one two three four five six"] * 2
    assert line_dedup.clean_documents(empty(spark)).count() == 0


def test_line_dedup_of_a_template(spark):
    """Many variants of one line, copies of one line in most documents, and clashing columns."""
    rng = random.Random(9)
    base = [f"t{i}" for i in range(34)]
    variant = lambda i: " ".join(w if rng.random() > 0.04 else f"x{i}" for w in base)
    texts = {i: "\n".join([variant(i), "a footer that all documents have in common", f"only {i} has this line of words", "Menu"]) for i in range(250)}
    df = docs(spark, [texts[i] for i in sorted(texts)]).withColumns({c: F.lit(1) for c in ("no", "gone", "lines", "key", "nos", "k1")})
    got = line_dedup.clean_documents(df)
    assert {r.doc_id: r.text for r in got.collect()} == brute_lines(texts) and got.columns == df.columns
    again = line_dedup.clean_documents(docs(spark, ["a b\nc d", "c d\na b", "a b\nx y"], ids=[1, 1, 2]))
    # Rows of one id are judged together: where both have a line at one place, an equal line elsewhere in them goes.
    assert sorted((r.doc_id, r.text) for r in again.collect())[-1] == (2, "x y")


def test_line_tokens_are_sorted_as_longs(spark):
    rows = spark.sql("select 'a b c d e f g a b c d e f' as line union all select 'x y'")
    made = line_dedup.with_tokens(line_dedup._words(rows), line_dedup.rarity_table(line_dedup._words(rows)))
    assert not made.schema["tokens"].dataType.containsNull
    for (tokens,) in made.collect():
        assert tokens == sorted(set(tokens))


def test_line_dedup_short_lines(spark):
    texts = {
        1: "one two three four five six seven eight nine ten\nLes.\nand so on\nÀ la une", 2: " Les. \nand  so\ton\nand so\n和平\n \n",
        3: "和平\nLes.\nA la une\n\n \nLes. Les.", 4: "one  two three four five six seven eight nine ten\none two three four\none two three four five",
    }
    want = {1: texts[1], 2: "and so\n和平\n \n", 3: "A la une\n\n \nLes. Les.", 4: "one two three four\none two three four five"}
    got = line_dedup.clean_documents(docs(spark, list(texts.values()), ids=list(texts)))
    assert {r.doc_id: r.text for r in got.collect()} == want


# Mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        open_w = sum(w[s] for s in order if s not in full)
        t = {s: 2 * sizes[s] if s in full else left * w[s] / open_w for s in order}
        over = {s for s in order if s not in full and t[s] > 2 * sizes[s]}
        if not over:
            return t
        full |= over


def test_mixing(spark, documents):
    got = mixing.mix(documents, block=64).join(documents.select("doc_id", "source", "text"), "doc_id").collect()
    sizes = collections.Counter()
    for r in got:
        assert r.size == len(WORD.findall(r.text)) and 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
    want, taken = brute_targets(sizes), collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = {(r.doc_id, r.taken) for r in mixing.mix(documents, block=64).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}
    mixed = mixing.mixed_documents(documents, block=64)
    words = mixed.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(WORD.pattern))).alias("n")).collect()
    assert {(r.doc_id, r.n) for r in words} == {(r.doc_id, r.taken) for r in got if r.taken}


def long_hash(seed, *values):
    """As Spark hashes longs and strings, one after another."""
    import struct

    import xxhash

    h = 42
    for v in (seed, *values):
        h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v) if v >= 2**31 or v is not seed else struct.pack("<i", v), h)
    return h


def test_mixing_draw(spark):
    rows = [("sa", 9000, 9000.0), ("sb", 3000, 4100.0), ("sc", 500, 1.0), ("n", 40_000, 23_456.0)]
    plan = mixing.slot_plan(spark.createDataFrame(rows, "skey string, source_size long, target double"), 8)
    slots = {r.skey: r.slots for r in plan.collect()}
    total, low, line = sum(slots.values()), 0.0, []
    for k in sorted(slots):
        line.append((k, low, low := low + slots[k] / total))
    want = collections.Counter()
    for i in range(total):
        x = (long_hash(mixing.SEED, "draw", i // 64, i % 64) >> 11) / 2**53
        want[i // 64, next((k for k, a, b in line if a <= x < b), line[-1][0])] += 1
    assert {(r.shard, r.skey): r.drawn for r in mixing.drawn_counts(plan, 64).collect()} == dict(want)
    counts = mixing.shard_counts(plan, 64)
    by = collections.defaultdict(list)
    for r in counts.collect():
        by[r.skey].append((r.shard, r.first, r.blocks))
    for k, n in slots.items():
        at, drawn, all_drawn = 0, 0, sum(v for (_, s), v in want.items() if s == k)
        assert abs(all_drawn - n) < 5 * n**0.5 + 1
        for shard, first, blocks in sorted(by[k]):
            assert first == at
            at += blocks
            if all_drawn:
                drawn = sum(v for (i, s), v in want.items() if s == k and i <= shard)
                assert abs(at - drawn * n / all_drawn) <= 1
        assert at == n
    # The slots in all shards are each source's, one after another, and a shard has as many of each as it was dealt.
    made = mixing.mix_slots(plan, counts.withColumnRenamed("blocks", "blocks_drawn"), 8).collect()
    assert collections.Counter((r.shard, r.skey) for r in made) == {(i, k): n for k in by for i, _, n in by[k]}
    for k, n in slots.items():
        assert sorted(r.slot for r in made if r.skey == k) == list(range(n))
        epoch = [r.block for r in made if r.skey == k and r.epoch == 0]
        assert len(set(epoch)) == len(epoch)
    assert sum(r.words for r in made if r.skey == "n") == 23_456


def test_mixing_is_planned_in_parts(spark, documents):
    plan = mixing.mixed_documents(documents)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 8 and plan.count("Aggregate") <= 6


def test_mixing_uses_the_draw(spark, documents):
    plan = mixing.mix(documents, block=64)._jdf.queryExecution().optimizedPlan().toString()
    assert "shard" in plan and "draw" in plan
    got = mixing.mix(documents, block=64, shard_slots=64).collect()
    assert max(r.shards for r in got) > 1 and all((r.shards > 0) == (r.taken > 0) for r in got)


def test_mixing_of_equal_ids(spark):
    df = docs(spark, ["a b c", "d e", "d e", None, "f g h i"], sources=["b"] * 5, ids=[None, None, None, None, 1]).withColumn("spans", F.lit(1)).withColumn("row", F.lit(2))
    got = mixing.mixed_documents(df, block=2)
    assert got.columns == df.columns
    words = collections.Counter(w for r in got.collect() for w in r.text.split())
    assert sum(words.values()) in (16, 17) and all(words[w] <= (4 if w in "de" else 2) for w in words)


def test_mixing_cases(spark):
    df = docs(spark, ["a b c", None, "", " ", "x " * 500, "y", "y", "z z"], sources=["b", "a", None, "c", None, "b", "b", "é"], ids=[1, 2, 3, 4, None, 6, 6, 7])
    got = mixing.mix(df, block=8).collect()
    assert len(got) == 8 and all(r.taken <= 2 * r.size for r in got) and sum(r.size for r in got) == 507
    want = brute_targets({"b": 5, "a": 0, None: 500, "c": 0, "é": 2})
    assert {round(r.target, 6) for r in got if r.size == 500} == {round(want[None], 6)}
    assert abs(sum(r.taken for r in got if r.size == 500) - want[None]) <= 1
    assert mixing.mix(docs(spark, [None, ""])).agg(F.sum("taken"), F.sum("target")).first()[:] == (0, 0.0)
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed_documents(empty(spark)).columns == df.columns
    for n in (1, 2, 7, 100):
        at = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("k")).alias("x")).collect()
        assert sorted(r.x for r in at) == list(range(n))


# Secrets


def test_secrets_held_out(spark):
    words = [f"{a}{b}" for a in ("sta", "mor", "len", "pri", "ton") for b in ("der", "ing", "able", "ment", "sel")]
    lexicon, findings = secrets.Lexicon(collections.Counter(dict.fromkeys(words, 9))), secrets.example_findings(words, 1500, seed=1)
    context = secrets.Context(findings)
    model = secrets.train(spark, findings, lexicon, context)
    from pyspark.ml.functions import array_to_vector

    rows = [(secrets.features(t, a, b, p, lexicon, context), float(s)) for t, a, b, p, s in secrets.example_findings(words, 600, seed=2)]
    out = model.transform(spark.createDataFrame(rows, "f array<double>, label double").select(array_to_vector("f").alias("features"), "label"))
    assert out.select(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0] > 0.95


def test_secrets(spark):
    key = hashlib.sha1(b"x").hexdigest()
    text = f'the house token = "{key}" and commit {key} of example.com/some/path/to/page1.html'
    got = secrets.scan(docs(spark, [text, None, "", text.upper(), "plain words only " * 2000])).orderBy("doc_id", "start").collect()
    assert all(text[r.start : r.start + r.length] for r in got if r.doc_id == 0) and {r.doc_id for r in got} == {0, 3}
    by = {(r.doc_id, r.start): r for r in got}
    assert by[0, text.index(key)].secret and not by[0, text.rindex(key)].secret
    assert by[0, text.index(key)].value_sha256 == hashlib.sha256(key.encode()).hexdigest()
    assert secrets.scan(empty(spark)).count() == 0


def test_secrets_learns_words_and_paths_from_findings(spark):
    """Findings of other words and paths than the made ones: what speaks for a secret is learned, not listed."""
    rng = random.Random(12)

    def made(n):
        out = []
        for _ in range(n):
            secret, key = rng.random() < 0.5, "".join(rng.choice("0123456789abcdef") for _ in range(40))
            by_path = rng.random() < 0.5
            before = f"la phrase {'sesame' if by_path or secret else 'empreinte'} = "
            path = ("prive/serveur" if secret else "exemples/serveur") if by_path else "notes"
            out.append((before + key + " fin", len(before), len(before) + 40, path, secret))
        return out

    findings = made(800)
    context = secrets.Context(findings)
    assert context.words["=sesame"] > 0 > context.words["=empreinte"] and context.parts["prive"] > 1 > -1 > context.parts["exemples"]
    rows = made(200)
    table = spark.createDataFrame([(i, t, p) for i, (t, _, _, p, _) in enumerate(rows)], "doc_id long, text string, source string")
    got = {r.doc_id: r.secret for r in secrets.scan(table, findings).collect()}
    assert sum(got[i] == r[4] for i, r in enumerate(rows)) >= 190


def test_secrets_planted_in_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in rows.select("doc_id", "text").collect()}
    planted = {(i, m.start(1)) for i, t in texts.items() for m in re.finditer(r"""token = "([0-9a-f]{40})\"""", t)}
    found = secrets.scan(rows).collect()
    flagged = {(r.doc_id, r.start) for r in found if r.secret}
    assert planted and len(planted & flagged) >= 0.95 * len(planted) and len(flagged - planted) <= 0.1 * len(planted) + 1, (len(planted), len(flagged), flagged - planted)


def test_secrets_after_an_observation(spark):
    """A session that has observed something, and one that has cleaned lines, still sends the forest to its tasks."""
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(5).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 5 and line_dedup.clean_documents(docs(spark, ["a b", "a b"])).count() == 2
    key = hashlib.sha1(b"z").hexdigest()
    assert [r.secret for r in secrets.scan(docs(spark, [f'token = "{key}"'])).collect()] == [True]


def test_secrets_equals_judging_one_by_one(spark):
    """Places, digests and scores against a loop over the texts, with a forest walked in Python."""
    words = [f"{a}{b}" for a in ("sta", "mor", "len") for b in ("der", "ing", "able")]
    findings = secrets.example_findings(words, 400, seed=3)
    texts = [f[0] for f in secrets.example_findings(words, 60, seed=4)] + [None, "", "no candidates here"]
    df = docs(spark, texts, sources=["src/app"] * len(texts))
    lexicon, context = secrets.learn_lexicon(df, "text"), secrets.Context(findings)
    model = secrets.train(spark, findings, lexicon, context)
    assert not model.hasSummary
    want = []
    for i, t in enumerate(texts):
        for a, b in secrets.candidates(t or ""):
            p = model.predictProbability(__import__("pyspark.ml.linalg", fromlist=["Vectors"]).Vectors.dense(secrets.features(t, a, b, "src/app", lexicon, context)))[1]
            want.append((i, a, b - a, hashlib.sha256(t[a:b].encode()).hexdigest(), round(float(p), 9), bool(p >= 0.5)))
    got = [(r.doc_id, r.start, r.length, r.value_sha256, round(r.score, 9), r.secret) for r in secrets.scan(df, findings).collect()]
    assert sorted(got) == sorted(want) and {x[-1] for x in got} == {True, False}


def test_secrets_cases(spark):
    key = hashlib.sha1(b"y").hexdigest()
    df = docs(spark, [f'token = "{key}"'] * 3 + [f'token = "{key}"'], ids=[1, 1, None, 2]).withColumns({c: F.lit("x") for c in ("path", "f", "features", "secret", "start")})
    got = secrets.scan(df).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 1, 2] and len({r.value_sha256 for r in got}) == 1


def test_secrets_of_any_length(spark):
    rng = random.Random(8)
    draw = lambda k: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(k))
    jwt, key, one, tail = ".".join(draw(k) for k in (40, 700, 90)), draw(1600) + "==", draw(40), draw(44)
    text = f'Bearer {jwt} and private_key = "{key}" or {"a.b/c" * 120}={tail} with password = "hunter7x" then pwd=k9Lm2 and x/{one}={tail}. Done: no'
    places = secrets.candidates(text)
    found = [text[a:b] for a, b in places]
    assert {jwt, key, tail, "hunter7x", "k9Lm2", "x/" + one} <= set(found) and found.count(tail) == 2 and len(set(a for a, _ in places)) == len(places)
    got = {text[r.start : r.start + r.length]: r.secret for r in secrets.scan(docs(spark, [text, "plain words: " + "only " * 300])).where("doc_id = 0").collect()}
    assert got[jwt] and got[key] and got[tail] and got["hunter7x"]


def test_secrets_dictionary_of_all_documents(spark):
    rows = spark.range(6000).selectExpr("id as doc_id", "case when id % 1500 = 7 then 'seltenwort' else 'common words here' end as text")
    assert secrets.learn_lexicon(rows, "text").words == {"seltenwort", "common", "words", "here"}


# The registered queries


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_oracle(name, spark, sf_dir):
    db = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "benchmark"):
        path = f"{sf_dir}/{t}.parquet"
        db.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    df = registry.QUERIES[name](spark, sf_dir)
    want = db.sql(registry.ORACLE_SQL[name])
    order = lambda names, rows: sorted([[str(r[names.index(n)]) for n in sorted(names)] for r in rows])
    assert sorted(df.columns) == sorted(want.columns) and order(df.columns, df.collect()) == order(want.columns, want.fetchall())


def test_registered():
    assert sorted(n.split("_")[0] for n in registry.QUERIES if n != "pipeline") == sorted(f"op{i}" for i in range(1, 14)) and "pipeline" in registry.QUERIES
