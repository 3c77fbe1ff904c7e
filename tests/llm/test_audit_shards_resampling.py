"""Filter audit, sharding and importance resampling against brute force, and their defined cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siltstone.llm import filter_audit, importance, sharding

DOCS = "doc_id long, text string, lang string, part string, good int, digest string, _at int, shard string, slot int, words int, score int, rank int, _order int"


def docs(spark, rows):
    """Documents of (doc_id, text, lang), with columns of names that the operators use."""
    return spark.createDataFrame([(*r, "x", 7, "x", 1, "x", 1, 1, 1, 1, 1) for r in rows], DOCS)


# Filter audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_audit(rows, labels):
    """Every order run over every document."""
    good, toxic = ({i for i, *marks in labels if marks[k] == 1 and i is not None} for k in (0, 1))
    first, judged = {}, []
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t],
        }
        judged.append((lang or "", fails, i in good, i in toxic))
    out, total = {}, collections.Counter()
    for part in {p for p, *_ in judged}:
        mine = [j[1:] for j in judged if j[0] == part]
        for order in itertools.permutations("ABCDE"):
            left, gone = mine, []
            for step, f in enumerate(order, 1):
                lost, left = [d for d in left if d[0][f]], [d for d in left if not d[0][f]]
                only = sum(d[0][f] and sum(d[0].values()) == 1 for d in mine)
                out[part, "".join(order), step] = [len(left), len(lost), sum(d[0][f] for d in gone), only, sum(d[1] for d in lost), sum(d[2] for d in lost)]
                total[part, f] += len(lost)
                gone = gone + lost
    return {(p, o, s): (*x, total[p, o[s - 1]]) for (p, o, s), x in out.items()}


def audited(df, labels):
    rows = filter_audit.audit(filter_audit.failures(df, labels)).collect()
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}


def test_audit_equals_every_order(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["UPPER", "SHOUT"] * 20 + ["a#b"]
    made = [" ".join(rng.choice(words[: rng.choice([5, 150, 441])]) for _ in range(rng.choice([3, 99, 100, 101, 300]))) for _ in range(60)]
    rows = [(i, rng.choice(made + [None, "", "A", "É" * 9 + "A"]), rng.choice(["en", "fr", None, ""])) for i in range(150)]
    rows += [(None, made[0], "en"), (None, made[0], "en"), (3, rows[3][1], "fr"), (3, rows[3][1], "fr"), (1000, "word " * 200_000, "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 170, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    got = audited(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got == brute_audit(rows, labels)


def test_audit_sets_and_shares(spark):
    """Survivors, exact failures and Shapley values of joint failures, and the shares of the dividends as the mean over orders."""
    rng = np.random.default_rng(4)
    fails = rng.integers(0, 8, 200)
    joint = np.array([sum(f & m == m for f in fails) for m in range(8)])
    assert filter_audit._inverted(joint, False).tolist() == [int(sum(f & m == 0 for f in fails)) for m in range(8)]
    assert filter_audit._inverted(joint, True).tolist() == [int(sum(f == m for f in fails)) for m in range(8)]
    want = np.zeros(3, int)
    for order in itertools.permutations(range(3)):
        before = 0
        for f in order:
            want[f] += sum(x & before == 0 and x >> f & 1 for x in fails)
            before |= 1 << f
    assert filter_audit.shapley(joint).tolist() == want.tolist() and want.sum() == 6 * sum(fails > 0)


def test_audit_of_one_text(spark):
    """A third and more of all rows are one text: the joins meet rows by digest and id, and all but the first row fail E."""
    df = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 > 0 then 'same text' else concat('text ', id) end as text", "'en' as lang")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = audited(df, none)
    assert got["en", "EABCD", 1][:2] == (1001, 1999) and got["en", "ABCDE", 1][:2] == (0, 3000)
    assert audited(docs(spark, []), none) == {}


# Sharding


def xx(*parts):
    """Spark's xxhash64 of longs, ints and strings."""
    h = 42
    for kind, x in parts:
        h = xxhash.xxh64_intdigest(x.encode() if kind == "s" else struct.pack("<q" if kind == "q" else "<i", x), h)
    return h - (1 << 64) if h >> 63 else h


def swapped(x, n, *key):
    for i in range(1, 25):
        other = (xx(*key, ("i", i)) % n - x + n) % n
        if xx(*key, ("i", i), ("q", max(x, other))) % 2 == 1:
            x = other
    return x


def brute_shards(parts, shards, seed):
    """A list of each partition's rows to (row, shard, slot), one after another."""
    total = sum(map(len, parts.values()))
    room = [total // shards + (s < total % shards) for s in range(shards)]
    groups = sorted({p // sharding.GROUP for p in parts})
    sent = sharding.matrix([sum(len(parts[p]) for p in parts if p // sharding.GROUP == g) for g in groups], room, f"{seed}")
    come, out = [0] * shards, []
    for k, g in enumerate(groups):
        mine = sorted(p for p in parts if p // sharding.GROUP == g)
        rows = sharding.matrix([len(parts[p]) for p in mine], sent[k].tolist(), f"{seed} {g}")
        for p, counts in zip(mine, rows, strict=True):
            for at, row in enumerate(parts[p]):
                rank = swapped(at, len(parts[p]), ("i", seed), ("s", "send"), ("q", p))
                s = int(np.searchsorted(np.cumsum(counts), rank, side="right"))
                there = come[s] + rank - int(counts[:s].sum())
                out.append((row, s, swapped(there, room[s], ("i", seed), ("s", "receive"), ("i", s))))
            come = [c + int(n) for c, n in zip(come, counts, strict=True)]
    return sorted(out)


@pytest.mark.parametrize("shards", [1, 2, 7, 8])
def test_shards_equal_the_sequential_draw(spark, shards):
    rows = spark.range(0, 500, 1, 5).where("id % 11 < 9 and (id < 200 or id >= 300)").withColumn("x", F.col("id") * 2)
    parts = collections.defaultdict(list)
    for r in rows.select(F.spark_partition_id().alias("p"), "id").collect():
        parts[r.p].append(r.id)
    got = sorted((r.id, r.shard, r.slot) for r in sharding.shuffled(rows, shards, 9).collect())
    assert got == brute_shards(parts, shards, 9)
    assert [sorted(t for _, s, t in got if s == k) for k in range(shards)] == [list(range(n)) for n in sharding.shard_sizes(len(got), shards)]


def test_counts_are_hypergeometric():
    good, bad, drawn = 7, 9, 6
    p = [math.comb(good, k) * math.comb(bad, drawn - k) / math.comb(16, drawn) for k in range(7)]
    for k, edge in enumerate(np.cumsum(p)[:-1]):
        assert sharding.hypergeometric(good, bad, drawn, edge - 1e-9) == k and sharding.hypergeometric(good, bad, drawn, edge + 1e-9) == k + 1
    assert sharding.hypergeometric(0, 5, 3, 0.5) == 0 and sharding.hypergeometric(5, 0, 3, 0.5) == 3 and sharding.hypergeometric(4, 4, 8, 0.1) == 4
    big = [sharding.hypergeometric(10**12, 7 * 10**12, 10**9, u) for u in (0.5, 0.8413447460685429)]
    assert abs(big[0] - 125_000_000) < 10 and abs(big[1] - big[0] - math.sqrt(1e9 * 7 / 64)) < 10
    for seed in range(5):
        m = sharding.matrix([5, 0, 40, 17], [20, 21, 21], str(seed))
        assert m.sum(0).tolist() == [20, 21, 21] and m.sum(1).tolist() == [5, 0, 40, 17] and (m >= 0).all()


def test_shuffle_is_uniform():
    """Over many seeds each row is in each slot of each shard about equally often, and so are pairs of rows."""
    parts, shards, runs = {0: [0, 1, 2], 1: [3, 4]}, 2, 4000
    place, pairs = collections.Counter(), collections.Counter()
    for seed in range(runs):
        at = {row: (s, t) for row, s, t in brute_shards(parts, shards, seed)}
        place.update(at.items())
        pairs.update([(a, b) for a, b in itertools.permutations(range(5), 2) if at[a][0] == at[b][0] == 0 and at[a][1] < at[b][1]])
    chi = lambda c, cells: sum((x - sum(c.values()) / cells) ** 2 / (sum(c.values()) / cells) for x in c.values())
    assert len(place) == 25 and chi(place, 25) < 16 + 5 * math.sqrt(32)
    assert len(pairs) == 20 and chi(pairs, 20) < 19 + 5 * math.sqrt(38) + 20  # three pairs a run, which depend on each other


def test_shards_of_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in rows.collect()}
    got = sharding.op12(spark, sf_dir).collect()
    n = collections.Counter(r.shard for r in got)
    assert len(got) == len(texts) and max(n.values()) - min(n.values()) <= 1 and set(n) == set(range(8))
    for s in n:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n[s]))
    for r in got:
        b = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 1, zlib.crc32(b), "rows", None)


def test_shards_cases(spark, tmp_path):
    same = docs(spark, [(1, None, "en")] * 40 + [(None, "é", "en")] * 20 + [(None, "", None), (2, "x" * 3_000_000, "fr")])
    got = sharding.shuffled(sharding.measured(same)).collect()
    assert {(r.size, r.text_crc32) for r in got} == {(1, 0), (3, zlib.crc32("é".encode())), (3_000_001, zlib.crc32(b"x" * 3_000_000))}
    assert sorted(collections.Counter(r.shard for r in got).values()) == [7, 7, 8, 8, 8, 8, 8, 8]
    few = sharding.shuffled(docs(spark, [(1, "a", "en"), (2, "b", "en")]), shards=5, shard_col="s", slot_col="t")
    assert few.columns == [*(c.split()[0] for c in DOCS.split(", ")), "s", "t"] and sorted((r.s, r.t) for r in few.collect()) == [(0, 0), (1, 0)]
    assert sharding.shuffled(sharding.measured(docs(spark, []))).count() == 0
    rows = spark.range(100).withColumn("text", F.concat(F.lit("t"), "id"))
    sharding.write_shards(rows, str(tmp_path / "shards"), shards=3, seed=5)
    back = spark.read.parquet(str(tmp_path / "shards")).collect()
    assert sorted((r.id, r.shard, r.slot) for r in back) == sorted((r.id, r.shard, r.slot) for r in sharding.shuffled(rows, 3, 5).collect())
    assert sorted(p.name for p in (tmp_path / "shards").glob("shard=*")) == ["shard=0", "shard=1", "shard=2"]


# Importance resampling

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    w = PLAIN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_resample(rows, target, buckets, percent, fewest):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (collections.Counter(bucket(g) for x in texts for g in runs(x)[1]) for texts in ([r[1] for r in rows], target))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets))))
    out = []
    for i, text in rows:
        n, grams = runs(text)
        weight = sum(gain(bucket(g)) for g in grams)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= fewest), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    return out, drawn


@pytest.mark.parametrize("buckets", [7, 10_000])
def test_resampling_equals_counting(spark, buckets):
    rng = random.Random(6)
    words = ["the", "House", "naïve", "ÉTÉ", "x1", "a-b", "c'd", "42", "日本 語", "tab\tbed", "Ω", " "]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 19, 20, 60])))) for i in range(200)]
    rows += [(500, None), (501, "--- ..."), (502, "word " * 300_000), (503, rows[0][1]), (503, rows[0][1]), (None, " ".join(words * 3))]
    target = [None, "", "the House x1", " ".join(words * 5)]
    df = docs(spark, [(i, t, "en") for i, t in rows]).repartition(5)
    got = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent=30, buckets=buckets).collect()
    every, drawn = brute_resample(rows, target, buckets, 30, 20)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got), key=key) == sorted(every, key=key)
    by_rank = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in by_rank] == list(range(1, len(drawn) + 1)) and [r.doc_id for r in by_rank] == [r[0] for r in drawn]


def test_resampling_ties_go_to_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(importance, "noise", lambda doc_id, seed=42: 0)
    df = spark.range(0, 400, 1, 7).select(F.col("id").alias("doc_id"), F.lit("a b c " * 10).alias("text"))
    rows = importance.resample(df, df.limit(3), percent=10).where("rank is not null").collect()
    assert sorted((r["rank"], r.doc_id) for r in rows) == [(k + 1, k) for k in range(40)]


def test_resampling_cases(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = docs(spark, [(1, "one two three " * 10, "en")])
    assert importance.resample(none, some).collect() == []
    row = importance.resample(some, none, percent=100).first()
    assert row.n_features == 87 and row["rank"] == 1 and row.weight < 0
    assert importance.resampled_documents(some, none, percent=100).columns == some.columns
    assert importance.resampled_documents(some, none, percent=100).count() == 1 and importance.resampled_documents(some, none, percent=1).count() == 0
    with pytest.raises(ValueError):
        importance.packed(some, buckets=1 << 17)


def test_streams_hold_all_features(spark):
    texts = ["a b c d", "", "Z", "a b"]
    rows = importance.packed(docs(spark, [(i, t, "en") for i, t in enumerate(texts)]).coalesce(1)).collect()
    for r in rows:
        stream, begin = np.frombuffer(r.stream, "<u2"), 0
        for i, n, end in zip(r.doc_id, r.words, r.ends, strict=True):
            assert n == runs(texts[i])[0] and stream[begin:end].tolist() == [zlib.crc32(g.encode()) % 10_000 for g in runs(texts[i])[1]]
            begin = end
        assert begin == len(stream)
    assert sorted(i for r in rows for i in r.doc_id) == [0, 1, 2, 3]
