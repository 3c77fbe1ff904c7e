"""Exact similarity join of documents by the Jaccard similarity of their word n-gram sets.

The join uses relations between sets twice. In the index, a hash's list is kept in blocks by set size;
a set's size and its position in the list say which sizes a partner can have, so that it reads a few
blocks and skips the others, and of those it reads, the ones whose best entry cannot reach it. Among
the sets, answers are taken over: in rounds, each block compares all its sets with a leader; a set
similar to one shares its component, and no pair within one component is looked at again. What stays
apart when a round finds nothing more, pairs of different components in lists with several, is looked
up completely; pairs that the sets' bit sketches leave are decided by their differences from a common
leader, whose overlap with both is known.

How it runs:

1. Each document's n-gram hashes are formed in numpy and sent, as sorted byte blocks, to parts of the
   hash space, where hashes are counted over all documents; what several documents of a chunk have is
   sent once with its count. Hashes that one document alone has are dropped there: they lie in no
   intersection. The rest return with their frequency.
2. A set's prefix are its rarest hashes, so many that two similar sets share one of them. Sets whose
   prefix is made of hashes of their own have no partner, and are done.
3. Sets equal to another are represented by one of them; then the two steps above, and components.

The hash keeps 48 bits and the part's number, at least 54 bits, and verification counts hashes: the
result is exact but for texts whose n-grams collide in them.

Defined cases: a document without words, or null, has an empty set and is linked with nothing; one with
fewer words than n has its whole word sequence as its only n-gram; repeated rows are linked like
others; a row without id takes the component of its text, null if no other has an id; an empty table
gives an empty result; other columns are ignored, whatever their names. ``distinct_documents`` keeps
rows without id, keeps the columns, and keeps or drops all rows of one id together: they go if each of
them is in a group with a smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, prepare, table
from .components import components

#: Hashes and documents of a chunk, hashes that one part of the hash space should get, words whose hashes a worker keeps.
CHUNK_HASHES, CHUNK_DOCS, PART_HASHES, KEPT_WORDS = 1 << 19, 1 << 14, 1_500_000, 400_000
#: So many documents of a chunk with one hash, or more, stand under it together.
TOGETHER = 4
#: Rounds of leaders at most, after which all pairs that are left are looked up; size classes of a list are so wide.
MOST_ROUNDS, CLASS = 8, 1.02
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def shingle_set(text: str | None, n: int, hashes: dict) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(n, len(h))
    total = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        part = h[k : len(h) - n + 1 + k] + np.uint64(k + 1)
        total = (total ^ (part * _ODD[k % 4])) * _ODD[0]
        total ^= total >> np.uint64(29)
    return np.unique(total)


_BLOCK = "part int, chunk long, blob binary"


def _send(n: int, bits: int):
    """Documents to byte blocks: for each chunk and part the hashes and how many of them each document has; and a head."""

    def run(batches):
        hashes, base, number = _WordHashes(), TaskContext.get().partitionId() << 20, 0
        ids, sets, total = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                s = shingle_set(t.as_py(), n, hashes)
                ids.append(i)
                sets.append(s)
                total += len(s)
                if total >= CHUNK_HASHES or len(ids) >= CHUNK_DOCS:
                    yield from _chunk(base + number, ids, sets, bits)
                    number, ids, sets, total = number + 1, [], [], 0
        if ids:
            yield from _chunk(base + number, ids, sets, bits)

    return run


def _bytes(*arrays: np.ndarray) -> bytes:
    """Arrays with their lengths before them; ``_arrays`` reads them back."""
    return b"".join([np.array([len(a) for a in arrays], np.int64).tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def _arrays(blob: bytes, *kinds) -> list[np.ndarray]:
    at, out = 8 * len(kinds), []
    for size, kind in zip(np.frombuffer(blob, np.int64, len(kinds)), kinds, strict=True):
        out.append(np.frombuffer(blob, kind, size, at))
        at += size * np.dtype(kind).itemsize
    return out


def _low(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :6].ravel()


def _whole(low: np.ndarray) -> np.ndarray:
    out = np.zeros((len(low) // 6, 8), np.uint8)
    out[:, :6] = low.reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _chunk(chunk: int, ids: list, sets: list[np.ndarray], bits: int):
    """Hashes of few documents go to their parts document by document; others once, with their documents in the head."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    h = np.concatenate(sets)
    h = h & np.uint64((1 << 48) - 1) | h >> np.uint64(64 - bits) << np.uint64(64 - bits)  # as the parts will have it
    doc = np.repeat(np.arange(len(sets)), sizes).astype(np.uint16)
    order = np.argsort(h, kind="stable")
    h, doc = h[order], doc[order]
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate([starts, [len(h)]]))
    many = counts >= TOGETHER
    held = np.repeat(many, counts)
    many_h, many_n, many_doc = h[starts[many]], counts[many].astype(np.uint32), doc[held]
    h, doc = h[~held], doc[~held]
    part_of = lambda x: (x >> np.uint64(64 - bits)).astype(np.int64)
    order = np.lexsort((doc, part_of(h)))
    h, doc = h[order], doc[order]
    every = np.arange((1 << bits) + 1)
    edges, many_edges = np.searchsorted(part_of(h), every), np.searchsorted(part_of(many_h), every)
    names = np.array([i is None for i in ids])
    prints = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.uint8)
    head = _bytes(np.array([0 if i is None else i for i in ids], np.int64), sizes, names, prints, many_h, many_n, many_doc)
    parts, blobs = [(1 << bits) + chunk % (1 << bits)], [head]
    for p in np.flatnonzero(np.diff(edges) + np.diff(many_edges)):
        at, at_many = slice(edges[p], edges[p + 1]), slice(many_edges[p], many_edges[p + 1])
        per = np.bincount(doc[at], minlength=len(sets))
        per = per.astype(np.uint8 if per.max(initial=0) < 255 else np.uint32)
        parts.append(int(p))
        blobs.append(bytes([per.itemsize]) + _bytes(per, _low(h[at]), _low(many_h[at_many]), many_n[at_many]))
    yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([chunk] * len(parts), pa.int64()), pa.array(blobs, pa.binary())], names=["part", "chunk", "blob"])


def _count(bits: int):
    """In one part: the hashes that several documents have, back by chunk with the bit length of their frequency."""

    def run(key, group):
        part, chunks = key[0].as_py(), group.column("chunk").to_pylist()
        blobs = [b.as_py() for b in group.column("blob")]
        if part < 1 << bits:
            each = [_arrays(b[1:], np.uint8 if b[0] == 1 else np.uint32, np.uint8, np.uint8, np.uint32) for b in blobs]
            lows = [x for per, low, many, n in each for x in (_whole(low), _whole(many))]
            weights = [x for per, low, many, n in each for x in (np.ones(len(low) // 6, np.int64), n.astype(np.int64))]
            ends = np.cumsum([0] + [len(x) for x in lows])
            _, inverse = np.unique(np.concatenate(lows), return_inverse=True)
            df = np.bincount(inverse, np.concatenate(weights)).astype(np.int64)[inverse]
            level, blobs = np.frexp(df.astype(np.float64))[1].astype(np.uint8), []
            for k, (per, *_) in enumerate(each):
                mine, many = slice(ends[2 * k], ends[2 * k + 1]), slice(ends[2 * k + 1], ends[2 * k + 2])
                keep = df[mine] > 1
                doc = np.repeat(np.arange(len(per), dtype=np.uint16), per)[keep]
                full = lows[2 * k][keep] | np.uint64(part) << np.uint64(64 - bits)
                blobs.append(_bytes(doc, full, level[mine][keep], level[many]))
        return pa.table({"part": pa.array([part] * len(blobs), pa.int32()), "chunk": pa.array(chunks, pa.int64()), "blob": pa.array(blobs, pa.binary())})

    return run


#: 64-bit words of a set's bit sketch: a bit that one set has and another lacks proves a hash outside the intersection.
SKETCH = [f"s{k}" for k in range(32)]
_SETS = "uid long, doc_id long, n long, alone long, print binary, prefix array<long>, common array<long>, " + ", ".join(f"{s} long" for s in SKETCH)


def _gather(bits: int, num: int, den: int):
    """Of one chunk: a row for each document; with prefix and shared hashes where it may have a partner."""

    def run(key, group):
        chunk, doc, full, level, many_levels = key[0].as_py(), [], [], [], {}
        for part, blob in zip(group.column("part").to_pylist(), group.column("blob"), strict=True):
            blob = blob.as_py()
            if part >= 1 << bits:
                ids, n, none, prints, many_h, many_n, many_doc = _arrays(blob, np.int64, np.int64, bool, np.uint8, np.uint64, np.uint32, np.uint16)
                docs, prints = len(ids), prints.tobytes()
            else:
                one, hashes, its, many = _arrays(blob, np.uint16, np.uint64, np.uint8, np.uint8)
                doc.append(one)
                full.append(hashes)
                level.append(its)
                many_levels[part] = many
        doc.append(many_doc)
        full.append(np.repeat(many_h, many_n))
        level.append(np.repeat(np.concatenate([np.zeros(0, np.uint8), *(many_levels[p] for p in sorted(many_levels))]), many_n))
        doc, full, level = np.concatenate(doc), np.concatenate(full), np.concatenate(level)
        shared = np.bincount(doc, minlength=docs).astype(np.int64)
        alone = n - shared
        length = np.where(n > 0, n + (num * n) // -den + 1, 0)  # n - ceil(num n / den) + 1
        may = length > alone
        keep = may[doc.astype(np.int64)] if len(doc) else np.zeros(0, bool)
        doc, full, level = doc[keep], full[keep].astype(np.uint64).view(np.int64), level[keep]
        order = np.lexsort((full, level, doc))
        full, doc = full[order], doc[order]
        ends = np.cumsum(np.where(may, shared, 0))
        starts = ends - np.where(may, shared, 0)
        first = np.where(may, length - alone, 0)
        inside = np.arange(len(full)) - np.repeat(starts, ends - starts)
        taken = inside < np.repeat(first, ends - starts)
        sketch = np.zeros((docs, len(SKETCH)), np.uint64)
        bits_of = full.view(np.uint64)
        np.bitwise_or.at(sketch, (doc.astype(np.int64), (bits_of >> np.uint64(6) & np.uint64(len(SKETCH) - 1)).astype(np.int64)), np.uint64(1) << (bits_of & np.uint64(63)))
        lists = lambda values, sizes: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, pa.int64()))
        return pa.table({
            "uid": pa.array((chunk << 14) + np.arange(docs), pa.int64()), "doc_id": pa.array(ids, pa.int64(), mask=none),
            "n": pa.array(n, pa.int64()), "alone": pa.array(alone, pa.int64()), "print": pa.array([prints[16 * k : 16 * k + 16] for k in range(docs)], pa.binary()),
            "prefix": lists(full[taken], first), "common": lists(full, ends - starts),
            **{c: pa.array(sketch[:, k].astype(np.uint64).view(np.int64), pa.int64()) for k, c in enumerate(SKETCH)},
        })

    return run


def indexed_sets(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """A row for each document: its set's size, fingerprint, prefix and shared hashes (empty where no partner can be)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    words = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 6
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words / PART_HASHES, 16)
    bits = min(24, math.ceil(math.log2(parts)))
    sent = rows.mapInArrow(_send(n, bits), _BLOCK)
    counted = sent.groupBy("part").applyInArrow(_count(bits), _BLOCK)
    return materialize(counted.groupBy("chunk").applyInArrow(_gather(bits, num, den), _SETS), "ngram-sets")


def _need(a: Column, b: Column, num: int, den: int) -> Column:
    """Least intersection of similar sets of sizes a and b."""
    return F.ceil((F.lit(num) * (a + b)) / F.lit(float(num + den)) - 1e-9)


def _sizes(n: Column, pos: Column, num: int, den: int) -> tuple[Column, Column]:
    """Smallest and largest size of a set that can be similar to one of size n, the token at pos being the first common one."""
    low = F.ceil(F.lit(num) * n / F.lit(float(den)) - 1e-9)
    return low, F.least(F.floor(F.lit(den) * n / F.lit(float(num)) + 1e-9), F.floor((n - pos) * F.lit(num + den) / F.lit(float(num)) + 1e-9) - n)


def _may_meet(num: int, den: int) -> Column:
    """By the sketches of l and r: whether what surely lies outside the intersection leaves enough."""
    need = _need(F.col("l.n"), F.col("r.n"), num, den)
    lost = lambda a, b: sum((F.bit_count(F.col(f"{a}.{s}").bitwiseAND(F.bitwise_not(f"{b}.{s}"))) for s in SKETCH), F.lit(0))
    return (F.col("l.c") - lost("l", "r") >= need) & (F.col("r.c") - lost("r", "l") >= need)


def _similar(inter: Column, num: int, den: int) -> Column:
    return den * inter >= num * (F.col("n_u") + F.col("n_v") - inter)


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """u, v, inter, similar: whole intersections of distinct pairs."""
    side = lambda c: sets.select(F.col("uid").alias(c), F.col("n").alias(f"n_{c}"), F.col("common").alias(f"set_{c}"))
    both = pairs.select("u", "v").join(side("u"), "u").join(side("v"), "v").withColumn("inter", F.size(F.array_intersect("set_u", "set_v")))
    return both.select("u", "v", "inter", _similar(F.col("inter"), num, den).alias("similar"))


def _derived(pairs: DataFrame, sets: DataFrame, tried: DataFrame, num: int, den: int) -> DataFrame:
    """Links u, v of distinct pairs. Two sets with a common leader: from both sets' differences from it; others as a whole."""
    of = tried.select(F.col("u").alias("uid"), F.col("v").alias("lead"), "inter").union(tried.select("v", "u", "inter"))
    leads = of.groupBy("uid").agg(F.max_by("lead", F.struct("inter", "lead")).alias("lead"))
    mine = pairs.select(F.col("u").alias("uid")).union(pairs.select("v")).distinct().join(leads, "uid")
    both = mine.join(sets.select("uid", "n", "common"), "uid").join(sets.select(F.col("uid").alias("lead"), F.col("common").alias("base")), "lead")
    apart = materialize(both.select("uid", "n", "lead", F.size("base").alias("m"), F.array_except("base", "common").alias("lacks"), F.array_except("common", "base").alias("adds")), "ngram-apart")
    side = lambda c: apart.select(F.col("uid").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("n", "lead", "m", "lacks", "adds")])
    led = pairs.join(side("u"), "u", "left").join(side("v"), "v", "left").withColumn("same", F.coalesce(F.col("lead_u") == F.col("lead_v"), F.lit(False)))
    shared = F.size(F.array_intersect("lacks_u", "lacks_v")) + F.size(F.array_intersect("adds_u", "adds_v"))
    inter = F.col("m_u") - F.size("lacks_u") - F.size("lacks_v") + shared
    derived = led.where("same").where(_similar(inter, num, den)).select("u", "v")
    out = materialize(derived.union(_verified(led.where("not same"), sets, num, den).where("similar").select("u", "v")), "ngram-derived")
    discard(apart)
    return out


def _pair() -> tuple[Column, Column]:
    return F.greatest(F.col("l.uid"), F.col("r.uid")).alias("u"), F.least(F.col("l.uid"), F.col("r.uid")).alias("v")


def _with_components(entries: DataFrame, known: DataFrame | None) -> DataFrame:
    if known is None:
        return entries.withColumn("component", F.col("uid"))
    return entries.join(known, entries["uid"] == known["node"], "left").drop("node").withColumn("component", F.coalesce("component", "uid"))


def _mixed(entries: DataFrame, *block: str) -> DataFrame:
    """Blocks with several components, and the largest one of each."""
    per = entries.groupBy(*block, "component").agg(F.count("*").alias("m"))
    per = per.groupBy(*block).agg(F.max_by("component", F.struct("m", "component")).alias("largest"), F.count("*").alias("c"))
    return entries.join(per.where("c > 1").drop("c"), list(block))


def _with_leaders(entries: DataFrame) -> DataFrame:
    """Pairs u, v of each block's sets with its leaders: of the largest component and of the others, the one with fewest hashes of its own."""
    blocks = _mixed(entries.union(entries.withColumn("level", F.col("level") + 1)), "token", "level")
    best, apart = F.struct("own", "uid", "n", "pos", "low", "high", "component"), F.col("component") != F.col("largest")
    leaders = blocks.groupBy("token", "level").agg(F.min(F.when(~apart, best)).alias("a"), F.min(F.when(apart, best)).alias("b"))
    leaders = leaders.select("token", "level", F.explode(F.array("a", "b")).alias("x")).select("token", "level", "x.*")
    return blocks.alias("l").join(leaders.alias("r"), ["token", "level"]).where("l.component <> r.component")


def similar_links(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links u, v of distinct sets (uid, n, alone, prefix, common, sketch): enough to connect whatever similar pairs connect."""
    step = math.log(den / num)
    level = F.floor(F.log("n") / step * (1 - 1e-9)).cast("int")
    entries = sets.select("uid", "n", level.alias("level"), "alone", F.posexplode("prefix").alias("k", "token"))
    entries = entries.select("token", "level", "uid", "n", (F.col("alone") + F.col("k")).alias("pos"), (F.col("alone") / F.col("n")).alias("own"))
    low, high = _sizes(F.col("n"), F.col("pos"), num, den)
    entries = entries.withColumns({"low": low, "high": high}).where("low <= high")
    lists = entries.groupBy("token").agg(F.count("*").alias("m")).where("m > 1").select("token")
    entries = materialize(entries.join(lists, "token"), "ngram-lists")
    near = F.col("l.n").between(F.col("r.low"), F.col("r.high")) & F.col("r.n").between(F.col("l.low"), F.col("l.high"))
    # In rounds, all sets of a block with its leaders, as long as that finds links.
    rounds: list[DataFrame] = []
    found = known = tried = None
    for _ in range(MOST_ROUNDS):
        pairs = _with_leaders(_with_components(entries, known)).where(near).select(*_pair()).distinct()
        if tried is not None:
            pairs = pairs.join(tried.select("u", "v"), ["u", "v"], "left_anti")
        rounds.append(materialize(_verified(pairs, sets, num, den), "ngram-led"))
        tried = rounds[0] if tried is None else tried.union(rounds[-1])
        hits = rounds[-1].where("similar").select("u", "v")
        found = hits if found is None else found.union(hits)
        if hits.isEmpty():
            break
        known = components(found)
    # Then what is left: pairs of different components; the smaller set is looked up in the blocks of sizes that the larger allows.
    size_class = lambda n: F.floor(F.log(n) / math.log(CLASS)).cast("int")
    mixed = _mixed(_with_components(entries, known), "token").withColumn("main", F.col("component") == F.col("largest"))
    small = mixed.where("high >= n").withColumn("class", size_class(F.col("n")))
    block = ["token", "class", "main"]
    heads = small.groupBy(*block).agg(F.max("high").alias("most"), F.min("component").alias("c0"), F.max("component").alias("c1"))
    top = F.least("n", "high")
    large = mixed.withColumn("class", F.explode(F.sequence(size_class(F.col("low")), size_class(top))))
    large = large.withColumn("main_", F.explode(F.when(F.col("main"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))))
    large = large.drop("main").withColumnRenamed("main_", "main").join(heads, block).where("n <= most and (component <> c0 or component <> c1)")
    sketch = sets.select("uid", F.size("common").alias("c"), *SKETCH)
    left, right = large.drop("most", "c0", "c1", "largest").join(sketch, "uid").alias("l"), small.drop("largest").join(sketch, "uid").alias("r")
    once = (F.col("l.n") > F.col("r.n")) | ((F.col("l.n") == F.col("r.n")) & (F.col("l.uid") > F.col("r.uid")))
    cross = left.join(right, block).where((F.col("l.component") != F.col("r.component")) & once & near & _may_meet(num, den))
    pairs = materialize(cross.select(*_pair()).distinct().join(tried.select("u", "v"), ["u", "v"], "left_anti"), "ngram-left")
    derived = _derived(pairs, sets, tried, num, den)
    links = materialize(found.union(derived), "ngram-links")
    discard(entries, pairs, derived, *rounds)
    return links


def ngram_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every document; sets link when den * intersection >= num * union."""
    rows = indexed_sets(docs, n, num, den, id_col, text_col)
    may = rows.where(F.size("prefix") > 0)
    same = may.groupBy("print").agg(F.min("uid").alias("rep"))
    of = may.select("uid", "print").join(same, "print").select("uid", "rep")
    sets = materialize(may.join(same.select(F.col("rep").alias("uid")), "uid", "left_semi").select("uid", "n", "alone", "prefix", "common", *SKETCH), "ngram-reps")
    links = similar_links(sets, num, den)
    known = components(links)
    of = of.join(known, of["rep"] == known["node"], "left").select("uid", F.coalesce("component", "rep").alias("component"))
    placed = materialize(rows.select("uid", "doc_id", "n").join(of, "uid", "left").select("doc_id", "n", F.coalesce("component", "uid").alias("component")), "ngram-placed")
    discard(rows, sets, links)
    several = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return placed.join(several, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def distinct_documents(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one, of the smallest id, of each component; rows without id stay."""
    rows = ngram_components(docs, n, num, den, id_col, text_col)
    drop = rows.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("first")).where("not first")
    return docs.join(drop, docs[id_col].cast("long") == drop["doc_id"], "left_anti")


def op5(spark, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


QUERIES = {"op5_ngram_join": op5}
ORACLE_SQL = {
    "op5_ngram_join": r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), g as (
  select distinct doc_id, array_to_string(list_slice(w, i, i + 3), ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) as i from w where len(w) > 0)
), n as (select doc_id, count(*) as n from g group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as shared from g a join g b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
e as (select x, y from p join n s on s.doc_id = x join n t on t.doc_id = y where 100 * shared >= 85 * (s.n + t.n - shared)),
r as (select doc_id as node, doc_id as c from documents union select e.y, r.c from r join e on e.x = r.node)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.c as component_id from documents d left join n on n.doc_id = d.doc_id join (select node, min(c) as c from r group by node) m on m.node = d.doc_id
"""
}
