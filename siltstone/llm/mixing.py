"""Mixing sources to target weights by permuted fixed-length blocks, with DataFrame functions only.

Each source's words stand one after another (by hash bucket, then id) and are cut to blocks of a
fixed length. Each output shard draws the source of each of its slots from the target weights, so that
its counts of the sources are multinomial. The counts are settled for each source: they are scaled
along the shards so that the source's slots in all shards are as many as its target takes. The settled
counts number a source's slots. Slots run through the source's blocks in the order of a pseudorandom
permutation of the block indices, another one for each epoch, and meet documents where block indices
are equal. The last slot of a source is cut to the words that its target still lacks.

Targets: sources in code point order, null last, have the weights in turn; a target above its cap
is the cap, and the excess goes to the others by weight, until none is above.

Defined cases: null or wordless text has size 0 and nothing is taken from it; a null id or source is a
value like others; repeated rows each count, and of rows with one id, source and text it is undefined
only which of them another part is taken from; with no words at all every target is 0; an empty table
gives an empty result; very long texts are cut to blocks like others; other columns, whatever their
names, are ignored by ``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, table

WEIGHTS, SHARE, CAP = (5.0, 2.0, 1.0), 1.5, 2
BLOCK_WORDS, SHARD_SLOTS, SEED, ROUNDS = 1024, 1024, 20240229, 24
#: Documents that a bucket of the running sums has on average; neighbours that a running sum takes together; slots that one row unfolds to; cells of the weights' line, by which draws find their source.
BUCKET_ROWS, TOGETHER, CHUNK, CELLS = 1000, 1024, 512, 1 << 16


def permuted(x: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """Where a pseudorandom permutation of 0..n-1, chosen by key, takes x: a swap-or-not network on any n."""

    def swap(at: Column, i: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, i), n) - at + n, n)
        return F.when(F.pmod(F.xxhash64(*key, i, F.greatest(at, other)), F.lit(2)) == 1, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("long"), swap)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Of (source, skey, size) rows: skey, source_size, target. The windows run over one row for each source."""
    every = Window.partitionBy()
    by_name = every.orderBy(F.col("source").isNull(), "source")
    per = sizes.groupBy("source", "skey").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("rank", F.row_number().over(by_name))
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1))
    per = per.withColumn("most", cap * F.col("source_size").cast("double")).withColumn("full_at", F.col("most") / F.col("w"))
    upward = every.orderBy("full_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("held", F.coalesce(F.sum("most").over(upward), F.lit(0.0)))
    per = per.withColumn("open_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(upward), F.lit(0.0)))
    per = per.withColumn("level", (share * F.sum("source_size").over(every) - F.col("held")) / F.col("open_w"))
    # The first source, in the order in which they fill up, that is not filled at its level sets the level.
    first = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "rank", "level"))).over(every)["level"]
    return per.withColumn("target", F.coalesce(F.least("most", first * F.col("w")), F.col("most"))).select("skey", "source_size", "target")


def _keys(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    """doc_id, skey, tie and size of a document: tie keeps documents apart that share their id."""
    source, text = F.col(source_col).cast("string"), F.col(text_col).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    skey = F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source))
    return [F.col(id_col).cast("long").alias("doc_id"), skey.alias("skey"), F.xxhash64(text).alias("tie"), size.alias("size")]


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(*_keys(docs, id_col, text_col, source_col), F.col(source_col).cast("string").alias("source"))


def _running(rows: DataFrame, key: str, order: str, value: str, to: str) -> DataFrame:
    """Adds the sum of a key's values before each row. Sums run among neighbours, then over groups of them: no task has all of a key."""
    group = F.floor(F.col(order) / TOGETHER)
    rows = rows.withColumn("_g", group)
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(key, "_g").agg(F.sum(value).alias("_s")).withColumn("_gg", F.floor(F.col("_g") / TOGETHER))
    tops = sums.groupBy(key, "_gg").agg(F.sum("_s").alias("_t"))
    tops = tops.select(key, "_gg", F.coalesce(F.sum("_t").over(before(key).orderBy("_gg")), F.lit(0)).alias("_top"))
    base = F.col("_top") + F.coalesce(F.sum("_s").over(before(key, "_gg").orderBy("_g")), F.lit(0))
    sums = sums.join(tops, [key, "_gg"]).select(key, "_g", base.alias("_base"))
    inner = F.coalesce(F.sum(value).over(before(key, "_g").orderBy(order)), F.lit(0))
    return rows.withColumn("_in", inner).join(sums, [key, "_g"]).withColumn(to, F.col("_base") + F.col("_in")).drop("_g", "_in", "_base")


def _placed(sizes: DataFrame) -> DataFrame:
    """Each row that has words with the offset of its first word in its source; sums run in buckets, then over buckets."""
    buckets = max(1, -(-sizes.count() // BUCKET_ROWS))
    rows = sizes.where("size > 0").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(buckets)))
    total = materialize(rows.groupBy("skey", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    base = _running(total, "skey", "bucket", "words", "base").select("skey", "bucket", "base")
    within = Window.partitionBy("skey", "bucket").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    nth = F.row_number().over(Window.partitionBy("skey", "bucket", "doc_id", "tie").orderBy("size"))
    return rows.withColumn("nth", nth).join(base, ["skey", "bucket"]).withColumn("start", F.col("base") + F.col("inner")).drop("bucket", "base", "inner")


def slot_plan(targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """How many slots each source fills, and how its blocks and epochs divide."""
    size, want = F.col("source_size"), F.col("want")
    plan = targets.where("source_size > 0").withColumn("want", F.least(F.round("target").cast("long"), CAP * size))
    plan = plan.withColumn("full_blocks", F.floor(size / block)).withColumn("blocks", F.ceil(size / block))
    plan = plan.withColumn("epochs", F.floor(want / size)).withColumn("left", want % size)
    plan = plan.withColumn("left_full", F.floor(F.col("left") / block)).withColumn("cut", F.col("left") % block)
    return plan.withColumn("slots", F.col("epochs") * F.col("blocks") + F.col("left_full") + (F.col("cut") > 0).cast("long")).where("slots > 0")


def _uniform(seed: int, *key: str) -> Column:
    """A pseudorandom number from 0 to below 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("draw"), *map(F.col, key)), 11).cast("double") / F.lit(float(1 << 53))


def drawn_counts(plan: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """shard, skey, drawn: each shard draws the source of each of its slots by the sources' shares of all slots."""
    spark = plan.sparkSession
    total = plan.agg(F.sum("slots")).first()[0] or 0
    share = F.col("slots") / F.lit(float(max(total, 1)))
    line = plan.withColumn("high", F.sum(share).over(Window.orderBy("skey").rowsBetween(Window.unboundedPreceding, 0)))
    # One row a source: the last one's end is 1, whatever the rounding.
    line = line.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("skey")), F.lit(0.0)))
    line = line.withColumn("high", F.when(F.lead("skey").over(Window.orderBy("skey")).isNull(), 1.0).otherwise(F.col("high")))
    cells = F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))
    line = line.select("skey", "low", "high", F.explode(cells).alias("cell"))
    shards = -(-total // shard_slots)
    slots = spark.range(shards * shard_slots).select(F.floor(F.col("id") / shard_slots).alias("shard"), (F.col("id") % shard_slots).alias("at"))
    slots = slots.where(F.col("shard") * shard_slots + F.col("at") < total).withColumn("x", _uniform(seed, "shard", "at"))
    slots = slots.withColumn("cell", F.floor(F.col("x") * CELLS))
    return slots.join(line, "cell").where("x >= low and x < high").groupBy("shard", "skey").agg(F.count("*").alias("drawn"))


def shard_counts(plan: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """shard, skey, first, blocks: the drawn counts, settled so that each source gets its slots; first numbers a shard's slots of a source."""
    drawn = materialize(drawn_counts(plan, shard_slots, seed), "mix-drawn")
    got = _running(drawn, "skey", "shard", "drawn", "before").join(drawn.groupBy("skey").agg(F.sum("drawn").alias("all_drawn")), "skey")
    rows = got.join(plan.select("skey", "slots"), "skey")
    edge = lambda n: F.round(n * (F.col("slots") / F.col("all_drawn"))).cast("long")
    first, last = edge(F.col("before")), F.when(F.col("before") + F.col("drawn") == F.col("all_drawn"), F.col("slots")).otherwise(edge(F.col("before") + F.col("drawn")))
    rows = rows.select("shard", "skey", first.alias("first"), (last - first).alias("blocks")).where("blocks > 0")
    # A source that no shard has drawn comes in the first one.
    none = plan.join(drawn.select("skey").distinct(), "skey", "left_anti")
    return rows.union(none.select(F.lit(0).cast("long"), "skey", F.lit(0).cast("long"), "slots"))


def mix_slots(plan: DataFrame, counts: DataFrame, block: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """skey, slot, shard, epoch, block, words: every slot of the mix, numbered by the shards' counts."""
    size = F.col("source_size")
    chunks = counts.join(plan, "skey").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("blocks_drawn") - 1) / CHUNK))))
    n = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(n, "skey", "shard", "chunk")
    end = F.least(F.col("blocks_drawn"), (F.col("chunk") + 1) * CHUNK) - 1
    slots = chunks.withColumn("nth", F.explode(F.sequence(F.col("chunk") * CHUNK, end))).withColumn("slot", F.col("first") + F.col("nth"))
    slots = slots.withColumn("epoch", F.floor(F.col("slot") / F.col("blocks"))).withColumn("at", F.col("slot") % F.col("blocks"))
    # The short block, if there is one, ends every epoch; the others are permuted.
    index = F.when(F.col("at") >= F.col("full_blocks"), F.col("at")).otherwise(permuted(F.col("at"), F.col("full_blocks"), F.lit(seed), F.col("skey"), F.col("epoch")))
    cut = (F.col("slot") == F.col("slots") - 1) & (F.col("cut") > 0)
    words = F.when(cut, F.col("cut")).otherwise(F.least(F.lit(block), size - F.col("block") * block))
    return slots.withColumn("block", index).select("skey", "slot", "shard", "epoch", "block", words.alias("words"))


def _taken(placed: DataFrame, slots: DataFrame, block: int) -> DataFrame:
    """Pieces of documents joined with the slots that take their block: doc columns, shard, epoch, first and last word taken."""
    start, end = F.col("start"), F.col("start") + F.col("size")
    pieces = placed.withColumn("block", F.explode(F.sequence(F.floor(start / block), F.floor((end - 1) / block))))
    low = F.greatest(start - F.col("block") * block, F.lit(0))
    high = F.least(end - F.col("block") * block, F.col("words"))
    # Slots unfold from few rows, so their size is not known before; both sides grow with the input.
    both = pieces.join(slots.hint("merge"), ["skey", "block"])
    return both.withColumn("low", low).withColumn("high", high).where("high > low").withColumn("offset", F.col("block") * block - start)


def _parts(docs: DataFrame, id_col: str, text_col: str, source_col: str, block: int, shard_slots: int, seed: int, weights, share: float):
    sizes = materialize(_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    targets = materialize(source_targets(sizes, weights, share), "mix-targets")  # a row for each source, read many times
    # A row for each source, and one for each source and shard: stored, so that the driver does not plan them anew wherever they are read.
    plan = materialize(slot_plan(targets, block), "mix-plan")
    counts = shard_counts(plan, shard_slots, seed).withColumnRenamed("blocks", "blocks_drawn")
    counts, placed = materialize(counts, "mix-counts"), _placed(sizes)
    return sizes, targets, placed, _taken(placed, mix_slots(plan, counts, block, seed), block)


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", block=BLOCK_WORDS, shard_slots=SHARD_SLOTS, seed=SEED, weights=WEIGHTS, share=SHARE) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and shards, how many output shards its words are in."""
    sizes, targets, placed, taken = _parts(docs, id_col, text_col, source_col, block, shard_slots, seed, weights, share)
    got = taken.groupBy("skey", "start").agg(F.sum(F.col("high") - F.col("low")).alias("taken"), F.size(F.collect_set("shard")).alias("shards"))
    rows = placed.join(got, ["skey", "start"], "left").select("doc_id", "skey", "size", F.coalesce("taken", F.lit(0)).alias("taken"), F.coalesce("shards", F.lit(0)).alias("shards"))
    rows = rows.unionByName(sizes.where("size = 0").select("doc_id", "skey", "size", F.lit(0).cast("long").alias("taken"), F.lit(0).alias("shards")))
    return rows.join(targets, "skey").select("doc_id", "size", "source_size", "target", "taken", "shards")


def mixed_documents(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", block=BLOCK_WORDS, shard_slots=SHARD_SLOTS, seed=SEED, weights=WEIGHTS, share=SHARE) -> DataFrame:
    """The mix as documents: a row for each document and epoch with the words taken; a whole document keeps its text as it is."""
    *_, taken = _parts(docs, id_col, text_col, source_col, block, shard_slots, seed, weights, share)
    on = ["doc_id", "skey", "tie", "nth"]
    spans = taken.groupBy(*on, "size", "epoch").agg(
        F.array_sort(F.collect_list(F.struct((F.col("offset") + F.col("low")).alias("low"), (F.col("offset") + F.col("high")).alias("high")))).alias("spans"),
        F.sum(F.col("high") - F.col("low")).alias("n_taken"),
    )
    # The documents' own columns stand in one struct, so that their names do not matter.
    rows = docs.select(*_keys(docs, id_col, text_col, source_col)[:3], F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*on[:3]).orderBy("doc_id")))
    same = F.lit(True)
    for c in on:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}"))
    both = rows.alias("r").join(spans.alias("s"), same).select("row", "size", "spans", "n_taken")
    text, part = F.col("row")[text_col], F.col("n_taken") < F.col("size")
    words = F.when(part, F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    cut = F.array_join(F.flatten(F.transform("spans", lambda s: F.slice("words", (s["low"] + 1).cast("int"), (s["high"] - s["low"]).cast("int")))), " ")
    both = both.withColumn("words", words).withColumn("new", F.when(part, cut).otherwise(text))
    n_chars = F.length("new").cast("long")
    return both.select(*[(F.col("new") if c == text_col else n_chars if c == "n_chars" else F.col("row")[c]).alias(c) for c in docs.columns])


def op9(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


QUERIES = {"op9_mixing": op9}
