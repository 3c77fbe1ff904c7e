"""A uniform shuffle of a table into shards of exact sizes, by a drawn communication matrix.

Rows stand in the partitions in which they were read. How many rows each partition sends to each shard is
drawn first: a matrix with the partitions' and the shards' sizes as its margins, distributed as a uniform
shuffle of all rows would distribute it (multivariate hypergeometric). It is drawn for groups of partitions
on the driver, and for the partitions of each group in a task of its own. Then a partition's rows are put in
a pseudorandom order and go to the shards by that order and the drawn counts; rows that arrive in a shard are
ordered by partition and put in a pseudorandom order again, which gives their slots.

Both orders are permutations of indices that are worked out for each row alone, so that no task holds a
partition's or a shard's rows, and a shard may be of any size. Rows are stored once with their partition and
their place in it: a lost task, or a second reading, finds the same rows in the same places.

The law that holds is ``rows``: the shards' numbers of rows are at most one apart, whatever the rows hold. Equal
texts, however many, are spread over the shards as other rows are. Equal splits of the input, seed and number
of shards give an equal result.

Defined cases: null text has a size of 1 and the checksum of no bytes, 0; repeated rows, also a third of all rows,
are rows like others; null ids too; very long texts are one row; an empty table gives an empty result; fewer rows
than shards leave the last shards empty; other columns, whatever their names, are kept by ``shuffled``.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, prepare, table
from .mixing import permuted

SHARDS, SEED = 8, 20240517
#: Partitions whose counts one task draws; bytes of the plan up to which it is broadcast; what monotonically increasing ids count a partition's rows in.
GROUP, BROADCAST_BYTES, PLACE_BITS = 256, 32 << 20, 33
#: Standard deviations, and steps besides, on both sides of the mean beyond which the counts' probabilities are below what a double holds.
DEVIATIONS, STEPS = 12, 64


def hypergeometric(good: int, bad: int, drawn: int, u: float) -> int:
    """The number of good ones among those drawn without replacement, at the quantile u: by its distribution function, from the ratios of neighbouring probabilities."""
    all_ = good + bad
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    mean, share = drawn * good / all_, good / all_
    spread = math.sqrt(drawn * share * (1 - share) * (all_ - drawn) / max(all_ - 1, 1)) * DEVIATIONS + STEPS
    low, high = max(low, math.floor(mean - spread)), min(high, math.ceil(mean + spread))
    k = np.arange(low, high, dtype=np.float64)
    ratio = np.log((good - k) * (drawn - k)) - np.log((k + 1) * (bad - drawn + k + 1))
    log_p = np.concatenate([[0.0], np.cumsum(ratio)])
    p = np.cumsum(np.exp(log_p - log_p.max()))
    return low + min(int(np.searchsorted(p, u * p[-1], side="right")), high - low)


def matrix(sizes: list[int], room: list[int], seed: str) -> np.ndarray:
    """How many rows each sender sends to each receiver; sizes and room are its margins, with equal sums."""
    rng, room, out = random.Random(seed), list(room), np.zeros((len(sizes), len(room)), np.int64)
    for i, n in enumerate(sizes):
        rest = sum(room)
        for j, r in enumerate(room):
            rest -= r
            got = hypergeometric(r, rest, n, rng.random())
            out[i, j], n = got, n - got
        room = [r - int(x) for r, x in zip(room, out[i], strict=True)]
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication(counts: DataFrame, shards: int, seed: int) -> tuple[DataFrame, int]:
    """Of (part, n): part, n, ends and starts, and the number of all rows.

    ends[s] is how many of the partition's rows go to the shards up to s; starts[s] is where those that go to s begin among all that arrive there.
    """
    groups = counts.groupBy(F.floor(F.col("part") / GROUP).alias("group")).agg(F.sum("n").alias("n")).orderBy("group").collect()  # a row for each 256 partitions
    room = shard_sizes(sum(g["n"] for g in groups), shards)
    sent = matrix([g["n"] for g in groups], room, f"{seed}")
    begin = np.cumsum(sent, axis=0) - sent
    rows = [(g["group"], sent[i].tolist(), begin[i].tolist()) for i, g in enumerate(groups)]
    dealt = counts.sparkSession.createDataFrame(rows, "group long, sent array<long>, begin array<long>")
    prepare(counts.sparkSession)

    def of_group(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("part")
        got = matrix(g["n"].tolist(), list(map(int, g["sent"].iloc[0])), f"{seed} {g['group'].iloc[0]}")
        starts = np.asarray(g["begin"].iloc[0]) + np.cumsum(got, axis=0) - got
        return pd.DataFrame({"part": g["part"], "n": g["n"], "ends": list(np.cumsum(got, axis=1)), "starts": list(starts)})

    plan = counts.withColumn("group", F.floor(F.col("part") / GROUP)).join(F.broadcast(dealt) if len(rows) * shards * 16 <= BROADCAST_BYTES else dealt, "group")
    return plan.groupBy("group").applyInPandas(of_group, "part long, n long, ends array<long>, starts array<long>"), sum(room)


def _first_above(ends: Column, x: Column, shards: int) -> Column:
    """How many of the rising ends are at most x, which is below the last one: by halving."""
    strides = [1 << b for b in reversed(range(max(1, (shards - 1).bit_length())))]

    def step(at: Column, stride: Column) -> Column:
        to = at + stride
        return F.when((to < shards) & (F.get(ends, to - 1) <= x), to).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, strides)), F.lit(0), step)


def shuffled(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """The rows with their shard (0 to shards - 1) and slot in it (from 0, without gaps)."""
    at = free_name(rows, "_at")
    stored = materialize(rows.withColumn(at, F.monotonically_increasing_id()), "shard-rows")
    part, place = F.shiftright(at, PLACE_BITS), F.col(at).bitwiseAND((1 << PLACE_BITS) - 1)
    plan, total = communication(stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")), shards, seed)
    plan = materialize(plan, "shard-plan").select(F.struct("n", "ends", "starts").alias("_plan"), F.col("part").alias("_plan_part"))
    # A row of the plan for each input partition: small beside the partition, and broadcast only where that is known to be small.
    plan = F.broadcast(plan) if plan.count() * shards * 16 <= BROADCAST_BYTES else plan.hint("merge")
    both = stored.join(plan, part == F.col("_plan_part"))
    p = F.col("_plan")
    both = both.withColumn("_rank", permuted(place, p["n"], F.lit(seed), F.lit("send"), part))
    both = both.withColumn("_shard", _first_above(p["ends"], F.col("_rank"), shards))
    s = F.col("_shard")
    arrived = F.get(p["starts"], s) + F.col("_rank") - F.when(s > 0, F.get(p["ends"], s - 1)).otherwise(0)
    size = F.lit(total // shards) + (s < total % shards).cast("long")
    slot = permuted(arrived, size, F.lit(seed), F.lit("receive"), s)
    return both.select(*rows.columns, s.alias(shard_col), slot.alias(slot_col))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """The shuffled rows as Parquet, a folder for each shard, its files and the rows in them in the order of the slots."""
    rows = shuffled(docs, shards, seed)
    n = max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size and text_crc32 of documents: what their shards are checked by."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))


def op12(spark, sf_dir: str) -> DataFrame:
    rows = shuffled(measured(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op12_sharding": op12}
