"""Importance resampling towards a target distribution, by bucket streams that are written, sorted and gathered from.

Each block of documents is written as one row: ids, the documents' ends, and the packed stream of the buckets (uint16)
of all their features, the runs of one to three words. The checksum of a run continues that of the shorter run, so
that a text's features are hashed in one pass without being joined.

- Counts: a block's stream is sorted and run-length encoded; a task adds the runs up and hands on one row a bucket.
- Gains: a number for each bucket, of which there are at most 65,536; these go to all tasks.
- Weights: a block's gains are gathered by its stream and summed between the documents' ends.
- Draw: scores (weight and Gumbel noise by the document's id) are numbered by ranges; the highest are drawn.

Texts are read once; what is written is two bytes a feature. No task holds more than a block's stream.

Defined cases: null or wordless text has no features and weighs 0; null ids are hashed as the empty string and come before
others of equal score; repeated rows are rows like others; a very long text is a block of its own; empty tables count nothing, and with
no documents the result is empty; other columns, whatever their names, are ignored by ``resample``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.frontier import numbered

from .common import materialize, prepare, table

#: Bytes of a written group of rows; features that a block has, but for one longer document.
GROUP_BYTES, BLOCK_FEATURES = 4 << 20, 1 << 17
BUCKETS, LONGEST_RUN, SEED, FEWEST_WORDS, PERCENT, SCALE = 10_000, 3, 42, 20, 5, 1000
#: All bytes of words as they are, A-Z lower-cased, all other bytes as spaces.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
PACKED = "doc_id array<long>, words array<int>, ends array<long>, stream binary"


def features(text: bytes, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words of UTF-8 text, and the buckets of its runs of words."""
    words = text.translate(_PLAIN).split()
    after = [b" " + w for w in words]
    sums, out = list(map(crc32, words)), []
    for n in range(LONGEST_RUN):
        if n:
            sums = list(map(crc32, after[n:], sums))
        out.append(np.array(sums, np.uint32))
    return len(words), (np.concatenate(out) % buckets).astype(np.uint16)


def _block(ids: list, words: list[int], streams: list[np.ndarray]) -> pa.RecordBatch:
    columns = [
        pa.array([ids], pa.list_(pa.int64())), pa.array([words], pa.list_(pa.int32())), pa.array([np.cumsum([len(s) for s in streams])], pa.list_(pa.int64())),
        pa.array([np.concatenate(streams).astype("<u2").tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "words", "ends", "stream"])


def packed(docs: DataFrame, id_col: str | None = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """The bucket streams, a row for each block of documents."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are numbered by 16 bits")
    prepare(docs.sparkSession)

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words, streams, n = [], [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                many, stream = features(text.as_py() or b"", buckets)
                if ids and n + len(stream) > BLOCK_FEATURES:
                    yield _block(ids, words, streams)
                    ids, words, streams, n = [], [], [], 0
                ids.append(doc_id)
                words.append(many)
                streams.append(stream)
                n += len(stream)
            if ids:
                yield _block(ids, words, streams)

    doc_id = F.col(id_col) if id_col else F.lit(None)
    return docs.select(doc_id.cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(of_batch, PACKED)


def bucket_counts(streams: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: a task's runs are added up before they are exchanged."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for stream in batch.column(0):
                s = np.sort(np.frombuffer(stream.as_buffer(), "<u2"), kind="stable")
                starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
                total[s[starts]] += np.diff(np.append(starts, len(s)))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    return streams.select("stream").mapInArrow(of_task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Of bucket counts: each bucket's gain, from counts of which one is added everywhere."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, to in ((source, s), (target, t)):
        for row in counts.collect():  # a row for each bucket
            to[row["bucket"]] = row["n"]
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(SCALE * np.log(ratio)).astype(np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Scaled Gumbel noise by the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(streams: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document of the streams."""

    def of_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, words, ends, stream in zip(*(batch.column(k) for k in range(4)), strict=True):
                ids, ends = ids.as_py(), ends.values.to_numpy()
                starts = np.concatenate([[0], ends[:-1]])
                weight, full = np.zeros(len(ends), np.int64), ends > starts
                if full.any():
                    weight[full] = np.add.reduceat(gain[np.frombuffer(stream.as_buffer(), "<u2")], starts[full])
                score = weight + np.array([noise(i, seed) for i in ids], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), words.values.cast(pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(weight), pa.array(score)], ["doc_id", "n_words", "n_features", "weight", "score"]
                )

    return streams.mapInArrow(of_block, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = PERCENT, fewest: int = FEWEST_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and, where it is drawn, rank: percent of the documents of so many words at least."""
    # A reader holds a whole group of rows, so groups are made small.
    streams = materialize(packed(docs, id_col, text_col, buckets), "importance-streams", **{"parquet.block.size": GROUP_BYTES, "parquet.enable.dictionary": "false"})
    gain = gains(bucket_counts(streams, buckets), bucket_counts(packed(target, None, target_col, buckets), buckets), buckets)
    rows = materialize(weighed(streams, gain, seed), "importance-scores")
    able = F.coalesce(F.col("n_words") >= fewest, F.lit(False))
    drawn = rows.where(able).count() * percent // 100
    ranked = numbered(rows.where(able).withColumn("_order", -F.col("score")), ["_order", "doc_id"], "rank").drop("_order")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(rows.where(~able).withColumn("rank", F.lit(None).cast("long")))


def resampled_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with all their columns, known by their ids."""
    id_col = options.get("id_col", "doc_id")
    drawn = resample(docs, target, **options).where("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(drawn, docs[id_col].cast("long") == F.col("_drawn"), "left_semi")


def op13(spark, sf_dir: str) -> DataFrame:
    rows = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {"op13_importance": op13}

#: The checksum is linear: each byte's share is its table entry, moved on by the bytes after it; the shares of a run are joined by xor.
ORACLE_SQL = {
    "op13_importance": r"""
with recursive bits(b, k, v) as (select b::bigint, 0, b::bigint from range(256) as r(b) union all select b, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
crc_table as (select b, v from bits where k = 8),
texts as (select 0 as side, row_number() over () as row_id, doc_id, text from documents union all select 1, row_number() over (), null, text from benchmark),
worded as (select side, row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
grams as (select side, row_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as g from worded),
counted as (select side, row_id, g, count(*) as n from grams group by all),
terms as (select g, row_number() over () as g_id, strlen(g) as size, hex(encode(g)) as h from (select distinct g from counted)),
powers(d, b, v) as (select 0, b, v from crc_table union all select 0, -1, 4294967295
  union all select d + 1, p.b, xor(t.v, p.v >> 8) from powers p join crc_table t on t.b = p.v & 255 where d <= (select max(size) from terms)),
bytes as (select g_id, size, unnest(range(size)) as i, h from terms),
raw as (select g_id, size - 1 - i as d, ('0x' || substr(h, 2 * i + 1, 2))::bigint as b from bytes union all select g_id, size, -1 from terms),
hashed as (select g_id, xor(bit_xor(v), 4294967295) % 10000 as bucket from raw join powers using (d, b) group by g_id),
bucketed as (select side, row_id, bucket, sum(n)::bigint as n from counted join terms using (g) join hashed using (g_id) group by all),
totals as (select sum(n) filter (side = 0)::double as s, coalesce(sum(n) filter (side = 1), 0)::double as t from bucketed),
per as (select bucket, coalesce(sum(n) filter (side = 0), 0)::double as s, coalesce(sum(n) filter (side = 1), 0)::double as t from bucketed group by bucket),
gains as (select bucket, floor(1000 * ln((per.t + 1) * (totals.s + 10000) / ((per.s + 1) * (totals.t + 10000))))::bigint as gain from per, totals),
weights as (select row_id, sum(n * gain)::bigint as weight, sum(n)::bigint as n_features from bucketed join gains using (bucket) where side = 0 group by row_id),
scored as (select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from worded left join weights using (row_id) where side = 0),
ranked as (select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls first) as r, count(*) filter (n_words >= 20) over () as able from scored)
select doc_id, n_features, weight, score, case when n_words >= 20 and r <= 5 * able // 100 then r end as rank from ranked""",
}
