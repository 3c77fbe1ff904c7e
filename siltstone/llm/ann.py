"""Approximate nearest neighbours by an adaptive dimension scan of inverted lists.

Largest inner products become nearest points by one more coordinate, the root of what a vector's squared
norm lacks to the largest one. Vectors are turned by a random rotation, so that the first coordinates
say about a distance what any others would, and stand in lists by their nearest centroid. A query
probes its nearest lists; in each, coordinates are read in column blocks, and after each block a
hypothesis test gives up the candidates whose distance so far is too large to end below the query's
threshold. The threshold starts at the k-th distance to a fixed sample and falls with what is found.
Survivors get the exact measure, in double precision on the original vectors.

Centroids, the number of lists that a query probes (for a recall of ``AIM`` on the sample) and first
thresholds come from a sample of bounded size; every vector is indexed. Lists with many vectors or
queries are cut to segments, so that one very common vector is no bottleneck.

Defined cases: vectors that are null, zero, hold null or non-finite components, have no id or another
dimension than most take no part; ties go to the smaller id; of repeated query ids one vector (the
smallest) is searched, and rows with the query's id are its own; an id is found once; with fewer
candidates than k all are found; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, prepare, table

#: Numbers that the sample may hold, its vectors that give first thresholds, recall aimed at on the sample, rows of a
#: segment, queries of a segment, lists that set a query's threshold, columns of a block, width of the test in standard deviations, seed.
SAMPLE_VALUES, ANCHORS, AIM, SEGMENT, QUERY_SEGMENT, FIRST, COLUMNS, WIDTH, SEED = 2_000_000, 1024, 0.97, 2048, 2048, 4, 16, 2.1, 7
MOST_LISTS = 4096
_SLACK = 1e-4


def _matrix(column, width: int) -> np.ndarray:
    """Vectors of an Arrow list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


class ListIndex:
    """Rotation, centroids and anchors; what all tasks share."""

    def __init__(self, ids: np.ndarray, sample: np.ndarray, rows: int, largest: float, k: int):
        rng = np.random.default_rng(SEED)
        self.width, self.k, self.square = sample.shape[1], k, largest
        self.turn = np.linalg.qr(rng.standard_normal((self.width + 1, self.width + 1)))[0]
        points = self.points(sample)
        lists = int(max(1, min(MOST_LISTS, math.sqrt(rows), len(sample) // 16)))
        self.centroids = points[rng.permutation(len(points))[:lists]].copy()
        for _ in range(8):
            near = self.distances(points, self.centroids).argmin(1)
            count = np.bincount(near, minlength=lists)
            for c in range(self.width + 1):
                total = np.bincount(near, points[:, c], minlength=lists)
                self.centroids[:, c] = np.where(count > 0, total / np.maximum(count, 1), self.centroids[:, c])
        self.anchor_ids, self.anchors = ids[:ANCHORS], sample[:ANCHORS]
        self.probes = self._calibrate(sample, points)

    def points(self, x: np.ndarray) -> np.ndarray:
        """Vectors as rotated points whose distances order as inner products with a query do."""
        rest = np.sqrt(np.maximum(0, self.square - (x * x).sum(1)))
        return np.hstack([x, rest[:, None]]) @ self.turn

    def queries(self, q: np.ndarray) -> np.ndarray:
        return np.hstack([q, np.zeros((len(q), 1))]) @ self.turn

    @staticmethod
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)

    def _calibrate(self, sample: np.ndarray, points: np.ndarray) -> int:
        """Lists to probe so that the sample's vectors find AIM of their neighbours in the sample."""
        tries, lists = min(256, len(sample)), len(self.centroids)
        q = self.queries(sample[:tries])
        d = self.distances(q, points)
        d[np.arange(tries), np.arange(tries)] = np.inf
        k = min(self.k, len(points) - 1)
        if k < 1 or lists == 1:
            return lists
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        home = self.distances(points, self.centroids).argmin(1)
        rank = self.distances(q, self.centroids).argsort(1).argsort(1)
        ranks = np.take_along_axis(rank, home[near], 1).ravel()
        return int(min(lists, np.quantile(ranks, AIM) + 2))

    def anchor_hits(self, ids: np.ndarray, q: np.ndarray) -> tuple[list, np.ndarray]:
        """Each query's best anchors (id, score), and its first threshold: the k-th squared distance."""
        score = q @ self.anchors.T
        score[ids[:, None] == self.anchor_ids] = -np.inf
        best = np.argsort(-score, axis=1)[:, : self.k]
        hits, limit = [], np.full(len(q), np.inf)
        for r in range(len(q)):
            own = [c for c in best[r] if score[r, c] > -np.inf]
            hits.append([(int(self.anchor_ids[c]), float((self.anchors[c] * q[r]).sum())) for c in own])
            if len(own) == self.k:
                limit[r] = (q[r] * q[r]).sum() + self.square - 2 * score[r, own[-1]]
        return hits, limit

    def scan(self, q_ids: np.ndarray, q: np.ndarray, limit: np.ndarray, ids: np.ndarray, x: np.ndarray):
        """The k best of a segment for each query, as arrays of query row, id and score."""
        points, turned, wide = self.points(x), self.queries(q), self.width + 1
        limit = limit.copy()
        rows, found, scores = [], [], []
        alive_q, alive_x = np.nonzero(q_ids[:, None] != ids)
        so_far = np.zeros(len(alive_q))
        for start in range(0, wide, COLUMNS):
            end = min(wide, start + COLUMNS)
            if start == 0:
                so_far = self.distances(turned[:, :end], points[:, :end])[alive_q, alive_x]
            else:
                gap = turned[alive_q, start:end] - points[alive_x, start:end]
                so_far = so_far + (gap * gap).sum(1)
            if end < wide:
                bound = limit * (end / wide) * (1 + WIDTH / math.sqrt(end)) ** 2
            else:
                bound = limit
            keep = so_far <= bound[alive_q] * (1 + _SLACK) + _SLACK * self.square
            alive_q, alive_x, so_far = alive_q[keep], alive_x[keep], so_far[keep]
        for at in range(0, len(alive_q), 1 << 16):
            a, b = alive_q[at : at + (1 << 16)], alive_x[at : at + (1 << 16)]
            rows.append(a)
            found.append(ids[b])
            scores.append((x[b] * q[a]).sum(1))
        if not rows:
            return np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0)
        rows, found, scores = map(np.concatenate, (rows, found, scores))
        order = np.lexsort((found, -scores, rows))
        rows, found, scores = rows[order], found[order], scores[order]
        first = np.searchsorted(rows, np.arange(len(q)))
        keep = np.arange(len(rows)) - first[rows] < self.k
        return rows[keep], found[keep], scores[keep]


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (doubles) of the vectors that take part, whatever their dimension."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~bad & F.exists("v", lambda x: x != 0))


_HITS = "query_id long, vec_id long, score double"


def nearest(df: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by every."""
    spark = df.sparkSession
    prepare(spark, 2000)
    rows = valid_vectors(df, id_col, vector_col)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    sizes = rows.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"), F.max(square).alias("most")).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, n, most = max(sizes, key=lambda r: (r["n"], r["width"]))
    rows = rows.where(F.size("v") == width)
    share = min(1.0, SAMPLE_VALUES / width / n)
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(SEED), "vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = sorted(drawn.limit(2 * SAMPLE_VALUES // width + 1).collect(), key=lambda r: (r[0] * 2654435761) % (1 << 32))
    index = ListIndex(np.array([r[0] for r in sample], np.int64), np.array([r[1] for r in sample]), n, most, k)
    shared = spark.sparkContext.broadcast(index)

    def assign(batches):
        for b in batches:
            x = _matrix(b.column(1), width)
            home = shared.value.distances(shared.value.points(x), shared.value.centroids).argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array(home, pa.int32()), b.column(0), b.column(1)], names=["list", "vec_id", "v"])

    placed = materialize(rows.mapInArrow(assign, "list int, vec_id long, v array<double>"), "ann-lists")
    filled = {r[0]: r[1] for r in placed.groupBy("list").count().collect()}
    held = np.array([filled.get(i, 0) for i in range(len(index.centroids))])

    def probe(batches):
        made = pa.schema([("query_id", pa.int64()), ("v", pa.list_(pa.float64())), ("limit", pa.float64()), ("lists", pa.list_(pa.int32())), ("hits", pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())])))])
        for b in batches:
            x, ids = _matrix(b.column(1), width), b.column(0).to_numpy()
            order = shared.value.distances(shared.value.queries(x), shared.value.centroids).argsort(1)
            enough = (np.cumsum(held[order], 1) < 8 * k).sum(1) + 1
            lists = [row[: max(shared.value.probes, e)].tolist() for row, e in zip(order, enough, strict=True)]
            hits, limit = shared.value.anchor_hits(ids, x)
            hits = [[{"vec_id": i, "score": s} for i, s in h] for h in hits]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(limit), pa.array(lists, made.field("lists").type), pa.array(hits, made.field("hits").type)], schema=made)

    asked = placed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = asked.mapInArrow(probe, "query_id long, v array<double>, limit double, lists array<int>, hits array<struct<vec_id:long,score:double>>")
    asked = materialize(asked, "ann-queries")
    probes = asked.select("query_id", "v", "limit", F.posexplode("lists").alias("at", "list"))
    wanted = {r[0]: r[1] for r in probes.groupBy("list").count().collect()}
    cuts = lambda counts, most: F.element_at(F.array(*[F.lit(max(1, -(-counts.get(i, 0) // most))) for i in range(len(held))]), F.col("list") + 1)
    segments, blocks = cuts(filled, SEGMENT), cuts(wanted, QUERY_SEGMENT)
    right = placed.withColumn("segment", F.pmod(F.xxhash64("vec_id"), segments).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    key = ["list", "segment", "block"]

    def found(asked_lists: DataFrame) -> DataFrame:
        """A query goes to every segment of a list, a vector to every block of the list's queries."""
        left = asked_lists.withColumn("block", F.pmod(F.xxhash64("query_id"), blocks).cast("int")).withColumn("segment", F.explode(F.sequence(F.lit(0), segments - 1)))
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(scan, _HITS)

    def ranked(hits: DataFrame) -> DataFrame:
        best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)

    def scan(queries, vectors):
        out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not queries.num_rows or not vectors.num_rows:
            return out.empty_table()
        q_ids = queries.column("query_id").to_numpy()
        q, x = _matrix(queries.column("v"), width), _matrix(vectors.column("v"), width)
        ids, limit = vectors.column("vec_id").to_numpy(), queries.column("limit").to_numpy()
        parts = []
        for at in range(0, len(q), 256):
            r, found, score = shared.value.scan(q_ids[at : at + 256], q[at : at + 256], limit[at : at + 256], ids, x)
            parts.append(pa.table([q_ids[at : at + 256][r], found, score], schema=out))
        return pa.concat_tables(parts)

    # The nearest lists first: the k-th of what they hold is the threshold for the others.
    near = materialize(found(probes.where(F.col("at") < FIRST)).union(asked.select("query_id", F.inline("hits"))), "ann-near")
    reached = ranked(near).where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    far = probes.where(F.col("at") >= FIRST).join(reached, "query_id", "left")
    own = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    far = far.withColumn("limit", F.least("limit", own + F.lit(float(most)) - 2 * F.col("kth"))).drop("kth")
    return ranked(near.union(found(far))).select("query_id", "rank", "vec_id", "score")


def op6(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {"op6_ann": op6}
