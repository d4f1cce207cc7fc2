"""Approximate nearest neighbours by collision counting over single projections.

Each projection keeps its vectors in a sorted array.  A query opens a window around its
own value in every array; virtual rehashing widens all windows step by step, and each
vector counts in how many windows it lies.  Vectors that reach the collision threshold
are verified by their cosine.  The search ends when the k-th best verified vector is so
near that a vector as near as it would have reached the threshold with a chance of
``Settings.sure``; until then the windows widen, at last to all vectors, but never further than
the k-th best so far asks for.  No number of candidates ends a search.

Vectors are dealt into blocks of some thousand by a hash of their id.  Every block has
its own arrays, every query meets every block, and the block's best are merged by query.
Equal vectors are one in the arrays, with their k+1 smallest distinct ids: no query returns more.

Defined cases: vectors that are null, empty, zero or hold a null or a non-finite
component, and rows without an id, take no part, neither as query nor as candidate;
vectors are compared with those of their own length; ties go to the smaller id; rows
that repeat both id and vector are one candidate, rows of one id with other vectors are
candidates of their own, and a query never returns its own id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickroll.llm.common import query, table
from clickroll.session import stored


@dataclass(frozen=True)
class Settings:
    projections: int = 64
    threshold: float = 0.6
    """Share of the projections a candidate collides in."""
    first: float = 0.25
    """Half width of the first windows, in distances of unit vectors."""
    widen: float = 1.35
    """Growth of the windows from step to step, until k vectors bound it."""
    sure: float = 0.99
    block_rows: int = 16_384
    seed: int = 11

    @property
    def reach(self) -> float:
        """Window half width, over distance, at which a vector is found with the chance ``sure``."""
        m, normal = self.projections, NormalDist()
        spread = math.sqrt(self.threshold * (1 - self.threshold) / m)
        share = min(0.999, self.threshold + normal.inv_cdf(self.sure) * spread)
        return normal.inv_cdf((1 + share) / 2)


class Block:
    """The sorted arrays of some vectors of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, settings: Settings) -> None:
        self.settings, self.ids, self.vectors = settings, ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.axes = np.random.default_rng(settings.seed).normal(size=(vectors.shape[1], settings.projections))
        places = (vectors / self.norms[:, None]) @ self.axes
        self.order = np.argsort(places, axis=0, kind="stable").T.astype(np.int32).copy()
        self.sorted = np.take_along_axis(places, self.order.T.astype(np.int64), axis=0).T.copy()
        # one long ascending array, so that one search serves all projections
        self.step = 4 * float(np.abs(places).max(initial=1.0)) + 64 * float(np.sqrt(vectors.shape[1]))
        self.shift = np.arange(settings.projections) * self.step
        self.flat = (self.sorted + self.shift[:, None]).ravel()

    def nearest(self, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest, by cosine, then id."""
        s, n = self.settings, len(self.ids)
        norm = math.sqrt(float(vector @ vector))
        centre = (vector / norm) @ self.axes
        need = math.ceil(s.threshold * s.projections)
        counts = np.zeros(n, np.int64)
        base = np.arange(s.projections) * n
        left = right = np.searchsorted(self.flat, centre + self.shift) - base
        width, enough, seen = s.first, math.inf, np.zeros(n, bool)
        at, cosines = np.zeros(0, np.int64), np.zeros(0)
        while True:
            # windows stay within their own stretch of the long array
            reach = min(width, self.step / 4)
            low = np.clip(np.searchsorted(self.flat, centre - reach + self.shift, "left") - base, 0, left)
            high = np.clip(np.searchsorted(self.flat, centre + reach + self.shift, "right") - base, right, n)
            if reach < width:
                low, high = np.zeros_like(left), np.full_like(right, n)
            parts = [self.order[i, a:b] for i, (a, b) in enumerate(zip(low.tolist(), left.tolist(), strict=True)) if a < b]
            parts += [self.order[i, a:b] for i, (a, b) in enumerate(zip(right.tolist(), high.tolist(), strict=True)) if a < b]
            if parts:
                counts += np.bincount(np.concatenate(parts), minlength=n)
            left, right = low, high
            new = np.flatnonzero((counts >= need) & ~seen)
            if len(new):
                seen[new] = True
                at = np.concatenate([at, new])
                cosines = np.concatenate([cosines, (self.vectors[new] @ vector) / (self.norms[new] * norm)])
                best = np.lexsort((self.ids[at], -cosines))[:k]
                at, cosines = at[best], cosines[best]
            if len(at) >= min(k, n):
                far = math.sqrt(max(0.0, 2 - 2 * float(cosines[-1])))
                if far * s.reach <= width:
                    return at, cosines
                # windows of this width end the search, if no nearer vector ends it before
                enough = far * s.reach
            if reach < width:
                return at, cosines
            width = min(width * s.widen, enough)


def usable(vector: str) -> Column:
    """Vectors that have a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def nearest_neighbours(vectors: DataFrame, is_query: Column, *, key: str = "vec_id", vector: str = "embedding",
                       k: int = 5, settings: Settings = Settings()) -> DataFrame:
    """The ``k`` nearest rows to each row for which ``is_query`` holds.

    Columns: ``query_id, rank`` (from 1), the key as ``match_id``, and ``score``.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull()).where(usable("v")).withColumn("h", F.xxhash64("v"))
    # per distinct vector the k+1 smallest ids: small arrays, merged before the shuffle as well
    smallest = _smallest_ids(rows, k + 1)
    # ids may be shared by vectors, so each vector gets a number of its own, fixed by being written
    distinct = stored(smallest.withColumn("no", F.monotonically_increasing_id()), "vectors")
    n_blocks = max(1, -(-distinct.count() // settings.block_rows))
    block = F.pmod(F.xxhash64("rep"), F.lit(n_blocks)).cast("int")
    held = distinct.select(F.size("v").alias("dim"), block.alias("block"), F.lit(0).alias("kind"), "rep", "ids", "v",
                           F.lit(0).alias("want"), "no")
    # besides k others, a query may meet every vector of its own id
    several = rows.select("id", "h", "v").distinct().groupBy("id").agg(F.count("*").alias("m")).where("m > 1")
    more = rows.where("asks").join(several, "id").groupBy(F.col("h").alias("h3"), F.col("v").alias("v3")).agg(
        F.max("m").cast("int").alias("m"))
    wanting = distinct.where("asks").join(more, (F.col("h") == F.col("h3")) & (F.col("v") == F.col("v3")), "left")
    asking = wanting.select(
        F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
        F.lit(1).alias("kind"), "rep", "ids", "v", (F.lit(k) + F.coalesce("m", F.lit(1))).alias("want"), "no")
    dealt = held.union(asking).repartition("dim", "block").sortWithinPartitions("dim", "block", "kind", "rep")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, reps, parts, index = None, [], [], [], None
        for batch in batches:
            d, b, kind = (batch.column(i).to_numpy() for i in range(3))
            group = np.stack([d, b, kind], axis=1)
            cuts = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(d)], strict=True):
                if start == stop:
                    continue
                some = batch.slice(start, stop - start)
                place = (int(d[start]), int(b[start]))
                rows_ = some.column(5).flatten().to_numpy(zero_copy_only=False).reshape(-1, place[0])
                if kind[start] == 0:
                    if place != now:
                        now, ids, reps, parts, index = place, [], [], [], None
                    reps.append(some.column(3).to_numpy())
                    ids += some.column(4).to_pylist()
                    parts.append(rows_)
                    continue
                if place != now:        # queries of a block that has no vectors
                    continue
                if index is None:
                    index = Block(np.concatenate(reps), np.concatenate(parts), settings)
                out = []
                for want, no, v in zip(some.column(6).to_pylist(), some.column(7).to_pylist(), rows_, strict=True):
                    at, cosines = index.nearest(v, want)
                    out += [(no, want, int(index.ids[i]), ids[i], float(c)) for i, c in zip(at, cosines, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                        pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.float64()), strict=True)],
                    names=["q", "want", "rep", "ids", "score"])

    best = dealt.mapInArrow(search, "q long, want int, rep long, ids array<long>, score double")
    # the best of each block for each vector that asks; the ``want`` best of them hold every answer
    found = best.groupBy("q", "want").agg(F.slice(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("s"), "rep", "ids"))), 1, F.col("want")).alias("f"))
    ranked = found.select("q", F.array_sort(F.flatten(F.transform(
        "f", lambda x: F.transform(x["ids"], lambda i: F.struct(x["s"].alias("s"), i.alias("id")))))).alias("f"))
    reps = distinct.where("asks").select(F.col("h").alias("h2"), F.col("v").alias("v2"), "no")
    asked = rows.where("asks").join(reps, (F.col("h") == F.col("h2")) & (F.col("v") == F.col("v2"))).select("id", "no")
    answers = asked.join(ranked, F.col("no") == F.col("q")).select(F.col("id").alias("query_id"), F.posexplode(F.slice(
        F.filter("f", lambda x: x["id"] != F.col("id")), 1, k)).alias("p", "m"))
    return answers.select("query_id", (F.col("p") + 1).alias("rank"), F.col("m.id").alias("match_id"),
                          (-F.col("m.s")).alias("score"))


def _smallest_ids(rows: DataFrame, n: int) -> DataFrame:
    """Distinct vectors with their ``n`` smallest ids; partial lists hold ``n`` ids, so no group is large."""
    # a limit on the rank is applied before the shuffle too
    ranked = rows.select("h", "v", "id").distinct().withColumn("r", F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))).where(F.col("r") <= n)
    few = ranked.groupBy("h", "v").agg(F.min("id").alias("rep"), F.array_sort(F.collect_list("id")).alias("ids"))
    asks = rows.where("asks").select(F.col("h").alias("h1"), F.col("v").alias("v1")).distinct()
    return few.join(asks, (F.col("h") == F.col("h1")) & (F.col("v") == F.col("v1")), "left").select(
        "h", "v", "rep", "ids", F.col("h1").isNotNull().alias("asks"))


@query("op2_ann")
def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    found = nearest_neighbours(vectors, F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", F.col("match_id").alias("vec_id"), "score")
