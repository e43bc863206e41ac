"""Comparing rankings: the nearest vectors of many queries, what they are worth, and whether one ranking is better.

Queries are dealt into blocks and vectors into parts; a task holds one block
against one part as two matrices and keeps the nearest of each query, so what
travels on is queries times parts times most, whatever the number of vectors.
The bootstrap is Poisson's: a query counts in a resample as often as a hash of
both says, so resamples are sums that combine before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Queries of a block, and vectors of a part, where these are few.
BLOCK, PART = 1_024, 50_000
#: Blocks, and parts, before either grows beyond that, and the rows to which it may grow.
DEALT, MOST_ROWS = 8, 16_384
#: Queries whose scores a task holds at once.
AT_ONCE = 256
RESAMPLES = 200


def _matrix(table: pa.Table, dims: int) -> np.ndarray:
    rows = table.column("_v").combine_chunks()
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(rows), -1)[:, :dims].astype(np.float64) if len(rows) else np.zeros((0, dims))


def _scored(asked: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each query with the scores of all vectors, its own being the least."""
    for at in range(0, len(asked), AT_ONCE):
        some = asked[at : at + AT_ONCE]
        scores = np.round(queries[at : at + AT_ONCE] @ vectors.T, 6)
        scores[some[:, None] == ids[None]] = -np.inf
        yield from zip(some.tolist(), scores, strict=True)


def _groups(rows: int, size: int) -> int:
    """Into how many groups of that size rows are dealt; more than DEALT only where these would have more than MOST_ROWS."""
    return max(1, min(math.ceil(rows / size), max(DEALT, math.ceil(rows / MOST_ROWS))))


def _nearest(dims: int, most: int):
    def near(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        asked, ids = queries.column("_id").to_numpy(), vectors.column("_id").to_numpy()
        found: list[list] = [[], [], []]
        if len(asked) and len(ids):
            for query, own in _scored(asked, _matrix(queries, dims), ids, _matrix(vectors, dims)):
                # more than most where scores tie at the edge, then by id
                edge = np.partition(own, -most)[-most] if len(own) > most else -np.inf
                some = np.flatnonzero((own >= edge) & (own > -np.inf))
                some = some[np.lexsort((ids[some], -own[some]))][:most]
                found[0] += [query] * len(some)
                found[1] += ids[some].tolist()
                found[2] += own[some].tolist()
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(x, k) for x, k in zip(found, kinds, strict=True)], ["query_id", "vec_id", "score"])

    return near


def nearest(vectors: DataFrame, queries: DataFrame, dims: int, most: int = 10, *, block: int = BLOCK, part: int = PART, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, vec_id, score, rank): each query's most nearest vectors by the product of the first dims numbers, itself left out, ties by id.

    Ids are whole numbers; vectors are of one length and without nulls.
    Vectors are copied for each block of queries and queries for each part of
    vectors; what a task holds is bounded by both. Groups of block and part
    rows grow to MOST_ROWS before there are more than DEALT, so up to
    DEALT * MOST_ROWS rows what is copied grows no faster than they do.
    """
    blocks, parts = (_groups(d.count(), n) for d, n in ((queries, block), (vectors, part)))
    of = lambda d: d.select(F.col(id_col).cast("long").alias("_id"), F.slice(vector_col, 1, dims).alias("_v"))
    deal = lambda n: F.pmod(F.xxhash64("_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = of(queries).withColumn("_q", deal(blocks)).withColumn("_p", every(parts))
    there = of(vectors).withColumn("_p", deal(parts)).withColumn("_q", every(blocks))
    met = asked.groupBy("_q", "_p").cogroup(there.groupBy("_q", "_p")).applyInArrow(_nearest(dims, most), "query_id long, vec_id long, score double")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def metrics(ranked: DataFrame, labels: DataFrame, most: int = 10) -> DataFrame:
    """(query_id, hits, recall, ndcg) of rankings, a vector being right if it has the query's label.

    recall is of all vectors with the label, at most as many as a ranking has
    room for; ndcg weighs a hit by the logarithm of its rank. A query whose
    label no other vector has scores 0. labels (vec_id, label) has each id once.
    """
    own = labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("_own"))
    sizes = labels.groupBy(F.col("label").alias("_own")).agg(F.count("*").alias("_n"))
    gain = F.when(F.col("label") == F.col("_own"), 1 / F.log2(F.col("rank") + 1)).otherwise(0.0)
    told = ranked.join(labels.select("vec_id", "label"), "vec_id").join(own, "query_id").groupBy("query_id", "_own").agg(F.count_if(F.col("label") == F.col("_own")).alias("hits"), F.sum(gain).alias("_dcg"))
    room = F.least(F.col("_n") - 1, F.lit(most))
    ideal = F.aggregate(F.sequence(F.lit(1), room.cast("int")), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1))
    rate = lambda x, of: F.round(F.when(room > 0, x / of).otherwise(0.0), 6)
    return told.join(sizes, "_own").select("query_id", "hits", rate(F.col("hits"), room).alias("recall"), rate(F.col("_dcg"), F.when(room > 0, ideal)).alias("ndcg"))


#: The chances of a Poisson variable of mean 1 to be at most 0, 1, 2 ...
_POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(9)]


def _times(query: Column, resample: Column) -> Column:
    """How often a query counts in a resample: the same on every run."""
    digits = F.substring(F.md5(F.concat_ws(":", query.cast("string"), resample.cast("string")).cast("binary")), 1, 8)
    share = F.conv(digits, 16, 10).cast("double") / float(1 << 32)
    return sum(((share >= chance).cast("int") for chance in _POISSON), F.lit(0))


def bootstrap(one: DataFrame, other: DataFrame, measure: str = "ndcg", *, resamples: int = RESAMPLES, share: float = 0.95) -> DataFrame:
    """(queries, difference, low, high): by how much other's mean measure is above one's over the queries that both have, and the interval that holds so great a share of the resamples."""
    both = one.select("query_id", F.col(measure).alias("_one")).join(other.select("query_id", F.col(measure).alias("_other")), "query_id").select("query_id", (F.col("_other") - F.col("_one")).alias("_d"))
    drawn = both.withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(resamples)))).withColumn("_t", _times(F.col("query_id"), F.col("_r")))
    means = drawn.groupBy("_r").agg(F.round(F.sum(F.col("_t") * F.col("_d")) / F.sum("_t"), 6).alias("_m")).where("_m IS NOT NULL")
    outside = (1 - share) / 2
    # as many rows as there are resamples
    ends = means.agg(F.sort_array(F.collect_list("_m")).alias("_l"))
    place = lambda p: F.get("_l", F.floor(F.lit(p) * (F.size("_l") - 1)).cast("int"))
    whole = both.agg(F.count("*").alias("queries"), F.round(F.avg("_d"), 6).alias("difference"))
    return whole.crossJoin(F.broadcast(ends.select(place(outside).alias("low"), place(1 - outside).alias("high"))))


@dataclass(frozen=True)
class Comparison:
    """A challenger's difference to the champion with its interval."""

    queries: int
    difference: float | None
    low: float | None
    high: float | None

    @property
    def better(self) -> bool:
        """Whether the whole interval is above zero."""
        return self.low is not None and self.low > 0


def compare(vectors: DataFrame, queries: DataFrame, champion: int, challenger: int, *, most: int = 10, measure: str = "ndcg", **options) -> Comparison:
    """Ranks a snapshot for all queries by the first champion and the first challenger dimensions, and says which is better; nothing is promoted."""
    labels = vectors.select("vec_id", "label")
    one, other = (metrics(nearest(vectors, queries, dims, most), labels, most) for dims in (champion, challenger))
    return Comparison(*bootstrap(one, other, measure, **options).first())


def may_be_promoted(comparisons: Sequence[Comparison]) -> bool:
    """A gate: every comparison that was made is better."""
    return bool(comparisons) and all(c.better for c in comparisons)
