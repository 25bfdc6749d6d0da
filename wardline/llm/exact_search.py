"""Exact top-k search by inner product: a Voronoi join of queries and data.

Vectors become whole numbers, floor(scale * x). With one more coordinate that lifts every
vector to the same length, the largest inner product is the smallest distance, so metric
bounds hold: every row belongs to the cell of its nearest pivot; summaries of the cells bound the
distance of the k-th neighbour for each group of queries, and a data row is sent to a group only
if the triangle inequality cannot rule it out. Inside a group the search is plain arithmetic.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.session import written

PIVOTS = 48
GROUP_QUERIES = 512
CHUNK_ROWS = 16_384
BLOCK = 256
RESULT = "query_id long, rank int, vec_id long, score long"


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of lists of equal length without nulls as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and floor(scale * x) of every component, as double; only whole, finite vectors."""
    x = F.col("embedding").cast("array<double>")
    usable = (F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)
              & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("double"))
    return vectors.filter(usable).select("vec_id", whole.alias("v"))


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products as long: exact in floating point while they stay below 2**53."""
    most = (np.abs(queries).max(initial=0) * np.abs(data).max(initial=0) * queries.shape[1])
    if most < 2.0 ** 53:
        return (queries @ data.T).astype(np.int64)
    return queries.astype(np.int64) @ data.astype(np.int64).T


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def _lifted(v: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest * longest - (v * v).sum(axis=1), 0.0))
    return np.hstack([v, rest[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def exact_top_k(vectors: DataFrame, *, k: int = 5, every: int = 50, scale: int = 256,
                pivots: int = PIVOTS, group_queries: int = GROUP_QUERIES,
                chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k highest inner products.

    ``vectors`` has vec_id and embedding; other columns play no part. Queries are the rows whose
    vec_id is divisible by ``every``; candidates are all rows but the query's own; ties go to the
    smaller vec_id. Rows without a vec_id, and vectors that are null, empty or hold a null or
    non-finite component take no part; a query meets only vectors of its own length. Of rows that
    repeat a vec_id the smallest vector counts. Products must fit a long. Empty tables give an
    empty result.

    What goes to the driver and to every task is bounded by parameters: ``pivots`` vectors, and
    for each pair of cells the distance that decides. Queries are solved in groups of about
    ``group_queries`` and data in chunks of about ``chunk_rows``, so a vector that fills a third
    of the table is spread over many tasks.
    """
    spark = vectors.sparkSession
    whole = written(integer_vectors(vectors, scale).groupBy("vec_id").agg(F.min("v").alias("v")),
                    "exact-vectors")
    lengths = [r[0] for r in whole.select(F.size("v")).distinct().limit(1025).collect()]
    if len(lengths) > 1024:
        raise ValueError("vectors of more than 1,024 different lengths")
    out = spark.createDataFrame([], RESULT)
    for n in sorted(lengths):
        out = out.unionByName(_same_length(whole.filter(F.size("v") == n), k, every, pivots,
                                           group_queries, chunk_rows))
    return out


def _same_length(whole, k, every, pivots, group_queries, chunk_rows):
    spark = whole.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, longest = whole.agg(F.count(F.lit(1)), F.max(square)).first()
    longest = math.sqrt(longest) * (1 + 1e-9)
    drawn = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("v").collect()
    centres = _lifted(np.unique(np.array([r.v for r in drawn]), axis=0), longest)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(1))
            if not len(v):
                continue
            asks = np.flatnonzero(batch.column(0).to_numpy() % every == 0)
            for kind, rows, points in (
                    (0, np.arange(len(v)), _lifted(v, longest)),
                    (1, asks, np.hstack([v, np.zeros((len(v), 1))])[asks])):  # not lifted
                far = _distances(points, centres)
                cell = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)),
                     pa.array(np.full(len(rows), kind, np.int32)),
                     pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(rows)), cell])],
                    names=["vec_id", "v", "kind", "cell", "far"])

    cells = written(whole.mapInArrow(
        assign, "vec_id long, v array<double>, kind int, cell int, far double"), "exact-cells")
    data, queries = cells.filter("kind = 0"), cells.filter("kind = 1")
    asked_cells = {r.cell: (r.far, r.n) for r in queries.groupBy("cell").agg(
        F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect()}
    if not asked_cells:
        return spark.createDataFrame([], RESULT)
    # the nearest rows of each cell to its pivot, one more than k: a query is no candidate of its own
    nearest = data.select("cell", "far").withColumn("_n", F.row_number().over(
        Window.partitionBy("cell").orderBy("far"))).filter(F.col("_n") <= k + 1).collect()
    plan, parts = _plan(centres, asked_cells, nearest, k, longest, group_queries)
    sets = spark.createDataFrame([(c, s) for c, (s, _) in parts.items()], "cell int, set int")
    splits = spark.createDataFrame(
        sorted({(s, count) for s, count in parts.values()}), "set int, parts int")
    plan = spark.createDataFrame(plan, "set int, cell int, least double").join(splits, "set")
    chunks = max(1, math.ceil(n / chunk_rows))

    asked = (queries.join(F.broadcast(sets), "cell").join(F.broadcast(splits), "set")
             .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
             .select("set", "part", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
                     F.col("vec_id").alias("query_id"), F.col("v").alias("q")))
    sent = (data.join(F.broadcast(plan), "cell").filter(F.col("far") >= F.col("least"))
            .select("set", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                    F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(chunks)).cast("int").alias("chunk"),
                    "vec_id", "v"))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids, data = right["vec_id"].to_numpy(), matrix(right["v"])
            query_ids, points = left["query_id"].to_numpy(), matrix(left["q"])
            for start in range(0, len(points), BLOCK):
                scores = products(points[start:start + BLOCK], data)
                for query, line in zip(query_ids[start:start + BLOCK], scores):
                    others = np.flatnonzero(ids != query)
                    top = others[best(ids[others], line[others], k)]
                    rows.extend((int(query), int(ids[i]), int(line[i])) for i in top)
        return pa.Table.from_pylist(
            [dict(zip(("query_id", "vec_id", "score"), r)) for r in rows], schema=pa.schema(
                [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]))

    keys = ["set", "part", "chunk"]
    found = asked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(
        solve, "query_id long, vec_id long, score long")
    return ranked(found, k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k highest scores of each query_id, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _plan(centres, asked, nearest, k, longest, group_queries):
    """For each set of query cells, the least distance from its pivot a data row must have.

    A query q of cell p, a row s of cell c: d(q, s) is at most radius(p) + d(p, c) + d(c, s), which bounds
    the k-th distance of every query of p; and d(q, s) is at least d(p, c) - radius(p) - d(c, s)
    and at least d(c, s) - d(p, c) - radius(p). A row must be near enough by both.
    """
    between = _distances(centres, centres)
    slack = 1e-6 * (1.0 + longest)
    sets: dict[int, tuple[int, int]] = {}
    filled, current = 0, 0
    order = sorted(asked, key=lambda c: (between[min(asked), c], c))  # neighbours share a set
    for cell in order:
        count = asked[cell][1]
        if filled and filled + count > group_queries:
            current, filled = current + 1, 0
        sets[cell] = (current, 0)
        filled += count
    sizes: dict[int, int] = {}
    for cell, (number, _) in sets.items():
        sizes[number] = sizes.get(number, 0) + asked[cell][1]
    parts = {c: (number, math.ceil(sizes[number] / group_queries))
             for c, (number, _) in sets.items()}
    least: dict[tuple[int, int], float] = {}
    for cell, (radius, _) in asked.items():
        bounds = sorted(radius + between[cell, r.cell] + r.far for r in nearest)
        most = bounds[k] if len(bounds) > k else math.inf
        for other in {r.cell for r in nearest}:
            key = (sets[cell][0], int(other))
            bound = float(between[cell, other] - radius - most - slack)
            least[key] = min(least.get(key, math.inf), bound)
    return [(number, cell, bound) for (number, cell), bound in least.items()], parts
