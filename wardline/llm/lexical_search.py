"""Ranked lexical search: posting lists cut into blocks of similar documents, skipped by their maxima.

Documents are ordered by the signs of a random projection of their weighted terms and dealt into shards of a few thousand,
so a shard holds neighbours and copies spread over as many shards as they fill. In a shard each term's posting list is
clustered: some of its documents are pivots, the others go to the pivot with the largest inner product, and each block stores,
for every term, the largest impact that a document of the block has (rounded up). The inner product of a query with that
summary bounds the score of each document of the block, so a block below the score to beat is left out,
and so are lists that together can't reach it. All other documents are scored exactly from their own vectors.

Only terms that are asked for get a list, as no other adds to a score. Queries are taken in blocks of a bounded
number of terms; all that goes to the driver or to every task is one such block.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.session import written

TOP = 20
SHARD_DOCS = 2_048
BLOCK_DOCS = 256
LIST_BLOCKS = 8  # of a long posting list in a shard; its blocks grow with it
SUMMARY_DOCS = 32  # a smaller block has no summary: its documents are scored
QUERY_TERMS = 1 << 16  # terms of the queries that are asked together, repeats included
SKETCH = 32
SEEDS = 64  # one shard of so many is searched first, for scores to beat
STEPS = 255  # summaries hold a term's impacts in so many steps up to its largest in the shard, rounded up
PIECE = 1 << 20

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_BORDER = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_GAP = 1 << 33
_NO_ID = np.iinfo(np.int64).max  # stands for a null id, which comes last; the keys of such rows are larger than all others
_NULL_KEYS = 1 << 62


def term_counts(text: str | None) -> Counter:
    """The terms of a whole text, with A-Z lowered; a long one is read piece by piece."""
    data = (text or "").encode("utf-8")
    counts: Counter = Counter()
    start = 0
    while start < len(data):
        border = _BORDER.search(data, start + PIECE)
        stop = border.start() if border else len(data)
        counts.update(_TERM.findall(data[start:stop].lower()))
        start = stop
    return counts


# --- queries ------------------------------------------------------------------------------------
def item_rows(items: DataFrame) -> DataFrame:
    """item (a number), item_id, terms and times of every row of ``items`` (item_id, text) that has a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * _GAP
        for batch in batches:
            rows = []
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = term_counts(text.as_py())
                if counts:
                    rows.append((number, item_id, list(counts), list(counts.values())))
                number += 1
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            columns = [*zip(*rows)] or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["item", "item_id", "terms", "times"])

    return items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").mapInArrow(
        run, "item long, item_id long, terms array<binary>, times array<bigint>")


@dataclass(frozen=True)
class Queries:
    """A block of items: bounded, so it may be sent to every task."""

    items: tuple[tuple[int, int | None, np.ndarray, np.ndarray], ...]  # item, item_id, term numbers, times
    terms: dict[bytes, int]

    @classmethod
    def of(cls, rows: pa.Table) -> Queries:
        lists = list(zip(*(rows[c].to_pylist() for c in ("item", "item_id", "terms", "times"))))
        terms = {t: i for i, t in enumerate(sorted({t for _, _, ts, _ in lists for t in ts}))}
        return cls(tuple((item, item_id, np.array([terms[t] for t in ts]), np.array(times))
                         for item, item_id, ts, times in lists), terms)


# --- documents ----------------------------------------------------------------------------------
def forward_rows(docs: DataFrame, queries: Queries) -> DataFrame:
    """key, doc_id, n (terms of the whole text), and which terms of ``queries`` it has how often."""
    shared = docs.sparkSession.sparkContext.broadcast(queries.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        key = TaskContext.get().partitionId() * _GAP
        for batch in batches:
            sizes, numbers, times, ptr = [], [], [], [0]
            for text in batch.column(1):
                counts = term_counts(text.as_py())
                sizes.append(counts.total())
                held = [t for t in counts if t in terms]
                numbers += [terms[t] for t in held]
                times += [counts[t] for t in held]
                ptr.append(len(numbers))
            keys = np.arange(key, key + batch.num_rows)
            key += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), batch.column(0), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ptr, pa.array(numbers, pa.int32())),
                 pa.ListArray.from_arrays(ptr, pa.array(times, pa.int64()))],
                names=["key", "doc_id", "n", "terms", "times"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "key long, doc_id long, n long, terms array<int>, times array<bigint>")


@dataclass(frozen=True)
class Statistics:
    """Documents with a term, all their terms, and the weight of each term of the queries."""

    documents: int
    total: int
    weights: np.ndarray

    @classmethod
    def of(cls, rows: DataFrame, size: int) -> Statistics:
        documents, total = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        found = rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toArrow()
        weights = np.zeros(size, dtype=np.int64)
        for term, df in zip(found["t"].to_pylist(), found["df"].to_pylist()):
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        return cls(documents, total, weights)

    def impacts(self, times: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What each term adds to a score, but for its weight; ``sizes`` are those of the terms' documents."""
        length = 100 - 25 + (25 * sizes * self.documents) // self.total
        return (1_000_000_000 * times) // (1_000 * times + 12 * length)


@lru_cache(maxsize=2)
def _directions(size: int) -> np.ndarray:
    return np.random.default_rng(12).standard_normal((size, SKETCH), dtype=np.float32)


def sketches(terms: np.ndarray, values: np.ndarray, ptr: np.ndarray, size: int) -> np.ndarray:
    """Random projections of the documents' vectors, made as long as each other; all have a term."""
    out = np.add.reduceat(_directions(size)[terms] * values.astype(np.float32)[:, None], ptr[:-1], axis=0)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and where each row's begin."""
    ptr = column.offsets.to_numpy()
    return column.flatten().to_numpy(), ptr - ptr[0]


def build_index(rows: DataFrame, statistics: Statistics, *, shard_docs: int = SHARD_DOCS,
                block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row for each shard of ``rows`` (see ``forward_rows``), with every document that has a term of the queries."""
    size = len(statistics.weights)
    shared = rows.sparkSession.sparkContext.broadcast(statistics)

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            terms, ptr = _lists(batch.column(3))
            sizes = np.repeat(batch.column(2).to_numpy(), np.diff(ptr))
            impacts = known.impacts(_lists(batch.column(4))[0], sizes)
            signs = sketches(terms, impacts * known.weights[terms], ptr, size)[:, :16] > 0
            code = (signs << np.arange(16)).sum(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(code), *batch.columns[:2], batch.column(3),
                 pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(impacts.astype(np.int32)))],
                names=["code", "key", "doc_id", "terms", "impacts"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        number = TaskContext.get().partitionId() * _GAP
        waiting: list[pa.RecordBatch] = []

        def made(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            terms, ptr = _lists(table["terms"].chunk(0))
            impacts, _ = _lists(table["impacts"].chunk(0))
            ids = table["doc_id"]
            keys = table["key"].to_numpy() + _NULL_KEYS * ids.is_null().to_numpy()
            return Shard.build(number, keys, ids.fill_null(_NO_ID).to_numpy(), ptr, terms, impacts.astype(np.int64),
                               known.weights, block_docs).batch()

        for batch in batches:
            while batch.num_rows:
                room = shard_docs - sum(b.num_rows for b in waiting)
                waiting.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in waiting) == shard_docs:
                    yield made(pa.Table.from_batches(waiting))
                    waiting, number = [], number + 1
        if waiting:
            yield made(pa.Table.from_batches(waiting))

    coded = rows.filter(F.size("terms") > 0).mapInArrow(
        ordered, "code int, key long, doc_id long, terms array<int>, impacts array<int>")
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), statistics.documents // (4 * shard_docs))
    return coded.repartitionByRange(parts, "code", "key").sortWithinPartitions("code", "key").mapInArrow(
        shards, "shard long, " + ", ".join(f"{n} binary" for n in Shard.ARRAYS))


@dataclass(frozen=True)
class Shard:
    """Forward vectors, and each term's list in blocks with summaries."""

    number: int
    keys: np.ndarray
    ids: np.ndarray
    ptr: np.ndarray  # of each document's vector
    terms: np.ndarray
    impacts: np.ndarray
    listed: np.ndarray  # the terms that have a list, ascending
    most: np.ndarray  # and the largest impact in it
    list_ptr: np.ndarray  # of its blocks
    block_ptr: np.ndarray  # of the documents of a block
    members: np.ndarray
    summary_ptr: np.ndarray  # of a block's summary; none if it is empty
    gaps: np.ndarray  # from a term of the summary to the next; the first from -1
    largest: np.ndarray  # in steps

    ARRAYS = {"keys": np.int64, "ids": np.int64, "ptr": np.int32, "terms": np.int32, "impacts": np.int32,
              "listed": np.int32, "most": np.int32, "list_ptr": np.int32, "block_ptr": np.int32, "members": np.int32,
              "summary_ptr": np.int32, "gaps": np.uint8, "largest": np.uint8}

    @classmethod
    def build(cls, number: int, keys: np.ndarray, ids: np.ndarray, ptr: np.ndarray, terms: np.ndarray,
              impacts: np.ndarray, weights: np.ndarray, block_docs: int) -> Shard:
        """``terms`` and ``impacts`` are the vectors of all documents in a row; each document has one at least."""
        size = len(weights)
        sketch = sketches(terms, impacts * weights[terms], ptr, size)
        order = np.argsort(terms, kind="stable")
        docs = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))[order]
        listed, first = np.unique(terms[order], return_index=True)
        most = np.maximum.reduceat(impacts[order], first)
        steps = np.ones(size, dtype=np.int64)
        steps[listed] = step_sizes(most)
        lists, block_sizes, members, summaries = [0], [], [], []
        for list_docs in np.split(docs, first[1:]):
            blocks = clustered(list_docs, sketch, block_docs)
            lists.append(lists[-1] + len(blocks))
            block_sizes += [len(b) for b in blocks]
            members += blocks
            summaries += summarised(blocks, ptr, terms, impacts, steps)
        none = np.empty(0, np.int64)
        return cls(number, keys, ids, ptr, terms, impacts, listed, most, np.array(lists), np.cumsum([0, *block_sizes]),
                   np.concatenate(members or [none]), np.cumsum([0, *[len(t) for t, _ in summaries]]),
                   *(np.concatenate([s[k] for s in summaries] or [none]) for k in (0, 1)))

    def batch(self) -> pa.RecordBatch:
        values = [np.ascontiguousarray(getattr(self, n), dtype=t).tobytes() for n, t in self.ARRAYS.items()]
        return pa.RecordBatch.from_arrays([pa.array([self.number], pa.int64()), *[pa.array([v], pa.binary()) for v in values]],
                                          names=["shard", *self.ARRAYS])

    @classmethod
    def read(cls, row: dict) -> Shard:
        return cls(row["shard"], *[np.frombuffer(row[n], dtype=t) for n, t in cls.ARRAYS.items()])

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores; ``weights`` holds the query's weight of every term."""
        lengths = self.ptr[docs + 1] - self.ptr[docs]
        starts = np.cumsum(lengths) - lengths
        at = np.repeat(self.ptr[docs] - starts, lengths) + np.arange(lengths.sum())
        return np.add.reduceat(weights[self.terms[at]] * self.impacts[at], starts)

    def stepped(self, weights: np.ndarray) -> np.ndarray:
        """What one step of a summary adds to a bound, for every term."""
        out = weights.copy()
        out[self.listed] *= step_sizes(self.most)
        return out

    def bounds(self, a: int, b: int, stepped: np.ndarray) -> np.ndarray:
        """Of the blocks from ``a`` to ``b``: no document of a block scores more. Without a summary there is no bound."""
        ptr = self.summary_ptr[a:b + 1]
        out = np.full(b - a, np.iinfo(np.int64).max)
        some = ptr[1:] > ptr[:-1]
        if some.any():
            span, first = slice(ptr[0], ptr[-1]), (ptr[:-1] - ptr[0])[some]
            gaps = self.gaps[span].astype(np.int64)
            terms = np.cumsum(gaps) - 1
            terms -= np.repeat(terms[first] - gaps[first] + 1, np.diff(np.append(first, len(gaps))))
            out[some] = np.add.reduceat(stepped[terms] * self.largest[span], first)
        return out

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Puts every document that may belong to the best into ``best``; ``terms`` are those of the query."""
        at = np.searchsorted(self.listed, terms)
        here = at < len(self.listed)
        at = at[here][self.listed[at[here]] == terms[here]]
        at = at[weights[self.listed[at]] > 0]
        ceilings = weights[self.listed[at]] * self.most[at].astype(np.int64)
        order = np.argsort(-ceilings, kind="stable")
        rest = np.cumsum(ceilings[order][::-1])[::-1]  # what a list and all after it can add
        seen, stepped = np.zeros(len(self.keys), dtype=bool), self.stepped(weights)
        for number, left in zip(at[order].tolist(), rest.tolist()):
            if left < best.least:
                break  # a document in none of the lists before scores less
            a, b = self.list_ptr[number], self.list_ptr[number + 1]
            blocks = np.flatnonzero(self.bounds(a, b, stepped) >= best.least) + a
            if not len(blocks):
                continue
            lengths = self.block_ptr[blocks + 1] - self.block_ptr[blocks]
            places = np.repeat(self.block_ptr[blocks] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            docs = self.members[places]
            docs = docs[~seen[docs]]
            if len(docs):
                seen[docs] = True
                best.add(self.scores(docs, weights), self.ids[docs], self.keys[docs])


def clustered(docs: np.ndarray, sketch: np.ndarray, block_docs: int) -> list[np.ndarray]:
    """``docs`` in blocks around evenly spaced pivots; a block with many more than its share is cut."""
    share = max(block_docs, -(-len(docs) // LIST_BLOCKS))
    if len(docs) <= share:
        return [docs]
    pivots = docs[::share]
    nearest = np.argmax(sketch[docs] @ sketch[pivots].T, axis=1)
    order = np.argsort(nearest, kind="stable")
    blocks = np.split(docs[order], np.flatnonzero(np.diff(nearest[order])) + 1)
    return [b[i:i + 4 * share] for b in blocks for i in range(0, len(b), 4 * share)]


def step_sizes(most: np.ndarray) -> np.ndarray:
    return -(-most.astype(np.int64) // STEPS)


def summarised(blocks: list[np.ndarray], ptr: np.ndarray, terms: np.ndarray, impacts: np.ndarray, steps: np.ndarray
               ) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each block the gaps between its terms and each term's largest impact, in steps; empty for small blocks.

    A gap takes one byte; a longer one has stops on the way, with zero as their largest.
    """
    out = []
    for block in blocks:
        if len(block) < SUMMARY_DOCS:
            out.append((np.empty(0, np.int64), np.empty(0, np.int64)))
            continue
        lengths = ptr[block + 1] - ptr[block]
        at = np.repeat(ptr[block] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        largest = np.zeros(len(steps), dtype=np.int64)
        np.maximum.at(largest, terms[at], impacts[at])
        held = np.flatnonzero(largest)
        gaps = np.diff(held, prepend=-1)
        stops = (gaps - 1) // 255
        place = np.arange(len(held)) + np.cumsum(stops)
        coded = np.full(len(held) + stops.sum(), 255)
        most = np.zeros(len(coded), dtype=np.int64)
        coded[place] = gaps - 255 * stops
        most[place] = -(-largest[held] // steps[held])
        out.append((coded, most))
    return out


class Best:
    """The highest scores of an item so far; ties go to the smaller id, then to the smaller key."""

    def __init__(self, top: int, floor: int):
        self.top, self.floor = top, max(floor, 1)
        self.rows = np.empty((0, 3), dtype=np.int64)

    @property
    def least(self) -> int:
        """A document below this score is not among the best."""
        return max(self.floor, int(self.rows[-1, 0])) if len(self.rows) == self.top else self.floor

    def add(self, scores: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        enough = scores >= self.least
        if enough.any():
            rows = np.concatenate([self.rows, np.column_stack([scores, ids, keys])[enough]])
            self.rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))[:self.top]]


def ask(index: DataFrame, queries: Queries, weights: np.ndarray, top: int, floors: dict[int, int]) -> DataFrame:
    """item, item_id, doc_id, score and key of each task's best; ``floors`` are scores that the best reach at least."""
    shared = index.sparkSession.sparkContext.broadcast((queries.items, weights, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, floors = shared.value
        best = [Best(top, floors.get(item, 1)) for item, *_ in items]
        asked = np.zeros(len(weights), dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard.read(batch.slice(i, 1).to_pylist()[0])
                for (_, _, terms, times), found in zip(items, best):
                    asked[terms] = times * weights[terms]
                    shard.search(terms, asked, found)
                    asked[terms] = 0
        for (item, item_id, _, _), found in zip(items, best):
            if len(found.rows):
                k = len(found.rows)
                score, ids, keys = found.rows.T
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * k, pa.int64()), pa.array([item_id] * k, pa.int64()),
                     pa.array(ids, mask=keys >= _NULL_KEYS), pa.array(score), pa.array(keys)],
                    names=["item", "item_id", "doc_id", "score", "key"])

    return index.mapInArrow(run, "item long, item_id long, doc_id long, score long, key long")


def ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP, query_terms: int = QUERY_TERMS,
           shard_docs: int = SHARD_DOCS, block_docs: int = BLOCK_DOCS, seeds: int = SEEDS) -> DataFrame:
    """The ``top`` rows of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text) with a score above 0.

    item_id, rank (from 1), doc_id, score; equal scores by ascending doc_id, nulls last. A row of either table stands for itself, also
    if its id is null or repeated. A null text has no term; without a term in common there is no row. Other columns are
    not read. The scores are exact and do not depend on the last three parameters.
    """
    asked = written(item_rows(items), "search-items")
    spark = docs.sparkSession
    terms = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = -(-terms // query_terms)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for number in range(blocks):
        queries = Queries.of(asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).toArrow())
        if not queries.items:
            continue
        rows = written(forward_rows(docs, queries), "search-terms")
        statistics = Statistics.of(rows, len(queries.terms))
        if not statistics.documents:
            continue
        index = written(build_index(rows, statistics, shard_docs=shard_docs, block_docs=block_docs), "search-index")
        first = ranked(ask(index.filter(F.pmod(F.xxhash64("shard"), F.lit(seeds)) == 0), queries, statistics.weights, top, {}), top)
        floors = {r.item: r.score for r in first.filter(F.col("rank") == top).select("item", "score").collect()}
        found = ranked(ask(index, queries, statistics.weights, top, floors), top)
        out = out.unionByName(written(found.select("item_id", "rank", "doc_id", "score"), "search-results"))
    return out
