"""Quality scores: hashed word n-grams, a logistic model trained by follow-the-regularised-leader.

A text is the set of its hashed n-grams: one and two words with A-Z lowered, and one and two word shapes (runs of
upper case, of lower case, of digits, or of one other byte; ``!Ab1`` and ``!Xyz22`` have one shape). Each counts
once, and a text's vector has length one. A score is the logistic function of a sparse dot product.

Training: shards of a bounded sample take steps one text at a time, each from the same state of the leader; between
rounds Spark averages what the shards that met a feature have changed. The state has a fixed number of
features, so it is small on the driver and in the tasks whatever the corpus holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import crc_remainder, mix, quoted, slices, span_hashes, text_bytes
from wardline.session import written

BITS = 18
MAX_ROWS = 20_000
SHARDS = 8
ROUNDS = 6
THRESHOLD = 0.3
PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 65, 97, 48, 97


@dataclass(frozen=True)
class Rates:
    """Step size ``alpha / (beta + sqrt(sum of squared slopes))``, and how hard weights are held at zero."""

    alpha: float = 16.0
    beta: float = 1.0
    lasso: float = 0.01
    ridge: float = 0.0


@dataclass(frozen=True)
class Model:
    """``offset`` is the log odds of the sample's share of ones; ``weights`` belong to the hashed features."""

    weights: np.ndarray
    offset: float

    def scores(self, sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """From the sums of the weights of texts' features and the numbers of features."""
        odds = self.offset + sums / np.sqrt(np.maximum(sizes, 1))
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of all texts start and end, and each word's text; a word ends with its text."""
    inside = np.ones(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~_SPACE[data]
    middle = inside[1:-1]
    opening, closing = middle & ~inside[:-2], middle & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opening[edges] |= middle[edges]
    closing[edges - 1] |= middle[edges - 1]
    starts = np.flatnonzero(opening)
    return starts, np.flatnonzero(closing) + 1, np.searchsorted(offsets, starts, "right") - 1


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words' shapes."""
    classes = _CLASS[data]
    new = np.ones(len(data) + 1, dtype=bool)
    new[1:-1] = classes[1:] != classes[:-1]
    new[starts] = True
    place = np.cumsum(new) - new  # of each byte among those that begin a run
    return span_hashes(classes[new[:-1]], place[starts], place[ends - 1] + new[ends - 1])


def _grams(hashes: np.ndarray, text: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of single words and of pairs in one text, with their texts."""
    one = mix(hashes + np.uint64(kind))
    joined = mix(hashes[:-1] * np.uint64(3) + mix(hashes[1:] + np.uint64(kind)))[text[:-1] == text[1:]]
    return np.concatenate([one, joined]), np.concatenate([text, text[:-1][text[:-1] == text[1:]]])


def features(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of each text in a row, and where each text's begin; null has none."""
    data, offsets = text_bytes(column)
    ptr = np.zeros(len(column) + 1, dtype=np.int64)
    if not len(data):
        return np.empty(0, np.int64), ptr
    starts, ends, text = _spans(data, offsets)
    if not len(starts):
        return np.empty(0, np.int64), ptr
    kinds = [_grams(span_hashes(_LOWER[data], starts, ends), text, 1), _grams(_shapes(data, starts, ends), text, 2)]
    places = np.concatenate([h >> np.uint64(64 - bits) for h, _ in kinds]).astype(np.int64)
    keys = np.unique((np.concatenate([t for _, t in kinds]) << bits) | places)
    ptr[1:] = np.searchsorted(keys, np.arange(1, len(column) + 1) << bits)
    return keys & ((1 << bits) - 1), ptr


def pieces(text: str, limit: int) -> Iterator[str]:
    """``text`` cut before words; a piece begins with the last word of the one before, so that no pair is lost."""
    data = text.encode("utf-8")
    space = np.flatnonzero(_SPACE[np.frombuffer(data, dtype=np.uint8)])
    start, last = 0, b""
    while start < len(data):
        at = int(np.searchsorted(space, start + limit))
        stop = int(space[at]) if at < len(space) else len(data)
        yield (last + b" " + data[start:stop]).decode("utf-8")
        last = (data[start:stop].rsplit(None, 1)[-1:] or [last])[0]
        start = stop + 1


def long_features(text: str, bits: int = BITS, limit: int = PIECE_BYTES) -> np.ndarray:
    """The distinct features of one text of any length, piece by piece."""
    met = np.zeros(1 << bits, dtype=bool)
    for piece in pieces(text, limit):
        met[features(pa.array([piece], pa.large_string()), bits)[0]] = True
    return np.flatnonzero(met)


def _batches(batches: Iterator[pa.RecordBatch], column: str, bits: int
             ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of about a megabyte, or one text, with the features of their texts."""
    for batch in slices(batches, column):
        texts = batch.column(batch.schema.get_field_index(column))
        if batch.num_rows == 1 and texts.nbytes > 2 * PIECE_BYTES and texts[0].is_valid:
            found = long_features(texts[0].as_py(), bits)
            yield batch, found, np.array([0, len(found)])
        else:
            yield batch, *features(texts, bits)


def sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """key, target and text of at most ``max_rows`` labelled documents, the first in the order of a hash of the id.

    Labels of one id count as their mean; labels without an id or a value do not count. Of different texts under
    one id, that with the smallest hash is taken; a null text is empty. No text is shuffled but those taken.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.avg("quality").alias("target"))
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                      F.coalesce("text", F.lit("")).alias("text")).filter("doc_id IS NOT NULL")
    key = F.xxhash64("doc_id")
    present = written(known.join(ids.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("key", key), "labelled")
    total = present.count()
    if total > max_rows:  # first by a bound of the key that more than enough rows pass, so that one task sorts few
        enough = max_rows + 10 * math.isqrt(max_rows) + 10
        bound = -(1 << 63) + int((1 << 64) * min(1.0, enough / total))
        present = present.filter(F.col("key") < min(bound, (1 << 63) - 1)).orderBy("key").limit(max_rows)
    taken = ids.join(F.broadcast(present), "doc_id").groupBy("doc_id").agg(
        F.min_by(F.struct("key", "target", "text"), F.xxhash64("text")).alias("row"))
    return written(taken.select("row.*"), "quality-sample")


def train(docs: DataFrame, labels: DataFrame, *, bits: int = BITS, max_rows: int = MAX_ROWS, rounds: int = ROUNDS,
          rates: Rates = Rates()) -> Model:
    """A model of ``labels`` (doc_id, quality 0 or 1) over the texts of ``docs`` (doc_id, text).

    Learns from at most ``max_rows`` labelled documents, chosen by a hash of the id. Without any label every score is
    one half; with one value only, scores stand near it.
    """
    rows = sample(docs, labels, max_rows)
    ones, count = rows.agg(F.coalesce(F.sum("target"), F.lit(0.0)), F.count(F.lit(1))).first()
    offset = math.log((ones + 1) / (count - ones + 1))
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    context = docs.sparkSession.sparkContext
    # kept between rounds: else each of them shuffles the sample again, and all those shuffles stay on disk
    dealt = rows.repartition(SHARDS, "key").sortWithinPartitions("key").persist()
    for _ in range(rounds if count else 0):
        state = context.broadcast((z, n))

        def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            z0, n0 = state.value
            yield from changes(z0, n0, steps(_batches(batches, "text", bits), offset, z0.copy(), n0.copy(), rates))

        moved = dealt.mapInArrow(shard, "place int, z double, n double").groupBy("place").agg(
            F.avg("z").alias("z"), F.avg("n").alias("n")).toArrow()  # one row a feature at most
        places = moved["place"].to_numpy()
        z[places] += moved["z"].to_numpy()
        n[places] += moved["n"].to_numpy()
        state.unpersist()
    dealt.unpersist()
    return Model(weights(z, n, rates), offset)


def weights(z: np.ndarray, n: np.ndarray, rates: Rates) -> np.ndarray:
    """The leader: what minimises the linearised losses so far and both penalties."""
    pull = np.sign(z) * np.maximum(np.abs(z) - rates.lasso, 0)
    return -pull / ((rates.beta + np.sqrt(n)) / rates.alpha + rates.ridge)


def steps(found, offset: float, z: np.ndarray, n: np.ndarray, rates: Rates) -> tuple[np.ndarray, np.ndarray]:
    """One step for each text, in the order given."""
    for batch, places, ptr in found:
        targets = batch.column(batch.schema.get_field_index("target")).to_pylist()
        for i, target in enumerate(targets):
            at = places[ptr[i]:ptr[i + 1]]
            if not len(at):
                continue
            value = 1 / math.sqrt(len(at))
            now = weights(z[at], n[at], rates)
            odds = offset + value * now.sum()
            slope = (1 / (1 + math.exp(-max(-700.0, min(700.0, odds)))) - target) * value
            sigma = (np.sqrt(n[at] + slope * slope) - np.sqrt(n[at])) / rates.alpha
            z[at] += slope - sigma * now
            n[at] += slope * slope
    return z, n


def changes(z0: np.ndarray, n0: np.ndarray, after: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    z, n = after
    places = np.flatnonzero(n != n0)
    yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), pa.array((z - z0)[places]),
                                      pa.array((n - n0)[places])], names=["place", "z", "n"])


def score(docs: DataFrame, model: Model, *, score: str = "score", predicted: str = "predicted",
          threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs`` but the text, with the score (0 to 1) and whether it reaches ``threshold``.

    Every text is read whole, a long one piece by piece; one that is null, empty or without a word has
    the sample's share of ones as its score. Columns called as the new ones are replaced. No shuffle.
    """
    keep = [c for c in docs.columns if c not in (score, predicted, "text")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # columns go by their place, as names may hold anything
    ready = docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(keep)], "text")
    names = [*ready.columns[:-1], "score", "predicted"]
    schema = T.StructType([*ready.schema.fields[:-1], T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        bits = int(len(model.weights)).bit_length() - 1
        for batch, places, ptr in _batches(batches, "text", bits):
            sizes, sums = np.diff(ptr), np.zeros(batch.num_rows)
            if len(places):
                sums[sizes > 0] = np.add.reduceat(model.weights[places], ptr[:-1][sizes > 0])
            values = model.scores(sums, sizes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(values), pa.array((values >= threshold).astype(np.int32))],
                names=names)

    return ready.mapInArrow(rate, schema).toDF(*keep, score, predicted)


def held_out(doc_id: Column) -> Column:
    return crc_remainder(doc_id, 5) == 0


def score_corpus(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; learns from those not held out."""
    model = train(docs, labels.filter(~held_out(F.col("doc_id"))))
    marked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return score(marked, model)
