"""Scoring texts with an interpolated modified Kneser-Ney model of bigrams or trigrams.

Tokens are words with A-Z lowered and one end per text. All training texts are counted in Spark:
tasks count what they read, shuffles add up. The model lies in the shared folder as sorted
arrays that workers map into memory:

* vocabulary: the sorted 64-bit hashes of the words, with their counts and the numbers of
  different words before them; a word's id is its place;
* bigrams: the sorted pairs of ids (32 bits each) with their counts;
* contexts: for each id, the numbers of bigrams seen once, twice, and more often, and the sum of their counts.

With trigrams the arrays below stand beside those of the bigrams, part for part:

* triples: the sorted pairs (row of the context in its part of the bigrams, id) with their counts;
* kinds: for each bigram as a context, the numbers of trigrams seen once, twice, and more often;
* adjusted: for each bigram, how many different words stand before it; the count itself at the start of a text,
  before which there is nothing. Bigrams are then told by these numbers, and what is not in a trigram's context is
  left to them.

Every array is cut into parts, each written by one task under a temporary name and renamed. Pairs and triples take five bytes
a key (``Keys``), counts one byte but for the few large ones (``Numbers``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import (crc_remainder, load_array, mounted, save_array, slices,
                                 word_hashes)
from wardline.session import scratch_path

END = np.uint64(1)  # the hash of the end; a word's hash is mixed, so it isn't met by chance
BUFFER = 4_000_000  # tokens a task holds before it counts them


@dataclass(frozen=True)
class Meta:
    """What every worker knows of a model; bounded, whatever the corpus."""

    folder: str
    parts: int
    documents: int
    tokens: int
    words: int  # different tokens
    pairs: int  # different bigrams
    first_ids: tuple[int, ...]  # of each part of the vocabulary
    hot: tuple[int, ...]  # contexts whose bigrams are dealt over all parts
    spare: float  # the probability that unigrams leave for all words alike, unknown ones too
    unigram_discounts: tuple[float, ...]
    bigram_discounts: tuple[float, ...]
    order: int = 2
    trigram_discounts: tuple[float, ...] = ()
    hot_pairs: tuple[int, ...] = ()  # contexts whose trigrams are dealt over all parts
    hot_kinds: tuple[tuple[int, ...], ...] = ()  # of each of them, the numbers of trigrams

    @property
    def start(self) -> int:
        """The context of a text's first token; it has the id after the last word."""
        return self.words


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, ends included, and where each text starts."""
    words, starts = word_hashes(column)
    return np.insert(words, starts[1:], END), starts + np.arange(len(starts))


SPREAD = np.uint64(0x9E3779B97F4A7C15)
WORD_BITS, WORD_MASK = np.uint64(32), np.uint64(0xFFFFFFFF)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Equal ranges of hashes, so parts stand in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def pair_part(pairs: np.ndarray, meta: Meta) -> np.ndarray:
    """Pairs go by their context; those of hot contexts by both words."""
    context = pairs >> WORD_BITS
    by = np.where(np.isin(context, np.array(meta.hot, dtype=np.uint64)), pairs, context)
    return part_of(by * SPREAD, meta.parts)


def small(values: np.ndarray) -> np.ndarray:
    """In the smallest unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and their counts as a blob; a task's row for one part.

    The upper halves of keys are told by their steps, the lower ones too as long as the upper half stays, each with the lowest
    bytes of all first: most bytes are few different ones, which compression takes.
    """
    keys, counts = keys.astype(np.uint64), small(counts)
    upper, lower = (keys >> WORD_BITS).astype("<u4"), keys.astype("<u4")
    steps = np.diff(upper, prepend=np.uint32(0))
    lower = np.where(steps, lower, np.diff(lower, prepend=np.uint32(0)))
    planes = [x.view(np.uint8).reshape(-1, 4).T.tobytes() for x in (steps, lower.astype("<u4"))]
    body = b"".join([bytes([counts.dtype.itemsize]), counts.tobytes(), *planes])
    return len(body).to_bytes(8, "little") + pa.Codec("zstd").compress(body, asbytes=True)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    body = pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    width = body[0]
    n = (len(body) - 1) // (8 + width)
    planes = np.frombuffer(body, np.uint8, 8 * n, 1 + n * width).reshape(2, 4, n)
    steps, lower = (np.ascontiguousarray(x.T).view("<u4").ravel() for x in planes)
    upper = np.cumsum(steps, dtype=np.uint32)
    # running sums that begin anew where the upper half changes
    sums = np.cumsum(lower, dtype=np.uint32)
    first = np.flatnonzero(steps)
    before = np.append(np.uint32(0), (sums - lower)[first])[np.cumsum(steps != 0)]
    return upper.astype(np.uint64) << WORD_BITS | (sums - before).astype(np.uint64), np.frombuffer(body, f"<u{width}", n, 1)


def save_arrays(path: str, *arrays: np.ndarray) -> None:
    """Arrays one after the other in one file, each from a multiple of eight bytes on, and their sizes."""
    raw = [np.ascontiguousarray(a).reshape(-1).view(np.uint8) for a in arrays]
    filled = [x for r in raw for x in (r, np.zeros(-len(r) % 8, np.uint8))]
    save_array(path, np.concatenate([*filled, np.array([len(r) for r in raw], np.int64).view(np.uint8)]))


def load_arrays(path: str, *types: type) -> list[np.ndarray]:
    data = np.asarray(load_array(path))
    out, at = [], 0
    for kind, size in zip(types, data[-8 * len(types):].view(np.int64).tolist()):
        out.append(data[at:at + size].view(kind))
        at += size + -size % 8
    return out


class Keys:
    """Sorted keys of 64 bits: the lower 40 bits of each, and which upper 24 begin where."""

    BITS, REST = np.uint64(40), np.uint64((1 << 40) - 1)

    def __init__(self, lower: np.ndarray, upper: np.ndarray, heads: np.ndarray, starts: np.ndarray) -> None:
        self.lower, self.upper, self.heads, self.starts = lower, upper, heads, starts

    @classmethod
    def save(cls, path: str, keys: np.ndarray) -> None:
        heads, starts = np.unique(keys >> cls.BITS, return_index=True)
        save_arrays(path, keys.astype(np.uint32), (keys >> WORD_BITS).astype(np.uint8), heads.astype(np.uint32),
                    np.append(starts, len(keys)).astype(np.int64))

    @classmethod
    def load(cls, path: str) -> Keys:
        return cls(*load_arrays(path, np.uint32, np.uint8, np.uint32, np.int64))

    @classmethod
    def none(cls) -> Keys:
        return cls(*(np.zeros(n, t) for n, t in ((0, np.uint32), (0, np.uint8), (0, np.uint32), (1, np.int64))))

    def __len__(self) -> int:
        return len(self.lower)

    def all(self) -> np.ndarray:
        return (np.repeat(self.heads.astype(np.uint64), np.diff(self.starts)) << self.BITS
                | self._rest(slice(None)))

    def _rest(self, at: np.ndarray | slice) -> np.ndarray:
        return self.upper[at].astype(np.uint64) << WORD_BITS | self.lower[at]

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where sorted keys stand, and whether they do."""
        head, known = look_up(self.heads, (keys >> self.BITS).astype(np.uint32))
        row = np.zeros(len(keys), np.int64)
        low, high, keys = self.starts[head[known]], self.starts[head[known] + 1], keys[known] & self.REST
        # halved until one is left, the last that is not above the key
        size = high - low
        for _ in range(int(size.max(initial=0) - 1).bit_length() if len(size) else 0):
            half = size >> 1
            middle = low + half
            low = np.where(self._rest(middle) <= keys, middle, low)
            size -= half
        row[known] = low
        known[known] = self._rest(low) == keys
        return row, known


class Numbers:
    """Rows of numbers, a byte each; those from 255 on stand apart with their places."""

    MOST = 255

    def __init__(self, values: np.ndarray, places: np.ndarray, more: np.ndarray, rows: int = 1) -> None:
        self.values, self.places, self.more, self.rows = values, places, more, rows

    @classmethod
    def save(cls, path: str, numbers: np.ndarray) -> None:
        numbers = numbers.reshape(-1)
        places = np.flatnonzero(numbers >= cls.MOST)
        save_arrays(path, np.minimum(numbers, cls.MOST).astype(np.uint8), places.astype(np.int64),
                    numbers[places].astype(np.int64))

    @classmethod
    def load(cls, path: str, rows: int = 1) -> Numbers:
        return cls(*load_arrays(path, np.uint8, np.int64, np.int64), rows)

    @classmethod
    def none(cls, rows: int = 1) -> Numbers:
        return cls(np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64), rows)

    def __len__(self) -> int:
        return len(self.values) // self.rows

    def at(self, places: np.ndarray) -> np.ndarray:
        """The numbers of all rows at ``places``."""
        places = np.arange(self.rows)[:, None] * len(self) + places
        out = self.values[places].astype(np.int64)
        large = np.nonzero(out == self.MOST)
        if len(large[0]):
            out[large] = self.more[np.searchsorted(self.places, places[large])]
        return out


def added(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of counts by key, over blobs."""
    if not blobs:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keys, counts = zip(*map(unpacked, blobs))
    keys, counts = np.concatenate(keys), np.concatenate([c.astype(np.int64) for c in counts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


BLOBS = "part int, blob binary"


def counted(texts: DataFrame, keys_of, part, buffer: int = BUFFER) -> DataFrame:
    """Rows (part, blob) of the counts of ``keys_of`` (an array of texts) over ``texts``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, "text"):
            keys = keys_of(batch.column(0))
            held.append(keys)
            size += len(keys)
            if size >= buffer:
                yield blobs(held)
                held, size = [], 0
        if size:
            yield blobs(held)

    def blobs(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return dealt(keys, counts, part(keys))

    return texts.select("text").mapInArrow(count, BLOBS)


def dealt(keys: np.ndarray, counts: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(parts, kind="stable")
    numbers, starts = np.unique(parts[order], return_index=True)
    rows = [packed(keys[x], counts[x]) for x in np.split(order, starts[1:])]
    return pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int32)), pa.array(rows, pa.binary())],
                                      names=["part", "blob"])


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """The blobs of each part of a sorted task."""
    last, held = None, []
    for batch in batches:
        for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if part != last and held:
                yield last, held
                held = []
            last = part
            held.append(blob)
    if held:
        yield last, held


def gathered(blobs: DataFrame, parts: int) -> DataFrame:
    return blobs.repartition(parts, "part").sortWithinPartitions("part")


def histogram(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return [int(np.count_nonzero(counts == n)) for n in (1, 2, 3, 4)]


def discounts(n: list[int]) -> tuple[float, ...]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more; usual values where n tells nothing."""
    if min(n[:3]) <= 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    found = [k + 1 - (k + 1) * y * n[k + 1] / n[k] for k in range(3)]
    return tuple(min(max(d, 0.0), k + 1.0) for k, d in enumerate(found))


def train(texts: DataFrame, *, order: int = 2, parts: int | None = None) -> Meta:
    """Count all of ``texts`` (text; null: empty) and write the model of bigrams (``order`` 2) or trigrams (3).

    ``parts`` is a number of tasks to share each array, by default that of the session's shuffles. A word or a pair
    that makes up a third of all tokens is one row for each task and part before the shuffle; a context that would fill more
    than a quarter of a part is dealt over all parts.
    """
    if order not in (2, 3):
        raise ValueError(f"no model of order {order}")
    spark = texts.sparkSession
    folder = scratch_path(spark, "kneser-ney")
    root = mounted(folder)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def tokens_of(column: pa.Array) -> np.ndarray:
        return token_hashes(column)[0]

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, blobs in by_part(batches):
            keys, counts = added(blobs)
            save_array(f"{root}/word-{part}.npy", keys)
            Numbers.save(f"{root}/count-{part}.npy", counts)
            ends = int(counts[keys == END].sum())
            most = np.argsort(-counts, kind="stable")[:4 * parts]  # which may be hot
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([len(keys)], pa.int64()),
                 pa.array([int(counts.sum())], pa.int64()), pa.array([ends], pa.int64()),
                 pa.array([most.tolist()], pa.list_(pa.int64())),
                 pa.array([counts[most].tolist()], pa.list_(pa.int64()))],
                names=["part", "words", "tokens", "ends", "place", "n"])

    vocabulary = gathered(counted(texts, tokens_of, lambda k: part_of(k, parts)), parts).mapInArrow(
        write_words, "part int, words long, tokens long, ends long, place array<long>, n array<long>").collect()
    rows = {r.part: r for r in vocabulary}
    sizes = [rows[p].words if p in rows else 0 for p in range(parts)]
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(int).tolist()
    total = sum(r.tokens for r in vocabulary)
    documents = sum(r.ends for r in vocabulary)
    if first[-1] + 1 >= 1 << 32:
        raise ValueError("more than 2**32 different words")
    limit = max(1, total // (4 * parts))
    hot = sorted([first[r.part] + i for r in vocabulary for i, n in zip(r.place, r.n) if n > limit]
                 + [first[-1]] * (documents > limit))
    meta = Meta(root, parts, documents, total, first[-1], 0, tuple(first), tuple(hot), 1.0, (), (), order)
    return _train_pairs(texts, meta)


def _train_pairs(texts: DataFrame, meta: Meta) -> Meta:
    root, parts = meta.folder, meta.parts

    def pairs_of(column: pa.Array) -> np.ndarray:
        model = Model.of(meta)
        hashes, starts = token_hashes(column)
        ids = model.ids(hashes)
        return with_contexts(ids, starts, meta)

    hot_count = max(1, meta.tokens // (4 * parts))

    def write_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, blobs in by_part(batches):
            keys, counts = added(blobs)
            Keys.save(f"{root}/pair-{part}.npy", keys)
            Numbers.save(f"{root}/times-{part}.npy", counts)
            if meta.order == 2:
                yield from context_rows(keys, counts, meta)
            yield told(part, PAIRS, [len(keys), *histogram(counts)], keys[counts > hot_count].tolist())

    rows, heard = _stored(gathered(
        counted(texts, pairs_of, lambda k: pair_part(k, meta)), parts).mapInArrow(write_pairs, BLOBS),
        f"{root}/statistics")
    totals, hot_pairs = heard[PAIRS]
    if meta.order == 3:
        # ends have nothing after them
        end = Model(meta).ids(np.array([END]))[0]
        meta = Meta(**asdict(meta) | {"hot_pairs": tuple(sorted(p for p in hot_pairs if p & 0xFFFFFFFF != end))})
        rows, totals, meta = _train_triples(texts, meta)

    def write_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, blobs in by_part(batches):
            low = meta.first_ids[part]
            size = meta.first_ids[part + 1] - low + (part == parts - 1)  # the start is the last id
            seen = np.zeros((5, size), dtype=np.int64)
            for kind in range(5):
                keys, values = added([b[1:] for b in blobs if b[0] == kind + 1])
                seen[kind, (keys - np.uint64(low)).astype(np.int64)] = values
            Numbers.save(f"{root}/context-{part}.npy", seen[:4])
            Numbers.save(f"{root}/before-{part}.npy", seen[4])
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], pa.int64()) for x in histogram(seen[4])], names=["a", "b", "c", "d"])

    histograms = gathered(rows, parts).mapInArrow(
        write_contexts, "a long, b long, c long, d long").collect()
    continuation = np.array([list(r) for r in histograms] or [[0] * 4]).sum(axis=0).tolist()
    unigram = discounts(continuation)
    # every word stands after something
    kinds = [*continuation[:2], meta.words - sum(continuation[:2])]
    spare = sum(d * n for d, n in zip(unigram, kinds)) / totals[0] if totals[0] else 1.0
    return Meta(**asdict(meta) | {
        "pairs": totals[0], "spare": spare, "unigram_discounts": unigram,
        "bigram_discounts": discounts(totals[1:])})


PAIRS, TRIPLES = 2, 3  # of what a row for the driver tells


def _stored(stats: DataFrame, path: str) -> tuple[DataFrame, dict[int, tuple[list[int], list]]]:
    """Written rows for the parts, and sums and lists of what the parts told of pairs and of triples."""
    stats.write.parquet(path)
    stats = stats.sparkSession.read.schema(BLOBS).parquet(path)
    heard = [json.loads(bytes(r.blob)) for r in stats.filter("part < 0").collect()]
    of = {kind: [h[1:] for h in heard if h[0] == kind] for kind in (PAIRS, TRIPLES)}
    return stats.filter("part >= 0"), {
        kind: (np.array([h[0] for h in rows] or [[0] * 5]).sum(axis=0).tolist(), [x for h in rows for x in h[1]])
        for kind, rows in of.items()}


def told(part: int, kind: int, sums: list[int], items: list) -> pa.RecordBatch:
    """A row for the driver."""
    return pa.RecordBatch.from_arrays(
        [pa.array([-1 - part], pa.int32()), pa.array([json.dumps([kind, sums, items]).encode()], pa.binary())],
        names=["part", "blob"])


def context_rows(keys: np.ndarray, counts: np.ndarray, meta: Meta) -> Iterator[pa.RecordBatch]:
    """What a part's bigrams say of their words; it goes to the parts of the vocabulary that have their ids."""
    context = keys >> WORD_BITS
    first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    for n in (1, 2, 3):
        values = np.add.reduceat((counts == n) if n < 3 else (counts > 2), first).astype(np.int64)
        yield tagged(n, context[first][values > 0], values[values > 0], meta)
    yield tagged(4, context[first], np.add.reduceat(counts, first), meta)
    yield tagged(5, *np.unique(keys & WORD_MASK, return_counts=True), meta)


def _train_triples(texts: DataFrame, meta: Meta) -> tuple[DataFrame, list[int], Meta]:
    """Write the arrays of trigrams; the rows and totals of bigrams come from their adjusted counts."""
    spark, root, parts = texts.sparkSession, meta.folder, meta.parts
    every = spark.createDataFrame([(p, b"") for p in range(parts)], BLOBS)  # parts without trigrams too
    hot = np.array(meta.hot_pairs, dtype=np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.of(meta)
        model.finish()
        held, size = [], 0
        for batch in slices(batches, "text"):
            hashes, starts = token_hashes(batch.column(0))
            ids = model.ids(hashes)
            pairs = with_contexts(ids, starts, meta)
            later = np.ones(len(ids), dtype=bool)
            later[starts[:-1]] = False
            places = np.flatnonzero(later)
            kinds, back = np.unique(pairs[places - 1], return_inverse=True)
            held.append(model.triples(kinds, model.pair_rows(kinds)[0], back, ids[places]))
            size += len(places)
            if size >= BUFFER:
                yield blobs(held)
                held, size = [], 0
        if size:
            yield blobs(held)

    def blobs(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        part, keys = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((keys, part))
        part, keys = part[order], keys[order]
        first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (part[1:] != part[:-1])]))
        return dealt(keys[first], np.diff(np.append(first, len(keys))), part[first])

    def write_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, blobs in by_part(batches):
            try:
                pairs = Keys.load(f"{root}/pair-{part}.npy").all()
            except FileNotFoundError:  # hot contexts can fall here all the same
                pairs = np.empty(0, np.uint64)
            keys, counts = added([b for b in blobs if b])
            Keys.save(f"{root}/triple-{part}.npy", keys)
            Numbers.save(f"{root}/triple_times-{part}.npy", counts)
            row = keys >> WORD_BITS
            is_hot = row > WORD_MASK - np.uint64(len(hot))
            place = (WORD_MASK - row[is_hot]).astype(np.int64)
            row = row.astype(np.int64)
            kinds, hot_kinds = [], []
            for n in (1, 2, 3):
                of = (counts == n) if n < 3 else (counts > 2)
                kinds.append(np.bincount(row[of & ~is_hot], minlength=len(pairs)))
                hot_kinds.append(np.bincount(place[of[is_hot]], minlength=len(hot)).tolist())
            Numbers.save(f"{root}/kinds-{part}.npy", np.concatenate(kinds))
            # the bigram that is left when the first word goes
            middle = np.empty(len(keys), dtype=np.uint64)
            middle[~is_hot] = pairs[row[~is_hot]] & WORD_MASK
            middle[is_hot] = hot[place] & WORD_MASK
            after, before = np.unique(middle << WORD_BITS | keys & WORD_MASK, return_counts=True)
            if len(after):
                yield dealt(after, before, pair_part(after, meta))
            yield told(part, TRIPLES, [len(keys), *histogram(counts)], [hot_kinds])

    def write_adjusted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, blobs in by_part(batches):
            if part < 0:  # what the trigrams' tasks told goes on to the driver
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())],
                                                 names=["part", "blob"])
                continue
            try:
                pairs = Keys.load(f"{root}/pair-{part}.npy").all()
                times = Numbers.load(f"{root}/times-{part}.npy")
            except FileNotFoundError:
                continue
            counts = np.zeros(len(pairs), dtype=np.int64)
            at_start = np.flatnonzero(pairs >> WORD_BITS == np.uint64(meta.start))
            counts[at_start] = times.at(at_start)[0]
            keys, before = added([b for b in blobs if b])
            counts[np.searchsorted(pairs, keys)] = before
            Numbers.save(f"{root}/adjusted-{part}.npy", counts)
            yield from context_rows(pairs, counts, meta)
            yield told(part, PAIRS, [len(pairs), *histogram(counts)], [])

    found = texts.select("text").mapInArrow(count, BLOBS)
    adjusted = gathered(found.union(every), parts).mapInArrow(write_triples, BLOBS)
    rows, heard = _stored(gathered(adjusted.union(every), parts).mapInArrow(write_adjusted, BLOBS),
                          f"{root}/statistics-2")
    pair_totals, (totals, hot_kinds) = heard[PAIRS][0], heard[TRIPLES]
    hot_kinds = np.array(hot_kinds, dtype=np.int64).sum(axis=0).reshape(3, len(hot)).T.tolist()
    return rows, pair_totals, Meta(**asdict(meta) | {
        "trigram_discounts": discounts(totals[1:]), "hot_kinds": tuple(map(tuple, hot_kinds))})


def tagged(kind: int, ids: np.ndarray, values: np.ndarray, meta: Meta) -> pa.RecordBatch:
    """Blobs for the parts of the vocabulary, each with its kind in front."""
    parts = np.clip(np.searchsorted(np.array(meta.first_ids), ids.astype(np.int64), "right") - 1,
                    0, meta.parts - 1)
    if not len(ids):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.binary())],
                                          names=["part", "blob"])
    batch = dealt(ids, values, parts)
    rows = [bytes([kind]) + x for x in batch.column(1).to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())],
                                      names=["part", "blob"])


def with_contexts(ids: np.ndarray, starts: np.ndarray, meta: Meta) -> np.ndarray:
    """Each token's pair with the token before it in its text; ids are known ones."""
    before = np.empty(len(ids), dtype=np.uint64)
    before[1:] = ids[:-1]
    before[starts[:-1]] = meta.start
    return before << np.uint64(32) | ids.astype(np.uint64)


class Model:
    """The arrays of a model as a worker has mapped them."""

    _open: dict[Meta, Model] = {}

    def __init__(self, meta: Meta) -> None:
        self.meta = meta
        self.words = [self._load("word", p, lambda path: np.asarray(load_array(path)), np.empty(0, np.uint64))
                      for p in range(meta.parts)]

    @classmethod
    def of(cls, meta: Meta) -> Model:
        if meta not in cls._open:
            cls._open = {meta: cls(meta)}
        return cls._open[meta]

    def _load(self, name: str, part: int, load, none):
        try:
            return load(f"{self.meta.folder}/{name}-{part}.npy")
        except FileNotFoundError:  # no word or pair fell into the part
            return none

    def finish(self) -> None:
        """Open what only scoring needs."""
        if not hasattr(self, "pairs"):
            of = range(self.meta.parts)
            rows = {"context": 4, "kinds": 3}
            (self.counts, self.before, self.contexts, self.times, self.adjusted, self.kinds, self.triple_times) = (
                [self._load(n, p, lambda path, r=rows.get(n, 1): Numbers.load(path, r), Numbers.none(rows.get(n, 1)))
                 for p in of] for n in ("count", "before", "context", "times", "adjusted", "kinds", "triple_times"))
            self.triple_keys, self.pairs = ([self._load(n, p, Keys.load, Keys.none()) for p in of]
                                            for n in ("triple", "pair"))

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The id of each hash; -1 for unknown words."""
        keys, back = np.unique(hashes, return_inverse=True)
        ids = np.full(len(keys), -1, dtype=np.int64)
        borders = np.searchsorted(part_of(keys, self.meta.parts), np.arange(self.meta.parts + 1))
        for part in np.flatnonzero(np.diff(borders)):
            some = slice(borders[part], borders[part + 1])
            row, known = look_up(self.words[part], keys[some])
            ids[some] = np.where(known, row + self.meta.first_ids[part], -1)
        return ids[back]

    def of_ids(self, arrays: list[Numbers], ids: np.ndarray, rows: int = 1) -> np.ndarray:
        """What ``arrays`` say of ids of the vocabulary, which are sorted and known."""
        out = np.zeros((rows, len(ids)), dtype=np.float64)
        borders = np.searchsorted(ids, [*self.meta.first_ids[:-1], self.meta.start + 1])
        for part in np.flatnonzero(np.diff(borders)):
            some = slice(borders[part], borders[part + 1])
            if len(arrays[part]):
                out[:, some] = arrays[part].at(ids[some] - self.meta.first_ids[part])
        return out

    def rows(self, tables: list[Keys], part: np.ndarray, keys: np.ndarray,
             *arrays: tuple[list[Numbers], int]) -> list[np.ndarray]:
        """The row of each key in the table of its part, -1 if unknown, and what ``arrays`` hold there, else 0."""
        row = np.full(len(keys), -1, dtype=np.int64)
        out = [np.zeros((n, len(keys))) for _, n in arrays]
        order = np.lexsort((keys, part))
        borders = np.searchsorted(part[order], np.arange(self.meta.parts + 1))
        for number in np.flatnonzero(np.diff(borders)):
            some = order[borders[number]:borders[number + 1]]
            at, known = tables[number].look_up(keys[some])
            some, at = some[known], at[known]
            row[some] = at
            for values, (array, _) in zip(out, arrays):
                if len(at):
                    values[:, some] = array[number].at(at)
        return [row, *out]

    def pair_rows(self, pairs: np.ndarray, *arrays: tuple[list[Numbers], int]) -> list[np.ndarray]:
        return self.rows(self.pairs, pair_part(pairs, self.meta), pairs, *arrays)

    def triples(self, contexts: np.ndarray, row: np.ndarray, back: np.ndarray,
                ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Part and key of trigrams: ``back`` tells the context of each of ``ids``, ``row`` where contexts stand."""
        meta = self.meta
        part = pair_part(contexts, meta)
        place, is_hot = look_up(np.array(meta.hot_pairs, dtype=np.uint64), contexts)
        row = np.where(is_hot, WORD_MASK - place.astype(np.uint64), row.astype(np.uint64))
        keys = row[back] << WORD_BITS | ids.astype(np.uint64)
        return np.where(is_hot[back], part_of(keys * SPREAD, meta.parts), part[back]).astype(np.int32), keys

    def score(self, column: pa.Array) -> dict[str, np.ndarray]:
        """Sums over the tokens of each text: see ``score``."""
        self.finish()
        meta = self.meta
        hashes, starts = token_hashes(column)
        ids = self.ids(hashes)
        known = ids >= 0
        kinds, back = np.unique(ids[known], return_inverse=True)
        count, before = np.zeros(len(ids)), np.zeros(len(ids))
        count[known] = self.of_ids(self.counts, kinds)[0][back]
        before[known] = self.of_ids(self.before, kinds)[0][back]
        # unigrams: how many different words stand before a word
        once, twice, more = meta.unigram_discounts or (0.5, 1.0, 1.5)
        discount = np.select([before == 0, before == 1, before == 2], [0, once, twice], more)
        lower = (before - discount) / max(meta.pairs, 1)
        lower += meta.spare / (meta.words + 1)
        # bigrams
        context = np.empty(len(ids), dtype=np.int64)
        context[1:] = ids[:-1]
        context[starts[:-1]] = meta.start if meta.documents else -1
        there = context >= 0
        kinds, back = np.unique(context[there], return_inverse=True)
        numbers = self.of_ids(self.contexts, kinds, 4)
        total = numbers[3]
        once, twice, more = meta.bigram_discounts or (0.5, 1.0, 1.5)
        rest = (once * numbers[0] + twice * numbers[1] + more * numbers[2]) / np.maximum(total, 1)
        chance = lower.copy()
        both = there & known
        times = np.zeros(len(ids))
        pairs, again = np.unique(context[both].astype(np.uint64) << np.uint64(32)
                                 | ids[both].astype(np.uint64), return_inverse=True)
        shown = self.adjusted if meta.order == 3 else self.times
        times[both] = self.pair_rows(pairs, (shown, 1))[1][0][again]
        discount = np.select([times == 0, times == 1, times == 2], [0, once, twice], more)
        chance[there] = ((times - discount)[there] / np.maximum(total, 1)[back]
                         + rest[back] * lower[there])
        if meta.order == 3:
            self._add_triples(chance, ids, context, starts)
        base = np.log10((count + 0.5) / (meta.tokens + 0.5 * (meta.words + 1)))
        sums = {name: np.add.reduceat(values, starts[:-1]) for name, values in (
            ("n_known", known.astype(np.int64)), ("base_score", base), ("score", np.log10(chance)))}
        return sums | {"n_tokens": np.diff(starts)}


    def _add_triples(self, chance: np.ndarray, ids: np.ndarray, context: np.ndarray, starts: np.ndarray) -> None:
        """Turn the chances of tokens after the word before them into those after two, where the two were seen."""
        meta = self.meta
        later = np.ones(len(ids), dtype=bool)
        later[starts[:-1]] = False
        at = np.flatnonzero(later)
        at = at[(context[at] >= 0) & (context[at - 1] >= 0)]
        pairs, back = np.unique(context[at - 1].astype(np.uint64) << WORD_BITS
                                | context[at].astype(np.uint64), return_inverse=True)
        row, total, kinds = self.pair_rows(pairs, (self.times, 1), (self.kinds, 3))
        place, is_hot = look_up(np.array(meta.hot_pairs, dtype=np.uint64), pairs)
        if is_hot.any():
            kinds[:, is_hot] = np.array(meta.hot_kinds, dtype=np.float64)[place[is_hot]].T
        seen = row[back] >= 0
        at, back = at[seen], back[seen]
        times = np.zeros(len(at))
        known = ids[at] >= 0
        part, keys = self.triples(pairs, np.maximum(row, 0), back[known], ids[at][known])
        times[known] = self.rows(self.triple_keys, part, keys, (self.triple_times, 1))[1][0]
        once, twice, more = meta.trigram_discounts
        rest = (once * kinds[0] + twice * kinds[1] + more * kinds[2]) / np.maximum(total[0], 1)
        discount = np.select([times == 0, times == 1, times == 2], [0, once, twice], more)
        chance[at] = (times - discount) / np.maximum(total[0], 1)[back] + rest[back] * chance[at]


def look_up(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted keys stand in a sorted table, and whether they do."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    row = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return row, table[row] == keys


def score(docs: DataFrame, meta: Meta) -> DataFrame:
    """Add n_tokens, n_known, train_tokens, base_score, score and perplexity to ``docs``.

    ``text`` (null: empty) is dropped; columns called as the new ones are replaced. The end is a token, so every text
    has at least one. ``score`` is the log10 probability of the text under the model; ``base_score``
    that of its tokens one by one, half a count added to each. After an empty
    corpus every token has the probability that one unknown word has. No shuffle; a task holds one slice of
    texts, and the pages of the arrays that it touches are shared by the workers of a machine.
    """
    added_columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    keep = [c for c in docs.columns if c not in ("text", *added_columns)]
    ready = docs.select(*keep, "text")
    kinds = ["long", "long", "long", "double", "double", "double"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in ready.schema.fields[:-1]]
                       + [f"{n} {k}" for n, k in zip(added_columns, kinds)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.of(meta)
        for batch in slices(batches, "text"):
            sums = model.score(batch.column(len(keep)))
            sums["train_tokens"] = np.full(batch.num_rows, meta.tokens)
            sums["perplexity"] = 10.0 ** np.minimum(-sums["score"] / sums["n_tokens"], 300)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], *(pa.array(sums[c]) for c in added_columns)],
                names=[*keep, *added_columns])

    return ready.mapInArrow(add, schema)


def score_corpus(docs: DataFrame, *, order: int = 3) -> DataFrame:
    """Learn from the documents that are not held out, and score all."""
    marked = docs.select("doc_id", (crc_remainder(F.col("doc_id"), 5) == 1).alias("held_out"), "text")
    return score(marked, train(marked.filter("NOT held_out").select("text"), order=order))
