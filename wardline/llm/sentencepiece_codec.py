"""SentencePiece encoding and decoding by way of the different words of a corpus.

No piece has a space after another character, and some characters stand in no longer piece, so
a text falls into words whose segmentations don't touch. The different words of the corpus
are found and segmented once, as rows that Spark deals out; the segmented words lie in the shared folder
as sorted hash arrays, from which workers encode whole texts.

How a word is segmented follows the kind of model. A unigram model wants the path of the highest
sum of scores: the word's bounded-length substrings are exploded and joined to the piece table, the edges
are grouped by word and folded with the higher-order ``aggregate`` (``lattice``, ``best_path``). In a BPE model
the scores are ranks of merges, and the best sum is another segmentation than the model's for more than half of
all words; neighbours are merged in the order of their scores (``merges``), which gives the ids
of the public library.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import (fresh, load_array, mounted, save_array, slices, span_hashes, text_bytes)
from wardline.session import scratch_path

SPACE = "▁"  # how pieces write a space
MAX_PIECES = 1_000_000
SEEN = 4_000_000  # words a task remembers as handed on
LONG_WORD = 256  # characters; longer words are merged by a heap
IDS = 1 << 18  # that are decoded at once, or those of one text


@dataclass(frozen=True)
class Pieces:
    """The table of a model: bounded by its vocabulary, and sent to every task."""

    rows: tuple[tuple[str, int, float], ...]  # piece, id, score; no bytes and no control pieces
    byte_ids: tuple[int, ...]  # of the 256 bytes
    unknown: int
    unigram: bool

    @property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.rows), default=1)

    def cuts(self) -> np.ndarray:
        """Which single bytes stand in no longer piece: they are words of their own."""
        joined = {ord(c) for p, _, _ in self.rows if len(p) > 1 for c in p}
        out = np.zeros(256, dtype=bool)
        out[[b for b in range(128) if b not in joined and b != 0x20]] = True
        return out


def load_pieces(path: str, *, unigram: bool = False) -> Pieces:
    """The pieces of a model file with byte fallback, no normalization and a space put in front."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    if len(ids) > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    if any(model.encode(t) != model.encode(u) for t, u in (("a  b ", "a▁▁b▁"),)) or (
            model.decode(model.encode(" Å  x ")) != " Å  x "):
        raise ValueError("models that change texts are not supported")
    single = {model.id_to_piece(i): i for i in ids if model.is_byte(i)}
    if len(single) != 256:
        raise ValueError("models without byte fallback are not supported")
    rows = tuple((model.id_to_piece(i), i, model.get_score(i)) for i in ids
                 if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
                         or model.is_unused(i)))
    if any(SPACE in p.lstrip(SPACE) for p, _, _ in rows):
        raise ValueError("models whose pieces span words are not supported")
    return Pieces(rows, tuple(single[f"<0x{b:02X}>"] for b in range(256)), model.unk_id(), unigram)


def prepared(text: Column) -> Column:
    """A text as its words are cut from it: with a space in front, and none if it is empty or null."""
    plain = F.replace(text, F.lit(SPACE), F.lit(" "))
    return F.when(F.length(text) > 0, F.concat(F.lit(" "), plain)).otherwise(F.lit("")).alias("_text")


def word_spans(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words start and end: at a run of spaces, and around bytes that stand alone."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    space, alone = data == 0x20, cuts[data]
    opens = space.copy()
    opens[1:] &= ~space[:-1]
    opens |= alone
    opens[1:] |= alone[:-1]
    opens[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(opens)
    return starts, np.append(starts[1:], len(data))


def distinct_words(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """hash and word (with a piece's sign for spaces) of all different words of ``docs`` (text)."""
    cuts = pieces.cuts()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.empty(0, np.uint64)
        for batch in slices(batches, "_text"):
            data, offsets = text_bytes(batch.column(0))
            starts, ends = word_spans(data, offsets, cuts)
            hashes, first = np.unique(span_hashes(data, starts, ends), return_index=True)
            if len(seen):
                at = np.minimum(np.searchsorted(seen, hashes), len(seen) - 1)
                new = seen[at] != hashes
                hashes, first = hashes[new], first[new]
            whole = data.tobytes()
            words = [whole[a:b].decode("utf-8").replace(" ", SPACE)
                     for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            seen = hashes if len(seen) > SEEN else np.sort(np.concatenate([seen, hashes]))
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(words, pa.string())],
                                             names=["hash", "word"])

    return docs.select(prepared(F.col("text"))).mapInArrow(find, "hash long, word string").distinct()


def lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``words`` with ``edges``: start (from 0), length, id and score of the pieces in the word.

    Every substring up to the longest piece is joined to the piece table. The
    table is broadcast; its size is that of the vocabulary. The words stay where they are. Each substring is
    a row that carries its word, so this suits words, not lines.
    """
    table = words.sparkSession.createDataFrame(
        list(pieces.rows), "_piece string, id int, score double")
    starts = words.withColumn("start", F.explode(F.sequence(F.lit(1), F.length("word"))))
    spans = starts.withColumn("length", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(pieces.longest), F.length("word") - F.col("start") + 1))))
    spans = spans.withColumn("_piece", F.substring("word", F.col("start"), F.col("length")))
    found = spans.join(F.broadcast(table), "_piece", "left").filter(
        "id IS NOT NULL OR (start = 1 AND length = 1)")  # a word without pieces stays
    edge = F.struct((F.col("start") - 1).alias("start"), "length", "id", "score")
    keys = [c for c in words.columns]
    return found.groupBy(*keys).agg(F.collect_list(edge).alias("edges"))


def best_path(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``words`` with ``ids``: the path with the highest sum of scores, a character that no piece
    has as its bytes; of equal sums the one with the longer last piece.

    A Viterbi fold over the edges in the order of their ends; for each place it keeps the best
    sum and the start and id of the piece that ends there.
    """
    lowest = min((s for _, _, s in pieces.rows), default=0.0) - 10.0  # of a character without a piece
    bytes_of = F.array(*[F.lit(i) for i in pieces.byte_ids])
    size = F.length("word")
    gaps = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        i.alias("start"), F.lit(1).alias("length"), F.lit(-1).alias("id"), F.lit(lowest).alias("score")))
    known = F.filter("edges", lambda e: e["id"].isNotNull())
    ordered = F.array_sort(F.concat(known, gaps), lambda a, b: (
        (a["start"] + a["length"]) * 1000 - a["length"]) - ((b["start"] + b["length"]) * 1000 - b["length"]))
    state = "array<struct<total:double,start:int,id:int>>"
    first = F.array(F.struct(F.lit(0.0).alias("total"), F.lit(-1).alias("start"), F.lit(-1).alias("id")))

    def step(places: Column, edge: Column) -> Column:
        end = edge["start"] + edge["length"]
        total = F.element_at(places, edge["start"] + 1)["total"] + edge["score"]
        here = F.struct(total.alias("total"), edge["start"].alias("start"), edge["id"].alias("id"))
        return (F.when(F.size(places) <= end, F.concat(places, F.array(here)))
                .when(total > F.element_at(places, -1)["total"],
                      F.concat(F.slice(places, F.lit(1), end), F.array(here))).otherwise(places))

    places = F.aggregate(ordered, first.cast(state), lambda p, e: step(p, e).cast(state))

    def back(acc: Column, _: Column) -> Column:
        place = F.element_at(F.col("_places"), acc["at"] + 1)
        symbol = F.substring("word", place["start"] + 1, F.lit(1))
        raw = F.transform(F.sequence(F.lit(1), F.octet_length(symbol)), lambda i: F.element_at(
            bytes_of, F.conv(F.substring(F.hex(symbol), i * 2 - 1, F.lit(2)), 16, 10).cast("int") + 1))
        ids = F.when(place["id"] >= 0, F.array(place["id"])).otherwise(raw)
        return F.when(acc["at"] <= 0, acc).otherwise(F.struct(
            place["start"].alias("at"), F.concat(ids, acc["ids"]).alias("ids")))

    start = F.struct(size.alias("at"), F.array().cast("array<int>").alias("ids"))
    walked = F.aggregate(F.sequence(F.lit(1), size), start, back)
    keep = [c for c in words.columns if c != "edges"]
    return words.withColumn("_places", places).select(*keep, walked["ids"].alias("ids"))


NEVER = np.int64(1 << 30)  # the rank of neighbours that make no piece


class Merger:
    """Segments many words at once by merging neighbours, the highest score first and of equal
    scores the leftmost, until no two neighbours make a piece."""

    def __init__(self, pieces: Pieces) -> None:
        self.table = {p: (i, s) for p, i, s in pieces.rows}
        self.longest, self.byte_ids = pieces.longest, pieces.byte_ids
        # a character that stands in pieces but is none gets an id after the last
        self.limit = max((i for i, _ in self.table.values()), default=0) + 1
        ids = {p: i for p, (i, _) in self.table.items()}
        for char in sorted({c for p in self.table for c in p}):
            ids.setdefault(char, len(ids) + self.limit)
        self.of_char = np.full(0x110000, -1, dtype=np.int64)
        self.of_char[[ord(p) for p in ids if len(p) == 1]] = [i for p, i in ids.items() if len(p) == 1]
        ranks = {s: n for n, s in enumerate(sorted({s for _, s in self.table.values()}, reverse=True))}
        pairs = sorted((ids[p[:cut]] << 32 | ids[p[cut:]], ranks[s], i)
                       for p, (i, s) in self.table.items() for cut in range(1, len(p))
                       if p[:cut] in ids and p[cut:] in ids)
        self.pairs, self.ranks, self.made = (np.array(x, dtype=np.int64) for x in zip(*pairs or [(-1, 0, 0)]))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of what neighbours make."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        known = (self.pairs[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], NEVER), self.made[at]

    def segment(self, words: list[str]) -> list[list[int]]:
        """The ids of each word."""
        out: list[list[int]] = [[] for _ in words]
        short = [i for i, w in enumerate(words) if 0 < len(w) <= LONG_WORD]
        for i, word in enumerate(words):
            if len(word) > LONG_WORD:
                borders = merged_long(word, self.table, self.longest)
                symbols = [self.table.get(word[a:b], (-1,))[0] for a, b in zip(borders[:-1], borders[1:])]
                out[i] = self.with_bytes(symbols, word, borders)
        if not short:
            return out
        sizes = np.array([len(words[i]) for i in short])
        chars = np.frombuffer("".join([words[i] for i in short]).encode("utf-32-le"), np.uint32)
        symbols, places = self.merge(self.of_char[chars], np.repeat(np.arange(len(short)), sizes))
        word = np.repeat(np.arange(len(short)), sizes)[places]
        starts = np.searchsorted(word, np.arange(len(short) + 1))
        first = np.cumsum(sizes) - sizes
        plain, odd = symbols.tolist(), (symbols < 0) | (symbols >= self.limit)
        strange = set(word[odd].tolist())
        for n, i in enumerate(short):
            found = plain[starts[n]:starts[n + 1]]
            if n in strange:
                found = self.with_bytes(found, words[i], (places[starts[n]:starts[n + 1]] - first[n]).tolist())
            out[i] = found
        return out

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that are left and the places where they start; one merge a word and round."""
        places, done = np.arange(len(symbols)), []
        rank, made = np.full(len(symbols), NEVER), np.zeros(len(symbols), np.int64)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside], made[inside] = self.look_up(symbols[inside], symbols[inside + 1])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), starts)
            ready = best >> 32 >= NEVER
            at = best[~ready] & 0xFFFFFFFF
            symbols[at] = made[at]
            lengths = np.diff(np.append(starts, len(symbols)))
            finished = np.repeat(ready, lengths)
            done.append((symbols[finished], places[finished]))
            keep = ~finished
            keep[at + 1] = False
            position = np.cumsum(keep) - 1  # where a kept symbol stands from now on
            symbols, places, word, rank, made = (x[keep] for x in (symbols, places, word, rank, made))
            at = position[at]
            for left in (at - 1, at):  # the two pairs of each new symbol
                last = (left < 0) | (left + 1 >= len(symbols))
                left = left[~last]
                rank[left], made[left] = NEVER, 0
                left = left[word[left] == word[left + 1]]
                rank[left], made[left] = self.look_up(symbols[left], symbols[left + 1])
            if len(rank):
                rank[-1] = NEVER
        symbols, places = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(places, kind="stable")
        return symbols[order], places[order]

    def with_bytes(self, symbols: list[int], word: str, starts: list[int]) -> list[int]:
        """Ids, with the bytes of every character that is no piece."""
        out: list[int] = []
        for symbol, start in zip(symbols, starts):
            if 0 <= symbol < self.limit:
                out.append(symbol)
            else:
                out.extend(self.byte_ids[b] for b in word[start].replace(SPACE, " ").encode("utf-8"))
        return out


def merged_long(word: str, table: dict[str, tuple[int, float]], longest: int) -> list[int]:
    """The borders in one long word, by a heap of neighbours, in about n * log(n) steps."""
    size = len(word)

    def score(a: int, c: int) -> float | None:
        found = table.get(word[a:c]) if a >= 0 and c <= size and c - a <= longest else None
        return None if found is None else found[1]

    after = list(range(1, size + 1)) + [size + 1]
    before = list(range(-1, size))
    first = ((score(i, i + 2), i) for i in range(size - 1))
    heap = [(-s, i, i + 1, i + 2) for s, i in first if s is not None]
    heapq.heapify(heap)
    while heap:
        _, left, middle, right = heapq.heappop(heap)
        if after[left] != middle or after[middle] != right:
            continue  # one of the two is no longer there
        after[left], before[right] = right, left
        after[middle] = -1
        for a, b, c in ((before[left], left, right), (left, right, after[right])):
            value = score(a, c)
            if value is not None:
                heapq.heappush(heap, (-value, a, b, c))
    borders = [0]
    while borders[-1] < size:
        borders.append(after[borders[-1]])
    return borders


def merges(words: DataFrame, pieces: Pieces) -> DataFrame:
    """hash and ids of ``words`` (hash, word), merged in the order of the scores."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = None
        for batch in batches:
            merger = merger or Merger(pieces)
            ids = merger.segment(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["hash", "ids"])

    return words.select("hash", "word").mapInArrow(fold, "hash long, ids array<int>")


@dataclass(frozen=True)
class Codec:
    """A model and the folder with the segmented words of a corpus."""

    pieces: Pieces
    folder: str
    parts: int


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def build(docs: DataFrame, pieces: Pieces, *, parts: int | None = None) -> Codec:
    """Segment the different words of ``docs`` (text) and write them as sorted hash arrays."""
    spark = docs.sparkSession
    root = mounted(scratch_path(spark, "words"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = distinct_words(docs, pieces)
    words = best_path(lattice(words, pieces), pieces) if pieces.unigram else merges(words, pieces)
    # the range of hashes that a word falls into, as in part_of
    part = F.shiftrightunsigned(F.shiftrightunsigned("hash", 32) * F.lit(parts), 32).cast("int")
    rows = words.select(part.alias("part"), "hash", "ids").repartition(parts, "part").sortWithinPartitions(
        "part", F.expr("hash < 0"), "hash")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            for part in np.unique(numbers):
                if held and part != last:
                    yield save(last, held)
                    held = []
                last = part
                held.append(batch.slice(int(np.searchsorted(numbers, part)), int((numbers == part).sum())))
        if held:
            yield save(last, held)

    def save(part: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        hashes = rows["hash"].to_numpy().view(np.uint64)
        if len(hashes) > 1 and (hashes[1:] == hashes[:-1]).any():
            raise ValueError("two words with one hash")
        ids = rows["ids"].combine_chunks()
        lengths = ids.value_lengths().to_numpy()
        save_array(f"{root}/hash-{part}.npy", hashes)
        save_array(f"{root}/start-{part}.npy", np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64))
        save_array(f"{root}/ids-{part}.npy", ids.flatten().to_numpy().astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array([len(hashes)], pa.int64())], names=["n"])

    rows.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return Codec(pieces, root, parts)


_open: dict[str, list] = {}


def _arrays(codec: Codec) -> list:
    """The arrays of a codec as this worker has mapped them."""
    if codec.folder not in _open:
        _open.clear()
        _open[codec.folder] = []
        for part in range(codec.parts):
            try:
                _open[codec.folder].append(tuple(
                    load_array(f"{codec.folder}/{n}-{part}.npy") for n in ("hash", "start", "ids")))
            except FileNotFoundError:  # no word fell into the part
                _open[codec.folder].append(None)
    return _open[codec.folder]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run of a given length, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def encode_texts(column: pa.Array, codec: Codec, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all prepared texts in a row, and where each text starts."""
    data, offsets = text_bytes(column)
    starts, ends = word_spans(data, offsets, cuts)
    hashes, back = np.unique(span_hashes(data, starts, ends), return_inverse=True)
    lengths = np.zeros(len(hashes), dtype=np.int64)
    chosen, borders = [], np.searchsorted(part_of(hashes, codec.parts), np.arange(codec.parts + 1))
    for part in np.flatnonzero(np.diff(borders)):
        some = slice(borders[part], borders[part + 1])
        known, first, ids = _arrays(codec)[part]
        row = np.searchsorted(known, hashes[some])
        if (known[np.minimum(row, len(known) - 1)] != hashes[some]).any():
            raise ValueError("a word that the codec was not built with")
        lengths[some] = first[row + 1] - first[row]
        chosen.append(ids[spread(first[row], lengths[some])])
    flat = np.concatenate(chosen) if chosen else np.empty(0, np.int32)
    first = np.cumsum(lengths) - lengths
    out = flat[spread(first[back], lengths[back])]
    before = np.concatenate([[0], np.cumsum(lengths[back])])
    return out, before[np.searchsorted(starts, offsets)]


def decode_ids(ids: np.ndarray, starts: np.ndarray, pieces: Pieces) -> list[str]:
    """Texts of rows of ids; the space in front goes, bytes that are no UTF-8 become U+FFFD."""
    data, first, lengths = _piece_bytes(pieces)
    sizes = lengths[ids]
    raw = data[spread(first[ids], sizes)].tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[starts]
    return [raw[a:b].decode("utf-8", "replace").removeprefix(" ")
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


@lru_cache(maxsize=2)
def _piece_bytes(pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    by_id = {i: p.replace(SPACE, " ").encode("utf-8") for p, i, _ in pieces.rows}
    by_id |= {i: bytes([b]) for b, i in enumerate(pieces.byte_ids)}
    texts = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    lengths = np.array([len(t) for t in texts])
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths) - lengths, lengths


def encode(docs: DataFrame, codec: Codec, *, ids: str = "token_ids",
           restored: str | None = None) -> DataFrame:
    """``docs`` with the ids of each text; null and empty texts have none.

    With ``restored``, the ids are decoded in the same pass, and that column tells whether they give
    the text again (null: the empty text). No shuffle: a task holds a slice of texts and maps
    the arrays of words. Columns already called as the new ones are replaced.
    """
    new = [ids] + ([restored] if restored else [])
    keep = [c for c in docs.columns if c not in new]
    cuts = codec.pieces.cuts()
    plain, marked = fresh(keep, "_text"), fresh(keep, "_marked")
    ready = docs.select(*keep, prepared(F.col("text")).alias(plain),
                        F.coalesce(F.contains("text", F.lit(SPACE)), F.lit(False)).alias(marked))
    kinds = ["array<int>", "boolean"][:len(new)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in ready.schema.fields[:-2]]
                       + [f"`{n}` {k}" for n, k in zip(new, kinds)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, plain):
            texts = batch.column(len(keep))
            found, starts = encode_texts(texts, codec, cuts)
            columns = [pa.ListArray.from_arrays(
                pa.array(starts.astype(np.int32)), pa.array(found.astype(np.int32)))]
            if restored:
                again = decode_ids(found, starts, codec.pieces)
                columns.append(pa.array([not mark and text[1:] == other for text, other, mark in zip(
                    texts.to_pylist(), again, batch.column(len(keep) + 1).to_pylist())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], names=[*keep, *new])

    return ready.mapInArrow(add, schema)


def decode(encoded: DataFrame, pieces: Pieces, *, ids: str = "token_ids",
           text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of each row's ids; null ids are those of an empty text."""
    keep = [c for c in encoded.columns if c != text]
    ready = encoded.select(*keep, F.coalesce(ids, F.array().cast("array<int>")).alias(fresh(keep, "_ids")))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in ready.schema.fields[:-1]]
                       + [f"`{text}` string"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(keep))
            starts = column.offsets.to_numpy() - column.offsets[0].as_py()
            ids, texts, row = column.flatten().to_numpy(), [], 0
            while row < batch.num_rows:
                stop = max(row + 1, int(np.searchsorted(starts, starts[row] + IDS, "right")) - 1)
                some = starts[row:stop + 1]
                texts += decode_ids(ids[some[0]:some[-1]], some - some[0], pieces)
                row = stop
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())],
                                             names=[*keep, text])

    return ready.mapInArrow(add, schema)
