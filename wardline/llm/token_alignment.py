"""Which tokens of two tokenizers cover the same bytes, and how usual each pair of ids is in the corpus.

Tokenizer A is byte-level BPE over a space and the text, tokenizer B SentencePiece BPE over the text, which puts the
space in front itself. Both begin a token at a single space between other characters, whatever stands around, so a text's tokens
are those of its words (see ``words``), and each different word of a block is encoded once. Every place where both have a
token that begins with a space is an anchor, once the bytes before it are known to be the same; anchors cut the two id sequences into
windows. What a window's tokens have in common depends on its ids alone, so each pair of id tuples is aligned once in a block and
remembered.

A block is the unit of work: about four megabytes of texts, cut, encoded and aligned in slices. It holds its different windows and pairs
once, and of each document only how often it has which window. The corpus-wide counts are sums of the blocks'
counts; each block then gets back the counts of its own pairs, not one row for each document and pair.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import mix
from wardline.session import written

# fixed values: how the byte-level tokenizer cuts a text before it merges
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = "▁"
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 1 << 20
ID_BITS = 24

CHUNK = 1 << 14  # windows, or pairs, of a block that one row holds
# a row is a document, some of its block's windows from the number ``first`` on, or some of its pairs
DOCUMENT, WINDOWS, PAIRS = 0, 1, 2
BLOCK = ("block long, kind int, first int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
         "groups_sha256 string, window array<int>, times array<int>, sizes array<int>, pair_no array<int>, "
         "occurrences array<int>, pair array<bigint>, documents array<int>")
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32()),
          "array<bigint>": pa.list_(pa.int64())}
OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
       "groups_sha256 string")


# --- the two tokenizers ---------------------------------------------------------------------
def _printable() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary, and back: printable ones for themselves."""
    own = [b for b in range(256) if chr(b).isprintable() and b != 0x20]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE model file, encoded by a library that takes merges in the order of the ids."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        special = {t["content"] for t in stored["added_tokens"]}
        byte = _printable()
        ranks = {bytes(byte[c] for c in piece): number for piece, number in stored["model"]["vocab"].items()
                 if piece not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in stored["model"]["merges"]]
        order = [stored["model"]["vocab"]["".join(m)] for m in merges]
        if stored["normalizer"] or not stored["pre_tokenizer"]["use_regex"] or any(
                a >= b for a, b in zip(order, order[1:])):
            raise ValueError("only plain byte-level models whose ids follow the order of merges are supported")
        self.bytes: list[bytes] = [b""] * (max(stored["model"]["vocab"].values()) + 1)
        for piece, number in ranks.items():
            self.bytes[number] = piece
        self._codec = tiktoken.Encoding("byte-level", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        """The ids of a space and ``text``; names of special tokens are plain text."""
        return self._codec.encode_ordinary(" " + text)


class Pieces:
    """A SentencePiece model that puts a space in front."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(i) for i in range(self._model.vocab_size())]
        self.bytes = [bytes([int(n[3:5], 16)]) if self._model.is_byte(i) else n.replace(SPACE, " ").encode("utf-8")
                      for i, n in enumerate(names)]

    def encode(self, text: str) -> list[int]:
        return self._model.encode(text, num_threads=1)


@lru_cache(maxsize=2)
def _tokenizers(a: str, b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(a), Pieces(b)


# --- windows ----------------------------------------------------------------------------------
def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length says, in a row."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


@dataclass
class Sequences:
    """Pairs of id sequences over the same bytes, one after the other: ids of both sides, and where each pair's begin."""

    ids: tuple[np.ndarray, np.ndarray]
    ptr: tuple[np.ndarray, np.ndarray]

    @classmethod
    def none(cls) -> Sequences:
        return cls((np.empty(0, np.int64),) * 2, (np.zeros(1, np.int64),) * 2)

    def take(self, which: np.ndarray) -> Sequences:
        lengths = [np.diff(p)[which] for p in self.ptr]
        return Sequences(tuple(i[_spread(p[which], n)] for i, p, n in zip(self.ids, self.ptr, lengths)),
                         tuple(np.concatenate([[0], np.cumsum(n)]) for n in lengths))

    def joined(self, other: Sequences) -> Sequences:
        return Sequences(tuple(map(np.concatenate, zip(self.ids, other.ids))),
                         tuple(np.concatenate([p, p[-1] + q[1:]]) for p, q in zip(self.ptr, other.ptr)))

    def same(self, other: Sequences) -> np.ndarray:
        """Whether each pair equals that of ``other`` in the same place."""
        out = np.ones(len(self.ptr[0]) - 1, dtype=bool)
        for i, p, j, q in zip(self.ids, self.ptr, other.ids, other.ptr):
            out &= np.diff(p) == np.diff(q)
        at = np.flatnonzero(out)
        left, right = self.take(at), other.take(at)
        for i, p, j in zip(left.ids, left.ptr, right.ids):
            if len(at):
                out[at] &= np.logical_and.reduceat(i == j, p[:-1])
        return out

    def hashes(self) -> np.ndarray:
        out = np.zeros(len(self.ptr[0]) - 1, dtype=np.uint64)
        for side, (i, p) in enumerate(zip(self.ids, self.ptr)):
            place = np.arange(len(i)) - np.repeat(p[:-1], np.diff(p))
            marked = (i * 2 + side).astype(np.uint64) + (place.astype(np.uint64) << np.uint64(32))
            out += np.add.reduceat(mix(marked), p[:-1])
        return out

    def key(self, which: int) -> tuple[tuple[int, ...], ...]:
        return tuple(tuple(i[p[which]:p[which + 1]].tolist()) for i, p in zip(self.ids, self.ptr))


class Windows:
    """The windows of one block, numbered as they are met, with the pairs that each links.

    Known windows are found by a hash of their ids and compared with the ids themselves; windows that share a
    hash with another are kept apart by their id tuples.
    """

    def __init__(self, tokenizers: tuple[ByteLevel, Pieces]):
        tables = [t.bytes for t in tokenizers]
        self._sizes = [np.array([len(x) for x in t]) for t in tables]
        self._spaced = [np.array([x[:1] == b" " for x in t]) for t in tables]
        self._known = Sequences.none()
        self._hashes, self._numbers = np.empty(0, np.uint64), np.empty(0, np.int64)
        self._odd: dict[tuple, int] = {}
        self.pairs, self.times = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ptr = np.zeros(1, np.int64)

    def of(self, texts: list[tuple[list[int], list[int]]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text, its two sequences having the same bytes, the numbers of its windows and its ``written`` groups."""
        if not texts:
            return []
        first = [np.cumsum([len(t[side]) for t in texts])[:-1] for side in (0, 1)]
        _, anchors, numbers, codes = self.cut(texts)
        return list(zip(np.split(numbers, np.searchsorted(anchors, first[0])), np.split(codes, first[0] + first[1])))

    def cut(self, texts: list[tuple[list[int], list[int]]]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Of all texts in a row: at which byte the tokens of each side begin, which of A's tokens begin windows, the windows'
        numbers and the ``written`` groups."""
        ids = tuple(np.fromiter(chain.from_iterable(t[side] for t in texts), np.int64) for side in (0, 1))
        sizes = [s[i] for s, i in zip(self._sizes, ids)]
        starts = [np.cumsum(n) - n for n in sizes]
        begun = np.zeros(int(sizes[0].sum()), dtype=np.int8)  # 1, 2: a token of A, of B begins; 4, 8: with a space
        for side in (0, 1):
            begun[starts[side]] += ((1 + 4 * self._spaced[side][ids[side]]) << side).astype(np.int8)
        begins = [begun[s] for s in starts]
        anchors = [np.flatnonzero(x == 15) for x in begins]
        windows = Sequences(ids, tuple(np.append(a, len(i)) for a, i in zip(anchors, ids)))
        codes = _group_codes(ids, [(x & 3) == 3 for x in begins], len(self._sizes[0]))
        return starts, anchors[0], self._numbered(windows), codes

    def _numbered(self, windows: Sequences) -> np.ndarray:
        hashes, one, which = np.unique(windows.hashes(), return_index=True, return_inverse=True)
        distinct = windows.take(one)
        alike = windows.same(distinct.take(which))  # all, but for windows that share a hash
        at = np.searchsorted(self._hashes, hashes)
        met = at < len(self._hashes)
        met[met] = self._hashes[at[met]] == hashes[met]
        new = np.flatnonzero(~met)
        numbers = np.empty(len(one), dtype=np.int64)
        numbers[new] = self._add(distinct.take(new))
        numbers[met] = self._numbers[at[met]]
        wrong = np.zeros(len(one), dtype=bool)
        wrong[met] = ~distinct.take(np.flatnonzero(met)).same(self._known.take(numbers[met]))
        order = np.argsort(self._hashes_with(hashes[new]), kind="stable")
        self._hashes = self._hashes_with(hashes[new])[order]
        self._numbers = np.concatenate([self._numbers, numbers[new]])[order]
        out = numbers[which]
        for place in np.flatnonzero(~alike | wrong[which]).tolist():
            key = windows.key(place)
            if key not in self._odd:
                self._odd[key] = int(self._add(windows.take(np.array([place])))[0])
            out[place] = self._odd[key]
        return out

    def _hashes_with(self, more: np.ndarray) -> np.ndarray:
        return np.concatenate([self._hashes, more])

    def _add(self, windows: Sequences) -> np.ndarray:
        """Aligns windows that are not known yet; their numbers."""
        count = len(self.ptr) - 1
        window, pair, times = align(windows, self._sizes)
        found = np.bincount(window, minlength=len(windows.ptr[0]) - 1)
        self.pairs, self.times = np.concatenate([self.pairs, pair]), np.concatenate([self.times, times])
        self.ptr = np.concatenate([self.ptr, self.ptr[-1] + np.cumsum(found)])
        self._known = self._known.joined(windows)
        return np.arange(count, len(self.ptr) - 1)


def align(windows: Sequences, sizes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """window, pair (a << ID_BITS | b) and number of links, once for each pair of ids that a window links.

    Two tokens overlap for a stretch of bytes that begins where the later of them begins, and at each place where a token
    begins one pair's stretch does.
    """
    starts = [np.cumsum(n) - n for n in (s[i] for s, i in zip(sizes, windows.ids))]
    total = int(starts[0][-1] + sizes[0][windows.ids[0][-1]]) if len(starts[0]) else 0
    begun = np.zeros((2, total), dtype=bool)
    for side in (0, 1):
        begun[side, starts[side]] = True
    places = np.flatnonzero(begun[0] | begun[1])
    a, b = (np.cumsum(begun[side])[places] - 1 for side in (0, 1))
    window = np.repeat(np.arange(len(windows.ptr[0]) - 1), np.diff(windows.ptr[0]))[a]
    pair = (windows.ids[0][a] << ID_BITS) | windows.ids[1][b]
    order = np.lexsort((pair, window))
    window, pair = window[order], pair[order]
    first = np.flatnonzero(np.append(True, (window[1:] != window[:-1]) | (pair[1:] != pair[:-1]))[:len(pair)])
    return window[first], pair[first], np.diff(np.append(first, len(pair)))


def _group_codes(ids: tuple[np.ndarray, np.ndarray], opens: list[np.ndarray], first_b: int) -> np.ndarray:
    """The ids in the order in which groups are written, as places in ``_signs``."""
    heads = [np.flatnonzero(o) for o in opens]
    group = [np.cumsum(o) - 1 for o in opens]
    lasts = [np.append(o[1:], True) for o in opens]
    out = np.empty(len(ids[0]) + len(ids[1]), dtype=np.int64)
    out[np.arange(len(ids[0])) + heads[1][group[0]]] = 2 * ids[0] + lasts[0]
    out[np.arange(len(ids[1])) + np.append(heads[0], len(ids[0]))[group[1] + 1]] = 2 * (ids[1] + first_b) + lasts[1]
    return out


@lru_cache(maxsize=2)
def _signs(count_a: int, count_b: int) -> list[str]:
    """How an id is written: A's ids before another of the group and before B's, then B's and before the next group."""
    return [f"{i}{end}" for count, ends in ((count_a, ",|"), (count_b, ",;")) for i in range(count) for end in ends]


# --- blocks -----------------------------------------------------------------------------------
TOGETHER = 256  # words that are encoded at once
CUT = re.compile(r" (?<=\S )(?=\S)")


def cuts(text: str, limit: int) -> Iterator[str]:
    """``text`` in pieces of about ``limit`` characters, cut at a single space between two other characters.

    Both tokenizers begin a token there, whatever follows, so the pieces' tokens are those of the text. The space goes
    with neither piece, as both put one in front.
    """
    start = 0
    while len(text) - start > limit:
        at = CUT.search(text, start + limit)
        if not at:
            break
        yield text[start:at.start()]
        start = at.end()
    yield text[start:]


def words(text: str) -> list[str]:
    """``text`` cut wherever ``cuts`` may; what is left whole holds other white space, if any."""
    return CUT.split(text)


@dataclass
class Block:
    """The documents of a block so far, and its different words: what they were encoded to."""

    tokenizers: tuple[ByteLevel, Pieces]
    windows: Windows
    rows: list[tuple] = field(default_factory=list)  # doc_id, n_a, n_b, n_groups, n_links, groups_sha256
    content: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # windows of each document, and how often
    known: dict[str, int] = field(default_factory=dict)  # the number of each word
    written: list[str] = field(default_factory=list)  # its groups
    sizes: np.ndarray = field(default_factory=lambda: np.empty((3, 0), np.int64))  # n_a, n_b, groups; 0 if it has no tokens
    of_word: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # its windows, from ``ptr`` on
    ptr: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the words of each text; new words are encoded and aligned."""
        lists = list(map(words, texts))
        new = [w for w in dict.fromkeys(chain.from_iterable(lists)) if w not in self.known]
        if new:
            # white space that begins or ends a text can't be told from that of a neighbour
            self._learn(new, {w for x in lists for w in (x[0], x[-1]) if w != w.strip()})
        return [np.fromiter(map(self.known.__getitem__, x), np.int64, len(x)) for x in lists]

    def _learn(self, new: list[str], alone: set[str]) -> None:
        """``new`` words are encoded together, with single spaces between, but for those that must stand ``alone``."""
        inner = [w for w in new if w not in alone]
        groups = [*([w] for w in new if w in alone), *(inner[i:i + TOGETHER] for i in range(0, len(inner), TOGETHER))]
        found = [x for group in groups for x in self._encoded(group)]
        good = [w for some, ids in found if ids for w in some]
        self.known.update(zip(chain(good, (w for some, ids in found if not ids for w in some)), count(len(self.known))))
        bad = len(new) - len(good)
        if good:
            starts, anchors, numbers, codes = self.windows.cut([ids for _, ids in found if ids])
            ends = np.cumsum([1 + len(w.encode("utf-8")) for w in good])
            at = [np.append(0, np.searchsorted(x, ends)) for x in starts]  # where the tokens of each word begin
            of_codes = at[0] + at[1]
            last = codes < 2 * len(self.tokenizers[0].bytes)
            groups = np.append(0, np.cumsum(last & (codes & 1 == 1)))[of_codes]
            self.sizes = np.concatenate([self.sizes, np.diff([*at, groups])], axis=1)
            self.of_word = np.concatenate([self.of_word, numbers])
            self.ptr = np.append(self.ptr, self.ptr[-1] + np.searchsorted(anchors, at[0][1:]))
            signs = _signs(*(len(t.bytes) for t in self.tokenizers))
            texts, bounds = [signs[c] for c in codes.tolist()], of_codes.tolist()
            self.written += ["".join(texts[i:j]) for i, j in zip(bounds, bounds[1:])]
        # a word that a tokenizer changes has no tokens
        self.sizes = np.concatenate([self.sizes, np.zeros((3, bad), np.int64)], axis=1)
        self.ptr = np.append(self.ptr, np.repeat(self.ptr[-1], bad))
        self.written += [""] * bad

    def _encoded(self, some: list[str]) -> Iterator[tuple[list[str], tuple[list[int], list[int]] | None]]:
        """``some`` words and their ids; in smaller groups where a tokenizer changes one of them."""
        text = " ".join(some)
        ids = tuple(t.encode(text) for t in self.tokenizers)
        data = (" " + text).encode("utf-8")
        if all(b"".join(map(t.bytes.__getitem__, x)) == data for t, x in zip(self.tokenizers, ids)):
            yield some, ids
        elif len(some) == 1:
            yield some, None
        else:
            step = -(-len(some) // 16)
            for i in range(0, len(some), step):
                yield from self._encoded(some[i:i + step])

    def add(self, doc_id: int | None, parts: list[np.ndarray]) -> None:
        """A document by the numbers of its words, in parts that are written one by one; without parts it has no tokens."""
        word, often = np.unique(np.concatenate([np.empty(0, np.int64), *parts]), return_counts=True)
        n_a, n_b, groups = (self.sizes[:, word] * often).sum(axis=1).tolist()
        if not len(word) or not self.sizes[0, word].all():
            self.rows.append((doc_id, 0, 0, 0, 0, ""))
            return self.content.append((np.empty(0, np.int64),) * 2)
        digest = hashlib.sha256()
        for i, part in enumerate(parts):
            text = "".join(map(self.written.__getitem__, part.tolist()))
            digest.update(text[:-1 if i + 1 == len(parts) else None].encode())
        # a link begins where a token of either side does; where both do, a group begins
        self.rows.append((doc_id, n_a, n_b, groups, n_a + n_b - groups, digest.hexdigest()))
        sizes = self.ptr[word + 1] - self.ptr[word]
        window, back = np.unique(self.of_word[_spread(self.ptr[word], sizes)], return_inverse=True)
        times = np.zeros(len(window), np.int64)
        np.add.at(times, back, np.repeat(often, sizes))
        self.content.append((window, times))

    def batches(self, number: int) -> Iterator[pa.RecordBatch]:
        """The documents, the windows and the distinct pairs of the block, these with the number of documents that hold them."""
        w = self.windows
        pair, pair_no = np.unique(w.pairs, return_inverse=True)
        documents = np.zeros(len(pair), dtype=np.int64)
        for window, _ in self.content:
            documents[np.unique(pair_no[_spread(w.ptr[window], w.ptr[window + 1] - w.ptr[window])])] += 1
        window, times = (np.concatenate([np.empty(0, np.int64), *[c[k] for c in self.content]]) for k in (0, 1))
        ids, n_a, n_b, groups, links, digests = zip(*self.rows)
        at = np.cumsum([0, *[len(c) for c, _ in self.content]])
        yield _batch(number, DOCUMENT, np.zeros(len(ids)), {
            "doc_id": ids, "n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": links, "groups_sha256": digests,
            "window": (at, window), "times": (at, times)})
        first = np.arange(0, len(w.ptr) - 1, CHUNK)
        at, of_pairs = np.append(first, len(w.ptr) - 1), np.append(w.ptr[first], w.ptr[-1])
        yield _batch(number, WINDOWS, first, {"sizes": (at, np.diff(w.ptr)), "pair_no": (of_pairs, pair_no),
                                              "occurrences": (of_pairs, w.times)})
        first = np.arange(0, len(pair), CHUNK)
        at = np.append(first, len(pair))
        yield _batch(number, PAIRS, first, {"pair": (at, pair), "documents": (at, documents)})


def _batch(number: int, kind: int, first: np.ndarray, columns: dict) -> pa.RecordBatch:
    """Rows of one kind; a list column is given by where its rows begin and all values, others are NULL."""
    count = len(first)
    columns = {"block": [number] * count, "kind": [kind] * count, "first": first.astype(int).tolist()} | columns
    arrays = {}
    for name, kind_name in (part.split(" ") for part in BLOCK.split(", ")):
        value, arrow = columns.get(name), _ARROW[kind_name]
        if value is None:
            arrays[name] = pa.nulls(count, arrow)
        elif pa.types.is_list(arrow):
            at, values = value
            arrays[name] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values).cast(arrow.value_type)).cast(arrow)
        else:
            arrays[name] = pa.array(list(value), arrow)
    return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))


def blocks(docs: DataFrame, a: str, b: str, *, block_bytes: int = BLOCK_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The blocks of ``docs`` (doc_id, text) as rows; see ``BLOCK``.

    A text that is null or empty, or that a tokenizer changes, has no tokens. A text longer than a slice is encoded and
    aligned piece by piece.
    """
    def flush(block: Block, waiting: list[tuple]) -> None:
        found = iter(block.numbers([text for _, text in waiting if text]))
        for doc_id, text in waiting:
            block.add(doc_id, [next(found)] if text else [])
        waiting.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _tokenizers(a, b)
        number = TaskContext.get().partitionId() << 32
        block, waiting, size, held = Block(tokenizers, Windows(tokenizers)), [], 0, 0
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                if text and len(text) > slice_bytes:
                    flush(block, waiting)
                    held = 0
                    block.add(doc_id, [block.numbers([piece])[0] for piece in cuts(text, slice_bytes)])
                else:
                    waiting.append((doc_id, text))
                size, held = size + len(text or ""), held + len(text or "")
                if held >= slice_bytes or len(waiting) >= 10_000:
                    flush(block, waiting)
                    held = 0
                if size >= block_bytes or len(block.rows) >= 100_000:
                    flush(block, waiting)
                    yield from block.batches(number)
                    number += 1
                    block, size, held = Block(tokenizers, Windows(tokenizers)), 0, 0
        flush(block, waiting)
        if block.rows:
            yield from block.batches(number)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, BLOCK)


def pair_counts(found: DataFrame) -> DataFrame:
    """pair and value of each linked pair of ids: twice its number of documents, one more if no pair of its A id has more."""
    pairs = found.filter(F.col("kind") == PAIRS).select(
        F.explode(F.arrays_zip("pair", "documents")).alias("p")).select("p.*")
    counts = written(pairs.groupBy("pair").agg(F.sum("documents").alias("n")), "pair-counts")
    # as many rows as tokenizer A has ids
    best = counts.groupBy(_a_id(F.col("pair")).alias("a")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(best), _a_id(F.col("pair")) == F.col("a")).select(
        "pair", (F.col("n") * 2 + (F.col("n") == F.col("most")).cast("long")).alias("value"))


def _a_id(pair: Column) -> Column:
    return F.shiftright(pair, ID_BITS)


def alignments(docs: DataFrame, a: str, b: str, *, block_bytes: int = BLOCK_BYTES,
               slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """How the tokens of ``docs`` (doc_id, text) by the model files ``a`` and ``b`` lie over each other.

    One row for each row of ``docs``: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair is in as many
    documents as any of its A id, ties included), count_sum (documents of the links' pairs) and groups_sha256. A
    row counts as a document of its own, whether or not another has its id or text. Null and empty texts, and those
    whose tokens do not give back a space and the text, have no tokens: zeros and an empty digest.
    Other columns are not read. Texts stay where they are; what is shuffled is the blocks' distinct pairs and, once,
    the blocks' windows.
    """
    found = written(blocks(docs, a, b, block_bytes=block_bytes, slice_bytes=slice_bytes), "aligned-blocks")
    wanted = found.filter(F.col("kind") == PAIRS).select("block", "first", F.posexplode("pair").alias("place", "pair"))
    values = wanted.join(pair_counts(found), "pair").select(
        F.col("block").alias("of"), (F.col("first") + F.col("place")).alias("place"), "value")
    rows = found.filter(F.col("kind") != PAIRS).drop("pair", "documents")

    def summed(block: pa.Table, value: pa.Table) -> pa.Table:
        value_of = np.zeros(value.num_rows, dtype=np.int64)
        value_of[value["place"].to_numpy()] = value["value"].to_numpy()
        windows = block.filter(pc.equal(block["kind"], WINDOWS)).sort_by("first")
        docs = block.filter(pc.equal(block["kind"], DOCUMENT))
        get = {n: t[n].combine_chunks().flatten().to_numpy().astype(np.int64) for t, names in (
            (windows, ("sizes", "pair_no", "occurrences")), (docs, ("window", "times"))) for n in names}
        ptr = np.concatenate([[0], np.cumsum(get["sizes"])])
        doc_ptr = np.concatenate([[0], np.cumsum(pc.list_value_length(docs["times"]).to_numpy())])
        each = value_of[get["pair_no"]]
        of_window = [_sums(get["occurrences"] * part, ptr) for part in (each & 1, each >> 1)]
        best, total = (_sums(w[get["window"]] * get["times"], doc_ptr) for w in of_window)
        names = [c.split(" ")[0] for c in OUT.split(", ")]
        own = {"n_best": pa.array(best), "count_sum": pa.array(total)}
        return pa.table([own[n] if n in own else docs[n] for n in names], names=names)

    return rows.groupBy("block").cogroup(values.groupBy("of")).applyInArrow(summed, OUT)


def _sums(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return running[ptr[1:]] - running[ptr[:-1]]
