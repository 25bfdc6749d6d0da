"""Language identification by prediction by partial matching.

For each language the bytes of a training sample give a tree of contexts of up to ``order`` bytes. After a context
that was seen n times with d different next bytes, a byte seen c times costs -log2(c / (n + d)) bits, and
an escape to the next shorter context -log2(d / (n + d)); below the empty context every byte costs 8.
The statistics are frozen after training, so the code length of a text under a language is a sum over
its bytes, and it is computed exactly for the whole text. The shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import crc_remainder, fresh, slices, text_bytes
from wardline.session import written

ORDER = 4
SAMPLE_BYTES = 1 << 20  # size of the training sample of a language
TOTAL_BYTES = 1 << 25  # and of all languages together
PIECE_BYTES = 1 << 12  # texts are drawn in pieces of this size
MAX_LANGUAGES = 1024
UNDETERMINED = "und"


def packed(data: np.ndarray, order: int) -> np.ndarray:
    """The number made of each byte and the ``order`` bytes before it."""
    grams = data[order:].astype(np.uint64)
    for back in range(1, order + 1):
        grams |= data[order - back:len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    return grams


def count_contexts(samples: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, length (of the context), gram and n, of ``samples`` (lang, text)."""
    schema = "lang string, length int, gram long, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found: dict[tuple[str, int], list] = {}
            for lang, text in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                data = np.frombuffer(text.encode("utf-8"), np.uint8)
                for length in range(min(order, len(data) - 1) + 1 if len(data) else 0):
                    found.setdefault((lang, length), []).append(packed(data, length))
            for (lang, length), grams in found.items():
                values, counts = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()),
                     pa.array(np.full(len(values), length, np.int32)),
                     pa.array(values.astype(np.int64)), pa.array(counts.astype(np.int64))],
                    names=["lang", "length", "gram", "n"])

    return samples.select("lang", "text").mapInArrow(count, schema).groupBy(
        "lang", "length", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Costs in bits of all seen grams, and of escaping from all seen contexts, by language."""

    def __init__(self, counts: pa.Table, order: int = ORDER) -> None:
        self.order = order
        self.languages = sorted(set(counts["lang"].to_pylist()), key=lambda x: x.encode("utf-8"))
        place = {x: i for i, x in enumerate(self.languages)}
        lang = np.array([place[x] for x in counts["lang"].to_pylist()], dtype=np.int64)
        length, gram, n = (counts[c].to_numpy() for c in ("length", "gram", "n"))
        gram = gram.astype(np.uint64)
        self.grams, self.costs, self.contexts, self.escapes = [], [], [], []
        shorter = np.full((256, len(place)), 8.0)
        shorter_grams = np.arange(256, dtype=np.uint64)
        for k in range(order + 1):
            of = length == k
            grams, row = np.unique(gram[of], return_inverse=True)
            contexts, context_of = np.unique(grams >> np.uint64(8), return_inverse=True)
            seen = np.zeros((len(grams), len(place)))
            seen[row, lang[of]] = n[of]
            total = np.zeros((len(contexts), len(place)))
            kinds = np.zeros_like(total)
            np.add.at(total, context_of, seen)
            np.add.at(kinds, context_of, (seen > 0).astype(float))
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(kinds > 0, -np.log2(kinds / (total + kinds)), 0.0)
                direct = -np.log2(seen / (total + kinds)[context_of])
            # a seen gram's shorter gram was seen too; below the empty context stands every byte
            suffix = grams & np.uint64((1 << (8 * max(k, 1))) - 1)
            below = shorter[np.searchsorted(shorter_grams, suffix)]
            if k == 0:  # every byte has a cost after the empty context
                full = escape[0] + 8.0 if len(contexts) else np.full(len(place), 8.0)
                costs = np.tile(full, (256, 1))
                costs[grams.astype(int)] = np.where(seen > 0, direct, full)
                grams = np.arange(256, dtype=np.uint64)
            else:
                costs = np.where(seen > 0, direct, escape[context_of] + below)
            self.grams.append(grams)
            self.costs.append(costs)
            self.contexts.append(contexts)
            self.escapes.append(escape)
            shorter, shorter_grams = costs, grams

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for part in (self.grams, self.costs, self.contexts, self.escapes) for x in part)

    def code_lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits of each text under each language; ``starts`` are the places of the texts in ``data``."""
        out = np.zeros((len(starts) - 1, len(self.languages)))
        text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        behind = np.arange(len(data)) - starts[:-1][text]  # bytes of the text before this one
        grams = np.zeros(len(data), dtype=np.uint64)
        grams[:] = data
        for back in range(1, self.order + 1):
            grams[back:] |= data[:-back].astype(np.uint64) << np.uint64(8 * back)
        rest = np.arange(len(data))
        for k in range(self.order, -1, -1):
            # texts start without a context; their first bytes wait for a short one
            ready = behind[rest] >= k
            here, later = rest[ready], rest[~ready]
            gram = grams[here] & np.uint64((1 << (8 * (k + 1))) - 1)
            known, row = find(self.grams[k], gram)
            self._add(out, text, here[known], self.costs[k], row[known])
            missed, gram = here[~known], gram[~known]
            seen, row = find(self.contexts[k], gram >> np.uint64(8))
            self._add(out, text, missed[seen], self.escapes[k], row[seen])
            rest = np.concatenate([missed, later])
        return out

    def _add(self, out, text, places, values, rows) -> None:
        of = text[places]
        for lang in range(out.shape[1]):
            out[:, lang] += np.bincount(of, weights=values[rows, lang], minlength=len(out))


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is in the sorted table, and where."""
    if not len(table):
        return np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64)
    row = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[row] == keys, row


def train(docs: DataFrame, *, order: int = ORDER, sample_bytes: int = SAMPLE_BYTES,
          total_bytes: int = TOTAL_BYTES) -> Model:
    """A model of the languages of ``docs`` (doc_id, text, lang).

    Rows without a text or a language teach nothing. Texts are drawn in pieces: of each language the first in the order
    of a hash, until ``sample_bytes`` are reached, fewer if all languages would pass ``total_bytes``. So a language
    gives one piece at least and at most one more than fits, however long its texts are; a smaller language is taken
    whole. That bounds what is counted, collected and broadcast.
    """
    return Model(count_contexts(drawn(docs, sample_bytes, total_bytes), order).toArrow(), order)


def piece_key(number: Column) -> Column:
    """Where a piece stands in its language's order."""
    return F.xxhash64("doc_id", number, "_hash")


def drawn(docs: DataFrame, sample_bytes: int, total_bytes: int) -> DataFrame:
    """lang and text (lowered) of the drawn pieces; those that follow each other in a text are one.

    The order is cut in two steps, by sums over the 4,096 ranges of keys and then inside one range, so no task sees all
    pieces of a language. Pieces of rows that are equal throughout have one key; of the last key, as many as fit.
    """
    texts = docs.filter("text IS NOT NULL AND text <> '' AND lang IS NOT NULL").select(
        "doc_id", "lang", F.lower("text").alias("text"))
    texts = texts.select("*", F.xxhash64("text").alias("_hash"), F.octet_length("text").alias("_n"))
    last = ((F.col("_n") - 1) / PIECE_BYTES).cast("int")
    pieces = texts.select("lang", "doc_id", "_hash", "_n", F.explode(F.sequence(F.lit(0), last)).alias("_piece"))
    pieces = pieces.select(
        "lang", piece_key(F.col("_piece")).alias("key"),
        F.least(F.lit(PIECE_BYTES), F.col("_n") - F.col("_piece") * PIECE_BYTES).cast("long").alias("size"))
    ranges = written(pieces.groupBy("lang", F.shiftright("key", 52).alias("range")).agg(
        F.sum("size").alias("size")), "language-ranges")
    languages = ranges.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    limit = min(sample_bytes, total_bytes // max(1, languages))

    def cut(sums: DataFrame, by: str, start: Column) -> DataFrame:
        """The last row of each language before which the limit isn't reached."""
        before = Window.partitionBy("lang").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", start + F.coalesce(F.sum("size").over(before), F.lit(0)))
        rest = [c for c in sums.columns if c not in ("lang", by)]
        # the first row counts even if there is no limit to speak of
        fits = (F.col("before") < limit) | (F.col("before") == 0)
        return sums.filter(fits).groupBy("lang").agg(F.max(F.struct(by, *rest)).alias("_cut")).select("lang", "_cut.*")

    last_range = cut(ranges, "range", F.lit(0)).select("lang", "range", F.col("before").alias("_start"))
    inside = pieces.withColumn("range", F.shiftright("key", 52)).join(F.broadcast(last_range), ["lang", "range"])
    keys = inside.groupBy("lang", "key").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("copies"), F.max("_start").alias("_start"))
    fitting = F.least("copies", F.greatest(F.lit(1), F.ceil(
        (F.lit(limit) - F.col("before")) * F.col("copies") / F.col("size"))))
    cuts = written(cut(keys, "key", F.col("_start")).select(
        "lang", F.col("key").alias("_cut"), fitting.cast("int").alias("_some"),
        (fitting == F.col("copies")).alias("_all")), "language-cuts")

    known = texts.join(F.broadcast(cuts), "lang")
    numbers = F.sequence(F.lit(0), last)

    def chosen(rows: DataFrame, condition) -> DataFrame:
        picked = F.filter(numbers, lambda i: condition(piece_key(i)))
        return rows.select("lang", "text", "_some", picked.alias("_pieces")).filter("size(_pieces) > 0")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [(lang, run, some) for lang, text, some, numbers in zip(*(c.to_pylist() for c in batch.columns))
                    for run in runs(text, numbers)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32()))],
                names=["lang", "text", "some"])

    schema = "lang string, text string, some int"
    below = chosen(known, lambda key: (key < F.col("_cut")) | (F.col("_all") & (key == F.col("_cut"))))
    at = chosen(known.filter("NOT _all"), lambda key: key == F.col("_cut")).mapInArrow(take, schema)
    at = at.groupBy("lang").agg(F.min(F.struct("text", "some")).alias("_row")).select(
        "lang", "_row.text", F.explode(F.array_repeat(F.lit(0), F.col("_row.some"))).alias("_copy"))
    return below.mapInArrow(take, schema).select("lang", "text").unionByName(at.select("lang", "text"))


def runs(text: str, numbers: list[int]) -> Iterator[str]:
    """The pieces of a text, those with following numbers as one; a character belongs to where it starts."""
    data = text.encode("utf-8")

    def border(place: int) -> int:
        while place < len(data) and data[place] & 0xC0 == 0x80:
            place += 1
        return min(place, len(data))

    first = 0
    for i, number in enumerate(numbers):
        if i + 1 == len(numbers) or numbers[i + 1] != number + 1:
            yield data[border(numbers[first] * PIECE_BYTES):border((number + 1) * PIECE_BYTES)].decode("utf-8")
            first = i + 1


def has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


def predict(docs: DataFrame, model: Model, *, prediction: str = "lang_pred",
            score: str = "score", keep_text: bool = False) -> DataFrame:
    """The columns of ``docs``, the text only if asked for, with the prediction and its score.

    The score is the winner's share of the probability that all languages give the text, from 0
    to 1. A text that is null or has no letter is ``und`` with score 0, as is every text if nothing was learned. Ties
    go to the first language by code point. Case plays no part. Columns of ``docs`` that are
    called as the new ones are replaced. No shuffle; a task holds slices of about a megabyte or one text.
    """
    dropped = {prediction, score} | (set() if keep_text else {"text"})
    keep = [c for c in docs.columns if c not in dropped]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    lowered = fresh(keep, "_text")
    text = F.when(has_letter(F.col("text")), F.lower("text")).alias(lowered)
    ready = docs.select(*keep, text)
    fields = [ready.schema[c] for c in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                       + [f"`{prediction}` string", f"`{score}` double"])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        for batch in slices(batches, lowered):
            column = batch.column(len(keep))
            best = np.full(batch.num_rows, len(model.languages))
            sure = np.zeros(batch.num_rows)
            if model.languages:
                bits = model.code_lengths(*text_bytes(column))
                told = column.is_valid().to_numpy(zero_copy_only=False)
                best[told] = bits.argmin(axis=1)[told]
                least = bits.min(axis=1, keepdims=True)
                sure[told] = (1 / np.exp2(least - bits).sum(axis=1))[told]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(names[best].tolist(), pa.string()), pa.array(sure)],
                names=[*keep, prediction, score])

    return ready.mapInArrow(label, schema)


def held_out(docs: DataFrame) -> DataFrame:
    return docs.withColumn("held_out", crc_remainder(F.col("doc_id"), 4) == 2)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score; learns from the documents that are not held out."""
    marked = held_out(docs.select("doc_id", "text", "lang"))
    model = train(marked.filter("NOT held_out"))
    return predict(marked.select("doc_id", "held_out", "text"), model)
