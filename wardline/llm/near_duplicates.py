"""Near duplicates by HyperMinHash: banded, compressed registers, then exact confirmation.

A document's set is that of its distinct shingles, as 64-bit hashes. A register keeps the smallest hash of a
bucket, compressed to the number of its leading zeros (6 bits) and the 10 bits after the first one.

* For banding, each of ``BANDS`` hash functions deals the shingles into four buckets; its four registers
  are one 64-bit band. Two sets with Jaccard similarity J agree in a band with probability of about J**4, also
  if they are small: 0.32 at 0.75, so a pair at the threshold escapes all 32 bands with probability 5e-6.
* For estimating J, ``BUCKETS`` further registers hold one function's minima. The share of equal ones among those
  that are not empty on both sides, less what equal compressed values of unequal minima add, estimates J;
  a small set is nearly all in its registers, so its estimate is nearly exact.

Documents with equal sets are one class from the start. Classes that share a band are compared by their
registers. Pairs well below the threshold are dropped, all others are confirmed on their full sets, and
confirmed pairs make components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import mix, slices, word_hashes
from wardline.llm.components import components
from wardline.session import written

WORDS = 5
PERCENT = 75
BANDS = 32
BAND_BUCKETS = 4
BUCKETS = 256
MANTISSA = 10
COLLISION = 2.0 ** -(MANTISSA + 1)  # of two registers whose minima differ, about
DEVIATIONS = 4.5  # standard deviations below the threshold at which a pair is dropped,
LEAST_MARGIN = 0.09  # and at least so far below it
PARTNERS = (1, None)  # that a class may confirm in each round
SPLIT_ROWS = 1_024  # rows of a group that meet in one task
EMPTY = np.uint16(0xFFFF)

_RANDOM = np.random.default_rng(20)
FACTORS = _RANDOM.integers(1, 1 << 63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RANDOM.integers(0, 1 << 63, BANDS, dtype=np.uint64)


def shingle_hashes(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of the runs of ``size`` words; a shorter text is one run."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i:len(words) - size + 1 + i]
    return np.unique(mix(total + np.uint64(size)))


def sets_of(column: pa.Array) -> list[np.ndarray]:
    hashes, starts = word_hashes(column)
    return [shingle_hashes(hashes[a:b]) for a, b in zip(starts[:-1], starts[1:])]


def joined(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All hashes in a row, and where each set starts."""
    sizes = np.array([len(s) for s in sets])
    return np.concatenate(sets), np.cumsum(sizes) - sizes


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """The bands of non-empty sets, a row each: four registers side by side."""
    data, starts = joined(sets)
    out = np.empty((len(sets), BANDS * BAND_BUCKETS), dtype=np.uint16)
    for band in range(BANDS):
        hashed = data * FACTORS[band] + OFFSETS[band]
        hashed ^= hashed >> np.uint64(29)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        for bucket in range(BAND_BUCKETS):
            # the bucket's hashes come first once its number is taken off
            least = np.minimum.reduceat(hashed - (np.uint64(bucket) << np.uint64(62)), starts)
            out[:, band * BAND_BUCKETS + bucket] = compress(least)
    return out.view(np.int64)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The registers of non-empty sets for estimating, a row each."""
    data, starts = joined(sets)
    bucket = (data >> np.uint64(56)).astype(np.int64)
    # a set is sorted, so the first hash of each bucket is its smallest
    first = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    first[starts] = True
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = np.full((len(sets), BUCKETS), EMPTY, dtype=np.uint16)
    least = (data[first] & np.uint64((1 << 56) - 1)) << np.uint64(6)
    out[row[first], bucket[first]] = compress(least)
    return out


def compress(least: np.ndarray) -> np.ndarray:
    """Leading zeros of a 62-bit minimum and the bits after its first one; larger values: empty."""
    empty = least >> np.uint64(62) != 0
    value = np.where(empty, np.uint64(1), np.maximum(least, np.uint64(1)))
    # the place of the first one, exact: 53 bits are enough once the rest is cut off
    high = value >> np.uint64(31)
    top = np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 31,
                   np.frexp((value & np.uint64((1 << 31) - 1)).astype(np.float64))[1])
    zeros = (62 - top).astype(np.uint64)
    first = (value << (zeros + np.uint64(3)))  # the bits after the first one, from the top
    packed = (zeros << np.uint64(MANTISSA)) | (first >> np.uint64(64 - MANTISSA))
    return np.where(empty, EMPTY, packed.astype(np.uint16))


def similarity(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated Jaccard similarity of rows of registers, corrected for chance collisions, and the
    number of registers that it rests on."""
    counted = ~((left == EMPTY) & (right == EMPTY))
    equal = ((left == right) & counted).sum(axis=-1)
    used = np.maximum(counted.sum(axis=-1), 1)
    return (equal / used - COLLISION) / (1 - COLLISION), used


def plausible(estimate: np.ndarray, used: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether pairs may reach the threshold, by their estimates and the sums of their sizes.

    The registers in use are a draw without replacement from the union, whose size at the threshold
    follows from the sizes; the fewer are left out, the surer the estimate.
    """
    least = PERCENT / 100
    left_out = np.clip(1 - used / (sizes / (1 + least)), 0, 1)
    deviation = np.sqrt(least * (1 - least) / used * left_out)
    return estimate >= least - np.maximum(LEAST_MARGIN, DEVIATIONS * deviation)


SKETCH = ("doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, "
          "registers binary")


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set, bands and registers (null: an empty set)."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = sets_of(batch.column(1))
            full = [i for i, s in enumerate(sets) if len(s)]
            digests = np.zeros((2, len(sets)), dtype=np.uint64)
            lines: list[list[int] | None] = [None] * len(sets)
            held: list[bytes | None] = [None] * len(sets)
            if full:
                some = [sets[i] for i in full]
                for i, line, kept in zip(full, band_keys(some).tolist(), registers(some)):
                    lines[i], held[i] = line, kept.tobytes()
                    digests[:, i] = sets[i].sum(), mix(sets[i] + np.uint64(1)).sum()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 *(pa.array(d.view(np.int64)) for d in digests),
                 pa.array(lines, pa.list_(pa.int64())), pa.array(held, pa.binary())],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "registers"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(sketch, SKETCH)


def register_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), BUCKETS)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document of ``docs`` (doc_id, text).

    A null text and one without words have an empty set and are linked with nothing; with
    fewer than five words the whole text is one shingle. Rows with equal sets are linked whatever
    their number, also repeated rows; rows with one doc_id are one document, so they are linked too. Rows without a doc_id have no
    component of their own: they get that of an equal text, or none, and are kept unless an equal text has an id. Other
    columns play no part; an empty table gives an empty result.

    Nothing grows with the square of a group: equal sets are one class; in a band's bucket every
    class is first linked to one centre, and only classes that confirmed links have not joined are
    compared with each other, in blocks, by their registers. Of those that pass, each class
    confirms its best partner first, then all that are left and still in different components; so no
    link between different components goes untried.
    """
    sketched = written(sketches(docs), "sketches")
    keys = ["n_shingles", "set_a", "set_b"]
    sets = sketched.filter("n_shingles > 0")
    firsts = sets.groupBy(*keys).agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL")
    classes = written(sets.join(firsts, [*keys, "doc_id"], "left_semi")
                      .withColumnRenamed("doc_id", "rep"), "classes")
    members = written(shared_buckets(classes), "members")
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = written(docs.select(F.col("doc_id").cast("bigint"), "text").join(
        wanted, "doc_id", "left_semi"), "texts")
    roots = linked(members, classes, texts)

    homes = (classes.select(*keys, "rep").distinct()
             .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .groupBy(*keys).agg(F.min(F.coalesce("root", "rep")).alias("_home")))
    found = sketched.select("doc_id", *keys).join(homes, keys, "left")
    component = F.coalesce("_home", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))


def shared_buckets(classes: DataFrame) -> DataFrame:
    """rep, band, key and centre (the smallest rep) of the buckets that hold several classes."""
    rows = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    several = (rows.groupBy("band", "key").agg(F.min("rep").alias("centre"), F.max("rep").alias("_last"))
               .filter("_last > centre").drop("_last"))
    return rows.join(several, ["band", "key"])


def linked(members: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """node and root of every class that a confirmed link joins to another."""
    stars = members.filter("rep <> centre").select(
        F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    best = F.max_by(F.struct("a", "b"), F.struct("estimate", -F.col("a")))
    tried = written(estimated(stars, classes).groupBy("b").agg(best.alias("_p")).select("_p.*"), "tried")
    roots = written(components(written(confirmed(tried, texts), "links")), "roots")
    for partners in PARTNERS:
        pairs = written(open_pairs(members, classes, roots, tried, partners), "pairs")
        if pairs.isEmpty():  # a round with limited partners may offer tried pairs alone
            continue
        tried = tried.unionByName(pairs)
        links = written(confirmed(pairs, texts), "links")
        if not links.isEmpty():
            so_far = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = written(components(so_far.unionByName(links)), "roots")
    return roots


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that may be similar enough, with the estimate of their similarity."""
    known = classes.select("rep", "n_shingles", "registers")
    sides = pairs
    for side in ("a", "b"):
        sides = sides.join(known.select(F.col("rep").alias(side), F.col("n_shingles").alias(f"n_{side}"),
                                        F.col("registers").alias(f"registers_{side}")), side)
    sides = sides.filter(near_sizes(F.col("n_a"), F.col("n_b")))

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, used = similarity(register_rows(batch.column(2)), register_rows(batch.column(3)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)],
                                             names=["a", "b", "estimate"]).filter(
                pa.array(plausible(found, used, batch.column(4).to_numpy())))

    sizes = (F.col("n_a") + F.col("n_b")).alias("n")
    return sides.select("a", "b", "registers_a", "registers_b", sizes).mapInArrow(
        estimate, "a long, b long, estimate double")


def near_sizes(left: Column, right: Column) -> Column:
    return F.least(left, right) * 100 >= F.greatest(left, right) * PERCENT


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    The text of b travels to that of a. Texts of an ``a`` with many partners are dealt to
    several tasks, each with a copy of ``a``; a task holds one set and one slice of texts.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(SPLIT_ROWS)).cast("int").alias("_parts"))
    dealt = pairs.join(counts, "a").withColumn(
        "part", F.pmod(F.xxhash64("b"), F.col("_parts")).cast("int"))
    centres = counts.select("a", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"),
                            F.lit(None).cast("bigint").alias("b"))
    left = centres.join(texts.withColumnRenamed("doc_id", "a"), "a")
    right = dealt.select("a", "part", "b").join(texts.withColumnRenamed("doc_id", "b"), "b")
    rows = left.select("a", "part", "b", "text").unionByName(right.select("a", "part", "b", "text"))
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[np.ndarray] = []
        before = None
        for batch in slices(batches, "text"):
            found = []
            a, part, b = (batch.column(i).to_pylist() for i in range(3))
            for at, members in zip(zip(a, part, b), sets_of(batch.column(3))):
                if at[2] is None:  # rows of one id with several texts stand together
                    own = [*own, members] if before == at[:2] else [members]
                    before = at[:2]
                elif any(similar(members, x) for x in own):
                    found.append((at[0], at[2]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)],
                                                 names=["a", "b"])

    return rows.mapInArrow(confirm, "a long, b long").distinct()


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    small, large = sorted((len(left), len(right)))
    if not small or 100 * small < PERCENT * large:
        return False
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * common >= PERCENT * (small + large - common)


def open_pairs(members: DataFrame, classes: DataFrame, roots: DataFrame, tried: DataFrame,
               partners: int | None) -> DataFrame:
    """Untried pairs of classes of one bucket that are in different components so far.

    With ``partners``, only so many of the most similar ones of each class.
    """
    placed = members.select("band", "key", "rep").join(
        roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "root", F.coalesce("root", "rep"))
    mixed = placed.groupBy("band", "key").agg(
        F.min("root").alias("_low"), F.max("root").alias("_high"),
        F.ceil(F.count(F.lit(1)) / F.lit(SPLIT_ROWS)).cast("int").alias("_blocks")).filter(
        "_low < _high").drop("_low", "_high")
    rows = placed.join(mixed, ["band", "key"]).join(
        classes.select("rep", "n_shingles", "bands", "registers"), "rep")
    # a block meets every other block of its bucket in one task, and itself in one
    own = F.pmod(F.xxhash64("rep"), F.col("_blocks")).cast("int")
    rows = rows.withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.select("band", "key", F.least("_own", "_other").alias("low"),
                       F.greatest("_own", "_other").alias("high"), "_own", "rep", "root", "n_shingles", "bands",
                       "registers")
    keys = ["band", "key", "low", "high"]
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "root", "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in key_runs(batches, len(keys)):
            found = compare_block(block, partners)
            if len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["a", "b", "estimate"])

    found = rows.mapInArrow(compare, "a long, b long, estimate double").distinct()
    found = found.join(tried, ["a", "b"], "left_anti")  # the smaller id is a in both
    if partners is None:
        return found.select("a", "b")
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"), "estimate"))
    order = Window.partitionBy("a").orderBy(F.col("estimate").desc(), "b")
    return (both.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= partners)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def key_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The rows of each key of sorted batches, across their borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(keys)]
        changes = np.zeros(batch.num_rows, dtype=bool)
        for values in columns:
            changes[1:] |= values[1:] != values[:-1]
        borders = [0, *np.flatnonzero(changes).tolist(), batch.num_rows]
        for start, stop in zip(borders[:-1], borders[1:]):
            key = tuple(values[start] for values in columns)
            if held and key != last:
                yield pa.concat_batches(held) if len(held) > 1 else held[0]
                held = []
            held.append(batch.slice(start, stop - start))
            last = key
    if held:
        yield pa.concat_batches(held) if len(held) > 1 else held[0]


def compare_block(block: pa.RecordBatch, partners: int | None
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a block, sorted by root, that are in different components and may be similar.

    A pair that shares several bands is found in the first of them only. With ``partners``, a pair
    is left out unless it is among that many of the most similar ones of one of its two.
    """
    band, low, high = (block.column(i)[0].as_py() for i in (0, 2, 3))
    own, reps, roots, sizes = (block.column(i).to_numpy() for i in (4, 5, 6, 7))
    nothing = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    if roots[0] == roots[-1]:
        return nothing
    bands = block.column(8).flatten().to_numpy(zero_copy_only=False).reshape(len(reps), BANDS)
    lines = register_rows(block.column(9))
    out: list[tuple] = []
    ends = np.searchsorted(roots, roots, "right")  # later components start there
    step = max(1, (1 << 22) // (len(reps) * BUCKETS))
    for start in range(0, len(reps), step):
        some = np.arange(start, min(start + step, len(reps)))
        i, j = np.nonzero(np.arange(len(reps))[None, :] >= ends[some][:, None])
        i = some[i]
        near = np.minimum(sizes[i], sizes[j]) * 100 >= np.maximum(sizes[i], sizes[j]) * PERCENT
        if low != high:
            near &= own[i] != own[j]  # within a block, its own task compares
        i, j = i[near], j[near]
        estimate, used = similarity(lines[i], lines[j])
        near = plausible(estimate, used, sizes[i] + sizes[j])
        i, j, estimate = i[near], j[near], estimate[near]
        near = (bands[i] == bands[j]).argmax(axis=1) == band
        out.append((i[near], j[near], estimate[near]))
    i, j, estimate = (np.concatenate(x) for x in zip(*out))
    if partners is not None and len(i):
        chosen = best_of_each(i, estimate, partners) | best_of_each(j, estimate, partners)
        i, j, estimate = i[chosen], j[chosen], estimate[chosen]
    return np.minimum(reps[i], reps[j]), np.maximum(reps[i], reps[j]), estimate


def best_of_each(keys: np.ndarray, values: np.ndarray, most: int) -> np.ndarray:
    """Which entries are among the ``most`` highest of their key."""
    order = np.lexsort((-values, keys))
    starts = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0]))
    place = np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))
    chosen = np.zeros(len(keys), dtype=bool)
    chosen[order[place < most]] = True
    return chosen
