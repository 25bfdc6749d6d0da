"""Mixing sources to target weights: hash-random order, prefix sums of sizes, exact cuts.

A source that is to give more than it holds is gone through again, a whole epoch at a
time; the rest of its budget is a prefix of a random order of its documents, cut at the
exact word. The order depends on the document id and a seed alone, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.lookups import lookup_join
from wardline.llm.common import word_count
from wardline.session import written

MAX_EPOCHS = 3
RANGES = 3  # hexadecimal digits of the key that name a range: 4,096 ranges in a source


def random_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
                 .cast("binary"))


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source_size`` and ``target`` of every source of ``sizes`` (source, size).

    Sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3, ... and share all words by
    weight. A target stops at ``max_epochs`` times its source; what is over is shared
    again by weight among the others. That ends with one rate of words per weight: with
    the sources ordered by limit / weight, a first part of them is at its limit and the rest
    takes rate * weight. Taking sources out of the sharing raises the rate of the others as long
    as they are over their limit and lowers it from then on, so the rate is the highest of
    those that cuts at each source give. The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weighed = totals.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1).withColumn(
        "full", F.col("source_size") * max_epochs)
    fills = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").isNull(),
                           F.col("source").cast("binary"))
    everything = Window.partitionBy()
    shared = weighed.select(
        "*", F.sum("source_size").over(everything).alias("_all"),
        F.sum("weight").over(fills.rowsBetween(0, Window.unboundedFollowing)).alias("_weights"),
        F.coalesce(F.sum("full").over(fills.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_filled"))
    rate = (F.col("_all") - F.col("_filled")) / F.col("_weights")
    target = F.least(F.col("full").cast("double"), F.col("weight") * F.max(rate).over(everything))
    return shared.select(
        "source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix(docs: DataFrame, *, seed: str = "mix", max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, and its source.

    ``docs`` has doc_id, text and source; other columns play no part. A null text or one
    without words has size 0 and is taken 0 times. Repeated rows are documents of their own;
    rows with equal ids stand next to each other in the order and are alike. Documents
    without an id share one key. An empty table gives an empty result.

    A source that holds a third of all rows is no hot key: rows are dealt by source *and* range of
    the random key, ranges are summed before they are shuffled, and only the 4,096 sums of a source
    stand in one window.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                        random_key(F.col("doc_id"), seed).alias("_key"))
    sized = sized.withColumn("_range", F.substring("_key", 1, RANGES))
    ranges = sized.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    targets = source_targets(
        ranges.select("source", F.col("_sum").alias("size")), max_epochs)
    starts = ranges.select("source", "_range", F.coalesce(
        F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    starts = starts.alias("a").join(
        targets.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select(
        F.col("a.source").alias("_source"), F.col("_range").alias("_r"), "_start",
        "source_size", "target")
    inside = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size")
    earlier = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)),
                         F.lit(0))
    placed = sized.withColumn("_earlier", earlier).join(
        starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_r")))
    budget = F.floor(F.col("target") + F.lit(0.5)).cast("bigint")
    place = F.col("_start") + F.col("_earlier")
    rest = F.col("_budget") - F.col("_epochs") * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - place))
    return (placed.withColumn("_budget", budget)
            .withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(
                F.col("_budget") / F.col("source_size"))).otherwise(0).cast("bigint"))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("_epochs") + cut).cast("bigint").alias("taken"),
                    "source"))


def copies(taken: Column, size: Column) -> Column:
    """How often a whole document stands in the mix: its words taken, to the nearest copy."""
    return F.when(size > 0, F.floor((taken * 2 + size) / (size * 2))).otherwise(0).cast("int")


def source_cuts(mixed: DataFrame, seed: str = "mix") -> DataFrame:
    """_source, epochs and cut: whole documents with a key up to ``cut`` come once more than ``epochs``."""
    epochs = F.when(F.col("source_size") > 0, F.floor(F.floor(F.col("target") + F.lit(0.5))
                                                      / F.col("source_size"))).otherwise(0)
    more = copies(F.col("taken"), F.col("size")) > F.col("epochs")
    return mixed.withColumn("epochs", epochs.cast("int")).groupBy(
        source_name(F.col("source")).alias("_source")).agg(
        F.max("epochs").alias("epochs"),
        F.max(F.when(more, random_key(F.col("doc_id"), seed))).alias("cut"))


def source_name(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def repeated(docs: DataFrame, *, seed: str = "mix", max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, whole, to the nearest copy.

    Texts are not shuffled: what a source takes is a prefix of its random order, so one row for each
    source tells every document how often it comes. Documents without words come never; rows that
    repeat an id, or have none, are repeated alike.
    """
    cuts = written(source_cuts(mix(docs, seed=seed, max_epochs=max_epochs), seed), "mix-cuts")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"),
                       random_key(F.col("doc_id"), seed).alias("_key"),
                       source_name(F.col("source")).alias("_source"))
    known = lookup_join(rows.filter(F.col("_row.text").rlike(r"[^\x20\x09-\x0D]")), cuts, ["_source"],
                        spread_by="_key")
    number = F.col("epochs") + F.when(F.col("_key") <= F.col("cut"), 1).otherwise(0)
    each = F.explode(F.array_repeat(F.lit(0), number)).alias("_copy")
    return known.select("_row", each).select("_row.*")
