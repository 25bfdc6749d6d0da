"""Removing repeated runs of lines with a distributed suffix array, in DataFrame functions only.

Lines are numbers, documents sequences of them. Prefix doubling ranks all places by their first 1,
2, 4, ... lines: the rank of twice the length is that of the pair of ranks at a place and the length
after it, by one range sort and its prefix sums. A place whose first lines stand nowhere else
can start no repeated run of that length and leaves the array, so the rounds shrink.

Places of one rank are an interval of the array with a common prefix of at least that length; two
overlapping ranks name any longer stretch. A run counts if it has ``min_words`` words. It then
consists of stretches that are just long enough: forward from each of its lines, and backward
from each. Every such stretch that stands at an earlier place too is a later copy, and the
union of these stretches is that of all maximal repeated runs; their lines go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.exprs import bind, element_rows
from wardline.llm.common import word_count
from wardline.session import written

MIN_WORDS = 50
PLACE = ["doc_id", "version", "line"]  # version: a hash of the text, as ids may repeat
DOC = PLACE[:2]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def line_places(docs: DataFrame, min_words: int) -> DataFrame:
    """Each line's place, its number in two hashes, and the stretches that start or end there.

    ``until``: the first line after the shortest stretch from here; ``since``: where the shortest
    stretch that ends before this line starts; both with at least ``min_words`` words.
    """
    named = docs.filter("text IS NOT NULL AND doc_id IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("version"),
        F.concat(lines_of(F.col("text")), F.array(F.lit(None).cast("string"))).alias("_lines"))
    lines = element_rows(named, DOC, F.col("_lines"), "_line", "line").select(
        *PLACE, F.xxhash64("_line").alias("hash_a"), F.xxhash64(F.lit(7), "_line").alias("hash_b"),
        word_count(F.col("_line")).alias("_words"), F.col("_line").isNull().alias("is_end"))
    # a document's lines come from one row, so this is no key that grows
    lines = lines.repartition(*DOC).dropDuplicates(PLACE)
    before = Window.partitionBy(*DOC).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0))
                               ).withColumn("_after", -F.col("_before"))
    enough = (Window.unboundedPreceding, -min_words)
    since = F.max("line").over(Window.partitionBy(*DOC).orderBy("_before").rangeBetween(*enough))
    until = F.min("line").over(Window.partitionBy(*DOC).orderBy("_after").rangeBetween(*enough))
    return counted.select(*PLACE, "hash_a", "hash_b", "is_end", since.alias("since"), until.alias("until"))


def ranked(places: DataFrame, key: list[str]) -> DataFrame:
    """The places whose ``key`` is not unique, with its rank: how many such places have a smaller one.

    Keys are counted before they are sorted, so a key with a third of all rows is one row. The sums run
    inside the ranges of one range sort; the totals of the ranges are as many as there are tasks.
    """
    counts = places.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    tasks = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = written(counts.repartitionByRange(tasks, *key).sortWithinPartitions(*key).withColumn(
        "_at", F.monotonically_increasing_id()), "line-ranks").withColumn(
        "_range", F.shiftright("_at", 33))
    totals = in_order.groupBy("_range").agg(F.sum("_n").alias("_total"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    ranks = in_order.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        F.broadcast(totals), "_range").select(*key, (F.col("_base") + F.col("_inside")).alias("_rank"))
    return written(places.join(ranks, key).select(*PLACE, F.col("_rank").alias("rank")), "line-places")


def repeated_stretches(places: DataFrame) -> DataFrame:
    """doc_id, version, start and size of the stretches that also stand at an earlier place."""
    ends = places.filter("until IS NOT NULL").select(
        *DOC, F.col("line").alias("start"), (F.col("until") - F.col("line")).alias("size"))
    starts = places.filter("since IS NOT NULL").select(
        *DOC, F.col("since").alias("start"), (F.col("line") - F.col("since")).alias("size"))
    array = ranked(places.filter("NOT is_end"), ["hash_a", "hash_b"])
    # a stretch can be repeated only if its first and its last line are
    at = array.select(*DOC, F.col("line").alias("start"))
    until = array.select(*DOC, (F.col("line") + 1).alias("_end"))
    stretches = written(ends.unionByName(starts).distinct().join(at, [*DOC, "start"], "left_semi")
                        .withColumn("_end", F.col("start") + F.col("size"))
                        .join(until, [*DOC, "_end"], "left_semi").drop("_end"), "stretches")
    longest = stretches.agg(F.max("size")).first()[0] or 0
    named, length = None, 1
    while length <= longest:
        some = stretches.filter((F.col("size") >= length) & (F.col("size") < 2 * length))
        head = array.select(*DOC, F.col("line").alias("start"), F.col("rank").alias("head"))
        tail = array.select(*DOC, F.col("line").alias("_tail"), F.col("rank").alias("tail"))
        some = (some.join(head, [*DOC, "start"])
                .withColumn("_tail", F.col("start") + F.col("size") - length)
                .join(tail, [*DOC, "_tail"]).drop("_tail"))
        named = some if named is None else named.unionByName(some)
        if 2 * length <= longest:
            after = array.select(*DOC, (F.col("line") - length).alias("line"), F.col("rank").alias("next"))
            array = ranked(array.join(after, PLACE), ["rank", "next"])
            if array.isEmpty():
                break
        length *= 2
    if named is None:
        return stretches
    named = written(named, "named-stretches")
    here = F.struct(*DOC, "start")
    key = ["size", "head", "tail"]
    firsts = named.groupBy(*key).agg(F.min(here).alias("_first"), F.max(here).alias("_last")).filter(
        "_first < _last").drop("_last")
    return named.join(firsts, key).filter(here > F.col("_first")).select(*DOC, "start", "size")


def remove_repeated_lines(docs: DataFrame, *, min_words: int = MIN_WORDS, removed: str = "n_removed"
                          ) -> DataFrame:
    """``docs`` with the lines of later copies of repeated runs cut out of ``text``, and their number.

    A run is one or more whole lines, equal byte by byte, with ``min_words`` words together; what
    counts as earlier is the order by doc_id, and the line. Runs repeat inside a
    document as between documents; every line that goes stands in a kept place before. A document of which all lines go has an
    empty text; a null text stays null, and a document without an id is left as it is. Rows with one doc_id and one text are one document: all keep
    the same lines. With one doc_id and several texts, a hash of the text decides which is earlier. Other columns stay; one that is called as the new
    one is replaced.
    """
    places = written(line_places(docs.select("doc_id", "text"), min_words), "lines")
    stretches = repeated_stretches(places)
    gone = stretches.select(*DOC, F.explode(F.sequence(
        F.col("start"), F.col("start") + F.col("size") - 1)).alias("_gone")).distinct()
    gone = gone.groupBy(*DOC).agg(F.collect_list("_gone").alias("_gone")).select(
        F.col("doc_id").alias("_id"), F.col("version").alias("_version"), "_gone")
    keep = [c for c in docs.columns if c != removed]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")  # other columns can't clash
    both = docs.select(row, "doc_id", "text", F.xxhash64("text").alias("_hash")).join(
        gone, (F.col("doc_id") == F.col("_id")) & (F.col("_hash") == F.col("_version")), "left")

    def rest(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(bind(lines_of(F.col("text")), rest))
    number = F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.size("_gone")).cast("bigint")
    return both.select(*[text.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in keep],
                       number.alias(removed))
