"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.session import written

LINKS_PER_FILE = 200_000


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """node and root (the smallest node of its component) for every node of ``links`` (a, b).

    Each round hangs all of a node's neighbours on its smallest one: first those larger than
    the node, then those not larger than it. A node with very many neighbours is
    reduced to its minimum before it is shuffled. Rounds go on until no link changes; each is
    written to the shared folder, so a lost executor costs no earlier round, in files of about
    ``LINKS_PER_FILE`` links.
    """
    both = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = written(both, purpose)
    summary = _summary(current)
    while True:
        files = max(1, 2 * summary[0] // LINKS_PER_FILE)
        mirrored = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        spread = written(_stars(mirrored, F.col("b") > F.col("a")).coalesce(files), purpose)
        current = written(_stars(spread, F.lit(True)).coalesce(files), purpose)
        before, summary = summary, _summary(current)
        if summary == before:
            break
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select("root").distinct().select(
        F.col("root").alias("node"), "root"))


def _stars(links: DataFrame, kept) -> DataFrame:
    """Links from each neighbour ``b`` of ``a`` that is kept, and from ``a``, to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("_least")).withColumn(
        "_least", F.least("_least", "a"))
    hung = links.join(least, "a")
    out = hung.filter(kept).select(F.col("b").alias("a"), F.col("_least").alias("b"))
    own = least.select("a", F.col("_least").alias("b"))
    return out.unionByName(own).filter("a <> b").distinct()


def _summary(df: DataFrame) -> tuple:
    """The number of links and a checksum of them that their order plays no part in."""
    mixed = F.xxhash64("a", "b")
    return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(mixed),
                        F.bit_xor(F.xxhash64(mixed, F.lit(1)))).first())
