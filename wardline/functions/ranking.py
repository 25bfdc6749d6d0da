"""Exact positions in a total order, without pulling a group into one task.

The rows are sorted once by a range shuffle, in which a group or a leading value of any size is
spread over as many tasks as it fills, and the sorted table is written. Its parts are in order, so
the place of a row is its place inside its part plus the rows of its group in the parts
before; the summary this takes has one row for each part and group that meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.session import written

_ROW_BITS = 33  # of monotonically_increasing_id: the row inside its part


def with_position(df: DataFrame, leading: Sequence[tuple[str, Column]], *,
                  within: Sequence[str] = (), seq: str = "seq", name: str = "position",
                  parts: int | None = None) -> DataFrame:
    """Add the 1-based position of each row, ordered by ``leading`` (ascending), then ``seq``.

    ``leading`` are (name, expression) pairs; ``seq`` is unique; ``within`` restarts the count
    for each group. ``parts`` is the number of sorted parts, by default that of a shuffle.
    """
    helper = [f"_order_{n}" for n, _ in leading]
    group = list(within)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*group, *helper, seq]
    keyed = df.withColumns({h: e for h, (_, e) in zip(helper, leading)})
    in_order = (keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                .select(*df.columns, F.monotonically_increasing_id().alias("_at")))
    rows = written(in_order, "positions").withColumn("_part", F.shiftright("_at", _ROW_BITS))

    pieces = rows.groupBy(*group, "_part").agg(
        F.count(F.lit(1)).alias("_size"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(*group, "_part", (
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    if not group:  # one row for each part
        starts = F.broadcast(starts)
    ranked = _null_safe_join(rows, starts, [*group, "_part"])
    position = (F.col("_at") + F.col("_shift") + 1).cast("bigint")
    return ranked.select(*df.columns, position.alias(name))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join that also pairs NULL keys; the right side's key columns are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    matches = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, matches, "inner").drop(*[f"_r_{k}" for k in keys])
