"""The version that was valid at a row's time, for keys and versions of any number.

Rows and versions are sorted together by one range shuffle, in which a key with very many rows is spread over as many parts
as it fills, and the sorted table is written. Inside a part the version of a row is the last one before it. Only the first key of a part can
have versions in earlier parts, so what is carried from part to part is one row for each part at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.exprs import named
from wardline.session import written

_ROW_BITS = 33  # of monotonically_increasing_id: the row inside its part


def as_of_join(rows: DataFrame, versions: DataFrame, *, key: str, at: str, valid_from: str, seq: str = "seq",
               parts: int | None = None) -> DataFrame:
    """Left join of each row to the version of its ``key`` with the latest ``valid_from`` that is not after ``at``.

    Adds the columns of ``versions`` but for ``key`` and ``valid_from``. Of versions that begin at the same time the largest, column
    by column, counts. Rows without a key or a time, and rows before all versions, get NULLs; versions without a key or a
    beginning are never valid. ``seq`` spreads rows of one key and time.
    """
    values = [c for c in versions.columns if c not in (key, valid_from)]
    kind = versions.select(F.struct(*map(named, values))).schema[0].dataType
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    time = rows.select(named(at)).schema[0].dataType
    known = versions.dropna(subset=[key, valid_from]).groupBy(named(key).alias("_key"), named(valid_from).cast(time).alias("_time")).agg(
        F.max(F.struct(*map(named, values))).alias("_version"))
    usable = named(at).isNotNull()
    both = known.select("_key", "_time", F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("_spread"), "_version",
                        F.lit(None).cast(rows.schema).alias("_row")).unionByName(
        rows.select(F.when(usable, named(key)).alias("_key"), named(at).alias("_time"), F.lit(1).alias("_kind"),
                    F.xxhash64(named(seq)).alias("_spread"), F.lit(None).cast(kind).alias("_version"),
                    F.struct(*map(named, rows.columns)).alias("_row")))
    order = ["_key", "_time", "_kind", "_spread"]
    swept = written(both.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "_key", "_version", "_row", F.monotonically_increasing_id().alias("_at")), "as-of")
    swept = swept.withColumn("_part", F.shiftright("_at", _ROW_BITS))

    inside = Window.partitionBy("_part", "_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = swept.filter("_key IS NOT NULL AND _version IS NOT NULL").groupBy("_part", "_key").agg(
        F.max_by("_version", "_at").alias("_last"))
    spans = swept.filter("_key IS NOT NULL").select("_part", "_key").distinct()
    carried = spans.join(ends, ["_part", "_key"], "left").select(
        "_part", "_key", F.last("_last", ignorenulls=True).over(earlier).alias("_before")).filter("_before IS NOT NULL")
    found = swept.withColumn("_now", F.last("_version", ignorenulls=True).over(inside)).filter("_row IS NOT NULL")
    # at most one row for each part: the key with which it begins
    found = found.join(F.broadcast(carried), ["_part", "_key"], "left")
    version = F.when(F.col("_key").isNotNull(), F.coalesce("_now", "_before"))
    return found.select("_row", version.alias("_version")).select(
        *[F.col("_row").getField(c).alias(c) for c in rows.columns],
        *[F.col("_version").getField(c).alias(c) for c in values])
