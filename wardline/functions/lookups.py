"""First-row-per-key and skew-proof lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardline.functions.exprs import named
from wardline.session import scratch_path

ROWS_PER_TASK = 1_000_000
BROADCAST_BYTES = 8 << 20
HOT_KEYS = 10_000
# a filter has at most so many buckets of 4 KB, a bit position inside one for each probe of a key
BUCKETS, BUCKET_BITS = 2_048, 32_768
PROBES, BITS_PER_KEY = 4, 16


def first_per_key(df: DataFrame, keys: Sequence[str], order: str = "seq") -> DataFrame:
    """The row with the lowest ``order`` of every key.

    Select the columns you need first: the rest of the row travels as one struct, which the
    optimizer does not prune. An aggregate, not a window: copies are dropped before the shuffle, so a key that
    holds a large share of the rows sends one row per input partition.
    """
    return _extreme_per_key(df, keys, F.min_by, order)


def last_per_key(df: DataFrame, keys: Sequence[str], order: str = "seq") -> DataFrame:
    return _extreme_per_key(df, keys, F.max_by, order)


def _extreme_per_key(df, keys, pick, order):
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.col(order)).alias("_row"))
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def measured(table: DataFrame) -> tuple[DataFrame, int, int]:
    """``table`` written to the shared folder, with its rows and about its bytes, both counted while it is written."""
    seen = Observation()
    size = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(named(c).cast("string")), F.lit(0)) + 8
                                       for c in table.columns])
    path = scratch_path(table.sparkSession, "lookup")
    table.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")).write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path), seen.get["rows"], seen.get["bytes"] or 0


def lookup_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], *, spread_by: str = "seq",
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Left join to a ``table`` that is unique on ``keys``, safe against hot keys.

    The table is computed once, and its size is known from that. Up to ``BROADCAST_BYTES`` it is broadcast: the rows stay
    where they are and no key can be hot. A larger one is joined by shuffle, but rows whose key a Bloom filter of the
    table's keys does not know stay where they are. Hot keys are left to the adaptive skew join; where the session has that
    switched off, they are salted (``salted_join``).
    """
    table, count, size = measured(table)
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), list(keys), "left")

    def shuffled(some: DataFrame) -> DataFrame:
        conf = some.sparkSession.conf
        if all(conf.get(f"spark.sql.adaptive.{name}", "true") == "true" for name in ("enabled", "skewJoin.enabled")):
            return some.join(table, list(keys), "left")
        return salted_join(some, table, keys, spread_by=spread_by, rows_per_task=rows_per_task)

    if count > BUCKETS * BUCKET_BITS // 2:  # the filter would know nearly every key
        return shuffled(rows)
    probed, may_match = with_filter(rows, key_filter(table, keys, count), keys)
    known = shuffled(probed.filter(may_match).select(*map(named, rows.columns)))
    others = probed.filter(~may_match).select(*[
        named(c) if c in rows.columns else F.lit(None).cast(table.schema[c].dataType).alias(c) for c in known.columns])
    return known.unionByName(others)


def _bucket(keys: Sequence[str], buckets: int | Column) -> Column:
    return F.pmod(F.xxhash64(*keys), buckets)


def _positions(keys: Sequence[str]) -> list[Column]:
    """Where a key's bits are inside its bucket, from hashes that do not depend on the bucket's."""
    return [F.pmod(F.xxhash64(F.lit(f"probe {i}"), *keys), F.lit(BUCKET_BITS)) for i in range(PROBES)]


def key_filter(table: DataFrame, keys: Sequence[str], count: int) -> DataFrame:
    """A Bloom filter of ``count`` keys: bucket, bits (4 KB each) and the number of buckets, at most ``BUCKETS`` rows.

    Built by one aggregate, which joins bits before they are shuffled.
    """
    buckets = min(BUCKETS, max(1, -(-count * BITS_PER_KEY // BUCKET_BITS)))
    positions = table.dropna(subset=list(keys)).select(
        _bucket(keys, F.lit(buckets)).alias("_bucket"), F.explode(F.array(*_positions(keys))).alias("_at"))
    return positions.groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits")).withColumn(
        "_buckets", F.lit(buckets))


def with_filter(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``rows`` with the part of a ``key_filter`` that concerns them, and whether their key may be in it."""
    buckets = known.select("_buckets").limit(1).collect()
    joined = rows.withColumn("_bucket", _bucket(keys, F.lit(buckets[0][0] if buckets else 1))).join(
        F.broadcast(known.drop("_buckets")), "_bucket", "left")

    def is_set(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (at % 8).cast("int")) == 1

    found = reduce(lambda a, b: a & b, [is_set(at) for at in _positions(keys)])
    return joined, F.coalesce(F.col("_bits").isNotNull() & found, F.lit(False))


def salted_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], *, spread_by: str,
                rows_per_task: int) -> DataFrame:
    """A shuffled left join that spreads hot keys itself.

    Keys with more than ``rows_per_task`` rows are salted: their rows are spread over ``ceil(rows / rows_per_task)`` salts
    and their single table row is repeated once per salt. The limit is raised with the number of rows so that at most
    ``HOT_KEYS`` keys can pass it, which bounds the broadcast list of hot keys; all other keys join unsalted.
    """
    rows_per_task = max(rows_per_task, -(-rows.count() // HOT_KEYS))
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = (counted.filter(F.col("_n") > rows_per_task)
           .select(*keys, F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias("_salts")))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    spreader = F.xxhash64(spread_by)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    # rows without a key match nothing: any salt does, so they are spread as widely as can be
    salt = F.when(no_key, spreader.cast("bigint")).otherwise(F.pmod(spreader, salts))
    salted_rows = (rows.join(F.broadcast(hot), list(keys), "left")
                   .withColumn("_salt", salt.cast("bigint")).drop("_salts"))
    salted_table = (table.join(F.broadcast(hot), list(keys), "left")
                    .withColumn("_salt", F.explode(
                        F.sequence(F.lit(0).cast("bigint"), (salts - 1).cast("bigint"))))
                    .drop("_salts"))
    return salted_rows.join(salted_table, [*keys, "_salt"], "left").drop("_salt")
