"""Several tables written by one stream, with one commit for all of them.

Each attempt at a micro-batch writes its parts of all tables into folders of its own. Only when all
of them are there is a manifest written, which names the attempt; readers take what a manifest names and nothing
else. So a reader sees a batch in all tables or in none, a batch that dies half way leaves nothing to be
seen, and a batch that is repeated after its manifest was written is not written again.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "commits"
NAMES = "batch_id long, attempt string"
BEFORE_ALL = -1  # the batch that makes every table exist


def manifests(spark: SparkSession, base: str) -> DataFrame:
    """batch_id and attempt of what is committed: one row a batch."""
    return spark.read.schema(NAMES).parquet(f"{base}/{MANIFESTS}")


def is_committed(spark: SparkSession, base: str, batch_id: int) -> bool:
    return not manifests(spark, base).filter(F.col("batch_id") == batch_id).isEmpty()


def commit(spark: SparkSession, base: str, batch_id: int, tables: Mapping[str, DataFrame]) -> None:
    """Write a batch's part of every table, then its manifest; nothing if it is committed already."""
    if batch_id != BEFORE_ALL and is_committed(spark, base, batch_id):
        return
    attempt = uuid.uuid4().hex
    for name, rows in tables.items():
        rows.write.parquet(f"{base}/{name}/batch_id={batch_id}/attempt={attempt}")
    # one row, so one file, which appears whole; a second attempt at the same time replaces it by its own
    manifest = spark.range(1).coalesce(1).select(F.lit(attempt).alias("attempt"))
    manifest.write.mode("overwrite").parquet(f"{base}/{MANIFESTS}/batch_id={batch_id}")


def begin(spark: SparkSession, base: str, schemas: Mapping[str, T.StructType]) -> None:
    """Make every table of ``base`` exist, without rows, unless it does; to be called before the first batch."""
    empty = {name: spark.createDataFrame([], schema) for name, schema in schemas.items()}
    try:
        started = is_committed(spark, base, BEFORE_ALL)
    except Exception as error:  # no manifest was ever written
        if "PATH_NOT_FOUND" not in str(error):
            raise
        started = False
    if not started:
        commit(spark, base, BEFORE_ALL, empty)


def read(spark: SparkSession, base: str, table: str, schema: T.StructType, *, before: int | None = None) -> DataFrame:
    """The committed rows of a table, of the batches before a number if one is given.

    The manifests are few rows next to the data and prune the folders that are read.
    """
    known = manifests(spark, base)
    if before is not None:
        known = known.filter(F.col("batch_id") < before)
    with_place = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType()),
                               T.StructField("attempt", T.StringType())])
    rows = spark.read.schema(with_place).parquet(f"{base}/{table}")
    return rows.join(known, ["batch_id", "attempt"], "left_semi").select(*[f"`{n}`" for n in schema.names])
