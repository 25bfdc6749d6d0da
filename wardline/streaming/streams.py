"""Streaming runs of the batch operators, and first-seen detection over a stream."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators.access import PAIR, first_accesses
from wardline.session import scratch_path
from wardline.streaming import commits


def parquet_stream(spark: SparkSession, path: str, *, files_per_trigger: int = 64) -> DataFrame:
    """File stream over a parquet folder or a single parquet file.

    A single file is found in its folder by its name, as a stream reads folders only.
    """
    table = spark.read.parquet(path)
    parent, _, name = path.rstrip("/").rpartition("/")
    files = table.inputFiles()
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_trigger)
    if len(files) == 1 and files[0].rpartition("/")[2] == name:
        return stream.option("pathGlobFilter", name).parquet(parent)
    return stream.parquet(path)


def write_stream(df: DataFrame, out: str, checkpoint: str, *, every: str | None = None):
    """Append a stateless stream to a parquet table, exactly once.

    Runs to the end of what is there now, or goes on with a micro-batch ``every`` interval.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (df.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", out)
            .trigger(**trigger).start())


def run_to_end(spark: SparkSession, stream: DataFrame,
               transform: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Process all the stream holds now with a stateless transform; return what was written."""
    base = scratch_path(spark, name)
    result = transform(stream)
    write_stream(result, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{base}/out")


def run_to_sinks(spark: SparkSession, stream: DataFrame,
                 transform: Callable[[DataFrame], DataFrame],
                 sinks: dict[str, Callable[[DataFrame], DataFrame]], name: str, *, base: str | None = None
                 ) -> dict[str, DataFrame]:
    """As ``run_to_end``, with several tables written from one computation of each micro-batch.

    A batch becomes visible in all tables at once (see ``commits``). Runs that are given the same ``base`` go on
    where the last one ended or died. What is computed is written, not cached: a cached part is read whole by one task of every
    sink, however large its split came out, but of a written one a task reads a split, and the columns that its sink uses. It is
    emptied when the batch is committed.
    """
    base = base or scratch_path(spark, name)
    sample = transform(spark.createDataFrame([], stream.schema))
    schemas = {sink: part(sample).schema for sink, part in sinks.items()}
    commits.begin(spark, base, schemas)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session, path = batch.sparkSession, f"{base}/computed/{uuid.uuid4().hex}"
        if commits.is_committed(session, base, batch_id):
            return
        result = transform(batch)
        try:
            result.write.parquet(path)
            computed = session.read.schema(result.schema).parquet(path)
            commits.commit(session, base, batch_id, {s: part(computed) for s, part in sinks.items()})
        finally:
            session.createDataFrame([], result.schema).write.mode("overwrite").parquet(path)

    (stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{base}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return {s: commits.read(spark, base, s, k) for s, k in schemas.items()}


def first_seen(spark: SparkSession, accesses: DataFrame, history: DataFrame, *,
               base: str | None = None, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Each (principal, connector) pair's earliest access, of the pairs history does not know.

    The state store keeps the earliest access of each pair, so a micro-batch costs what it
    holds, not what came before; a batch is reduced to one row per pair where it lies. A pair is
    reported when it first appears, and again if a later batch brings an earlier access; the
    result holds the earliest, so it does not depend on how files fall into batches. History is
    snapshot once for each ``base``, so repeated batches and later starts see the same.
    """
    base = base or scratch_path(spark, "first-seen")
    out = f"{base}/out"
    columns = accesses.columns
    rest = [c for c in columns if c not in (*PAIR, *order)]
    pairs = history.select(*PAIR).distinct()
    pairs.write.mode("ignore").parquet(f"{base}/history")
    known = spark.read.schema(pairs.schema).parquet(f"{base}/history")
    earliest = accesses.join(known, PAIR, "left_anti").groupBy(*PAIR).agg(
        F.min(F.struct(*order, *rest)).alias("_first"))
    found = earliest.select(*[F.col(c) if c in PAIR else F.col(f"_first.{c}").alias(c) for c in columns])
    # an empty first folder, so that there is always a table to read
    spark.createDataFrame([], found.schema).write.mode("overwrite").parquet(f"{out}/batch_id=-1")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    (found.writeStream.outputMode("update").foreachBatch(on_batch)
     .option("checkpointLocation", f"{base}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    schema = T.StructType([*found.schema.fields, T.StructField("batch_id", T.LongType())])
    return first_accesses(spark.read.schema(schema).parquet(out).select(*columns), order=order)
