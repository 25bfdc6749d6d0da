"""Readers and writers: explicit schemas, no inference, bad records fail the read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardline.registries import RISK_WEIGHTS

FINDING_SCHEMA = (
    "id string, title string, resource string, vendor_severity string, "
    + ", ".join(f"{flag} boolean" for flag in RISK_WEIGHTS) + ", owner string"
)
CONTACT_SCHEMA = ("contact_id string, name string, timezone string, consent string, "
                  "consent_date string")
PENTEST_SCHEMA = ("id string, title string, severity string, component string, "
                  "discovered date, owner string, status string")


def read_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def spread(df: DataFrame, key: str, pieces: int | None) -> DataFrame:
    """``df`` dealt into ``pieces`` by ``key`` if the caller asks for it, else as it is.

    A parquet file is split by row group at most, so a small table in one file is one task;
    whoever runs costly work on such tables names the number of pieces.
    """
    return df.repartition(pieces, key) if pieces else df


def dealt_out(df: DataFrame) -> DataFrame:
    """``df`` in as many tasks as the session shuffles into, or more if its files make more.

    For tables whose rows are short and cost much: millions of them lie in one split, and the rest of the cluster waits. The
    rows are dealt in turn, not by a key, so one key or many nulls do not meet in a task.
    """
    spark = df.sparkSession
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def read_json(spark: SparkSession, path: str, schema: str, *, lines: bool = False) -> DataFrame:
    """JSON records with a fixed schema.

    A JSON array is one document and cannot be split, so it suits small files; large
    tables come as one record per line (``lines=True``), which splits freely.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return reader.option("multiLine", not lines).json(path)


def with_input_order(df: DataFrame) -> DataFrame:
    """``seq`` in file order, for inputs that carry none: unique and increasing, not dense."""
    if "seq" in df.columns:
        return df
    return df.select(F.monotonically_increasing_id().alias("seq"), "*")


def load_findings(spark: SparkSession, path: str, *, schema: str = FINDING_SCHEMA,
                  lines: bool = False) -> DataFrame:
    """Cloud findings; absent factors are false, an absent owner is unassigned."""
    df = with_input_order(read_json(spark, path, schema, lines=lines))
    return df.fillna(False, subset=list(RISK_WEIGHTS)).fillna("unassigned", subset=["owner"])


def load_contacts(spark: SparkSession, path: str, *, schema: str = CONTACT_SCHEMA,
                  lines: bool = False) -> DataFrame:
    return with_input_order(read_json(spark, path, schema, lines=lines))


def load_pentest(spark: SparkSession, path: str, *, schema: str = PENTEST_SCHEMA,
                 lines: bool = False) -> DataFrame:
    df = with_input_order(read_json(spark, path, schema, lines=lines))
    return df.fillna({"owner": "unassigned", "status": "open"})


def read_source_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per file: path and whole content."""
    return (spark.read.text(paths, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")))


def read_source_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per line of text files of any size: path, block, at, line.

    A file is read in as many splits as its size asks for. ``block`` is where the split begins in the file, and ``at``
    grows by one from line to line inside a split, so ``path``, ``block`` and ``at`` order the lines
    of a file; see ``line_scans`` for line numbers. Lines end at line feeds and carriage returns. ``at`` holds for one run of
    the plan: whoever needs it twice writes it down.
    """
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def list_source_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path and size of files; their content is not read. Spark's readers, this one too, pass over empty files."""
    return (spark.read.format("binaryFile").load(paths)
            .select(F.col("path"), F.col("length").alias("size")))


def write_records(df: DataFrame, path: str, *, fmt: str = "json", mode: str = "errorifexists",
                  **options: object) -> int:
    """Write and return the number of records, counted while they are written."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.options(**options).mode(mode).format(fmt).save(path)
    return int(seen.get["n"])
