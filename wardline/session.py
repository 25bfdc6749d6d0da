"""Session settings the operators are written for, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # no stack capture for every column expression that is built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# how many pieces small input tables are dealt into; unset: as they lie
INPUT_PIECES = "wardline.input.pieces"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g",
                  shared: str | None = None, pieces: int | None = None) -> SparkSession:
    """Session for tests and the benchmark; clusters bring their own.

    ``shared`` is the folder for scratch data; whoever names it also removes it. ``pieces`` asks
    for small input tables, which are one task each, to be dealt out.
    """
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("wardline")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", memory)
               .config("spark.ui.showConsoleProgress", "false"))
    if pieces:
        builder = builder.config(INPUT_PIECES, str(pieces))
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else below the warehouse.

    Spark's warehouse is shared by all executors as the checkpoint folder is; the session's
    settings are left as they are. Nothing is put into a machine's own temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir")
    folder = named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return folder.rstrip("/")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
