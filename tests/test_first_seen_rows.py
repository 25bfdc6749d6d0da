"""First-seen state goes by rows, whose values stay what they are."""

import datetime as dt

from pyspark.sql import functions as F

from wardline.streaming import expiring, streams


def test_whole_numbers_beside_missing_ones_stay_exact(spark, tmp_path):
    folder, exact = str(tmp_path / "in"), 2 ** 53 + 1
    rows = [("2026-01-01", None, "a", "crm", 5), ("2026-01-01", exact, "a", "crm", None), ("2026-01-01", exact + 2, "a", "crm", exact)]
    df = spark.createDataFrame(rows, "ts string, seq bigint, principal string, connector string, size bigint")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(folder)
    history = spark.createDataFrame([], "principal string, connector string")
    found = expiring.first_seen(spark, streams.parquet_stream(spark, folder), history, keep=dt.timedelta(days=9), base=str(tmp_path / "b"))
    assert [(r.seq, r.size) for r in found.collect()] == [(exact, None)]
