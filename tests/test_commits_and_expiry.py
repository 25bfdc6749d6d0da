"""One commit for several tables of a stream, and first-seen access in bounded state."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators import access
from wardline.streaming import commits, expiring, streams

NUMBERS = T.StructType([T.StructField("id", T.LongType())])


def numbered(spark, folder, *ranges):
    for a, b in ranges:
        spark.range(a, b).coalesce(1).write.mode("append").parquet(folder)


def ids(df):
    return sorted(r.id for r in df.collect())


class Sinks:
    """Two sinks; the second fails as often as asked."""

    def __init__(self, failures=0):
        self.failures, self.batches = failures, 0

    def tables(self):
        return {"audit": lambda df: df, "vault": self.second}

    def second(self, df):
        if "_seen" not in df.columns:
            self.batches += 1
        if self.batches > 2 and self.failures:  # the first call tells the schema
            self.failures -= 1
            return df.withColumn("id", F.raise_error(F.lit("lost an executor")).cast("long"))
        return df.withColumn("id", F.col("id") * 10)


def test_a_batch_that_fails_between_two_tables_is_seen_in_neither(spark, tmp_path):
    folder, base = str(tmp_path / "in"), str(tmp_path / "out")
    numbered(spark, folder, (0, 5), (5, 9), (9, 12))
    stream = streams.parquet_stream(spark, folder, files_per_trigger=1)
    sinks = Sinks(failures=1)
    with pytest.raises(Exception, match="lost an executor"):
        streams.run_to_sinks(spark, stream, lambda df: df, sinks.tables(), "x", base=base)
    audit, vault = (commits.read(spark, base, t, NUMBERS) for t in ("audit", "vault"))
    seen = ids(audit)
    assert 0 < len(seen) < 12 and ids(vault) == [10 * i for i in seen]
    # the files of the dead attempt are there, but no manifest names them
    assert spark.read.parquet(f"{base}/audit").count() > len(seen)
    again = streams.run_to_sinks(spark, stream, lambda df: df, sinks.tables(), "x", base=base)
    assert ids(again["audit"]) == list(range(12)) and ids(again["vault"]) == [10 * i for i in range(12)]


def test_a_batch_is_written_once_however_often_it_is_repeated(spark, tmp_path):
    base = str(tmp_path)
    commits.begin(spark, base, {"a": NUMBERS, "b": NUMBERS})
    commits.begin(spark, base, {"a": NUMBERS, "b": NUMBERS})
    for rows in (spark.range(3), spark.range(7)):  # the second is a repetition after the manifest was written
        commits.commit(spark, base, 0, {"a": rows, "b": rows})
    commits.commit(spark, base, 1, {"a": spark.range(10, 11), "b": spark.range(0)})
    assert ids(commits.read(spark, base, "a", NUMBERS)) == [0, 1, 2, 10]
    assert ids(commits.read(spark, base, "b", NUMBERS)) == [0, 1, 2]
    assert ids(commits.read(spark, base, "a", NUMBERS, before=1)) == [0, 1, 2]


def test_a_manifest_that_was_not_finished_counts_for_nothing(spark, tmp_path):
    base = str(tmp_path)
    commits.begin(spark, base, {"a": NUMBERS})
    spark.range(5).write.parquet(f"{base}/a/batch_id=0/attempt=dead")
    (tmp_path / "commits/batch_id=0/_temporary/0").mkdir(parents=True)
    assert ids(commits.read(spark, base, "a", NUMBERS)) == []
    commits.commit(spark, base, 0, {"a": spark.range(2)})
    assert ids(commits.read(spark, base, "a", NUMBERS)) == [0, 1]


def test_a_stream_without_batches_has_empty_tables(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(0).write.parquet(folder)
    out = streams.run_to_sinks(spark, streams.parquet_stream(spark, folder), lambda df: df,
                               {"a": lambda df: df, "b": lambda df: df.withColumn("x", F.lit(1))}, "x")
    assert out["a"].count() == 0 and out["b"].columns == ["id", "x"]


def accesses(spark, folder, rows):
    df = spark.createDataFrame(rows, "seq bigint, ts string, principal string, connector string")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(folder)


def found(df):
    return sorted((r.seq, r.principal, r.connector, str(r.ts)) for r in df.collect())


DAYS = dt.timedelta(days=9)


def test_nothing_expires_and_the_result_is_that_of_the_batch(spark, tmp_path):
    folder, base = str(tmp_path / "in"), str(tmp_path / "state")
    history = spark.createDataFrame([("old", "crm")], "principal string, connector string")
    accesses(spark, folder, [(2, "2026-01-02", "a", "crm"), (1, "2026-01-01 00:00:00.25", "a", "crm"), (3, "2026-01-01", "old", "crm")])
    stream = streams.parquet_stream(spark, folder, files_per_trigger=1)
    first = expiring.first_seen(spark, stream, history, keep=DAYS, base=base)
    assert [r[0] for r in found(first)] == [1]
    accesses(spark, folder, [(4, "2025-01-03", "a", "crm"), (5, "2026-01-03", "b", "crm"), (8, "2026-01-03", None, "crm")])
    accesses(spark, folder, [(6, "2026-01-04", "b", "crm"), (7, "2026-01-04", "old", "email"), (9, "2026-01-04", None, "crm")])
    stream = streams.parquet_stream(spark, folder, files_per_trigger=1)
    again = expiring.first_seen(spark, stream, history, keep=DAYS, base=base)
    assert found(again) == found(access.first_accesses(spark.read.parquet(folder), history))
    assert [r[0] for r in found(again)] == [4, 5, 7, 8]


def test_expired_pairs_leave_the_state_and_are_known(spark, tmp_path):
    folder, base = str(tmp_path / "in"), str(tmp_path / "state")
    history = spark.createDataFrame([], "principal string, connector string")
    pairs = T.StructType([T.StructField(n, T.StringType()) for n in access.PAIR])

    def run(*rows):
        accesses(spark, folder, list(rows))
        stream = streams.parquet_stream(spark, folder, files_per_trigger=1)
        return expiring.first_seen(spark, stream, history, keep=dt.timedelta(seconds=1), base=base)

    run((1, "2026-01-01", "a", "crm"), (2, "2026-01-01", "b", "crm"))
    time.sleep(1.2)
    run((3, "2026-01-02", "c", "crm"))  # its batch finds the timers of a and b run out
    time.sleep(1.2)
    last = run((4, "2026-01-03", "a", "crm"), (5, "2026-01-03", "d", "crm"))
    assert [r[0] for r in found(last)] == [1, 2, 3, 5]
    gone = commits.read(spark, base, expiring.HISTORY, pairs)
    assert {r.principal for r in gone.collect()} >= {"a", "b"}
    state = spark.read.format("statestore").option("stateVarName", "first").load(f"{base}/checkpoint")
    assert state.select("key.principal").distinct().count() <= 2  # a again, and d
