import json

import pytest
from pyspark.sql import functions as F

from wardline.operators import access
from wardline.sources import tables
from wardline.streaming import streams

FINDING = {"id": "F1", "title": "t", "resource": "r", "vendor_severity": "high", "internet_facing": True}


def test_json_array_with_defaults(spark, tmp_path):
    path = tmp_path / "findings.json"
    path.write_text(json.dumps([FINDING, {**FINDING, "id": "F2", "owner": "me"}]))
    rows = tables.load_findings(spark, str(path)).orderBy("seq").collect()
    assert [r.id for r in rows] == ["F1", "F2"] and [r.owner for r in rows] == ["unassigned", "me"]
    assert rows[0].internet_facing is True and rows[0].production is False


def test_bad_records_fail(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('[{"id": "F1", "production": "perhaps"}]')
    with pytest.raises(Exception):
        tables.load_findings(spark, str(path)).collect()


def test_pentest_dates(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text(json.dumps([{"id": "P", "title": "t", "severity": "low", "component": "c",
                                 "discovered": "2026-06-01"}]))
    row = tables.load_pentest(spark, str(path)).first()
    assert str(row.discovered) == "2026-06-01" and (row.owner, row.status) == ("unassigned", "open")


def test_write_counts_and_whole_files(spark, tmp_path):
    df = spark.range(1000).repartition(5)
    assert tables.write_records(df, str(tmp_path / "out")) == 1000
    assert spark.read.json(str(tmp_path / "out")).count() == 1000
    for name in ("a.py", "b.py"):
        (tmp_path / name).write_text(f"# {name}\n\nx = 1\n")
    files = tables.read_source_files(spark, [str(tmp_path / "a.py"), str(tmp_path / "b.py")]).collect()
    assert sorted(f.content for f in files) == ["# a.py\n\nx = 1\n", "# b.py\n\nx = 1\n"]
    assert {f.path.rsplit("/", 1)[1] for f in files} == {"a.py", "b.py"}


def access_file(spark, folder, rows):
    df = spark.createDataFrame(rows, "seq bigint, ts string, principal string, connector string")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(folder)


def test_first_seen_over_batches_and_restarts(spark, tmp_path):
    folder, base = str(tmp_path / "in.parquet"), str(tmp_path / "state")
    history = spark.createDataFrame([("old", "crm")], "principal string, connector string")
    access_file(spark, folder, [(2, "2026-01-02", "a", "crm"), (1, "2026-01-01", "a", "crm"),
                                (3, "2026-01-01", "old", "crm")])
    stream = streams.parquet_stream(spark, folder, files_per_trigger=1)
    first = streams.first_seen(spark, stream, history, base=base)
    assert sorted((r.seq, r.principal) for r in first.collect()) == [(1, "a")]
    access_file(spark, folder, [(4, "2026-01-03", "a", "crm"), (5, "2026-01-03", "b", "crm")])
    access_file(spark, folder, [(6, "2026-01-04", "b", "crm"), (7, "2026-01-04", "old", "email")])
    stream = streams.parquet_stream(spark, folder, files_per_trigger=1)
    again = streams.first_seen(spark, stream, history, base=base)
    streamed = sorted((r.principal, r.connector) for r in again.collect())
    batch = access.first_accesses(spark.read.parquet(folder), history)
    assert streamed == sorted((r.principal, r.connector) for r in batch.collect())
    assert streamed == [("a", "crm"), ("b", "crm"), ("old", "email")]


def test_the_earliest_access_is_reported_in_whatever_file_it_lies(spark, tmp_path):
    folder, base = str(tmp_path / "in.parquet"), str(tmp_path / "state")
    history = spark.createDataFrame([], "principal string, connector string")
    access_file(spark, folder, [(2, "2026-01-02", "a", "crm"), (5, "2026-01-05", "b", "crm")])
    stream = streams.parquet_stream(spark, folder, files_per_trigger=1)
    first = streams.first_seen(spark, stream, history, base=base).collect()
    assert sorted((r.seq, r.principal) for r in first) == [(2, "a"), (5, "b")]
    access_file(spark, folder, [(1, "2026-01-01", "a", "crm"), (7, "2026-01-07", "b", "crm")])
    late = spark.createDataFrame([("b", "crm")], "principal string, connector string")
    stream = streams.parquet_stream(spark, folder, files_per_trigger=1)
    again = streams.first_seen(spark, stream, late, base=base).collect()
    # the earlier access of a replaces the one reported; the history is that of the first start
    assert sorted((r.seq, r.principal) for r in again) == [(1, "a"), (5, "b")]


def test_a_file_stream_of_one_file_reads_only_that(spark, tmp_path):
    for name in ("a.parquet", "a.parquet.old"):
        spark.range(3).toPandas().to_parquet(tmp_path / name)
    stream = streams.parquet_stream(spark, f"{tmp_path}/a.parquet")
    assert streams.run_to_end(spark, stream, lambda df: df, "one").count() == 3
