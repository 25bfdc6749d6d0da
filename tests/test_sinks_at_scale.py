"""What a stream's sinks share is written for them, not cached, and emptied afterwards."""

from pyspark.sql import functions as F

from wardline.streaming import streams


def test_sinks_read_files_with_their_columns_only_and_the_files_go(spark, tmp_path):
    folder, base = str(tmp_path / "in"), tmp_path / "out"
    for a, b in ((0, 5), (5, 9)):
        spark.range(a, b).coalesce(1).write.mode("append").parquet(folder)
    given = []

    def narrow(df):
        given.append(df)
        return df.select("id")

    # a random number is the same in both tables, as it is computed once
    out = streams.run_to_sinks(
        spark, streams.parquet_stream(spark, folder, files_per_trigger=1),
        lambda df: df.withColumns({"x": F.rand(), "wide": F.repeat(F.lit("w"), 1000)}),
        {"a": narrow, "b": lambda df: df.select("id", "x"), "c": lambda df: df.select("id", "x")}, "x", base=str(base))
    batches = given[1:]  # the first tells the schema
    assert len(batches) == 2 and not any(df.is_cached for df in batches)
    assert sorted(r.id for r in out["a"].collect()) == list(range(9))
    assert out["b"].exceptAll(out["c"]).isEmpty() and out["b"].count() == 9
    left = [p for p in (base / "computed").iterdir()]
    assert len(left) == 2 and all(spark.read.parquet(str(p)).isEmpty() for p in left)
