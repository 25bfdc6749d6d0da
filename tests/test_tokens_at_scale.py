"""Token work is dealt over the cluster, and cheaper text functions give what the costly ones gave."""

import base64

from pyspark.sql import functions as F

from wardline.functions import identity as idn
from wardline.plans import views as v
from wardline.sources import tables


def test_chains_of_one_small_file_are_dealt_out(spark, tmp_path):
    folder = str(tmp_path)
    rows = spark.range(200).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("c_custkey"))
    rows.coalesce(1).write.parquet(f"{folder}/customer.parquet")
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    chains = v.chains(spark, folder)
    assert chains.rdd.getNumPartitions() >= wanted > 1
    assert sorted(str(r.seq) for r in chains.collect()) == sorted(str(r.c_custkey) for r in rows.collect())
    # keys that are null do not meet in one task
    null = chains.filter("seq IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(null) >= wanted and max(r["count"] for r in null) < 40


def test_a_table_in_enough_tasks_stays_as_it_is(spark):
    many = spark.range(0, 100, 1, 16)
    assert tables.dealt_out(many) is many


def test_base64url_is_that_of_the_standard_library(spark):
    bodies = [bytes(range(256))[:n] * k for n in (0, 1, 2, 3, 250, 256) for k in (1, 2, 3)] + [b"\xfb\xef\xff" * 40, b"???>>>~~"]
    df = spark.createDataFrame([(bytearray(b),) for b in bodies], "b binary")
    for legacy in ("false", "true"):
        spark.conf.set("spark.sql.legacy.chunkBase64String.enabled", legacy)
        try:
            got = df.select(idn.base64url(F.col("b")).alias("t"), idn.from_base64url(idn.base64url(F.col("b"))).alias("b")).collect()
        finally:
            spark.conf.unset("spark.sql.legacy.chunkBase64String.enabled")
        assert [r.t for r in got] == [base64.urlsafe_b64encode(b).decode().rstrip("=") for b in bodies]
        assert [bytes(r.b) for r in got] == bodies


def test_the_stale_hop_of_a_chain_is_signed_and_expired(spark):
    df = v.with_tokens(v.with_chain(spark.createDataFrame([(2,), (7,), (4,)], "seq long")))
    rows = {r.seq: r for r in df.select("seq", "chain_tokens", idn.verify_chain(
        F.col("chain_tokens"), v.SIGNING_KEY, F.lit(v.NOW)).alias("c")).collect()}
    for seq in (2, 7):
        assert rows[seq].c.reason.endswith("expired") and rows[seq].c.chain == [f"human:human-{seq}"]
        early = spark.range(1).select(idn.verify(F.lit(rows[seq].chain_tokens[1]), v.SIGNING_KEY, F.lit(v.NOW - v.EXPIRED_BY)).alias("v"))
        assert early.first().v.claims.iat == v.NOW - v.EXPIRED_BY
    assert rows[4].chain_tokens is None
