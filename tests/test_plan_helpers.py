import random

import pytest
from pyspark.sql import functions as F

from wardline.functions import lookups
from wardline.functions.lookups import first_per_key, last_per_key, lookup_join, salted_join
from wardline.functions.ranking import with_position


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 'hot' holds a third of the rows."""
    rnd = random.Random(1)
    data = [(k, "hot" if k % 3 == 0 else f"k{rnd.randint(0, 40)}", rnd.randint(0, 5))
            for k in range(3000)]
    return spark.createDataFrame(data, "seq bigint, key string, level int").repartition(6).cache()


def test_positions_equal_a_full_sort(skewed):
    rows = skewed.collect()
    for parts in (1, 7, 100):
        df = with_position(skewed, [("level", -F.col("level"))], parts=parts)
        got = {r.seq: r.position for r in df.collect()}
        order = sorted(rows, key=lambda r: (-r.level, r.seq))
        assert got == {r.seq: n for n, r in enumerate(order, start=1)}


def test_no_row_is_lost_to_a_null(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, None), (3, None, None), (4, 5, "a")],
                               "seq bigint, level int, key string")
    ranked = with_position(df, [("level", F.col("level"))], parts=2).collect()
    assert {r.seq: r.position for r in ranked} == {1: 1, 3: 2, 2: 3, 4: 4}
    grouped = with_position(df, [], within=["key"], parts=2).collect()
    assert {r.seq: r.position for r in grouped} == {1: 1, 4: 2, 2: 1, 3: 2}
    table = spark.createDataFrame([("a", 1)], "key string, value int")
    joined = salted_join(df, table, ["key"], spread_by="seq", rows_per_task=1).collect()
    assert {r.seq: r.value for r in joined} == {1: 1, 2: None, 3: None, 4: 1}


def test_positions_within_groups(skewed):
    df = with_position(skewed, [], within=["key"], parts=50)
    got = {r.seq: r.position for r in df.collect()}
    expected, seen = {}, {}
    for r in sorted(skewed.collect(), key=lambda r: r.seq):
        expected[r.seq] = seen[r.key] = seen.get(r.key, 0) + 1
    assert got == expected


def test_positions_of_scattered_ids_and_one_large_group(spark):
    """Ids spread over all long values, and half of all rows in one group."""
    df = spark.range(2000).select(
        F.xxhash64("id").alias("seq"), F.when(F.col("id") % 2 == 0, "big").otherwise(
            F.concat(F.lit("g"), F.col("id") % 30)).alias("key"), (F.col("id") % 3).alias("level"))
    got = {r.seq: r.position for r in with_position(
        df, [("level", F.col("level"))], within=["key"], parts=9).collect()}
    expected, seen = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r.key, r.level, r.seq)):
        expected[r.seq] = seen[r.key] = seen.get(r.key, 0) + 1
    assert got == expected


def test_summary_has_a_row_for_each_part_and_group_that_meet(spark, skewed):
    """Nothing is ranked row by row, and the input is read once, as a sorted table."""
    df = with_position(skewed, [("level", F.col("level"))], parts=16)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and plan.count("Relation") == 2  # rows, and their summary


def test_lookup_is_the_same_however_hot_the_keys(spark, skewed):
    table = (skewed.select("key").distinct().filter("key <> 'k3'")
             .withColumn("value", F.concat(F.lit("v-"), "key")))
    expected = sorted((r.seq, r.value) for r in skewed.join(table, "key", "left").collect())
    for limit in (10, 100, 100_000):
        joined = salted_join(skewed, table, ["key"], spread_by="seq", rows_per_task=limit)
        assert sorted((r.seq, r.value) for r in joined.collect()) == expected
        assert joined.columns == lookup_join(skewed, table, ["key"]).columns


def test_hot_rows_are_spread_where_the_session_does_not(spark, skewed, monkeypatch):
    table = skewed.select("key").distinct().withColumn("value", F.lit(1))
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 0)
    assert "_salt" not in lookup_join(skewed, table, ["key"])._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        joined = lookup_join(skewed, table, ["key"], rows_per_task=100)
        assert "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()
        assert joined.count() == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_lookups_give_the_same_with_and_without_a_filter(spark, skewed, monkeypatch, limit):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", limit)
    rows = skewed.withColumn("key", F.when(F.col("seq") % 11 > 0, F.col("key"))).withColumn("part", F.col("seq") % 2)
    table = (rows.select("key", "part").distinct().filter("key <> 'k3' or key is null")
             .withColumn("value", F.array(F.col("key"))).withColumn("`odd", F.lit(1)))
    expected = rows.join(table, ["key", "part"], "left")
    joined = lookup_join(rows, table, ["key", "part"])
    assert joined.columns == expected.columns
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, expected.collect()))
    assert lookup_join(rows, table.limit(0), ["key", "part"]).filter("value is null").count() == 3000


def test_the_filter_knows_its_keys_and_few_others(spark):
    table = spark.range(0, 30_000).select(F.concat(F.lit("k"), "id").alias("key"))
    known = lookups.key_filter(table, ["key"], 30_000)
    assert known.count() == 15 and {r.n for r in known.select(F.length("_bits").alias("n")).collect()} == {4096}
    others = spark.range(30_000, 60_000).select(F.concat(F.lit("k"), "id").alias("key"))
    counts = [(df := lookups.with_filter(rows, known, ["key"]))[0].filter(df[1]).count() for rows in (table, others)]
    assert counts[0] == 30_000 and counts[1] < 600


def test_the_table_is_computed_once_and_strangers_are_not_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 0)
    spark.range(1000).write.parquet(str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table")).select(F.col("id").alias("key"), F.lit(1).alias("value"))
    rows = spark.range(100_000).withColumnRenamed("id", "key")
    joined = lookup_join(rows, table, ["key"])
    assert str(tmp_path / "table") not in "".join(joined.inputFiles())
    shuffled = joined._jdf.queryExecution().optimizedPlan().toString()
    assert shuffled.startswith("Union") and joined.filter("value = 1").count() == 1000 and joined.count() == 100_000


def test_the_list_of_hot_keys_is_bounded(spark, skewed, monkeypatch):
    """With room for two hot keys, all others are joined unsalted, whatever is asked for."""
    monkeypatch.setattr(lookups, "HOT_KEYS", 2)
    table = skewed.select("key").distinct().withColumn("value", F.lit(1))
    joined = salted_join(skewed, table, ["key"], spread_by="seq", rows_per_task=1)
    hot = skewed.groupBy("key").count().filter(F.col("count") > 3000 // 2).count()
    assert hot <= 2 and joined.filter("value = 1").count() == 3000


def test_first_and_last_per_key(skewed):
    first, last = {}, {}
    for r in sorted(skewed.collect(), key=lambda r: r.seq):
        first.setdefault(r.key, r.seq)
        last[r.key] = r.seq
    assert {r.key: r.seq for r in first_per_key(skewed, ["key"]).collect()} == first
    assert {r.key: r.seq for r in last_per_key(skewed, ["key"]).collect()} == last
