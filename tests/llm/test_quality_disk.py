"""The sample that quality learns from is dealt to its shards once, whatever the number of rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm import quality


def test_rounds_share_one_dealing_of_the_sample(spark, monkeypatch):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("word "), (F.col("id") % 7).cast("string"), F.lit(" and "), (F.col("id") % 3).cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    kind, cached = type(docs), []
    plain = kind.mapInArrow

    def watched(self: DataFrame, *args, **kwargs):
        cached.append(self)
        return plain(self, *args, **kwargs)

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    monkeypatch.setattr(kind, "mapInArrow", watched)
    plans = []
    stay = kind.unpersist
    monkeypatch.setattr(kind, "unpersist", lambda self, *a: (plans.append(self.storageLevel.useDisk), stay(self, *a))[1])
    quality.train(docs, labels, rounds=3)
    assert len(cached) == 3 and len({id(df) for df in cached}) == 1
    assert plans == [True]  # it was kept, and is let go
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
