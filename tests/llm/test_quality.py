"""The quality classifier against plain Python, its accuracy on held-out documents, and odd inputs."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardline.llm import quality

FOLDER = "/root/testdata/sf0.01"
ODD = ["", None, "   \t\n", "one", "One two one two", "é Ü 12ab!! | x", "word " * 300, "The The The", "a\x0bb\x0cc"]


def plain_features(text):
    """Words and shapes as strings, and pairs of neighbours."""
    words = re.findall("[^\x20\x09-\x0d]+", text or "")

    def shape(word):
        marks = ["A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" or ord(c) > 127 else "0" if "0" <= c <= "9" else c
                 for c in word]
        return "".join(c for i, c in enumerate(marks) if not i or marks[i - 1] != c)

    lower = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    shapes = [shape(w) for w in words]
    return {(kind, *gram) for kind, row in (("w", lower), ("s", shapes))
            for gram in [*zip(row), *zip(row, row[1:])]}


def test_features_are_those_of_plain_python():
    found, ptr = quality.features(pa.array(ODD), 48)
    sets = [frozenset(found[a:b].tolist()) for a, b in zip(ptr, ptr[1:])]
    plain = [plain_features(t) for t in ODD]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i in range(len(ODD)):
        for j in range(len(ODD)):
            assert len(sets[i] & sets[j]) == len(plain[i] & plain[j])


@pytest.mark.parametrize("text", ["a bc  def\tgh " * 50, "x" * 100, " " * 70 + "end", "start" + " " * 90 + "end", "é" * 40 + " ü"])
def test_a_long_text_has_the_same_features_in_pieces(text):
    whole, _ = quality.features(pa.array([text]), 16)
    for limit in (1, 7, 30):
        assert quality.long_features(text, 16, limit).tolist() == whole.tolist()


def test_a_step_is_that_of_the_formula():
    rates = quality.Rates()
    z, n, weights = {}, {}, {}
    examples = [([1, 5, 9], 1.0), ([5, 7], 0.0), ([1, 9], 1.0), ([], 0.0), ([7], 0.0), ([5], 0.5)]
    for places, target in examples:
        if not places:
            continue
        x = 1 / math.sqrt(len(places))
        for p in places:
            zp, np_ = z.get(p, 0.0), n.get(p, 0.0)
            weights[p] = 0.0 if abs(zp) <= rates.lasso else -(zp - math.copysign(rates.lasso, zp)) / (
                (rates.beta + math.sqrt(np_)) / rates.alpha + rates.ridge)
        g = (1 / (1 + math.exp(-(0.3 + sum(weights[p] * x for p in places)))) - target) * x
        for p in places:
            sigma = (math.sqrt(n.get(p, 0.0) + g * g) - math.sqrt(n.get(p, 0.0))) / rates.alpha
            z[p] = z.get(p, 0.0) + g - sigma * weights[p]
            n[p] = n.get(p, 0.0) + g * g
    batch = pa.RecordBatch.from_pydict({"target": [t for _, t in examples]})
    places = np.array([p for ps, _ in examples for p in ps])
    ptr = np.cumsum([0, *[len(ps) for ps, _ in examples]])
    got_z, got_n = quality.steps([(batch, places, ptr)], 0.3, np.zeros(16), np.zeros(16), rates)
    assert np.allclose([got_z[p] for p in z], list(z.values())) and np.allclose([got_n[p] for p in n], list(n.values()))


def test_held_out_documents_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.score_corpus(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = found[found.quality == 1].score, found[found.quality == 0].score
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert (found.predicted == found.quality).mean() > 0.9 and found.score.between(0, 1).all()


def test_labels_of_held_out_documents_and_other_columns_play_no_part(spark):
    docs = spark.createDataFrame([(i, f"word{i % 5} tail", "s", i) for i in range(60)], "doc_id long, text string, source string, `a.b` int")
    labels = spark.createDataFrame([(i, int(i % 5 > 1), None) for i in range(60)], "doc_id long, quality int, toxic int")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    rows = [sorted(map(tuple, quality.score_corpus(docs, t).collect())) for t in (labels, turned, labels)]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 60


def test_a_bounded_sample_takes_the_first_by_hash(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(300)] + [(7, "another"), (None, "none")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(290)] + [(7, 0), (8, None), (None, 1)], "doc_id long, quality int")
    hashes = {r[0]: r[1] for r in docs.filter("doc_id < 290").select("doc_id", F.xxhash64("doc_id")).collect()}
    got = quality.sample(docs, labels, 40)
    assert sorted(r.key for r in got.collect()) == sorted(hashes.values())[:40]
    assert quality.sample(docs, labels).count() == 290
    assert quality.sample(docs, labels).filter(F.col("key") == hashes[7]).first().target == 0.5


@pytest.mark.parametrize("labelled", [[], [(0, 1)], [(0, 1), (1, 0), (2, None), (None, 0)]])
def test_odd_texts_and_few_labels(spark, labelled):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(None, "x"), (1, "twice")], "doc_id long, text string")
    labels = spark.createDataFrame(labelled, "doc_id long, quality int")
    rows = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(rows) == len(ODD) + 2 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    if not labelled:
        assert {r.score for r in rows} == {0.5}


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 2.0, {"k": 1})], "doc_id long, text string, score double, `a.b` map<string,int>")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert quality.score(docs, model).columns == ["doc_id", "a.b", "score", "predicted"]
    assert quality.score(docs.limit(0), model).count() == 0
    assert quality.score(docs, model).first().score == 0.5
