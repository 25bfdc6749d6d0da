"""Sharding, mixing, near and exact search against plain Python, and their odd inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import exact_search, mixing, near_search, sharding

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<float>{extra}")


def random_rows(n, d=12, seed=1):
    rng = np.random.default_rng(seed)
    data = rng.standard_normal((n, d)).astype(np.float32)
    data[n // 3:2 * n // 3] = data[n // 3]  # a third is one vector: ties without end
    return [(i, data[i].tolist()) for i in range(n)]


ODD = [(None, [1.0] * 12), (5000, None), (5001, []), (5050, [NAN] * 12), (5051, [INF] + [0.0] * 11),
       (5052, [None] + [1.0] * 11), (5100, [1.0, 2.0]), (5101, [2.0, 1.0])]


# --- sharding -------------------------------------------------------------------------------
def test_table_is_full_even_and_stable():
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 211)
    counts = np.bincount(table, minlength=7)
    assert counts.sum() == 211 and counts.max() - counts.min() <= 1
    assert table == sharding.lookup_table(names[::-1], 211)
    # when a shard leaves, few slots of the others move
    fewer = sharding.lookup_table(names[:-1], 211)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 211 * 0.2


def test_weights_and_refusals():
    counts = np.bincount(sharding.lookup_table({"a": 1, "b": 3}, 1009))
    assert 2.9 < counts[1] / counts[0] < 3.1
    for bad in ([], ["a", "a"], {"a": 0}, ["a"] * 3):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 101)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 100)


def test_placing_odd_rows(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (10**15, None)], "doc_id long, slot string")
    rows = sharding.place(df, "doc_id", ["a", "b", "c"], size=101).collect()
    table = sharding.lookup_table(["a", "b", "c"], 101)
    assert len(rows) == 4 and all("abc"[table[r.slot]] == r.shard for r in rows)
    assert len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert sharding.place(df.limit(0), "doc_id", ["a"], size=101).columns == ["doc_id", "slot", "shard"]


# --- mixing ----------------------------------------------------------------------------------
def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(order)
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    return target


def test_mix_hits_targets_and_reruns_agree(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join("w" * int(rng.integers(0, 60))), f"s{i % 11 % 5}" if i % 13 else None, "own", i)
            for i in range(600)] + [(900, None, "s1", "x", 0), (901, "", "tiny", "x", 0), (902, "a b", "rare", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, target long")
    out = mixing.mix(df).collect()
    sizes, taken = {}, {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = plain_targets(sizes)
    for r in out:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6)
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes) and len(out) == len(rows)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, again), key=repr)


def test_whole_copies_follow_the_mix(spark):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join("w" * int(rng.integers(0, 30))), f"s{i % 5}" if i % 7 else None, i) for i in range(300)]
    rows += [(900, None, "s1", 0), (902, "a b", "rare", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _key long")
    want = {r.doc_id: r.n for r in mixing.mix(df).select(
        "doc_id", mixing.copies(F.col("taken"), F.col("size")).alias("n")).collect()}
    got = {i: 0 for i in want}
    for r in mixing.repeated(df).collect():
        got[r.doc_id] += 1
    assert got == want and max(got.values()) <= 3 and mixing.repeated(df).columns == df.columns


def test_mix_of_nothing(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    rows = mixing.mix(spark.createDataFrame([(1, None, None), (1, None, None), (None, "", "a")], schema)).collect()
    assert [(r.size, r.taken, r.target) for r in rows] == [(0, 0, 0.0)] * 3


# --- near search ------------------------------------------------------------------------------
def cosines(rows, query):
    a = np.array(query, np.float64)
    out = []
    for i, v in rows:
        b = np.array(v, np.float64)
        out.append((-(a * b).sum() / math.sqrt((b * b).sum()) / math.sqrt((a * a).sum()), i))
    return out


def test_near_search_recall_and_ties(spark):
    rows = random_rows(900)
    found = near_search.near_top_k(vectors(spark, rows + [(6000, [0.0] * 12)]), every=30, block_rows=250).collect()
    hits = total = 0
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by_query) == {i for i, _ in rows if i % 30 == 0}  # a zero vector takes no part
    for query, got in by_query.items():
        best = sorted(cosines([x for x in rows if x[0] != query], dict(rows)[query]))[:5]
        got = sorted(got)
        assert [g[0] for g in got] == [1, 2, 3, 4, 5]
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(got, got[1:]))
        hits += len({g[1] for g in got} & {b[1] for b in best})
        total += 5
    assert hits / total >= 0.9
    query = by_query[300]  # one of three hundred equal vectors: the smallest ids win
    assert [v for _, v, _ in sorted(query)] == [301, 302, 303, 304, 305]


def test_near_search_odd_rows(spark):
    few = random_rows(3)
    rows = [(*r, "x", 1) for r in few + ODD + few]  # repeated rows count once
    out = near_search.near_top_k(vectors(spark, rows, ", score string, rank int")).collect()
    assert sorted((r.query_id, r.vec_id) for r in out) == [(0, 1), (0, 2), (5100, 5101)]
    assert near_search.near_top_k(vectors(spark, [])).count() == 0


# --- exact search -----------------------------------------------------------------------------
def plain_search(rows, every, k=5):
    whole = {i: [math.floor(256 * float(x)) for x in v] for i, v in rows}
    out = set()
    for q, a in whole.items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole.items()
                            if i != q and len(a) == len(b))[:k]
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)}
    return out


@pytest.mark.parametrize("limits", [{}, {"pivots": 3, "group_queries": 4, "chunk_rows": 60}])
def test_exact_search_is_exact(spark, limits):
    rows = random_rows(400)
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    out = exact_search.exact_top_k(vectors(spark, rows), every=20, **limits).collect()
    assert {tuple(r) for r in out} == plain_search(rows, 20)


def test_bounds_drop_what_cannot_be_near(spark):
    """Two far clusters: a query's own one is enough, and the answer stays exact."""
    rng = np.random.default_rng(5)
    rows = [(i, ((100 if i % 2 else -100) + rng.standard_normal(4)).astype(np.float32).tolist()) for i in range(300)]
    out = exact_search.exact_top_k(vectors(spark, rows), every=50, pivots=8, chunk_rows=50).collect()
    assert {tuple(r) for r in out} == plain_search(rows, 50)


def test_exact_search_odd_rows(spark):
    few = random_rows(3)
    rows = [(*r, "x", 1) for r in few + ODD + few]
    out = exact_search.exact_top_k(vectors(spark, rows, ", score string, cell int")).collect()
    assert {tuple(r) for r in out} == plain_search(few + ODD[-2:], 50)
    large = [(0, [1e30, 1.0]), (1, [2.0, 1.0]), (2, [-1.0, 1.0])]
    assert exact_search.exact_top_k(vectors(spark, large[1:] + [(50, [3e4, 1.0])])).count() == 2
    assert exact_search.exact_top_k(vectors(spark, [])).count() == 0
    assert exact_search.exact_top_k(vectors(spark, [(1, [1.0])])).count() == 0
