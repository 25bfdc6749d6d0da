"""Ranked search against a program that scores every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from wardline.llm import lexical_search as ls

WORDS = "alpha beta gamma delta Épée naïve x1 2024 rare1 rare2 the the the of of Zeta zeta".split()


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(docs, items, top=20):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        rows = []
        for doc_id, c in counted:
            if c:
                m = 100 - 25 + (25 * c.total() * n_docs) // total
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                            * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
                if score > 0:
                    rows.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(rows, key=lambda r: r[:3])[:top])]
    return sorted(out, key=str)


def texts(seed, count, longest):
    r = np.random.default_rng(seed)
    return [" ".join(r.choice(WORDS, r.integers(0, longest))) + "." for _ in range(count)]


@pytest.mark.parametrize("shard, block, queries, seeds", [(4096, 64, 1 << 16, 64), (50, 4, 1 << 16, 2), (7, 9, 12, 1)])
def test_ranking_is_that_of_scoring_everything(spark, shard, block, queries, seeds):
    docs = [*enumerate(texts(1, 400, 25)), (5, "alpha rare1"), (None, "rare2 rare1 delta"), (900, None), (901, ""), (902, "-- !"),
            (None, None), *[(1000 + i, "alpha beta rare1 x1 the") for i in range(60)]]
    items = [*enumerate(texts(2, 12, 9)), (3, "rare1 rare1 rare2"), (None, "Alpha"), (50, None), (51, "unknown words"), (52, "")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, `a.b` string").repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id int, text string, rank int")
    got = ls.search(frame, asked, shard_docs=shard, block_docs=block, query_terms=queries, seeds=seeds)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a a b")], [(1, "a b")]),
                                         ([((1 << 63) - 1, "a"), (None, "a"), (2, "b")], [(0, "a")])])
def test_small_and_empty_tables(spark, docs, items):
    got = ls.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


def shard_of(monkeypatch, seed=3, count=600, size=80, apart=1):
    """Vectors over every ``apart``-th of ``size`` terms, in small blocks that have summaries."""
    monkeypatch.setattr(ls, "SUMMARY_DOCS", 4)
    monkeypatch.setattr(ls, "LIST_BLOCKS", 32)
    r = np.random.default_rng(seed)
    vectors = [apart * np.sort(r.choice(size, r.integers(1, 20), replace=False, p=(p := 1 / np.arange(1, size + 1)) / p.sum())) for _ in range(count)]
    ptr = np.cumsum([0, *map(len, vectors)])
    found = np.concatenate(vectors)
    return ls.Shard.build(9, np.arange(count), np.arange(count) + 100, ptr, found, r.integers(1, 10**6, len(found)),
                          r.integers(1, 5000, size * apart), 16), r


@pytest.mark.parametrize("apart", [1, 700])
def test_bounds_hold_and_some_blocks_are_skipped(monkeypatch, apart):
    shard, r = shard_of(monkeypatch, apart=apart)
    skipped = 0
    for _ in range(20):
        asked = np.zeros(80 * apart, dtype=np.int64)
        asked[apart * r.choice(80, 6, replace=False)] = r.integers(1, 5000, 6)
        everything = shard.scores(np.arange(600), asked)
        best = ls.Best(5, 1)
        shard.search(np.flatnonzero(asked), asked, best)
        expected = sorted(everything[everything > 0], reverse=True)[:5]
        assert best.rows[:, 0].tolist() == expected
        for a, b in zip(shard.list_ptr, shard.list_ptr[1:]):
            bounds = shard.bounds(a, b, shard.stepped(asked))
            for block in range(a, b):
                members = shard.members[shard.block_ptr[block]:shard.block_ptr[block + 1]]
                assert everything[members].max() <= bounds[block - a]
            skipped += (bounds < expected[-1]).sum()
    assert skipped


def test_each_list_holds_its_documents_once_and_survives_storage(monkeypatch):
    shard, _ = shard_of(monkeypatch)
    again = ls.Shard.read(shard.batch().to_pylist()[0])
    docs = np.repeat(np.arange(600), np.diff(shard.ptr))
    for number, term in enumerate(again.listed):
        blocks = range(again.list_ptr[number], again.list_ptr[number + 1])
        members = np.concatenate([again.members[again.block_ptr[b]:again.block_ptr[b + 1]] for b in blocks])
        assert sorted(members) == sorted(docs[shard.terms == term])
    assert all(np.array_equal(getattr(again, n), getattr(shard, n)) for n in shard.ARRAYS) and len(again.gaps)


def test_a_long_text_is_counted_whole(monkeypatch):
    text = "Ab,cd ef-" * 50 + "é" * 30 + " ab"
    whole = ls.term_counts(text)
    for piece in (1, 5, 64):
        monkeypatch.setattr(ls, "PIECE", piece)
        assert ls.term_counts(text) == whole == Counter(t.encode() for t in terms(text))
