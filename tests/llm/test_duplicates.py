"""Near duplicates, line runs and components against plain Python, and their odd inputs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import line_dedup, near_duplicates
from wardline.llm.components import components


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").lower())
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def plain_components(rows):
    """doc_id -> smallest doc_id reachable, by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i in root}


def words(rng, n):
    return [f"w{rng.randint(0, 9999)}" for _ in range(n)]


def corpus(seed):
    """Groups at every similarity around the threshold, copies, short texts and chains."""
    rng = random.Random(seed)
    rows = []
    for size in (1, 2, 4, 5, 6, 8, 20, 60, 300):
        for _ in range(4):
            base = words(rng, size)
            rows.append(" ".join(base))
            for changes in (0, 1, 2, 3, 5, 8):
                other = list(base)
                for _ in range(changes):
                    other[rng.randrange(size)] = f"c{rng.randint(0, 10**6)}"
                rows.append(" ".join(other).upper() if rng.random() < 0.2 else "  ".join(other))
    chain = words(rng, 100)
    for i in range(12):  # each like the next, the ends unlike
        rows.append(" ".join(chain[i * 4:] + words(random.Random(i), i * 4)))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    out = {r.doc_id: r for r in near_duplicates.near_duplicates(df).collect()}
    want = plain_components(rows)
    assert {i: r.component_id for i, r in out.items()} == want
    assert all(r.n_shingles == len(shingles(t)) for (i, t), r in zip(rows, (out[i] for i, _ in rows)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.values())


def test_a_large_group_in_small_blocks(spark, monkeypatch):
    """Copies of a hidden text, many pairs just over and just under the threshold."""
    monkeypatch.setattr(near_duplicates, "SPLIT_ROWS", 16)
    rng = random.Random(4)
    base = words(rng, 60)
    rows = []
    for i in range(150):
        other = list(base)
        for _ in range(rng.randint(0, 2)):
            other[rng.randrange(60)] = f"c{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(other)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(df).collect()}
    assert out == plain_components(rows)


def test_an_empty_round_does_not_end_the_search(spark, monkeypatch):
    """Where the best partners were tried before, the others are still confirmed."""
    pair = spark.createDataFrame([(2, 3)], "a long, b long")
    rounds = []

    def open_pairs(members, classes, roots, tried, partners):
        rounds.append(partners)
        return pair.limit(0) if partners else pair

    monkeypatch.setattr(near_duplicates, "open_pairs", open_pairs)
    monkeypatch.setattr(near_duplicates, "estimated", lambda pairs, classes: pairs.withColumn("estimate", F.lit(0.7)))
    monkeypatch.setattr(near_duplicates, "confirmed", lambda pairs, texts: pairs.filter("a = 2"))
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "rep long, centre long")
    roots = near_duplicates.linked(members, None, None)
    assert rounds == list(near_duplicates.PARTNERS)
    assert sorted(map(tuple, roots.select("node", "root").collect())) == [(2, 2), (3, 2)]


def test_odd_documents(spark):
    long = " ".join(words(random.Random(1), 30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, long), (7, long), (8, "x" * 100_000),
            (9, "same text of five words"), (9, "same text of five words"), (None, "one two"), (None, "alone here"),
            (None, None), (11, "other text under one id now"), (11, "quite another text under that id")]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id int, text string, bands string")
    out = near_duplicates.near_duplicates(df).collect()
    assert len(out) == len(rows)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out), key=repr)
    size = len(shingles(long))
    assert found == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False),
                            (6, size, 6, True), (7, size, 6, False), (8, 1, 8, True), (9, 1, 9, True), (9, 1, 9, True),
                            (None, 1, 4, False), (None, 1, None, True), (None, 0, None, True),
                            (11, 2, 11, True), (11, 2, 11, True)], key=repr)
    assert near_duplicates.near_duplicates(df.limit(0)).count() == 0


def test_registers_estimate_similarity():
    rng = np.random.default_rng(2)
    for size in (4, 8, 20, 145, 1000, 20_000):
        for share in (0.2, 0.5, 0.857, 0.95):
            pool = rng.integers(0, 1 << 64, 2 * size, dtype=np.uint64)
            common = round(size * share)
            left, right = np.unique(pool[:size]), np.unique(np.concatenate([pool[:common], pool[size:2 * size - common]]))
            true = len(np.intersect1d(left, right)) / len(np.union1d(left, right))
            a, b = near_duplicates.registers([left, right])
            found, used = near_duplicates.similarity(a[None, :], b[None, :])
            assert abs(found[0] - true) < 0.13
            if true >= 0.75:
                assert near_duplicates.plausible(found, used, np.array([len(left) + len(right)]))[0]


def test_estimates_lose_no_link():
    """Many pairs right at the threshold, at many sizes: none is dropped."""
    rng = np.random.default_rng(3)
    for size in (4, 7, 8, 12, 20, 50, 145, 400, 2000):
        for _ in range(150 if size < 1000 else 30):
            common = -(-size * 6 // 7)
            pool = rng.integers(0, 1 << 64, 2 * size, dtype=np.uint64)
            left, right = np.unique(pool[:size]), np.unique(np.concatenate([pool[:common], pool[size:2 * size - common]]))
            if near_duplicates.similar(left, right):
                found, used = near_duplicates.similarity(*(x[None, :] for x in near_duplicates.registers([left, right])))
                assert near_duplicates.plausible(found, used, np.array([len(left) + len(right)]))[0], size


def test_compressed_registers():
    values = np.array([1, 2, 3, (1 << 62) - 1, 1 << 61, (1 << 61) + (1 << 60), 1 << 62], dtype=np.uint64)
    zeros = (near_duplicates.compress(values) >> np.uint16(10)).tolist()
    assert zeros[:6] == [61, 60, 60, 0, 0, 0] and near_duplicates.compress(values)[-1] == near_duplicates.EMPTY
    assert near_duplicates.compress(values)[3] == (1 << 10) - 1 and near_duplicates.compress(values)[5] == 1 << 9


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(200, 230)] + [(9, 9), (7, 8), (8, 7)]
    links += [(rng.randint(1000, 1040), rng.randint(1000, 1040)) for _ in range(25)]
    df = spark.createDataFrame(links, "a long, b long")
    out = {r.node: r.root for r in components(df).collect()}
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    root.pop(9)
    alone = {x for x in root if all(a == b for a, b in links if x in (a, b))}
    assert out == {x: r for x, r in root.items() if x not in alone}


# --- line runs --------------------------------------------------------------------------------
def plain_lines(rows, min_words):
    """What is left of each text, by following every pair of equal lines."""
    docs = sorted({(i, t) for i, t in rows if i is not None and t is not None})
    places = [(d, n, line) for d, (_, t) in enumerate(docs) for n, line in enumerate(t.split("\n"))]
    index = {(d, n): k for k, (d, n, _) in enumerate(places)}
    count = [len(re.findall("[^\x20\x09-\x0d]+", line)) for _, _, line in places]
    gone = set()
    for k, (d, n, line) in enumerate(places):
        for j in range(k):
            if places[j][2] != line or (k and j and places[k - 1][0] == d and places[j - 1][0] == places[j][0]
                                         and places[k - 1][2] == places[j - 1][2]):
                continue  # not equal, or not the start of the run
            length = 0
            while (k + length < len(places) and places[k + length][0] == d
                   and places[j + length][0] == places[j][0] and places[k + length][2] == places[j + length][2]):
                length += 1
            if sum(count[k:k + length]) >= min_words:
                gone |= set(range(k, k + length))
    out = {}
    for d, (i, t) in enumerate(docs):
        kept = [line for n, line in enumerate(t.split("\n")) if index[d, n] not in gone]
        out[i, t] = "\n".join(kept)
    return out


def line_corpus(seed):
    rng = random.Random(seed)
    pool = [" ".join(words(rng, n)) for n in (0, 1, 2, 3, 5, 8, 12) for _ in range(3)]
    runs = [[rng.choice(pool) for _ in range(rng.randint(1, 9))] for _ in range(6)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(1, 4)):
            part = list(rng.choice(runs))
            lines += part[rng.randint(0, 2):] if rng.random() < 0.4 else part
            lines += [" ".join(words(rng, rng.randint(1, 9)))] if rng.random() < 0.6 else []
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed, min_words", [(1, 10), (2, 8), (3, 12), (4, 1)])
def test_lines_left_are_those_of_the_plain_search(spark, seed, min_words):
    rows = line_corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.remove_repeated_lines(df, min_words=min_words).collect()
    want = plain_lines(rows, min_words)
    for r in out:
        text = dict(rows)[r.doc_id]
        assert r.text == want[r.doc_id, text], r.doc_id
        if r.text:
            assert r.n_removed == text.count("\n") - r.text.count("\n")
    if min_words > 1:
        assert any(r.n_removed for r in out) and any(not r.n_removed for r in out)


def test_odd_lines(spark):
    passage = "\n".join(f"line {i} with some words here" for i in range(12))
    once = " ".join(words(random.Random(2), 60))
    rows = [(1, passage), (2, "own start\n" + passage + "\nown end"), (3, None), (4, ""), (5, "\n" * 300), (6, "\n" * 300),
            (7, once), (7, once), (8, once), (None, passage), (9, "x" * 200_000), (10, "one line\n" * 200),
            (11, "short line"), (12, "short line"), (13, passage.replace("line 6", "line six"))]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, line int")
    out = line_dedup.remove_repeated_lines(df).collect()
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in out), key=repr)
    thirteen = passage.replace("line 6", "line six")
    want = [(1, passage, 0), (2, "own start\nown end", 12), (3, None, 0), (4, "", 0), (5, "\n" * 300, 0), (6, "\n" * 300, 0),
            (7, once, 0), (7, once, 0), (8, "", 1), (None, passage, 0), (9, "x" * 200_000, 0),
            (10, "one line\n", 199), (11, "short line", 0), (12, "short line", 0), (13, thirteen, 0)]
    assert got == sorted(want, key=repr)
    assert all(r.line == 5 for r in out) and out[0].asDict().keys() == {"doc_id", "text", "line", "n_removed"}
    assert line_dedup.remove_repeated_lines(df.limit(0)).count() == 0


def test_line_dedup_runs_without_python(spark):
    df = spark.createDataFrame(line_corpus(1), "doc_id long, text string")
    plan = line_dedup.remove_repeated_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
