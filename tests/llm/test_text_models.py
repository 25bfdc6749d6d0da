"""Scoring and language identification against plain Python, and their odd inputs."""

import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardline.llm import common, language, scoring

TEXTS = ["the cat sat on the mat", "The CAT ate", "", None, "a b c " * 200, "x" * 200_000, "\t\n \x0b",
         "ÀÉ àé naïve", "the the the", "the cat sat on the mat", "Z z \x00 y"]


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", lower) + ["</s>"]


class Plain:
    """The model written out with dictionaries."""

    def __init__(self, texts):
        lists = [tokens(t) for t in texts]
        self.count = collections.Counter(w for t in lists for w in t)
        self.n = sum(self.count.values())
        self.pairs = collections.Counter(p for t in lists for p in zip(["<s>", *t], t))
        self.after, self.before = collections.Counter(), collections.Counter()
        self.kinds = collections.defaultdict(lambda: [0, 0, 0])
        for (a, b), n in self.pairs.items():
            self.after[a] += n
            self.before[b] += 1
            self.kinds[a][min(n, 3) - 1] += 1
        histogram = lambda values: [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        self.d1 = scoring.discounts(histogram(self.before.values()))
        self.d2 = scoring.discounts(histogram(self.pairs.values()))
        spare = sum(self.d1[min(v, 3) - 1] for v in self.before.values())
        self.spare = spare / len(self.pairs) if self.pairs else 1.0

    def chance(self, a, b):
        n = self.before[b]
        lower = (n - (self.d1[min(n, 3) - 1] if n else 0)) / max(len(self.pairs), 1)
        lower += self.spare / (len(self.count) + 1)
        if a not in self.after:
            return lower
        n = self.pairs.get((a, b), 0)
        rest = sum(d * k for d, k in zip(self.d2, self.kinds[a])) / self.after[a]
        return (n - (self.d2[min(n, 3) - 1] if n else 0)) / self.after[a] + rest * lower

    def score(self, text):
        words = tokens(text)
        base = sum(math.log10((self.count[w] + 0.5) / (self.n + 0.5 * (len(self.count) + 1))) for w in words)
        full = sum(math.log10(self.chance(a, b)) for a, b in zip(["<s>", *words], words))
        return len(words), sum(self.count[w] > 0 for w in words), self.n, base, full


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_scores_are_those_of_the_plain_model(spark, parts):
    rng = np.random.default_rng(1)
    words = [f"w{int(x)}" for x in rng.zipf(1.5, 4000) if x < 500]
    corpus = TEXTS + [" ".join(words[i:i + 40]) for i in range(0, len(words), 40)]
    plain = Plain(corpus)
    model = scoring.train(spark.createDataFrame([(t,) for t in corpus], "text string"), parts=parts)
    tests = TEXTS + ["unknown words w1 w2 w3", "w1 w1 unknown"]
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(tests)],
                               "doc_id long, text string, score string, other int")
    rows = {r.doc_id: r for r in scoring.score(df, model).collect()}
    assert len(rows) == len(tests) and rows[0].other == 7
    for i, t in enumerate(tests):
        n, known, total, base, full = plain.score(t)
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, full, rel_tol=1e-9)
    all_words = [*plain.count, "<unk>"]
    assert math.isclose(sum(plain.chance("the", w) for w in all_words), 1.0, rel_tol=1e-9)


class PlainTrigrams(Plain):
    """Bigrams told by the words before them, and trigrams over them."""

    def __init__(self, texts):
        super().__init__(texts)
        lists = [["<s>", *tokens(t)] for t in texts]
        self.triples = collections.Counter(x for t in lists for x in zip(t, t[1:], t[2:]))
        raw, self.pairs = self.pairs, collections.Counter(x[1:] for x in self.triples)
        self.pairs.update({p: n for p, n in raw.items() if p[0] == "<s>"})
        assert len(self.pairs) == len(raw)
        self.after, self.kinds = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
        for (a, b), n in self.pairs.items():
            self.after[a] += n
            self.kinds[a][min(n, 3) - 1] += 1
        histogram = lambda values: [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        self.d2 = scoring.discounts(histogram(self.pairs.values()))
        self.d3 = scoring.discounts(histogram(self.triples.values()))
        self.after3, self.kinds3 = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
        for (*context, _), n in self.triples.items():
            self.after3[tuple(context)] += n
            self.kinds3[tuple(context)][min(n, 3) - 1] += 1

    def chance3(self, context, b):
        lower, context = self.chance(context[-1], b), tuple(context)
        if context not in self.after3:
            return lower
        n = self.triples.get((*context, b), 0)
        rest = sum(d * k for d, k in zip(self.d3, self.kinds3[context])) / self.after3[context]
        return (n - (self.d3[min(n, 3) - 1] if n else 0)) / self.after3[context] + rest * lower

    def score(self, text):
        words = ["<s>", *tokens(text)]
        full = sum(math.log10(self.chance3(words[max(i - 2, 0):i], words[i])) for i in range(1, len(words)))
        return *super().score(text)[:4], full


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_trigram_scores_are_those_of_the_plain_model(spark, parts):
    rng = np.random.default_rng(1)
    words = [f"w{int(x)}" for x in rng.zipf(1.5, 4000) if x < 500]
    corpus = TEXTS + [" ".join(words[i:i + 40]) for i in range(0, len(words), 40)]
    plain = PlainTrigrams(corpus)
    model = scoring.train(spark.createDataFrame([(t,) for t in corpus], "text string"), order=3, parts=parts)
    assert (len(model.hot_pairs) > 0) == (parts > 1)  # contexts dealt over all parts are met too
    tests = TEXTS + ["unknown words w1 w2 w3", "w1 w1 unknown", "w1 w1 w1 w2 w1", "a unknown b c"]
    df = spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string")
    rows = {r.doc_id: r for r in scoring.score(df, model).collect()}
    for i, t in enumerate(tests):
        n, known, total, base, full = plain.score(t)
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, full, rel_tol=1e-9)
    for context in (["w1", "w1"], ["<s>", "the"], ["a", "b"]):
        assert math.isclose(sum(plain.chance3(context, w) for w in [*plain.count, "<unk>"]), 1.0, rel_tol=1e-9)


def test_the_query_knows_two_words_of_context(spark):
    texts = ["a b c", "x b d"] * 50
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(1001, "a b d")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in scoring.score_corpus(df).collect()}
    assert scores[0] > scores[1001] + 0.5
    assert scoring.score_corpus(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        scoring.train(df, order=4)


def test_an_empty_corpus_and_empty_tables(spark):
    model = scoring.train(spark.createDataFrame([], "text string"))
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in scoring.score(df, model).collect()}
    assert (rows[1].n_tokens, rows[1].n_known, rows[1].score) == (3, 0, 0.0)
    assert (rows[2].n_tokens, rows[2].base_score) == (1, 0.0)
    assert scoring.score_corpus(df.limit(0)).count() == 0


def test_held_out_documents_teach_nothing(spark):
    df = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), "id").alias("text"))
    rows = scoring.score_corpus(df).collect()
    assert {r.held_out for r in rows} == {True, False}
    assert all(r.n_known == (1 if r.held_out else 2) for r in rows)


def test_word_hashes_find_words_as_the_pattern_does():
    column = pa.array(TEXTS + ["a b", "end ", " start", "A a"])
    hashes, starts = common.word_hashes(column.slice(1))
    for text, a, b in zip(column.to_pylist()[1:], starts[:-1], starts[1:]):
        assert b - a == len(tokens(text)) - 1
    a, b = hashes[starts[-2]:starts[-1]]
    assert a == b  # A and a
    assert len(set(hashes.tolist())) == len({w for t in column.to_pylist()[1:] for w in tokens(t)[:-1]})


# --- language -------------------------------------------------------------------------------
def plain_bits(samples, text, order):
    """Code length of a text by the definition, one byte at a time."""
    counts = collections.defaultdict(collections.Counter)
    for sample in samples:
        data = sample.lower().encode()
        for i, byte in enumerate(data):
            for k in range(min(i, order) + 1):
                counts[data[i - k:i]][byte] += 1
    data, bits = text.lower().encode(), 0.0
    for i, byte in enumerate(data):
        for k in range(min(i, order), -1, -1):
            seen = counts.get(data[i - k:i])
            if not seen:
                continue
            n, d = sum(seen.values()), len(seen)
            if byte in seen:
                bits += -math.log2(seen[byte] / (n + d))
                break
            bits += -math.log2(d / (n + d))
        else:
            bits += 8
    return bits


SAMPLES = {"en": ["the quick brown fox jumps over the lazy dog", "this is the house that jack built"],
           "de": ["der schnelle braune fuchs springt über den faulen hund", "das ist das haus"],
           "fr": ["le vif renard brun saute par-dessus le chien paresseux"]}


def trained(spark, order):
    rows = [(i, t, lang, "k") for lang, texts in SAMPLES.items() for i, t in enumerate(texts)]
    rows += [(9, None, "en", "k"), (10, "x", None, "k"), (None, "the", "en", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n string")
    return language.train(df, order=order)


@pytest.mark.parametrize("order", [0, 2, 4])
def test_code_lengths_are_exact(spark, order):
    model = trained(spark, order)
    texts = ["the dog", "Das HAUS", "zzz qqq ÿ", "x", "le chien du house " * 30]
    data, starts = common.text_bytes(pa.array([t.lower() for t in texts]))
    bits = model.code_lengths(data, starts)
    samples = SAMPLES | {"en": [*SAMPLES["en"], "the"]}
    for row, text in zip(bits, texts):
        for lang, value in zip(model.languages, row):
            assert math.isclose(value, plain_bits(samples[lang], text, order), rel_tol=1e-9)


def test_predictions_of_odd_texts(spark):
    model = trained(spark, 3)
    texts = [None, "", "123 !?", "the house of the dog", "das haus", "the " * 50_000, "中文", "the house of the dog"]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    rows = {r.doc_id: r for r in language.predict(df, model).collect()}
    assert [rows[i].lang_pred for i in range(6)] == ["und", "und", "und", "en", "de", "en"]
    assert rows[6].lang_pred != "und"  # letters, if strange ones
    assert all(0 <= r.score <= 1 for r in rows.values()) and rows[0].score == 0.0
    assert rows[3].lang_pred == rows[7].lang_pred and rows[3].score == rows[7].score
    assert language.predict(df, model, keep_text=True).columns == ["doc_id", "text", "lang_pred", "score"]
    assert language.predict(df.limit(0), model).count() == 0


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.identify(df).collect()] == [("und", 0.0)]
    assert language.identify(df.limit(0)).count() == 0


def test_the_sample_is_bounded(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("aa bb").alias("text"), F.lit("en").alias("lang"))
    model = language.train(df, sample_bytes=1000)
    whole = language.train(df, sample_bytes=10**6)
    assert model.languages == whole.languages == ["en"]


def test_long_texts_do_not_starve_the_sample(spark):
    """Pieces are drawn up to the limit of each language, of texts of any length."""
    rows = [(i, "für " * 75, "de") for i in range(100)] + [(100, "ÄÖÜ ß" * 60_000, "de")]
    rows += [(200 + i, f"le vif {i} " * 30_000, "fr") for i in range(2)] + [(300, "å" * 9_000, "sv")]
    rows += [(None, "same row", "en")] * 4000
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    limit = 20_000
    found = collections.defaultdict(list)
    for r in language.drawn(df.repartition(7), limit, 1 << 25).collect():
        found[r.lang].append(r.text)
    size = {lang: sum(len(t.encode()) for t in texts) for lang, texts in found.items()}
    assert found["sv"] == ["å" * 9_000]  # smaller than the limit: whole
    slack = language.PIECE_BYTES
    assert all(limit - 8 <= size[x] <= limit + slack for x in ("de", "fr", "en"))
    assert all(t == "same row" for t in found["en"])
    assert all(t in "äöü ß" * 60_000 or t == "für " * 75 for t in found["de"])
    model = language.train(df, sample_bytes=100)
    assert model.languages == ["de", "en", "fr", "sv"]


def test_held_out_accuracy(spark):
    """On the benchmark tables nearly every held-out document is told right."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
