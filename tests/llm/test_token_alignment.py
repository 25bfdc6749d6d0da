"""Aligned tokens against a program that walks bytes, with the public libraries as tokenizers."""

import collections
import hashlib

import pytest

from wardline.llm import token_alignment as ta
from wardline.llm.queries import BYTE_TOKENIZER, TOKENIZER

FOLDER = "/root/testdata/sf0.001"
ODD = ["", None, " ", "a", "  two  spaces ", "line\n\nbreak \n x\t tab", "<|endoftext|> <s> </s> <unk>", "▁mark", "é" * 40,
       "naïve Ünïcode 中文 🙂👍🏽 x", "word " * 700, "x" * 5_000, "a b  c", "it's they're we'll", "\x00\x01 �", "é ä",
       "same text", "same text", " ̈x", "1234567 12 3,456.7", "trailing \n"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE_TOKENIZER)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)


def plain(rows, libraries):
    """doc rows by the definition: tokens that share a byte are linked."""
    a_model, b_model = libraries
    byte = ta._printable()

    def ids_and_bytes(text):
        a = a_model.encode(" " + text, add_special_tokens=False).ids
        b = b_model.encode(text)
        a_bytes = [bytes(byte[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, b_model.id_to_piece(i)) for i in b)]
        return a, b, a_bytes, b_bytes

    done = []
    for doc_id, text in rows:
        a, b, a_bytes, b_bytes = ids_and_bytes(text) if text else ([], [], [], [])
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            done.append((doc_id, 0, 0, [], ""))
            continue
        of_a = [k for k, x in enumerate(a_bytes) for _ in x]
        of_b = [k for k, x in enumerate(b_bytes) for _ in x]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(of_a, of_b)))]
        groups, first = [], (0, 0)
        for at, (i, j) in enumerate(zip(of_a, of_b)):
            last = at + 1 == len(of_a)
            if last or (of_a[at + 1] != i and of_b[at + 1] != j):
                groups.append(",".join(map(str, a[first[0]:i + 1])) + "|" + ",".join(map(str, b[first[1]:j + 1])))
                first = (i + 1, j + 1)
        done.append((doc_id, len(a), len(b), links, ";".join(groups)))
    counts = collections.Counter(p for *_, links, _ in done for p in set(links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(((d, n_a, n_b, g.count(";") + 1 if g else 0, len(links), sum(counts[p] == best[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "")
                   for d, n_a, n_b, links, g in done), key=str)


@pytest.mark.parametrize("block, piece", [(1 << 23, 1 << 20), (2_000, 700), (1, 10)])
def test_odd_texts_are_aligned_as_by_definition(spark, libraries, block, piece):
    rows = [*enumerate(ODD), (None, "no id"), (3, "a")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, `n_a.b` string").repartition(3)
    got = ta.alignments(docs, BYTE_TOKENIZER, TOKENIZER, block_bytes=block, slice_bytes=piece)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, libraries)


def test_corpus_is_aligned_as_by_definition(spark, libraries):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    got = ta.alignments(docs.repartition(4), BYTE_TOKENIZER, TOKENIZER, block_bytes=60_000, slice_bytes=20_000)
    assert sorted(map(tuple, got.collect()), key=str) == plain([tuple(r) for r in docs.collect()], libraries)


def test_encoders_give_the_ids_of_the_public_libraries(spark, libraries):
    a, b = ta.ByteLevel(BYTE_TOKENIZER), ta.Pieces(TOKENIZER)
    texts = [t for t in ODD if t] + [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    for text in texts:
        assert a.encode(text) == libraries[0].encode(" " + text, add_special_tokens=False).ids
        assert b.encode(text) == libraries[1].encode(text)


def test_pieces_of_a_long_text_have_its_tokens():
    a, b = ta.ByteLevel(BYTE_TOKENIZER), ta.Pieces(TOKENIZER)
    text = "some words\n and  more  \n\nthen the end of it all " * 40
    for limit in (1, 13, 200):
        pieces = list(ta.cuts(text, limit))
        assert " ".join(pieces) == text and (limit > 100 or len(pieces) > 20)
        assert [i for p in pieces for i in a.encode(p)] == a.encode(text)
        assert [i for p in pieces for i in b.encode(p)] == b.encode(text)


def test_equal_hashes_of_windows_do_no_harm(monkeypatch):
    monkeypatch.setattr(ta, "mix", lambda values: values * 0)
    tokenizers = ta.ByteLevel(BYTE_TOKENIZER), ta.Pieces(TOKENIZER)
    windows = ta.Windows(tokenizers)
    texts = [tuple(t.encode(x) for t in tokenizers) for x in ("red green red", "green blue")]
    numbers = [n.tolist() for n, _ in windows.of(texts)]
    assert numbers[0][0] == numbers[0][2] != numbers[0][1] == numbers[1][0]


def test_an_empty_table_has_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    got = ta.alignments(docs, BYTE_TOKENIZER, TOKENIZER)
    assert got.count() == 0 and got.schema.simpleString() == "struct<" + ",".join(
        f"{c.split(' ')[0]}:{'bigint' if c.endswith('long') else 'string'}" for c in ta.OUT.split(", ")) + ">"


class Counting:
    """A tokenizer that adds up the characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.bytes, self.seen = tokenizer, tokenizer.bytes, 0

    def encode(self, text):
        self.seen += len(text)
        return self.tokenizer.encode(text)


def test_each_different_word_of_a_block_is_encoded_once():
    tokenizers = Counting(ta.ByteLevel(BYTE_TOKENIZER)), Counting(ta.Pieces(TOKENIZER))
    block = ta.Block(tokenizers, ta.Windows(tokenizers))
    texts = ["the same few words, over and over again " * 200, "again and over\n the words "]
    for _ in range(2):
        for number, text in zip(block.numbers(texts), texts):
            block.add(1, [number])
    for t in tokenizers:
        assert t.seen < 200
    assert [r[1:3] for r in block.rows] == 2 * [tuple(len(t.encode(x)) for t in tokenizers) for x in texts]


def test_words_have_the_tokens_of_their_text_and_changed_ones_are_found():
    tokenizers = ta.ByteLevel(BYTE_TOKENIZER), ta.Pieces(TOKENIZER)
    texts = [t for t in ODD if t]
    for text in texts:
        assert " ".join(ta.words(text)) == text
        for t in tokenizers:
            assert [i for w in ta.words(text) for i in t.encode(w)] == t.encode(text)
    block = ta.Block(tokenizers, ta.Windows(tokenizers))
    many = [f"w{i}" + "▁" * (i % 97 == 5) for i in range(1_000)]
    block.numbers([" ".join(many), *texts])
    changed = {w for w, n in block.known.items() if not block.sizes[0, n]}
    assert {w for w in many if "▁" in w} == changed & set(many)
    for w, n in block.known.items():
        if w not in changed:
            assert block.sizes[:2, n].tolist() == [len(t.encode(w)) for t in tokenizers]
