"""SentencePiece, WARC archives and the pipeline, and their odd inputs."""

import base64
import gzip
import hashlib
import itertools
import os
from pathlib import Path

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from wardline.llm import queries, sentencepiece_codec as codec_, warc
from wardline.session import scratch_path

ODD_TEXTS = ["a  b ", " x", "日本 語", "a▁b", "x\n\ny\t1234", None, "", "   ", "é①ﬁ ÿ", "a" * 3000, "aaab " * 5, "  \n  ",
             "nul \x00 end", "The quick brown fox", "The quick brown fox", "🙂🙂 ok", "a b　c", "x" * 100_000 + " y"]


@pytest.fixture(scope="module")
def pieces():
    return codec_.load_pieces(queries.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.TOKENIZER)


def test_ids_are_those_of_the_library_and_decode(spark, pieces, library):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(ODD_TEXTS)],
                               "doc_id long, text string, hash string, token_ids int")
    codec = codec_.build(df, pieces, parts=5)
    rows = codec_.decode(codec_.encode(df, codec), pieces).collect()
    assert len(rows) == len(ODD_TEXTS)
    for r in rows:
        assert r.token_ids == library.encode(r.text or ""), r.text
        assert r.decoded == library.decode(r.token_ids) == (r.text or "").replace("▁", " ")
    again = {r.doc_id: r for r in codec_.encode(df, codec, ids="hash", restored="token_ids").collect()}
    for r in rows:
        assert again[r.doc_id].hash == r.token_ids
        assert again[r.doc_id].token_ids == (r.decoded == (r.text or ""))
    assert codec_.encode(df.limit(0), codec).count() == 0
    empty = codec_.build(df.limit(0), pieces)
    assert codec_.encode(df.filter("text = ''"), empty).first().token_ids == []


def test_documents_of_the_tables(spark, pieces, library):
    rows = queries.QUERIES["op3_sentencepiece"](spark, "/root/testdata/sf0.001").collect()
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    assert all(r.token_ids == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.token_ids) for r in rows)
    assert all(r.restored for r in rows) and len(rows) == len(texts)


def test_many_words_at_once_one_long_word_and_the_library_agree(pieces, library):
    merger = codec_.Merger(pieces)
    words = ["▁" + "".join(x) for x in itertools.product(["a", "th", "▁", "é", "ing", "\x07", "語"], repeat=4)]
    words += ["▁", "▁" * 40, "▁" + "abc" * 60, "", "é"]
    words = [w for w in words if "▁" not in w.lstrip("▁")]
    for word, ids in zip(words, merger.segment(words)):
        borders = codec_.merged_long(word, merger.table, merger.longest)
        symbols = [merger.table.get(word[i:j], (-1,))[0] for i, j in zip(borders[:-1], borders[1:])]
        assert ids == merger.with_bytes(symbols, word, borders)
        if word.startswith("▁"):
            assert ids == library.encode(word[1:].replace("▁", " ")) or word == "▁"


def test_best_path_of_a_unigram_model(spark):
    table = [("▁", 1, -3.0), ("▁a", 2, -2.0), ("a", 3, -2.5), ("b", 4, -2.5), ("ab", 5, -4.0), ("aba", 6, -5.5), ("▁ab", 7, -4.6)]
    pieces = codec_.Pieces(tuple(table), tuple(range(100, 356)), 0, True)
    words = ["▁" + "".join(x) for n in (0, 1, 2, 3, 5) for x in itertools.product("abé", repeat=n) if n < 4 or x[0] == "a"]
    df = spark.createDataFrame(list(enumerate(words)), "hash long, word string")
    got = {r.word: r.ids for r in codec_.best_path(codec_.lattice(df, pieces), pieces).collect()}
    known = {p: (i, s) for p, i, s in table}

    def best(word):
        paths = {0: (0.0, [])}
        for end in range(1, len(word) + 1):
            options = []
            for start in range(max(0, end - 3), end):
                part = word[start:end]
                if part in known:
                    options.append((paths[start][0] + known[part][1], end - start, paths[start][1] + [known[part][0]]))
            raw = [100 + b for b in word[end - 1].replace("▁", " ").encode()]
            options.append((paths[end - 1][0] - 15.5, 0, paths[end - 1][1] + raw))
            total, _, ids = max(options, key=lambda o: (o[0], o[1]))
            paths[end] = (total, ids)
        return paths[len(word)][1]
    assert got == {w: best(w) for w in words}


# --- WARC ------------------------------------------------------------------------------------------
PAGES = [(5, "http://a/ü b", "<p>ä</p>"), (1, None, None), (2, "http://b", ""), (3, "http://c\r\nX: 1", "<p>ä</p>"),
         (None, "http://d", "<p>ä</p>"), (7, "u", "one " * 40_000), (8, "u", "WARC/1.1\r\n\r\n"), (8, "u", "WARC/1.1\r\n\r\n"),
         (10**14, "u", "far away")]


def plain_records(pages, least=0):
    largest = {}
    for page, _, html in pages:
        if page is not None:
            largest[html or ""] = max(largest.get(html or "", page), page)
    out, responses = [], set()
    for page, _, html in pages:
        data = (html or "").encode()
        first = largest.get(html or "")
        # of rows that repeat a response one is the response
        revisit = len(data) >= least and (page != first or (page is not None and (page, html or "") in responses))
        responses.add((page, html or ""))
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least, roll, shard", [(0, 1 << 20, 1 << 20), (5, 1, 1), (0, 600, 3000)])
def test_archives_hold_every_page(spark, least, roll, shard):
    pages = spark.createDataFrame([(*p, 0) for p in PAGES], "page_id long, url string, html string, shard int")
    folders = [scratch_path(spark, "warc-test") for _ in range(2)]
    for folder, df in zip(folders, (pages, pages.repartition(5))):
        assert warc.write_archives(df, folder, least_bytes=least, roll_bytes=roll, shard_bytes=shard) == len(PAGES)
    rows = warc.read_archives(spark, folders[0]).collect()
    assert sorted(map(tuple, rows), key=repr) == plain_records(PAGES, least)
    first, second = (sorted(p for p in os.listdir(f) if not p.endswith(".crc")) for f in folders)
    assert first == second and not any(name.startswith("_") for name in first)  # no temporary file is left
    assert all(Path(folders[0], n).read_bytes() == Path(folders[1], n).read_bytes() for n in first)


def test_a_changed_archive_is_noticed(spark):
    pages = spark.createDataFrame(PAGES[:1], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    warc.write_archives(pages, folder)
    path = next(Path(folder).glob("*.warc.gz"))
    path.write_bytes(gzip.compress(gzip.decompress(path.read_bytes()).replace(b"<p>", b"<q>")))
    with pytest.raises(Exception, match="was changed"):
        warc.read_archives(spark, folder).collect()


def test_archives_of_nothing(spark):
    folder = scratch_path(spark, "warc-test")
    nothing = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write_archives(nothing, folder) == 0 and warc.read_archives(spark, folder).count() == 0


# --- the pipeline -----------------------------------------------------------------------------------
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, line string, _copies int"


def stages(spark, docs):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage-test")
        stage(spark, out[-1], "/nowhere").write.parquet(path)
        out.append(spark.read.parquet(path))
    return out[1:]


def test_stages_take_effect(spark):
    run = "\n".join(f"shared line {i} of a passage that repeats" for i in range(9))
    clean = [(i, f"document {i} tells of the matter {i * 7919} " * 8, "en", f"s{i % 3}") for i in range(100, 130)]
    rows = [(1, run + "\nmine alone", "en", "s0"), (2, "start\n" + run, "en", "s1"), (3, None, "en", "s0"), (4, "12 34", "en", "s0"),
            (5, "", "en", "s0"), (6, clean[0][1] + "more", None, "s1"), (7, "word " * 20, "en", None), (8, run, "en", "s0"),
            (None, "a text without any id", "en", "s1"), (None, "a text without any id", "en", "s1"), (9, "same row twice here", "en", "s1"),
            (9, "same row twice here", "en", "s1"), *clean]
    docs = spark.createDataFrame([(*r, len(r[1] or ""), "l", 9) for r in rows], DOCUMENTS)
    languages, lines, near, mixed, tokens = stages(spark, docs)
    ids = lambda df: sorted((r.doc_id for r in df.collect()), key=repr)
    assert set(ids(languages)) == {r[0] for r in rows} - {3, 4, 5}
    assert all(df.columns == docs.columns for df in (languages, lines, near, mixed))
    assert languages.filter("doc_id = 6").first().lang == "en"
    left = {r.doc_id: r for r in lines.filter("doc_id < 100").collect()}
    assert left[1].text == run + "\nmine alone" and left[2].text == "start" and left[2].n_chars == 5 and 8 not in left
    assert {r[0] for r in clean} <= set(ids(lines))
    after = ids(near)
    assert after.count(9) == 1 and after.count(None) == 2 and 6 in after and 100 not in after
    assert {r[0] for r in clean[1:]} <= set(after)
    assert set(ids(mixed)) <= set(after) and mixed.count() > 0
    assert tokens.count() == mixed.count() and tokens.filter("NOT restored").count() == 0


def test_documents_stay_if_no_language_was_learned(spark):
    rows = [(1, "some text", None), (2, "12 34", None), (3, None, None), (4, "ein Text", None)]
    docs = spark.createDataFrame([(i, t, x, "s", 1, "l", 1) for i, t, x in rows], DOCUMENTS)
    kept = corpus_pipeline.identify_language(spark, docs, "/nowhere").collect()
    assert sorted((r.doc_id, r.lang) for r in kept) == [(1, None), (4, None)]


def test_different_texts_under_one_id_are_documents_of_their_own(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(60)) for w in ("first", "second", "third"))
    rows = [(7, one), (7, two), (7, two), (7, three), (8, two + " more"), (6, three + " end"), (9, "alone in this table")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "l", 1) for i, t in rows], DOCUMENTS)
    kept = corpus_pipeline.remove_near_duplicates(spark, docs.repartition(3), "/nowhere")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        [(7, one), (7, two), (6, three + " end"), (9, "alone in this table")])


def test_an_empty_table_passes_all_stages(spark):
    assert [df.count() for df in stages(spark, spark.createDataFrame([], DOCUMENTS))] == [0] * 5


def test_run_on_the_tables(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and out.filter(~F.col("restored")).count() == 0
