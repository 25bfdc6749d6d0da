"""What scoring keeps on disk: a model of five bytes a key, exact all the same."""

import os

import numpy as np

from wardline.llm import scoring


def test_keys_are_found_and_others_are_not(tmp_path):
    rng = np.random.default_rng(3)
    context = np.concatenate([rng.integers(0, 3_000, 20_000), np.full(5_000, 7), 2 ** 32 - 1 - rng.integers(0, 3, 100)])
    all_keys = np.unique(context.astype(np.uint64) << np.uint64(32) | rng.integers(0, 2 ** 32, len(context)).astype(np.uint64))
    for keys in (all_keys, all_keys[:1], all_keys[:0], np.array([0, 2 ** 64 - 1], np.uint64)):
        path = f"{tmp_path}/keys-{len(keys)}.npy"
        scoring.Keys.save(path, keys)
        table = scoring.Keys.load(path)
        assert len(table) == len(keys) and table.all().dtype == np.uint64 and np.array_equal(table.all(), keys)
        asked = np.unique(np.concatenate([keys, keys + np.uint64(1), keys - np.uint64(1), np.array([0, 5], np.uint64)]))
        row, known = table.look_up(asked)
        assert np.array_equal(known, np.isin(asked, keys))
        assert np.array_equal(row[known], np.arange(len(keys)))


def test_large_numbers_stand_apart(tmp_path):
    numbers = np.array([[0, 1, 254, 255, 256, 3], [2 ** 40, 0, 0, 7, 255, 9]])
    path = f"{tmp_path}/numbers.npy"
    scoring.Numbers.save(path, numbers)
    found = scoring.Numbers.load(path, 2)
    assert len(found) == 6
    assert found.at(np.array([5, 0, 3, 4, 2])).tolist() == numbers[:, [5, 0, 3, 4, 2]].tolist()


def test_a_model_takes_few_bytes_a_key(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, 400) % 50_000) for _ in range(300)]
    common = " ".join(["a b"] * 300)  # counts of more than a byte
    model = scoring.train(spark.createDataFrame([(t,) for t in [*texts, common]], "text string"), order=3, parts=2)
    on_disk = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(model.folder) for f in files)
    triples = len({(a, b, c) for t in [*texts, common] for w in [["", *t.split(" "), "end"]]
                   for a, b, c in zip(w, w[1:], w[2:])}) - 301
    assert on_disk < 12 * (model.pairs + triples)
