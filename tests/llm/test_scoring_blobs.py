"""The blobs of counts that scoring shuffles: exact, and small once the shuffle has compressed them."""

import numpy as np
import pyarrow as pa

from wardline.llm import scoring


def test_blobs_give_back_what_they_got():
    edge = np.array([0, 1, 2 ** 32 - 1, 2 ** 32, 2 ** 63, 2 ** 64 - 1], dtype=np.uint64)
    for keys, counts in ((edge, np.array([1, 2, 300, 70_000, 2 ** 40, 1])), (edge[:0], np.empty(0, np.int64)),
                         (edge[-1:], np.array([1])), (edge[::-1].copy(), np.arange(6)), (np.array([3, 9]), np.array([1, 1]))):
        got, n = scoring.unpacked(scoring.packed(keys, counts))
        assert got.dtype == np.uint64 and got.tolist() == keys.tolist() and n.tolist() == counts.tolist()


def test_keys_of_pairs_compress():
    rng = np.random.default_rng(1)
    keys = np.unique((rng.integers(0, 2_000, 50_000).astype(np.uint64) << np.uint64(32)) | rng.integers(0, 50_000, 50_000).astype(np.uint64))
    blob = scoring.packed(keys, np.ones(len(keys), np.int64))
    assert len(pa.Codec("lz4_raw").compress(blob, asbytes=True)) < 4 * len(keys)
