"""What the operators share: words, fixed hashes, slices of Arrow batches, shared files."""

from __future__ import annotations

import os
import string
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, with as many underscores in front as keep it apart from ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(column: str) -> Column:
    """A column by its whole name, whatever characters that holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column) -> Column:
    """Number of words of a text as long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; an id that is null counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus))


def uri(path: str) -> str:
    """A path in the form that file system libraries take: file:///..., or as it is."""
    return "file:///" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path


def mounted(path: str) -> str:
    """The path under which every machine has the shared folder mounted.

    Memory mapping needs a file system, so a folder of another scheme is refused.
    """
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        raise ValueError(f"spark.checkpoint.dir must be a mounted folder to map files: {path}")
    return path


def save_array(path: str, values: np.ndarray) -> None:
    """Write under a name of its own, then rename: a repeated task leaves one whole file."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(temporary, "wb") as out:
        np.save(out, values)
    os.replace(temporary, path)


def load_array(path: str) -> np.ndarray:
    """Memory-mapped, so all workers of a machine share the pages they touch."""
    try:
        return np.load(path, mmap_mode="r")
    except ValueError:  # an empty array can't be mapped
        return np.load(path)


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(sizes), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def mix(values: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit (splitmix64's last steps)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


@lru_cache(maxsize=2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    def series(base: int) -> np.ndarray:
        out = np.empty(length + 1, dtype=np.uint64)
        out[0] = 1
        done = 1
        while done <= length:
            step = min(done, length + 1 - done)
            out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        return out
    return series(_BASE), series(_BASE_INVERSE)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each text starts; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z lowered, and where each text's words start."""
    data, offsets = text_bytes(column)
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = _IS_WORD[data]
    opening = inside[1:-1] & ~inside[:-2]
    closing = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]  # a word ends with its text
    opening[edges] |= inside[1:-1][edges]
    closing[edges - 1] |= inside[1:-1][edges - 1]
    starts, ends = np.flatnonzero(opening), np.flatnonzero(closing) + 1
    return span_hashes(_LOWER[data], starts, ends), np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of each span: polynomials from running sums, then mixed."""
    n = len(data)
    powers, inverse = _powers(max(SLICE_BYTES, 1 << max(n - 1, 1).bit_length()))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(hashes + (ends - starts).astype(np.uint64))
