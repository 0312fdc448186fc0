"""Helpers of the training-data operators: Arrow batches of text, words in bytes, cut lineage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from caseflow.session import materialise

CHUNK_BYTES = 4 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The two word definitions of the contracts, over UTF-8 bytes. Bytes from 0x80 on
# only occur inside code points beyond ASCII, which are word characters in both.
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALNUM = b"0123456789" + UPPER + UPPER.lower()

LOWER = bytes(c + 32 if c in UPPER else c for c in range(256))
NOT_WHITE = np.array([c not in WHITE for c in range(256)])
ALNUM_OR_WIDE = np.array([c in ALNUM or c >= 0x80 for c in range(256)])


def settle(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder, read it back, drop its shuffle files.

    The written copy survives lost executors, so nothing needs the shuffle files afterwards; at
    scale they would fill the executors' disks until the driver happens to collect its garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return materialise(df, label)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def chunks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of ``column``; a longer row stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        upto = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = upto[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(upto, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


class Words(NamedTuple):
    """The words of a slice of texts: bytes, bounds of every word, first word of every row."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # one entry more than rows: the last is the number of words


def find_words(column: pa.Array, inside: np.ndarray) -> Words:
    """Maximal runs of bytes for which ``inside`` holds; a null text has none."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, bounds, content = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(bounds[-1] - bounds[0])
    data = np.frombuffer(content, np.uint8, size, int(bounds[0])) if size else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    word = inside[data]
    left = np.zeros(size, bool)
    left[1:] = word[:-1]
    left[bounds[:-1][bounds[:-1] < size]] = False
    right = np.zeros(size, bool)
    right[:-1] = word[1:]
    right[bounds[1:][bounds[1:] > 0] - 1] = False
    start = np.flatnonzero(word & ~left)
    end = np.flatnonzero(word & ~right) + 1
    return Words(data, start, end, np.searchsorted(start, bounds))


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of every word, eight bytes at a time over all words at once."""
    padded = np.zeros(len(words.data) + 8, np.uint8)
    padded[:-8] = words.data
    eights = np.ndarray(len(words.data) + 1, np.dtype("<u8"), padded, strides=(1,))
    left = words.end - words.start
    hashes = scramble(left.astype(np.uint64))
    at = np.arange(len(left))
    done = 0
    while len(at):
        value = eights[words.start[at] + done]
        short = left[at] - done < 8
        bits = ((left[at][short] - done) * 8).astype(np.uint64)
        value[short] &= (np.uint64(1) << bits) - np.uint64(1)
        hashes[at] = scramble(hashes[at] * np.uint64(0x9E3779B97F4A7C15) + value)
        done += 8
        at = at[left[at] > done]
    return hashes


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` consecutive words."""
    count = max(0, len(hashes) - size + 1)
    total = np.zeros(count, np.uint64)
    for j in range(size if count else 0):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + count]
    return scramble(total)


def as_long(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's signed ones, bit for bit."""
    return values.astype(np.uint64, copy=False).view(np.int64)
