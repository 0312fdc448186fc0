"""Benchmark decontamination: an FM-index per shard of documents, searched for benchmark phrases.

Every task reads its documents in shards of bounded size. Words become identifiers of the phrases'
vocabulary; a run of known words shorter than the shortest phrase cannot hold one, and the others
are indexed. Each phrase is searched backwards, its occurrences are located from sampled positions
and merged into spans of words. Documents are never shuffled, and read once. The phrases are a stated
query set: they are cut into blocks of bounded size, all broadcast in packed form, and a task meets
its shard with one unpacked block after the other.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import ALNUM, ALNUM_OR_WIDE, LOWER, chunks, find_words, settle, word_hashes
from caseflow.llm.fmindex import FMIndex

WINDOW = 10
SHARD_WORDS = 1 << 20
SHARD_BYTES = 32 << 20
# Text of one block of benchmark items, unless one item alone is longer. A block is collected on the
# driver and broadcast in packed form; every worker keeps the packed blocks, and one unpacked.
BLOCK_BYTES = 4 << 20
ITEM_WORD = re.compile(b"[0-9A-Za-z\x80-\xff]+")
SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("size", T.LongType())])
)


class Phrases(NamedTuple):
    """A block of windows: word hashes in order, windows by length, and the items of each window."""

    vocabulary: np.ndarray
    windows: list[np.ndarray]  # one matrix of word identifiers for each length
    owner_of: np.ndarray  # pairs in order: numbers of windows, and of items that hold them
    owner: np.ndarray
    items: list[str]

    def pack(self) -> bytes:
        return zstandard.compress(pickle.dumps(self, pickle.HIGHEST_PROTOCOL))


def unpack(block: bytes) -> Phrases:
    return pickle.loads(zstandard.decompress(block))


def phrases(rows: list[tuple[object, str | None]], window: int) -> Phrases:
    """The windows of benchmark items, equal windows together."""
    texts = pa.array([(text or "").encode().translate(LOWER).decode() for _, text in rows])
    words = find_words(texts.cast(pa.string()), ALNUM_OR_WIDE)
    vocabulary, ids = np.unique(word_hashes(words), return_inverse=True)
    ids = ids.astype(np.int32) + 1
    names = sorted({str(item) for item, _ in rows if item is not None})
    number = {name: i for i, name in enumerate(names)}
    numbers = np.array([-1 if item is None else number[str(item)] for item, _ in rows], np.int32)
    counts = np.diff(words.first)
    sizes = np.minimum(counts, window)
    windows, owner_of, owner, before = [], [], [], 0
    for size in np.unique(sizes[sizes > 0]).tolist():
        mine = np.flatnonzero(sizes == size)
        times = counts[mine] - size + 1
        which = np.repeat(np.arange(len(mine)), times)
        step = np.arange(times.sum()) - (np.cumsum(times) - times)[which]
        starts = words.first[mine][which] + step
        found = np.lib.stride_tricks.sliding_window_view(ids, size)[starts]
        distinct, place = np.unique(found, axis=0, return_inverse=True)
        named = numbers[mine][which] >= 0
        held = np.unique(np.stack((place.ravel()[named], numbers[mine][which][named])), axis=1)
        windows.append(distinct)
        owner_of.append(held[0] + before)
        owner.append(held[1])
        before += len(distinct)
    return Phrases(
        vocabulary,
        windows,
        np.concatenate([np.empty(0, np.int64), *owner_of]),
        np.concatenate([np.empty(0, np.int64), *owner]),
        names,
    )


def blocks_of(
    rows: Iterable[tuple[object, str | None]], block_bytes: int
) -> Iterator[list[tuple[object, str | None]]]:
    """The rows in lists of at most ``block_bytes`` of text; a longer text stands alone."""
    block, size = [], 0
    for item, text in rows:
        mine = len((text or "").encode())
        if block and size + mine > block_bytes:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += mine
    if block:
        yield block


class Shard:
    """Documents of one task up to a bounded size, as hashes of their words."""

    def __init__(self):
        self.batches: list[pa.RecordBatch] = []
        self.hashes: list[np.ndarray] = []
        self.first: list[np.ndarray] = []
        self.rows = self.bytes = 0
        self.spans: list[list[tuple[int, int]]] = []
        self.items: list[set[str]] = []

    def full(self) -> bool:
        return self.bytes >= SHARD_BYTES

    def add(self, batch: pa.RecordBatch, text: str) -> None:
        words = find_words(batch.column(text), ALNUM_OR_WIDE)
        lowered = np.frombuffer(LOWER, np.uint8)[words.data]
        self.hashes.append(word_hashes(words._replace(data=lowered)))
        self.first.append(words.first)
        self.batches.append(batch)
        self.rows += batch.num_rows
        self.bytes += len(words.data)
        self.spans.extend([] for _ in range(batch.num_rows))
        self.items.extend(set() for _ in range(batch.num_rows))

    def counts(self) -> np.ndarray:
        return np.concatenate([np.diff(first) for first in self.first])

    def search(self, block: Phrases) -> None:
        """Add the hits of a block: spans of words, and names of found items."""
        shortest = min((w.shape[1] for w in block.windows), default=1 << 62)
        runs, size, rows = [], 0, 0
        for hashes, first in zip(self.hashes, self.first, strict=True):
            run = known_runs(hashes, first, block.vocabulary, shortest)
            runs.append((run[0], np.where(run[1] < 0, -1, run[1] + rows), run[2]))
            rows += len(first) - 1
            size += len(run[0])
            if size >= SHARD_WORDS:
                self.search_runs(block, runs)
                runs, size = [], 0
        self.search_runs(block, runs)

    def search_runs(self, block: Phrases, runs: list[tuple[np.ndarray, ...]]) -> None:
        if not any(len(run[0]) for run in runs):
            return
        text, row, word = (np.concatenate(part) for part in zip(*runs, strict=True))
        index = FMIndex(text, len(block.vocabulary))
        change = np.zeros(len(text) + 1, np.int64)
        pairs, offset = [], 0
        for windows in block.windows:
            low, high = index.search(windows)
            found = np.flatnonzero(low < high)
            times = (high - low)[found]
            which = np.repeat(found, times)
            rows = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + low[which]
            at = index.locate(rows)
            np.add.at(change, at, 1)
            np.add.at(change, at + windows.shape[1], -1)
            pairs.append(np.unique(np.stack((row[at], which + offset)), axis=1))
            offset += len(windows)
        hit = np.cumsum(change[:-1]) > 0
        edges = np.diff(hit.astype(np.int8), prepend=0, append=0)
        for start, end in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
            self.spans[row[start]].append((int(word[start]), int(end - start)))
        docs, found = np.concatenate(pairs, axis=1)
        low = np.searchsorted(block.owner_of, found)
        high = np.searchsorted(block.owner_of, found, "right")
        for doc, start, end in zip(docs.tolist(), low.tolist(), high.tolist(), strict=True):
            self.items[doc].update(block.items[i] for i in block.owner[start:end].tolist())


def known_runs(
    hashes: np.ndarray, first: np.ndarray, known: np.ndarray, shortest: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of at least ``shortest`` known words of one batch, one separator (0, row -1) before each:
    word identifiers, rows and places within the row."""
    ids = np.searchsorted(known[:-1], hashes)
    ids = np.where(known[ids] == hashes, ids + 1, 0) if len(known) else np.zeros(len(hashes), int)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    # A run ends at an unknown word and at the end of a document.
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (ids[1:] == 0) | (ids[:-1] == 0) | (row[1:] != row[:-1])
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(starts, len(ids)))
    long = (ids[starts] > 0) & (sizes >= shortest)
    at = np.flatnonzero(np.repeat(long, sizes))
    heads = np.flatnonzero(fresh[at])
    return (
        np.insert(ids[at], heads, 0),
        np.insert(row[at], heads, -1),
        np.insert(at - first[row[at]], heads, -1),
    )


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one, in order."""
    merged: list[list[int]] = []
    for start, size in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], start + size)
        else:
            merged.append([start, start + size])
    return [(start, end - start) for start, end in merged]


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans, from the first byte of their first word to the last of their last."""
    if not spans:
        return text
    bounds = [m.span() for m in ITEM_WORD.finditer(text)]
    pieces, at = [], 0
    for start, size in spans:
        pieces.append(text[at : bounds[start][0]])
        at = bounds[start + size - 1][1]
    return b"".join([*pieces, text[at:]])


def _mark(docs: DataFrame, blocks: list[bytes], clean: bool) -> DataFrame:
    """``row``, ``_text`` (cut, or null unless ``clean``), ``n_words``, ``spans`` and ``items``."""
    packed = [docs.sparkSession.sparkContext.broadcast(block) for block in blocks]
    schema = T.StructType(
        [
            docs.schema["row"],
            docs.schema["_text"],
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", SPANS),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    arrow_spans = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))

    def results(shard: Shard) -> Iterator[pa.RecordBatch]:
        for block in packed:
            shard.search(unpack(block.value))
        counts, at = shard.counts(), 0
        for batch in shard.batches:
            here = slice(at, at + batch.num_rows)
            spans = [merge_spans(s) for s in shard.spans[here]]
            content = batch.column("_text")
            if not clean:
                content = pa.nulls(batch.num_rows, pa.string())
            elif any(spans):
                whole = content.cast(pa.binary()).to_pylist()
                cut = [cut_spans(t, s) if s else t for t, s in zip(whole, spans, strict=True)]
                content = pa.array(cut, pa.binary()).cast(pa.string())
            listed = [[{"start": a, "size": n} for a, n in s] for s in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    content,
                    pa.array(counts[here], pa.int64()),
                    pa.array(listed, arrow_spans),
                    pa.array([sorted(i) for i in shard.items[here]], pa.list_(pa.string())),
                ],
                schema.names,
            )
            at += batch.num_rows

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in chunks(batches, "_text"):
            shard.add(batch, "_text")
            if shard.full():
                yield from results(shard)
                shard = Shard()
        if shard.batches:
            yield from results(shard)

    return docs.mapInArrow(search, schema)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
    clean: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: ``row`` (the input row, or its columns ``keep``), ``n_words``,
    ``spans`` (start and size in words, merged and in order), ``items`` and, if ``clean``,
    ``_text``: the text without the spans.

    Items are compared by windows of ``window`` words, shorter ones as a whole. Null and empty
    texts have no words and are never hit; items without words have no windows; an item without an
    id still removes text but is not listed; equal ids count once. An empty benchmark or table is
    fine: nothing is hit, or no rows come out.
    """
    items = benchmark.select(
        benchmark[item_id].cast("string").alias("item"), benchmark[item_text].cast("string").alias("text")
    ).distinct()
    items = settle(items, "items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A larger benchmark passes through the driver block by block, never as a whole.
    rows = items.collect() if size <= block_bytes else items.toLocalIterator()
    blocks = [phrases(block, window).pack() for block in blocks_of(rows, block_bytes)]
    marked = docs.select(
        F.struct(*(keep or ["*"])).alias("row"), docs[text].cast("string").alias("_text")
    )
    return _mark(marked, blocks, clean)


def remove_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without the words of benchmark passages, columns unchanged.

    Documents that keep no word of those they had are dropped; clean ones stay as they are.
    """
    found = find_benchmark(docs, benchmark, text, clean=True, **options)
    left = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["size"])
    return (
        found.filter((left == 0) | (left < F.col("n_words")))
        .select(F.col("row").withField(text, F.col("_text")).alias("row"))
        .select("row.*")
    )
