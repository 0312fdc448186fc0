"""Token counts: a broadcast table of frequent pre-tokens, worker caches for the rest, no shuffle.

A byte-level tokenizer splits a text into pre-tokens and encodes each by itself, so a text's count
is the sum over its pre-tokens. The lengths of those most frequent in a bounded sample spread over
the input are broadcast as one compact table; any other pre-token is encoded once by each worker and
kept in a bounded cache. The table and the caches decide the speed only, never the counts.

A text of plain characters is cut by the pre-token pattern. Any other is first cut in front of white
space, which no pre-token reaches across from the left: its plain stretches are cut by the pattern,
the words between them are looked up as they are, and long ones (scripts without spaces) are cut by
the library's own pre-tokenizer.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import chunks, settle

VOCABULARY = "byte_bpe_50k.json"
# The sample for the table: so many partitions, evenly spread, and so much text of each.
SAMPLE_PARTITIONS = 256
SAMPLE_BYTES = 1 << 18
FREQUENT = 1 << 17
CACHED = 1 << 19
LONGEST_CACHED = 64

# The byte-level tokenizer's special string, and its pre-token pattern written out for
# code points whose class is the same in all Unicode tables: ASCII and the Latin letters to U+024F.
SPECIAL = "<|endoftext|>"
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = re.compile(rf"[\t\n\v\f\r\x20-\x7e{LETTERS}]*")
PRE_TOKEN = re.compile(
    rf" ?(?:[{LETTERS}]+|[0-9]+)|'(?:[stmd]|re|ve|ll)| ?[^\s0-9{LETTERS}]+|\s+(?!\S)|\s+"
)
# In front of white space that follows anything but white space, U+180E counted as both.
CUT = re.compile(r"(?<=[^\s\u180e])(?=[\t\n\v\f\r ])")


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism here
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def pieces(text: str, split) -> list[str]:
    """What a text without the special string is looked up by; ``split`` is the library's pre-tokenizer."""
    if PLAIN.fullmatch(text):
        return PRE_TOKEN.findall(text)
    parts: list[str] = []
    stretch: list[str] = []
    for word in CUT.split(text):
        if PLAIN.fullmatch(word):
            stretch.append(word)
            continue
        parts += PRE_TOKEN.findall("".join(stretch))
        stretch.clear()
        parts += [word] if len(word) <= LONGEST_CACHED else split(word)
    return parts + PRE_TOKEN.findall("".join(stretch))


def splitter(model):
    def split(text: str) -> list[str]:
        spans = (span for _, span in model.pre_tokenizer.pre_tokenize_str(text))
        return [text[start:end] for start, end in spans]

    return split


class Counting:
    """Counts tokens in one worker: first the broadcast table, then a bounded cache, then the library."""

    def __init__(self, path: str, keys: bytes, lengths: bytes):
        self.model = tokenizer(path)
        self.split = splitter(self.model)
        names = keys.decode().split("\0") if lengths else []
        self.table = dict(zip(names, lengths, strict=True))
        self.cache: dict[str, int] = {}

    def library(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, text: str) -> int:
        """The tokens of one text. The special string is one token wherever it stands."""
        if SPECIAL in text:
            between = text.split(SPECIAL)
            return len(between) - 1 + sum(map(self.count, filter(None, between)))
        parts = pieces(text, self.split)
        sizes = list(map(self.table.get, parts))
        if None not in sizes:
            return sum(sizes)
        cache = self.cache
        missed = [p for p, n in zip(parts, sizes, strict=True) if n is None]
        fresh = list({p for p in missed if p not in cache})
        lengths = dict(zip(fresh, self.library(fresh), strict=True)) if fresh else {}
        total = sum(filter(None, sizes)) + sum(lengths.get(p) or cache[p] for p in missed)
        if len(cache) + len(lengths) > CACHED:
            cache.clear()
        for part in fresh[:CACHED]:
            if len(part) <= LONGEST_CACHED:
                cache[part] = lengths[part]
        return total


# One counter per worker process: its cache outlives a task.
_counters: dict[tuple[str, bytes], Counting] = {}


def counter_of(path: str, keys: bytes, lengths: bytes) -> Counting:
    if (path, keys) not in _counters:
        _counters.clear()
        _counters[path, keys] = Counting(path, keys, lengths)
    return _counters[path, keys]


def frequent(docs: DataFrame, path: str, text: str = "text") -> list[str]:
    """The pre-tokens of a sample with the highest counts, at most ``FREQUENT``, in code point order.

    The sample is the first ``SAMPLE_BYTES`` of text, cut at the end of a document, of
    ``SAMPLE_PARTITIONS`` partitions spread evenly over the input. Its counts are added up by Spark;
    the driver gets at most ``FREQUENT`` short pre-tokens.
    """
    texts = docs.select(docs[text].cast("string").alias("t"))
    every = max(1, texts.rdd.getNumPartitions() // SAMPLE_PARTITIONS)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if TaskContext.get().partitionId() % every:
            return
        split, left = splitter(tokenizer(path)), SAMPLE_BYTES
        counts: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column("t").to_pylist():
                # The rest of a longer text is not needed; what is cut counts a little wrong here.
                value = (value or "")[:left].replace(SPECIAL, " ")
                left -= len(value)
                counts.update(p for p in pieces(value, split) if len(p) <= LONGEST_CACHED)
                if left <= 0:
                    break
            if left <= 0:
                break
        names = [name for name in counts if "\0" not in name]
        yield pa.RecordBatch.from_pydict(
            {"name": pa.array(names, pa.string()), "n": pa.array([counts[n] for n in names], pa.int64())}
        )

    counted = texts.mapInArrow(sample, "name string, n long").groupBy("name").agg(F.sum("n").alias("n"))
    counted = settle(counted, "pre-tokens")
    # The least count that no more than FREQUENT names reach, from the number of names by count.
    by_count = counted.groupBy("n").agg(F.count("*").alias("names"))
    reached = F.sum("names").over(Window.orderBy(F.col("n").desc()))
    least = by_count.select("n", reached.alias("names")).filter(F.col("names") <= FREQUENT)
    rows = counted.filter(F.col("n") >= least.agg(F.min("n")).scalar()).select("name").collect()
    return sorted(r.name for r in rows)


def frequent_lengths(names: list[str], path: str) -> tuple[bytes, bytes]:
    """The pre-tokens, joined, and a byte of length for each."""
    model = tokenizer(path)
    encoded = model.encode_batch_fast(names, add_special_tokens=False) if names else []
    known = [(name, len(e)) for name, e in zip(names, encoded, strict=True) if len(e) < 256]
    return "\0".join(name for name, _ in known).encode(), bytes(n for _, n in known)


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """One row per document: ``row`` (the input row, or its columns ``keep``), ``n_bytes``, ``n_tokens``.

    Counts are those of the library for the vocabulary at ``path`` (which every executor must
    have), special strings inside texts by its default, no truncation. A null text is empty; an
    empty one has no tokens. Rows are neither dropped nor reordered within a partition.
    """
    # Which rows the sample holds changes no count.
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(frequent(docs, path, text), path))
    rows = docs.select(
        F.struct(*(keep or ["*"])).alias("row"), docs[text].cast("string").alias("_text")
    )
    schema = T.StructType(
        [
            rows.schema["row"],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = counter_of(path, *table.value)
        for batch in chunks(batches, "_text"):
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            columns = [
                batch.column("row"),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array([counting.count(t) if t else 0 for t in texts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(count, schema)
