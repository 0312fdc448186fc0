"""Cross-tokenizer alignment: divide and conquer at shared cuts, links counted over the corpus.

Two tokenizers cut the same bytes. Where a token of each ends on one byte offset, both sequences can
be cut. A stretch is cut at the shared end nearest to its middle, found by bisecting the other
side's ends, and both halves are cut in turn; a stretch without a shared end inside is a leaf, a
group whose tokens are linked. The stretches of a slice of documents are worked on together, level
by level.

An id pair counts once for every document that holds it linked. Documents are graded by these counts
in two tiers: pairs with more than a fixed fraction of all (document, pair) rows, of which there can
only be ``HEAVY``, are broadcast and looked up where the documents lie; the others, none of which
can be a hot key, meet their documents in a join.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import chunks, settle

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
HEAVY = 1 << 17  # pairs that hold more than one in so many of all rows are broadcast
SLICE_BYTES = 1 << 20  # texts encoded and cut together
PLAIN_GROUP = 64  # links of a group up to which they are listed before they are counted
SPACE = "▁"
# Fixed value: the pre-tokens of the byte-level vocabulary.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_letter() -> dict[str, int]:
    """The letters that stand for the 256 bytes in a byte-level vocabulary.

    A printable byte of Latin-1 is its own letter; the others take the code points from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(rest)}


class Side(NamedTuple):
    """One tokenizer: its ids for a list of texts, and the bytes behind every id."""

    encode: object
    pieces: list[bytes]
    sizes: np.ndarray


def _side(encode, pieces: list[bytes]) -> Side:
    return Side(encode, pieces, np.array([len(p) for p in pieces], np.int64))


def byte_level_side(path: str) -> Side:
    """The byte-level tokenizer at ``path``, special strings as plain text.

    Its vocabulary is numbered in the order of its merges, so it also serves as ranks for the
    faster of the two libraries that encode by it; where that gives up on a text (hundreds of
    thousands of blanks in a row), the other one encodes it.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism here
    import tiktoken
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    letters = byte_of_letter()
    special = {t.content for t in model.get_added_tokens_decoder().values()}
    pieces = [b""] * model.get_vocab_size()
    for token, i in model.get_vocab().items():
        pieces[i] = bytes(letters[c] for c in token)
    ranks = {pieces[i]: i for token, i in model.get_vocab().items() if token not in special}
    fast = tiktoken.Encoding(
        path, pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={}
    )

    def ids(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64)
        except ValueError:
            return np.array(model.encode(" " + text, add_special_tokens=False).ids, np.int64)

    return _side(lambda texts: [ids(t) for t in texts], pieces)


def piece_side(path: str) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        pieces.append(
            bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode()
        )
    return _side(
        lambda texts: [np.array(ids, np.int64) for ids in model.encode(texts, num_threads=1)], pieces
    )


# One pair of tokenizers per worker process; loading them takes longer than a slice of texts.
_sides: dict[tuple[str, str], tuple[Side, Side]] = {}


def sides_of(path_a: str, path_b: str) -> tuple[Side, Side]:
    if (path_a, path_b) not in _sides:
        _sides.clear()
        _sides[path_a, path_b] = byte_level_side(path_a), piece_side(path_b)
    return _sides[path_a, path_b]


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The tokens of A, in order, that end where one of B ends, found by divide and conquer.

    ``ends_a`` and ``ends_b`` are ascending byte offsets; document d holds the tokens of A from
    ``first[d]`` to before ``first[d + 1]``, and both sides end together at the end of a document.
    """
    low, high = first[:-1], first[1:] - 1  # the last token of a stretch is a cut already
    cuts = [high[high >= low]]
    low, high = low[high > low], high[high > low]
    while len(low):
        middle = (low + high - 1) // 2
        cut = np.full(len(low), -1)
        open_ = np.arange(len(low))
        near, far = 0, 1
        while len(open_):
            steps = np.arange(near, far)
            steps = np.stack((-steps, steps), axis=1).ravel()  # nearest first
            at = middle[open_, None] + steps
            inside = (at >= low[open_, None]) & (at < high[open_, None])
            ends = ends_a[np.where(inside, at, low[open_, None])]
            shared = inside & (ends_b[np.searchsorted(ends_b, ends)] == ends)
            hit = shared.any(axis=1)
            cut[open_[hit]] = at[hit, shared[hit].argmax(axis=1)]
            reach = np.maximum(middle[open_] - low[open_], high[open_] - 1 - middle[open_])
            open_ = open_[~hit & (reach >= far)]
            near, far = far, 2 * far
        low, cut, high = low[cut >= 0], cut[cut >= 0], high[cut >= 0]
        cuts.append(cut)
        low, high = np.concatenate((low, cut + 1)), np.concatenate((cut, high))
        low, high = low[high > low], high[high > low]
    return np.sort(np.concatenate(cuts))


class Aligned(NamedTuple):
    """What a slice of documents gives, by document; links as flat arrays behind ``links_first``."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    pairs: np.ndarray
    times: np.ndarray
    links_first: np.ndarray


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions ``first[i] .. first[i] + size[i]`` of all i, one after the other."""
    starts = np.cumsum(size) - size
    return np.repeat(first - starts, size) + np.arange(int(size.sum()))


def _links(a, b, last_a, last_b, doc, width):
    """Distinct (document, id pair) keys of all groups and how often each is linked."""
    first_a, first_b = np.append(0, last_a[:-1] + 1), np.append(0, last_b[:-1] + 1)
    size_a, size_b = last_a + 1 - first_a, last_b + 1 - first_b
    plain = size_a * size_b <= PLAIN_GROUP
    base = doc * width[0] * width[1]
    keys, times = [], []
    # Groups of few links: the tokens of A, each as often as there are tokens of B.
    own = np.flatnonzero(plain)
    at_a = _spread(first_a[own], size_a[own])
    group = np.repeat(own, size_a[own])
    repeats = size_b[group]
    at_b = _spread(first_b[group], repeats)
    keys.append(np.repeat(base[group] + a[at_a] * width[1], repeats) + b[at_b])
    times.append(np.ones(len(keys[0]), np.int64))
    for g in np.flatnonzero(~plain):  # long stretches of few ids: count these first
        ids_a, n_a = np.unique(a[first_a[g] : last_a[g] + 1], return_counts=True)
        ids_b, n_b = np.unique(b[first_b[g] : last_b[g] + 1], return_counts=True)
        keys.append((base[g] + ids_a[:, None] * width[1] + ids_b).ravel())
        times.append((n_a[:, None] * n_b).ravel())
    keys, times = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, int)
    return keys[new], np.add.reduceat(times, new) if len(new) else times


def align(texts: list[str | None], sides: tuple[Side, Side]) -> Aligned:
    """Groups and links of every text; texts that a tokenizer does not give back have no tokens."""
    given = [t or "" for t in texts]
    raw = [b" " + t.encode() if t else b"" for t in given]
    kept, ids = [], ([], [])
    encoded = [side.encode(given) for side in sides]
    for d, whole in enumerate(raw):
        if whole and all(
            b"".join(map(side.pieces.__getitem__, found[d].tolist())) == whole
            for side, found in zip(sides, encoded, strict=True)
        ):
            kept.append(d)
            for mine, found in zip(ids, encoded, strict=True):
                mine.append(found[d])
    n = len(texts)
    counts = [np.zeros(n, np.int64) for _ in range(4)]
    digests = [""] * n
    if not kept:
        none = np.empty(0, np.int64)
        return Aligned(*counts, digests, none, none, np.zeros(n + 1, np.int64))
    kept = np.array(kept)
    a, b = (np.concatenate(mine) for mine in ids)
    first_a, first_b = (np.append(0, np.cumsum([len(x) for x in mine])) for mine in ids)
    ends_a, ends_b = np.cumsum(sides[0].sizes[a]), np.cumsum(sides[1].sizes[b])
    last_a = shared_cuts(ends_a, ends_b, first_a)
    last_b = np.searchsorted(ends_b, ends_a[last_a])
    doc = np.searchsorted(first_a, last_a, "right") - 1  # of every group, among the kept
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    counts[0][kept], counts[1][kept] = np.diff(first_a), np.diff(first_b)
    counts[2][kept] = np.bincount(doc, minlength=len(kept))
    np.add.at(counts[3], kept[doc], size_a * size_b)

    # The groups as text: every token with the sign in front of it, in the order of the groups.
    signs = _signs(max(len(s.pieces) for s in sides))
    width = len(signs) // 3
    of_a, of_b = np.repeat(np.arange(len(doc)), size_a), np.repeat(np.arange(len(doc)), size_b)
    code = np.empty(len(a) + len(b), np.int64)
    begins_a, begins_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    begins_a[last_a + 1 - size_a], begins_b[last_b + 1 - size_b] = 2 * width, width
    code[np.arange(len(a)) + (last_b + 1 - size_b)[of_a]] = a + begins_a
    code[np.arange(len(b)) + last_a[of_b] + 1] = b + begins_b
    for i, d in enumerate(kept):
        mine = code[first_a[i] + first_b[i] : first_a[i + 1] + first_b[i + 1]].tolist()
        digests[d] = hashlib.sha256("".join(map(signs.__getitem__, mine))[1:].encode()).hexdigest()

    widths = len(sides[0].pieces), len(sides[1].pieces)
    keys, times = _links(a, b, last_a, last_b, kept[doc], widths)
    owner, pairs = np.divmod(keys, widths[0] * widths[1])
    return Aligned(*counts, digests, pairs, times, np.searchsorted(owner, np.arange(n + 1)))


_written: list[str] = []


def _signs(ids: int) -> list[str]:
    """Every id behind a comma, then behind a bar, then behind a semicolon."""
    if len(_written) != 3 * ids:
        _written[:] = [sign + str(i) for sign in ",|;" for i in range(ids)]
    return _written


def _list(values: np.ndarray, first: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


def with_links(docs: DataFrame, text: str, path_a: str, path_b: str) -> DataFrame:
    """``docs`` without ``text``, with its groups' figures and its distinct linked pairs."""
    added = [
        T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")
    ] + [
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("pairs", T.ArrayType(T.LongType())),
        T.StructField("times", T.ArrayType(T.LongType())),
    ]
    others = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*others, *added])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = sides_of(path_a, path_b)
        for batch in chunks(batches, text, SLICE_BYTES):
            done = align(batch.column(text).to_pylist(), sides)
            columns = [batch.column(f.name) for f in others]
            columns += [pa.array(x, pa.int64()) for x in done[:4]]
            columns += [
                pa.array(done.digests, pa.string()),
                _list(done.pairs, done.links_first, pa.int64()),
                _list(done.times, done.links_first, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(work, schema)


def _graded(docs: DataFrame, heavy) -> DataFrame:
    """Sums over the links of broadcast pairs, and what is left to look up."""
    others = [f for f in docs.schema.fields if f.name not in ("pairs", "times")]
    rest = T.StructType([T.StructField("pair", T.LongType()), T.StructField("times", T.LongType())])
    schema = T.StructType(
        [
            *others,
            T.StructField("n_best", T.LongType()),
            T.StructField("count_sum", T.LongType()),
            T.StructField("rest", T.ArrayType(rest)),
        ]
    )

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = heavy.value
        for batch in batches:
            lists = batch.column("pairs")
            pairs, times = (
                batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times")
            )
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            sums = np.zeros((2, len(sizes)), np.int64)
            if known.any():
                np.add.at(sums[0], row[known], times[known] * best[at[known]])
                np.add.at(sums[1], row[known], times[known] * counts[at[known]])
            first = np.append(0, np.cumsum(np.bincount(row[~known], minlength=len(sizes))))
            left = pa.StructArray.from_arrays(
                [pa.array(pairs[~known], pa.int64()), pa.array(times[~known], pa.int64())],
                ["pair", "times"],
            )
            columns = [batch.column(f.name) for f in others]
            columns += [pa.array(x, pa.int64()) for x in sums]
            columns.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), left))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(grade, schema)


def align_tokenizers(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    text: str = "text",
    keep: list[str] | None = None,
    heavy_pairs: int = HEAVY,
) -> DataFrame:
    """One row per document: ``row`` (the input row, or its columns ``keep``), ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    A is the byte-level tokenizer at ``path_a`` over a space and the text, B the piece tokenizer at
    ``path_b``, which adds that space itself; every executor must have both files. Special strings
    inside texts are plain text. A null or empty text, and one whose bytes a tokenizer does not
    give back, has no tokens: zeros and an empty digest. Rows count as documents, so a repeated row
    counts its pairs again; links of a row weigh as often as they occur. Ids, extra columns and
    their names do not matter. An empty table gives no rows.

    ``heavy_pairs`` bounds the broadcast table and decides no result.
    """
    rows = docs.select(
        F.struct(*(keep or ["*"])).alias("row"), docs[text].cast("string").alias("_text")
    )
    linked = with_links(rows, "_text", path_a, path_b)
    stored = settle(linked.withColumn("uid", F.monotonically_increasing_id()), "alignments")

    ids_b = len(sides_of(path_a, path_b)[1].pieces)
    id_a = F.expr(f"pair div {ids_b}L").alias("id_a")
    counts = settle(
        stored.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")),
        "pair-counts",
    )
    # One row per id of A: bounded by its vocabulary.
    tops = counts.groupBy(id_a).agg(F.max("n").alias("top"))
    graded = settle(
        counts.withColumn("id_a", id_a)
        .join(F.broadcast(tops), "id_a")
        .select("pair", "n", (F.col("n") == F.col("top")).alias("best")),
        "pair-grades",
    )
    total = graded.agg(F.sum("n")).first()[0] or 0
    is_heavy = F.col("n") * heavy_pairs > total
    table = graded.filter(is_heavy).toArrow().sort_by("pair")  # fewer than heavy_pairs rows
    heavy = docs.sparkSession.sparkContext.broadcast(
        (
            table["pair"].to_numpy(),
            table["n"].to_numpy(),
            table["best"].to_numpy().astype(np.int64),
        )
    )
    partly = settle(_graded(stored, heavy), "partly-graded")
    light = (
        partly.select("uid", F.inline("rest"))
        .join(graded.filter(~is_heavy), "pair")
        .groupBy("uid")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
    )
    more = lambda name: F.coalesce(name, F.lit(0))
    return (
        partly.drop("rest")
        .join(light, "uid", "left")
        .select(
            "row",
            "n_a",
            "n_b",
            "n_groups",
            "n_links",
            (F.col("n_best") + more("more_best")).alias("n_best"),
            (F.col("count_sum") + more("more_sum")).alias("count_sum"),
            "groups_sha256",
        )
    )
