"""Spelling variants: K-d trees over letter counts, box-pruned range searches, letter order verified.

A word is the point of its length and its letter counts. One inserted, deleted or replaced letter
moves the counts by two at most in Manhattan distance, and by one if the length changes. Words are
searched per length pair (L, L) and (L, L + 1) in a K-d tree over all words: its upper part, fitted
to a bounded sample of them, deals the words to cells; a word visits every cell whose box its search
can reach. Within a cell the tree goes on down to small leaves, with boxes drawn tight around their
points; what is left is verified letter by letter. A pair is met once: words of one length search
from their own cell on, by number, and the longer word does not search. No pairs are written: a cell
gives every word the number of its near words there and the best of them.

A cell that holds more words or visitors than fit one task is worked on as a grid of blocks, every
part of its words against every part of its visitors.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import UPPER, settle

LETTERS = "[A-Za-zÀ-ÿ]"
LEAST_LETTERS = 7
LEAST_COUNT = 2
TIMES = 10  # a form is so many times as frequent
SAMPLE_WORDS = 1 << 16  # the sample that the upper tree is fitted to,
SAMPLE_LETTERS = 64  # of words of so many letters at most
HASH_SHARES = 1 << 20
LEAST_SAMPLE = 16  # words of the sample in a cell
CELL_WORDS = 1 << 12
BLOCK_ROWS = 1 << 15  # words or visitors of a cell that one task takes
LEAF = 128
AT_ONCE = 1 << 12
LEVELS = 8  # of a letter's count
LONGEST = 1 << 14
SIDE_BY_SIDE = 64  # longer words are compared one by one
OWN, SAME, LONGER, HOME = 1, 2, 4, 8  # why a word is in a cell: it lies or searches there, or both


def runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_letters: int = 1) -> DataFrame:
    """``doc_id, run`` of every maximal run of so many Latin letters, A-Z lower-cased. A null text
    has none."""
    # A search takes whole runs only, and makes no text of shorter ones.
    whole = F.lit(f"{LETTERS}{{{max(least_letters, 1)},}}")
    run = F.explode(F.regexp_extract_all(docs[text].cast("string"), whole, F.lit(0))).alias("run")
    upper = UPPER.decode()
    lowered = F.translate("run", upper, upper.lower()).alias("run")
    return docs.select(docs[doc_id].alias("doc_id"), run).select("doc_id", lowered)


def points(words: list[str]) -> np.ndarray:
    """Length and letter counts; letters beyond a-z share 64 counts, and a count ends at ``LEVELS``.

    Both only bring points nearer, so no near word is missed; letters are compared in the end.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    letter = np.where((codes >= 97) & (codes <= 122), codes - 96, 27 + codes % 64)
    row = np.repeat(np.arange(len(words)), sizes)
    counts = np.bincount(row * 91 + letter, minlength=len(words) * 91).reshape(len(words), 91)
    np.minimum(counts, LEVELS, out=counts)
    counts[:, 0] = np.minimum(sizes, LONGEST)
    return counts.astype(np.int16)


def one_longer(v: np.ndarray) -> np.ndarray:
    """The points of words of the same letters and one more place."""
    longer = v.copy()
    longer[:, 0] = np.minimum(longer[:, 0] + 1, LONGEST)
    return longer


def _axis(v: np.ndarray) -> tuple[int, int] | None:
    """The axis of the largest spread, and the value up to which a point goes low."""
    axis = int(v.astype(np.float64).var(axis=0).argmax())
    values = v[:, axis]
    low, high = int(values.min()), int(values.max())
    return None if low == high else (axis, min(int(np.median(values)), high - 1))


class Tree(NamedTuple):
    """The upper tree: per node its axis, the cut, the bounds it had on that axis, the children.

    A child below zero is a cell, as its complement.
    """

    axis: list[int]
    cut: list[int]
    least: list[int]
    most: list[int]
    low: list[int]
    high: list[int]

    @classmethod
    def fit(cls, v: np.ndarray, leaf: int) -> Tree:
        tree = cls([], [], [], [], [], [])
        far = np.iinfo(np.int64).max // 4
        cells = 0
        todo = [(np.arange(len(v)), {}, None)]
        while todo:
            mine, bounds, parent = todo.pop()
            split = _axis(v[mine]) if len(mine) > leaf else None
            if split is None:
                node, cells = ~cells, cells + 1
            else:
                axis, cut = split
                node = len(tree.axis)
                least, most = bounds.get(axis, (-far, far))
                for values, value in zip(tree, (axis, cut, least, most, 0, 0), strict=True):
                    values.append(value)
                below = v[mine, axis] <= cut
                todo.append((mine[below], bounds | {axis: (least, cut)}, (tree.low, node)))
                todo.append((mine[~below], bounds | {axis: (cut + 1, most)}, (tree.high, node)))
            if parent:
                parent[0][parent[1]] = node
        return tree

    def reach(self, v: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Which points reach which cells: within the radius of its box, in their very length."""
        rows, cells = [], []
        todo = [(0 if self.axis else ~0, np.arange(len(v)), np.zeros(len(v), np.int64))]
        while todo:
            node, mine, far = todo.pop()
            if not len(mine):
                continue
            if node < 0:
                rows.append(mine)
                cells.append(np.full(len(mine), ~node))
                continue
            values = v[mine, self.axis[node]].astype(np.int64)
            least, cut, most = self.least[node], self.cut[node], self.most[node]
            weight = radius + 1 if self.axis[node] == 0 else 1
            before = np.maximum(np.maximum(least - values, values - most), 0)
            for child, lower, upper in (
                (self.low[node], least, cut),
                (self.high[node], cut + 1, most),
            ):
                gap = np.maximum(np.maximum(lower - values, values - upper), 0)
                now = far + (gap - before) * weight
                near = now <= radius
                todo.append((child, mine[near], now[near]))
        if not rows:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(rows), np.concatenate(cells)


def one_edit(x: str, y: str) -> bool:
    """Whether one inserted or replaced letter makes ``y`` of ``x``."""
    at = 0
    for a, b in zip(x, y, strict=False):
        if a != b:
            break
        at += 1
    if len(x) == len(y):
        return at < len(x) and x[at + 1 :] == y[at + 1 :]
    return len(x) + 1 == len(y) and x[at:] == y[at + 1 :]


class Letters:
    """The letters of the words side by side, for comparing many pairs at once."""

    def __init__(self, words: list[str]):
        self.words = words
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        short = [w if len(w) <= SIDE_BY_SIDE else "" for w in words]
        width = max(map(len, short), default=0) + 2
        self.codes = np.array(short, f"<U{width}").view("<u4").reshape(len(words), width)

    def one_edit(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Of pairs of words: whether one inserted or replaced letter makes the second."""
        more = self.sizes[y] - self.sizes[x]
        out = np.zeros(len(x), bool)
        long = self.sizes[y] > SIDE_BY_SIDE
        for i in np.flatnonzero(long & ((more == 0) | (more == 1))):
            out[i] = one_edit(self.words[x[i]], self.words[y[i]])
        same, longer = np.flatnonzero(~long & (more == 0)), np.flatnonzero(~long & (more == 1))
        out[same] = (self.codes[x[same]] != self.codes[y[same]]).sum(axis=1) == 1
        a, b = self.codes[x[longer]], self.codes[y[longer]]
        # Equal up to some place, and from there on equal one place further.
        upto = (a != b).argmax(axis=1)
        beyond = a[:, :-1] != b[:, 1:]
        last = beyond.shape[1] - 1 - beyond[:, ::-1].argmax(axis=1)
        out[longer] = ~beyond.any(axis=1) | (last < upto)
        return out


def _in_bits(v: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Counts as bits, one for each of a letter's levels: distances become numbers of unequal bits."""
    bits = np.concatenate([v[:, i : i + 1] > np.arange(n) for i, n in enumerate(levels)], axis=1)
    packed = np.packbits(bits, axis=1)
    room = -(-max(packed.shape[1], 1) // 8) * 8
    out = np.zeros((len(v), room), np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def range_search(
    words: np.ndarray, asked: np.ndarray, radius: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs ``(query, word)`` of equal length within the query's radius.

    The K-d tree over the words is grown where queries go: a node whose box no query reaches is
    never split.
    """
    # Letters that no word has are as far from all of them.
    used = np.flatnonzero(words.max(axis=0) > 0)
    foreign = asked[:, words.max(axis=0) == 0].sum(axis=1)
    words, asked, radius = words[:, used], asked[:, used], radius - foreign
    levels = np.maximum(words[:, 1:].max(axis=0), asked[:, 1:].max(axis=0))
    bits, asked_bits = _in_bits(words[:, 1:], levels), _in_bits(asked[:, 1:], levels)
    todo = [(np.arange(len(words)), np.flatnonzero(radius >= 0))]
    while todo:
        mine, who = todo.pop()
        box = words[mine]
        low, high = box.min(axis=0), box.max(axis=0)
        near = []
        for part in np.array_split(who, len(who) // AT_ONCE + 1):
            some = asked[part]
            gap = np.maximum(np.maximum(low - some, some - high), 0)
            near.append(part[(gap[:, 0] == 0) & (gap[:, 1:].sum(axis=1) <= radius[part])])
        who = np.concatenate(near)
        if not len(who):
            continue
        split = _axis(box) if len(mine) > LEAF else None
        if split is not None:
            below = box[:, split[0]] <= split[1]
            todo.append((mine[below], who))
            todo.append((mine[~below], who))
            continue
        for some in np.array_split(mine, (len(mine) - 1) // LEAF + 1):
            for part in np.array_split(who, len(who) // AT_ONCE + 1):
                far = np.zeros((len(part), len(some)), np.uint16)
                for own, other in zip(asked_bits[part].T, bits[some].T, strict=True):
                    far += np.bitwise_count(own[:, None] ^ other[None, :])
                hit = (far <= radius[part, None]) & (asked[part, :1] == words[some, 0])
                q, w = np.nonzero(hit)
                yield part[q], some[w]


FOUND = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("near", T.LongType()),
        T.StructField("best_n", T.LongType()),
        T.StructField("best", T.StringType()),
    ]
)


def search_block(block: pa.Table) -> pa.Table:
    """The near words that one block of a cell knows: per word their number and the best."""
    words, counts = block["word"].to_pylist(), block["n"].to_numpy()
    why = block["why"].to_numpy()
    v, letters = points(words), Letters(words)
    own, same, longer = (np.flatnonzero(why & bit) for bit in (OWN, SAME, LONGER))
    near = np.zeros(len(words), np.int64)
    # The words by how good a form they make: of the larger count, of the smaller letters.
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    best = np.full(len(words), len(words))

    def add(of: np.ndarray, others: np.ndarray) -> None:
        np.add.at(near, of, 1)
        np.minimum.at(best, of, rank[others])

    if len(own) and len(same) + len(longer):
        asked = np.concatenate((v[same], one_longer(v[longer])))
        who = np.concatenate((same, longer))
        radius = np.repeat([2, 1], [len(same), len(longer)])
        for q, w in range_search(v[own], asked, radius):
            x, y = who[q], own[w]
            longer_pair = q >= len(same)
            once = longer_pair | (why[x] & HOME == 0) | (rank[x] < rank[y])
            hit = np.flatnonzero(once & (letters.sizes[y] - letters.sizes[x] == longer_pair))
            hit = hit[letters.one_edit(x[hit], y[hit])]
            add(x[hit], y[hit])
            add(y[hit], x[hit])
    found = np.flatnonzero(near)
    first = np.array(order, np.int64)[best[found]]
    return pa.table(
        [
            pa.array([words[i] for i in found], pa.string()),
            pa.array(near[found]),
            pa.array(counts[first].astype(np.int64)),
            pa.array([words[i] for i in first], pa.string()),
        ],
        names=FOUND.names,
    )


def _sorted_to_cells(words: DataFrame, tree: Tree) -> DataFrame:
    """``cell, why, word, n``: every word where it lies and where it searches."""
    schema = T.StructType(
        [
            T.StructField("cell", T.IntegerType()),
            T.StructField("why", T.IntegerType()),
            *words.schema.fields,
        ]
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = points(batch.column("word").to_pylist())
            own_rows, own = tree.reach(v, 0)
            home = np.empty(len(v), np.int64)
            home[own_rows] = own
            same_rows, same = tree.reach(v, 2)
            onward = same >= home[same_rows]
            found = [
                (rows * (1 << 32) + cells, np.full(len(rows), bit))
                for bit, (rows, cells) in (
                    (OWN | HOME, (own_rows, own)),
                    (SAME, (same_rows[onward], same[onward])),
                    (LONGER, tree.reach(one_longer(v), 1)),
                )
            ]
            keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            why = np.zeros(len(keys), np.int32)
            np.add.at(why, at, np.concatenate([b for _, b in found]))
            rows = batch.take(pa.array(keys >> 32))
            cells = pa.array((keys & 0xFFFFFFFF).astype(np.int32))
            yield pa.RecordBatch.from_arrays([cells, pa.array(why), *rows.columns], schema.names)

    return words.mapInArrow(deal, schema)


def near_words(words: DataFrame, cell_words: int = CELL_WORDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``word, n_near, best_n, best`` of every word of ``word, n`` (distinct) with a near word.

    ``best`` is the near word of the largest ``n``, of equal ones the smallest by code points.
    """
    total = words.count()
    # The upper tree only decides where words meet, never which words do: about SAMPLE_WORDS of
    # them, chosen by their hash, are enough.
    share = F.pmod(F.xxhash64("word"), F.lit(HASH_SHARES)) * max(total, 1) < HASH_SHARES * SAMPLE_WORDS
    few = words.filter((F.length("word") <= SAMPLE_LETTERS) & share)
    sample = sorted(few.select("word").toArrow()["word"].to_pylist())
    leaf = max(LEAST_SAMPLE, cell_words * len(sample) // max(total, 1)) if total > cell_words else total
    tree = Tree.fit(points(sample), leaf)
    dealt = settle(_sorted_to_cells(words, tree), "cells")
    # One row per cell; there are at most SAMPLE_WORDS of them.
    own = F.col("why").bitwiseAND(F.lit(OWN))
    parts = lambda some: F.greatest(F.ceil(F.count_if(some) / block_rows), F.lit(1)).cast("int")
    grid = dealt.groupBy("cell").agg(
        parts(own > 0).alias("across"), parts(F.col("why").bitwiseAND(F.lit(SAME | LONGER)) > 0).alias("down")
    )
    blocks = (
        dealt.join(F.broadcast(grid), "cell")
        .withColumns(
            {
                "own": own,
                "asks": F.col("why").bitwiseAND(F.lit(SAME | LONGER | HOME)),
                "col": F.pmod(F.xxhash64("word"), F.col("across").cast("long")).cast("int"),
                "row": F.pmod(F.xxhash64("word"), F.col("down").cast("long")).cast("int"),
            }
        )
        .select(
            "cell",
            "word",
            "n",
            # The word lies in every block of its column, and searches in every one of its row.
            F.expr(
                """inline(if(across = 1 and down = 1,
                    array(struct(0 as i, 0 as j, why as why)),
                    concat(transform(sequence(0, down - 1), j -> struct(col as i, j as j, own as why)),
                           transform(sequence(0, across - 1), i -> struct(i as i, row as j, asks as why)))))"""
            ),
        )
        .filter("why > 0")
    )
    found = blocks.groupBy("cell", "i", "j").applyInArrow(search_block, FOUND)
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (
        found.groupBy("word")
        .agg(F.sum("near").alias("n_near"), first.alias("first"))
        .select("word", "n_near", (-F.col("first.n")).alias("best_n"), F.col("first.word").alias("best"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: forms ``word, form`` followed to the last, by doubling the steps.

    Every form is more frequent than its word, so there are no circles.
    """
    current = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = current.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        if current.join(after, F.col("root") == F.col("_at"), "left_semi").isEmpty():
            return current
        jumped = current.join(after, F.col("root") == F.col("_at"), "left")
        current = settle(jumped.select("word", F.coalesce("_next", "root").alias("root")), "roots")


def variants(
    occurrences: DataFrame,
    word: str = "word",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    cell_words: int = CELL_WORDS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every distinct word that is long and frequent enough.

    ``occurrences`` has a row per occurrence in column ``word``; other columns do not matter. Words
    are near if they differ by exactly one inserted, deleted or replaced code point; ``n_near``
    counts a word's near words. Its ``form`` is the one of them with the largest ``n``, of equal
    ones the smallest by code points, if that is ``times`` its own ``n``, else null; ``form_n`` is
    the form's ``n``. ``root`` follows the forms to the last and is the word itself without one.
    Null and empty words never count; a very long word is one like any other. No words, no rows.
    """
    counted = (
        occurrences.select(F.col(word).cast("string").alias("word"))
        .filter(F.length("word") >= max(least_letters, 1))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= least_count)
    )
    words = settle(counted, "spellings")
    found = near_words(words, cell_words, block_rows)
    has = F.col("best_n") >= times * F.col("n")
    formed = settle(
        words.join(found, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("best")).alias("form"),
            F.when(has, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.filter("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
