"""Near-duplicates, substrings and benchmark passages against plain versions."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import (
    ROLLING,
    classes_of,
    components,
    contamination,
    edge_docs,
    kept_words,
    simhash,
    triples,
)
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseflow.llm import decontaminate, simhash as sh, substrings
from caseflow.llm.components import connected
from caseflow.llm.fmindex import FMIndex


def signed(value):
    return value - (1 << 64) if value >> 63 else value


# --- components ------------------------------------------------------------------------------


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (-5, 200)]
    random.Random(1).shuffle(edges)
    found = connected(spark.createDataFrame(edges, "u long, v long")).collect()
    roots = {r.node: r.root for r in found}
    assert len(found) == len(roots)
    assert all(roots[i] == 1 for i in range(1, 41))
    assert all(roots[i] == 100 for i in range(100, 130))
    assert roots[200] == roots[-5] == -5
    assert connected(spark.createDataFrame([], "u long, v long")).collect() == []


# --- SimHash ---------------------------------------------------------------------------------


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", ROLLING, ROLLING * 40, "É é e f g"])
def test_fingerprint(text):
    assert sh.fingerprint(None if text is None else text.encode(), 3) == simhash(text)


def test_links_find_exactly_the_pairs_within_two_bits(spark):
    rng = random.Random(3)
    prints = {0, (1 << 64) - 1, 1, 3, 7, 1 << 63, 3 << 62}
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for bits in (1, 2, 2, 3, 4):
            other = base
            for b in rng.sample(range(64), bits):
                other ^= 1 << b
            prints.add(other)
    prints = sorted(prints)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "_fp long")
    links = [(r.u, r.v) for r in sh.near_links(frame).collect()]
    number = {signed(p): i for i, p in enumerate(prints)}
    assert all((prints[number[u]] ^ prints[number[v]]).bit_count() <= 2 for u, v in links)
    roots = {r.node: r.root for r in connected(frame.sparkSession.createDataFrame(links, "u long, v long")).collect()}
    expected = classes_of(prints)
    mine = [roots.get(signed(p), signed(p)) for p in prints]
    assert len(set(zip(mine, expected, strict=True))) == len(set(mine)) == len(set(expected))


def test_dealt_fingerprints_are_not_broadcast(spark):
    # Each is dealt to up to 33 cells, which the size of the fingerprints says nothing of.
    links = sh.near_links(spark.createDataFrame([(p,) for p in range(9)], "_fp long"))
    assert links.collect()
    assert "Broadcast" not in links._jdf.queryExecution().executedPlan().toString()


def near_docs():
    rng = random.Random(5)
    vocabulary = [f"word{i}" for i in range(400)]
    texts = []
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(300)]
        texts.append(base)
        for _ in range(4):
            copy = list(base)
            copy[rng.randrange(300)] = "changed"
            texts.append(copy)
    return [(100 + i, " ".join(t), "n") for i, t in enumerate(texts)]


def test_near_groups(spark):
    docs = edge_docs(spark, near_docs())
    groups = sh.near_groups(docs)
    rows = groups.select("row.doc_id", "row.text", "fingerprint", "component_id", "leads").collect()
    expected = components([(r.doc_id, r.text) for r in rows])
    assert [(int(r.fingerprint, 16), r.component_id) for r in rows] == expected
    assert all(len(r.fingerprint) == 16 for r in rows)
    n_classes = len(set(classes_of([p for p, _ in expected])))
    assert sum(r.leads for r in rows) == n_classes
    assert all(r.doc_id == r.component_id for r in rows if r.leads)
    kept = sh.drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == n_classes
    assert sh.near_groups(docs.limit(0)).count() == 0


# --- substrings ------------------------------------------------------------------------------


def check_substrings(docs):
    rows = substrings.remove_repeats(docs).select("row.doc_id", "row.text", "n_words", "n_removed", "kept").collect()
    expected = kept_words([(r.doc_id, r.text) for r in rows])
    assert [(r.n_words, r.n_removed, r.kept) for r in rows] == expected
    return rows


def test_substrings(spark):
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    extra = []
    for i in range(40):
        at, size = rng.randrange(40), rng.randrange(8, 40)
        noise = [f"n{rng.randrange(30)}" for _ in range(rng.randrange(30))]
        extra.append((200 + i, " ".join(noise + passage[at : at + size] + noise[::-1]), "s"))
    # Few different words: anchors with very many contexts.
    extra += [(300 + i, " ".join(rng.choice("ab") for _ in range(60)), "s") for i in range(30)]
    extra += [(400, "x " * 40, "s"), (401, "x " * 13, "s"), (402, "x " * 12, "s")]
    docs = edge_docs(spark, extra)
    rows = check_substrings(docs)
    assert any(r.n_removed for r in rows)
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 9))
def test_first_smallest_in_window(values, width):
    values = np.array(values, np.int64)
    found = substrings.leftmost_least(values, width) if len(values) >= width else np.empty(0)
    expected = [i + int(np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)]
    assert found.tolist() == expected


# --- FM-index and benchmark ------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=25), max_size=8), st.integers(1, 4))
def test_index_finds_every_occurrence(runs, size):
    text = np.array([s for run in runs for s in (0, *run)] or [0], np.int64)
    index = FMIndex(text, 4)
    patterns = np.array(np.meshgrid(*[range(1, 5)] * size)).reshape(size, -1).T
    low, high = index.search(patterns)
    for pattern, a, b in zip(patterns, low, high, strict=True):
        expected = [i for i in range(len(text) - size + 1) if (text[i : i + size] == pattern).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


ITEMS = [
    (1, ROLLING),
    (2, "Gamma DELTA, epsilon zeta eta theta iota kappa lambda mu nu different ending here"),
    (3, "short item"),
    (3, "short item"),
    (None, "a text without any id"),
    (5, None),
    (6, " ... "),
    (7, "one"),
]


def benchmark_docs(spark):
    return edge_docs(
        spark,
        [
            (50, "before " + ROLLING.replace(" ", " -- ") + " after, a SHORT item; x a text without any id", "q"),
            (51, "short. item short-item shortitem", "q"),
            (52, "beta gamma delta epsilon zeta eta theta iota kappa", "q"),
        ],
    )


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_benchmark(spark, block_bytes):
    docs, items = benchmark_docs(spark), spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.find_benchmark(docs, items, block_bytes=block_bytes)
    rows = found.select("row.text", "n_words", "spans", "items").collect()
    expected = contamination([r.text for r in rows], ITEMS)
    assert [(r.n_words, sum(s["size"] for s in r["spans"]), r["items"]) for r in rows] == expected
    cleaned = decontaminate.remove_benchmark(docs, items, block_bytes=block_bytes)
    assert cleaned.columns == docs.columns
    left = cleaned.collect()
    again = contamination([r.text for r in left], [i for i in ITEMS if i[0] in (1, 2)])
    assert not any(hits for _, hits, _ in again)
    clean = {(r.text or "") for r, (_, n, _) in zip(rows, expected, strict=True) if not n}
    assert clean <= {(r.text or "") for r in left}
    assert any("after, a " in (r.text or "") for r in left)


def test_benchmark_blocks(spark, monkeypatch):
    """Copied items count once, no block passes its bound, and no document is written or read twice."""
    copies = [(1, ROLLING)] * 500 + [(i, f"item number {i} of a benchmark with many small texts {i}") for i in range(300)]
    items = spark.createDataFrame(copies, "item_id long, text string")
    docs = spark.createDataFrame(
        [(i, f"x {ROLLING} y item number {i} of a benchmark with many small texts {i} z") for i in range(40)],
        "doc_id long, text string",
    )
    seen, cut = [], decontaminate.phrases
    monkeypatch.setattr(decontaminate, "phrases", lambda rows, n: seen.append(rows) or cut(rows, n))
    found = decontaminate.find_benchmark(docs, items, block_bytes=1_000)
    assert len(seen) > 15 and len({len(r) for r in seen}) < 5
    assert all(sum(len(text) for _, text in rows) <= 1_000 or len(rows) == 1 for rows in seen)
    assert sorted(row for rows in seen for row in rows) == sorted(set((str(i), t) for i, t in copies))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan
    rows = found.select("row.text", "n_words", "spans", "items").collect()
    expected = contamination([r.text for r in rows], sorted(set(copies)))
    assert [(r.n_words, sum(s["size"] for s in r["spans"]), r["items"]) for r in rows] == expected


def test_long_shards_are_searched_in_parts(spark, monkeypatch):
    rows = [(str(i), t) for i, t in [(1, "a b c d e f g h i j k"), (2, "c d e")]]
    block = decontaminate.phrases(rows, 10)
    texts = ["x a b c d e f g h i j k y", None, "", "c d e", "a b"] * 30
    results = []
    for most in (1 << 20, 20):
        monkeypatch.setattr(decontaminate, "SHARD_WORDS", most)
        shard = decontaminate.Shard()
        for at in range(0, len(texts), 7):
            shard.add(pa.RecordBatch.from_pydict({"t": pa.array(texts[at : at + 7], pa.string())}), "t")
        shard.search(decontaminate.unpack(block.pack()))
        results.append((shard.spans, shard.items))
    assert results[0] == results[1]
    assert results[0][0][:4] == [[(1, 11)], [], [], [(0, 3)]] and results[0][1][0] == {"1", "2"}


def test_benchmark_empty(spark):
    docs = benchmark_docs(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate.find_benchmark(docs, none).select("spans", "items").collect()
    assert len(rows) == docs.count() and not any(r["spans"] or r["items"] for r in rows)
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.find_benchmark(docs.limit(0), some).count() == 0


def test_spans_merge():
    assert decontaminate.merge_spans([(5, 2), (0, 3), (3, 1), (6, 4)]) == [(0, 4), (5, 5)]
    assert decontaminate.merge_spans([]) == []
    assert decontaminate.cut_spans("a, b! cé d.".encode(), [(1, 2)]).decode() == "a,  d."


def test_digest_of_no_items(spark):
    from caseflow.llm.queries import op2_decontaminate

    rows = op2_decontaminate(spark, "/root/testdata/sf0.001").filter("not contaminated").take(1)
    assert rows[0].items_sha256 == hashlib.sha256(b"").hexdigest()


