"""Spelling variants against neighbourhoods of deleted letters."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import edge_docs
from pyspark.sql import functions as F

from caseflow.llm import spelling
from caseflow.llm.queries import all_queries, table, with_slips

SF_DIR = "/root/testdata/sf0.001"


def near_pairs(words):
    """All pairs one edit apart: words that share a deletion, or of which one is the other's."""
    holes = defaultdict(set)
    for w in words:
        holes[w, None].add(w)
        for i in range(len(w)):
            holes[w[:i] + w[i + 1 :], i].add(w)  # replaced at i
            holes[w[:i] + w[i + 1 :], None].add(w)
    near = defaultdict(set)
    known = set(words)
    for (rest, at), some in holes.items():
        if at is not None:
            for w in some:
                near[w] |= some - {w}
        elif rest in known:
            for w in some - {rest}:
                near[w].add(rest)
                near[rest].add(w)
    return near


def expected(occurrences, letters=7, least=2, times=10):
    counts = Counter(w for w in occurrences if w and len(w) >= letters)
    counts = {w: n for w, n in counts.items() if n >= least}
    near = near_pairs(list(counts))
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= times * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts.get(form[w]))
    return out


def rows_of(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def occurrences(text, doc_id):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        at = h % len(run)
        yield run[:at] + run[at + 1 :] if h % 31 == 0 else run


def test_query_on_documents(spark):
    rows = table(spark, SF_DIR, "documents").collect()
    query = all_queries()["op13_spelling_variants"](spark, SF_DIR)
    assert set(query.columns) == {"word", "form", "root", "n", "n_near", "form_n"}
    wanted = expected(w for r in rows for w in occurrences(r.text, r.doc_id))
    assert rows_of(query) == wanted
    assert any(form for form, *_ in wanted.values())


def test_slips(spark):
    docs = edge_docs(spark, [(12, "ÀÉABCD×÷xyz ~ straßen" * 40, "a")])
    words = with_slips(spelling.runs(docs)).collect()
    wanted = Counter(w for r in docs.collect() for w in occurrences(r.text, r.doc_id))
    assert Counter(r.word for r in words) == wanted


def test_short_runs_are_not_cut_out_first(spark):
    """No text is made of runs that are too short; long ones come whole, beside anything."""
    long = "Ab" * 400_000
    texts = [(1, f"{long}1abcdefg_ABCDEFÿ\U0001f600abcdef abcdefgh"), (2, None), (3, ""), (4, "abcdef")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = spelling.runs(docs, least_letters=7)
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, long.lower()), (1, "abcdefg"), (1, "abcdefgh"), (1, "abcdefÿ")
    ]
    assert "split(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert spelling.runs(docs).count() == 6


def given(spark, counts):
    rows = [(w, n) for w, n in counts.items()]
    df = spark.createDataFrame(rows, "word string, n int")
    return df.select("word", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("best"))


@pytest.mark.parametrize("cell_words, block_rows", [(1 << 12, 1 << 15), (24, 1 << 15), (24, 7), (1 << 12, 50)])
def test_any_cells_and_blocks(spark, cell_words, block_rows):
    random = np.random.default_rng(3)
    base = ["".join(random.choice(list("abcdeé×"), random.integers(7, 10))) for _ in range(60)]
    counts = {}
    for w in base:
        counts[w] = int(random.integers(2, 400))
        for _ in range(4):
            at = int(random.integers(len(w)))
            letter = str(random.choice(list("abcdeéà")))
            for x in (w[:at] + w[at + 1 :], w[:at] + letter + w[at:], w[:at] + letter + w[at + 1 :], w[::-1]):
                counts.setdefault(x, int(random.integers(1, 9)))
    df = given(spark, counts)
    found = spelling.variants(df, cell_words=cell_words, block_rows=block_rows)
    assert rows_of(found) == expected(w for w, n in counts.items() for _ in range(n))


def test_chains_ties_and_odd_words(spark):
    long_word = "w" * 30_000
    counts = {
        "letters": 2_000,
        "lettters": 200,
        "letttters": 20,
        "lettttters": 2,
        "variant": 5,
        "variaxt": 50,
        "varianté": 50,
        "varianx": 50,
        "anagram": 9,
        "margana": 9,
        long_word: 20,
        long_word + "x": 2,
        "once only": 1,
        "short": 90,
    }
    df = given(spark, counts).unionByName(spark.createDataFrame([(None, 1), ("", 1)], "word string, best int"))
    found = rows_of(spelling.variants(df))
    assert found == expected(w for w, n in counts.items() for _ in range(n))
    assert found["lettttters"][:2] == ("letttters", "letters")
    assert found["variant"][:2] == ("varianté", "varianté") and found["variant"][3] == 3
    assert found["anagram"][3] == 0 and found[long_word + "x"][0] == long_word


def test_no_words(spark):
    empty = spark.createDataFrame([], "word string")
    assert spelling.variants(empty).collect() == []
    assert spelling.variants(spark.createDataFrame([("short",)], "word string")).collect() == []


def test_boxes_lose_no_neighbour():
    random = np.random.default_rng(5)
    words = ["".join(random.choice(list("abcdef"), random.integers(3, 7))) for _ in range(500)]
    v = spelling.points(words)
    tree = spelling.Tree.fit(v[:300], 8)
    own_rows, own = tree.reach(v, 0)
    assert sorted(own_rows) == list(range(len(words)))  # everyone lies in one cell
    cell = dict(zip(own_rows.tolist(), own.tolist(), strict=True))
    visits = set(zip(*(x.tolist() for x in tree.reach(v, 2)), strict=True))
    for x in range(len(words)):
        for y in range(len(words)):
            same = len(words[x]) == len(words[y])
            if same and np.abs(v[x, 1:].astype(int) - v[y, 1:]).sum() <= 2:
                assert (x, cell[y]) in visits


def test_points_of_long_words_stay_near():
    words = ["a" * n for n in (1, 7, 8, 9, 64, 65, 66, 16_383, 16_384, 16_385, 40_000)]
    v = spelling.points(words)
    longer = spelling.one_longer(v)
    for x, y in zip(range(len(words)), range(1, len(words)), strict=False):
        if len(words[y]) - len(words[x]) == 1:
            assert longer[x, 0] == v[y, 0] and np.abs(v[x, 1:] - v[y, 1:]).sum() <= 1


def test_letters_are_compared_like_one_by_one():
    random = np.random.default_rng(9)
    words = ["".join(random.choice(list("abé"), random.integers(1, 7))) for _ in range(300)] + ["a" * 70, "a" * 71]
    letters = spelling.Letters(words)
    x, y = (a.ravel() for a in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    found = letters.one_edit(x, y)
    assert found.tolist() == [spelling.one_edit(words[i], words[j]) for i, j in zip(x, y, strict=True)]
