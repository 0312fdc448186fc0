"""Cross-tokenizer alignment against plain sets of ends and plain counts of pairs."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from brute import edge_docs

from caseflow.llm import alignment
from caseflow.llm.queries import all_queries, table

tokenizers = pytest.importorskip("public_tokenizers")
PATHS = tokenizers.path(alignment.VOCABULARY_A), tokenizers.path(alignment.VOCABULARY_B)
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    """Ids and end offsets of a text, straight from the two libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])

    def tokens(text):
        whole = " " + text
        upto = np.cumsum([0, *(len(c.encode()) for c in whole)])
        found = a.encode(whole, add_special_tokens=False)
        # Within a character the library's offsets cover all of it: count bytes by the vocabulary.
        sizes = [len(t) for t in found.tokens]
        ends_a = np.cumsum(sizes).tolist()
        assert not ends_a or ends_a[-1] == upto[-1]
        ids_b = b.encode(text)
        pieces = [b.id_to_piece(i) for i in ids_b]
        data = [
            bytes.fromhex(p[3:5]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(ids_b, pieces, strict=True)
        ]
        if not text or b"".join(data) != whole.encode():
            return [], [], [], []
        return found.ids, ends_a, ids_b, np.cumsum([len(d) for d in data]).tolist()

    return tokens


def expected(texts, tokens):
    rows, links = [], []
    for text in texts:
        ids_a, ends_a, ids_b, ends_b = tokens(text or "")
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, mine, low = [], Counter(), (0, 0)
        for cut in cuts:
            upto = ends_a.index(cut, low[0]) + 1, ends_b.index(cut, low[1]) + 1
            a, b = ids_a[low[0] : upto[0]], ids_b[low[1] : upto[1]]
            groups.append((a, b))
            mine.update((x, y) for x in a for y in b)
            low = upto
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        rows.append([len(ids_a), len(ids_b), len(groups), mine.total(), digest])
        links.append(mine)
    counts = Counter(pair for mine in links for pair in mine)
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for row, mine in zip(rows, links, strict=True):
        n_best = sum(n for (a, b), n in mine.items() if counts[a, b] == best[a])
        out.append((*row[:4], n_best, sum(n * counts[p] for p, n in mine.items()), row[4]))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    "one two three",
    None,
    "",
    " ",
    "  two  blanks\n\n\tand lines \r\n",
    "a ▁ that is no space",
    "café 你好 \U0001f600\U0001f1e9\U0001f1ea é   nb",
    "<|endoftext|> <s> </s> <unk> <0x41> are plain",
    " " * 700 + "x" + "=" * 900 + "\n" * 300,
    "ab" * 3_000,
    "one two three",
    "\u0000 zero",
    "x" + " " * 400_000 + "y",  # too much for the faster library
]


@pytest.mark.parametrize("heavy_pairs", [alignment.HEAVY, 50, 0])
def test_odd_texts(spark, plain, heavy_pairs):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id int, text string")
    done = alignment.align_tokenizers(docs, *PATHS, heavy_pairs=heavy_pairs).collect()
    found = {r.row.doc_id: tuple(r[c] for c in COLUMNS) for r in done}
    assert [found[i] for i in range(len(ODD))] == expected(ODD, plain)


def test_query_on_documents(spark, plain):
    rows = table(spark, SF_DIR, "documents").collect()
    query = all_queries()["op12_token_alignment"](spark, SF_DIR)
    assert query.columns == ["doc_id", *COLUMNS]
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in query.collect()}
    assert [found[r.doc_id] for r in rows] == expected([r.text for r in rows], plain)


def test_odd_documents(spark, plain):
    docs = edge_docs(spark)
    rows = alignment.align_tokenizers(docs, *PATHS).collect()
    assert len(rows) == docs.count() and list(rows[0].row.asDict()) == docs.columns
    texts = [r.row.text for r in rows]
    wanted = dict(zip(texts, expected(texts, plain), strict=True))
    assert all(tuple(r[c] for c in COLUMNS) == wanted[r.row.text] for r in rows)
    assert alignment.align_tokenizers(docs.limit(0), *PATHS).collect() == []


def test_cuts_are_all_shared_ends():
    random = np.random.default_rng(1)
    for density in (0.9, 0.5, 0.05, 0.002):
        sizes = random.integers(1, 3_000, 20)
        both = np.cumsum(sizes)
        sides = []
        for _ in range(2):
            inner = np.flatnonzero(random.random(int(both[-1])) < density) + 1
            sides.append(np.union1d(inner, both))
        a, b = sides
        first = np.append(0, np.searchsorted(a, both) + 1)
        cuts = alignment.shared_cuts(a, b, first)
        assert a[cuts].tolist() == np.intersect1d(a, b).tolist()


def test_a_long_stretch_without_a_cut_is_one_leaf():
    a = np.append(np.arange(1, 40_001, 2), 40_002)
    b = np.append(np.arange(2, 40_001, 2), 40_002)
    assert alignment.shared_cuts(a, b, np.array([0, len(a)])).tolist() == [len(a) - 1]
