"""Every registered query agrees with its SQL or a plain version; the pipeline with plain stages."""

import pytest
from brute import (
    classes_of,
    components,
    contamination,
    edge_docs,
    measures,
    simhash,
    words,
)
from oracle import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from caseflow.llm import decontaminate, pii, tokens
from caseflow.llm.oracles import ORACLES
from caseflow.llm.queries import all_queries, table
from caseflow.session import materialise

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    assert difference(all_queries()[name](spark, SF_DIR), con, ORACLES[name]) is None


def documents(spark):
    rows = table(spark, SF_DIR, "documents").collect()
    return {r.doc_id: r for r in rows}, rows


def test_simhash_query(spark):
    _, rows = documents(spark)
    expected = components([(r.doc_id, r.text) for r in rows])
    found = {r.doc_id: r for r in all_queries()["op3_simhash_groups"](spark, SF_DIR).collect()}
    for r, (mark, component) in zip(rows, expected, strict=True):
        assert found[r.doc_id].fingerprint == f"{mark:016x}"
        assert found[r.doc_id].component_id == component


def test_token_query(spark):
    path = pytest.importorskip("public_tokenizers").path(tokens.VOCABULARY)
    model, (by_id, _) = tokens.tokenizer(path), documents(spark)
    for r in all_queries()["op5_token_counts"](spark, SF_DIR).collect():
        n = len(model.encode(by_id[r.doc_id].text, add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit) == (n, n > 512)


def test_pseudonym_query(spark):
    by_id, rows = documents(spark)
    back = pii.Pseudonyms(pii.EXAMPLE_KEY, backwards=True)
    found = all_queries()["op8_pseudonyms"](spark, SF_DIR).collect()
    assert len(found) == len(rows)
    for r in found:
        assert back.replace(r.text)[0] == by_id[r.doc_id].text
        assert (r.text != by_id[r.doc_id].text) == (r.n_values > 0)


def plain_stages(rows, items):
    """The first four stages on ``(doc_id, text, source)`` rows with distinct ids."""
    kept = []
    for own, text, source in rows:
        n, *_, again = measures(text)
        if n >= 50 and 100 * again <= 50 * n:
            kept.append((own, text, source))
    roots = classes_of([simhash(text) for _, text, _ in kept])
    heads = {}
    for row, root in zip(kept, roots, strict=True):
        heads[root] = min(row, heads.get(root, row))
    out = []
    there = pii.Pseudonyms(pii.EXAMPLE_KEY)
    for own, text, source in sorted(heads.values()):
        ((n, hit, _),) = contamination([text], items)
        if n and n == hit:
            continue
        cleaned = there.replace(remove_hits(text, items))[0]
        out.append((own, cleaned, source))
    return out


def remove_hits(text, items):
    w = [(m.start(), m.end()) for m in decontaminate.ITEM_WORD.finditer(text.encode())]
    block = decontaminate.phrases(items, decontaminate.WINDOW)
    known = {}
    from brute import item_words

    for _, item in items:
        q = item_words(item)
        for p in range(max(1, len(q) - 9) if q else 0):
            known[tuple(q[p : p + 10])] = True
    mine = item_words(text)
    hit = set()
    for n in {len(k) for k in known}:
        for p in range(len(mine) - n + 1):
            if tuple(mine[p : p + n]) in known:
                hit |= set(range(p, p + n))
    assert len(block.windows) == len({len(k) for k in known})
    data, out, at = text.encode(), [], 0
    for i in sorted(hit):
        if i - 1 not in hit:
            out.append(data[at : w[i][0]])
        at = w[i][1]
    return b"".join([*out, data[at:]]).decode()


def test_pipeline(spark):
    _, rows = documents(spark)
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    expected = plain_stages([(r.doc_id, r.text, r.source) for r in rows], items)
    docs = table(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    found = sorted((r.doc_id, r.text, r.source) for r in docs.collect())
    assert found == expected
    mixed = corpus_pipeline.run(spark, SF_DIR).collect()
    texts = {own: text for own, text, _ in expected}
    assert mixed and all(texts[r.doc_id] == r.text for r in mixed)
    assert all(r.mix_size == len(words(r.text)) for r in mixed)
    for source in {r.source for r in mixed}:
        mine = [r for r in mixed if r.source == source]
        largest = max(len(words(t)) for _, t, s in expected if s == source)
        assert abs(sum(r.mix_size for r in mine) - mine[0].mix_target) <= largest / 2


def test_stages_on_odd_documents(spark):
    docs = edge_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
        assert stage(spark, docs.limit(0), SF_DIR).collect() == []
        docs = stage(spark, docs, SF_DIR)
    docs.collect()


def test_all_stages_on_documents_of_an_earlier_run(spark):
    extra = [(100 + i, " ".join(f"w{i}x{j}" for j in range(60 + i)), "big") for i in range(20)]
    marks = {"mix_size": -1, "mix_source_size": -2, "MIX_Target": -3, "mix_epoch": -4, "mix_epoch_2": -5}
    docs = edge_docs(spark, extra).withColumns({name: F.lit(value) for name, value in marks.items()})
    for given in (docs, docs.limit(0)):
        mixed = given
        for name, stage in corpus_pipeline.STAGES:
            mixed = materialise(stage(spark, mixed, SF_DIR), name)
        added = ["mix_size_3", "mix_source_size_3", "mix_target_3", "mix_epoch_3"]
        assert mixed.columns == docs.columns + added
        rows = mixed.collect()
        assert bool(rows) == (given is docs)
        assert all(r[name] == value for r in rows for name, value in marks.items())
        assert all(r.mix_size_3 == len(words(r.text)) and r.mix_epoch_3 > 0 for r in rows)
