"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re

import xxhash

CLASHING = [
    "row", "_text", "size", "n_words", "uid", "fingerprint", "spans", "items", "kept", "kinds",
    "_id", "_key", "removed", "_bucket", "_source", "epochs", "rule", "host", "window", "_domain",
]
ROLLING = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def edge_docs(spark, extra=()):
    """Nulls, empty and long texts, ties, repeated rows, and columns with the library's own names."""
    long_text = " ".join(f"w{i * i % 977} {i % 13}" for i in range(6_000))
    rows = [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n ", None),
        (4, ROLLING, "b"),
        (4, ROLLING, "b"),
        (5, ROLLING + " sigma.", "b"),
        (None, ROLLING + " tau", None),
        (None, None, "c"),
        (6, long_text, "a"),
        (7, long_text + " end", "c"),
        (8, "é" * 3 + " x y z " + ROLLING.upper(), "Z"),
        (9, "one", "a"),
        (10, "one two", ""),
        (10, "another text of the same id", "b"),
        *extra,
    ]
    clash = [(*r, "en", len(r[1] or ""), *range(len(CLASHING))) for r in rows]
    names = ["doc_id long", "text string", "source string", "lang string", "n_chars long"]
    return spark.createDataFrame(clash, ", ".join(names + [f"`{c}` long" for c in CLASHING]))


def triples(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


# --- 2: benchmark windows --------------------------------------------------------------------


def item_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def contamination(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = item_words(text)
        for p in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[p : p + size]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for text in docs:
        w, hit, found = item_words(text), set(), set()
        for n in lengths:
            for p in range(len(w) - n + 1):
                owners = windows.get(tuple(w[p : p + n]))
                if owners is not None:
                    hit |= set(range(p, p + n))
                    found |= {str(o) for o in owners if o is not None}
        out.append((len(w), len(hit), sorted(found)))
    return out


# --- 3: SimHash ------------------------------------------------------------------------------


def simhash(text, shingle=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return 0
    grams = [w] if len(w) < shingle else [w[i : i + shingle] for i in range(len(w) - shingle + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(prints, bits=2):
    """Class number of every fingerprint by all pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def components(docs, bits=2):
    """Fingerprint and smallest id of the component for ``(doc_id, text)``."""
    prints = [simhash(text) for _, text in docs]
    roots = classes_of(prints, bits)
    least = {}
    for (own, _), root in zip(docs, roots, strict=True):
        if own is not None:
            least[root] = min(own, least.get(root, own))
    return [(p, least.get(r)) for p, r in zip(prints, roots, strict=True)]


# --- 4: substrings ---------------------------------------------------------------------------


def kept_words(docs, size=13):
    first = {}
    for own, text in docs:
        w = words(text)
        for p in range(len(w) - size + 1):
            if own is not None:
                gram = tuple(w[p : p + size])
                first[gram] = min(own, first.get(gram, own))
    out = []
    for own, text in docs:
        w, gone = words(text), set()
        for p in range(len(w) - size + 1):
            if own is not None and first[tuple(w[p : p + size])] < own:
                gone |= set(range(p, p + size))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


# --- 7: quality ------------------------------------------------------------------------------


def measures(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 200 else None
    if twice is None:
        seen, twice = set(), set()
        for g in grams:
            (twice if g in seen else seen).add(g)
    covered = {i + j for i, g in enumerate(grams) if g in twice for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(lines), len(covered)


# --- 1: mixing -------------------------------------------------------------------------------


def mix_targets(sizes, weights=(5, 2, 1), most=3):
    """Targets by repeated resharing; ``sizes`` by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        held = sum(most * sizes[s] for s in capped)
        rest = sum(weight[s] for s in order if s not in capped)
        share = (total - held) / rest if rest else 0
        more = {s for s in order if s not in capped and weight[s] * share > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in capped else weight[s] * share for s in order}
        capped |= more


def mix_taken(docs):
    """``(size, target, taken)`` of ``(doc_id, text, source)`` rows; ids are distinct."""
    sizes, rows = {}, []
    for own, text, source in docs:
        digest = hashlib.md5(f"mix:{'null' if own is None else own}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 0.5) / (1 << 52)
        clean = 1.0 if text is None else sum(c not in "#*$%&|<>" for c in text) / max(1, len(text))
        rows.append((len(words(text)), -math.log(u) / max(clean, 0.05)))
        sizes[source] = sizes.get(source, 0) + rows[-1][0]
    targets = mix_targets(sizes)
    out = [None] * len(docs)
    for source in sizes:
        mine = sorted((i for i, d in enumerate(docs) if d[2] == source), key=lambda i: rows[i][1])
        epochs = int(targets[source] // sizes[source]) if sizes[source] else 0
        left, prefix = targets[source] - epochs * sizes[source], 0
        for i in mine:
            size = rows[i][0]
            extra = size > 0 and prefix + size / 2 <= left
            prefix += size
            out[i] = (size, targets[source], size * (epochs + extra))
    return out
