"""SimHash copies, ranked search and spelling variants against brute force, and on odd input."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from .test_operators import LONG, WORD, documents, frame, low, odd, texts  # noqa: F401


# --- op11 ------------------------------------------------------------------------------


def fingerprint(text, n=3):
    words = WORD.findall(low(text))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, near):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(nodes, 2):
        if near(a, b):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {x: root(x) for x in nodes}


def test_simhash_dedup(spark, documents, texts, odd):  # noqa: F811
    from roistack.llm.simhash_dedup import simhash_components

    prints = {i: fingerprint(t) for i, t in texts.items()}
    groups = components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    rows = simhash_components(documents).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{p:016x}", groups[i]) for i, p in prints.items()}
    assert len(rows) == len(texts) and len(set(groups.values())) < len(texts) - 10

    found = simhash_components(odd).collect()
    assert len(found) == odd.count()
    assert {r.component_id for r in found if r.doc_id in (0, 1, 2)} == {0} and {r.fingerprint for r in found if r.doc_id in (0, 1, 2)} == {"0" * 16}
    assert all(r.component_id in (6, 7) and r.fingerprint == f"{fingerprint('one two three four five six'):016x}" for r in found if r.doc_id in (6, 7, None))
    assert [r.fingerprint for r in found if r.doc_id == 4] == [f"{fingerprint(LONG):016x}"]
    assert simhash_components(odd.limit(0)).count() == 0
    assert [r.component_id for r in simhash_components(odd.where("doc_id is null")).collect()] == [None]


@pytest.mark.parametrize("chunk", [2048, 3])
def test_fingerprints_within_the_radius(spark, chunk, monkeypatch):
    """Planted distances of 0 to 4 bits, chains, and a crowd about one fingerprint; tiles whole and cut into chunks."""
    from roistack.llm import simhash_dedup as S
    from roistack.llm.graph import connected_components

    monkeypatch.setattr(S, "HOMES", chunk)
    monkeypatch.setattr(S, "VISITORS", chunk)
    rng = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        at = rng.getrandbits(64)
        prints.add(at)
        for _ in range(4):
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            prints.add(at)
    crowd = rng.getrandbits(64)
    prints |= {crowd ^ 1 << a ^ 1 << b for a in range(0, 64, 3) for b in range(1, 64, 5)}
    signed = {int(np.uint64(p).astype(np.int64)): p for p in prints}
    edges = S.links(spark.createDataFrame([(s,) for s in signed], "print long"), 2).collect()
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = components(sorted(signed), lambda a, b: (signed[a] ^ signed[b]).bit_count() <= 2)
    assert {s: found.get(s, s) for s in signed} == expected


def test_forest_connects_what_the_links_do():
    from roistack.llm.simhash_dedup import forest

    rng = np.random.default_rng(3)
    for n, m, share in ((5, 7, 0.9), (40, 30, 0.1), (40, 30, 0.02), (1, 50, 1.0)):
        a, b = np.nonzero(rng.random((n, m)) < share)
        x, y = forest(a, b, n, m)
        assert len(x) <= n + m
        one = components(list(range(n + m)), lambda p, q, s=set(zip(a.tolist(), (b + n).tolist(), strict=True)): (p, q) in s)
        two = components(list(range(n + m)), lambda p, q, s={tuple(sorted(z)) for z in zip(x.tolist(), y.tolist(), strict=True)}: (p, q) in s)
        assert one == two


# --- op12 ------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k=10):
    """docs: id (None last) and text of each row."""
    bags = [(i, Counter(TERM.findall(low(t)))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked, scores = Counter(TERM.findall(low(text))), []
        for (i, bag), size in zip(bags, sizes, strict=True):
            score = 0
            for t, times in asked.items():
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += times * w * (10**9 * bag[t] // (1000 * bag[t] + 8 * (25 + 75 * size * n // total)))
            if score:
                scores.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return sorted(out, key=str)


def test_lexical_search(spark, documents, texts, odd):  # noqa: F811
    from roistack.llm.lexical_search import rank_documents

    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    got = sorted(map(tuple, rank_documents(documents, benchmark).collect()), key=str)
    assert got == ranked(list(texts.items()), items)

    asked = spark.createDataFrame([(1, "MIT lorem license, É é!", 0), (2, None, 0), (3, "", 0), (4, "five six six", 0), (4, "five six six", 0), (None, "nowhere", 0)], "item_id long, text string, doc_id int")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted(map(tuple, rank_documents(odd, asked).collect()), key=str)
    assert got == ranked(rows, [(1, "MIT lorem license, É é!"), (4, "five six six")]) and len(got) > 4
    assert rank_documents(odd.limit(0), asked).count() == 0 and rank_documents(odd, asked.limit(0)).count() == 0


def test_search_in_a_block(monkeypatch):
    """Splits, small intervals, ties and pruning against sums over all documents."""
    from roistack.llm import lexical_search as S

    rng = np.random.default_rng(9)
    for leaf in (1, 4, 128):
        monkeypatch.setattr(S, "LEAF", leaf)
        for n_docs in (1, 7, 300):
            tf = (rng.random((6, n_docs)) < np.array([[0.02], [0.2], [0.5], [0.9], [0.05], [1.0]])) * rng.integers(1, 4, (6, n_docs))
            tf[:, n_docs // 2 :] = tf[:, : n_docs - n_docs // 2]  # ties
            terms = [t for t in range(6) if tf[t].any()]
            lists = [np.flatnonzero(tf[t]) for t in terms]
            row = {
                "ids": np.arange(n_docs).tobytes(), "known": np.ones(n_docs, bool).tobytes(), "sizes": np.full(n_docs, 9).tobytes(), "terms": np.array(terms, np.uint64).tobytes(),
                "first": np.cumsum([0, *map(len, lists)]).tobytes(), "docs": np.concatenate(lists).astype(np.int32).tobytes(), "tf": np.concatenate([tf[t][x] for t, x in zip(terms, lists, strict=True)]).tobytes(),
            }
            weights = np.array([900, 500, 200, 30, 700, 0])
            impact = np.where(tf > 0, 10**9 * tf // (1000 * tf + 8 * 100), 0)
            scores = (impact * weights[:, None]).sum(axis=0)
            expected = sorted(((int(s), d) for d, s in enumerate(scores) if s), key=lambda x: (-x[0], x[1]))[:10]
            assert S.Block(row, n_docs, 9 * n_docs).best(np.arange(6).astype(np.uint64), weights, 10) == expected


# --- op13 ------------------------------------------------------------------------------

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def vocabulary(docs):
    n = Counter()
    for i, text in docs:
        for run in map(low, RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            run = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            n[run] += len(run) >= 7
    return {w: c for w, c in n.items() if c >= 2}


def forms(n):
    """By what is left of a word without one code point: near words share it at one place, or one is it."""
    left = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            left[w[:i] + w[i + 1 :]].add((w, i))
    near = defaultdict(set)
    for rest, words in left.items():
        for w, i in words:
            near[w] |= {v for v, j in words if v != w and i == j} | ({rest} if rest in n else set())
            if rest in n:
                near[rest].add(w)
    best = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: best[w] for w in best if n[best[w]] >= 10 * n[w]}
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


@pytest.mark.parametrize("tile", [2048, 5])
def test_spelling_variants(spark, documents, texts, odd, tile):  # noqa: F811
    from roistack.llm.spelling_variants import spelling_forms

    rows = spelling_forms(documents, tile=tile).collect()
    expected = forms(vocabulary(texts.items()))
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == expected and len(rows) == len(expected)
    assert sum(v[3] for v in expected.values()) > 100
    found = spelling_forms(odd, tile=tile).collect()
    assert {r.word: r.n for r in found} == vocabulary([(r.doc_id, r.text) for r in odd.collect()])
    assert spelling_forms(odd.limit(0)).count() == 0


def test_words_one_edit_apart(spark):
    """Made-up words: chains of forms, ties, letters beyond ASCII, very long words, runs of one letter."""
    from roistack.llm.spelling_variants import near_words, spelling_forms

    rng = random.Random(2)
    n = {}
    for base in ["abcdefg", "aaaaaaa", "éàçùöñî", "qwertzuiop", "x" * 3000, "".join(rng.choice("ab") for _ in range(900))]:
        for _ in range(60):
            w = base
            for _ in range(rng.randint(0, 2)):
                i, c = rng.randrange(len(w)), rng.choice("abxyé")
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
            if len(w) >= 7:
                n.setdefault(w, rng.choice([2, 3, 30, 30, 400, 5000]))
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    expected = forms(n)
    for tile in (2048, 4):
        got = {r.word: (r.n_near, r.form if r.form_n >= 10 * n[r.word] else None) for r in near_words(words, tile).collect()}
        assert got == {w: (v[3], v[0]) for w, v in expected.items() if v[3]}
    text = " ".join(w for w, c in (("abcdefg", 2), ("abcdefgh", 30), ("abcdefghi", 400)) for _ in range(c))
    docs = frame(spark, [text]).withColumn("word", F.lit(None).cast("string"))
    got = {r.word: r.root for r in spelling_forms(docs, every=2**40).collect()}
    assert got == {w: "abcdefghi" for w in ("abcdefg", "abcdefgh", "abcdefghi")}
