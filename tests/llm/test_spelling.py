import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from episcope.llm import registry, spelling


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def _brute(n, times=10):
    near = {w: [v for v in n if _near(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def _vocabulary(spark, n):
    return spark.createDataFrame(sorted(n.items()), "word string, n long").repartition(3)


def _rows(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def _words(rng, letters, count):
    out = set()
    while len(out) < count:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(7, 10)))
        out.add(w)
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            if len(w) >= 7:
                out.add(w)
    return out


@pytest.mark.parametrize("letters,cell_words,limit", [("abcdeéÀÿ", 10_000, None), ("abc", 20, None), ("ab", 30, 8), ("abcdefghijk", 50, 20)])
def test_variants_equal_brute_force(spark, make_docs, letters, cell_words, limit):
    rng = random.Random(len(letters) * 7 + cell_words)
    n = {w: 10 ** rng.randrange(5) * rng.randint(1, 3) for w in _words(rng, letters, 350)}
    assert _rows(spelling.variants(_vocabulary(spark, n), cell_words=cell_words, limit=limit)) == _brute(n)


def test_words_of_equal_counts_are_cut_by_hash(spark, make_docs):
    """Anagrams lie in one cell whatever the planes; parts of it meet pair by pair."""
    rng = random.Random(9)
    n = {}
    while len(n) < 250:
        w = list("aabbccdd")
        rng.shuffle(w)
        n["".join(w)] = 3
    n |= {w[:7] + "e": 40 for w in list(n)[:60]} | {w + "a": 2 for w in list(n)[:60]}
    assert _rows(spelling.variants(_vocabulary(spark, n), cell_words=16, limit=5)) == _brute(n)


def test_long_chain_of_forms(spark, make_docs):
    word, n = "a" * 40, {}
    for i in range(14):
        n[word[:i] + "b" * (40 - i)] = 10 ** i
    assert _rows(spelling.variants(_vocabulary(spark, n))) == _brute(n)
    assert {r["root"] for r in spelling.variants(_vocabulary(spark, n)).collect()} == {word[:13] + "b" * 27}


def test_upper_tree_parts_evenly():
    rng = np.random.default_rng(2)
    vectors = rng.integers(0, 4, (5000, spelling.LETTERS)).astype(np.int32)
    nodes = spelling.upper_tree(vectors, 16)
    row, cell = spelling.cells_of(nodes, vectors, 0, 0)
    assert sorted(row) == list(range(5000)) and np.bincount(cell).max() < 3 * 5000 / 16
    near = vectors.copy()
    near[:, 3] += 1
    row2, cell2 = spelling.cells_of(nodes, vectors, 1, 0)
    at = dict(zip(*(x.tolist() for x in spelling.cells_of(nodes, near, 0, 0))))
    assert {(r, at[r]) for r in range(5000)} <= set(zip(row2.tolist(), cell2.tolist()))


def test_words_and_deletions_against_brute_force(spark, make_docs):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcXYZéÀ×") for _ in range(rng.randint(5, 12))) for _ in range(60)]
    rows = [(i, "".join(rng.choice(vocabulary) + rng.choice([" ", "'", "1", "\n", "ž"]) for _ in range(40))) for i in range(120)]
    rows += [(1, rows[1][1]), (500, None), (501, ""), (502, "Longword " * 30_000), (503, "z" * 100_000)]
    want = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{i}:{run}".encode())
            word = run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run
            if len(word) >= 7:
                want[word] += 1
    docs = make_docs(rows).withColumn("run", F.lit("clash")).withColumn("word", F.lit("clash")).select("doc_id", "text")
    vocab = spelling.vocabulary(registry.misspelt(spelling.words_of(docs)))
    got = {r["word"]: r["n"] for r in vocab.collect()}
    assert got == {w: n for w, n in want.items() if n >= 2}
    assert _rows(spelling.variants(vocab)) == _brute(got)
    nobody = make_docs([(None, "longword longword"), (None, "longword")])
    assert {r["word"]: r["n"] for r in spelling.vocabulary(registry.misspelt(spelling.words_of(nobody))).collect()} == {"longword": 3}
    empty = spelling.vocabulary(registry.misspelt(spelling.words_of(make_docs([]))))
    assert spelling.variants(empty).count() == 0


def test_one_edit_apart():
    rng = random.Random(8)
    for _ in range(2000):
        a = "".join(rng.choice("ab") for _ in range(7))
        b = "".join(rng.choice("ab") for _ in range(rng.choice([7, 8])))
        x, y = spelling.code_points([a], 7), spelling.code_points([b], len(b))
        got = spelling.one_replaced(x, y) if len(b) == 7 else spelling.one_inserted(x, y)
        assert bool(got[0]) == _near(a, b)
