import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from episcope.llm import ntt, periodic_runs, registry


def _brute(words, least=12):
    """{(start, end): smallest period} straight from the definition."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and j > i:
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return out


def _collapsed(words, runs):
    gone = {i for (s, e), q in runs.items() for i in range(s + q, e)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("n", [4, 64, 128, 2048, 1 << 16])
def test_transform_is_exact(n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(0, ntt.P, (2, n)), rng.integers(0, ntt.P, (2, n))
    assert (ntt.inverse(ntt.forward(a.astype(float))).astype(np.int64) % ntt.P == a).all()
    got = ntt.convolve(a.astype(float), b.astype(float))
    for k in (0, 1, n // 2, n - 1):
        assert got[1][k] == sum(int(a[1][i]) * int(b[1][(k - i) % n]) for i in range(n)) % ntt.P


@pytest.mark.parametrize("least", [12, 1, 2, 5, 20])
def test_scales_cover_every_period_once(least):
    seen = [q for _, first, count in periodic_runs.scales(least, 700) for q in range(first, first + count)]
    assert seen == list(range(1, 701))
    for block, first, count in periodic_runs.scales(least, 700):
        assert all(2 * block - 1 <= max(least - q, q) for q in range(first, first + count))


def test_runs_equal_brute_force(monkeypatch):
    rng = random.Random(11)
    for t in range(400):
        n, letters = rng.randint(0, 140), rng.choice([1, 2, 3, 5, 50])
        words = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.6:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 2))
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)] + [rng.randrange(letters) for _ in range(rng.choice([0, 9]))]
        least = rng.choice([12, 12, 5, 2, 1, 20])
        if t == 200:     # windows in pieces, few rows at a time
            monkeypatch.setattr(ntt, "MOST", 32)
            monkeypatch.setattr(periodic_runs, "CONVOLVED", 64)
        assert periodic_runs.runs_of(np.array(words, dtype=np.int64), least) == _brute(words, least)


def test_sums_that_vanish_modulo_the_prime_give_nothing():
    words = np.arange(40) * 1 + np.repeat([0, ntt.P], 20)      # second half: other numbers, same residues after the shift
    words[20:] = words[:20] + ntt.P
    assert periodic_runs.runs_of(words.astype(np.int64)) == {}


def test_edge_rows(spark, make_docs):
    rng = random.Random(5)
    once = " ".join(f"w{rng.randrange(10**6)}" for _ in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, "a " * 60_000), (5, f"{once} {once}"), (6, "x y z " * 5 + "q"), (6, "x y z " * 5 + "q"), (None, "b c " * 12),
            (7, "p q p q p q p q p q p"), (8, "p q p q p q p q p q p q")]
    docs = make_docs(rows).withColumn("runs", F.lit("clash")).withColumn("Collapsed", F.lit("clash"))
    out = {}
    for r in periodic_runs.find_runs(docs).collect():
        out.setdefault(r["doc_id"], []).append(([tuple(x) for x in r["runs"]], r["collapsed"]))
    assert out[1] == out[2] == out[3] == [([], "")]
    assert out[4] == [([(0, 60_000, 1)], "a")]
    assert out[5] == [([(0, 60_000, 30_000)], once)]
    assert out[6] == [([(0, 15, 3)], "x y z q")] * 2
    assert out[None] == [([(0, 12, 1)], "b c")]
    assert out[7] == [([], "p q p q p q p q p q p")] and out[8] == [([(0, 12, 2)], "p q")]
    assert periodic_runs.find_runs(make_docs([])).count() == 0


def test_tails_and_ties_in_the_registered_shape(spark, make_docs):
    import zlib
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))) for i in range(300)] + [(400, None), (None, "a b")]
    got = {r["doc_id"]: r["text"] for r in registry.with_periodic_tails(make_docs(rows)).collect()}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if j < a else words[a + (j - a) % p] for j, w in enumerate(words)]
        assert (got[i] or "").split() == words
