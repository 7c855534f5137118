import random

import numpy as np
from pyspark.sql import functions as F

from episcope.llm import decontamination, ngram_join, suffix_dedup
from episcope.llm.components import connected_components
from episcope.llm.suffix_sort import common_prefix, deep_shallow

WORDS = [f"{a}{b}" for a in ("ta", "re", "mi", "so", "lu", "ka", "ne") for b in ("n", "r", "st", "lo", "que", "m", "")]


def _text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def _edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(WORDS)
    return " ".join(w)


def _sets(rows, size):
    out = {}
    for k, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        out[k] = {tuple(w)} if 0 < len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}
    return out


def _brute(rows, size, percent):
    sets = _sets(rows, size)
    comp = {k: k for k in sets}

    def root(k):
        while comp[k] != k:
            k = comp[k]
        return k
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                comp[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in keys}


def _near_rows(seed):
    rng = random.Random(seed)
    rows, k = [], 0
    for n in (1, 2, 3, 5, 12, 30, 60, 150, 400):
        for _ in range(3):
            base = _text(rng, n)
            for e in (0, 0, 1, 2, 3, n // 20, n // 12, n // 8):
                rows.append((k, _edited(rng, base, e) if e else base))
                k += 1
    hot = _text(rng, 70)                         # one large group of near copies, pairwise mixed
    for _ in range(150):
        rows.append((k, _edited(rng, hot, rng.randint(0, 3))))
        k += 1
    rows += [(k, None), (k + 1, ""), (k + 2, " \n\t"), (k + 3, "A  b\tc D"), (k + 4, "a b C d"), (k + 5, _text(rng, 20_000))]
    rng.shuffle(rows)
    ids = rng.sample(range(10_000), len(rows))
    return [(i, t) for i, (_, t) in zip(ids, rows)]


def _components(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_join_equals_brute_force(make_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "PAIR_CHUNK", 16)
    monkeypatch.setattr(ngram_join, "STAR_CHUNK", 8)
    rows = _near_rows(1)
    docs = make_docs(rows).withColumn("component_id", F.lit("clash")).withColumn("key", F.lit(0))
    assert _components(ngram_join.link_components(docs, size=3, percent=90)) == _brute(rows, 3, 90)
    assert _components(ngram_join.link_components(docs, size=5, percent=80)) == _brute(rows, 5, 80)


def test_join_of_unlinked_documents_that_share_a_passage(make_docs, monkeypatch, tmp_path):
    """No task holds more than two chunks of a bucket, and the buckets' members do not all meet."""
    monkeypatch.setattr(ngram_join, "PAIR_CHUNK", 64)
    rng = random.Random(12)
    passage, templates = _text(rng, 24), [_text(rng, 12) for _ in range(7)]
    rows = [(i, f"{passage} {_text(rng, 48)}") for i in range(3000)]
    rows += [(3000 + i, _edited(rng, rows[7 * i][1], 1 + i % 3)) for i in range(200)]
    rows += [(4000 + i, " ".join(rng.sample(templates, 5))) for i in range(300)]      # nothing in these is rare
    rows += rows[:3]
    inner, told = ngram_join._cross_pairs, tmp_path / "rows"
    told.mkdir()

    def counted(percent):
        run, out = inner(percent), str(told)

        def count(pdf):
            import uuid
            with open(f"{out}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(len(pdf)))
            return run(pdf)
        return count

    monkeypatch.setattr(ngram_join, "_cross_pairs", counted)
    assert _components(ngram_join.link_components(make_docs(rows), size=5, percent=80)) == _brute(rows, 5, 80)
    sizes = [int(f.read_text()) for f in told.iterdir()]
    assert sizes and max(sizes) <= 4 * 64        # two chunks dealt by a hash
    assert sum(sizes) < 20 * len(rows)


def test_documents_send_only_the_blocks_that_a_link_needs():
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        for n in (12, 40, 95, 350, 700):
            own = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
            sent = {band: set(buckets.tolist()) for band, buckets, _ in ngram_join._sketches(n, np.unique(own), percent)}
            assert all(len(b) <= 1 + ngram_join.bound(n, n * 100 // percent, percent) for b in sent.values())
            for m in range(n, n * 100 // percent + 1):          # the largest partners, and those that swap shingles
                swapped = (ngram_join.bound(n, m, percent) - (m - n)) // 2
                if (m > n or swapped > 0) and swapped >= 0:
                    other = np.unique(np.concatenate([own[swapped:], rng.integers(0, 2 ** 63, m - n + swapped, dtype=np.uint64)]))
                    if ngram_join._linked(np.unique(own), other, percent):
                        met = {band: set(b.tolist()) for band, b, _ in ngram_join._sketches(len(other), other, percent)}
                        assert any(met.get(band, set()) & b for band, b in sent.items())


def test_pairs_outside_the_bound_cost_no_text(make_docs, monkeypatch):
    rng = random.Random(21)
    passage = _text(rng, 24)
    rows = [(i, f"{passage} {_text(rng, 48)}") for i in range(400)] + [(1000, f"{passage} {_text(rng, 48)}")]
    rows += [(2000 + i, _edited(rng, rows[9 * i][1], 1)) for i in range(30)]
    inner, seen = ngram_join.verified, []

    def counted(pairs, docs, size, percent):
        seen.append(pairs.count())
        return inner(pairs, docs, size, percent)

    monkeypatch.setattr(ngram_join, "verified", counted)
    assert _components(ngram_join.link_components(make_docs(rows), size=5, percent=80)) == _brute(rows, 5, 80)
    assert sum(seen) < 100                       # the passage alone brings 400 pairs


def test_join_edge_rows(make_docs):
    out = ngram_join.link_components(make_docs([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (9, "A b c d")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in out) == [(-1, -1), (5, 5), (5, 5), (9, 5)]
    assert ngram_join.link_components(make_docs([])).count() == 0


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(999, i) for i in range(200, 240)] + [(300, 302), (302, 301), (301, 300)] + [(7, 7)]
    out = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {out[i] for i in range(100, 161)} == {100} and {out[i] for i in [*range(200, 240), 999]} == {200}
    assert {out[i] for i in (300, 301, 302)} == {300} and 7 not in out


def _brute_contaminated(docs, items, size, percent):
    import re
    from collections import Counter

    def words(t):
        return [w for w in re.findall(r"[^\W_]+", (t or "").lower())]
    found = {}
    for d, t in docs:
        w = words(t)
        for i, u in items:
            v = words(u)
            if not v:
                continue
            k = min(size, len(v))
            gi = Counter(tuple(v[p:p + k]) for p in range(len(v) - k + 1))
            gd = [tuple(w[p:p + k]) for p in range(len(w) - k + 1)]
            m = sum(gi.values())
            for s in range(max(1, len(gd) - m + 1)):
                win = Counter(gd[s:s + m])
                both, all_ = sum((gi & win).values()), sum((gi | win).values())
                if win and 100 * both >= percent * all_:
                    found[(d, i)] = max(found.get((d, i), 0), both / all_)
    return found


def test_decontamination_equals_brute_force(spark, make_docs):
    rng = random.Random(4)
    items = [(i, _text(rng, rng.randint(12, 50))) for i in range(25)] + [(100, "tan rer"), (101, ""), (102, None), (103, "min")]
    docs = [(0, _text(rng, 300)), (1, None), (2, ""), (3, _text(rng, 3))]
    for i, t in items[:25]:
        docs.append((10 + i, f"{_text(rng, 40)}. {t.upper()}! {_text(rng, 30)}"))
        docs.append((50 + i, f"{_text(rng, 40)} {_edited(rng, t, 1)} {_text(rng, 5)}"))
        w = t.split()
        docs.append((90 + i, f"{_text(rng, 10)} {' '.join(w[:len(w) // 2] + ['inserted'] + w[len(w) // 2:])} {_text(rng, 9)}"))
        docs.append((130 + i, " ".join(w[:-1])))
        docs.append((170 + i, f"{_text(rng, 12)} {' '.join(w[:len(w) // 2])} {_text(rng, 12)}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.contaminated(make_docs(docs).withColumn("item_id", F.lit(1)), bench).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in out}
    assert len(got) == len(out)
    want = _brute_contaminated(docs, items, 5, 80)
    assert got == want


def test_decontamination_shuffle_join_and_empty(spark, make_docs, monkeypatch):
    rng = random.Random(6)
    items = [(i, _text(rng, 20)) for i in range(4)]
    docs = [(i, f"{_text(rng, 20)} {t} {_text(rng, 9)}") for i, t in items] + [(None, items[0][1]), (9, items[1][1]), (9, items[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def pairs():
        return sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["item_id"]) for r in decontamination.contaminated(make_docs(docs), bench).collect())
    first = pairs()
    assert first == [(-1, 0), (0, 0), (1, 1), (2, 2), (3, 3), (9, 1)]
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    assert pairs() == first
    assert decontamination.contaminated(make_docs([]), bench).count() == 0
    assert decontamination.contaminated(make_docs(docs), bench.limit(0)).count() == 0


def _brute_kept(rows, width):
    seen, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    data = {i: (rows[i][1] or "").encode() for i in order}
    for i in order:
        for s in range(len(data[i]) - width + 1):
            seen.setdefault(data[i][s:s + width], (rows[i][0] is None, rows[i][0] or 0, s))
    for i in order:
        cov = bytearray(len(data[i]))
        for s in range(len(data[i]) - width + 1):
            if seen[data[i][s:s + width]] < (rows[i][0] is None, rows[i][0] or 0, s):
                cov[s:s + width] = b"\1" * width
        out.append((rows[i][0], bytes(a for a, c in zip(data[i], cov) if not c)))
    return sorted(out, key=str)


def test_suffix_dedup_equals_brute_force(make_docs):
    rng = random.Random(8)
    shared = [_text(rng, 12) for _ in range(6)]
    rows = []
    for i in range(220):
        parts = [_text(rng, rng.randint(0, 9))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 10)
            parts += [s[a:a + rng.randint(10, 70)], _text(rng, rng.randint(0, 3))]
        rows.append((i, " ".join(parts)))
    rows += [(500, "ab" * 200), (501, "é" * 150), (502, None), (503, ""), (504, rows[3][1]), (504, rows[3][1]), (505, "x" * 19), (None, rows[5][1]),
             (506, "ab" * 90 + rows[7][1]), (507, rows[9][1] * 3)]
    docs = make_docs(rows, 4).withColumn("spans", F.lit("clash"))
    want = _brute_kept(rows, 20)
    for group_rows in (0, 3, 32):                # all by hash, mixed, mostly by sorting
        out = suffix_dedup.remove_repeats(docs, width=20, gram=6, group_rows=group_rows).collect()
        assert sorted(((r["doc_id"], bytes(r["kept"])) for r in out), key=str) == want
        for r in out:
            spans = [(s["start"], s["stop"]) for s in r["spans"]]
            assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
            assert r["n_bytes"] - sum(b - a for a, b in spans) == len(r["kept"])
    assert suffix_dedup.remove_repeats(make_docs([])).count() == 0


def test_suffix_dedup_long_text_in_chunks(make_docs, monkeypatch):
    rng = random.Random(9)
    base = _text(rng, 30)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    rows = [(1, _text(rng, 40) + base + _text(rng, 40)), (2, base + base), (3, _text(rng, 9) + base[5:])]
    suffix_dedup._POWERS.clear()
    for r, (s, count, *_) in [(r, suffix_dedup.extents(r[1].encode(), 20, 6)) for r in rows]:
        covered = [x for a, n in zip(s, count) for x in range(a, a + n)]
        assert covered == list(range(len(r[1]) - 19))


def test_deep_shallow_sort():
    rng = random.Random(2)
    for _ in range(3000):
        base = bytes(rng.choice(b"ab") for _ in range(30))
        s = [base[:rng.randint(0, 30)] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 8))]
        order, lcp = deep_shallow(s, rng.choice([0, 1, 4, 12]))
        assert [s[i] for i in order] == sorted(s)
        assert lcp == [0] + [common_prefix(s[a], s[b]) for a, b in zip(order, order[1:])]


def test_dedup_tasks_send_bounded_batches(monkeypatch):
    import pyarrow as pa
    from episcope.llm import common, suffix_dedup
    texts = [("%d same passage of some length, " % i * 9).encode() for i in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(30), pa.int64()), pa.array(texts), pa.array([0] * 30, pa.int32())], names=["doc", "data", "tag"])
    whole = pa.Table.from_batches(list(suffix_dedup._find(40, 8)([batch])))
    monkeypatch.setattr(suffix_dedup, "SEND", 16)
    got = list(common.lean(suffix_dedup._find(40, 8))([batch]))
    assert max(b.num_rows for b in got) <= 16 < whole.num_rows and pa.Table.from_batches(got).to_pylist() == whole.to_pylist()
