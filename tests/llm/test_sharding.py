from collections import Counter

from pyspark.sql import functions as F

from episcope.llm.sharding import interleave


def _shards(df):
    return [r.asDict() for r in df.collect()]


def test_counts_slots_and_mixture(make_docs):
    rows = [(i, "x", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(701)] + [(1000 + i, "y", f"tiny{i}") for i in range(60)]
    out = _shards(interleave(make_docs(rows), shards=8))
    assert sorted(r["doc_id"] for r in out) == sorted(r[0] for r in rows)
    sizes = Counter(r["shard"] for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(8))
    for s in sizes:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sizes[s]))
    for source in {r[2] for r in rows}:
        per = Counter(r["shard"] for r in out if r["source"] == source)
        total = sum(per.values())
        assert all(abs(per[s] - total * sizes[s] / len(rows)) <= 2 for s in sizes)
    tiny = Counter(r["shard"] for r in out if r["source"].startswith("tiny"))
    assert max(tiny.values()) <= 30          # one-row sources do not pile up in one shard


def test_same_result_for_any_partitioning(make_docs):
    rows = [(i, "x", f"s{i % 4}") for i in range(200)]
    a = {(r["doc_id"], r["shard"], r["slot"]) for r in _shards(interleave(make_docs(rows, 1), shards=7))}
    b = {(r["doc_id"], r["shard"], r["slot"]) for r in _shards(interleave(make_docs(rows, 5), shards=7))}
    assert a == b


def test_nulls_repeats_extra_columns_and_empty(make_docs):
    docs = make_docs([(None, None, None), (1, "", None), (1, "", None), (2, "a", "s"), (3, "b" * 50_000, "s")]) \
        .withColumn("shard", F.lit("old")).withColumn("extra", F.array(F.lit(1)))
    out = _shards(interleave(docs, shards=3))
    assert len(out) == 5 and all(isinstance(r["shard"], int) and r["extra"] == [1] for r in out)
    assert interleave(make_docs([]), shards=3).count() == 0
    assert len({r["shard"] for r in _shards(interleave(make_docs([(1, "a"), (2, "b")]), shards=40))}) == 2
