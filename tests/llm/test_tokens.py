import random

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from episcope.llm import common, packing, token_index
from episcope.llm.common import Encoder, shared_path

TEXTS = [(1, "Hello world, it's 2024.\n\nNew  line"), (2, None), (3, ""), (4, "a" * 5000), (5, "word " * 3000), (7, "naïve — 東京 😀 <|endoftext|> x"),
         (7, "repeated id"), (7, "repeated id"), (-3, "minus")]


def _ids(tok, text, end):
    return tok.encode(text or "", add_special_tokens=False).ids + [end]


def test_encoder_equals_the_library(tokenizer):
    tok, enc = Tokenizer.from_file(tokenizer), Encoder(tokenizer, cache_chunks=50)
    rng = random.Random(3)
    alphabet = list("ab Z9'\n\t\r\x0b\x1c\x1f\x85\xa0  　é中😀.,!?;:_") + ["<|endoftext|>", "'s", "  ", "\x00", "ñ", "ﬁ"]
    for _ in range(4000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(enc.encode(s, 2), "<u4").tolist() == _ids(tok, s, 2), repr(s)


def test_shards_and_index_round_trip(spark, make_docs, tokenizer):
    tok, folder = Tokenizer.from_file(tokenizer), shared_path(spark, "tok-test")
    docs = make_docs(TEXTS + [(1000 + i, f"text number {i} " * (i % 9)) for i in range(300)])
    shards = token_index.write_shards(docs, folder, tokenizer, 2)
    index = token_index.build_index(shards, folder, 5)
    assert index.agg(F.sum("keys")).first()[0] == docs.count()
    got = token_index.lookup(token_index.all_keys(docs), folder, 5, copy="copy").collect()
    rows = sorted((r["doc_id"], r["copy"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in got)
    start, want = 0, []
    from collections import Counter
    copies = Counter()
    for k, t in sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda x: (x[0], x[1] or "")):
        ids = np.array(_ids(tok, t, 2), dtype="<u4")
        want.append((k, copies[k], start, len(ids), ids.tobytes()))
        copies[k] += 1
        start += len(ids)
    assert rows == sorted(want)
    foreign = spark.createDataFrame([(999_999,), (None,)], "doc_id long")
    assert token_index.lookup(foreign, folder, 5).count() == 0


def test_ids_are_dealt_out_not_texts(make_docs, tokenizer):
    tok = Tokenizer.from_file(tokenizer)
    got = token_index.encoded(make_docs(TEXTS + [(None, "b"), (None, "a")]), tokenizer, 2, wide=False).collect()
    want = sorted((k or 0, np.array(_ids(tok, t, 2), dtype="<u2").tobytes(), t if k in (7, None) else None) for k, t in [*TEXTS, (None, "b"), (None, "a")])
    assert sorted((r["key"] or 0, bytes(r["ids"]), r["tie"]) for r in got) == want
    common.encoder(tokenizer)
    common.forget_encoders()
    assert not common._ENCODERS


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 70, 5000):
        h = np.unique(np.random.default_rng(n).integers(0, 2 ** 63, size=n, dtype=np.uint64))
        mph = token_index.PerfectHash.build(h)
        assert sorted(mph.slots(h).tolist()) == list(range(len(h)))


def test_null_key_and_empty_table(spark, make_docs, tokenizer):
    folder = shared_path(spark, "tok-test")
    docs = make_docs([(None, "x"), (3, "y")])
    shards = token_index.write_shards(docs, folder, tokenizer, 2)
    token_index.build_index(shards, folder, 2)
    got = token_index.lookup(token_index.all_keys(docs), folder, 2, copy="copy").collect()
    assert sorted((r["doc_id"] or 0, r["start"]) for r in got) == [(0, 0), (3, 2)]
    folder = shared_path(spark, "tok-test")
    empty = token_index.write_shards(make_docs([]), folder, tokenizer, 2)
    token_index.build_index(empty, folder, 2)
    assert token_index.lookup(token_index.all_keys(make_docs([])), folder, 2, copy="copy").count() == 0


def test_packing_places_each_id_once(spark, make_docs, tokenizer):
    tok = Tokenizer.from_file(tokenizer)
    rng = random.Random(5)
    rows = [(i, "word " * rng.randint(0, 400)) for i in range(400)] + [(900, None), (901, "x y z " * 4000)]
    docs = make_docs(rows, 5).withColumn("start", F.lit("clash")).withColumn("sequence_id", F.lit(1))
    out = packing.pack_documents(docs, tokenizer, end_id=0, window=256, open_windows=8, merge_parts=2).collect()
    by, seqs = {}, {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append(r)
    assert set(by) == {r[0] for r in rows}
    for k, t in rows:
        want = np.array(_ids(tok, t, 0), dtype="<u4").tobytes()
        pieces = sorted(by[k], key=lambda r: r["start"])
        assert b"".join(bytes(p["ids"]) for p in pieces) == want
        at = 0
        for p in pieces:
            assert (p["start"], p["length"], p["doc_tokens"]) == (at, len(p["ids"]) // 4, len(want) // 4)
            at += p["length"]
    for pieces in seqs.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 256
    used = sum(r["length"] for r in out)
    assert 1 - used / (256 * len(seqs)) < 0.05
    assert packing.pack_documents(make_docs([]), tokenizer).count() == 0
    same = packing.pack_documents(make_docs([(1, "a"), (1, "a"), (None, "b")]), tokenizer)
    assert sorted(r["doc_id"] or 0 for r in same.collect()) == [0, 1, 1]
