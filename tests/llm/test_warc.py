import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from episcope.llm import warc
from episcope.llm.common import open_fs, shared_path


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def _round(spark, rows, split=32 << 20, **kw):
    folder = shared_path(spark, "warc-test")
    archives = warc.write_warc(_pages(spark, rows), folder, **kw)
    return archives, folder, [r.asDict() for r in warc.read_warc(archives, split).collect()]


def test_round_trip_with_revisits_over_small_splits(spark, make_docs):
    rows = [(i, f"http://h/{i}", "same page" if i % 3 == 0 else f"<p>{i}</p>" * (i * 40)) for i in range(60)] + [(100, None, None), (101, "http://e/ x\n", "")]
    seen = None
    for split in (64, 1000, 32 << 20):
        archives, folder, out = _round(spark, rows, split)
        by = {r["key"]: r for r in out}
        assert len(out) == len(rows) and archives.agg(F.sum("records")).first()[0] == len(rows)
        first = {}
        for k, _, h in sorted(rows):
            first.setdefault(h or "", k)
        for k, u, h in rows:
            raw = (h or "").encode()
            r = by[k]
            assert r["payload_bytes"] == len(raw)
            assert r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
            if first[h or ""] == k:
                assert r["record_type"] == "response" and bytes(r["payload"]) == raw and r["refers_to"] is None
            else:
                assert r["record_type"] == "revisit" and r["refers_to"] == first[h or ""] and r["payload"] is None
        got = sorted((r["key"], r["record_type"], r["refers_to"] or -1) for r in out)
        assert seen in (None, got)
        seen = got
    assert warc.list_archives(spark, folder).count() == archives.count()
    fs, p = open_fs(archives.first()["path"])
    with fs.open_input_file(p) as f:
        assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\n")


def test_threshold_repeats_null_keys_and_empty(spark, make_docs):
    _, _, out = _round(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], revisit_bytes=3)
    assert sorted((r["key"], r["record_type"]) for r in out) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]
    _, _, out = _round(spark, [(None, "u", "x"), (5, "u", "x"), (5, "u", "x"), (6, "u", "x")])
    assert sorted((r["key"] or 0, r["record_type"]) for r in out) == [(0, "response"), (5, "response"), (5, "response"), (6, "revisit")]
    _, _, out = _round(spark, [])
    assert out == []


def test_payload_that_looks_like_a_record(spark, make_docs):
    inner = warc.encode_record(7, "u", b"inner", None, "2024-01-01T00:00:00Z").decode()
    _, _, out = _round(spark, [(1, "u", inner), (2, "u", "\x1f\u008b\x08" + inner)], split=16)
    assert sorted(r["key"] for r in out) == [1, 2]
