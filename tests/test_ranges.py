"""Files read by byte ranges give what reading them whole gives, for every size of the ranges."""

import csv
import io
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from episcope.sources import files as IO
from episcope.sources import ranges as R

SIZES = [97, 400, 1 << 20]


@pytest.fixture
def sized(spark):
    def by(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield by
    for k in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{k}")


def _csv_rows(seed, n=60):
    rng = random.Random(seed)
    bits = ["a", "bc", '"', '""', "\n", "\n\n", ",", "', ", "é", " ", '",\n"', "x" * 30]
    return [(str(i), "".join(rng.choice(bits) for _ in range(rng.randrange(8))), rng.choice(["", "t", "a,b"])) for i in range(n)]


def _write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(header)
        w.writerows(rows)


def test_quotes_open_and_close():
    for line, out, inside in (("a,b", False, True), ('"a', True, False), ('a"b,c', False, False), ('"a""b",c', False, False), ('a,"b', True, False),
                              ('"', True, False), ('""', False, True), ('"a",""', False, False), ('x"",y', False, True)):
        assert (R.quoted_after(line, False), R.quoted_after(line, True)) == (out, inside), line


@pytest.mark.parametrize("size", SIZES)
def test_csv_equals_the_whole_read(spark, sized, size):
    d = tempfile.mkdtemp(prefix="episcope-csv-")
    rows = _csv_rows(1, 50)
    _write_csv(os.path.join(d, "a.csv"), ["id", "text", "tag"], rows)
    sized(size)
    got = R.read_csv(spark, d, ["id", "text", "tag", "none"])
    if size == 97:
        assert R._pieces(spark, d, "\n").rdd.getNumPartitions() > 8
    want = [tuple(c if c else None for c in r) + (None,) for r in rows]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    whole = spark.read.options(header=True, multiLine=True, escape='"').csv(os.path.join(d, "a.csv"))
    assert sorted(map(tuple, whole.collect()), key=str) == sorted((tuple(r)[:3] for r in got.collect()), key=str)


@pytest.mark.parametrize("size", [60, 1 << 20])
def test_files_with_their_own_headers(spark, sized, size):
    d = tempfile.mkdtemp(prefix="episcope-csv-")
    one, two = _csv_rows(3, 30), _csv_rows(4, 30)
    _write_csv(os.path.join(d, "a.csv"), ["id", "text", "tag"], one)
    _write_csv(os.path.join(d, "b.csv"), ["tag", "extra", "id"], [(t, "e", i) for i, _x, t in two])
    _write_csv(os.path.join(d, "c.csv"), ["id", "text"], [])
    open(os.path.join(d, "d.csv"), "w").close()
    sized(size)
    got = sorted((tuple(r) for r in R.read_csv(spark, d, ["id", "text", "tag"]).collect()), key=str)
    want = [tuple(c or None for c in r) for r in one] + [(i, None, t or None) for i, _x, t in two]
    assert got == sorted(want, key=str)


def test_csv_line_ends_and_open_quotes(spark, sized):
    d = tempfile.mkdtemp(prefix="episcope-csv-")
    with open(os.path.join(d, "a.csv"), "w", newline="") as f:
        f.write('id,text\r\n1,"a\nb"\r\n\r\n2,plain\r\n3,"never closed\n4,x')
    for size in (10, 1 << 20):
        sized(size)
        got = {r["record"] for r in R.csv_records(spark, d).where("not first").collect()}
        assert got == {'1,"a\nb"', "2,plain", '3,"never closed\n4,x'}


def test_read_social_by_ranges(spark, sized):
    d = tempfile.mkdtemp(prefix="episcope-csv-")
    posts = [(str(i), f"line one\nline {i}, \"quoted\"", "2024-01-02 10:00:00", "['a', 'b']") for i in range(40)]
    _write_csv(os.path.join(d, "a.csv"), ["id", "text", "created_at", "symptoms"], posts)
    sized(200)
    got = {r.id: r for r in IO.read_social(spark, d).collect()}
    assert len(got) == 40 and all(got[p[0]].text == p[1] and got[p[0]].symptoms == ["a", "b"] for p in posts)


def _document(seed):
    rng = random.Random(seed)

    def item(i):
        return {"id": i, "t": "".join(rng.choice(["a", ",", "]", "[", "{", "}", '"', "\\", "é", " , ", "\n"]) for _ in range(rng.randrange(9))),
                "deep": [[i, {"x": "],"}], []], "o": {"k": [1, 2]}}
    return {"about": {"a": 1, "list": [1, [2]], "s": "[,]"}, "first": [item(i) for i in range(6)], "none": [], "text": "x, [y", "n": 3,
            "second": [item(i) for i in range(100, 106)], "numbers": [1, 2.5, None, True], "words": ["a, b", "[", " c , "], "last": {"z": []}}


@pytest.mark.parametrize("size,indent", [(97, None), (150, 2), (700, None), (1 << 20, 2)])
def test_json_items_equal_the_document(spark, sized, size, indent):
    d = tempfile.mkdtemp(prefix="episcope-json-")
    docs = [_document(1), _document(2)] if size > 100 else [_document(1)]
    for i, doc in enumerate(docs):
        with open(os.path.join(d, f"{i}.json"), "w", encoding="utf-8") as f:
            json.dump(doc, f, indent=indent, ensure_ascii=False)
    sized(size)
    for key in ("first", "second", "words") if size < 1000 else ("first", "numbers", "none", "about", "missing"):
        got = sorted(json.dumps(json.loads(r["item"])) for r in R.json_items(spark, d, key).collect())
        want = [json.dumps(x) for doc in docs for x in (doc.get(key, []) if key != "about" else [])]
        assert got == sorted(want), key


def test_health_document_by_ranges(spark, sized):
    d = tempfile.mkdtemp(prefix="episcope-json-")
    rows = [{"disease": "flu, a", "cases": i, "note": "x]"} for i in range(60)]
    with open(os.path.join(d, "doc.json"), "w") as f:
        json.dump({"environmental_data": [{"date": "2024-01-01"}], "surveillance_data": rows}, f)
    sized(300)
    got = IO.read_health_document(spark, d, "surveillance_data", IO.SURVEILLANCE_JSON_SCHEMA)
    assert got.agg(F.count(F.lit(1)), F.sum("cases"), F.min("disease")).first() == (60, sum(range(60)), "flu, a")
    assert R._pieces(spark, d, ",").rdd.getNumPartitions() > 5


def test_empty_folders(spark):
    d = tempfile.mkdtemp(prefix="episcope-none-")
    open(os.path.join(d, "a.csv"), "w").close()
    assert R.read_csv(spark, d, ["id"]).count() == 0
    assert R.json_items(spark, d, "x").count() == 0
