import random
import re

from pyspark.sql import functions as F

from episcope.llm import licences, registry
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def _base(text):
    words = _words(text)
    return sorted((i, label) for phrase, label in licences.BASE.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split())


def _terms_by_rules(tokens):
    """Terms of an infix expression by recursive descent (the parser under test works with stacks)."""
    at = 0

    def factor():
        nonlocal at
        if tokens[at] == "(":
            at += 1
            v = either()
            at += 1
            return v
        v = licences.LICENCES[tokens[at]][0]
        at += 1
        if at < len(tokens) and tokens[at] == "with":
            at += 2
            v = min(v, 1)
        return v

    def both():
        nonlocal at
        v = factor()
        while at < len(tokens) and tokens[at] == "and":
            at += 1
            v = max(v, factor())
        return v

    def either():
        nonlocal at
        v = both()
        while at < len(tokens) and tokens[at] == "or":
            at += 1
            v = min(v, both())
        return v
    return licences.TERMS[either()]


def _expression(rng, depth):
    if depth == 0 or rng.random() < 0.3:
        x = rng.choice(list(licences.LICENCES))
        return [x, "with", rng.choice(licences.EXCEPTIONS)] if rng.random() < 0.2 else [x]
    inner = _expression(rng, depth - 1) + [rng.choice(["and", "or"])] + _expression(rng, depth - 1)
    return ["(", *inner, ")"] if rng.random() < 0.5 else inner


def test_registered_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = registry.QUERIES["op12_licences"][0](spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = _base(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (len(_words(texts[r["doc_id"]])), len(base))
        assert (r["first_word"], r["last_word"]) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r["base_labels"] == ",".join(sorted({b[1] for b in base}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_places_of_random_words():
    rng = random.Random(3)
    pieces = ["mit", "MIT", "license", "License", "apache", "general", "public", "GNU", "x", "é", "0"]
    for _ in range(300):
        text = "".join(rng.choice(pieces) + rng.choice([" ", "-", ".\n", "_", "\x7f"]) for _ in range(rng.randrange(40)))
        got = licences.scan_text(text.encode())
        assert [(b["start"], b["label"]) for b in got["base"]] == _base(text) and got["n_words"] == len(_words(text))


def test_expressions_against_recursive_descent():
    rng = random.Random(4)
    for _ in range(300):
        tokens = _expression(rng, 4)
        text = f"// SPDX-License-Identifier: {' '.join(tokens).upper()}\nOR MIT"
        got = licences.scan_text(text.encode())["expressions"]
        assert [(e["expression"], e["terms"], e["kind"]) for e in got] == [(" ".join(tokens), _terms_by_rules(tokens), "tag")]


def test_notices_and_broken_expressions():
    def found(text):
        got = licences.scan_text(text.encode())
        return got["labels"], [e["expression"] for e in got["expressions"]], got["terms"]
    assert found("This work is licensed under the GNU General Public License, version 3.") == (["gpl", "gpl-3.0"], ["gpl-3.0"], "strong copyleft")
    assert found("Licensed under either the MIT license or the Apache License, Version 2.0, at your option") == (
        ["apache", "apache-2.0", "mit"], ["mit or apache-2.0"], "permissive")
    assert found("licensed under GPL-2.0+ WITH Classpath-exception-2.0. and mit") == (
        ["gpl-2.0-or-later"], ["gpl-2.0-or-later with classpath-exception-2.0"], "weak copyleft")
    assert found("SPDX-License-Identifier: (MIT OR Zlib") == ([], [], None)             # never closed
    assert found("SPDX-License-Identifier: MIT OR") == (["mit"], ["mit"], "permissive")  # the longest whole prefix
    assert found("SPDX-License-Identifier: MIT) AND Zlib") == (["mit"], ["mit"], "permissive")
    assert found("SPDX-License-Identifier: MIT WITH Zlib") == (["mit"], ["mit"], "permissive")
    assert found("SPDX-License-Identifier: LicenseRef-own AND MIT") == ([], [], None)
    assert found("the transmit licenses, mit and zlib") == ([], [], None)               # names alone, without a notice


def test_edge_rows(make_docs):
    long = "(" * 50_000 + "mit" + ")" * 50_000
    rows = [(1, None), (2, ""), (3, "-- --"), (4, "word " * 200_000 + "MIT License"), (5, f"licensed under {long}"),
            (6, "licensed under " + "mit or " * 30_000 + "zlib"), (7, "mit license"), (7, "mit license"), (None, "apache license"), (8, "licensed under")]
    docs = make_docs(rows).withColumn("labels", F.lit("clash")).withColumn("Score", F.lit("clash"))
    out = {}
    for r in licences.scan(docs).collect():
        out.setdefault(r["doc_id"], []).append(r)
    assert all((out[i][0]["n_words"], out[i][0]["labels"], out[i][0]["score"]) == (0, [], 0.0) for i in (1, 2, 3))
    assert [tuple(b) for b in out[4][0]["base"]] == [("mit", 200_000)]
    assert out[5][0]["labels"] == ["mit"] and out[6][0]["labels"] == ["mit", "zlib"]
    assert len(out[7]) == 2 and out[7][0] == out[7][1]
    assert out[None][0]["base_labels"] == ["apache"] and out[8][0]["expressions"] == []
    assert licences.scan(make_docs([])).count() == 0
