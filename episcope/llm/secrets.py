"""Secret scan: three base patterns and character Markov models of random strings.

Two first-order Markov models over the characters of candidate tokens are trained: one on
secrets (values that the base patterns matched), one on ordinary identifiers and words (runs
of the same characters that no base match touches).  The transition counts cover every
document; they are one table of at most 2 * 69 * 69 sums whatever the corpus size.  A run of
``min_length`` or more characters outside the base matches is reported as ``markov`` when its
log-likelihood ratio (secret : ordinary) is positive enough in total and per character.

Offsets are code points, end exclusive.  A null text counts as empty; a text without
matches has no spans; repeated rows give equal rows; other columns are carried unless named
``spans``.  Without any training secret the base patterns stand alone.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episcope.llm.common import cut, lean, small_batches

# The base patterns, in the order in which equal starts are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")     # runs are maximal, so 20 characters in all is the same as 16 after AKIA
HEX = re.compile(r"[0-9a-f]{24,}")            # likewise
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
STATES = len(ALPHABET) + 1                    # state 0: start of a token
SPAN = "array<struct<kind:string,start:int,end:int>>"

_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{4,}")
_CODE = np.zeros(256, dtype=np.uint8)
_CODE[np.frombuffer(ALPHABET.encode(), dtype=np.uint8)] = np.arange(1, STATES, dtype=np.uint8)


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind index, end, value start, value end) of the base matches, in order."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _pairs(tokens: list[str]) -> np.ndarray:
    """Transition counts of the tokens, start state included, as one flat vector."""
    raw = np.frombuffer(("\n" + "\n".join(tokens)).encode("ascii"), dtype=np.uint8)
    code = _CODE[raw].astype(np.int32)                # a line feed is state 0
    pair = code[:-1] * STATES + code[1:]
    return np.bincount(pair[code[1:] > 0], minlength=STATES * STATES)


def _count(batches):
    """(label, from, to, n) sums of one task; label 1: secret values, 0: all else."""
    sums = np.zeros((2, STATES * STATES), dtype=np.int64)
    for b in small_batches(batches):
        for text in b.column(0).to_pylist():
            if not text:
                continue
            spans = base_spans(text)
            if spans:
                sums[1] += _pairs([text[s[3]:s[4]] for s in spans])
                parts, at = [], 0
                for s in spans:
                    parts.append(text[at:max(at, s[0])])
                    at = max(at, s[2])
                text = " ".join([*parts, text[at:]])
            tokens = _TOKEN.findall(text)
            if tokens:
                sums[0] += _pairs(tokens)
    label, pair = np.nonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int32)), pa.array(pair.astype(np.int32)),
                                      pa.array(sums[label, pair])], names=["label", "pair", "n"])


def train(docs: DataFrame, text: str = "text", backoff: float = 20.0) -> np.ndarray | None:
    """Log-likelihood ratio of each transition, learned from all documents; None without a
    training secret.  The driver receives at most 2 * 69 * 69 sums.  A transition's share is
    smoothed by ``backoff`` rows of the model's overall character shares."""
    rows = docs.select(text).mapInArrow(lean(_count), "label int, pair int, n long") \
        .groupBy("label", "pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((2, STATES, STATES))
    for r in rows:
        counts[r["label"], r["pair"] // STATES, r["pair"] % STATES] += r["n"]
    if not counts[1].any():
        return None
    overall = counts.sum(axis=1) + 0.5
    overall /= overall[:, 1:].sum(axis=1, keepdims=True)
    share = (counts + backoff * overall[:, None, :]) / (counts.sum(axis=2, keepdims=True) + backoff)
    return np.log(share[1]) - np.log(share[0])


def markov_spans(text: str, spans: list, llr: np.ndarray, min_length: int, min_total: float,
                 min_mean: float) -> list[tuple[int, int, int]]:
    """Runs of token characters outside ``spans`` that look random."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_.=-]{%d,}" % min_length, text):
        if any(s[0] < m.end() and m.start() < s[2] for s in spans):
            continue
        code = _CODE[np.frombuffer(m[0].encode("ascii"), dtype=np.uint8)]
        total = float(llr[0, code[0]] + llr[code[:-1], code[1:]].sum())
        if total >= min_total and total >= min_mean * len(code):
            out.append((m.start(), 3, m.end()))
    return out


def scan(docs: DataFrame, text: str = "text", model: np.ndarray | None = None, min_length: int = 16,
         min_total: float = 12.0, min_mean: float = 0.6) -> DataFrame:
    """``docs`` with ``spans``: all matches as (kind, start, end), by start, then kind."""
    cols = [c for c in docs.columns if c != "spans"]
    out_type = T.StructType([*docs.select(*cols).schema.fields,
                             T.StructField("spans", T._parse_datatype_string(SPAN))])

    def run(batches):
        for b in small_batches(batches):
            found = []
            for t in b.column(b.schema.get_field_index(text)).to_pylist():
                t = t or ""
                spans = base_spans(t)
                marked = [(s[0], s[1], s[2]) for s in spans]
                if model is not None:
                    marked = sorted(marked + markov_spans(t, spans, model, min_length, min_total, min_mean))
                found.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in marked])
            spans_t = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, spans_t)], names=[*cols, "spans"])

    return docs.select(*cols).mapInArrow(lean(run), out_type)


def mask(docs: DataFrame, text: str = "text", spans: str = "spans", mark: str = "[SECRET]") -> DataFrame:
    """Replace each span of ``text`` by ``mark`` (overlapping spans by one) and drop ``spans``.  ``docs`` is written
    first: in one plan with the scan, each task would scan twice and hold two Python workers at once."""
    docs = cut(docs, "scanned")

    @F.pandas_udf("string")
    def masked(t, s):
        import pandas as pd

        def one(x, found):
            if x is None or found is None or len(found) == 0:
                return x
            parts, at = [], 0
            for f in sorted(found, key=lambda f: f["start"]):
                if f["start"] >= at:
                    parts += [x[at:f["start"]], mark]
                at = max(at, f["end"])
            return "".join([*parts, x[at:]])
        return pd.Series([one(x, f) for x, f in zip(t, s)], dtype=object)

    # only texts with spans go to Python
    found = F.size(spans) > 0
    clean, hit = docs.filter(~found), docs.filter(found)
    return clean.drop(spans).unionByName(hit.withColumn(text, masked(F.col(text), F.col(spans))).drop(spans))
