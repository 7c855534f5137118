"""Toxicity by multiple-instance learning.

A document is a bag of sentences; only the document's label is known.  A sentence's score is
a logistic model over its words' hashed features (the word and its beginnings); a document's score is the noisy-or ``1 - prod(1 - p)`` of its sentences.  The model
is trained from document labels through the noisy-or, and afterwards points at the sentences
that carry a document's score.

Training reads a bounded sample of the labelled rows it is given: at most ``per_class`` rows
of each class (those with the smallest hash of their id), of at most ``max_chars`` characters.
Scoring reads every whole text.  A null or empty text is one empty sentence; rows without a
label do not train; repeated rows score alike; without rows of both classes the score is the
share of label 1 (0 without labels).  Extra columns are carried unless they clash with the
output's names (score, sentences).
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episcope.llm.common import lean, small_batches

BITS = 18
SENTENCES = "array<struct<start:int,end:int,score:double>>"
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """Hashed features of a lower-case word; whole word and beginnings are marked apart."""
    grams = ["=" + word, *("^" + word[:n] for n in (3, 4, 5) if len(word) > n)]
    return [crc32(g.encode()) & ((1 << BITS) - 1) for g in grams]


def split_sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, words) of the sentences that have words; one empty sentence if none has."""
    out = []
    for m in _SENTENCE.finditer(text):
        words = _WORD.findall(m[0].lower())
        if words:
            out.append((m.start(), m.end(), words))
    return out or [(0, 0, [])]


class NoisyOr:
    """Word weights, a sentence bias and a floor for the document score."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self._cache = weights.astype(np.float32), float(bias), {}

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "_cache": {}}

    def _word(self, word: str) -> float:
        got = self._cache.get(word)
        if got is None:
            got = float(self.weights[word_features(word)].sum())
            if len(self._cache) >= 250_000:
                self._cache.clear()
            self._cache[word] = got
        return got

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, logit) of each sentence."""
        word = self._word
        return [(s, e, self.bias + sum(map(word, set(words)))) for s, e, words in split_sentences(text)]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def fit(texts: list[str], labels: list[int], base_rate: float, steps: int = 200, rate: float = 0.2,
        lasso: float = 1e-4, least_docs: int = 4) -> NoisyOr:
    """Gradient descent (Adam, with a lasso step) on the weighted log-loss of the noisy-or of
    document labels.  ``base_rate``: share of label 1 among all training labels, which the class
    weights restore.  Features of fewer than ``least_docs`` distinct texts are left out."""
    seen: dict[str, int] = {}
    for t, l in zip(texts, labels):
        seen.setdefault(t, l)
    texts, labels = list(seen), list(seen.values())
    words: dict[str, int] = {}
    word_at, sent_at, sent_doc = [], [], []
    for d, text in enumerate(texts):
        for _, _, ws in split_sentences(text):
            s = len(sent_doc)
            sent_doc.append(d)
            for w in set(ws):
                word_at.append(words.setdefault(w, len(words)))
                sent_at.append(s)
    word_at, sent_at = np.array(word_at, dtype=np.int32), np.array(sent_at, dtype=np.int32)
    sent_doc = np.array(sent_doc, dtype=np.int32)
    feats = [word_features(w) for w in words]
    f_word = np.repeat(np.arange(len(feats), dtype=np.int32), [len(f) for f in feats])
    f_at = np.array([x for f in feats for x in f], dtype=np.int32)
    doc_word = np.unique(sent_doc[sent_at].astype(np.int64) * max(len(words), 1) + word_at)
    docs_of = np.bincount((doc_word % max(len(words), 1)).astype(np.int64), minlength=len(words))
    enough = np.bincount(f_at, docs_of[f_word], minlength=1 << BITS)[f_at] >= least_docs
    f_word, f_at = f_word[enough], f_at[enough]
    used, f_at = np.unique(f_at, return_inverse=True)
    y = np.array(labels, dtype=np.float64)
    n_words, n_sents, n_docs, n_used = len(words), len(sent_doc), len(y), len(used)
    weight = np.where(y == 1, base_rate / max(y.mean(), 1e-9), (1 - base_rate) / max(1 - y.mean(), 1e-9)) / n_docs

    w, bias = np.zeros(n_used), float(np.log(max(base_rate, 1e-6) * n_docs / n_sents))
    m, v, mb, vb = np.zeros(n_used), np.zeros(n_used), 0.0, 0.0
    for t in range(1, steps + 1):
        by_word = np.bincount(f_word, w[f_at], minlength=n_words) if n_words else np.zeros(0)
        z = bias + (np.bincount(sent_at, by_word[word_at], minlength=n_sents) if n_words else np.zeros(n_sents))
        total = np.bincount(sent_doc, _softplus(z), minlength=n_docs)
        slope = weight * np.where(y == 1, -1.0 / np.expm1(np.clip(total, 1e-12, 500.0)), 1.0)
        g_sent = slope[sent_doc] / (1.0 + np.exp(-z))
        g_word = np.bincount(word_at, g_sent[sent_at], minlength=n_words)
        g = np.bincount(f_at, g_word[f_word], minlength=n_used)
        gb = g_sent.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        step = rate / (np.sqrt(v / c2) + 1e-4)
        w = w - step * (m / c1)
        w = np.sign(w) * np.maximum(np.abs(w) - step * lasso, 0.0)
        bias -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-4)
    weights = np.zeros(1 << BITS)
    weights[used] = w
    return NoisyOr(weights, bias)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          per_class: int = 2500, max_chars: int = 40_000) -> NoisyOr:
    """Model of ``label`` (0/1) fitted on the bounded sample described above."""
    lab = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()) \
        .groupBy(F.col(key).alias("_tx_key")).agg(F.max(F.col(label)).cast("int").alias("_tx_label"))
    sizes = {r["_tx_label"]: r["count"] for r in lab.groupBy("_tx_label").count().collect()}
    rate = sizes.get(1, 0) / max(1, sum(sizes.values()))
    order = [F.xxhash64(F.lit(5), "_tx_key"), F.col("_tx_key")]
    drawn = lab.filter("_tx_label = 1").orderBy(*order).limit(per_class) \
        .unionByName(lab.filter("_tx_label = 0").orderBy(*order).limit(per_class))
    # at most 2 * per_class rows of two numbers: a proven size
    rows = docs.select(F.col(key).alias("_tx_key"), F.col(text).alias("_tx_text")) \
        .join(F.broadcast(drawn), "_tx_key").filter(F.length("_tx_text") <= max_chars) \
        .groupBy("_tx_key", "_tx_label").agg(F.min("_tx_text").alias("_tx_text")).collect()
    rows = sorted((r["_tx_key"], r["_tx_label"], r["_tx_text"]) for r in rows)
    if len({r[1] for r in rows}) < 2:
        return NoisyOr(np.zeros(1 << BITS), float(np.log(max(rate, 1e-9) / max(1 - rate, 1e-9))))
    return fit([r[2] for r in rows], [r[1] for r in rows], rate)


def score(docs: DataFrame, model: NoisyOr, text: str = "text", sentence_floor: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (noisy-or over the whole text) and ``sentences`` (code point
    offsets of the sentences whose own score reaches ``sentence_floor``)."""
    cols = [c for c in docs.columns if c not in ("score", "sentences")]
    kind = T.StructType([*docs.select(*cols).schema.fields, T.StructField("score", T.DoubleType()),
                         T.StructField("sentences", T._parse_datatype_string(SENTENCES))])
    sent = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        for b in small_batches(batches):
            scores, found = [], []
            for t in b.column(b.schema.get_field_index(text)).to_pylist():
                parts = model.sentences(t or "")
                z = np.array([p[2] for p in parts])
                scores.append(float(-np.expm1(-_softplus(z).sum())))
                p = 1.0 / (1.0 + np.exp(-z))
                found.append([{"start": parts[i][0], "end": parts[i][1], "score": float(p[i])}
                              for i in np.flatnonzero(p >= sentence_floor)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64()), pa.array(found, sent)],
                                             names=[*cols, "score", "sentences"])

    return docs.select(*cols).mapInArrow(lean(run), kind)
