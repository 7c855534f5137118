"""Periodic runs of words: every maximal stretch that repeats with some smallest period.

A run of period q (words q apart are identical) and length m >= max(least, 2 q) compares equal
with itself, shifted by q, over m - q >= max(least - q, q) words, so it holds an aligned block
of half that many words whose copy stands q words on.  At dyadic scales (blocks of 4, 8, 16 ...
words, distances 2 L - 1 to 4 L - 2) the blocks are laid over the text, and each is compared
with all places of the window that follows at those distances by one convolution: the sum of
squared differences at distance d is

    sum a(j)^2 + sum w(d + j)^2 - 2 sum a(j) w(d + j)

over dense word numbers, computed exactly modulo a prime (:mod:`episcope.llm.ntt`).  It is
zero where the block occurs again; the words themselves are then compared, so a sum that only
vanishes modulo the prime gives nothing.  Each distance found is a seed: the stretch with that
period is extended to both sides as far as it goes, and is a run if it is long enough.  Of
equal stretches the smallest period stands.

Blocks that hold a word which does not occur again at that distance or beyond cannot match and
are left out before the transform; windows longer than a transform are taken in pieces, so no
length or period is capped.  A task holds the words of some texts (at least one whole text)
and a bounded number of blocks at a time.

Words are runs of other than space and tab to carriage return.  A null, empty or blank text has
no words, no runs and an empty collapsed text; very long texts are processed whole; repeated rows
give equal rows; rows without a key are like others; an empty table gives no rows; other columns
are carried unless named ``runs`` or ``collapsed``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from episcope.llm import ntt
from episcope.llm.common import small_batches

GROUP_WORDS = 100_000        # words of several texts that are compared together
CONVOLVED = 1 << 19          # numbers in the rows of one convolution
RUNS = "array<struct<start:long,length:long,period:long>>"


class _Numbers(dict):
    """Word -> dense number, in order of first occurrence."""

    def __init__(self, first: int):
        super().__init__()
        self.first = first

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.first + len(self)
        return n


def scales(least: int, longest: int):
    """(block length, smallest distance, number of distances) for all periods up to ``longest``.
    The overlap of a run of period q with its shift is max(least - q, q) words; a block of L is
    sure to lie in it if that is 2 L - 1 or more."""
    q = 1
    while q <= longest:
        sure = max(least - q, q)
        block = 1
        while 4 * block - 1 <= sure:
            block *= 2
        last = q
        while last < longest and 2 * block - 1 <= max(least - last - 1, last + 1) < 4 * block - 1:
            last += 1
        yield block, q, last - q + 1
        q = last + 1


def occurrences(codes: np.ndarray, squares: np.ndarray, starts: np.ndarray, block: int, distance: int, lags: int):
    """(start, distance) wherever the block at a start occurs again, as far as the sums of squared
    differences modulo the prime tell.  ``codes`` are padded behind the last window."""
    n = 1
    while n < block + lags - 1:
        n *= 2
    for at in range(0, len(starts), max(1, CONVOLVED // n)):
        s = starts[at:at + max(1, CONVOLVED // n)]
        rows = np.zeros((len(s), n))
        rows[:, (n - np.arange(block)) % n] = codes[s[:, None] + np.arange(block)]      # reversed: a correlation
        windows = np.zeros((len(s), n))
        w = s + distance
        windows[:, :block + lags - 1] = codes[w[:, None] + np.arange(block + lags - 1)]
        cross = ntt.convolve(rows, windows)[:, :lags]
        own = squares[s + block] - squares[s]
        theirs = w[:, None] + np.arange(lags)
        other = squares[theirs + block] - squares[theirs]
        i, lag = np.nonzero((own[:, None] + other - 2 * cross) % ntt.P == 0)
        yield s[i], lag + distance


def _differs(ids: np.ndarray, i: int, d: int) -> int:
    """First place from i on where the word d further is another one (or there is none)."""
    step, end = 32, len(ids) - d
    while i < end:
        j = min(i + step, end)
        off = np.flatnonzero(ids[i:j] != ids[i + d:j + d])
        if len(off):
            return i + int(off[0])
        i, step = j, step * 4
    return end


def _differed(ids: np.ndarray, i: int, d: int) -> int:
    """Place behind the last one before i where the word d further is another one."""
    step = 32
    while i > 0:
        j = max(i - step, 0)
        off = np.flatnonzero(ids[j:i] != ids[j + d:i + d])
        if len(off):
            return j + int(off[-1]) + 1
        i, step = j, step * 4
    return 0


def runs_of(ids: np.ndarray, least: int = 12) -> dict[tuple[int, int], int]:
    """(start, end) -> smallest period, for every run of length max(least, 2 period) or more."""
    found: dict[tuple[int, int], int] = {}
    total = len(ids)
    if total < least:
        return found
    place = np.arange(total)
    last = np.zeros(int(ids.max()) + 1, dtype=np.int64)
    last[ids] = place                                    # of repeated numbers the last assignment stands
    reach = last[ids] - place
    most = ntt.MOST // 4
    for block, distance, lags in scales(least, min(total // 2, int(reach.max()))):
        bad = np.concatenate([[0], np.cumsum(reach < distance)])
        starts = np.arange(0, total - distance - block + 1, block)
        length = min(block, most)                        # of a longer block its head is compared
        starts = starts[bad[starts + length] == bad[starts]]
        if not len(starts):
            continue
        codes = np.concatenate([ids % ntt.P, np.zeros(distance + lags + block, dtype=np.int64)]).astype(np.float64)
        squares = np.concatenate([[0], np.cumsum((codes * codes) % ntt.P)]).astype(np.int64)
        pieces = [(distance + i, min(lags, 2 * length, lags - i)) for i in range(0, lags, 2 * length)]
        seeds = [x for d, m in pieces for x in occurrences(codes, squares, starts, length, d, m)]
        b = np.concatenate([x[0] for x in seeds])
        d = np.concatenate([x[1] for x in seeds])
        keep = b + d + length <= total
        b, d = b[keep], d[keep]
        order = np.argsort(b, kind="stable")
        b, d = b[order], d[order]
        # seeds inside a known run, a multiple of its period apart, only find that run again
        new = np.ones(len(b), dtype=bool)
        for (start, end), q in found.items():
            if end - start >= distance + length:
                lo, hi = np.searchsorted(b, (start, end))
                new[lo:hi] &= (d[lo:hi] % q != 0) | (b[lo:hi] + d[lo:hi] + length > end)
        b, d = b[new], d[new]
        order = np.lexsort((b, d))
        at, upto = -1, -1
        for start, gap in zip(b[order].tolist(), d[order].tolist()):
            if gap == at and start + gap + length <= upto:
                continue                                 # in the stretch just seen
            differs = _differs(ids, start, gap)
            if differs < start + length:
                continue                                 # the sum vanished modulo the prime only
            at, upto = gap, differs + gap
            begin = _differed(ids, start, gap)
            if upto - begin >= max(least, 2 * gap):
                found[begin, upto] = min(gap, found.get((begin, upto), gap))
    return found


def _texts(column: pa.Array):
    """Groups of texts (as lists of words) of GROUP_WORDS words, or one text, and more."""
    group, size = [], 0
    for text in column.cast(pa.binary()).to_pylist():
        words = (text or b"").split()
        group.append(words)
        size += len(words)
        if size >= GROUP_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _group_runs(group: list[list[bytes]], least: int):
    """(runs, collapsed text) of each text of a group.  Texts get separate word numbers, so that
    nothing matches across them."""
    numbers, first = [], 0
    for words in group:
        own = _Numbers(first)
        numbers += map(own.__getitem__, words)
        first += len(own)
    found = runs_of(np.array(numbers, dtype=np.int64), least)
    edges = np.cumsum([0] + [len(w) for w in group])
    of: dict[int, list] = {}
    for (start, end), q in found.items():
        i = int(np.searchsorted(edges, start, side="right")) - 1
        of.setdefault(i, []).append((start - int(edges[i]), end - start, q))
    for i, words in enumerate(group):
        runs = sorted(of.get(i, []))
        if runs:
            dropped = np.zeros(len(words) + 1, dtype=np.int64)
            for s, m, q in runs:
                dropped[s + q] += 1
                dropped[s + m] -= 1
            words = [words[j] for j in np.flatnonzero(np.cumsum(dropped[:-1]) == 0)]
        yield [{"start": s, "length": m, "period": q} for s, m, q in runs], b" ".join(words).decode()


def find_runs(docs: DataFrame, text: str = "text", least: int = 12) -> DataFrame:
    """``docs`` with ``runs`` (start word, length in words, period; by start, then period) and
    ``collapsed``: the text's words joined by one space, without the words that any run holds
    after its first period."""
    cols = [c for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    out_type = T.StructType([*docs.select(*cols).schema.fields,
                             T.StructField("runs", T._parse_datatype_string(RUNS)), T.StructField("collapsed", T.StringType())])
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    at = cols.index(text)

    def run(batches):
        for b in small_batches(batches):
            rows = [r for g in _texts(b.column(at)) for r in _group_runs(g, least)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r[0] for r in rows], runs_type), pa.array([r[1] for r in rows], pa.string())],
                                             names=[*cols, "runs", "collapsed"])

    return docs.select(*cols).mapInArrow(run, out_type)
