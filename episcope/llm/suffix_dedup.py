"""Exact removal of repeated passages: a distributed sparse suffix array.

Removed is each byte covered by a string of ``width`` bytes that also starts earlier (in a
document of a smaller key, or earlier in the same document); strings are judged on the input.

1. Every string of ``width`` bytes is represented by its minimizer, the place of its smallest
   ``gram``-byte hash (leftmost of equals), so equal strings have equal minimizers at equal
   offsets.  Neighbouring strings with one minimizer place form an extent.  Of extents with
   equal bytes only the first can hold first occurrences: the others are removed as a whole,
   first inside each task, then among all tasks.  So a passage that a third of the documents
   share costs a row per task, not one per document.
2. What is left to decide are minimizers with several different extents (passages that begin
   or end there).  Their suffixes from the minimizer on, and their reversed prefixes, are put
   in order by deep-shallow sorting.  Two of them hold an equal string at an offset exactly
   when the common prefixes of both sides reach far enough, which the neighbours' common
   prefixes in the two orders tell.
3. A minimizer with more than ``group_rows`` different extents is not sorted in one task: its
   strings are hashed one by one (128 bits) and the first of equals is found by aggregation.

Keys order documents; a null key counts as the largest (id 2^63 - 1 stands for it meanwhile).
A null text is empty; texts shorter than ``width`` lose nothing.  Rows that repeat a key and
text are one document and lose the same bytes; different texts under one key are not earlier
than each other.  An empty table gives no rows; only the key and text are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.llm.common import cut, lean, mix64, small_batches
from episcope.llm.suffix_sort import deep_shallow

LAST = 2 ** 63 - 1                  # stands for a null key
BASE = 0x9E3779B97F4A7C15           # of the rolling hash, odd
CHUNK = 1 << 20                     # places of a text that are hashed at once
FLUSH = 750_000                     # extents that a task compares among themselves at once
SEND = 65_536                       # rows of an Arrow batch that a task sends back
FOUND = "kind int, mh long, eh long, doc long, tag int, start long, meta int"
NAMES = [c.split()[0] for c in FOUND.split(", ")]
TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
EXTENT, REPEAT, OPEN = 0, 1, 2      # kinds: an extent; a removed run [start, eh); an undecided extent


class _Powers:
    """Powers of the base and of its inverse modulo 2^64."""

    def __init__(self, n: int):
        up, down = np.full(n, BASE, dtype=np.uint64), np.full(n, pow(BASE, -1, 2 ** 64), dtype=np.uint64)
        up[0] = down[0] = 1
        self.up, self.down = np.cumprod(up), np.cumprod(down)


_POWERS: dict[int, _Powers] = {}


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (w - span)], x[w - span:]) if span < w else x


def extents(text: bytes, width: int, gram: int):
    """(start, count, minimizer place, minimizer hash, hash of the extent's bytes) arrays: the
    extent holds the ``count`` strings of ``width`` bytes that start from ``start`` on."""
    out = []
    data = np.frombuffer(text, dtype=np.uint8)
    if CHUNK + width + 1 not in _POWERS:
        _POWERS[CHUNK + width + 1] = _Powers(CHUNK + width + 1)
    pw = _POWERS[CHUNK + width + 1]
    for c in range(0, len(data) - width + 1, CHUNK):
        b = data[c:c + CHUNK + width - 1].astype(np.uint64) + np.uint64(1)
        n = len(b)
        cs = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(b * pw.up[:n], out=cs[1:])
        grams = mix64((cs[gram:] - cs[:-gram]) * pw.down[:n - gram + 1])
        # smallest of the upper 40 bits, then leftmost
        place = _sliding_min((grams & np.uint64(2 ** 64 - 2 ** 24)) | np.arange(len(grams), dtype=np.uint64), width - gram + 1) & np.uint64(2 ** 24 - 1)
        place = place.astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:], [len(place)]]) - 1
        end = last + width
        eh = mix64((cs[end] - cs[first]) * pw.down[first] + (end - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        out.append((first + c, last - first + 1, place[first] + c, grams[place[first]], eh))
    return [np.concatenate(x) for x in zip(*out)] if out else None


def _batch(kind, mh, eh, doc, tag, start, meta) -> pa.RecordBatch:
    n = len(doc)
    cols = [np.full(n, kind, dtype=np.int32), mh.view(np.int64), eh.view(np.int64), doc, tag, start, meta]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, TYPES)], names=NAMES)


def _joined_runs(doc, tag, start, end):
    """Runs that touch or overlap in one document become one (ends do not fall as starts rise)."""
    order = np.lexsort((end, start, tag, doc))
    doc, tag, start, end = doc[order], tag[order], start[order], end[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(doc)]]) - 1 if len(doc) else first
    return doc[first], tag[first], start[first], end[last]


def _classes(mh, eh, doc, tag, start):
    """For rows in the order (mh, eh, doc, start): which are (or tie with) the first of their
    class, which repeat it later, and the class borders."""
    new = np.ones(len(mh), dtype=bool)
    new[1:] = (mh[1:] != mh[:-1]) | (eh[1:] != eh[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(mh)), 0))
    tie = (doc == doc[head]) & (start == start[head])
    same = np.zeros(len(mh), dtype=bool)
    same[1:] = (doc[1:] == doc[:-1]) & (start[1:] == start[:-1]) & (tag[1:] == tag[:-1]) & ~new[1:]
    return tie & ~same, ~tie, new


def _repeats(doc, tag, start, count, width, spread):
    d, t, s, e = _joined_runs(doc, tag, start, start + count - 1 + width)
    mh = mix64(d.view(np.uint64) + np.uint64(1)) if spread else np.zeros(len(d), dtype=np.uint64)
    return _batch(REPEAT, mh, e.astype(np.int64), d, t, s, np.zeros(len(d), dtype=np.int32))


def _find(width: int, gram: int):
    """Task: extents of its documents, one of each class; later copies as removed runs."""
    def flush(parts):
        cols = list(zip(*parts))
        parts.clear()
        for i in range(len(cols)):          # one column at a time: the pieces go as the whole comes
            cols[i] = np.concatenate(cols[i])
        mh, eh, doc, tag, start, meta = cols
        del cols
        order = np.lexsort((tag, start, doc, eh, mh))
        mh, eh, doc, tag, start, meta = (x[order] for x in (mh, eh, doc, tag, start, meta))
        keep, later, _ = _classes(mh, eh, doc, tag, start)
        yield from small_batches([_batch(EXTENT, mh[keep], eh[keep], doc[keep], tag[keep], start[keep], meta[keep])], SEND)
        if later.any():
            yield from small_batches([_repeats(doc[later], tag[later], start[later], (meta[later] >> 10).astype(np.int64), width, True)], SEND)

    def run(batches):
        parts, held = [], 0
        for b in small_batches(batches):
            for doc, text, tag in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if text is None or len(text) < width:
                    continue
                for start, count, place, mh, eh in [extents(text, width, gram)]:
                    parts.append((mh, eh, np.full(len(start), doc, dtype=np.int64), np.full(len(start), tag, dtype=np.int32),
                                  start, ((count << 10) | (place - start)).astype(np.int32)))
                    held += len(start)
                if held >= FLUSH:
                    yield from flush(parts)
                    parts, held = [], 0
        if parts:
            yield from flush(parts)
    return run


def _whole_groups(batches, column: str, least: int):
    """Frames of at least ``least`` rows that do not cut a run of equal ``column`` values."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n < least:
            continue
        t = pa.Table.from_batches(held)
        key = t.column(column).to_numpy()
        at = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        if at:
            yield t.slice(0, at)
            t = t.slice(at)
        held, n = t.to_batches(), t.num_rows
        if not at:
            least *= 2                   # one long group: look again when it has doubled
    if held:
        yield pa.Table.from_batches(held)


def _decide(width: int):
    """Sorted by (mh, eh, doc, start): first of each class over all tasks.  Passes on removed
    runs; extents whose minimizer has another class are undecided, with the class count in eh."""
    def run(batches):
        for t in _whole_groups(batches, "mh", 200_000):
            kind, mh, eh, doc, tag, start, meta = (t.column(c).to_numpy() for c in NAMES)
            known = kind == REPEAT
            if known.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[known], ty) for x, ty in zip((kind, mh, eh, doc, tag, start, meta), TYPES)], names=NAMES)
            mh, eh, doc, tag, start, meta = (x[~known] for x in (mh, eh, doc, tag, start, meta))
            if not len(mh):
                continue
            keep, later, new = _classes(mh, eh, doc, tag, start)
            if later.any():
                yield _repeats(doc[later], tag[later], start[later], (meta[later] >> 10).astype(np.int64), width, False)
            border = np.ones(len(mh), dtype=bool)
            border[1:] = mh[1:] != mh[:-1]
            group = np.cumsum(border) - 1
            classes = np.bincount(group, new)[group].astype(np.int64)
            ask = keep & (classes > 1)
            yield _batch(OPEN, mh[ask], classes[ask], doc[ask], tag[ask], start[ask], meta[ask])
    return run


def covered_offsets(members: list[tuple], width: int) -> list[tuple[int, int, int]]:
    """members: (doc, minimizer place, offset from, offset to, bytes before the minimizer reversed,
    bytes from it on).  (member, from, to): offsets at which a member's string starts earlier elsewhere."""
    g = len(members)
    right, left = [[0] * g for _ in range(g)], [[0] * g for _ in range(g)]
    for side, at in ((right, 5), (left, 4)):
        order, lcp = deep_shallow([m[at] for m in members])
        for i in range(g):
            low = width
            for j in range(i + 1, g):
                low = min(low, lcp[j])
                side[order[i]][order[j]] = side[order[j]][order[i]] = low
    out = []
    rank = sorted(range(g), key=lambda i: members[i][:2])
    for a, i in enumerate(rank):
        runs = []
        for j in rank[:a]:
            if members[j][:2] < members[i][:2]:
                lo = max(members[i][2], members[j][2], width - right[i][j])
                hi = min(members[i][3], members[j][3], left[i][j])
                if lo <= hi:
                    runs.append((lo, hi))
        upto = -1
        for lo, hi in sorted(runs):
            lo = max(lo, upto + 1)
            if lo <= hi:
                out.append((i, lo, hi))
                upto = hi
    return out


def _compare(width: int):
    """Sorted by mh: the undecided extents of each minimizer, by their contexts."""
    def run(batches):
        for t in _whole_groups(batches, "mh", 20_000):
            mh = t.column("mh").to_numpy()
            doc, tag, start, count, off = (t.column(c).to_numpy() for c in ("doc", "tag", "start", "count", "off"))
            ctx = t.column("ctx").to_pylist()
            edges = np.flatnonzero(np.concatenate([[True], mh[1:] != mh[:-1], [True]]))
            found = []
            for a, b in zip(edges[:-1], edges[1:]):
                if b - a > 1:
                    members = [(int(doc[i]), int(start[i] + off[i]), int(off[i] - count[i] + 1), int(off[i]),
                                ctx[i][:off[i]][::-1], ctx[i][off[i]:]) for i in range(a, b)]
                    for m, lo, hi in covered_offsets(members, width):
                        place = members[m][1]
                        found.append((int(doc[a + m]), int(tag[a + m]), place - hi, place - lo + width))
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(list(zip(*found)) or [[]] * 4, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                             names=["doc", "tag", "start", "stop"])
    return run


def repeated_runs(src: DataFrame, width: int, gram: int, group_rows: int) -> DataFrame:
    """(doc, tag, start, stop): runs of bytes to remove, which may overlap.  src: doc, data, tag."""
    found = src.mapInArrow(lean(_find(width, gram)), FOUND)
    decided = cut(found.repartition("mh").sortWithinPartitions("mh", "eh", "doc", "start", "tag").mapInArrow(lean(_decide(width)), FOUND), "extents", tidy=True)
    runs = decided.filter(F.col("kind") == REPEAT).select("doc", "tag", "start", F.col("eh").alias("stop"))

    ask = decided.filter(F.col("kind") == OPEN).select("mh", F.col("eh").alias("classes"), F.col("doc").alias("d"), F.col("tag").alias("t"), "start",
                                                       F.shiftright("meta", 10).alias("count"), F.col("meta").bitwiseAND(F.lit(1023)).alias("off"))
    ctx = src.join(ask, (F.col("doc") == F.col("d")) & (F.col("tag") == F.col("t"))) \
        .select("mh", "classes", "doc", "tag", "start", "count", "off",
                F.expr(f"substring(data, cast(start + 1 as int), count + {width - 1})").alias("ctx"))
    ctx = cut(ctx, "contexts", tidy=True)
    small = ctx.filter(F.col("classes") <= group_rows).drop("classes").repartition("mh").sortWithinPartitions("mh")
    runs = runs.unionByName(small.mapInArrow(lean(_compare(width)), "doc long, tag int, start long, stop long"))

    strings = ctx.filter(F.col("classes") > group_rows) \
        .select("doc", "tag", "start", "ctx", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("i")) \
        .withColumn("s", F.expr(f"substring(ctx, i + 1, {width})")) \
        .select("doc", "tag", (F.col("start") + F.col("i")).alias("start"), F.xxhash64("s").alias("h1"), F.xxhash64(F.lit(1), "s").alias("h2"))
    first = strings.groupBy(F.col("h1").alias("g1"), F.col("h2").alias("g2")) \
        .agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    hot = strings.join(first, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))) \
        .filter(F.struct("doc", "start") > F.col("first")).select("doc", "tag", "start", (F.col("start") + width).alias("stop"))
    return runs.unionByName(hot)


def _apply(batches):
    """(doc, data, runs) -> spans that touch or overlap joined, and the bytes that stay."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.binary()]
    for b in small_batches(batches):
        out = [[], [], [], []]
        for doc, data, runs in zip(*(c.to_pylist() for c in b.columns)):
            spans, kept, at = [], [], 0
            for r in sorted(runs or [], key=lambda r: (r["start"], r["stop"])):
                if spans and r["start"] <= spans[-1]["stop"]:
                    spans[-1]["stop"] = max(spans[-1]["stop"], r["stop"])
                else:
                    spans.append(dict(r))
            for s in spans:
                kept.append(data[at:s["start"]])
                at = s["stop"]
            kept.append(data[at:])
            for col, v in zip(out, (doc, len(data), spans, b"".join(kept))):
                col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["doc", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 100, gram: int = 24,
                   group_rows: int = 32) -> DataFrame:
    """(key, n_bytes, spans, kept): one row per row of ``docs``; spans are the maximal removed
    runs as byte offsets (stop exclusive), kept the remaining bytes."""
    if not 0 < gram <= width or width - gram > 900:
        raise ValueError("gram must lie between 1 and width, at most 900 below it")
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    src = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"), data.alias("data")) \
        .withColumn("tag", F.hash("data"))
    runs = cut(repeated_runs(src, width, gram, group_rows), "runs", tidy=True).groupBy(F.col("doc").alias("d"), F.col("tag").alias("t")) \
        .agg(F.collect_set(F.struct("start", "stop")).alias("runs"))
    whole = src.join(runs, (F.col("doc") == F.col("d")) & (F.col("tag") == F.col("t")), "left").select("doc", "data", "runs")
    return whole.mapInArrow(lean(_apply), "doc long, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept binary") \
        .select(F.when(F.col("doc") != LAST, F.col("doc")).alias(key), "n_bytes", "spans", "kept")
