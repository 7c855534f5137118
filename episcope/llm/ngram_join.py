"""Near-duplicate components by word-shingle Jaccard similarity: a parity-sketch join.

A document's set of shingles is hashed into a bit sketch: each shingle flips one bit, so the
Hamming distance of two sketches is at most the size of the sets' symmetric difference.  Sets
with Jaccard similarity of at least t differ in at most d = (|A| + |B|) (1 - t) / (1 + t)
shingles.  Sizes are cut into bands; a band's sketches have more than d blocks for its sizes, so
linked documents have a block in which nothing differs (pigeonhole).  The join is on that block:
on the XOR of its shingles' 64-bit hashes, which is equal when the block's shingles are and tells
apart what the block's few parity bits do not.  Blocks without shingles would agree by chance;
as there are more blocks than d + 1, a document with more than d filled blocks leaves its
empty ones out (an untouched block that is filled remains), the rare others keep them.  And of
its filled blocks, only the first d + 1 are needed, d for its own size and that of its largest partner
there: before the first untouched one, which is the same in both documents, at most d others come.
Documents compare in the band of the larger one: each sends its blocks to its own band and, if
a partner may lie there, to the next band.

Equal sets are one class; only its smallest id joins.  Rows that agree on a block form a
bucket, and no bucket is expanded into pairs:

1. every member whose sketch lies within the bound is verified against the bucket's smallest id (a
   star), links are followed to components, and buckets whose members then lie in one component are done;
2. in the rest, members outside the bucket's main component meet the members of other
   components by the sketches' Hamming distance, and only pairs within the bound are verified.
   Buckets of more than PAIR_CHUNK members (documents that share a passage) are not compared as
   such: their members meet again by a second key, their rarest shingles.  Linked sets share
   at least ceil(t n) of either's n shingles, so in any one order of all shingles they share one
   among the first n - ceil(t n) + 1; in order of the number of open documents that have
   them, the shingles of a passage come last.

Groups are compared chunk by chunk, PAIR_CHUNK rows a side, so a task holds two chunks however
large its group is.  A group in which even the rare shingles are common (texts put together
from a few templates) is as many such tasks as it has pairs of chunks.

Verification is exact, on the whole sets of 64-bit shingle hashes.  So no link is lost, and
components are those of all links.

Words are runs of non-space characters (space, tab to carriage return) of the text with A-Z
lower-cased.  Fewer words than a shingle: the whole sequence is the one shingle.  Null, empty
or blank texts have no shingles and link with nothing.  Rows without a key get no component.
Rows that repeat a key are that document again.  An empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episcope.llm.common import cut, keep, lean, mix64, partitions_of, small_batches
from episcope.llm.components import connected_components
from episcope.operators.joins import bounded_broadcast

K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                            0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
STAR_CHUNK = 64      # members that meet one copy of a hot star's centre
PAIR_CHUNK = 256     # rows a side that one task compares at once; larger buckets are split by rare shingles
RATIO = 1.5          # of neighbouring size bands
BAND_BITS = 8        # low bits of a bucket's id: its band


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


WORDS = "words"
_WORDS = keep(WORDS, _WordHash())


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - size + 1)
    width = min(size, len(h))
    s = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        s = mix64(s * K[0] + h[i:i + n] * K[1 + i % 4])
    return np.unique(s)


def bands(upto: int) -> list[int]:
    """First sizes of the bands, as far as ``upto`` needs."""
    out = [1]
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, int(out[-1] * RATIO)))
    return out


def bound(a, b, percent: int):
    """Most shingles in which linked sets of these sizes differ."""
    return (a + b) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=None)
def blocks_for(least: int, most: int) -> int:
    """Blocks of a band: enough that a set of ``least`` shingles, the smallest that joins there, is
    expected to fill more than ``most`` of them by two standard deviations."""
    n = most + 1
    while True:
        empty = (1 - 1 / n) ** least
        spread = n * empty * max(0.0, 1 - (1 + least / n) * empty)
        if n * (1 - empty) - 2 * spread ** 0.5 >= most + 1 or n > 2 * (most + 1):
            return n
        n += max(1, n // 50)


def sketch(shingles: np.ndarray, band: int, least: int, most: int, own: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket ids of the blocks that join, parity bits: 16 a block) for a band whose sets have
    ``least`` shingles or more and, if linked, differ in at most ``most``, this set in at most ``own``."""
    blocks = blocks_for(least, most)
    r = mix64(shingles ^ K[7])
    block = (r % np.uint64(blocks)).astype(np.int64)
    bits = (np.bincount(block * 16 + (r >> np.uint64(60)).astype(np.int64), minlength=16 * blocks) & 1).astype(np.uint8)
    order = np.argsort(block, kind="stable")
    filled, first = np.unique(block[order], return_index=True)
    xors = np.zeros(blocks, dtype=np.uint64)
    xors[filled] = np.bitwise_xor.reduceat(r[order], first)
    at = filled[:own + 1] if len(filled) > own else np.arange(blocks)
    bucket = (mix64(xors[at] + mix64(at.astype(np.uint64) * K[0] + np.uint64(band))) << np.uint64(BAND_BITS)) | np.uint64(band)
    return bucket.view(np.int64), np.packbits(bits, bitorder="little")


def _sketches(n: int, shingles: np.ndarray, percent: int) -> list[tuple[int, np.ndarray, bytes]]:
    """(band, buckets, bits) for the document's own band and, if a larger partner may lie there, the next."""
    if n == 0:
        return []
    edges = bands(int(n * 100 / percent) + 1)
    own = next(i for i in range(len(edges) - 1) if edges[i] <= n < edges[i + 1])
    out = []
    for band in (own, own + 1):
        if band == own or n * 100 // percent >= edges[band]:
            top = (edges[band + 1] if band + 1 < len(edges) else max(edges[band] + 1, int(edges[band] * RATIO))) - 1
            most, differ = bound(top, top, percent), bound(n, min(top, n * 100 // percent), percent)
            if differ > 0:                       # else only equal sets link, which are one class already
                buckets, bits = sketch(shingles, band, max(1, edges[band] * percent // 100), most, differ)
                out.append((band, buckets, bits.tobytes()))
    return out


def _describe(size: int, percent: int):
    def run(batches):
        for b in small_batches(batches):
            rows = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = shingle_set(text, size)
                sums = [int((mix64(s ^ k)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for k in (K[5], K[6])]
                sk = _sketches(len(s), s, percent) if key is not None else []
                rows.append((key, len(s), *sums, [x for _, b, _ in sk for x in b.tolist()],
                             [{"band": x[0], "bits": x[2]} for x in sk]))
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                     pa.list_(pa.struct([("band", pa.int32()), ("bits", pa.binary())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=["key", "n", "h1", "h2", "buckets", "sketches"])
    return run


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _near(percent: int):
    """Of rows (a, b, band, n and bits of both) the pairs whose sketches lie within the bound."""
    def run(batches):
        for batch in small_batches(batches):
            bands_, na, nb = (batch.column(i).to_numpy() for i in (2, 3, 5))
            bits = [batch.column(i).to_pylist() for i in (4, 6)]
            keep = np.zeros(batch.num_rows, dtype=bool)
            for band in np.unique(bands_):
                at = np.flatnonzero(bands_ == band)
                x, y = (np.frombuffer(b"".join([c[i] for i in at]), dtype="<u2").reshape(len(at), -1) for c in bits)
                keep[at] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= bound(na[at], nb[at], percent)
            yield batch.select([0, 1]).filter(pa.array(keep))
    return run


def _within_bound(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) of ``pairs`` (a, b, band) that can link by their sketches: these are a tenth
    of the sets, so what is only alike in a block costs no text."""
    pairs = cut(pairs, "candidates")
    ids = bounded_broadcast(cut(pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).distinct(), "ids"))
    sk = rows.join(ids, F.col("key") == F.col("_id"), "left_semi").select("key", "n", F.explode("sketches").alias("s")) \
        .select("key", "n", F.col("s.band").alias("band"), F.col("s.bits").alias("bits"))
    for side in ("a", "b"):
        of = sk.withColumnsRenamed({c: f"_{c}{side}" for c in sk.columns})
        pairs = pairs.join(of, (F.col(side) == F.col(f"_key{side}")) & (F.col("band") == F.col(f"_band{side}")))
    near = pairs.select("a", "b", "band", "_na", "_bitsa", "_nb", "_bitsb").mapInArrow(lean(_near(percent), keeps=WORDS), "a long, b long")
    return cut(near.distinct(), "pairs", tidy=True)


def _verify(size: int, percent: int):
    """Rows (a, part, b, text), sorted so that the centre's text (b null) comes first in each (a, part)."""
    def run(batches):
        current, centre = None, None
        for batch in small_batches(batches):
            found = []
            for a, part, b, text in zip(*(c.to_pylist() for c in batch.columns)):
                if b is None:
                    current, centre = (a, part), shingle_set(text, size)
                elif current == (a, part) and _linked(centre, shingle_set(text, size), percent):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())],
                                             names=["a", "b"])
    return run


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the stored (a, b) whose sets link.  The whole texts of the documents that occur in pairs
    travel (they compress, hashes don't), the sets are made where a pair meets.  A centre with many
    partners is copied once for every STAR_CHUNK of them."""
    ids = pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).distinct()
    # the texts stay where they are as long as the list of their ids passes the size check
    few = bounded_broadcast(cut(ids, "ids"))
    width = pairs.groupBy(F.col("a").alias("_a")).agg(F.ceil(F.count(F.lit(1)) / STAR_CHUNK).cast("int").alias("parts"))
    centres = width.select(F.col("_a").alias("id"), F.col("_a").alias("a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                           F.lit(None).cast("long").alias("b"))
    members = pairs.join(width, F.col("a") == F.col("_a")) \
        .select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b")
    wanted = cut(centres.unionByName(members), "wanted")
    rows = docs.join(few, docs["key"] == few["_id"], "left_semi").join(wanted, F.col("key") == F.col("id")).select("a", "part", "b", "text") \
        .repartition(partitions_of(docs.sparkSession), "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return cut(rows.mapInArrow(lean(_verify(size, percent), keeps=WORDS), "a long, b long").distinct(), "links", tidy=True)


def _cross_pairs(percent: int):
    """Within one pair of chunks (left: the chunk's own members, right: those they meet): pairs of
    different components whose sketches lie within the bound."""
    def run(pdf):
        out = []
        if len(pdf):
            ids, comp, n = pdf["id"].to_numpy(), pdf["component"].to_numpy(), pdf["n"].to_numpy()
            words = np.frombuffer(b"".join(pdf["bits"]), dtype=np.uint8).reshape(len(pdf), -1).view("<u2")
            left, right = np.flatnonzero(pdf["left"].to_numpy()), np.flatnonzero(pdf["right"].to_numpy())
            for i in left:
                j = right[comp[right] != comp[i]]
                far = np.bitwise_count(words[j] ^ words[i]).sum(axis=1, dtype=np.int64)
                for k in j[far <= bound(n[j], n[i], percent)]:
                    out.append((min(ids[i], ids[k]), max(ids[i], ids[k])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def _chunk_pairs(rest: DataFrame) -> DataFrame:
    """``rest`` (grp, band, id, component, mine) once for each pair of chunks (x, y) of its group
    that the row occurs in.  Members outside the main component are chunks 0 to c - 1, the others
    follow as c to c + d - 1; x < c meets every y >= x, so each pair of members meets once."""
    def chunks(own):
        return F.ceil(F.count(F.when(own, 1)) / PAIR_CHUNK).cast("int")

    counts = rest.groupBy(F.col("grp").alias("_g")).agg(chunks(F.col("mine")).alias("c"), chunks(~F.col("mine")).alias("d"))
    at = F.when(F.col("mine"), F.pmod(F.xxhash64("id"), F.col("c"))).otherwise(F.col("c") + F.pmod(F.xxhash64("id"), F.greatest("d", F.lit(1)))).cast("int")
    # as the left side with each y from its own chunk on, as the right side with each x before it
    meets = F.explode(F.sequence(F.lit(0), F.when(F.col("mine"), F.col("c") + F.col("d")).otherwise(F.col("c")) - 1))
    return rest.join(counts, F.col("grp") == F.col("_g")).withColumn("at", at).withColumn("with", meets) \
        .select("grp", F.least("at", "with").alias("x"), F.greatest("at", "with").alias("y"), "band", "id", "component",
                (F.col("mine") & (F.col("at") <= F.col("with"))).alias("left"), (F.col("at") >= F.col("with")).alias("right"))


def _rare_groups(large: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(grp, band, id, component, mine): members of large open buckets by their rarest shingles."""
    def shingles(batches):
        for b in small_batches(batches, 64):
            sets = [shingle_set(t, size) for t in b.column(1).to_pylist()]
            n = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), n), pa.int64()), pa.array(np.repeat(n, n), pa.int64()),
                                              pa.array(np.concatenate(sets).view(np.int64) if sets else [], pa.int64())], names=["id", "n", "h"])

    of = cut(large.select(F.col("id").alias("_id"), "band", "component").distinct(), "large")
    few = bounded_broadcast(cut(of.select("_id").distinct(), "large-ids"))
    have = docs.join(few, docs["key"] == few["_id"], "left_semi").mapInArrow(lean(shingles, keeps=WORDS), "id long, n long, h long")
    have = cut(have, "shingles", tidy=True)
    # a shingle of one document only comes before all others and needs no group
    common = cut(have.groupBy(F.col("h").alias("_h")).agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "common", tidy=True)
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    rare = have.join(bounded_broadcast(common), F.col("h") == F.col("_h")).groupBy("id", "n") \
        .agg(F.sort_array(F.collect_set(F.struct("df", "h"))).alias("t")) \
        .withColumn("first", (first - (F.col("n") - F.size("t"))).cast("int")).filter("first > 0") \
        .select("id", F.explode(F.slice("t", F.lit(1), F.col("first"))["h"]).alias("h"))
    rare = cut(rare.join(of, F.col("id") == F.col("_id")).select(F.xxhash64("h", "band").alias("grp"), "band", "id", "component"), "rare", tidy=True)
    parts = rare.groupBy("grp", "band", "component").agg(F.count(F.lit(1)).alias("m"))
    state = parts.groupBy(F.col("grp").alias("_g"), F.col("band").alias("_band")) \
        .agg(F.max_by("component", F.struct("m", "component")).alias("main"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    return rare.join(state, (F.col("grp") == F.col("_g")) & (F.col("band") == F.col("_band"))) \
        .select("grp", "band", "id", "component", (F.col("component") != F.col("main")).alias("mine"))


def link_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """(key, n_shingles, component_id): one row per row of ``docs``."""
    src = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows = cut(src.mapInArrow(lean(_describe(size, percent), keeps=WORDS), "key long, n long, h1 long, h2 long, buckets array<long>, sketches array<struct<band:int,bits:binary>>"), "sketches")
    of_set = ["n", "h1", "h2"]
    classes = rows.filter("n > 0").groupBy(*of_set).agg(F.min("key").alias("rep"))

    copies = rows.select("key", *of_set).join(classes.withColumnsRenamed({c: "_" + c for c in of_set}), F.expr("n = _n and h1 = _h1 and h2 = _h2")) \
        .filter("key <> rep").select(F.col("key").alias("_copy")).distinct() \
        .join(classes.select(F.col("rep").alias("_rep")), F.col("_copy") == F.col("_rep"), "left_anti")
    words = rows.select("key", "buckets").join(bounded_broadcast(cut(copies, "copies")), F.col("key") == F.col("_copy"), "left_anti") \
        .select(F.explode("buckets").alias("bucket"), F.col("key").alias("id"))
    # one shuffle: a bucket's least and greatest id beside each member; members alone in their bucket (most) end here.
    # A window spills, so a hot bucket costs its task time and disk, not memory.
    of_bucket = Window.partitionBy("bucket")
    members = cut(words.withColumn("centre", F.min("id").over(of_bucket)).withColumn("_last", F.max("id").over(of_bucket))
                  .filter("_last > centre").drop("_last"), "buckets", tidy=True)

    band = F.col("bucket").bitwiseAND(F.lit((1 << BAND_BITS) - 1)).cast("int")
    pairs = _within_bound(members.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b"), band.alias("band")).distinct(),
                          rows, percent)
    links = verified(pairs, src, size, percent)
    labels = connected_components(links)

    # what the stars left open: buckets with members of several components
    lab = labels.select(F.col("node").alias("_node"), "component")
    known = members.join(lab, F.col("id") == F.col("_node"), "left") \
        .select("bucket", "id", F.coalesce("component", "id").alias("component"))
    parts = known.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("m"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("who"))
    state = parts.groupBy("bucket").agg(F.max_by("component", F.struct("m", "component")).alias("main"), F.count(F.lit(1)).alias("c"),
                                        F.sum("m").alias("m"), F.sum("who").alias("who"))
    # buckets of the same members are compared once; with two members the star has said it all
    open_ = state.filter("c > 1 and m > 2").groupBy("m", "who", "main", band.alias("band")).agg(F.min("bucket").alias("bucket"))
    rest = cut(known.join(open_.select(F.col("bucket").alias("_b"), "main", "band", "m"), F.col("bucket") == F.col("_b"))
               .select(F.col("bucket").alias("grp"), "band", "id", "component", (F.col("component") != F.col("main")).alias("mine"),
                       (F.col("m") > PAIR_CHUNK).alias("large")), "open", tidy=True)
    if not rest.isEmpty():
        large = rest.filter("large")
        rest = rest.filter("not large").drop("large")
        if not large.isEmpty():
            rest = rest.unionByName(cut(_rare_groups(large, src, size, percent), "rare-groups", tidy=True))
        wanted = rest.select(F.col("id").alias("_id"), F.col("band").alias("_band")).distinct()
        sk = rows.select("key", "n", F.explode("sketches").alias("s")).join(wanted, (F.col("key") == F.col("_id")) & (F.col("s.band") == F.col("_band"))) \
            .select("_id", "_band", "n", F.col("s.bits").alias("bits")).dropDuplicates(["_id", "_band"])
        full = _chunk_pairs(rest).join(sk, (F.col("id") == F.col("_id")) & (F.col("band") == F.col("_band"))) \
            .select("grp", "band", "x", "y", "id", "component", "n", "bits", "left", "right")
        more = full.groupBy("grp", "band", "x", "y").applyInPandas(_cross_pairs(percent), "a long, b long").distinct()
        more = more.join(pairs.select(F.least("a", "b").alias("_pa"), F.greatest("a", "b").alias("_pb")),
                         (F.col("a") == F.col("_pa")) & (F.col("b") == F.col("_pb")), "left_anti")
        labels = connected_components(links.union(verified(cut(more, "pairs", tidy=True), src, size, percent)))

    lab = labels.select(F.col("node").alias("_node"), "component")
    named = classes.join(lab, F.col("rep") == F.col("_node"), "left") \
        .select(*[F.col(c).alias("_" + c) for c in of_set], F.coalesce("component", "rep").alias("_component"))
    return rows.select("key", *of_set).join(named, F.expr("n = _n and h1 = _h1 and h2 = _h2"), "left") \
        .select(F.col("key").alias(key), F.col("n").alias("n_shingles"),
                F.when(F.col("key").isNotNull(), F.coalesce("_component", "key")).alias("component_id"))
