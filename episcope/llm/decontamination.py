"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact
weighted-shingle verification.  DataFrame functions only.

Texts become lower-case words (runs of letters, marks and digits) and shingles of ``size``
words.  A document's window is as long as a benchmark item; a window that shares no shingle
with any item has similarity 0, so only windows that an equal shingle aligns with an item are
made (start of the shingle in the document less its place in the item, kept inside the
document; a document shorter than the item is one window).  Windows of equal contents are
one content whatever documents they lie in.

* A content's fingerprint is its 64-bit SimHash: each shingle votes on every bit, as often
  as it occurs.
* Fingerprints are cut into ``radius + 1`` blocks.  Two that differ in at most ``radius`` bits
  agree on a block, so the equi-join on (item size, block, value) holds all pairs within the
  radius; the Hamming distance then leaves just those.
* A pair is reported when the weighted Jaccard similarity of its shingles, weighted by how
  often they occur, reaches ``percent``.

Items of fewer words than ``size`` are one shingle of all their words.  Items or documents
without words match nothing; null ids are kept as they are; repeated documents are reported
alike (one row for each id and item); an empty table on either side gives no rows; only the
named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episcope.llm.common import cut

BITS = 64
BROADCAST_ROWS = 1_000_000     # item shingles (32 bytes each) up to which they are broadcast


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _shingles(w: Column, size: int) -> Column:
    """Hash of each run of ``size`` words.  The word array is bound to a lambda variable, so it is
    made once a row and not again at every place."""
    def of(w):
        n = F.size(w)
        at = F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)]))
    return F.get(F.transform(F.array(w), of), F.lit(0))


def _fingerprints(grams: DataFrame, key: list[str], shingle: str) -> DataFrame:
    """(key, fp): SimHash of the rows' shingles, one row for each occurrence."""
    votes = [F.sum(F.shiftrightunsigned(F.col(shingle), b).bitwiseAND(F.lit(1)) * 2 - 1).alias(f"_v{b}") for b in range(BITS)]
    bits = [F.when(F.col(f"_v{b}") > 0, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")) for b in range(BITS)]
    return grams.groupBy(*key).agg(*votes).select(*key, reduce(lambda x, y: x.bitwiseOR(y), bits).alias("fp"))


def _blocks(fp: Column, radius: int) -> Column:
    """The fingerprint's ``radius + 1`` block values, each with its block's number."""
    n = radius + 1
    edges = [i * BITS // n for i in range(n + 1)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, edges[i])
                              .bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1).cast("long")).alias("value")) for i in range(n)])


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text", size: int = 5, percent: int = 80, radius: int = 16) -> DataFrame:
    """(key, item, start_word, similarity): the best window of each document that holds an item
    (highest similarity, then first).  Items are few beside documents, but not bounded: their
    shingles are broadcast only up to BROADCAST_ROWS rows and joined by a shuffle beyond."""
    items = cut(benchmark.select(F.col(item).alias("item"), words(F.col(item_text)).alias("w")).filter(F.size("w") > 0)
                .withColumn("k", F.least(F.size("w"), F.lit(size))).distinct(), "items")
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())      # at most `size` rows
    src = docs.select(F.col(key).alias("doc"), words(F.col(text)).alias("w"))
    found = [_matches(src, items.filter(F.col("k") == k), k, percent, radius) for k in sizes]
    if not found:
        found = [src.select("doc", F.lit(None).cast(benchmark.schema[item].dataType).alias("item"), F.lit(0).alias("start"),
                            F.lit(0.0).alias("similarity")).limit(0)]
    best = reduce(DataFrame.unionByName, found).groupBy("doc", "item") \
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"))).alias("b"))
    return best.select(F.col("doc").alias(key), F.col("item").alias(item), (-F.col("b.s")).alias("start_word"),
                       F.col("b.similarity").alias("similarity"))


def _matches(src: DataFrame, items: DataFrame, k: int, percent: int, radius: int) -> DataFrame:
    grams = cut(items.select("item", F.posexplode(_shingles(F.col("w"), k)).alias("place", "gram"), (F.size("w") - k + 1).alias("m")), "grams")
    # where an item's shingle may start a window: (gram, place, m), without the items
    places = grams.select("gram", "place", "m").distinct()
    rows = src.select("doc", _shingles(F.col("w"), k).alias("g")).select("doc", "g", F.posexplode("g").alias("pos", "gram"))
    start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("place"), F.size("g") - F.col("m")))
    window = F.slice("g", F.col("start") + 1, F.col("m"))
    if grams.count() <= BROADCAST_ROWS:
        # the document's shingles stay beside the exploded row only until the row is matched
        hits = rows.join(F.broadcast(places), "gram").withColumn("start", start).select("doc", "start", "m", window.alias("win"))
    else:
        doc = F.xxhash64("doc", "g")
        at = rows.select(doc.alias("d"), "pos", "gram", F.size("g").alias("len")).join(places, "gram") \
            .select("d", "m", F.greatest(F.lit(0), F.least(F.col("pos") - F.col("place"), F.col("len") - F.col("m"))).alias("start")).distinct()
        whole = src.select("doc", _shingles(F.col("w"), k).alias("g")).withColumn("d2", doc)
        hits = at.join(whole, F.col("d") == F.col("d2")).select("doc", "start", "m", window.alias("win"))
    hits = hits.withColumn("c", F.xxhash64("m", "win"))
    seen = cut(hits.groupBy("doc", "start", "m", "c").agg(F.first("win").alias("win")), "windows")

    contents = seen.groupBy("c", "m").agg(F.first("win").alias("win"))
    win = cut(contents.select("c", "m", F.size("win").alias("len"), F.explode("win").alias("gram")), "contents")
    fps = _fingerprints(win, ["c", "m"], "gram").withColumn("at", F.explode(_blocks(F.col("fp"), radius)))
    item_fps = _fingerprints(grams, ["item", "m"], "gram").withColumn("at", F.explode(_blocks(F.col("fp"), radius)))
    item_fps = item_fps.select("item", F.col("m").alias("m2"), F.col("fp").alias("fp2"), F.col("at").alias("at2"))
    near = fps.join(item_fps, (F.col("m") == F.col("m2")) & (F.col("at.block") == F.col("at2.block")) & (F.col("at.value") == F.col("at2.value"))) \
        .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= radius).select("c", "item").distinct()

    own = win.groupBy("c", "len", "gram").agg(F.count(F.lit(1)).alias("n"))
    theirs = grams.groupBy(F.col("item").alias("item2"), F.col("m").alias("total"), F.col("gram").alias("gram2")).agg(F.count(F.lit(1)).alias("n2"))
    pairs = near.join(own, "c").join(theirs, (F.col("item") == F.col("item2")) & (F.col("gram") == F.col("gram2"))) \
        .groupBy("c", "item", "len", "total").agg(F.sum(F.least("n", "n2")).alias("both")) \
        .withColumn("all", F.col("len") + F.col("total") - F.col("both")) \
        .filter(F.col("both") * 100 >= F.col("all") * percent).select("c", "item", (F.col("both") / F.col("all")).alias("similarity"))
    return seen.select("doc", "start", "c").join(pairs, "c").select("doc", "item", "start", "similarity")
