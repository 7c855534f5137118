"""Token-id shards with a minimal perfect hash index.

Files, all in one folder of the shared store:

* ``shard-<n>.tok``: 16 bytes of head (magic, id width), the raw ids of the shard's documents
  one after the other (little-endian unsigned, 16 bits if the vocabulary allows, else 32),
  then the table of contents (key, null flag and id count of each document) and a trailer.
  Shards and the documents in them follow the ascending key (null first, equal keys by text).
* ``index-<n>.mph``: for the keys whose hash falls into bucket n, a minimal perfect hash with
  a fingerprint, the shard, the place in it and the id count at each key's slot.

The hash is built in levels: at each level the remaining keys are thrown into a bit array of
twice their number; keys that are alone set their bit, the others go down a level.  A key's
slot is the rank of its bit, so access takes a constant number of probes, no key is stored,
and a foreign key passes the 32-bit fingerprint with probability 2^-32.  The n-th document of
one key (repeated rows) is the key (key, n).

A null text is empty (the end id alone); an empty table gives no files and no rows; only the
key and text columns are read.  Keys must be spread out: rows of one key stay in one shard.
Tasks write each file under a temporary name and rename it, so a retried task replaces it.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episcope.llm.common import ENCODERS, cut, encoder, lean, mix64, open_fs, partitions_of, small_batches, write_whole
from episcope.operators.joins import bounded_broadcast
from episcope.operators.ordering import range_bucket

MAGIC, HEAD, TRAILER = b"TOKSHRD1", "<8sQ", "<QQ8s"
HEAD_BYTES, TRAILER_BYTES = struct.calcsize(HEAD), struct.calcsize(TRAILER)
INDEX_MAGIC = b"TOKMPHX1"
MANIFEST = "shard int, path string, docs long, ids long, bytes long"
ENTRY = np.dtype([("fp", "<u4"), ("shard", "<i4"), ("at", "<i8"), ("n", "<i8"), ("start", "<i8")])
GAMMA, MAX_LEVELS = 2.0, 60


# ---------------------------------------------------------------- shards

def _shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:06d}.tok"


def encoded(docs: DataFrame, tokenizer: str, end_id: int, wide: bool, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, tie, shard): each document's raw ids, made where it is read, so that ids and not texts are dealt
    out and sorted, by tasks that need no encoder.  ``tie``: the text of rows whose key repeats, else null.
    ``shard`` follows the key, by sampled bounds: a range partitioning would encode everything twice, for its sample."""
    def encode(batches):
        enc = encoder(tokenizer)
        for b in small_batches(batches):
            ids = (enc.encode(t or "", end_id) for t in b.column(1).to_pylist())
            raw = list(ids) if wide else [np.frombuffer(x, dtype="<u4").astype("<u2").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary()), b.column(2), b.column(3)], names=["key", "ids", "tie", "shard"])

    src = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    again = cut(src.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "again")
    tied = src.join(bounded_broadcast(again), F.col("key").eqNullSafe(F.col("_key")), "left") \
        .select("key", "text", F.when(F.col("_n").isNotNull(), F.col("text")).alias("tie"),
                range_bucket(src, "key", partitions_of(docs.sparkSession)).cast("int").alias("shard"))
    return tied.mapInArrow(lean(encode, keeps=ENCODERS), "key long, ids binary, tie string, shard int")


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id",
                 text: str = "text", vocabulary: int | None = None) -> DataFrame:
    """Write the shards; one task makes one shard, their number is the session's shuffle
    partitions.  Ids take 16 bits if ``vocabulary`` (default: from the tokenizer file, its largest id and one)
    and the end id allow, else 32.  Returns the manifest (shard, path, docs, ids, bytes)."""
    if vocabulary is None:
        from tokenizers import Tokenizer
        vocabulary = 1 + max(Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values(), default=0)
    wide = vocabulary > 65_536 or end_id > 65_535
    width = 4 if wide else 2

    def write(batches):
        shard, keys, nulls, counts = TaskContext.get().partitionId(), [], [], []

        def body():
            yield struct.pack(HEAD, MAGIC, width)
            for b in small_batches(batches):
                for k, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    keys.append(k or 0)
                    nulls.append(k is None)
                    counts.append(len(ids) // width)
                    yield ids
            yield np.array(keys, dtype="<i8").tobytes() + np.array(nulls, dtype="u1").tobytes() + np.array(counts, dtype="<i8").tobytes()
            yield struct.pack(TRAILER, len(keys), sum(counts), MAGIC)

        first = next(batches, None)
        if first is None:
            return
        from itertools import chain
        batches = chain([first], batches)
        path = _shard_path(folder, shard)
        size = write_whole(path, body())
        if keys:
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([path]), pa.array([len(keys)], pa.int64()),
                 pa.array([sum(counts)], pa.int64()), pa.array([size], pa.int64())], names=["shard", "path", "docs", "ids", "bytes"])

    coded = encoded(docs, tokenizer, end_id, wide, key, text)
    ordered = coded.repartitionById(partitions_of(docs.sparkSession), F.col("shard")).sortWithinPartitions("key", "tie").select("key", "ids")
    return cut(ordered.mapInArrow(lean(write), MANIFEST), "shards", tidy=True)


def read_contents(f) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(id width, keys, null flags, id counts) of an open shard file."""
    size = f.size()
    docs, _, magic = struct.unpack(TRAILER, bytes(f.read_at(TRAILER_BYTES, size - TRAILER_BYTES)))
    head, width = struct.unpack(HEAD, bytes(f.read_at(HEAD_BYTES, 0)))
    if magic != MAGIC or head != MAGIC:
        raise ValueError("not a token shard")
    raw = bytes(f.read_at(17 * docs, size - TRAILER_BYTES - 17 * docs))
    return width, np.frombuffer(raw, "<i8", docs), np.frombuffer(raw, "u1", docs, 8 * docs), np.frombuffer(raw, "<i8", docs, 9 * docs)


# ---------------------------------------------------------------- minimal perfect hash

def _level_pos(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix64(h + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))) % np.uint64(size)).astype(np.int64)


def _fingerprint(h: np.ndarray) -> np.ndarray:
    return (mix64(h ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Levels of bit arrays (64-bit words) and the running rank before each word."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
        self.first = np.concatenate([[0], np.cumsum([-(-s // 64) for s in sizes])]).astype(np.int64)

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        """Of distinct unsigned 64-bit hashes."""
        sizes, words = [], []
        while len(h):
            if len(sizes) == MAX_LEVELS:
                raise ValueError("keys with one 64-bit hash")
            size = max(64, int(GAMMA * len(h)))
            pos = _level_pos(h, len(sizes), size)
            alone = np.bincount(pos, minlength=size)[pos] == 1
            bits = np.zeros(-(-size // 64) * 64, dtype=np.uint8)
            bits[pos[alone]] = 1
            words.append(np.packbits(bits, bitorder="little").view("<u8"))
            sizes.append(size)
            h = h[~alone]
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, dtype="<u8"))

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slot of each hash; -1 for a hash that no level holds (not a key)."""
        out = np.full(len(h), -1, dtype=np.int64)
        left = np.arange(len(h))
        for level, size in enumerate(self.sizes):
            pos = _level_pos(h[left], level, size)
            word, bit = self.first[level] + (pos >> 6), (pos & 63).astype(np.uint64)
            w = self.words[word]
            hit = ((w >> bit) & np.uint64(1)) == 1
            below = np.bitwise_count(w & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[hit]] = (self.rank[word] + below)[hit]
            left = left[~hit]
        return out


def _write_index(path: str, h: np.ndarray, entries: np.ndarray) -> int:
    mph = PerfectHash.build(h)
    table = np.zeros(len(h), dtype=ENTRY)
    table[mph.slots(h)] = entries
    sizes = np.array(mph.sizes, dtype="<i8")
    return write_whole(path, [INDEX_MAGIC, struct.pack("<QQ", len(sizes), len(mph.words)), sizes.tobytes(),
                              mph.words.tobytes(), table.tobytes()])


def read_index(path: str) -> tuple[PerfectHash, np.ndarray] | None:
    """(hash, entries) of a bucket; None if there is no such file (no key fell into it)."""
    fs, p = open_fs(path)
    if fs.get_file_info(p).type.name != "File":
        return None
    with fs.open_input_file(p) as f:
        raw = bytes(f.read())
    if raw[:8] != INDEX_MAGIC:
        raise ValueError("not an index file")
    levels, words = struct.unpack_from("<QQ", raw, 8)
    sizes = np.frombuffer(raw, "<i8", levels, 24).tolist()
    at = 24 + 8 * levels
    return PerfectHash(sizes, np.frombuffer(raw, "<u8", words, at)), np.frombuffer(raw, ENTRY, -1, at + 8 * words)


# ---------------------------------------------------------------- index

def _hash(key="key", copy="copy"):
    """64-bit hash of (key, copy): the index is built and asked with the same expression."""
    return F.xxhash64(F.col(key), F.col(copy))


def _bucket_path(folder: str, bucket: int) -> str:
    return f"{folder}/index-{bucket:06d}.mph"


def build_index(manifest: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Write the index of all shards of ``manifest``; returns (bucket, keys, bytes)."""
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)     # one row a shard
    based = manifest.select("shard", "path", F.coalesce(F.sum("ids").over(w), F.lit(0)).alias("base"))

    def contents(frames):
        for f in frames:
            for shard, path, base in zip(f["shard"], f["path"], f["base"]):
                fs, p = open_fs(path)
                with fs.open_input_file(p) as g:
                    _, keys, nulls, counts = read_contents(g)
                at = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else counts
                same = np.zeros(len(keys), dtype=bool)
                same[1:] = (keys[1:] == keys[:-1]) & (nulls[1:] == nulls[:-1])
                run = np.arange(len(keys))
                copy = run - np.maximum.accumulate(np.where(same, 0, run))
                yield pd.DataFrame({"key": pd.array(keys, dtype="Int64").copy(), "copy": copy.astype(np.int32), "shard": np.int32(shard),
                                    "at": at, "n": counts, "start": at + base}).assign(
                    key=lambda d, z=nulls: d["key"].mask(z.astype(bool)))

    rows = based.repartition(partitions_of(manifest.sparkSession), "shard") \
        .mapInPandas(contents, "key long, copy int, shard int, at long, n long, start long")
    rows = rows.withColumn("h", _hash()).withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))

    def build(key, pdf):
        entries = np.zeros(len(pdf), dtype=ENTRY)
        h = pdf["h"].to_numpy().view(np.uint64)
        entries["fp"] = _fingerprint(h)
        for c in ("shard", "at", "n", "start"):
            entries[c] = pdf[c].to_numpy()
        size = _write_index(_bucket_path(folder, int(key[0])), h, entries)
        return pd.DataFrame({"bucket": [int(key[0])], "keys": [len(pdf)], "bytes": [size]}).astype({"bucket": "int32"})

    return cut(rows.groupBy("bucket").applyInPandas(build, "bucket int, keys long, bytes long"), "index")


def lookup(keys: DataFrame, folder: str, buckets: int, key: str = "doc_id", copy: str | None = None) -> DataFrame:
    """Keyed access: ``key``, ``copy``, start, n_tokens and ids (little-endian unsigned 32-bit) of
    each asked (key, copy) that the index knows.  Each index bucket and each shard is opened
    once by the task that holds its rows; shards are read at the places that the index gives."""
    asked = keys.select(F.col(key).cast("long").alias("key"), (F.col(copy) if copy else F.lit(0)).cast("int").alias("copy"))
    asked = asked.withColumn("h", _hash()).withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))

    def find(frames):
        bucket, index = None, None
        for f in frames:
            for b, g in f.groupby("bucket", sort=False):
                if b != bucket:
                    bucket, index = b, read_index(_bucket_path(folder, int(b)))
                if index is None:
                    continue
                h = g["h"].to_numpy().view(np.uint64)
                slots = index[0].slots(h)
                e = index[1][np.maximum(slots, 0)]
                ok = (slots >= 0) & (e["fp"] == _fingerprint(h))
                e, g = e[ok], g[ok]
                yield pd.DataFrame({"key": g["key"].to_numpy(), "copy": g["copy"].to_numpy(), "shard": e["shard"].astype(np.int32),
                                    "at": e["at"].astype(np.int64), "n": e["n"].astype(np.int64), "start": e["start"].astype(np.int64)}) \
                    .assign(key=lambda d: d["key"].astype("Int64"))

    def fetch(batches):
        shard, f, width = None, None, 0
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            out = []
            for s, at, n in zip(cols[2], cols[3], cols[4]):
                if s != shard:
                    if f is not None:
                        f.close()
                    fs, p = open_fs(_shard_path(folder, s))
                    shard, f = s, fs.open_input_file(p)
                    width = struct.unpack(HEAD, bytes(f.read_at(HEAD_BYTES, 0)))[1]
                raw = np.frombuffer(f.read_at(n * width, HEAD_BYTES + at * width), dtype="<u2" if width == 2 else "<u4")
                out.append(raw.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(5), b.column(4), pa.array(out, pa.binary())],
                                             names=[key, "copy", "start", "n_tokens", "ids"])
        if f is not None:
            f.close()

    p = partitions_of(keys.sparkSession)
    found = asked.repartition(p, "bucket").sortWithinPartitions("bucket") \
        .mapInPandas(find, "key long, copy int, shard int, at long, n long, start long")
    return found.repartition(p, "shard").sortWithinPartitions("shard", "at") \
        .mapInArrow(fetch, f"`{key}` long, copy int, start long, n_tokens long, ids binary")


def buckets_for(docs: int, spark, keys_per_bucket: int = 50_000) -> int:
    return max(partitions_of(spark), -(-docs // keys_per_bucket))


def all_keys(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, copy) of every row."""
    counts = docs.groupBy(F.col(key).cast("long").alias(key)).agg(F.count(F.lit(1)).alias("_n"))
    return counts.select(key, F.explode(F.sequence(F.lit(0), (F.col("_n") - 1).cast("int"))).alias("copy"))
