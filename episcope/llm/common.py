"""Small helpers shared by the training-data operators: tables, shared paths, token ids, hashing."""

from __future__ import annotations

import json
import os
import re
import uuid
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episcope.session import ensure_checkpoint_dir

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BATCH_ROWS = 2_048  # rows that Spark sends to a Python worker at once
TEXT_BATCH_ROWS = 512    # rows per Arrow batch for tasks that hold whole texts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/episcope-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` (zstd Parquet) to the shared checkpoint folder and read it back: later
    jobs and lost executors reread the files instead of replaying the plan.  ``tidy`` asks the
    driver's JVM to collect its garbage then: Spark deletes the shuffle files of a finished
    plan only once the plan is collected, and after a large step that should be soon."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    # rows may be whole texts: the JVM and the Python worker each hold an Arrow batch of them
    if int(spark.conf.get(ARROW_ROWS)) > ARROW_BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(ARROW_BATCH_ROWS))
    df.write.option("compression", "zstd").parquet(path)
    if tidy:
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def free_name(base: str, *frames: DataFrame) -> str:
    """``base``, with underscores in front until no frame has a column of that name."""
    taken = {c.lower() for f in frames for c in f.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def small_batches(batches, rows: int = TEXT_BATCH_ROWS):
    """The same rows in Arrow batches of at most ``rows``: what a task makes of a batch (Python
    strings, lists of hashes) is held for so many texts only."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def lean(run, keeps: str | None = None):
    """The task function ``run``, with the memory that it freed given back to the system when its task ends:
    Python workers outlive their tasks, and what they keep adds to that of the next operator.  For that,
    what tasks of other operators left in the worker is dropped first; ``keeps`` names what this one uses."""
    def wrapped(batches):
        forget(keeps)
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def give_back() -> None:
    """Return the process's freed memory to the system."""
    import ctypes
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)    # glibc only
    if trim is not None:
        trim(0)


_KEPT: dict[str, dict] = {}      # what the Python worker keeps from task to task


def keep(name: str, store: dict) -> dict:
    """``store``, which :func:`lean` tasks empty unless they keep that name."""
    _KEPT[name] = store
    return store


def forget(but: str | None = None) -> None:
    """Empty what the worker keeps, except for one name."""
    for name, store in _KEPT.items():
        if name != but:
            store.clear()


def partitions_of(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# ---------------------------------------------------------------- shared files

def open_fs(uri: str):
    """(filesystem, path) of a URI in a store that executors and driver share."""
    from pyarrow import fs
    if "://" not in uri:
        m = re.match(r"^([a-z][a-z0-9+.-]*):(/.*)$", uri)
        if not m:
            return fs.LocalFileSystem(), uri
        uri = f"{m[1]}://{m[2]}"
    return fs.FileSystem.from_uri(uri)


def write_whole(uri: str, chunks) -> int:
    """Write chunks to ``uri`` through a temporary name and one rename, so that a retried or
    speculative task replaces the file as a whole.  Returns the number of bytes."""
    fs, path = open_fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    tmp, n = f"{path}.{uuid.uuid4().hex}.tmp", 0
    with fs.open_output_stream(tmp) as out:
        for c in chunks:
            out.write(c)
            n += len(c)
    fs.move(tmp, path)
    return n


# ---------------------------------------------------------------- token ids

# Unicode White_Space, the class \\s of the byte-level pre-tokenizer
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_CHUNKS = re.compile(f" ?[{_LETTERS}]++(?=[ \n.,!?;:]|\\Z)| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


def _byte_alphabet() -> dict[int, str]:
    """Byte -> printable character of byte-level BPE vocabularies (printable Latin-1 bytes
    stand for themselves, the others for code points from 256 on)."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Cache(dict):
    """Chunk -> id bytes; two generations, so that rare chunks leave and frequent ones stay."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, chunk: str) -> bytes:
        got = self.old.get(chunk)
        if got is None:
            got = self.encode(chunk)
        if len(chunk) <= 64:
            self[chunk] = got
        return got

    def age(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
            give_back()


class Encoder:
    """Ids of whole texts by a byte-level BPE file of the tokenizers library.

    The pre-tokenizer never joins characters across the chunk borders used here: a chunk is
    a run of letters with one leading space before white space or punctuation, else a run of
    non-space characters, else a run of white space.  So a text's ids are its chunks' ids in
    order.  Chunks repeat, so each is encoded once by the library (a run of letters, being
    one pre-token, by its BPE model directly) and kept in a bounded cache.  Special tokens in
    a text are cut out first, as the library does.  Files of another kind (other
    pre-tokenizer, a normalizer) are encoded text by text.
    """

    def __init__(self, path: str, cache_chunks: int = 400_000):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        pre = kind.get("pre_tokenizer") or {}
        self.plain = kind.get("normalizer") is None and pre.get("type") == "ByteLevel" \
            and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.model, self.alphabet = self.tok.model, _byte_alphabet()
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.cache = _Cache(self._encode_chunk, cache_chunks)

    def _encode_chunk(self, chunk: str) -> bytes:
        if (chunk[1:] if chunk[0] == " " else chunk).isalpha():
            word = chunk.encode().decode("latin-1").translate(self.alphabet)
            return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        return array("I", self.tok.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _chunks(self, text: str) -> list[str]:
        if self.split is None or not any(s in text for s in self.special):
            return _CHUNKS.findall(text)
        out: list[str] = []
        for part in self.split.split(text):
            out.extend([part] if part in self.special else _CHUNKS.findall(part))
        return out

    def encode(self, text: str, end_id: int) -> bytes:
        """Little-endian unsigned 32-bit ids of the whole text, ``end_id`` last."""
        if self.plain:
            ids = b"".join(map(self.cache.__getitem__, self._chunks(text)))
            self.cache.age()
        else:
            ids = array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()
        return ids + array("I", [end_id]).tobytes()


ENCODERS = "encoders"
_ENCODERS = keep(ENCODERS, {})


def encoder(path: str) -> Encoder:
    """The worker's encoder of that file (loaded once per Python worker, until a task of another operator)."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget_encoders() -> None:
    """Free the worker's encoders and their caches; the next call loads them again."""
    _ENCODERS.clear()


# ---------------------------------------------------------------- hashing

def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on an unsigned 64-bit array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8_size(col) -> F.Column:
    """UTF-8 bytes of a text column (null: 0)."""
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")


# ---------------------------------------------------------------- code on the executors

_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once per application), for clusters
    on whose machines it is not installed."""
    import tempfile
    import zipfile
    from pathlib import Path
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="episcope-code-")) / f"{top.name}.zip"    # the driver's copy, which Spark serves
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)
