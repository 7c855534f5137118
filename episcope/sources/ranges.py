"""Splittable reading of files whose records do not end where lines do.

Spark's text source deals a file out in byte ranges and gives every piece (up to a separator) to
the range that it starts in.  What a piece means depends on all before it: inside a quoted cell or
a string, how deep in a document.  Three passes settle that without reading a file in one task:

1. every range reports what its pieces make of each state that it may start in;
2. these reports, one row a range, are chained along each file, which fixes the range's real state;
3. the ranges are read again.  Each cuts out the records that start in it; the end of a record
   that reaches into later ranges is reported by those, and such pieces alone are put together
   in a further step.

So records come out as from reading each file whole, for every size of the ranges.  Compressed
files are one range.  A file that ends inside a record gives what there is of it.
"""

from __future__ import annotations

import csv
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episcope.session import cut_lineage, ship_package

RECORD, HEAD, MIDDLE, TAIL, KEY = 0, 1, 2, 3, 4      # all of a record, its end, a part between, its beginning; the key of an array
PIECES = "file string, start long, kind int, first boolean, key string, text string"
MOST_HEADERS = 10_000


def _pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    return spark.read.option("lineSep", separator).text(path) \
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _by_range(batches):
    """(file, start, values) for each stretch of rows of one range, in order; a range may come in several stretches."""
    for b in batches:
        files = b.column(1).dictionary_encode()
        codes, starts = files.indices.to_numpy(), b.column(2).to_numpy()
        at = 0
        for i in [*((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])).nonzero()[0] + 1, b.num_rows]:
            if i > at:
                yield files.dictionary[int(codes[at])].as_py(), int(starts[at]), b.column(0).slice(at, i - at).to_pylist()
            at = i


def _scanned(batches, new):
    """Run a scanner over each range: ``new(file, start)`` makes one, ``feed(values)`` and ``finish()`` give rows."""
    current, scanner = None, None
    for file, start, values in _by_range(batches):
        if (file, start) != current:
            if scanner:
                yield from scanner.finish()
            current, scanner = (file, start), new(file, start)
        yield from scanner.feed(values)
    if scanner:
        yield from scanner.finish()


def _rows_to_batches(rows, schema: pa.Schema, size: int = 2_000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_PIECE_SCHEMA = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()),
                           ("key", pa.string()), ("text", pa.string())])


def _whole(pieces: DataFrame, separator: str) -> DataFrame:
    """(file, start, first, key, text) of all records of a written table of pieces; those in several pieces
    are put together."""
    records = pieces.where(F.col("kind") == RECORD).select("file", "start", "first", "key", "text")
    # a record in pieces: its tail opens it, the middles and the head of later ranges follow
    order = Window.partitionBy("file").orderBy("start", "kind")
    parts = pieces.where(F.col("kind") != RECORD).withColumn("_open", F.count(F.when(F.col("kind") == TAIL, 1)).over(order))
    joined = parts.where("_open > 0").groupBy("file", "_open").agg(
        F.min("start").alias("start"), F.max("first").alias("first"), F.min_by("key", F.struct("start", "kind")).alias("key"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "kind", "text"))), lambda x: x["text"]), separator).alias("text"))
    return records.unionByName(joined.drop("_open"))


# ---------------------------------------------------------------- quoted CSV

def quoted_after(line: str, quoted: bool) -> bool:
    """Whether a cell's quotes are open at the end of a line that begins inside (``quoted``) or outside them.
    Quotes open at the beginning of a cell only; inside, a doubled quote stands for one."""
    at = 0
    if '"' not in line:
        return quoted
    while True:
        if quoted:
            i = line.find('"', at)
            while i >= 0 and line[i + 1:i + 2] == '"':
                i = line.find('"', i + 2)
            if i < 0:
                return True
            at, quoted = i + 1, False
        else:
            i = 0 if at == 0 and line.startswith('"') else line.find(',"', at) + 1
            if i == 0 and not (at == 0 and line.startswith('"')):
                return False
            at, quoted = i + 1, True


class _QuoteStates:
    """What a range makes of beginning outside and inside quotes."""

    def __init__(self, file: str, start: int):
        self.file, self.start, self.out, self.inside = file, start, False, True

    def feed(self, lines):
        for line in lines:
            same = self.out == self.inside
            self.out = quoted_after(line, self.out)
            self.inside = self.out if same else quoted_after(line, self.inside)
        return ()

    def finish(self):
        yield self.file, self.start, self.out, self.inside


class _CsvRecords:
    def __init__(self, file: str, start: int, quoted: bool):
        self.file, self.start, self.quoted = file, start, quoted
        self.head, self.held, self.first = quoted, [], start == 0

    def feed(self, lines):
        for line in lines:
            self.held.append(line)
            self.quoted = quoted_after(line, self.quoted)
            if not self.quoted:
                yield self.file, self.start, HEAD if self.head else RECORD, self.first, None, "\n".join(self.held)
                self.head, self.held, self.first = False, [], False

    def finish(self):
        if self.held:
            yield self.file, self.start, MIDDLE if self.head else TAIL, self.first, None, "\n".join(self.held)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, record) for every record of quoted CSV files; ``first`` marks each file's first one.
    Records without a character are left out."""
    ship_package(spark)
    lines = _pieces(spark, path, "\n")
    kind = pa.schema([("file", pa.string()), ("start", pa.int64()), ("out", pa.bool_()), ("inside", pa.bool_())])
    ends = lines.mapInArrow(lambda b: _rows_to_batches(_scanned(b, _QuoteStates), kind), "file string, start long, out boolean, inside boolean")

    def chained(ranges: pa.Table) -> pa.Table:
        """The ranges of one file that begin inside quotes."""
        quoted, found = False, []
        for r in sorted(ranges.to_pylist(), key=lambda r: r["start"]):
            if quoted:
                found.append(r["start"])
            quoted = r["inside"] if quoted else r["out"]
        return pa.table({"file": pa.array([ranges["file"][0].as_py()] * len(found), pa.string()), "start": pa.array(found, pa.int64())})

    # one entry for every range that begins inside quotes: it grows with the files by some bytes for each 128 MB
    begin = spark.sparkContext.broadcast({(r["file"], r["start"]) for r in ends.groupBy("file").applyInArrow(chained, "file string, start long").collect()})

    def cut(batches):
        inside = begin.value
        return _rows_to_batches(_scanned(batches, lambda file, start: _CsvRecords(file, start, (file, start) in inside)), _PIECE_SCHEMA)

    return _whole(cut_lineage(lines.mapInArrow(cut, PIECES), "pieces"), "\n").select("file", "first", F.regexp_replace("text", "\r$", "").alias("record")).where("record <> ''")


def read_csv(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame:
    """The ``wanted`` columns, as strings, of quoted CSV files with line breaks in cells, by the names in
    each file's own header: files of one path may have their columns in different orders or lack some
    (null).  Empty cells are null."""
    records = cut_lineage(csv_records(spark, path), "csv")
    per_file = records.where("first").select("file", F.col("record").alias("header"))
    headers = sorted(r["header"] for r in per_file.select("header").distinct().limit(MOST_HEADERS + 1).collect())
    if len(headers) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers below {path}")
    names = [next(csv.reader([h.removeprefix("\ufeff")])) for h in headers]
    width = max((len(n) for n in names), default=1)
    cells = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    rows = records.where("not first").withColumn("cells", F.from_csv("record", cells.simpleString()[7:-1].replace(":", " "), {"escape": '"', "maxColumns": str(max(20_480, width))}))
    if len(headers) > 1:
        rows = rows.join(per_file.withColumnRenamed("file", "_file"), F.col("file") == F.col("_file"))
    else:
        rows = rows.withColumn("header", F.lit(headers[0] if headers else ""))

    def column(name):
        found = [F.when(F.col("header") == h, F.col(f"cells.c{n.index(name)}")) for h, n in zip(headers, names) if name in n]
        return (F.coalesce(*found) if found else F.lit(None).cast("string")).alias(name)
    return rows.select(*[column(n) for n in wanted])


# ---------------------------------------------------------------- one JSON document

_MARKS = re.compile(r'\\.|["{}\[\]]', re.DOTALL)


def structure(piece: str, string: bool, depth: int):
    """(in a string, depth, positions of the marks that change the depth as (place, mark, depth before)) at the
    end of a piece."""
    marks = []
    for m in _MARKS.finditer(piece):
        c = m[0]
        if c == '"':
            string = not string
        elif not string and len(c) == 1:
            marks.append((m.start(), c, depth))
            depth += 1 if c in "{[" else -1
    return string, depth, marks


@dataclass
class _Depths:
    """What a range makes of beginning outside and inside a string."""
    file: str
    start: int

    def __post_init__(self):
        self.states = [(False, 0), (True, 0)]

    def feed(self, pieces):
        for p in pieces:
            self.states = [structure(p, *s)[:2] for s in self.states]
        return ()

    def finish(self):
        (a, b), (c, d) = self.states
        yield self.file, self.start, a, b, c, d


class _JsonItems:
    """Items of the arrays in a document ``{key: [item, ...], ...}``: texts between the commas of depth 2.

    A range that begins below depth 1 does not know in what: its first items have no key yet.  A KEY row
    names the last array (text "[") or object ("{") that opens at depth 1 in the range."""

    def __init__(self, file: str, start: int, string: bool, depth: int):
        self.file, self.start, self.string, self.depth = file, start, string, depth
        self.held: list[str] = []
        self.within = "?" if depth >= 2 else ""          # "[", "{", "" (depth 1 or less) or "?"
        self.head = depth > 2 or depth == 2 and string    # else an item begins here: pieces begin behind commas
        self.key, self.opened, self.text = None, "", []   # text: pieces of an unfinished string at depth 1

    def _flush(self, kind):
        text = ",".join(self.held)
        self.held = []
        if kind != RECORD or text.strip():
            yield self.file, self.start, kind, False, self.key, text

    def feed(self, pieces):
        for p in pieces:
            string, depth, marks = structure(p, self.string, self.depth)
            at = 0
            for place, mark, before in marks:
                if before == 1 and mark in "[{":
                    self.key = _key_before(",".join([*self.text, p[:place]])) if mark == "[" else None
                    self.within = self.opened = mark
                    self.head, at = False, place + 1
                elif before == 2 and mark in "]}":
                    if self.within in ("[", "?"):
                        self.held.append(p[at:place])
                        yield from self._flush(HEAD if self.head else RECORD)
                    self.head, self.within = False, ""
            self.text = [*self.text, p] if depth < 2 and string else []
            if self.within in ("[", "?"):
                self.held.append(p[at:])
                if depth == 2 and not string:              # the comma behind this piece ends an item
                    yield from self._flush(HEAD if self.head else RECORD)
                    self.head = False
            self.string, self.depth = string, depth

    def finish(self):
        if self.held:
            yield from self._flush(MIDDLE if self.head else TAIL)
        if self.opened:
            yield self.file, self.start, KEY, False, self.key, self.opened


def _key_before(text: str) -> str:
    """The key in front of an array."""
    m = re.search(r'("(?:[^"\\]|\\.)*")\s*:\s*$', text, re.DOTALL)
    if not m:
        raise ValueError(f"no key in front of an array: ...{text[-80:]}")
    return json.loads(m[1], strict=False)


def json_items(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(file, item): the texts of the items of the array ``key`` of documents ``{key: [...], ...}``, one document a
    file, read from any number of ranges.  Other top-level values are passed over.  (A key that itself holds a
    comma must not be parted by the border of two ranges; that is an error, not another result.)"""
    ship_package(spark)
    pieces = _pieces(spark, path, ",")
    kind = pa.schema([("file", pa.string()), ("start", pa.int64()), *[(c, pa.bool_() if i % 2 == 0 else pa.int64()) for i, c in enumerate("abcd")]])
    ends = pieces.mapInArrow(lambda b: _rows_to_batches(_scanned(b, _Depths), kind), "file string, start long, a boolean, b long, c boolean, d long")

    def chained(ranges: pa.Table) -> pa.Table:
        string, depth, found = False, 0, []
        for r in sorted(ranges.to_pylist(), key=lambda r: r["start"]):
            found.append((r["file"], r["start"], string, depth))
            string, depth = (r["c"], depth + r["d"]) if string else (r["a"], depth + r["b"])
        return pa.table([pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.int64(), pa.bool_(), pa.int64()))],
                        names=["file", "start", "string", "depth"])

    # one entry for every range: it grows with the files by some bytes for each 128 MB
    states = ends.groupBy("file").applyInArrow(chained, "file string, start long, string boolean, depth long").collect()
    begin = spark.sparkContext.broadcast({(r["file"], r["start"]): (r["string"], r["depth"]) for r in states})

    def cut(batches):
        known = begin.value
        return _rows_to_batches(_scanned(batches, lambda file, start: _JsonItems(file, start, *known[file, start])), _PIECE_SCHEMA)

    found = cut_lineage(pieces.mapInArrow(cut, PIECES), "pieces")
    items = _whole(found.where(F.col("kind") != KEY), ",")
    # items that began without a key belong to the last array opened in an earlier range (one row for each range that opens any)
    following = Window.partitionBy("file").orderBy("start")
    opened = found.where(F.col("kind") == KEY).select(
        F.col("file").alias("_file"), F.col("start").alias("_from"), F.col("key").alias("_key"), F.col("text").alias("_mark"),
        F.lead("start").over(following).alias("_next"))
    late = items.where("key is null").join(opened, (F.col("file") == F.col("_file")) & (F.col("start") > F.col("_from"))
                                           & (F.col("_next").isNull() | (F.col("start") <= F.col("_next")))) \
        .where("_mark = '['").select("file", F.col("_key").alias("key"), "text")
    every = items.where("key is not null").select("file", "key", "text").unionByName(late)
    return every.where(F.col("key") == key).select("file", F.trim(F.regexp_replace("text", r"^\s+|\s+$", "")).alias("item")).where("item <> ''")
