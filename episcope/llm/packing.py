"""Bounded-space online packing of documents into token sequences.

Each task tokenises its documents and keeps at most ``open_windows`` windows open.  A piece
(a document's ids, cut every ``window`` ids) goes to the open window that it fits best; when
none has room and all are open, the fullest is emitted: topped up with the start of the piece
if both parts then have ``min_piece`` ids or more, else as it is.  What is still open at the
end of a task is merged in a last step: groups of ``merge_parts`` tasks place their leftover
windows into each other, best fit in falling size.  Only (window, fill) pairs of at most
``open_windows * merge_parts`` windows meet in one task there.

A null text counts as empty (it holds the end id alone); a null key stays null; repeated rows
are packed each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.llm.common import ENCODERS, cut, encoder, lean, small_batches

PIECES = ("key long, start long, length long, ids binary, doc_tokens long, window_id long, "
          "offset long, open boolean, task int")
_TYPES = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("window_id", pa.int64()), ("offset", pa.int64()),
                    ("open", pa.bool_()), ("task", pa.int32())])


class _Window:
    __slots__ = ("id", "fill", "pieces")

    def __init__(self, wid: int):
        self.id, self.fill, self.pieces = wid, 0, []

    def put(self, piece: tuple) -> None:
        self.pieces.append((*piece, self.id, self.fill))
        self.fill += piece[2]


class OnlinePacker:
    """The windows of one task.  ``add`` takes (key, start, length, ids, doc_tokens) and returns
    the windows that it closed."""

    def __init__(self, window: int, open_windows: int, min_piece: int, first_id: int):
        self.size, self.limit, self.min_piece, self.next_id = window, open_windows, min_piece, first_id
        self.by_room: list[tuple[int, int]] = []     # (room left, window id), ascending
        self.open: dict[int, _Window] = {}

    def add(self, piece: tuple) -> list[_Window]:
        closed = []
        if piece[2] < self.size:
            at = bisect_left(self.by_room, (piece[2], -1))
            if at == len(self.by_room) and len(self.open) >= self.limit:
                room, wid = self.by_room.pop(0)       # the fullest
                w = self.open.pop(wid)
                key, start, length, ids, total = piece
                if room >= self.min_piece and length - room >= self.min_piece:
                    w.put((key, start, room, ids[:4 * room], total))
                    piece = (key, start + room, length - room, ids[4 * room:], total)
                    at = bisect_left(self.by_room, (piece[2], -1))
                else:
                    at = len(self.by_room)
                closed.append(w)
            if at < len(self.by_room):                # best fit: least room that is enough
                w = self.open[self.by_room.pop(at)[1]]
            else:
                w = self._new()
        else:
            w = self._new()
        w.put(piece)
        if w.fill == self.size:
            del self.open[w.id]
            closed.append(w)
        else:
            insort(self.by_room, (self.size - w.fill, w.id))
        return closed

    def _new(self) -> _Window:
        w = self.open[self.next_id] = _Window(self.next_id)
        self.next_id += 1
        return w


def _rows(window: _Window, is_open: bool, task: int) -> list[tuple]:
    return [(*p, is_open, task) for p in window.pieces]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _TYPES)], schema=_TYPES)


def _pack_task(tokenizer: str, end_id: int, window: int, open_windows: int, min_piece: int):
    def run(batches):
        enc, task = encoder(tokenizer), TaskContext.get().partitionId()
        packer, rows = OnlinePacker(window, open_windows, min_piece, task << 32), []
        for b in small_batches(batches):
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = memoryview(enc.encode(text or "", end_id))
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = bytes(ids[4 * start:4 * (start + window)])
                    for w in packer.add((key, start, len(part) // 4, part, total)):
                        rows += _rows(w, False, task)
                if len(rows) >= 2000:
                    yield _batch(rows)
                    rows = []
        for w in packer.open.values():
            rows += _rows(w, True, task)
        if rows:
            yield _batch(rows)
    return run


def _merge(window: int):
    def run(pdf):
        """Best fit in falling size of one group's leftover windows into each other."""
        import pandas as pd
        left = sorted(zip(pdf["window_id"].tolist(), pdf["fill"].tolist()), key=lambda x: (-x[1], x[0]))
        rooms: list[tuple[int, int]] = []
        out = []
        for wid, fill in left:
            at = bisect_left(rooms, (fill, -1))
            room, target = rooms.pop(at) if at < len(rooms) else (window, wid)
            out.append((wid, target, window - room))
            if room > fill:
                insort(rooms, (room - fill, target))
        return pd.DataFrame(out, columns=["window_id", "sequence_id", "base"])
    return run


def pack_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0,
                   window: int = 1024, open_windows: int = 64, min_piece: int = 16, merge_parts: int = 16) -> DataFrame:
    """One row per piece: key, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset.  The pieces of a sequence lie gaplessly from offset 0."""
    src = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    pack = lean(_pack_task(tokenizer, end_id, window, open_windows, min_piece), keeps=ENCODERS)
    pieces = cut(src.mapInArrow(pack, PIECES), "pieces")
    is_open = pieces.filter("open")
    fills = is_open.groupBy("window_id").agg(F.sum("length").alias("fill"),
                                             F.floor(F.first("task") / merge_parts).alias("grp"))
    moved = fills.groupBy("grp").applyInPandas(_merge(window), "window_id long, sequence_id long, base long")
    kept = pieces.filter("not open").select("key", "start", "length", "ids", "doc_tokens",
                                            F.col("window_id").alias("sequence_id"), "offset")
    merged = is_open.join(moved, "window_id").select("key", "start", "length", "ids", "doc_tokens", "sequence_id",
                                                     (F.col("offset") + F.col("base")).alias("offset"))
    return kept.unionByName(merged).withColumnRenamed("key", key)
