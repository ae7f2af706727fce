"""Packing of token sequences into windows by bounded-space best fit.

A task keeps a fixed number of open windows. A piece goes to the fullest window that still holds it; where none does, the
fullest is filled up with the start of the piece, given out, and the rest is placed anew. At the end a task's open windows
are merged, then those of every FAN tasks, and what remains is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.bpe import Words
from cadenza.llm.common import cut, in_batches, read

WINDOW = 4096
OPEN = 16
#: Tasks whose last windows are merged together.
FAN = 64
END_ID = 2


@dataclass
class Piece:
    doc_id: object
    start: int
    doc_tokens: int
    ids: bytes  # little-endian 32-bit

    def __len__(self) -> int:
        return len(self.ids) // 4

    def split(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.doc_tokens, self.ids[: 4 * n]),
            Piece(self.doc_id, self.start + n, self.doc_tokens, self.ids[4 * n :]),
        )


@dataclass
class Packer:
    """Open windows of one task; done gets the pieces of each full one."""

    window: int = WINDOW
    open: int = OPEN
    windows: list[list[Piece]] = field(default_factory=list)
    used: list[int] = field(default_factory=list)
    done: list[list[Piece]] = field(default_factory=list)

    def add(self, piece: Piece) -> None:
        while len(piece) >= self.window:
            head, piece = piece.split(self.window)
            self.done.append([head])
        while len(piece):
            room = self.window - len(piece)
            fits = [i for i, u in enumerate(self.used) if u <= room]
            if fits:
                i = max(fits, key=self.used.__getitem__)
            elif len(self.used) < self.open:
                self.windows.append([])
                self.used.append(0)
                i = len(self.used) - 1
            else:
                i = max(range(len(self.used)), key=self.used.__getitem__)
                head, piece = piece.split(self.window - self.used[i])
                self.done.append([*self.windows.pop(i), head])
                self.used.pop(i)
                continue
            self.windows[i].append(piece)
            self.used[i] += len(piece)
            if self.used[i] == self.window:
                self.done.append(self.windows.pop(i))
                self.used.pop(i)
            return

    def merge(self) -> list[Piece]:
        """Open windows end to end: full ones to done; the rest, less than a window, is returned."""
        pieces = [p for _, w in sorted(zip(self.used, self.windows, strict=True), key=lambda x: -x[0]) for p in w]
        self.windows, self.used = [], []
        return self.fill(pieces)

    def fill(self, pieces: list[Piece]) -> list[Piece]:
        now: list[Piece] = []
        room = self.window
        for p in pieces:
            while len(p) >= room:
                head, p = p.split(room)
                self.done.append([*now, head])
                now, room = [], self.window
            if len(p):
                now.append(p)
                room -= len(p)
        return now


def powers(pieces: list[Piece]) -> list[list[Piece]]:
    """Windows whose lengths are the powers of two in the pieces' total, largest first."""
    out: list[list[Piece]] = []
    left = sum(map(len, pieces))
    rest = list(pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        now = []
        while room:
            p = rest.pop(0)
            if len(p) > room:
                p, after = p.split(room)
                rest.insert(0, after)
            now.append(p)
            room -= len(p)
        out.append(now)
    return out


def _rows(first: int, windows: list[list[Piece]]) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in COLUMNS}
    for n, pieces in enumerate(windows):
        at = 0
        for p in pieces:
            row = (p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, first + n, at, None, None)
            for k, v in zip(COLUMNS, row, strict=True):
                out[k].append(v)
            at += len(p)
    return out


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "task", "ids")
TYPES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def _pack(path: str | None):
    end = np.asarray([END_ID], "<u4").tobytes()

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        from pyspark import TaskContext

        task, n, packer, words = TaskContext.get().partitionId(), 0, Packer(), Words(path)
        for b in batches:
            for doc_id, ids in zip(b["doc_id"], words.of(b["text"]), strict=True):
                ids += end
                packer.add(Piece(doc_id, 0, len(ids) // 4, ids))
            yield _rows((task << 32) + n, packer.done)
            n += len(packer.done)
            packer.done = []
        last = packer.merge()
        yield _rows((task << 32) + n, packer.done)
        yield {k: [] for k in COLUMNS} | {
            "doc_id": [p.doc_id for p in last], "start": [p.start for p in last], "length": [len(p) for p in last],
            "ids_crc32": [None] * len(last), "doc_tokens": [p.doc_tokens for p in last],
            "sequence_id": [None] * len(last), "offset": list(range(len(last))), "task": [task] * len(last),
            "ids": [p.ids for p in last],
        }

    return run


def _merge(group: tuple, rows):
    import pandas as pd

    rows = rows.sort_values(["task", "offset"])
    packer = Packer()
    rest = packer.fill(
        [Piece(*x) for x in zip(rows["doc_id"], rows["start"], rows["doc_tokens"], map(bytes, rows["ids"]), strict=True)]
    )
    out = _rows((1 << 62) + (int(group[0]) << 32), packer.done + powers(rest))
    return pd.DataFrame({k: out[k] for k in COLUMNS[:7]})


def pack_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str | None = None) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's tokens are those of its text and END_ID; null text is empty. Each token lies in one piece, each piece in
    one sequence of WINDOW tokens or, for at most a dozen sequences in FAN tasks, of a smaller power of two. Documents of
    any length are cut as need be. Repeated rows are packed each. An empty table gives no pieces. A null id is carried
    as null. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    pieces = cut(in_batches(rows, _pack(path), f"doc_id {kind}, {TYPES}, task bigint, ids binary"))
    full = pieces.where("ids is null").drop("task", "ids")
    last = pieces.where("ids is not null").withColumn("fan", F.floor(F.col("task") / FAN))
    merged = last.groupBy("fan").applyInPandas(_merge, f"doc_id {kind}, {TYPES}")
    return full.unionByName(merged)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)
