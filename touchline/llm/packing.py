"""Packing of token sequences into windows by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.text import bounded_batches
from touchline.llm.tokens import encoded_texts

WINDOW = 1024
#: Bytes of text that a packing task encodes at once. A worker keeps its vocabulary and open windows beside them.
RUN = 1 << 20

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
])
_ARROW = pa.schema([(f.name, pa.int64()) for f in PIECES.fields])


@dataclass(frozen=True)
class Piece:
    doc: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def part(self, a: int, b: int) -> Piece:
        return Piece(self.doc, self.start + a, self.ids[a:b], self.doc_tokens)


class SumOfSquares:
    """Online packing: ``count[l]`` windows are filled up to level l.

    A piece goes to the level at which the sum of the squared counts of partly filled windows comes
    out least, an empty window being one of the choices; the fullest level wins a tie. Placing it
    moves one window from its level to a higher one, so only two terms of the sum change and all
    levels are judged at once.
    """

    def __init__(self, window: int) -> None:
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(window)]

    def level_for(self, size: int) -> int:
        after = 2 * self.count[size:self.window + 1] + 1  # the level that level l becomes
        after[-1] = 0  # a full window no longer counts
        before = 1 - 2 * self.count[:self.window + 1 - size]
        change = np.where(self.count[:len(before)] > 0, before + after, np.iinfo(np.int64).max)
        change[0] = after[0]
        return int(len(change) - 1 - np.argmin(change[::-1]))

    def place(self, piece: Piece) -> list[Piece] | None:
        """Put a piece of fewer ids than a window somewhere; the window's pieces if that fills it."""
        level = self.level_for(len(piece.ids))
        pieces = self.open[level].pop() if level else []
        self.count[level] -= level > 0
        pieces.append(piece)
        level += len(piece.ids)
        if level == self.window:
            return pieces
        self.open[level].append(pieces)
        self.count[level] += 1
        return None

    def rest(self) -> Iterator[list[Piece]]:
        """What is still open when the input ends, cut anew into full windows and powers of two."""
        pieces = [p for level in reversed(self.open) for window in level for p in window]
        left = sum(len(p.ids) for p in pieces)
        pieces.reverse()
        while left:
            room = min(self.window, 1 << (left.bit_length() - 1))
            left -= room
            out = []
            while room:
                piece = pieces.pop()
                size = len(piece.ids)
                if size > room:
                    pieces.append(piece.part(room, size))
                    piece = piece.part(0, room)
                out.append(piece)
                room -= len(piece.ids)
            yield out


def pack_documents(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = 0, id_column: str = "doc_id",
    text_column: str = "text", with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` token ids, without padding.

    A document is the ids of its whole text and ``end``. As many full windows as it fills are sequences
    by themselves; what remains is placed by :class:`SumOfSquares`. When a task's input ends, the
    windows that are still open are cut anew into full ones and one each of some powers of two, which
    need no padding. ``window`` must be a power of two. Tasks pack what they read, side by side,
    without a shuffle, and keep only their open windows. Every id is in exactly one piece.

    Columns: doc_id, start (ids of the document before the piece), length, ids_crc32 (of the ids as
    little-endian 32-bit integers), doc_tokens, sequence_id (task and number), offset (in the
    sequence, without gaps) and, if asked for, ids. Null and empty texts are the single id ``end``.
    Repeated rows and null ids are documents of their own. An empty table gives no rows.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    bounded_batches(docs.sparkSession)
    schema = T.StructType([*PIECES.fields, *([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else [])])
    arrow = pa.schema([*_ARROW, *([pa.field("ids", pa.list_(pa.int64()))] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, sequence, rows = SumOfSquares(window), TaskContext.get().partitionId() << 40, []

        def close(pieces: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for p in pieces:
                size = len(p.ids)
                row = (p.doc, p.start, size, zlib.crc32(p.ids), p.doc_tokens, sequence, offset)
                rows.append((*row, p.ids.tolist()) if with_ids else row)
                offset += size
            sequence += 1

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(arrow)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for row, coded in encoded_texts(tokenizer, batch.column(1), end, RUN):
                for i in range(len(coded.first) - 1):
                    ids = coded.ids[coded.first[i]:coded.first[i + 1]]
                    whole = Piece(names[row + i], 0, ids, len(ids))
                    full = len(ids) - len(ids) % window
                    for a in range(0, full, window):
                        close([whole.part(a, a + window)])
                    if full < len(ids):
                        tail = Piece(whole.doc, full, ids[full:].copy(), len(ids))
                        if pieces := packer.place(tail):
                            close(pieces)
                yield flushed()
        for pieces in packer.rest():
            close(pieces)
        yield flushed()

    return docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`")).mapInArrow(run, schema)
