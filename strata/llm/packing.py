"""Sum-of-squares packing of token ids into windows of a fixed length.

Each task packs the documents of its partition as they come, in id order. An
array counts the open windows at every fill level. A document goes to the
level (or a new window) after which the sum of the squared counts is least;
ties go to the fullest window. What a document has beyond whole windows is
placed this way, its whole windows are closed at once.

Open windows are bounded. When there are ``open_limit`` of them, and when the
partition ends, they are poured together: kept in order of fill, the fullest
are filled up by cutting the documents of the emptiest. So a partition leaves
at most one window that isn't full.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm.encode import Encoder

BATCH_IDS = 500_000     # packed between two batches of rows


class Packer:
    """Windows of ``width`` ids. Pieces are (key, start, ids, tokens of the document)."""

    def __init__(self, width: int, first_id: int, open_limit: int):
        self.width, self.next_id, self.open_limit = width, first_id, open_limit
        self.count = np.zeros(width + 1, np.int64)      # open windows at each level
        self.open: list[list] = [[] for _ in range(width + 1)]
        self.n_open = 0
        self.rows: list[tuple] = []

    def _close(self, pieces: list) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            self.rows.append((key, start, len(ids), ids.tobytes(), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def _level(self, size: int) -> int:
        """The fill level (0: a new window) that ``size`` more ids go to."""
        n, top = self.count, self.width - size
        after = 2 * n[size:size + top + 1] + 1          # a window more at level + size
        after[top] = 0                                  # full windows aren't counted
        cost = after + 1 - 2 * n[:top + 1]              # a window less at the level
        cost[1:][n[1:top + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = after[0]
        return top - int(np.argmin(cost[::-1]))

    def add(self, key, ids: np.ndarray) -> None:
        total, whole = len(ids), len(ids) // self.width * self.width
        for at in range(0, whole, self.width):
            self._close([(key, at, ids[at:at + self.width], total)])
        if whole == total:
            return
        piece = (key, whole, ids[whole:], total)
        level = self._level(total - whole)
        pieces = [*self.open[level].pop(), piece] if level else [piece]
        if level:
            self.count[level] -= 1
            self.n_open -= 1
        level += total - whole
        if level == self.width:
            self._close(pieces)
            return
        self.open[level].append(pieces)
        self.count[level] += 1
        self.n_open += 1
        if self.n_open > self.open_limit:
            self._pour(close_last=False)

    def _pour(self, close_last: bool) -> None:
        """Pour all open windows together, cutting pieces at window ends."""
        windows = [w for level in reversed(self.open) for w in level]
        self.count[:], self.open, self.n_open = 0, [[] for _ in range(self.width + 1)], 0
        head, tail = 0, len(windows)
        now, fill = [], 0
        spare: list = []                                # pieces of the emptiest windows
        while head < tail or spare:
            if not now and head < tail:                 # the fullest window that is left
                now, fill = windows[head], sum(len(p[2]) for p in windows[head])
                head += 1
            if not spare:
                if head == tail:
                    break
                tail -= 1
                spare = windows[tail][::-1]
            key, start, ids, total = spare.pop()
            room = self.width - fill
            now = [*now, (key, start, ids[:room], total)]
            fill += min(room, len(ids))
            if len(ids) > room:
                spare.append((key, start + room, ids[room:], total))
            if fill == self.width:
                self._close(now)
                now, fill = [], 0
        if now and close_last:
            self._close(now)
        elif now:
            self.open[fill].append(now)
            self.count[fill] += 1
            self.n_open += 1

    def finish(self) -> None:
        self._pour(close_last=True)

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pack(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
         width: int = 2048, open_limit: int = 2048) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``width`` ids.

    One row per piece: the id, ``start`` (ids of its document before it),
    ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens`` (with
    the ``end_id`` that closes each document), ``sequence_id``, ``offset``.
    Null and empty texts are a lone ``end_id``; rows with a null or repeated id
    are packed like others; an empty table gives no rows. Other columns aren't
    read. Partitions are packed apart, each in (id, text) order, so a repeated
    task packs alike.
    """
    key = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, key), *(T.StructField(n, t) for n, t in (
        ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()),
        ("sequence_id", T.LongType()), ("offset", T.LongType())))])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(width, TaskContext.get().partitionId() << 32, open_limit)
        encoder, types = _encoder(path), None

        def rows() -> Iterator[pa.RecordBatch]:
            got = packer.take()
            if got:
                columns = [pa.array(c, t) for c, t in zip(zip(*got), types)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            types = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
            held = 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py())
                packer.add(key, np.append(ids, np.uint32(end_id)))
                held += len(ids)
                if held > BATCH_IDS:
                    yield from rows()
                    held = 0
        packer.finish()
        yield from rows()

    return (docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
            .sortWithinPartitions(id_col, "text").mapInArrow(packed, schema))
