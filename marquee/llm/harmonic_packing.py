"""Harmonic packing of tokenized documents into sequences of fixed capacity.

A piece longer than C/(k+1) and at most C/k tokens is of class k, and a bin of
class k takes exactly k pieces.  Documents may be cut: full capacities are cut
off first, and a rest that would fill less than ``MIN_FILL`` of its class's
slot gives up a piece of C/(k+1), which fills a slot of class k+1, until what
is left fits well.  Pieces below the last class are packed by next fit, and so
are, when a worker ends, the pieces in its unfinished bins.  Every worker
(Spark task) has its own bins and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches
from .subwords import subwords

CAPACITY = 1024
CLASSES = 64
MIN_FILL = 0.95
END_ID = 0
#: Sequences a task may number.
PER_TASK = 1 << 40
#: Pieces sent back to Spark at a time; at most 4 KiB each at the default capacity.
BATCH_PIECES = 2000

SCHEMA = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"
Piece = tuple[object, int, bytes, int]  # document, start, ids, the document's tokens


class Bins:
    """One worker's bins; ``closed`` gets (sequence, offset, piece)."""

    def __init__(self, first: int, capacity: int, classes: int, min_fill: float):
        self.next, self.capacity, self.classes, self.min_fill = first, capacity, classes, min_fill
        self.open: dict[int, list[Piece]] = {}
        self.small: list[Piece] = []
        self.small_tokens = 0
        self.closed: list[tuple[int, int, Piece]] = []

    def add(self, doc, ids: bytes) -> None:
        total, start, cap = len(ids) // 4, 0, self.capacity
        while start < total:
            rest = total - start
            k = max(1, cap // rest)
            if rest >= cap:
                take = cap
            elif k >= self.classes:
                take = rest
            elif rest * k < self.min_fill * cap:
                k += 1
                take = cap // k
            else:
                take = rest
            piece = (doc, start, ids[4 * start : 4 * (start + take)], total)
            start += take
            if k >= self.classes:
                self.small.append(piece)
                self.small_tokens += take
                if self.small_tokens >= cap:
                    self._next_fit(last=False)
            else:
                bin_ = self.open.setdefault(k, [])
                bin_.append(piece)
                if len(bin_) == k:
                    self._close(self.open.pop(k))

    def _close(self, pieces: Iterable[Piece]) -> None:
        offset = 0
        for piece in pieces:
            self.closed.append((self.next, offset, piece))
            offset += len(piece[2]) // 4
        self.next += 1

    def _next_fit(self, last: bool) -> None:
        """Fill sequences with the small pieces, cut where one is full.

        The last tokens make sequences of falling powers of two, which need no padding.
        """
        pieces, self.small = self.small[::-1], []
        left = self.small_tokens
        while left >= self.capacity or (last and left):
            room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            left -= room
            bin_ = []
            while room:
                doc, start, ids, total = pieces.pop()
                if len(ids) > 4 * room:
                    pieces.append((doc, start + room, ids[4 * room :], total))
                    ids = ids[: 4 * room]
                bin_.append((doc, start, ids, total))
                room -= len(ids) // 4
            self._close(bin_)
        self.small, self.small_tokens = pieces[::-1], left

    def finish(self) -> None:
        for k in sorted(self.open):
            for piece in self.open.pop(k):
                self.small.append(piece)
                self.small_tokens += len(piece[2]) // 4
        self._next_fit(last=True)


def pack(
    docs: DataFrame,
    tokenizer: str,
    pattern: str,
    doc: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    classes: int = CLASSES,
    min_fill: float = MIN_FILL,
) -> DataFrame:
    """Pieces of documents with their place: one row per piece.

    ``doc_id``, ``start`` (the document's tokens before it), ``ids`` (little-
    endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``.
    ``tokenizer`` is the path of a byte-level BPE file, which every executor
    must be able to open, ``pattern`` its split pattern.  Every document ends
    with id ``END_ID``.

    A null or empty text is that id alone.  Null ids stay null; repeated rows
    are packed each.  Other columns are ignored.  An empty table gives no rows.
    """
    if not 2 <= classes <= capacity:
        raise ValueError("classes must lie between 2 and the capacity")
    end = END_ID.to_bytes(4, "little")

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode = subwords(tokenizer, pattern)
        bins = Bins(TaskContext.get().partitionId() * PER_TASK, capacity, classes, min_fill)

        def out():
            rows, bins.closed = bins.closed, []
            for at in range(0, len(rows), BATCH_PIECES):
                part = rows[at : at + BATCH_PIECES]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p[0] for _, _, p in part], pa.int64()),
                        pa.array([p[1] for _, _, p in part], pa.int64()),
                        pa.array([p[2] for _, _, p in part], pa.binary()),
                        pa.array([p[3] for _, _, p in part], pa.int64()),
                        pa.array([s for s, _, _ in part], pa.int64()),
                        pa.array([o for _, o, _ in part], pa.int64()),
                    ],
                    names=["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"],
                )

        for batch in batches:
            for doc_id, one in zip(batch.column(0).to_pylist(), batch.column(1)):
                bins.add(doc_id, encode(one.as_py() or "") + end)
                if len(bins.closed) >= BATCH_PIECES:
                    yield from out()
        bins.finish()
        yield from out()

    bound_batches(docs.sparkSession)
    chosen = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(work, SCHEMA)
