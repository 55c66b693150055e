"""Bounded-space online best-fit packing of token pieces into sequences.

Documents are tokenized where they are read. Only lengths and checksums (or, on request, the ids) are
dealt over tasks by hash; each task packs its pieces as they come, with a fixed number of open bins.
The bins are kept in one integer used as a bitset: bit ``f`` is set if an open bin has ``f`` tokens free.
The best bin for a piece is the lowest set bit at or above its length. When no open bin fits and
all are open, the fullest (the lowest set bit) closes. A task's memory is the open bins and one batch.

Defined results: a null or empty text is one piece, the end id alone; a document of ``capacity``
tokens at most is never cut, a longer one into pieces of ``capacity``, the last may be shorter; repeated
rows are packed as often as they occur; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import parts, stored, tidy_task
from marketlake.llm.tokens import coder

CAPACITY, OPEN_BINS, PIECES_PER_TASK, END_ID = 4096, 256, 25_000, 1
ROWS_AT_ONCE = 256  # of a batch, as Python's own texts


class OpenBins:
    """Online best-fit with at most ``limit`` open bins of ``capacity``; ``place`` gives (bin, offset)."""

    def __init__(self, capacity: int = CAPACITY, limit: int = OPEN_BINS):
        self.capacity, self.limit = capacity, limit
        self.free_bits = 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.made = 0

    def _lowest(self, at_least: int) -> int:
        bits = self.free_bits >> at_least
        return at_least + (bits & -bits).bit_length() - 1 if bits else -1

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        if len(bins) == 1:
            self.free_bits ^= 1 << free
        self.open -= 1
        return bins.pop()

    def place(self, length: int) -> tuple[int, int]:
        free = self._lowest(length)
        if free >= 0:
            found = self._take(free)
        else:
            if self.open >= self.limit:
                self._take(self._lowest(0))
            found, free = self.made, self.capacity
            self.made += 1
        left = free - length
        if left:
            if not self.by_free[left]:
                self.free_bits |= 1 << left
            self.by_free[left].append(found)
            self.open += 1
        return found, self.capacity - free


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", ids_as: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (of uint32) of each piece, with ``ids`` as little-endian ``<u2`` or ``<u4`` on request."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * bool(ids_as)
    size, end = 4 * capacity, end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = coder(vocabulary)
            rows: list[list] = [[] for _ in range(5)]
            source = []
            for k, ids in enumerate(known(_texts(batch.column(1)))):
                ids += end
                for piece, at in enumerate(range(0, len(ids), size)):
                    part = ids[at : at + size]
                    source.append(k)
                    for column, value in zip(rows, (piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=False):
                        column.append(value)
                    if ids_as:
                        rows[4].append(_narrow(part, ids_as))
            columns = [
                batch.column(0).take(pa.array(source, pa.int64())), pa.array(rows[0], pa.int32()),
                *[pa.array(c, pa.int64()) for c in rows[1:4]],
            ]
            if ids_as:
                columns.append(pa.array(rows[4], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(tidy_task(cut), schema)


def _texts(column: pa.Array) -> Iterator[bytes | None]:
    for at in range(0, len(column), ROWS_AT_ONCE):
        yield from column.slice(at, ROWS_AT_ONCE).cast(pa.large_binary()).to_pylist()


def _narrow(ids: bytes, to: str) -> bytes:
    if to == "<u4":
        return ids
    wide = np.frombuffer(ids, "<u4")
    if wide.max(initial=0) >= 1 << 16:
        raise ValueError("the vocabulary has ids that 16 bits do not hold; use 32")
    return wide.astype(to).tobytes()


def pack_best_fit(
    pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, pieces_per_task: int = PIECES_PER_TASK
) -> DataFrame:
    """``pieces`` (any columns, with ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Sequences of different tasks have different ids. ``pieces`` should be stored: it is counted first.
    """
    tasks = parts(pieces.count(), pieces_per_task)
    columns = pieces.columns
    order = F.xxhash64(*[c for c in columns if c != "ids"])
    dealt = (
        pieces.withColumn("__order", order)
        .repartition(tasks, F.pmod(F.col("__order"), F.lit(1 << 30)))
        .withColumn("__task", F.spark_partition_id())
        .sortWithinPartitions("__order")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins)
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            first = batch.column("__task")[0].as_py() << 40 if placed else 0
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array([first + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                names=[*columns, "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.mapInArrow(tidy_task(pack), f"{fields}, sequence_id long, `offset` long")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """The pieces of all documents with their place: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack_best_fit(stored(token_pieces(docs, vocabulary, capacity)), capacity, open_bins)
