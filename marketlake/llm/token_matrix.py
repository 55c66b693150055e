"""Packed token matrices: best-fit-decreasing over a segment tree of capacities.

Documents are tokenized where they are read and cut into pieces of at most ``capacity`` ids; nothing is lost. Pieces are dealt
over packing tasks by hash, each the ids of about BYTES_PER_TASK of text. A task places its pieces, longest first, into the
fullest row that has room: a segment tree over free capacities counts the open rows under each
node, and the smallest sufficient capacity is found by one descent. Rows are emitted as matrices' rows: ``ids``
(little-endian unsigned, 16 or 32 bits, padded), ``cu_seqlens`` (where segments start, and the end) and ``position_ids`` (little-endian
unsigned, as many as ``ids``; 16 bits up to a capacity of 65536, else 32), which start again at 0 with every segment.

Defined results: a null or empty text is one piece, the end id alone, and a table of any number of them is dealt over tasks by its
rows; a very long text is cut into pieces, and only its own pieces count; repeated rows are packed as often as they occur; pieces of
equal length are placed in the order in which they came, so rows may differ between runs, what they hold does not; padding is PAD_ID with
positions 0 and lies behind the last of ``cu_seqlens``; other columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import parts
from marketlake.llm.packing import CAPACITY, END_ID, token_pieces

BYTES_PER_TASK, PAD_ID = 16 << 20, 0
#: What a row costs a packing task beside its text, in bytes.
ROW_BYTES = 128


class CapacityTree:
    """Open rows by free capacity: counts in a segment tree, the rows themselves in lists."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        self._change(free, 1)

    def _change(self, free: int, by: int) -> None:
        node = free + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def best(self, length: int) -> int:
        """The smallest free capacity of at least ``length`` that an open row has, or -1."""
        node = length + self.leaves
        if self.count[node]:
            return length
        while node > 1 and (node & 1 or not self.count[node + 1]):
            node >>= 1
        if node <= 1:
            return -1
        node += 1
        while node < self.leaves:
            node *= 2
            if not self.count[node]:
                node += 1
        return node - self.leaves

    def take(self, free: int) -> int:
        self._change(free, -1)
        return self.rows[free].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of indexes of ``lengths``; no row's sum is above ``capacity``."""
    tree, rows = CapacityTree(capacity), []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        free = tree.best(lengths[k])
        if free < 0:
            row, free = len(rows), capacity
            rows.append([])
        else:
            row = tree.take(free)
        rows[row].append(k)
        if free > lengths[k]:
            tree.add(free - lengths[k], row)
    return rows


def packed_rows(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", id_bits: int = 16, end_id: int = END_ID) -> DataFrame:
    """``sequence_id, n_tokens, ids, position_ids, cu_seqlens, doc_ids, pieces, ids_crc32``: one row per row of the matrices."""
    stored_type = {16: "<u2", 32: "<u4"}[id_bits]
    tasks = parts(docs.agg(F.sum(F.coalesce(F.octet_length(docs[text_col]), F.lit(0)) + ROW_BYTES)).first()[0], BYTES_PER_TASK)
    pieces = token_pieces(docs, vocabulary, capacity, id_col, text_col, ids_as=stored_type, end_id=end_id).drop("ids_crc32")
    dealt = pieces.repartition(tasks, F.xxhash64("doc_id", "piece", F.crc32("ids"))).withColumn("task", F.spark_partition_id())
    id_type = pieces.schema["doc_id"].dataType.simpleString()
    schema = f"sequence_id long, n_tokens int, ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<{id_type}>, pieces array<int>, ids_crc32 long"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if held is None or not held.num_rows:
            return
        held = held.combine_chunks()
        lengths, ids = held.column("length").to_pylist(), held.column("ids").chunk(0)
        rows = best_fit_decreasing(lengths, capacity)
        first = held.column("task")[0].as_py() << 40
        for start in range(0, len(rows), 1024):
            some = rows[start : start + 1024]
            flat = [np.concatenate([np.frombuffer(ids[k].as_buffer(), stored_type) for k in row]) for row in some]
            matrix = [np.pad(f, (0, capacity - len(f)), constant_values=PAD_ID).tobytes() for f in flat]
            ends = [np.concatenate([[0], np.cumsum([lengths[k] for k in row])]) for row in some]
            members = pa.array([k for row in some for k in row], pa.int64())
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in some])]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([first + start + k for k in range(len(some))], pa.int64()), pa.array([len(f) for f in flat], pa.int32()),
                    pa.array(matrix, pa.binary()),
                    pa.array([position_ids(cu, capacity).tobytes() for cu in ends], pa.binary()),
                    pa.array([cu.tolist() for cu in ends], pa.list_(pa.int32())),
                    pa.ListArray.from_arrays(offsets, held.column("doc_id").chunk(0).take(members)),
                    pa.ListArray.from_arrays(offsets, held.column("piece").chunk(0).take(members)),
                    pa.array([zlib.crc32(f.astype("<u4").tobytes()) for f in flat], pa.int64()),
                ],
                names=["sequence_id", "n_tokens", "ids", "position_ids", "cu_seqlens", "doc_ids", "pieces", "ids_crc32"],
            )

    return dealt.select("task", "doc_id", "piece", "length", "ids").mapInArrow(pack, schema)


def position_type(capacity: int) -> str:
    return "<u2" if capacity <= 1 << 16 else "<u4"


def position_ids(cu_seqlens, capacity: int = CAPACITY) -> np.ndarray:
    """Positions of a row: from 0 in every segment, 0 in the padding."""
    starts, lengths = np.asarray(cu_seqlens[:-1]), np.diff(cu_seqlens)
    out = np.zeros(capacity, position_type(capacity))
    out[: cu_seqlens[-1]] = np.arange(cu_seqlens[-1]) - np.repeat(starts, lengths)
    return out


def write_matrices(packed: DataFrame, path: str) -> None:
    """The rows as Parquet files, sorted by sequence inside each: ``ids`` rows of equal size are one matrix when joined."""
    packed.sortWithinPartitions("sequence_id").write.mode("errorifexists").parquet(path)
