"""Removal of long strings that an earlier document has, by blockwise suffix sorting with a cover sample.

A string of ``LENGTH`` bytes (50) that also starts in a document with a smaller id is removed wherever it lies.
All suffixes can't be sorted at once, nor can a task hold the text they point into. So:

* Texts are stored in blocks of a few MB.
* The cover sample: of any LENGTH consecutive bytes, the GRAM-byte substring with the least hash. Like a difference
  cover modulo v, it gives any two equal strings a sample at one common offset; unlike it, it needs
  one sample for a string and not one for each residue of the other string, and a string goes to one bucket only.
* Samples that no second document has are found first, by hash, in buckets, with one bit per sample as the answer.
  Their suffixes can't match and go no further.
* The others' contexts (all the suffixes that a sample covers: some 63 bytes for 13 of them) are dealt to buckets
  by the sample's hash. Each task sorts one bucket. Equal contexts are settled as a whole; where a
  sample has different contexts, their suffixes are sorted by the first 32 bytes, and ties by the ranks of a difference cover
  modulo 7 of the contexts' positions, ranked beforehand for the bucket, and their last 8 bytes. All comparisons are of bytes.
* A sample with more than HOT different contexts (a phrase below LENGTH bytes that many documents have between other
  neighbours) has too many for one bucket. Its strings are dealt by the hash of all their bytes instead, as only equal strings
  must meet: each block settles its own copies and sends one row, with the least id, for each string.
* The answer for a context is one bit for each of its suffixes; blocks turn these into removed bytes.

Memory is bounded by a block or a bucket: a bucket has some BUCKET_BYTES of text by average, and of one sample HOT contexts, those
of one block, or of one string a row per block. A task works on some AT_ONCE of these contexts at a time, sample by sample. Copies inside a block are settled there, so a passage that a third of
all documents have sends a block's worth of contexts, not a row for each document, to its bucket.

Defined results: null texts are empty; a null id counts as larger than all others, and rows with equal ids (or null) don't
remove each other; texts below LENGTH bytes stay; repeated strings inside one document stay;
an empty table gives an empty result. Ids must be integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import parts, shielded, stored, tidy_group, tidy_pair, tidy_task
from marketlake.llm.shingles import mixed

LENGTH, GRAM = 50, 24
SPAN = LENGTH - GRAM + 1  # samples that a string has; so many suffixes at most share one
WIDTH = 80  # a context's bytes, SPAN + LENGTH - 1, in whole words
BLOCK_BYTES, BUCKET_BYTES, CHUNK_BYTES = 8 << 20, 16 << 20, 1 << 18
COVER, CYCLE, FIRST, TAIL = (0, 1, 3), 7, 32, 18
HOT, SPREAD = 4096, 4  # contexts of a sample that go to one bucket; buckets of strings for each bucket of contexts
STRING_WORDS, PIECE = (*range(0, LENGTH - 7, 8), LENGTH - 8), 1 << 20
AT_ONCE = 1 << 15  # contexts or answers worked on at once; what is made of them takes some kB each
LINK = np.uint64(1 << 63)  # of a mask: the string is that at the place in the low 32 bits, whatever becomes of it
LEVEL = 5  # of compression of what is stored and shuffled
NO_ID = np.iinfo(np.int64).max
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


# --- blocks -----------------------------------------------------------------------------------------------------


def _blocks(text_at: int):
    """Rows to blocks: (bytes of text, the rows as a compressed Arrow stream)."""

    def pack(batches: list[pa.RecordBatch]) -> bytes:
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))
        with pa.ipc.new_stream(sink, batches[0].schema, options=options) as writer:
            for batch in batches:
                writer.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([size], pa.int64()), pa.array([pack(held)], pa.binary())], names=["bytes", "rows"])

        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
            start = 0
            for at in range(batch.num_rows):
                size += int(lengths[at])
                if size >= BLOCK_BYTES:
                    held.append(batch.slice(start, at + 1 - start))
                    yield done()
                    held, size, start = [], 0, at + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield done()

    return run


class Block:
    """The rows of a block and its texts one after the other, with the samples of all their strings."""

    def __init__(self, rows: bytes, id_col: str, text_col: str):
        self.table = pa.ipc.open_stream(rows).read_all().combine_chunks()
        texts = self.table.column(text_col).cast(pa.large_binary())
        texts = texts.chunk(0) if texts.num_chunks else pa.array([], pa.large_binary())
        lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.data = np.frombuffer(b"".join([t for t in texts.to_pylist() if t]) + bytes(WIDTH + 8), dtype=np.uint8)
        ids = self.table.column(id_col).cast(pa.int64())
        self.ids = pa.compute.fill_null(ids, NO_ID).to_numpy()

    def samples(self) -> tuple[np.ndarray, ...]:
        """For each run of strings with one sample: first string, number of strings, the sample's place and hash, the text's index."""
        found = [tuple(np.zeros(0, np.int64) for _ in range(3))]
        doc, last = 0, len(self.starts) - 1
        while doc < last:
            end = min(last, max(doc + 1, int(np.searchsorted(self.starts, self.starts[doc] + CHUNK_BYTES, side="right")) - 1))
            found.append(self._chunk(doc, end))
            doc = end
        first, count, place = (np.concatenate(x) for x in zip(*found, strict=True))
        words = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        h = np.zeros(len(place), np.uint64)
        for k in range(0, GRAM, 8):
            h = mixed(h + words[place + k])
        return first, count, place, h, np.searchsorted(self.starts, first, side="right") - 1

    def _chunk(self, doc: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = int(self.starts[doc]), int(self.starts[end])
        n = b - a
        if n < LENGTH:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        words = np.ndarray((n + GRAM - 8,), "<u8", self.data[a:], strides=(1,)).copy()
        x = words[:n] * _K[0] + words[8 : n + 8] * _K[1] + words[16 : n + 16] * _K[2]
        x ^= x >> np.uint64(32)
        x *= _K[3]
        key = (x & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        least = key
        for step in (1, 2, 4, 8):
            least = np.minimum(least[:-step], least[step:])
        least = np.minimum(least[: n - SPAN + 1], least[SPAN - 16 : SPAN - 16 + n - SPAN + 1])
        left = np.repeat(self.starts[doc + 1 : end + 1] - a, np.diff(self.starts[doc : end + 1])) - np.arange(n)
        at = np.flatnonzero(left[: len(least)] >= LENGTH)
        if not len(at):
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        place = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(at), dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (np.diff(at) > 1)
        run = np.flatnonzero(new)
        return at[run] + a, np.diff(np.append(run, len(at))), place[run] + a


# --- samples that a second document has -------------------------------------------------------------------------


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _short(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, without their low bits, and each hash's index among them."""
    return np.unique(h & ~np.uint64((1 << (64 - bits)) - 1), return_inverse=True)


def _coded(values: np.ndarray, bits: int) -> bytes:
    """Ascending hashes as steps of 32 bits, or as they are where a step is longer."""
    steps = np.diff(values >> np.uint64(64 - bits))
    if len(steps) and steps.max() >= 1 << 32:
        return b"\0" + values.tobytes()
    return b"\1" + values[:1].tobytes() + steps.astype(np.uint32).tobytes()


def _decoded(data: bytes, bits: int) -> np.ndarray:
    if data[0] == 0:
        return np.frombuffer(data, np.uint64, offset=1)
    first = np.frombuffer(data, np.uint64, count=1, offset=1)
    steps = np.frombuffer(data, np.uint32, offset=9).astype(np.uint64) << np.uint64(64 - bits)
    return np.cumsum(np.concatenate([first, steps]))


def _counted(block: Block, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct short hashes of a block's samples, and how many different contexts each has there."""
    first, count, place, h, _ = block.samples()
    values, index = _short(h, bits)
    counts = np.bincount(index, minlength=len(values))
    again = np.flatnonzero(counts[index] > 1)
    if len(again):
        content = np.empty(len(again), np.uint64)
        for a in range(0, len(again), AT_ONCE):
            some = again[a : a + AT_ONCE]
            rows = _padded(block.data, first[some], count[some] + LENGTH - 1)
            content[a : a + AT_ONCE] = _row_hash(rows, place[some] - first[some], count[some])
        order = np.lexsort((content, index[again]))
        group, content = index[again][order], content[order]
        new = np.append(True, (group[1:] != group[:-1]) | (content[1:] != content[:-1]))
        different = np.bincount(group[new], minlength=len(values))
        counts = np.where(different > 0, different, counts)
    return values, counts


def _several(counts: np.ndarray) -> bytes:
    """Places and values of the counts above one."""
    at = np.flatnonzero(counts > 1)
    return np.concatenate([at, counts[at]]).astype("<u4").tobytes()


def _sampled(id_col: str, text_col: str, buckets: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows in zip(batch.column("block").to_pylist(), batch.column("rows").to_pylist(), strict=True):
                values, counts = _counted(Block(rows, id_col, text_col), bits)
                to = _bucket(values, buckets)
                used, start = np.unique(to, return_index=True)
                pieces = [_coded(v, bits) for v in np.split(values, start[1:])] if len(used) else []
                more = [_several(c) for c in np.split(counts, start[1:])] if len(used) else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used, pa.int64()), pa.array([block] * len(used), pa.int64()), pa.array(pieces, pa.binary()),
                        pa.array(more, pa.binary()),
                    ],
                    names=["bucket", "block", "hashes", "counts"],
                )

    return run


def _shared(bits: int):
    def run(key, rows):
        lists = [_decoded(x, bits) for x in rows.column("hashes").to_pylist()]
        ordered = np.sort(np.concatenate(lists))
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        out, places = [], []
        contexts = np.zeros(len(twice), np.int64)
        for values, counts in zip(lists, rows.column("counts").to_pylist(), strict=True):
            at = np.searchsorted(twice, values)
            at[at == len(twice)] = 0
            known = twice[at] == values if len(twice) else np.zeros(len(values), bool)
            out.append(np.packbits(known).tobytes())
            number = np.ones(len(values), np.int64)
            several, value = np.frombuffer(counts, "<u4").reshape(2, -1)
            number[several] = value
            contexts[at[known]] += number[known]
        hot = twice[contexts > HOT]
        for values in lists:
            places.append(np.flatnonzero(np.isin(values, hot)).astype("<u4").tobytes() if len(hot) else b"")
        return pa.table({
            "block": rows.column("block"), "bucket": rows.column("bucket"), "bits": pa.array(out, pa.binary()), "hot": pa.array(places, pa.binary()),
        })

    return run


# --- contexts ---------------------------------------------------------------------------------------------------


def _padded(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A row of WIDTH bytes for each context, zero behind its end."""
    rows = np.lib.stride_tricks.sliding_window_view(data, WIDTH)[first]
    rows[np.arange(WIDTH, dtype=np.uint8) >= size.astype(np.uint8)[:, None]] = 0
    return rows


def _row_hash(rows: np.ndarray, *more: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(rows).view(np.uint64)
    h = np.zeros(len(rows), np.uint64)
    for column in (*words.T, *more):
        h = mixed(h + column.astype(np.uint64))
    return h


def _by_sample(h: np.ndarray) -> Iterator[np.ndarray]:
    """Places in ``h``, some AT_ONCE at a time in its order; the contexts of one sample stay together."""
    by = np.argsort(h, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(h[by])) + 1, len(h))  # of samples
    a = 0
    while a < len(h):
        k = np.searchsorted(ends, a + AT_ONCE, side="right") - 1
        b = int(ends[k]) if k >= 0 and ends[k] > a else int(ends[k + 1])
        yield by[a:b]
        a = b


def _equal_groups(h: np.ndarray, rows: np.ndarray, offset: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal contexts of a sample together, and where groups start in it. Equality is of bytes."""
    order = np.lexsort((_row_hash(rows, offset, count), h))
    new = np.ones(len(order), dtype=bool)
    a, b = order[1:], order[:-1]
    new[1:] = (h[a] != h[b]) | (offset[a] != offset[b]) | (count[a] != count[b]) | (rows[a] != rows[b]).any(axis=1)
    return order, np.flatnonzero(new)


def _group_min(ids: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each context the least id of its group."""
    least = np.minimum.reduceat(ids[order], starts) if len(starts) else ids[:0]
    out = np.empty_like(ids)
    out[order] = np.repeat(least, np.diff(np.append(starts, len(order))))
    return out


def _string_hash(words: np.ndarray, start: np.ndarray) -> np.ndarray:
    h = np.zeros(len(start), np.uint64)
    for k in STRING_WORDS:
        h = mixed(h + words[start + k])
    return h


def _equal_strings(words: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings the equal strings of LENGTH bytes at ``start`` together, and where groups start in it. Equality is of bytes."""
    h = _string_hash(words, start)
    order = np.argsort(h, kind="stable")
    keys = [words[start + k] for k in STRING_WORDS]
    same = _tied(keys, order)
    if (~same & _tied([h], order)).any():  # two strings with one hash may lie mixed
        order = np.lexsort(keys)
        same = _tied(keys, order)
    return order, np.flatnonzero(np.append(np.ones(min(1, len(start)), bool), ~same))


def _hot_strings(block: Block, first: np.ndarray, count: np.ndarray, ids: np.ndarray, buckets: int):
    """Of contexts dealt by string: what the block settles itself as places and masks, and by bucket one row for each string."""
    words = np.ndarray((len(block.data) - 7,), "<u8", block.data, strides=(1,))
    windows = np.lib.stride_tricks.sliding_window_view(block.data, LENGTH)
    own = np.repeat(np.arange(len(first), dtype=np.int32), count)
    start = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    h = _string_hash(words, start)
    pieces = _bucket(h, -(-len(h) // PIECE))  # so many strings at once
    places, masks, out = [], [], []
    for piece in range(-(-len(h) // PIECE)):
        some = np.flatnonzero(pieces == piece)
        if not len(some):
            continue
        order, starts = _equal_strings(words, start[some])
        some = some[order]
        at, of, size = start[some], ids[own[some]], np.diff(np.append(starts, len(some)))
        least = np.minimum.reduceat(of, starts)
        low = of == np.repeat(least, size)
        # the first of a string's places with the least id stands for the others
        lead = np.minimum.reduceat(np.where(low, np.arange(len(some)), len(some)), starts)
        leads = np.repeat(at[lead], size)
        linked = low & (at != leads)
        places += [at[~low], at[linked]]
        masks += [np.ones(np.count_nonzero(~low), np.uint64), LINK | leads[linked].astype(np.uint64)]
        to = buckets + _bucket(h[some[lead]], SPREAD * buckets)
        sent = np.argsort(to, kind="stable")
        for bucket, part in zip(*_split(to[sent], sent), strict=True):
            out.append((int(bucket), _payload(at[lead[part]], least[part], windows[at[lead[part]]].reshape(-1))))
    return np.concatenate(places), np.concatenate(masks), out


def _contexts(id_col: str, text_col: str, buckets: int, bits: int):
    """A block's answer to the bits: its contexts and strings by bucket, and in a bucket below 0 what it has settled itself."""

    def run(key, left, right):
        block = Block(left.column("rows")[0].as_py(), id_col, text_col)
        first, count, place, h, doc = block.samples()
        values, index = _short(h, bits)
        flags, hot = np.zeros((2, len(values)), dtype=bool)
        ends = np.searchsorted(_bucket(values, buckets), np.arange(buckets + 1))
        for bucket, data, places in zip(*(right.column(c).to_pylist() for c in ("bucket", "bits", "hot")), strict=True):
            a, b = ends[bucket], ends[bucket + 1]
            flags[a:b] = np.unpackbits(np.frombuffer(data, np.uint8), count=b - a)
            hot[a + np.frombuffer(places, "<u4").astype(np.int64)] = True
        pairs = np.unique(index * len(block.ids) + doc)
        flags |= np.bincount(pairs // max(1, len(block.ids)), minlength=len(values)) > 1
        keep = flags[index]
        hot = hot[index][keep]
        first, count, place, h, doc = (x[keep] for x in (first, count, place, h, doc))
        ids, offset, size = block.ids[doc], place - first, count + LENGTH - 1
        settled, split, out = np.zeros(len(h), dtype=bool), np.zeros(len(h), dtype=bool), []
        for some in _by_sample(h):
            rows = _padded(block.data, first[some], size[some])
            order, starts = _equal_groups(h[some], rows, offset[some], count[some])
            here = _group_min(ids[some], order, starts) < ids[some]
            settled[some], split[some] = here, ~here & hot[some]
            send = np.flatnonzero(~here & ~hot[some])
            for bucket, part in zip(*_split(_bucket(h[some[send]], buckets), send), strict=True):
                used, own = np.arange(WIDTH) < size[some[part]][:, None], some[part]
                out.append((int(bucket), key[0].as_py(), _payload(
                    first[own], h[own], ids[own], offset[own].astype(np.uint8), count[own].astype(np.uint8), rows[part][used],
                )))
        at, mask = first[settled], (np.uint64(1) << count[settled].astype(np.uint64)) - np.uint64(1)
        if split.any():
            more_at, more_mask, strings = _hot_strings(block, first[split], count[split], ids[split], buckets)
            at, mask = np.concatenate([at, more_at]), np.concatenate([mask, more_mask])
            out += [(bucket, key[0].as_py(), payload) for bucket, payload in strings]
        if len(at):
            out.append((-1 - key[0].as_py(), key[0].as_py(), _payload(at, mask)))
        return pa.table({
            "bucket": pa.array([x[0] for x in out], pa.int64()), "block": pa.array([x[1] for x in out], pa.int64()),
            "payload": pa.array([x[2] for x in out], pa.binary()),
        })

    return run


def _split(labels: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    used, start = np.unique(labels, return_index=True)
    return used, np.split(values, start[1:]) if len(used) else []


_TYPES = ("<u4", "<u8", "<i8", "u1", "u1", "u1")
_ANSWER, _STRINGS = ("<u4", "<u8"), ("<u4", "<i8", "u1")


def _payload(*columns: np.ndarray) -> bytes:
    types = {2: _ANSWER, 3: _STRINGS}.get(len(columns), _TYPES)
    n = len(columns[0])
    data = b"".join(np.ascontiguousarray(c.astype(t)).tobytes() for c, t in zip(columns, types, strict=True))
    return n.to_bytes(8, "little") + len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=LEVEL).compress(data, asbytes=True)


def _columns(payload: bytes, types: tuple[str, ...]) -> list[np.ndarray]:
    n, size = int.from_bytes(payload[:8], "little"), int.from_bytes(payload[8:16], "little")
    data = pa.decompress(payload[16:], decompressed_size=size, codec="zstd", asbytes=True)
    out, at = [], 0
    for k, t in enumerate(types):
        whole = k == len(types) - 1 and types != _ANSWER  # the contexts' or strings' bytes
        out.append(np.frombuffer(data, t, count=-1 if whole else n, offset=at))
        at += n * np.dtype(t).itemsize
    return out


# --- one bucket -------------------------------------------------------------------------------------------------


def _settled(buckets: int):
    """For each block's contexts and strings the bits of those that a document with a smaller id has too."""

    def run(key, rows):
        bucket = key[0].as_py()
        if bucket < 0:  # an answer already
            return rows.select(["block", "payload"])
        return _sort_bucket(rows) if bucket < buckets else _string_rows(rows)

    return run


def _string_rows(rows: pa.Table) -> pa.Table:
    got = [_columns(p, _STRINGS) for p in rows.column("payload").to_pylist()]
    part = np.repeat(np.arange(len(got)), [len(g[0]) for g in got])
    first, ids, flat = (np.concatenate(c) for c in zip(*got, strict=True))
    words = np.ndarray((len(flat) - 7,), "<u8", flat, strides=(1,))
    order, starts = _equal_strings(words, np.arange(len(first)) * LENGTH)
    removed = _group_min(ids, order, starts) < ids
    blocks, out = rows.column("block").to_pylist(), []
    for k, block in enumerate(blocks):
        own = first[(part == k) & removed]
        if len(own):
            out.append((block, _payload(own, np.ones(len(own), np.uint64))))
    return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), "payload": pa.array([x[1] for x in out], pa.binary())})


def _sort_bucket(rows: pa.Table) -> pa.Table:
    got = [_columns(p, _TYPES) for p in rows.column("payload").to_pylist()]
    part = np.repeat(np.arange(len(got)), [len(g[0]) for g in got])
    first, h, ids, offset, count, flat = (np.concatenate(c) for c in zip(*got, strict=True))
    begin = np.concatenate([[0], np.cumsum(count.astype(np.int64) + LENGTH - 1)[:-1]])
    text = np.concatenate([flat, np.zeros(WIDTH, np.uint8)])
    del got, flat
    mask = np.empty(len(h), np.uint64)
    for some in _by_sample(h):
        mask[some] = _masks(text, begin[some], h[some], ids[some], offset[some].astype(np.int64), count[some].astype(np.int64))
    blocks, out = rows.column("block").to_pylist(), []
    for k, block in enumerate(blocks):
        own = np.flatnonzero((part == k) & (mask != 0))
        if len(own):
            out.append((block, _payload(first[own], mask[own])))
    return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), "payload": pa.array([x[1] for x in out], pa.binary())})


def _masks(text: np.ndarray, begin: np.ndarray, h: np.ndarray, ids: np.ndarray, offset: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The bits of the contexts that begin at these places of ``text``; all of a sample's are there."""
    contexts = _padded(text, begin, count + LENGTH - 1)
    order, starts = _equal_groups(h, contexts, offset, count)
    least = _group_min(ids, order, starts)
    full = (np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)
    # one context of each group that others of its sample differ from
    lead = order[starts]
    different = np.flatnonzero(np.append(h[lead][1:] == h[lead][:-1], False) | np.append(False, h[lead][1:] == h[lead][:-1]))
    bits = np.zeros(len(lead), np.uint64)
    if len(different):
        some = lead[different]
        bits[different] = suffix_bits(contexts[some], h[some], offset[some], count[some], least[some])
    group = np.empty(len(order), np.int64)
    group[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    return np.where(least < ids, full, bits[group])


def suffix_bits(contexts: np.ndarray, h: np.ndarray, offset: np.ndarray, count: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of each context the suffixes (bit j: the string of LENGTH bytes from byte j) that one with a smaller id has at the same place from the sample."""
    own = np.repeat(np.arange(len(contexts)), count)
    at = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    flat = np.concatenate([contexts.reshape(-1), np.zeros(WIDTH, np.uint8)])
    words = np.ndarray((len(flat) - 7,), "<u8", flat, strides=(1,))
    start = own * WIDTH + at
    lead = [words[start + k] for k in range(0, FIRST, 8)]
    sample, place = np.unique(h, return_inverse=True)[1][own], at - offset[own]
    order = np.lexsort((*lead, place, sample))
    keys = [sample, place, *lead]
    tied = _tied(keys, order)
    # suffixes equal in FIRST bytes: the rank of the cover sample behind them, and the last bytes
    long = np.zeros(len(order), dtype=bool)
    long[1:] = tied
    long[:-1] |= tied
    group = np.zeros(len(order), np.int64)
    group[1:] = np.cumsum(~tied)
    ties, tie_group = order[long], group[long]
    rank = cover_ranks(contexts, offset)
    near = FIRST - CYCLE + 1 + at[ties]  # the first byte of the cycle of places that the sample is in
    step = _to_cover()[(near - offset[own[ties]]) % CYCLE]
    ranks = rank[own[ties], near + step]
    last = words[start[ties] + LENGTH - 8]
    inner = np.lexsort((last, ranks, tie_group))
    ties, tie_group, ranks, last = ties[inner], tie_group[inner], ranks[inner], last[inner]
    same = _tied([tie_group, ranks, last], np.arange(len(ties)))
    starts = np.flatnonzero(np.concatenate([[True], ~same])) if len(ties) else np.zeros(0, np.int64)
    least = _group_min(ids[own], ties, starts) if len(ties) else ids[own]
    removed = np.zeros(len(own), dtype=bool)
    removed[ties] = least[ties] < ids[own][ties]
    out = np.zeros(len(contexts), np.uint64)
    np.bitwise_or.at(out, own[removed], np.uint64(1) << at[removed].astype(np.uint64))
    return out


def _tied(keys: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Whether each but the first has the keys of the one before it."""
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    for k in keys:
        same &= k[order[1:]] == k[order[:-1]]
    return same


def _to_cover() -> np.ndarray:
    """From each residue the way to the next place of the difference cover."""
    return np.array([min((c - r) % CYCLE for c in COVER) for r in range(CYCLE)])


def cover_ranks(contexts: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """At each place that lies on the cover, counted from the context's sample, the rank of the TAIL bytes from there."""
    place = np.arange(WIDTH)
    on = np.isin((place[None, :] - offset[:, None]) % CYCLE, COVER) & (place <= WIDTH - TAIL)
    at = np.flatnonzero(on.reshape(-1))
    flat = contexts.reshape(-1)
    words = np.ndarray((len(flat) - 7,), "<u8", flat, strides=(1,))
    keys = [words[at], words[at + 8], words[at + TAIL - 8]]
    order = np.lexsort(keys)
    rank = np.zeros(len(at), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(~_tied(keys, order))]) if len(at) else 0
    out = np.zeros(on.shape, np.int64)
    out.reshape(-1)[at] = rank
    return out


# --- results ----------------------------------------------------------------------------------------------------


def _cut(id_col: str, text_col: str, columns: list[str]):
    """The rows of a block with what is left of their text, and what was removed."""

    def run(key, left, right):
        block = Block(left.column("rows")[0].as_py(), id_col, text_col)
        edge = np.zeros(len(block.data) + 1, np.int32)
        answered, links = np.zeros(len(block.data), dtype=bool), []
        for payload in right.column("payload").to_pylist():
            first, mask = _columns(payload, _ANSWER)
            linked = mask >= LINK
            if linked.any():
                links.append((first[linked].astype(np.int64), (mask[linked] ^ LINK).astype(np.int64)))
                first, mask = first[~linked], mask[~linked]
            for a in range(0, len(first), AT_ONCE):
                bits = np.unpackbits(mask[a : a + AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                row, j = np.nonzero(bits)
                start = first[a : a + AT_ONCE][row].astype(np.int64) + j
                np.add.at(edge, start, 1)
                np.add.at(edge, start + LENGTH, -1)
                answered[start] = True
        for at, lead in links:
            at = at[answered[lead]]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + LENGTH, -1)
        gone = np.cumsum(edge, dtype=np.int32)[:-1] > 0
        n = len(block.ids)
        left_text, removed, spans = [], np.zeros(n, np.int64), np.zeros(n, np.int64)
        for k in range(n):
            a, b = block.starts[k], block.starts[k + 1]
            cut = gone[a:b]
            removed[k] = np.count_nonzero(cut)
            spans[k] = np.count_nonzero(cut[1:] & ~cut[:-1]) + bool(len(cut) and cut[0])
            left_text.append(block.data[a:b][~cut].tobytes())
        table = block.table
        out = {c: table.column(c) for c in columns}
        out["__bytes"] = pa.array(np.diff(block.starts))
        out["__removed"], out["__spans"] = pa.array(removed), pa.array(spans)
        out["__sha256"] = pa.array([hashlib.sha256(t).hexdigest() for t in left_text], pa.string())
        if text_col in columns:
            whole = table.column(text_col).to_pylist()
            out[text_col] = pa.array(
                [old if not n else t.decode("utf-8", "ignore") for old, n, t in zip(whole, removed.tolist(), left_text, strict=True)], pa.string()
            )
        return pa.table(out)

    return run


def _removal(docs: DataFrame, id_col: str, text_col: str, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, the text without what is removed, and ``__bytes, __removed, __spans, __sha256``."""
    blocks = docs.mapInArrow(tidy_task(_blocks(docs.columns.index(text_col))), "bytes long, rows binary")
    blocks = stored(blocks.withColumn("block", F.monotonically_increasing_id()), codec="uncompressed")
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    buckets, bits = parts(total, BUCKET_BYTES), min(64, max(40, total.bit_length() + 12))
    args = (id_col, text_col, buckets, bits)
    hashes = blocks.select("block", "rows").mapInArrow(tidy_task(_sampled(*args)), "bucket long, block long, hashes binary, counts binary")
    shared = stored(hashes.groupBy("bucket").applyInArrow(tidy_group(_shared(bits)), "block long, bucket long, bits binary, hot binary"))
    by_block = blocks.select("block", "rows").groupBy("block")
    # blocks are shuffled once for both uses; contexts go from one shuffle to the next and are not stored
    contexts = by_block.cogroup(shared.groupBy("block")).applyInArrow(tidy_pair(_contexts(*args)), "bucket long, block long, payload binary")
    answers = contexts.groupBy("bucket").applyInArrow(tidy_group(_settled(buckets)), "block long, payload binary")
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    schema = ", ".join([*fields, "__bytes long", "__removed long", "__spans long", "__sha256 string"])
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(tidy_pair(_cut(id_col, text_col, columns)), schema)


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    found = _removal(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")), "doc_id", "text", ["doc_id"])
    return found.select(
        "doc_id", F.col("__bytes").alias("n_bytes"), F.col("__removed").alias("n_removed"), F.col("__spans").alias("n_spans"),
        F.col("__sha256").alias("kept_sha256"),
    )


def drop_repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated strings cut out of the text; bytes of a character that was cut in two go too."""
    inner, restore = shielded(docs, [id_col, text_col])
    return restore(_removal(inner, id_col, text_col, inner.columns))
