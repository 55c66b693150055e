"""Token ids of whole texts, by the ``tokenizers`` library with a memory of words.

The vocabulary of the packing operators drops white space and merges inside pre-tokens only, so the ids
of a text are the ids of its chunks between ASCII white space, one after the other. Texts are coded in groups of some
``GROUP_BYTES``, in which Arrow cuts the chunks and looks each different one up once. Chunks of plain Latin letters are cut by the
vocabulary's own pre-token rule and merged by the library; all others go through its whole chain. A worker
remembers the ids of some ``MEMORY`` pre-tokens, and of as many other chunks, as bytes: those that were used last. The library starts no
threads of its own unless TOKENIZERS_PARALLELISM asks for them: a task has one core, and each thread keeps memory.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMORY = 160_000
GROUP_BYTES = 1 << 23
#: Fixed: the pre-token rule of the vocabulary for lower-case text below U+0100, as letters, numbers and the rest.
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼-¾ ]+| ")
#: A character that the rule isn't for: all but the printable ones below U+0100.
_ODD = "[^ -~\u00a1-\u00ff]"


def coder(path: str) -> Ids | RankIds:
    """The worker's coder of a vocabulary; it outlives the task, so later tasks know the words of earlier ones."""
    held = vars(sys.modules.setdefault("llm_worker_memory", types.ModuleType("llm_worker_memory")))
    if path not in held:
        held[path] = RankIds(path) if path.endswith(".tiktoken") else Ids(path)
    return held[path]


class Memory(dict):
    """Ids by chunk; looking up an unknown chunk gives None and notes it in ``lack``.

    ``age`` keeps what is in for one more round only; a chunk that is looked up meanwhile comes back.
    """

    def __init__(self, fixed: dict | None = None):
        self.fixed = fixed or {}
        super().__init__(self.fixed)
        self.lack: list = []
        self.old: dict = {}

    def __missing__(self, chunk) -> bytes | None:
        ids = self.old.get(chunk)
        if ids is None:
            self.lack.append(chunk)
        else:
            self[chunk] = ids
        return ids

    def age(self) -> None:
        self.old = self.copy()
        self.clear()
        self.update(self.fixed)


class RankIds:
    """``RankIds(path)(texts)``: the same for a file of merge ranks, whole texts by the ``tiktoken`` library."""

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: Iterable[bytes | None]) -> Iterator[bytes]:
        for text in texts:
            yield np.asarray(self.encoding.encode_ordinary((text or b"").decode()), dtype="<u4").tobytes()


class Ids:
    """``Ids(path)(texts)``: little-endian uint32 ids of each text (UTF-8 bytes; None counts as empty)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        spec = json.loads(self.whole.to_str())
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        spec |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.merges = Tokenizer.from_str(json.dumps(spec))
        vocabulary, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a pre-token
        self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.letters = byte_letters()
        self.odd = Memory()
        self.pieces = Memory({" ": b""})

    def __call__(self, texts: Iterable[bytes | None]) -> Iterator[bytes]:
        group: list[bytes] = []
        size = 0
        for text in texts:
            group.append(text or b"")
            size += len(group[-1])
            if size > GROUP_BYTES:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[bytes]) -> Iterator[bytes]:
        whole = {k for k, t in enumerate(texts) if any(s in t for s in self.special)}
        rest = pa.array([b"" if k in whole else t for k, t in enumerate(texts)], pa.large_binary()).view(pa.large_string())
        chunks = pc.ascii_split_whitespace(pc.ascii_lower(rest))
        coded = chunks.flatten().dictionary_encode()  # each chunk of the group is looked up once
        offsets, data = _content(self._learn(coded.dictionary).take(coded.indices))
        ends = offsets[np.asarray(chunks.offsets)].tolist()
        for memory in (self.odd, self.pieces):
            if len(memory) > MEMORY // 2:
                memory.age()
        for k, text in enumerate(texts):
            yield self._encode(text.decode()) if k in whole else data[ends[k] : ends[k + 1]].tobytes()

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, chunks: pa.Array) -> pa.Array:
        """Ids of each of the different chunks."""
        plain = chunks
        is_odd = pc.match_substring_regex(chunks, _ODD)
        odd = chunks.filter(is_odd).cast(pa.large_binary()).to_pylist()
        if odd:
            plain = pc.if_else(is_odd, "", chunks)
        ids = self._learn_plain(plain.to_pylist())
        if not odd:
            return ids
        found = list(map(self.odd.__getitem__, odd))
        lack = self.odd.lack
        self.odd.update((c, self._encode(c.decode())) for c in lack)
        lack.clear()
        found = [self.odd[c] if i is None else i for c, i in zip(odd, found, strict=True)]
        return pc.replace_with_mask(ids, is_odd, pa.array(found, pa.large_binary()))

    def _learn_plain(self, chunks: list[str]) -> pa.Array:
        """Ids of chunks of printable characters below U+0100: of their pre-tokens, one after the other."""
        cut = pa.array(_PIECE.findall(" ".join(chunks).lower()), pa.large_string()).dictionary_encode()  # a space between two chunks
        pieces = cut.dictionary.to_pylist()
        found = list(map(self.pieces.__getitem__, pieces))
        lack = self.pieces.lack
        if lack:
            self._merge(lack)
            lack.clear()
            found = [self.pieces[p] if i is None else i for p, i in zip(pieces, found, strict=True)]
        offsets, data = _content(pa.array(found, pa.large_binary()).take(cut.indices))
        breaks = np.flatnonzero(cut.indices.to_numpy() == pieces.index(" ")) if len(chunks) > 1 else []
        ends = np.concatenate([offsets[:1], offsets[breaks], offsets[-1:]]).astype(np.int64)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(ends), pa.py_buffer(data)])

    def _merge(self, lack: list[str]) -> None:
        """Ids of new pieces."""
        spelled = " ".join(lack).encode().decode("latin-1").translate(self.letters).split(" ")
        lines = [" ".join(spelled[i : i + 2000]) for i in range(0, len(spelled), 2000)]
        coded = self.merges.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.asarray(e.ids, dtype="<u4") for e in coded])
        ends = [0, *(4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()]
        data = ids.tobytes()
        self.pieces.update((p, data[i:j]) for p, i, j in zip(lack, ends[:-1], ends[1:], strict=True))


def _content(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the values of a large binary array without nulls lie in its bytes (one more than values), and the bytes."""
    _, offsets, data = ids.buffers()
    places = np.frombuffer(offsets, np.int64)[ids.offset : ids.offset + len(ids) + 1] if offsets and offsets.size else np.zeros(1, np.int64)
    return places, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def byte_letters() -> dict[int, int]:
    """The printable letter that byte-level vocabularies write for each byte: itself if printable, else 256 on.

    The space stays, as it parts the words here.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {0x20: 0x20} | {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others) if b != 0x20}
