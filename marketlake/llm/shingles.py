"""Hashed word shingles of many texts at once, in numpy. Hashes depend on the text alone, not on the process."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Odd multipliers: the base of the byte polynomial and its inverse modulo 2**64, and the base over words.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORDS = 0xC2B2AE3D27D4EB4F
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def grouped(texts: Iterable[bytes | None], size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Texts in groups of about ``size`` bytes, in order; a longer text is a group by itself."""
    group: list[bytes] = []
    held = 0
    for text in texts:
        text = text or b""
        if group and held + len(text) > size:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of every text, and the index of its text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    edge = np.diff(np.concatenate([[True], _IS_SPACE[data]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, len(data))[starts])
    last = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(last, starts, side="right")


def shingle_elements(texts: list[bytes], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Elements of weight one: (hash of the shingle and of how often it came before in its text, index of the text).

    Sorted by text. A text of fewer words than a shingle has one shingle of all its words.
    """
    h, of = word_hashes(texts)
    n = max(0, len(h) - words + 1)
    s = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        s = s * np.uint64(_WORDS) + h[k : k + n]
    whole = of[:n] == of[words - 1 :]
    s, doc = s[whole], of[:n][whole]
    count = np.bincount(of, minlength=len(texts))
    for short in np.flatnonzero((count > 0) & (count < words)):
        own = np.full(1, count[short], dtype=np.uint64)
        for x in h[of == short]:
            own = own * np.uint64(_WORDS) + x
        s, doc = np.append(s, own), np.append(doc, short)
    order = np.lexsort((s, doc))
    s, doc = mixed(s[order]), doc[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    at = np.arange(len(s))
    again = at - np.maximum.accumulate(np.where(new, at, 0))
    return mixed(s + again.astype(np.uint64) * np.uint64(_BASE)), doc
