"""Leaf blocks of a web page: runs of text between block-level tags, with their tag paths, read in one pass over the html.

The scanner bears unclosed and stray tags: a closing tag without an open one is ignored, ``p`` and ``li`` end where the next begins, an
unclosed comment, script or style reaches to the end. Its time is linear in the page.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import lru_cache
from html import unescape

import numpy as np

#: Elements whose content is no text of the page.
RAW = frozenset("script style title textarea iframe template noembed noframes xmp select svg math object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that don't end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset(f"h{k}" for k in range(1, 7))
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
LOOSE_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*+)([^>]*+)>")
HINTS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
HINT_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
TOKEN = re.compile(r"[^\W\d_]+|\d+|©")
TAG_BINS, WORD_BINS = 256, 128
DENSE = 15
INPUTS = TAG_BINS + WORD_BINS + DENSE


@lru_cache(maxsize=65536)
def _bin(token: str, bins: int) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % bins


class _Bins(dict):
    """The bin of each word, remembered for short words up to a bound."""

    def __missing__(self, word: str) -> int:
        found = zlib.crc32(word.encode("utf-8", "replace")) % WORD_BINS
        if len(word) < 40:
            if len(self) >= 200_000:
                self.clear()
            self[word] = found
        return found


_WORD_BIN = _Bins()


@lru_cache(maxsize=65536)
def _own_bits(tag: str, attributes: str) -> int:
    """The bins of an element's name and of the words of its class, id and role, as bits."""
    bits = 1 << _bin(f"<{tag}", TAG_BINS)
    for found in HINTS.finditer(attributes):
        for word in HINT_WORD.findall("".join(filter(None, found.groups()))):
            bits |= 1 << _bin(f".{word.lower()}", TAG_BINS)
    return bits


class Blocks:
    """``texts`` (white space collapsed, character references decoded), and for each its path's bins, leaf, depth and share of linked text."""

    def __init__(self, html: str):
        self.texts: list[str] = []
        self.paths: list[int] = []
        self.leaves: list[str] = []
        self.depths: list[int] = []
        self.linked: list[float] = []
        self._stack: list[tuple[str, int]] = []
        self._open: Counter = Counter()
        self._pieces: list[str] = []
        self._link_chars = self._chars = 0
        self._begun: tuple[int, str, int] | None = None
        self._read(html)

    def _text(self, piece: str) -> None:
        self._pieces.append(piece)
        if not piece.isspace():
            self._chars += len(piece)
            self._link_chars += len(piece) if self._open["a"] else 0
            if self._begun is None:
                tag, bits = self._stack[-1] if self._stack else ("", 0)
                self._begun = (bits, tag, len(self._stack))

    def _flush(self) -> None:
        if self._begun:
            text = " ".join(unescape("".join(self._pieces)).split())
            if text:
                bits, leaf, depth = self._begun
                self.texts.append(text)
                self.paths.append(bits)
                self.leaves.append(leaf)
                self.depths.append(depth)
                self.linked.append(self._link_chars / max(1, self._chars))
        self._pieces, self._begun, self._chars, self._link_chars = [], None, 0, 0

    def _pop_to(self, tag: str) -> None:
        while self._stack:
            last, _ = self._stack.pop()
            self._open[last] -= 1
            if last == tag:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._text(" ")
            return
        if tag not in INLINE:
            self._flush()
            if self._open["p"]:
                self._pop_to("p")
            if tag == "li":
                for last, _ in reversed(self._stack):
                    if last in ("ul", "ol", "menu"):
                        break
                    if last == "li":
                        self._pop_to("li")
                        break
        if tag not in VOID:
            above = self._stack[-1][1] if self._stack else 0
            self._stack.append((tag, above | _own_bits(tag, attributes if len(attributes) < 1000 else "")))
            self._open[tag] += 1

    def _end(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        if self._open[tag]:
            self._pop_to(tag)

    def _read(self, html: str) -> None:
        at, n, lower = 0, len(html), None
        quotes_close = True  # once a quote is found open to the end of the page, quotes no longer count
        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                self._text(html[at:])
                break
            if lt > at:
                self._text(html[at:lt])
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 2)
                at = n if end < 0 else end + 3
                continue
            if html.startswith(("<!", "<?"), lt):
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
                continue
            found = None
            if html[lt + 1 : lt + 3].lstrip("/")[:1].isalpha():
                found = TAG.match(html, lt) if quotes_close else None
                if not found:
                    found = LOOSE_TAG.match(html, lt)
                    quotes_close = False
                if not found:  # no tag ends after this place
                    self._text(html[lt:])
                    break
            if not found:
                self._text("<")
                at = lt + 1
                continue
            tag, at = found[1].lower(), found.end()
            if html[lt + 1] == "/":
                self._end(tag)
            elif tag in RAW:
                if tag not in INLINE:
                    self._flush()
                if html[at - 2] != "/":
                    lower = html.lower() if lower is None else lower
                    end = lower.find(f"</{tag}", at) if len(lower) == n else html.find(f"</{tag}", at)
                    at = n if end < 0 else end
                    if end >= 0:
                        close = html.find(">", end)
                        at = n if close < 0 else close + 1
            else:
                self._start(tag, found[2])
        self._flush()


def features(blocks: Blocks, start: int = 0, end: int | None = None) -> np.ndarray:
    """One row of INPUTS per block from ``start`` to ``end``: path bins, shares of hashed words, and measures of text and place."""
    total = len(blocks.texts)
    span = range(start, total if end is None else min(end, total))
    out = np.zeros((len(span), INPUTS), np.float32)
    if not len(span):
        return out
    width = TAG_BINS // 8
    raw = b"".join(blocks.paths[k].to_bytes(width, "little") for k in span)
    out[:, :TAG_BINS] = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, width), axis=1)
    dense = out[:, TAG_BINS + WORD_BINS :]
    at: list[int] = []
    for row, k in enumerate(span):
        text = blocks.texts[k]
        found = TOKEN.findall(text.lower())
        words = len(found)
        at += [row * WORD_BINS + _WORD_BIN[word] for word in found]
        chars, leaf = len(text), blocks.leaves[k]
        dense[row] = (
            np.log1p(chars) / 5, np.log1p(words) / 4, blocks.linked[k], sum(map(text.count, ".,;:!?")) / chars,
            min(1.0, chars / max(1, words) / 20), text[-1] in ".!?…\"”»", "©" in text, text[:1].isupper(),
            k / total, np.log1p(k) / 5, np.log1p(total - 1 - k) / 5, min(3.0, np.log1p(blocks.depths[k])) / 3,
            leaf in HEADINGS, leaf in ("li", "a"), leaf == "p",
        )
    counts = np.bincount(np.asarray(at, np.int64), minlength=len(span) * WORD_BINS).reshape(len(span), WORD_BINS)
    out[:, TAG_BINS : TAG_BINS + WORD_BINS] = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
    return out
