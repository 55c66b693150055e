"""License scan: MinHash bands over overlapping windows of text find templates; exact shingle containment decides.

Texts and templates are compared by words of ASCII letters and digits, in lower case, every run of digits as one number.
A template of n five-word shingles is looked for in windows of 1.25 n shingles (n if fewer than four) that start every n / 4
shingles, so an occurrence lies whole in one window. If a window contains SHARE (0.8) of the template, their
Jaccard similarity is 0.55 or more, and BANDS bands of ROWS rows miss it with probability
(1 - 0.55 ** 2) ** 20 = 0.0007; a whole occurrence (0.8) with 1e-9. Windows that agree in a band are verified exactly. Texts
are read whole; nothing is shuffled. The templates are a parameter that every task holds; their number is checked. Only templates
with SHARE of their shingles anywhere in a group of texts are looked for in its windows, as others can't be contained.

A name may have several texts; their finds are one name's finds. Since numbers are alike, a version is read after the match: ``{}`` in a
name becomes each version that the found span names (a row for each), and goes with its hyphen if there is none. SPDX lines are found by pattern.

Defined results: null and empty texts and texts below five words match nothing; overlapping finds of a name in a document are
one span with the highest containment; repeated rows are scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketlake.llm.shingles import _WORDS, grouped, mixed, word_hashes

BANDS, ROWS, WORDS, SHARE, MAX_TEMPLATES = 20, 2, 5, 0.8, 10_000

_WORD = re.compile(rb"[A-Za-z0-9]+")
_VERSION = re.compile(rb"(?<![A-Za-z0-9.])(?:[vV])?([0-9]{1,2}(?:\.[0-9]{1,2})*)(?![A-Za-z0-9])")
_ID = rb"\(*[A-Za-z][A-Za-z0-9.+-]*\)*"
_SPDX = re.compile(rb"SPDX-License-Identifier:[ \t]*(%b(?:[ \t]+(?:AND|OR|WITH)[ \t]+%b)*)" % (_ID, _ID))

#: The notices to look for if none are given. ``license_table.USUAL`` is the table of the registered query.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "CC-BY-NC notice": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c if 97 <= c <= 122 else 32 for c in range(256)
)


def plain(text: bytes) -> bytes:
    """Lower-case letters and numbers only; each number is one zero."""
    text = text.translate(_PLAIN)
    while b"00" in text:
        text = text.replace(b"00", b"0")
    return text


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word place of all texts the hash of the shingle from there, whether it lies in one text, and the text's index."""
    h, of = word_hashes([plain(t) for t in texts])
    n = max(0, len(h) - WORDS + 1)
    s = np.zeros(n, dtype=np.uint64)
    for k in range(WORDS):
        s = s * np.uint64(_WORDS) + h[k : k + n]
    return mixed(s), of[:n] == of[WORDS - 1 :], of


class Template:
    def __init__(self, name: str, text: str):
        s, _, _ = shingles([text.encode()])
        self.name, self.set = name, np.unique(s)
        n = len(self.set)
        if not n:
            raise ValueError(f"template {name} has fewer than {WORDS} words")
        self.window = n if n < 4 else -(-5 * n // 4)
        self.step = max(1, n // 4)


def _multipliers() -> np.ndarray:
    return mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def _hashed(s: np.ndarray, multiplier: np.uint64) -> np.ndarray:
    return ((s * multiplier) >> np.uint64(32)).astype(np.uint32)


def window_candidates(s: np.ndarray, templates: list[Template]) -> list[np.ndarray]:
    """For each template the starts of the windows that agree with it in a band."""
    hits = [np.zeros(max(0, -(-len(s) // t.step)), dtype=bool) for t in templates]
    agree: list[np.ndarray] = []
    for k, multiplier in enumerate(_multipliers()):
        value = _hashed(s, multiplier)
        least, width = {1: value}, 1
        while 2 * width <= max(t.window for t in templates):
            last = least[width]
            wider = last.copy()  # windows that reach behind the end have what is there
            wider[:-width] = np.minimum(last[:-width], last[width:])
            least[2 * width] = wider
            width *= 2
        for i, t in enumerate(templates):
            half = 1 << (t.window.bit_length() - 1)
            a = least[half]
            at = np.arange(0, len(s), t.step)
            low = np.minimum(a[at], a[np.minimum(at + t.window - half, len(s) - 1)])
            same = low == _hashed(t.set, multiplier).min()
            if k % ROWS == 0:
                agree.append(same)
            else:
                agree[i] &= same
        if k % ROWS == ROWS - 1:
            for hit, same in zip(hits, agree, strict=True):
                hit |= same
            agree = []
    return [np.flatnonzero(hit) * t.step for hit, t in zip(hits, templates, strict=True)]


def _present(known: np.ndarray, of: np.ndarray) -> int:
    """How many of ``of`` are among the ascending ``known``."""
    at = np.minimum(np.searchsorted(known, of), len(known) - 1)
    return int(np.count_nonzero(known[at] == of))


class Words:
    """Where the words of a text begin and end, found once and only if asked for."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def places(self) -> np.ndarray:
        return np.fromiter((x for m in _WORD.finditer(self.text) for x in m.span()), np.int64).reshape(-1, 2)

    def between(self, start: int, end: int) -> bytes:
        """The text of words ``start`` to ``end``."""
        return self.text[self.places[start, 0] : self.places[end - 1, 1]]

    def before(self, place: int) -> int:
        """How many words begin before a place of the text."""
        return int(np.searchsorted(self.places[:, 0], place))


def with_versions(words: Words, name: str, start: int, end: int) -> list[str]:
    """``name`` with each version that words ``start`` to ``end`` of the text name."""
    if "{}" not in name:
        return [name]
    found = _VERSION.findall(words.between(start, end))
    versions = sorted({v.decode() if b"." in v else f"{v.decode()}.0" for v in found})
    return [name.format(v) for v in versions] or [name.replace("-{}", "")]


def spdx_lines(words: Words) -> list[tuple[str, int, int]]:
    """(the license expression, first word, word behind the last) of each SPDX line."""
    out = []
    for m in _SPDX.finditer(words.text):
        start = words.before(m.start())
        out.append((m.group(1).decode(), start, start + len(_WORD.findall(m.group()))))
    return out


def found_in(texts: list[bytes], templates: list[Template]) -> list[tuple[int, str, int, int, float]]:
    """(index of the text, template, first word, word behind the last, containment)."""
    s, inside, of = shingles(texts)
    if not len(s):
        return []
    first_word = np.searchsorted(of, np.arange(len(texts)))
    safe = np.where(inside, s, np.uint64(0xFFFFFFFFFFFFFFFF))
    out = []
    known = np.unique(safe)
    templates = [t for t in templates if _present(known, t.set) >= SHARE * len(t.set)]
    if not templates:
        return []
    by_name: dict[str, dict[int, list[tuple[int, int, float]]]] = {}
    for t, starts in zip(templates, window_candidates(safe, templates), strict=True):
        spans = by_name.setdefault(t.name, {})
        for a in starts.tolist():
            b = min(a + t.window, len(s))
            at = a + np.flatnonzero(inside[a:b] & np.isin(s[a:b], t.set))
            for doc in np.unique(of[at]).tolist():
                own = at[of[at] == doc]
                share = len(np.unique(s[own])) / len(t.set)
                if share >= SHARE:
                    spans.setdefault(doc, []).append((int(own[0]), int(own[-1]) + WORDS, share))
    for name, spans in by_name.items():
        for doc, found in spans.items():
            merged: list[tuple[int, int, float]] = []
            for a, b, share in sorted(found):
                if merged and a < merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(b, merged[-1][1]), max(share, merged[-1][2]))
                else:
                    merged.append((a, b, share))
            base = int(first_word[doc])
            out += [(doc, name, a - base, b - base, share) for a, b, share in merged]
    return sorted(out)


def scan_licenses(
    docs: DataFrame, templates: dict[str, str | Sequence[str]] | None = None, id_col: str = "doc_id", text_col: str = "text", spdx: bool = False
) -> DataFrame:
    """``doc_id, license, start_word, end_word, containment`` of each notice found; words as the scan counts them."""
    given = TEMPLATES if templates is None else templates
    each = [(name, t) for name, texts in sorted(given.items()) for t in ([texts] if isinstance(texts, str) else texts)]
    if not 0 < len(each) <= MAX_TEMPLATES:
        raise ValueError(f"from 1 to {MAX_TEMPLATES} templates, got {len(each)}")
    ready = [Template(name, text) for name, text in each]
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, start = [], 0
            for texts in grouped(batch.column(1).cast(pa.large_binary()).to_pylist()):
                words = [Words(text) for text in texts]
                for doc, name, a, b, share in found_in(texts, ready):
                    rows += [(start + doc, label, a, b, share) for label in with_versions(words[doc], name, a, b)]
                if spdx:
                    rows += [(start + doc, f"SPDX {x}", a, b, 1.0) for doc, own in enumerate(words) for x, a, b in spdx_lines(own)]
                start += len(texts)
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.string()),
                    pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.float64()),
                ],
                names=["doc_id", "license", "start_word", "end_word", "containment"],
            )

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col]).mapInArrow(
        scan, f"doc_id {id_type}, license string, start_word long, end_word long, containment double"
    )
