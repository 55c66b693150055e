"""Operators on one very long text: the time grows with its length."""

import random
import time

from llm_cases import prose

from marketlake.llm import license_table, licenses


def bundle(parts):
    rng = random.Random(9)
    one = prose(rng, 120)
    notice = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
    return "\n".join(f"{one}\n{notice}\nSPDX-License-Identifier: MIT\n" for _ in range(parts)).encode()


def scanned(text):
    given = license_table.USUAL
    ready = [licenses.Template(n, t) for n, ts in sorted(given.items()) for t in ([ts] if isinstance(ts, str) else ts)]
    words = licenses.Words(text)
    found = [(label, a, b) for _, n, a, b, _ in licenses.found_in([text], ready) for label in licenses.with_versions(words, n, a, b)]
    return found, licenses.spdx_lines(words)


def test_ten_megabytes_of_notices():
    text = bundle(10_000)
    assert len(text) > 9_000_000
    began = time.time()
    found, lines = scanned(text)
    assert time.time() - began < 60
    apache = [x for x in found if "apache" in x[0].lower()]
    assert len(apache) == 10_000 and len(lines) == 10_000 and {x[0] for x in lines} == {"MIT"}
    few, few_lines = scanned(bundle(3))
    assert [x for x in apache[:3]] == [x for x in few if "apache" in x[0].lower()] and lines[:3] == few_lines
