"""Spelling variants: words that differ by one code point, and the form that each of them is a variant of.

Two words at edit distance one have letter multisets at Hamming distance one (a code point more) or two (another one), the
multiset being a binary vector with one dimension for each letter and each time that it can occur. PartEnum finds all such vectors
by equality: the dimensions are dealt to PARTS parts by a hash; of two vectors at distance two at most, two parts at most differ,
so that the vectors agree in all of some PARTS - 2 parts. A word's signatures are its vector on each choice of
PARTS - 2 parts.

Anagrams agree in every signature, and there are more of them the more words there are. Each signature is therefore refined by
half of the word, which keeps it exact: cut the shorter word of a pair after half of its code points, then the
two words agree in what is before the cut, or in what is after it (counted from their ends). So a word has four halves: those before
and after its own cut, and those it would agree in with a word that is one shorter. Words that share a
refined signature are verified by their edit distance; no link is lost, and no group of equal signatures meets in one task other
than as a sorted join that adaptive execution can split.

No join of words is broadcast: Spark takes the size of a stored table for that of its rows, though the file is compressed and each
word gives 12 or 24 signatures, and would hold them all in the driver.

Defined results: a null or empty text has no words; a null id counts as the empty string; texts are read whole, however long, and a
run of letters of any length is one word; rows that repeat count each time; of near words with the same count the smallest in
code-point order is the form; an empty table gives an empty result. Other columns of the table are never read, so their names are free.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import stored

MIN_POINTS, MIN_COUNT, DELETE_EVERY, FORM_FACTOR = 5, 3, 97, 2
PARTS = 4
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 300_000
#: Every code point of a word is one byte of Latin-1, whose ``lower`` changes A-Z only; all other bytes become spaces.
LETTERS = bytes(range(ord("A"), ord("Z") + 1)) + bytes(range(ord("a"), ord("z") + 1)) + bytes(range(0xC0, 0x100))
SPACED = bytes(c if c in LETTERS else 0x20 for c in range(256)).lower()
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20
MASK, ODD = (1 << 64) - 1, 0x9E3779B97F4A7C15


def run_counts(text: str) -> Counter:
    """The lower-cased runs of letters of ``text`` as Latin-1, and how often they occur."""
    spaced, start, counts = text.encode("latin-1", "replace").translate(SPACED), 0, Counter()
    while start < len(spaced):
        end = len(spaced) if len(spaced) - start <= PIECE else spaced.find(b" ", start + PIECE)
        end = len(spaced) if end < 0 else end
        counts.update(spaced[start:end].split())
        start = end
    return counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, int] = {}

    def rows() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    crc32 = zlib.crc32
    for batch in batches:
        for doc, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
            doc_crc = crc32(f"{doc}:".encode())
            for word, n in run_counts(text.as_py() or "").items():
                if len(word) < MIN_POINTS:  # deleting makes it no longer
                    continue
                h = crc32(word if word.isascii() else word.decode("latin-1").encode(), doc_crc)
                if h % DELETE_EVERY == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < MIN_POINTS:
                        continue
                held[word] = held.get(word, 0) + n
            if len(held) >= HELD_WORDS:
                yield rows()
                held.clear()
    yield rows()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of the words with MIN_POINTS code points that occur MIN_COUNT times in all texts."""
    texts = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), docs[text_col].alias("text"))
    found = texts.mapInArrow(_counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _mixed(x: int) -> int:
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def multiset_parts(word: str) -> list[int]:
    """For each part, a 64-bit hash of the word's letter multiset on the part's dimensions."""
    sums, seen = [0] * PARTS, {}
    for letter in word:
        k = seen[letter] = seen.get(letter, 0) + 1
        h = _mixed((ord(letter) << 32 | k) * ODD & MASK)
        sums[h % PARTS] += _mixed(h)
    return [s & MASK for s in sums]


def half_hashes(word: str) -> list[int]:
    """Hashes of (side, length of the shorter word, half): before and after its own cut, then of the cut of a word one shorter."""
    out = []
    for shorter in (len(word), len(word) - 1):
        cut = shorter // 2
        for side, half in ((0, word[:cut]), (1, word[len(word) - (shorter - cut) :])):
            raw = half.encode()
            out.append(_mixed((zlib.crc32(raw, shorter & 0xFFFFFFFF) << 32 | zlib.crc32(raw, side + 1)) * ODD & MASK))
    return out


def signatures(words: list[str]) -> np.ndarray:
    """Refined signatures, one row per word: first those of its own cut, then as many of the cut of a word one shorter."""
    parts = np.array([multiset_parts(w) for w in words], np.uint64).reshape(-1, PARTS)
    halves = np.array([half_hashes(w) for w in words], np.uint64).reshape(-1, 4)
    chosen = []
    for k, choice in enumerate(combinations(range(PARTS), PARTS - 2)):
        key = np.full(len(words), _mixed(k + 1), np.uint64)
        for p in choice:
            key = (key ^ parts[:, p]) * np.uint64(ODD)
            key ^= key >> np.uint64(29)
        chosen.append(key)
    both = (halves[:, :, None] ^ np.stack(chosen, 1)[:, None, :]) * np.uint64(ODD)
    return (both ^ (both >> np.uint64(32))).reshape(len(words), -1).view(np.int64)


def _signed(own_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 8192):
                batch = whole.slice(start, 8192)
                keys = signatures(batch.column("word").to_pylist())
                keys = keys[:, : keys.shape[1] // 2] if own_only else keys
                at = pa.array(np.repeat(np.arange(batch.num_rows), keys.shape[1]))
                rows = [pa.array(keys.reshape(-1)), batch.column("word").take(at), batch.column("n").take(at)]
                yield pa.RecordBatch.from_arrays(rows, names=["key", "word", "n"])

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of words (unique, with n) that differ by one code point, once; a is not longer than b."""
    left = words.mapInArrow(_signed(True), "key long, word string, n long").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = words.mapInArrow(_signed(False), "key long, word string, n long").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    once = (F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    near = left.join(right.hint("merge"), "key").filter(once & (F.levenshtein("a", "b", 1) == 1))
    return near.select("a", "a_n", "b", "b_n").distinct()


def forms(words: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n`` of every word (unique, with n)."""
    pairs = stored(near_pairs(words))
    a, b = F.struct((-F.col("a_n")).alias("k"), F.col("a").alias("w")), F.struct((-F.col("b_n")).alias("k"), F.col("b").alias("w"))
    links = pairs.select(F.col("a").alias("of"), b.alias("near")).unionByName(pairs.select(F.col("b").alias("of"), a.alias("near")))
    best = links.groupBy("of").agg(F.count(F.lit(1)).alias("links"), F.min("near").alias("best"))
    found = words.join(best.hint("merge"), F.col("word") == F.col("of"), "left")
    takes = -F.col("best.k") >= FORM_FACTOR * F.col("n")
    return found.select(
        "word", "n", F.coalesce("links", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("best.w")).alias("form"), F.when(takes, -F.col("best.k")).alias("form_n"),
    )


def with_roots(found: DataFrame) -> DataFrame:
    """``found`` with ``root``: the last form that is reached from a word by following forms.

    A form has FORM_FACTOR times its word's n, so chains are short; each round doubles the steps taken, on the words with a form only.
    """
    roots = stored(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = roots.select(F.col("word").alias("at"), F.col("root").alias("onward"))
        moved = roots.join(onward.hint("merge"), F.col("root") == F.col("at"), "left")
        moved = stored(moved.select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("went")))
        roots = moved.select("word", "root")
        if moved.filter("went").isEmpty():
            break
    roots = roots.select(F.col("word").alias("at"), "root")
    joined = found.join(roots.hint("merge"), F.col("word") == F.col("at"), "left").drop("at")
    return joined.withColumn("root", F.coalesce("root", "word"))


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word: ``word, form, root, n, n_near, form_n``."""
    words = stored(word_counts(docs, id_col, text_col))
    found = stored(forms(words))
    return with_roots(found).select("word", "form", "root", "n", "n_near", "form_n")
