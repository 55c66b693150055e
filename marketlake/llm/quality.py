"""Quality rules: distance of a document's histograms from its language's reference.

Two histograms describe a document: character classes, and the common words of its language (with
one bin for all other words). The references are the same histograms summed over all
documents of the language that pass the base rules. A document is rejected if the Jensen-Shannon distance (base 2,
0 to 1) to a reference is above a bound. Both are guarded by length, as histograms of short texts are mostly noise: a bound
falls with the root of the length, and below a minimum length it doesn't hold. It holds only for languages with enough words for a reference.

A word is common if it makes up at least COMMON_SHARE of its language's reference, that is of the documents that pass the
base rules. Tasks report words with half that share among what they read of those documents; no common word can be missed by
all reports' sum, and at most 2 / COMMON_SHARE words of a language pass. The counts themselves come from a second pass over all texts.

Defined results: null and empty texts have no words and fail the base rules; texts are read whole, however long; a null language is a
language of its own, apart from the empty one; a distance that ties with its bound is within it; other columns may have any names; languages with too few words for a reference are judged by the base rules only, all others by both
distances (a language without common words has one bin for all words, so only its classes can differ); repeated rows are judged
alike; an empty table gives an empty result. The common words of the MAX_LANGUAGES languages with most words are sent to
every task, those of further languages are joined to their documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import shielded, stored, tidy_task

COMMON_SHARE, MAX_LANGUAGES, MIN_REFERENCE_WORDS = 0.005, 256, 1000
#: Bounds of the distances for long texts, what is added for a text of n characters or words (times 1 / sqrt(n)), and the least n.
CLASS_BOUND, CLASS_SLACK, MIN_CHARS = 0.24, 1.7, 100
WORD_BOUND, WORD_SLACK, MIN_WORDS = 0.25, 1.0, 50
MIN_BASE_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
SPACE, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
CLASSES = ("lower", "upper", "digit", "space", "line", "punctuation", "symbol", "other")


def class_of_byte() -> np.ndarray:
    """The class of each byte of UTF-8 text; continuation bytes get the last, which is not counted."""
    table = np.full(256, CLASSES.index("symbol"), dtype=np.uint8)
    table[ord("a") : ord("z") + 1] = CLASSES.index("lower")
    table[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
    table[ord("0") : ord("9") + 1] = CLASSES.index("digit")
    table[list(SPACE)] = CLASSES.index("space")
    table[ord("\n")] = CLASSES.index("line")
    table[list(b".,;:!?'\"()-")] = CLASSES.index("punctuation")
    table[0xC0:] = CLASSES.index("other")
    table[0x80:0xC0] = len(CLASSES)
    return table


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words which the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(window):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    ordered = np.sort(total)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(total, twice))
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(covered)[:-1]))


def base_features(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    return (
        len(words),
        len(text.translate(None, SPACE + CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def passes_base(words: list[bytes]) -> bool:
    """Whether a text of these words passes the base rules; ``base_failed`` is the same rule on columns."""
    n = len(words)
    return n >= MIN_BASE_WORDS and 100 * repeated_words(words) <= MAX_REPEATED_PERCENT * n


def _texts(batch: pa.RecordBatch) -> list[tuple[str | None, bytes]]:
    texts = batch.column("text").cast(pa.large_binary()).to_pylist()
    return [(lang, text or b"") for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True)]


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of the words with half the share of a common word in what was read, and (lang, null, n) of all words.

    Only documents that pass the base rules count, as in the references.
    """
    for batch in batches:
        counts: dict[str | None, Counter] = {}
        for lang, text in _texts(batch):
            if passes_base(text.split()):
                counts.setdefault(lang, Counter()).update(text.lower().split())
        rows: list[tuple[str | None, bytes | None, int]] = []
        for lang, count in counts.items():
            total = count.total()
            rows.append((lang, None, total))
            rows += [(lang, w, n) for w, n in count.items() if n >= COMMON_SHARE / 2 * total]
        names = ["lang", "word", "n"]
        columns = zip(*rows, strict=True) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.binary(), pa.int64()), strict=True)], names=names
        )


def _one_of(lang: Column, langs: list[str | None]) -> Column:
    """Whether ``lang`` is one of ``langs``; null is a language too."""
    named = F.coalesce(lang.isin([x for x in langs if x is not None]), F.lit(False))
    return named | lang.isNull() if None in langs else named


def common_words(texts: DataFrame) -> tuple[dict[str | None, list[bytes]], DataFrame | None]:
    """By language, the words that may be common, 2 / COMMON_SHARE at most: of the MAX_LANGUAGES with most words, and the rest.

    The rest has one row ``__common_of, __common`` per language, and is None if there are no more languages.
    """
    found = stored(
        texts.select("lang", "text").mapInArrow(tidy_task(_frequent), "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    )
    totals = found.filter("word IS NULL").select(F.col("lang").alias("of"), F.col("n").alias("words"))
    totals = totals.filter(F.col("words") >= MIN_REFERENCE_WORDS)
    top = [r["of"] for r in totals.orderBy(F.desc("words"), "of").limit(MAX_LANGUAGES + 1).collect()]
    more, top = len(top) > MAX_LANGUAGES, top[:MAX_LANGUAGES]
    words = (
        found.filter("word IS NOT NULL")
        .join(totals, F.col("lang").eqNullSafe(F.col("of")))
        .filter(F.col("n") >= COMMON_SHARE / 2 * F.col("words"))
        .select("lang", "word")
    )
    out: dict[str | None, list[bytes]] = {lang: [] for lang in top}
    for word, lang in sorted(((bytes(r.word), r.lang) for r in words.filter(_one_of(F.col("lang"), top)).collect()), key=lambda x: x[0]):
        out[lang].append(word)
    if not more:
        return out, None
    rest = words.filter(~_one_of(F.col("lang"), top)).groupBy(F.col("lang").alias("__common_of"))
    return out, stored(rest.agg(F.array_sort(F.collect_list("word")).alias("__common")))


def features(docs: DataFrame, common: tuple[dict[str | None, list[bytes]], DataFrame | None], keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` (which has lang and text) and a struct ``__q`` of base features and histograms."""
    top, rest = common
    index = {lang: {w: k for k, w in enumerate(words)} for lang, words in top.items()}
    if rest is None:
        return _described(docs, index, keep)
    known = _one_of(F.col("lang"), list(top))
    others = docs.filter(~known).join(rest, F.col("lang").eqNullSafe(F.col("__common_of")), "left").drop("__common_of")
    return _described(docs.filter(known), index, keep).unionByName(_described(others, {}, keep))


def _described(docs: DataFrame, index: dict[str | None, dict[bytes, int]], keep: list[str]) -> DataFrame:
    """``features`` of documents whose language's words are in ``index`` or in the row's ``__common``."""
    schema = (
        ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
        + ", __q struct<lang: string, n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long,"
        + " n_repeat_words: long, classes: array<long>, words: array<long>>"
    )
    lookup = class_of_byte()
    joined = "__common" in docs.columns

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, base, classes, words = [], [], [], []
            places = {} if joined else index
            for row, (lang, text) in enumerate(_texts(batch.select(["lang", "text"]))):
                split = text.split()
                base.append(base_features(text, split))
                langs.append(lang)
                kinds = lookup[np.frombuffer(text, np.uint8)]
                classes.append(np.bincount(kinds, minlength=len(CLASSES) + 1)[: len(CLASSES)])
                if joined and lang not in places:
                    places[lang] = {w: k for k, w in enumerate(batch.column("__common")[row].as_py() or [])}
                place = places.get(lang, {})
                at = [p for p in map(place.get, text.lower().split()) if p is not None]
                words.append(np.bincount(np.asarray(at, np.int64), minlength=len(place)))
            numbers = np.asarray(base, np.int64).reshape(-1, 5)
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            struct = pa.StructArray.from_arrays(
                [
                    pa.array(langs, pa.string()), *[pa.array(numbers[:, k]) for k in range(5)],
                    pa.array(classes, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int64())),
                ],
                names=["lang", *names, "classes", "words"],
            )
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], struct], names=[*keep, "__q"])

    return docs.mapInArrow(tidy_task(describe), schema)


def base_failed(q: str = "__q") -> Column:
    words = F.col(f"{q}.n_words")
    return (words < MIN_BASE_WORDS) | (100 * F.col(f"{q}.n_repeat_words") > MAX_REPEATED_PERCENT * words)


def references(described: DataFrame) -> DataFrame:
    """``of_lang, class_sums, word_sums, reference_words``: histograms summed over the documents that pass the base rules.

    ``word_sums`` is empty for a language without words that may be common.
    """
    good = described.filter(~base_failed()).select("__q.*")
    sums = good.groupBy("lang").agg(
        F.array(*[F.sum(F.element_at("classes", k + 1)) for k in range(len(CLASSES))]).alias("class_sums"),
        F.sum("n_words").alias("reference_words"),
    )
    by_word = good.select("lang", F.posexplode("words").alias("pos", "n")).groupBy("lang", "pos").agg(F.sum("n").alias("n"))
    word_sums = by_word.groupBy(F.col("lang").alias("of")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "n"))), lambda x: x["n"]).alias("word_sums")
    )
    both = sums.join(word_sums, F.col("lang").eqNullSafe(F.col("of")), "left").drop("of").withColumnRenamed("lang", "of_lang")
    return both.withColumn("word_sums", F.coalesce("word_sums", F.array().cast("array<long>")))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)


def shares(a: Column, n: Column) -> Column:
    return F.transform(a, lambda x: F.try_divide(x.cast("double"), n.cast("double")))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms with the same bins, as shares; 0 if either is empty."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.coalesce(total(terms), F.lit(0.0)) / 2))


def prepared(described: DataFrame) -> DataFrame:
    """One row ``__ref`` per language with enough words: places of the common words, and both histograms as shares."""
    refs = references(described).filter(F.col("reference_words") >= MIN_REFERENCE_WORDS)
    n = F.col("reference_words")
    places = F.filter(F.sequence(F.lit(0), F.size("word_sums") - 1), lambda i: F.get("word_sums", i) >= COMMON_SHARE * n)
    refs = refs.withColumn("places", F.when(F.size("word_sums") > 0, places).otherwise(F.array().cast("array<int>")))
    refs = refs.withColumn("common", F.transform("places", lambda i: F.get("word_sums", i)))
    rest = n - F.aggregate("common", F.lit(0).cast("long"), lambda x, y: x + y)
    refs = refs.select(
        "of_lang", "places", shares(F.concat("common", F.array(rest)), n).alias("word_shares"),
        shares(F.col("class_sums"), total(F.col("class_sums"))).alias("class_shares"),
    )
    return refs.select(F.struct(refs.columns).alias("__ref"))


def judged(described: DataFrame) -> DataFrame:
    """``described`` with ``__class_distance``, ``__word_distance`` (null where not judged) and ``__kept``."""
    joined = described.join(stored(prepared(described)), F.col("__q.lang").eqNullSafe(F.col("__ref.of_lang")), "left")
    known, n = F.col("__ref").isNotNull(), F.col("__q.n_words")
    chars = F.aggregate("__q.classes", F.lit(0).cast("long"), lambda x, y: x + y)
    common = F.transform("__ref.places", lambda i: F.get("__q.words", i))
    rest = n - F.aggregate(common, F.lit(0).cast("long"), lambda x, y: x + y)
    words = distance(shares(F.concat(common, F.array(rest)), n), F.col("__ref.word_shares"))
    by_class = distance(shares(F.col("__q.classes"), chars), F.col("__ref.class_shares"))
    # columns that are used twice are not computed twice, as the optimizer doesn't merge projections then
    measured = joined.withColumns({
        "__chars": chars,
        "__class_distance": F.when(known & (chars >= MIN_CHARS), by_class),
        "__word_distance": F.when(known & (n >= MIN_WORDS), words),
    })
    kept = (
        ~base_failed()
        & F.coalesce(F.col("__class_distance") <= CLASS_BOUND + CLASS_SLACK / F.sqrt("__chars"), F.lit(True))
        & F.coalesce(F.col("__word_distance") <= WORD_BOUND + WORD_SLACK / F.sqrt("__q.n_words"), F.lit(True))
    )
    return measured.withColumn("__kept", kept).drop("__ref", "__chars")


def _named(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("doc_id"), docs[lang_col].alias("lang"), docs[text_col].alias("text"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: base features, ``base_failed``, both distances and ``kept``."""
    texts = _named(docs, id_col, text_col, lang_col)
    described = stored(features(texts, common_words(texts), ["doc_id"]))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged(described).select(
        "doc_id", *[F.col(f"__q.{c}").alias(c) for c in base], base_failed().alias("base_failed"),
        F.col("__kept").alias("kept"), F.col("__class_distance").alias("class_distance"), F.col("__word_distance").alias("word_distance"),
    )


def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (with doc_id, lang and text) that are kept, with its columns, whatever their names."""
    inner, restore = shielded(docs, ["doc_id", "lang", "text"])
    described = stored(features(inner, common_words(inner), inner.columns))
    return restore(judged(described).filter("__kept"))
