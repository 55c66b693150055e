import math
import random
from collections import Counter

import pytest
from llm_cases import base_features, documents, frame, words
from marketlake.llm import quality as Q


def divergence(p, q):
    a, b = sum(p), sum(q)
    if not a or not b:
        return 0.0
    total = 0.0
    for x, y in zip((v / a for v in p), (v / b for v in q)):
        m = (x + y) / 2
        total += (x * math.log2(x / m) if x else 0) + (y * math.log2(y / m) if y else 0)
    return math.sqrt(max(0.0, total / 2))


def classes(text):
    out = [0] * len(Q.CLASSES)
    for c in text or "":
        kind = (
            "other" if ord(c) > 127 else "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit()
            else "line" if c == "\n" else "space" if c in " \t\v\f\r" else "punctuation" if c in ".,;:!?'\"()-" else "symbol"
        )
        out[Q.CLASSES.index(kind)] += 1
    return out


def verdicts(rows):
    """(base features, base failed, kept) of each (lang, text) by plain code."""
    base = [base_features(t) for _, t in rows]
    failed = [b[0] < Q.MIN_BASE_WORDS or 100 * b[4] > Q.MAX_REPEATED_PERCENT * b[0] for b in base]
    lower = lambda t: [w.decode() for w in (t or "").encode().lower().split()]
    ref_words, ref_classes, all_words = {}, {}, {}
    for (lang, text), bad in zip(rows, failed):
        all_words[lang] = all_words.get(lang, 0) + len(words(text))
        if not bad:
            ref_words.setdefault(lang, Counter()).update(lower(text))
            old = ref_classes.get(lang, [0] * len(Q.CLASSES))
            ref_classes[lang] = [x + y for x, y in zip(old, classes(text))]
    kept = []
    for (lang, text), bad in zip(rows, failed):
        ref, ok = ref_words.get(lang), not bad
        if ok and ref and ref.total() >= Q.MIN_REFERENCE_WORDS:
            common = [w for w, n in ref.items() if n >= Q.COMMON_SHARE * ref.total()]
            own, n, chars = Counter(lower(text)), len(words(text)), len(text)
            p, q = [own[w] for w in common], [ref[w] for w in common]
            if n >= Q.MIN_WORDS:
                ok &= divergence([*p, n - sum(p)], [*q, ref.total() - sum(q)]) <= Q.WORD_BOUND + Q.WORD_SLACK / math.sqrt(n)
            if chars >= Q.MIN_CHARS:
                ok &= divergence(classes(text), ref_classes[lang]) <= Q.CLASS_BOUND + Q.CLASS_SLACK / math.sqrt(chars)
        kept.append(ok)
    return base, failed, kept


def test_rules_match_plain_code(spark):
    rows = documents()
    base, failed, kept = verdicts([(r[2], r[1]) for r in rows])
    got = sorted(
        tuple(r)[:8] for r in Q.quality_rules(frame(spark, rows)).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
        ).na.fill(-1, ["doc_id"]).collect()
    )
    want = sorted((-1 if r[0] is None else r[0], *b, f, k) for r, b, f, k in zip(rows, base, failed, kept))
    assert got == want
    by_id = {g[0]: g[7] for g in got}
    assert all(by_id[i] for i in range(12)) and all(by_id[i] for i in range(20, 28))
    assert not by_id[91] and not by_id[92] and not by_id[93]


def test_kept_rows_are_whole_rows(spark):
    docs = frame(spark, documents())
    kept = Q.keep_quality(docs)
    assert kept.columns == docs.columns
    assert kept.count() == Q.quality_rules(docs).filter("kept").count()
    assert Q.keep_quality(docs.filter("false")).collect() == [] and Q.quality_rules(docs.filter("false")).collect() == []


def test_any_columns_of_the_result_can_be_read(spark):
    docs = frame(spark, documents())
    out = Q.quality_rules(docs)
    whole = sorted(map(tuple, out.collect()), key=repr)
    for k, c in enumerate(out.columns):
        assert sorted((r[0] for r in out.select(c).collect()), key=repr) == sorted((r[k] for r in whole), key=repr)
    kept = sum(r[out.columns.index("kept")] for r in whole)
    assert out.select("doc_id", "kept").filter("kept").count() == kept == out.filter("kept").count()
    assert {r.kept: r["count"] for r in out.groupBy("kept").count().collect()}[True] == kept
    assert len(out.select("doc_id", "n_words", "kept").collect()) == len(out.select("class_distance", "kept").collect()) == len(whole)


def test_null_language_is_not_the_empty_one(spark):
    rng = random.Random(11)
    rows = []
    for lang, other in ((None, "xx"), ("", None)):
        common = [letters(rng) for _ in range(60)]
        rows += [(lang, " ".join(rng.choices(common, k=600))) for _ in range(30)]
    kept = kept_of(spark, rows)
    assert all(kept.values())  # each has its own words; together neither would be near the reference


def test_distance_bounds(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(
        Q.distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0))).alias("apart"),
        Q.distance(F.array(F.lit(0.25), F.lit(0.75)), F.array(F.lit(0.25), F.lit(0.75))).alias("same"),
        Q.distance(Q.shares(F.array(F.lit(0), F.lit(0)), F.lit(0)), F.array(F.lit(0.25), F.lit(0.75))).alias("none"),
    ).first()
    assert row.apart == pytest.approx(1) and row.same == pytest.approx(0, abs=1e-6) and row.none == 0


def letters(rng, n=6):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))


def kept_of(spark, rows):
    """``kept`` by doc_id (the index in ``rows`` of (lang, text)), after comparison with plain code."""
    got = {r.doc_id: r.kept for r in Q.quality_rules(frame(spark, [(i, t, lang, "s") for i, (lang, t) in enumerate(rows)])).collect()}
    assert [got[i] for i in range(len(rows))] == verdicts(rows)[2]
    return got


def test_base_failed_text_hides_no_common_words(spark):
    rng = random.Random(5)
    common = [letters(rng) for _ in range(120)]  # each 0.8 % of the good words, 0.16 % of all
    rows = [("en", " ".join(rng.choices(common, k=900))) for _ in range(10)]
    rows += [("en", " ".join([letters(rng) for _ in range(8)] * 113)) for _ in range(40)]
    rows.append(("en", " ".join(letters(rng) for _ in range(200))))
    assert sum(len(t.split()) for _, t in rows[10:50]) >= 4 * sum(len(t.split()) for _, t in rows[:10])
    kept = kept_of(spark, rows)
    assert all(kept[i] for i in range(10)) and not any(kept[i] for i in range(10, 51))


def test_language_without_common_words_is_judged_by_classes(spark):
    rng = random.Random(6)
    rows = [("zh", " ".join(letters(rng, 12) for _ in range(300))) for _ in range(12)]
    rows.append(("zh", " ".join(f"#{k}$%&|<>*" for k in range(30))))
    kept = kept_of(spark, rows)
    assert all(kept[i] for i in range(12)) and not kept[12]


def test_languages_beyond_the_bound_are_judged_alike(spark, monkeypatch):
    monkeypatch.setattr(Q, "MAX_LANGUAGES", 2)
    rng = random.Random(8)
    rows = []
    for k, lang in enumerate(("aa", "bb", "cc", None, "ee")):
        common = [letters(rng) for _ in range(80)]
        rows += [(lang, " ".join(rng.choices(common, k=900))) for _ in range(8 - k)]
        rows.append((lang, " ".join(letters(rng) for _ in range(200))))
        rows.append((lang, " ".join(f"#{j}$%&|<>*" for j in range(30))))
    rows += [("ff", "too few words for a reference " * 3), ("ff", None), ("zz", " ".join(letters(rng) for _ in range(1200)))]
    kept = kept_of(spark, rows)
    junk = [i for i, (_, t) in enumerate(rows[:-3]) if len(t.split()) < 900]
    assert len(junk) == 10 and not any(kept[i] for i in junk)
    docs = frame(spark, [(i, t, lang, "s") for i, (lang, t) in enumerate(rows)])
    assert sorted(r.doc_id for r in Q.keep_quality(docs).collect()) == sorted(i for i in kept if kept[i])
