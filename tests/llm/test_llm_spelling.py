import re
import zlib
from collections import Counter

import pytest
from llm_cases import CLASHES, documents, frame
from pyspark.sql import functions as F

from marketlake.llm import spelling as S


def plain_words(rows):
    """Distinct runs with their counts, after the planted deletions."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    n = plain_words(rows)
    near = {w: [v for v in n if one_apart(v, w)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def result(df):
    return {r.word: tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def varied():
    """Words with variants, anagrams, chains of forms, accents, ties, runs of many letters, and variants of every kind of edit."""
    rows = [(1, "colour " * 40 + "color " * 10 + "colr " * 9 + "coloor " * 4 + "Couleur " * 5), (2, "naïveté " * 8 + "naiveté " * 4 + "naivete " * 3 + "NAÏVETÉ " * 3)]
    rows += [(3, "stare tears rates aster tares resat " * 6), (4, "abcde " * 8 + "abcdf " * 8 + "abcdx " * 3 + "bcdef " * 4 + "abcdef " * 16)]
    rows += [(5, "ÿÿÿÿÿ × ÷÷÷÷÷÷ ÷÷÷÷÷÷ ÷÷÷÷÷÷ 日本語 ßßßßß ßßßßß ßßßßß"), (6, ("x" * 70_000 + " ") * 2 + "x" * 70_001 + " " + ("x" * 70_001 + ",") * 7)]
    rows += [(7, ("x" * 70_000 + " ") * 3), (8, None), (9, ""), (None, "colour color nothing"), (7, ("x" * 70_000 + " ") * 3)]
    return rows + [(100 + i, "".join(f"{w}{'s' * (i % 3)} " for w in ("letters", "kittens", "mittens", "bitten"))) for i in range(30)]


@pytest.mark.parametrize("rows", [varied(), [(r[0], r[1]) for r in documents()], []], ids=["varied", "documents", "empty"])
def test_groups_equal_brute_force(spark, rows):
    df = frame(spark, [(d, t, "en", "s") for d, t in rows]) if rows else spark.createDataFrame([], "doc_id long, text string")
    out = S.spelling_groups(df)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got, want = result(out), plain(rows)
    assert got == want and out.count() == len(want)


def test_signatures_miss_no_pair_at_distance_one(spark):
    import random

    rng = random.Random(3)
    words = set()
    for _ in range(300):
        w = "".join(rng.choice("abcé") for _ in range(rng.randint(5, 8)))
        i = rng.randrange(len(w))
        words |= {w, w[:i] + w[i + 1 :], w[:i] + rng.choice("abcé") + w[i:], w[:i] + rng.choice("abcé") + w[i + 1 :], "".join(sorted(w))}
    words = sorted(words)
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = {tuple(sorted((r.a, r.b))) for r in S.near_pairs(df).collect()}
    want = {(v, w) for i, w in enumerate(words) for v in words[:i] if one_apart(v, w)}
    assert got == want and S.near_pairs(df).count() == len(want) > 1000


def test_names_ids_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 64)  # texts are split into words in pieces
    rows = varied()
    df = frame(spark, [(d, t, "en", "s") for d, t in rows]).withColumns({c: F.lit(1) for c in (*CLASHES, "id", "a", "b", "form", "near", "at")})
    assert result(S.spelling_groups(df.withColumnsRenamed({"doc_id": "page", "text": "body"}), "page", "body")) == plain(rows)


def test_no_group_meets_in_one_task(spark):
    """Words of equal letters are refined by halves, so anagrams don't give pairs with the square of their number."""
    import itertools

    words = ["".join(p) for p in itertools.permutations("abcdefg")]
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    left = df.mapInArrow(S._signed(True), "key long, word string, n long")
    assert left.groupBy("key").count().agg(F.max("count")).first()[0] <= 24
    assert S.near_pairs(df).count() == 0


def test_no_join_is_broadcast(spark, monkeypatch):
    """A stored table of words is far smaller than its rows and their signatures, so small sizes must not make Spark broadcast them."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") in ("10485760b", "10MB")  # Spark's own
    plans, stored = [], S.stored

    def ran(df):
        df.collect()  # the plan is then the one that ran
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(S, "stored", lambda df: stored(ran(df)))
    rows = [(d, t) for d, t in varied() if len(t or "") < 70_000]
    assert result(ran(S.spelling_groups(frame(spark, [(d, t, "en", "s") for d, t in rows])))) == plain(rows)
    assert not any("Broadcast" in p for p in plans)
    assert sum("SortMergeJoin" in p for p in plans) >= 4  # of signatures, links, roots and the result
