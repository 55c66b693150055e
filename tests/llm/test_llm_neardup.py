import random

import numpy as np
from llm_cases import documents, frame, near_classes, prose, shingle_counts
from marketlake.llm import neardup as N
from marketlake.llm.components import components
from marketlake.llm.shingles import shingle_elements


def expected(rows):
    """The class id and whether it is kept, by plain code, of rows in order of id."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    roots = near_classes([rows[i][1] for i in order])
    return sorted((str(rows[i][0]), str(rows[order[r]][0])) for i, r in zip(order, roots))


def check(spark, rows):
    got = N.near_duplicates(frame(spark, rows)).collect()
    assert sorted((str(g.doc_id), str(g.class_id)) for g in got) == expected(rows)
    return got


def test_matches_brute_force(spark):
    rows = documents()
    got = check(spark, rows)
    kept = [g for g in got if g.kept]
    assert {40, 41, 42, 50} & {g.doc_id for g in kept} == set()
    assert sorted(str(g.doc_id) for g in kept if g.doc_id is not None) == sorted({c for _, c in expected(rows)} - {"None"})
    assert {g.doc_id for g in kept} >= {70, 71, 72, 73, 74, 94}


def test_chains_and_large_groups_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)  # several blocks for the buckets that stay mixed
    rng = random.Random(5)
    base = prose(rng, 200).split(" ")
    rows = []
    for i in range(120):  # copies with one to nine words changed: similar to some, not to others
        w = list(base)
        for j in rng.sample(range(len(w)), rng.randint(1, 9)):
            w[j] = f"x{i}"
        rows.append((i, " ".join(w), "en", "s"))
    rows += [(500, " ".join(base), "en", "s")] * 40
    check(spark, rows)


def test_dropping_keeps_one_row_of_each_class(spark):
    docs = frame(spark, documents())
    left = N.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert left.filter("doc_id IS NOT NULL").count() == N.near_duplicates(docs).filter("kept AND doc_id IS NOT NULL").count()
    assert N.near_duplicates(docs.filter("false")).collect() == [] and N.drop_near_duplicates(docs.filter("false")).collect() == []


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(2)
    a = prose(rng, 300)
    texts = [a, a.replace("tion", "tjon", 40), a + " " + a, "few words", ""]
    elements, doc = shingle_elements([t.encode() for t in texts])
    k = 4000
    darts = N.earliest_darts(elements, doc, len(texts), k)
    assert (darts[:4] != 0).all() and (darts[4] == 0).all()
    for i, j in ((0, 1), (0, 2)):
        x, y = shingle_counts(texts[i]), shingle_counts(texts[j])
        similar = sum((x & y).values()) / sum((x | y).values())
        assert abs((darts[i] == darts[j]).mean() - similar) < 0.04


def test_elements_are_the_weighted_shingles():
    rng = random.Random(4)
    texts = [prose(rng, n) for n in (0, 1, 4, 5, 6, 50)] + ["a b c d e a b c d e a b c d e"]
    elements, doc = shingle_elements([t.encode() for t in texts])
    assert np.bincount(doc, minlength=7).tolist() == [sum(shingle_counts(t).values()) for t in texts]
    assert len(np.unique(elements[doc == 6])) == 11


def test_components(spark):
    rng = random.Random(8)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + j) for j in range(1, 50)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    root = {x: x for p in pairs for x in p}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: top(x) for x in root if top(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
