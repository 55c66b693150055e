import hashlib

import corpus_pipeline as P
from llm_cases import documents, near_classes, without_repeats, words
from marketlake.llm import mixing, packing
from marketlake.llm.tokens import Ids
from test_llm_quality import verdicts


def test_stages_match_plain_code(spark, tmp_path):
    rows = [(d, t, lang, s, len(t or "")) for d, t, lang, s in documents() if d is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(2)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    here, results = docs, []
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, here, str(tmp_path)).write.parquet(str(tmp_path / f"s{k}"))
        here = spark.read.parquet(str(tmp_path / f"s{k}"))
        if k < 4:
            assert here.columns == docs.columns
        results.append([tuple(r) for r in here.collect()])

    _, _, kept = verdicts([(r[2], r[1]) for r in rows])
    good = [r for r, k in zip(rows, kept) if k]
    assert sorted(results[0], key=str) == sorted(good, key=str)

    good.sort(key=lambda r: r[0])
    roots = near_classes([r[1] for r in good])
    single = [r for i, r in enumerate(good) if roots[i] == i]
    assert sorted(results[1]) == single

    left = [t.decode("utf-8", "ignore") for *_, t in without_repeats([(r[0], r[1]) for r in single])]
    cut = [(r[0], t, r[2], r[3], len(t)) for r, t in zip(single, left)]
    assert sorted(results[2], key=str) == sorted(cut, key=str)

    table = spark.createDataFrame(cut, docs.schema)
    times = {r.doc_id: r.taken // max(1, r.size) for r in mixing.mix_sources(table).collect()}
    mixed = [r for r in cut for _ in range(times[r[0]]) if words(r[1])]
    assert sorted(r for r in results[3] if words(r[1])) == sorted(mixed)

    coded = Ids(P.vocabulary())([r[1].encode() for r in results[3]])
    assert sum(r[3] for r in results[4]) == sum(len(c) // 4 + 1 for c in coded)
    sums = {}
    for r in results[4]:
        sums[r[5]] = sums.get(r[5], 0) + r[3]
    assert max(sums.values()) <= packing.CAPACITY

    digest = lambda rows: hashlib.sha256(str(sorted((r[0], r[1], r[2], r[3], r[4]) for r in rows)).encode()).hexdigest()
    assert digest(map(tuple, P.run(spark, str(tmp_path)).collect())) == digest(results[4])


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []
