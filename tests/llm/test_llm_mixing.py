from collections import defaultdict

import duckdb
import pytest
from llm_cases import documents, frame, shared_targets, words
from marketlake.llm import mixing


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_mix_meets_targets_and_matches_sql(spark, tmp_path):
    rows = documents()
    docs = frame(spark, rows)
    got = mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")
    found = rows_of(got)
    assert found == rows_of(mixing.mix_sources(docs.repartition(5)))
    docs.select("doc_id", "text", "source").write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    sql = con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.SQL})").fetchall()
    assert found == sorted(sql, key=repr)

    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = shared_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5, 2)
    by_size = {sizes[s]: want[s] for s in order}
    taken, most = defaultdict(int), defaultdict(int)
    for _, size, source_size, target, t in found:
        assert target == pytest.approx(by_size[source_size])
        assert t <= 2 * size
        taken[source_size] += t
        most[source_size] = max(most[source_size], size)
    for s, t in taken.items():
        assert abs(t - by_size[s]) <= 3 * most[s]  # a tie of three equal rows stays together


def test_mixed_rows_are_whole_rows(spark):
    docs = frame(spark, documents())
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert sum(len(words(r.text)) for r in mixed.select("text").collect()) == sum(r.taken for r in mixing.mix_sources(docs).collect())


def test_empty_and_wordless(spark):
    assert mixing.mix_sources(frame(spark, documents()).filter("false")).collect() == []
    nothing = mixing.mix_sources(frame(spark, [(1, None, "en", "a"), (2, "  ", "en", None)]))
    assert rows_of(nothing) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_one_source_holds_a_third_and_no_python_runs(spark):
    rows = [(i, "w " * (i % 7 + 1), "en", "hot" if i % 3 == 0 else f"s{i % 40}") for i in range(600)]
    got = mixing.mix_sources(frame(spark, rows), weights=(1, 3), share=0.4, max_repeats=3)
    assert "Python" not in got._jdf.queryExecution().toString()
    sums, target = defaultdict(int), {}
    for r in got.collect():
        sums[r.source_size, r.target] += r.taken
        target[r.source_size, r.target] = r.target
    assert sum(sums.values()) == pytest.approx(0.4 * sum(i % 7 + 1 for i in range(600)), rel=0.1)
