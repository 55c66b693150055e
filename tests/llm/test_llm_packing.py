import random
import zlib

import numpy as np
import pytest
from llm_cases import documents, frame
from marketlake.llm import packing as P
from marketlake.llm import token_matrix as M
from marketlake.llm.queries import vocabulary
from marketlake.llm.tokens import Ids


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_ids_are_the_librarys(tokenizer):
    texts = [r[1] for r in documents()] + [
        "İstanbul ΣΑΣ ﬁ é x²y ¼ a\xa0b \x1c\x1d", "Don't I'LL he'S 123 4.5 <|endoftext|> foo<|startoftext|>bar <|ENDOFTEXT|>",
        "日本語 текст ßÄÖ ǅ   a\u0085b \x00 \x7f µª", "_x_ a_b 'S 'sS ''s" * 3, "x" * 5000, "é café", "'ſ   a​b",
    ]
    coded = Ids(vocabulary())([None if t is None else t.encode() for t in texts])
    for text, ids in zip(texts, coded):
        assert [*np.frombuffer(ids, "<u4").tolist(), 1] == ids_of(tokenizer, text)


def test_rank_files_give_the_same_ids_as_the_vocabulary_file():
    from marketlake.llm.tokens import coder
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    texts = [r[1] or "" for r in documents() if r[0] != 94] + ["x" * 20_000, "<|endoftext|> a  b\n\n日本 İ"]
    coded = coder(vocabulary("byte_bpe_50k.tiktoken"))([t.encode() for t in texts])
    for text, ids in zip(texts, coded):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_packed_documents(spark, tokenizer):
    rows = documents()
    got = P.pack_documents(frame(spark, rows), vocabulary()).collect()
    want = []
    for d, text, *_ in rows:
        ids = ids_of(tokenizer, text)
        for k, at in enumerate(range(0, len(ids), P.CAPACITY)):
            part = ids[at : at + P.CAPACITY]
            want.append((str(d), k, at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    assert sorted((str(g.doc_id), g.piece, g.start, g.length, g.ids_crc32) for g in got) == sorted(want)
    ends, used = {}, 0
    for g in sorted(got, key=lambda g: (g.sequence_id, g.offset)):
        assert g.offset == ends.get(g.sequence_id, 0)
        ends[g.sequence_id] = g.offset + g.length
        used += g.length
    assert max(ends.values()) <= P.CAPACITY and len(ends) <= used / P.CAPACITY + 2
    assert P.pack_documents(frame(spark, rows).filter("false"), vocabulary()).collect() == []


def test_extra_columns_ride_along(spark):
    pieces = spark.createDataFrame([(i, 1 + i * 37 % 100, "a") for i in range(500)], "id long, length long, bins string")
    got = P.pack_best_fit(pieces, capacity=100, open_bins=8, pieces_per_task=100).collect()
    assert sorted((g.id, g.length, g.bins) for g in got) == sorted((i, 1 + i * 37 % 100, "a") for i in range(500))
    sums = {}
    for g in got:
        sums[g.sequence_id] = sums.get(g.sequence_id, 0) + g.length
    assert max(sums.values()) <= 100


def plain_best_fit(lengths, capacity, limit):
    """The same rule by search: the fullest open bin that fits, else close the fullest if too many are open."""
    open_, out, made = [], [], 0
    for n in lengths:
        fit = [b for b in open_ if b[0] >= n]
        if fit:
            least = min(b[0] for b in fit)
            b = [b for b in open_ if b[0] == least][-1]
            open_.remove(b)
        else:
            if len(open_) >= limit:
                least = min(b[0] for b in open_)
                open_.remove([b for b in open_ if b[0] == least][-1])
            b = [capacity, made]
            made += 1
        out.append((b[1], capacity - b[0]))
        if b[0] > n:
            open_.append([b[0] - n, b[1]])
    return out


@pytest.mark.parametrize("limit", [1, 3, 50])
def test_open_bins_match_plain_best_fit(limit):
    rng = random.Random(limit)
    lengths = [rng.randint(1, 60) for _ in range(2000)]
    bins = P.OpenBins(60, limit)
    assert [bins.place(n) for n in lengths] == plain_best_fit(lengths, 60, limit)


def test_capacity_tree_matches_plain_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(20):
        lengths = [rng.randint(1, 97) for _ in range(200)]
        rows = M.best_fit_decreasing(lengths, 97)
        assert sorted(k for row in rows for k in row) == list(range(200))
        free, count = [], 0
        for n in sorted(lengths, reverse=True):
            fit = [f for f in free if f >= n]
            if fit:
                free.remove(min(fit))
                free.append(min(fit) - n)
            else:
                count += 1
                free.append(97 - n)
        assert len(rows) == count and all(sum(lengths[k] for k in row) <= 97 for row in rows)


def test_matrices_round_trip(spark, tokenizer, tmp_path):
    rows = documents()
    M.write_matrices(M.packed_rows(frame(spark, rows), vocabulary()), str(tmp_path / "m"))
    parts = {}
    for r in spark.read.parquet(str(tmp_path / "m")).collect():
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == P.CAPACITY and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (ids[r.n_tokens :] == M.PAD_ID).all() and zlib.crc32(ids[: r.n_tokens].astype("<u4").tobytes()) == r.ids_crc32
        positions = np.frombuffer(r.position_ids, "<u2")
        assert len(positions) == P.CAPACITY and not positions[r.n_tokens :].any()
        for a, b, d, p in zip(r.cu_seqlens[:-1], r.cu_seqlens[1:], r.doc_ids, r.pieces):
            assert positions[a:b].tolist() == list(range(b - a))
            parts.setdefault((str(d), p), []).append(ids[a:b].tolist())
    want = {}
    for d, text, *_ in rows:
        ids = ids_of(tokenizer, text)
        for k, at in enumerate(range(0, len(ids), P.CAPACITY)):
            want.setdefault((str(d), k), []).append(ids[at : at + P.CAPACITY])
    assert {k: sorted(v) for k, v in parts.items()} == {k: sorted(v) for k, v in want.items()}
    assert M.packed_rows(frame(spark, rows).filter("false"), vocabulary()).collect() == []


def test_position_ids():
    assert M.position_ids([0, 3, 4, 6], 8).tolist() == [0, 1, 2, 0, 0, 1, 0, 0]
    assert M.position_ids([0, 70000], 70000).tolist() == list(range(70000))


def test_matrices_of_empty_texts_use_several_tasks(spark, monkeypatch):
    """Texts without a byte still cost a row each: they are dealt over tasks; columns named like the result's do no harm."""
    monkeypatch.setattr(M, "ROW_BYTES", 1 << 20)
    docs = spark.range(64).selectExpr("id AS doc_id", "CAST(NULL AS string) AS text", "'x' AS ids", "7 AS position_ids", "8 AS task", "9 AS piece", "id AS length")
    rows = M.packed_rows(docs, vocabulary(), capacity=8).collect()
    assert len({r.sequence_id >> 40 for r in rows}) > 1
    assert sorted(d for r in rows for d in r.doc_ids) == list(range(64)) and sum(r.n_tokens for r in rows) == 64
    assert all(np.frombuffer(r.position_ids, "<u2").tolist() == [0] * 8 for r in rows)


def test_memory_keeps_what_was_used_last():
    from marketlake.llm.tokens import Memory

    m = Memory({" ": b"-"})
    m.update({"a": b"1", "b": b"2"})
    m.age()
    assert m["a"] == b"1" and len(m) == 2
    m.age()
    assert [m[x] for x in ("a", " ", "b")] == [b"1", b"-", None] and m.lack == ["b"]


def test_small_memories_give_the_same_ids(monkeypatch, tokenizer):
    from marketlake.llm import tokens as T

    monkeypatch.setattr(T, "MEMORY", 8)
    monkeypatch.setattr(T, "GROUP_BYTES", 64)
    texts = [r[1] for r in documents()] * 2
    for text, ids in zip(texts, Ids(vocabulary())([None if t is None else t.encode() for t in texts]), strict=True):
        assert [*np.frombuffer(ids, "<u4").tolist(), 1] == ids_of(tokenizer, text)


def test_each_chunk_of_a_group_is_looked_up_once(monkeypatch, tokenizer):
    """Repeated chunks cost no look-up of their own, odd ones no second run of the whole chain; empty groups and texts are none."""
    from marketlake.llm import tokens as T

    asked = []
    before = T.Memory.__getitem__
    monkeypatch.setattr(T.Memory, "__getitem__", lambda m, chunk: asked.append(chunk) or before(m, chunk), raising=False)
    coder = Ids(vocabulary())
    texts = [" ab,  日本\tAb-cd\x0b", "", " \n ", "İx ab," * 300, "日本 ab, É é " * 300, None]
    coded = list(coder([None if t is None else t.encode() for t in texts]))
    assert [[*np.frombuffer(ids, "<u4").tolist(), 1] for ids in coded] == [ids_of(tokenizer, t) for t in texts]
    assert len(asked) < 40
    assert list(coder([])) == [] and list(coder([None, b""])) == [b"", b""]


def test_a_worker_codes_in_one_thread():
    import os
    import subprocess
    import sys

    code = (
        "import os; from marketlake.llm.tokens import Ids; from marketlake.llm.queries import vocabulary; c = Ids(vocabulary()); "
        "before = len(os.listdir('/proc/self/task')); words = ' '.join(chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i // 676) * 3 for i in range(9000)); "
        "list(c([words.encode()])); print(len(os.listdir('/proc/self/task')) - before)"
    )
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    ran = subprocess.run([sys.executable, "-c", code], env=env, cwd=root, capture_output=True, text=True, timeout=120)
    assert ran.stdout.strip() == "0", ran.stdout + ran.stderr
