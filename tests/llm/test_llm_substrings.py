import hashlib
import random

import numpy as np
from llm_cases import documents, frame, without_repeats
from marketlake.llm import substrings as S


def compare(spark, rows, **more):
    got = S.repeated_strings(frame(spark, rows), **more).collect()
    want = without_repeats([(r[0], r[1]) for r in rows])
    key = lambda d: -1 if d is None else d
    assert sorted((key(g.doc_id), g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got) == sorted(
        (key(r[0]), n, removed, spans, hashlib.sha256(left).hexdigest()) for r, (n, removed, spans, left) in zip(rows, want)
    )
    return want


def test_matches_brute_force(spark):
    want = compare(spark, documents())
    assert sum(w[1] for w in want) > 5000


def test_small_alphabets_edges_and_overlaps(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):  # few letters: many matches of every length around the bound, in all alignments
        text = "".join(rng.choice("ab" if i % 2 else "abé") for _ in range(rng.randint(0, 120)))
        if rows and rng.random() < 0.7:
            other = rng.choice(rows)[1]
            a = rng.randint(0, max(0, len(other) - 1))
            text += other[a : a + rng.choice((48, 49, 50, 51, 70))] + rng.choice(("", "x", text))
        rows.append((rng.choice((i, i, 5, None)), text, "en", "s"))
    rows += [(100, "a" * 500, "en", "s"), (101, "a" * 49, "en", "s"), (102, "a" * 50, "en", "s"), (103, "b" + "a" * 60, "en", "s")]
    compare(spark, rows)


def test_many_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(S, "BUCKET_BYTES", 3000)
    monkeypatch.setattr(S, "CHUNK_BYTES", 500)
    compare(spark, [r for r in documents() if r[0] != 94])


def test_cut_text_and_empty_table(spark):
    docs = frame(spark, documents())
    cut = S.drop_repeated_strings(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    rows = documents()
    want = {r[0]: left.decode("utf-8", "ignore") for r, (_, _, _, left) in zip(rows, without_repeats([(r[0], r[1]) for r in rows])) if r[1]}
    got = {r.doc_id: r.text for r in cut.select("doc_id", "text").collect() if r.text}
    assert all(got.get(d, "") == t for d, t in want.items() if d is not None)
    assert S.repeated_strings(docs.filter("false")).collect() == []


def test_cover_reaches_every_pair_of_residues():
    differences = {(a - b) % S.CYCLE for a in S.COVER for b in S.COVER}
    assert differences == set(range(S.CYCLE))


def test_samples_agree_on_equal_strings():
    import pyarrow as pa

    rng = random.Random(1)
    shared = "".join(rng.choice("abcdef") for _ in range(50))
    texts = ["".join(rng.choice("abcdef") for _ in range(rng.randint(0, 40))) + shared + "zz" * k for k in range(20)]
    rows = pa.record_batch({"doc_id": pa.array(range(20), pa.int64()), "text": pa.array(texts, pa.string())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_batch(rows)
    block = S.Block(sink.getvalue().to_pybytes(), "doc_id", "text")
    first, count, place, h, doc = block.samples()
    offsets = set()
    for k, text in enumerate(texts):
        at = int(block.starts[k]) + text.index(shared)
        own = np.flatnonzero((first <= at) & (at < first + count))
        assert len(own) == 1 and doc[own[0]] == k
        offsets.add((int(place[own[0]]) - at, int(h[own[0]])))
    assert len(offsets) == 1


def phrases(rng, n):
    """Texts with one phrase below LENGTH bytes between other neighbours, some with a longer part of an earlier one, some with copies inside."""
    rows = []
    for i in range(n):
        left, right = ("".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 50))) for _ in range(2))
        text = f"{left}Share this page on Facebook ..{right}"
        if rows and rng.random() < 0.1:
            other = rng.choice(rows)[1]
            a = other.index("Share") - rng.randint(0, 20)
            text += " " + other[a : a + rng.randint(45, 60)]
        rows.append((rng.choice((i, i, i, 5, None)), text * rng.choice((1, 1, 1, 2)), "en", "s"))
    rng.shuffle(rows)
    return rows


def test_strings_of_frequent_samples(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 2, raising=False)
    monkeypatch.setattr(S, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(S, "BUCKET_BYTES", 9000)
    want = compare(spark, phrases(random.Random(4), 300) + [r for r in documents() if r[0] != 94])
    assert sum(w[1] for w in want) > 5000


def test_frequent_sample_does_not_fill_a_bucket(spark, monkeypatch):
    sort = S._sort_bucket

    def bounded(*args):
        n = sum(int.from_bytes(p[:8], "little") for p in args[-1].column("payload").to_pylist())
        assert n <= 7 * 64, f"{n} contexts in a bucket"  # the phrase has 7 samples
        return sort(*args)

    monkeypatch.setattr(S, "_sort_bucket", bounded)
    monkeypatch.setattr(S, "HOT", 64, raising=False)
    monkeypatch.setattr(S, "BLOCK_BYTES", 10_000)
    monkeypatch.setattr(S, "BUCKET_BYTES", 10_000)
    rng = random.Random(9)
    rows = [r for r in phrases(rng, 1700) if len(r[1]) < 140]
    assert len(rows) > 1000
    compare(spark, rows)


def test_bucket_is_sorted_in_pieces(monkeypatch):
    """A bucket of many contexts takes little more than its own size, and the pieces give the bits of the whole."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from marketlake.llm import substrings as S

    rng, n = np.random.default_rng(3), 120_000
    count, offset = np.full(n, 13, np.uint8), np.full(n, 12, np.uint8)
    texts = rng.integers(97, 99, (n, S.LENGTH + 12), dtype=np.uint8)
    texts[:, :44] = texts[:: n // 10][:10][rng.integers(0, 10, n)][:, :44]
    h = np.repeat(rng.integers(1, 1 << 62, n // 4).astype(np.uint64), 4)
    columns = (np.arange(n), h, np.arange(n), offset, count, texts.reshape(-1))
    rows = pa.table({"bucket": [0], "block": [7], "payload": pa.array([S._payload(*columns)], pa.binary())})
    tracemalloc.start()
    pieces = S._sort_bucket(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6, peak  # 133 MB; all at once took 461 MB
    monkeypatch.setattr(S, "AT_ONCE", 1 << 40)
    whole = S._sort_bucket(rows)
    got, want = ([S._columns(p, S._ANSWER) for p in t.column("payload").to_pylist()] for t in (pieces, whole))
    assert got and all((a == b).all() for g, w in zip(got, want, strict=True) for a, b in zip(g, w, strict=True))
