"""Balance of shards around forced groups (op10), and recall of the graph on data of awkward geometry (op9)."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import ann, sharding


def smallest_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)

    def fits(most):
        used, load = 1, 0
        for s in sizes:
            if load + s > most:
                used, load = used + 1, 0
            load += s
        return used <= shards

    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def loads_of(spark, texts, shards=8):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    out = sharding.shard_rows(df, shards)
    rows = out.select("shard", "size", "slot", "text_crc32").collect()
    assert len(rows) == len(texts)
    loads = [0] * shards
    for r in rows:
        loads[r.shard] += r.size
    for k in range(shards):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))
    groups = df.select(F.sha2("text", 256).alias("key"), (F.octet_length("text") + 1).alias("bytes")).groupBy("key").agg(F.sum("bytes").alias("b"))
    ordered = [r.b for r in groups.orderBy("key").collect()]
    assert max(loads) == smallest_capacity(ordered, shards)
    return loads, ordered


def test_a_third_in_one_text_leaves_no_shard_empty(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdef") for _ in range(rng.randint(20, 180))) for _ in range(1000)]
    texts += ["the one text that has many copies " * 3] * 400
    loads, groups = loads_of(spark, texts)
    at, large = loads.index(max(groups)), groups.index(max(groups))
    left, right = sum(groups[:large]), sum(groups[large + 1 :])
    even = min(max(left / n, right / (7 - n)) for n in range(1, 7))
    assert sum(loads[:at]) == left and max(loads[:at] + loads[at + 1 :]) <= even + 181
    for side in (loads[:at], loads[at + 1 :]):  # within a group of equal on both sides
        assert max(side) - min(side) <= 181 and min(side) > 0


@pytest.mark.parametrize("seed", range(4))
def test_forced_groups_anywhere(spark, seed):
    """Two large groups and groups of all sizes: the largest load is the smallest that can be, and no shard is empty."""
    rng = random.Random(seed)
    texts = [f"{seed} {i} " + "x" * int(10 * 1.5 ** rng.randint(0, 12)) for i in range(120)] + [f"large {seed}"] * 900 + [f"other {seed} "] * 500
    loads, _ = loads_of(spark, texts, 2 + 3 * seed)
    assert min(loads) > 0


def test_few_groups(spark):
    assert sorted(loads_of(spark, ["a", "bb", "bb"], 8)[0], reverse=True)[:2] == [6, 2]
    assert loads_of(spark, ["same"] * 10, 3)[0].count(0) == 2


@pytest.mark.parametrize("kind", ["plain", "shifted", "scaled", "small", "clusters", "mixed"])
def test_recall_whatever_the_geometry(kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 32))
    x = {
        "plain": x, "shifted": 1000 + 0.01 * x, "scaled": x * 1e25, "small": x * 1e-30, "mixed": x * 10.0 ** rng.integers(-2, 3, (3000, 1)),
        "clusters": (rng.normal(size=(40, 32)) * 1000)[rng.integers(0, 40, 3000)] + 0.01 * x,
    }[kind]
    graph, hit = ann.Graph.build(x), 0
    for q in range(0, 3000, 50):
        near = lambda rows: ((x[rows] - x[q]) ** 2).sum(axis=1)
        true = [v for v in np.argsort(near(np.arange(3000)), kind="stable") if v != q][:10]
        found = graph.search(x[q])
        hit += len(set(true) & {v for v in found[np.argsort(near(found))] if v != q and v in true})
    assert hit / 600 >= 0.95
