"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Equal vectors become one node with its smallest ids (as many as an answer can need, since ties go to smaller ids); nodes
are dealt to shards by hash. A task builds one shard's graph by inserting its nodes in order: each is linked, on every layer up to its level, to
diverse near ones among the nodes before it (distances to all of them come in matrix blocks, so
insertion finds the true nearest; they are centred and scaled first, and near ones are compared by their differences), and lists that grow too long are thinned by the same rule. The graph is stored
as flat arrays of neighbours per layer, beside the vectors. Queries go in blocks to every shard, walk
its layers, and the best found are scored on the original vectors in double precision. Every row is indexed.

Defined results: rows with a null id, and vectors that are null, empty, zero or hold a null or non-finite component take
no part; vectors of different length are never compared; a query does not find rows with its own id; with
fewer candidates than ``k`` all that were found are returned; repeated rows count once; an empty table gives an empty result; other columns are never read, so their names are free.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import parts, stored

SHARD_NODES, LINKS, CANDIDATES, WIDTH, QUERY_BLOCK, NEAREST = 16_384, 16, 64, 160, 512, 10


class Graph:
    """Layers of links over the rows of ``vectors``: for each layer its nodes and, for each of those, a row of links (-1: none)."""

    def __init__(self, vectors: np.ndarray, nodes: list[np.ndarray], links: list[np.ndarray]):
        self.vectors, self.nodes, self.links = vectors, nodes, links
        # layer 0 has all rows, in order
        self.row_of = [{int(v): k for k, v in enumerate(of)} if layer and len(of) > 1 else {} for layer, of in enumerate(nodes)]

    @classmethod
    def build(cls, vectors: np.ndarray, links: int = LINKS, candidates: int = CANDIDATES, seed: int = 0) -> Graph:
        n = len(vectors)
        # centred and scaled, so that products neither cancel nor overflow
        x = np.asarray(vectors, np.float64)
        top = np.abs(x).max(initial=0)
        x = x / top if top > 0 else x
        x = np.ascontiguousarray(x - x.mean(axis=0)) if n else x
        spread = np.abs(x).max(initial=0)
        x = x / spread if spread > 0 else x
        norm = (x * x).sum(axis=1)
        level = (-np.log1p(-np.random.default_rng(seed).random(n)) / np.log(links)).astype(int)
        level[:1] = level.max(initial=0)
        lists: list[dict[int, list[int]]] = [{} for _ in range(level.max(initial=0) + 1)]
        earlier: list[list[int]] = [[] for _ in lists]

        def diverse(of: int, near: np.ndarray, limit: int) -> list[int]:
            """Of ``near`` (nearest first) those that are nearer to ``of`` than to any chosen before; then the rest, up to ``limit``."""
            own = x[near] - x[of]  # seen from the node, distances between near ones keep all their digits
            size = (own * own).sum(axis=1)
            between = size[:, None] + size[None, :] - 2 * (own @ own.T)
            to = size.tolist()
            rows, chosen, left = between.tolist(), [], []
            for c in range(len(near)):
                if len(chosen) >= limit:
                    break
                (chosen if all(rows[c][k] > to[c] for k in chosen) else left).append(c)
            return [int(near[c]) for c in (chosen + left)[:limit]]

        def by_distance(of: int, near: np.ndarray) -> np.ndarray:
            gap = x[near] - x[of]
            return near[np.argsort((gap * gap).sum(axis=1), kind="stable")]

        for start in range(0, n, 256):
            end = min(n, start + 256)
            block = norm[start:end, None] + norm[None, :end] - 2 * (x[start:end] @ x[:end].T)
            for i in range(start, end):
                for layer in range(level[i], -1, -1):
                    known, most = earlier[layer], 2 * links if layer == 0 else links
                    if layer == 0:
                        pool, far = None, block[i - start, :i]
                    else:
                        pool = np.asarray(known, dtype=np.int64)
                        far = block[i - start, pool]
                    if len(far) > candidates:
                        near = np.argpartition(far, candidates)[:candidates]
                    else:
                        near = np.arange(len(far))
                    near = near if pool is None else pool[near]
                    chosen = diverse(i, by_distance(i, near), links)
                    table = lists[layer]
                    table[i] = chosen
                    for j in chosen:
                        table[j].append(i)
                        if len(table[j]) > 2 * most:
                            table[j] = diverse(j, by_distance(j, np.asarray(table[j])), most)
                    if layer:
                        known.append(i)
        nodes, flat = [], []
        for layer, table in enumerate(lists):
            most = 2 * links if layer == 0 else links
            out = np.full((len(table), most), -1, dtype=np.int32)
            for row, (j, to) in enumerate(table.items()):
                to = diverse(j, by_distance(j, np.asarray(to)), most) if len(to) > most else to
                out[row, : len(to)] = to
            nodes.append(np.fromiter(table, dtype=np.int32, count=len(table)))
            flat.append(out)
        return cls(vectors, nodes, flat)

    def search(self, query: np.ndarray, width: int = WIDTH) -> np.ndarray:
        """Up to ``width`` rows near ``query``, in no order."""
        if not len(self.vectors):
            return np.zeros(0, np.int64)
        best = int(self.nodes[-1][0])
        distance = self._to(query, np.array([best]))[0]
        for row_of, links in zip(self.row_of[:0:-1], self.links[:0:-1], strict=True):
            while best in row_of:
                to = links[row_of[best]]
                to = to[to >= 0]
                if not len(to):
                    break
                far = self._to(query, to)
                k = int(far.argmin())
                if far[k] >= distance:
                    break
                best, distance = int(to[k]), far[k]
        seen = np.zeros(len(self.vectors), dtype=bool)
        seen[best] = True
        ahead, found = [(distance, best)], [(-distance, best)]
        links = self.links[0]
        while ahead:
            distance, at = heapq.heappop(ahead)
            if len(found) >= width and distance > -found[0][0]:
                break
            to = links[at]
            to = to[to >= 0]
            to = to[~seen[to]]
            if not len(to):
                continue
            seen[to] = True
            for d, v in zip(self._to(query, to).tolist(), to.tolist(), strict=True):
                if len(found) < width:
                    heapq.heappush(found, (-d, v))
                elif d < -found[0][0]:
                    heapq.heapreplace(found, (-d, v))
                else:
                    continue
                heapq.heappush(ahead, (d, v))
        return np.array([v for _, v in found])

    def _to(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        gap = self.vectors[rows] - query
        return np.einsum("ij,ij->i", gap, gap)

    def stored(self) -> dict[str, list]:
        return {"nodes": [a.astype(np.int32).tobytes() for a in self.nodes], "links": [a.astype(np.int32).tobytes() for a in self.links]}

    @classmethod
    def of(cls, vectors: np.ndarray, nodes: list[bytes], links: list[bytes]) -> Graph:
        own = [np.frombuffer(b, np.int32) for b in nodes]
        return cls(vectors, own, [np.frombuffer(b, np.int32).reshape(len(a), -1) for a, b in zip(own, links, strict=True)])


_INDEX = "dim int, shard long, ids array<array<long>>, vectors binary, nodes array<binary>, links array<binary>"


def _build(key, rows):
    order = pa.compute.sort_indices(rows.column("first"))
    rows = rows.take(order)
    dim, shard = (k.as_py() for k in key)
    vectors = np.asarray(pa.compute.list_flatten(rows.column("vector").combine_chunks()), dtype=np.float64).reshape(-1, dim)
    graph = Graph.build(vectors, seed=shard).stored()
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int64()),
        "ids": pa.array([rows.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
        "vectors": pa.array([vectors.tobytes()], pa.binary()),
        "nodes": pa.array([graph["nodes"]], pa.list_(pa.binary())), "links": pa.array([graph["links"]], pa.list_(pa.binary())),
    })


def _search(width: int, k: int):
    def run(key, left, right):
        out: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            dim = key[0].as_py()
            vectors = np.frombuffer(left.column("vectors")[0].as_py(), np.float64).reshape(-1, dim)
            graph = Graph.of(vectors, left.column("nodes")[0].as_py(), left.column("links")[0].as_py())
            ids = left.column("ids")[0].as_py()
            for query_id, vector in zip(right.column("query_id").to_pylist(), right.column("vector").to_pylist(), strict=True):
                query = np.asarray(vector, dtype=np.float64)
                rows = graph.search(query, width)
                gap = vectors[rows] - query
                scores = np.sqrt((gap * gap).sum(axis=1)).tolist()
                near = [(s, v) for s, r in zip(scores, rows.tolist(), strict=True) for v in ids[r] if v != query_id]
                out += [(query_id, v, s) for s, v in heapq.nsmallest(k, near)]
        columns = zip(*out, strict=True) if out else ([], [], [])
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, types, strict=True)})

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, dim, vector`` (doubles) of the rows that take part."""
    vector = vectors[vector_col].cast("array<double>")
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vector.alias("vector")).filter("id IS NOT NULL AND vector IS NOT NULL")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(finite & F.exists("vector", lambda x: x != 0)).withColumn("dim", F.size("vector")).distinct()


def build_index(rows: DataFrame, k: int = NEAREST, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row per shard with its vectors, ids and graph, stored."""
    order = Window.partitionBy("vector").orderBy("id")
    nodes = (
        rows.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k + 1)
        .groupBy("dim", "vector")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .withColumn("first", F.element_at("ids", 1))
    )
    nodes = stored(nodes)
    shards = parts(nodes.count(), shard_nodes)
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)))
    return stored(nodes.groupBy("dim", "shard").applyInArrow(_build, _INDEX))


def search_index(index: DataFrame, queries: DataFrame, k: int = NEAREST, width: int = WIDTH) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for each of ``queries`` (id, dim, vector)."""
    blocks = parts(queries.count(), QUERY_BLOCK)
    shards = index.agg(F.max("shard")).first()[0]
    asked = queries.select(
        "dim", F.col("id").alias("query_id"), "vector", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards or 0).cast("long"))).alias("shard"),
    )
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    key = ["dim", "shard", "block"]
    found = held.groupBy(key).cogroup(asked.groupBy(key)).applyInArrow(_search(width, k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(
    vectors: DataFrame, query_step: int = 100, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest rows of every row whose id is divisible by ``query_step``."""
    rows = stored(usable(vectors, id_col, vector_col))
    return search_index(build_index(rows, k), rows.filter(F.col("id") % query_step == 0), k)
