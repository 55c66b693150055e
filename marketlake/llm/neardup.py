"""Near-duplicates by DartMinHash signatures and banded joining.

A document is a weighted set of five-word shingles; the weight is how often a shingle occurs, taken as
layers of weight one. Hashed darts fall on each layer's region as a Poisson process over ranks
(the gaps are exponentials of the dart's hash), so equal elements get equal darts in all documents. A document
throws the darts of rank up to t / weight, t = k ln k + 2k on average, and keeps for each of k
coordinates the earliest; where a coordinate stays empty it throws up to twice the rank. Two documents agree in a
coordinate with the probability of their weighted Jaccard similarity.

Exact copies are joined by their hash first. Documents that agree in a band are candidates. Each bucket is
tested against two of its members, the one in most and largest buckets and one at random, by the exact similarity
of their shingles (in tasks that hold one such member and stream the others). What is linked is joined to components. Buckets that
then still hold several components are tested whole, in blocks: all members of the smaller components against all others. So no
pair of a bucket with members of different components stays untested; with 24 bands of 4 a link at
0.8 is missed by all bands with probability 3e-6.

Defined results: null and empty texts and texts without words have no shingles and are a class each; a text of
one to four words has one shingle, all of it; the class is named by its smallest doc_id (nulls last), whose row is
kept, one of them if rows repeat; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import shielded, stored, tidy_task
from marketlake.llm.components import components
from marketlake.llm.shingles import grouped, mixed, shingle_elements

BANDS, ROWS = 24, 4
COORDINATES = BANDS * ROWS
SIMILAR = (4, 5)  # similarity of 4/5 or more
SALTS, BLOCK = 64, 512
_NEXT, _PLACE = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def earliest_darts(elements: np.ndarray, doc: np.ndarray, docs: int, k: int = COORDINATES) -> np.ndarray:
    """For each of ``docs`` documents the hash of the earliest dart of each of ``k`` coordinates (0 for a document without elements)."""
    out = np.zeros((docs, k), dtype=np.uint64)
    weight = np.bincount(doc, minlength=docs)
    darts = k * math.log(k) + 2 * k
    todo = weight > 0
    while todo.any():
        limit = np.where(todo, darts / np.maximum(weight, 1), 0.0)
        e, of = elements[todo[doc]], doc[todo[doc]]
        rank, now, found = np.zeros(len(e)), e, []
        while len(now):
            now = mixed(now + _NEXT)
            rank = rank - np.log1p(-(now >> np.uint64(11)).astype(np.float64) / 2.0**53)
            inside = rank <= limit[of]
            now, rank, of = now[inside], rank[inside], of[inside]
            found.append((now, rank, of))
        dart, rank, of = (np.concatenate(x) for x in zip(*found, strict=True))
        place = of * k + (mixed(dart ^ _PLACE) % np.uint64(k)).astype(np.int64)
        order = np.lexsort((dart, rank))
        cells, first = np.unique(place[order], return_index=True)
        out.reshape(-1)[cells] = dart[order][first]
        full = np.bincount(cells // k, minlength=docs) == k
        todo &= ~full
        darts *= 2
    return out


def bands_of(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    part = signatures.reshape(len(signatures), bands, rows)
    out = np.zeros(part.shape[:2], dtype=np.uint64)
    for r in range(rows):
        out = mixed(out + part[:, :, r])
    return out.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        weights, bands = [np.zeros(0, np.int64)], [np.zeros((0, BANDS), np.int64)]
        for texts in grouped(batch.column("text").cast(pa.large_binary()).to_pylist()):
            elements, doc = shingle_elements(texts)
            weights.append(np.bincount(doc, minlength=len(texts)))
            bands.append(bands_of(earliest_darts(elements, doc, len(texts))))
        flat = pa.array(np.concatenate(bands).reshape(-1))
        lists = pa.FixedSizeListArray.from_arrays(flat, BANDS).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(np.concatenate(weights)), lists],
            names=["doc_id", "key", "weight", "bands"],
        )


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements of each text as sorted 32-bit hashes."""
    for batch in batches:
        out = []
        for texts in grouped(batch.column("text").cast(pa.large_binary()).to_pylist()):
            elements, doc = shingle_elements(texts)
            ends = np.searchsorted(doc, np.arange(len(texts) + 1))
            short = (elements >> np.uint64(32)).astype(np.uint32)
            out += [np.sort(short[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.binary())], names=["node", "elements"])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _similar(common, a, b):
    return common * (SIMILAR[0] + SIMILAR[1]) >= SIMILAR[0] * (a + b)


def _against_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted so that each head comes before those to test against it: the similar pairs."""
    head, held = None, np.zeros(0, np.uint32)
    for batch in batches:
        a, b = [], []
        columns = (batch.column(c).to_pylist() for c in ("head", "node", "elements"))
        for of, node, data in zip(*columns, strict=True):
            own = np.frombuffer(data, np.uint32)
            if of == node:
                head, held = of, own
            elif of == head and _similar(_common(held, own), len(held), len(own)):
                a.append(of)
                b.append(node)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _block_links(nodes: np.ndarray, roots: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join all that the similar pairs of different roots join, at most one for each node."""
    size = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    own = np.repeat(np.arange(len(sets)), size)
    _, place, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count[place] > 1
    place, own = np.unique(place[shared], return_inverse=True)[1], own[shared]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 4096
    order = np.argsort(place, kind="stable")
    place, own = place[order], own[order]
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(place, [start, start + width])
        has = np.zeros((len(sets), width), dtype=np.float32)
        has[own[a:b], place[a:b] - start] = 1
        common += has @ has.T
    linked = _similar(common, size[:, None], size[None, :]) | (roots[:, None] == roots[None, :])
    label = np.arange(len(sets))
    while True:
        new = np.where(linked, label[None, :], len(sets)).min(axis=1)
        new = np.minimum(new, label)[np.minimum(new, label)]
        if (new == label).all():
            break
        label = new
    return [(int(nodes[label[i]]), int(nodes[i])) for i in range(len(sets)) if label[i] != i and roots[label[i]] != roots[i]]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: links within each block between nodes of different roots."""
    key, rows = None, []

    def done() -> list[tuple[int, int]]:
        seen = {}
        for node, root, data in rows:
            seen[node] = (root, data)
        if len({r for r, _ in seen.values()}) < 2:
            return []
        nodes, roots = np.array(list(seen)), np.array([r for r, _ in seen.values()])
        return _block_links(nodes, roots, [np.frombuffer(d, np.uint32) for _, d in seen.values()])

    def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("band", "h", "x", "y", "node", "root", "elements"))
        for *at, node, root, data in zip(*columns, strict=True):
            if at != key:
                if len(rows) > 1:
                    yield out(done())
                key, rows = at, []
            rows.append((node, root, data))
    if len(rows) > 1:
        yield out(done())


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _first_row() -> Column:
    """Rows in the order in which they name and represent a class."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("node").alias("node"))


def _with_elements(nodes: DataFrame, texts: DataFrame, representatives: DataFrame) -> DataFrame:
    """``node, elements`` of the given distinct nodes, from one text of each."""
    wanted = representatives.join(nodes, "node", "left_semi").select(F.col("key").alias("of"), "node")
    found = texts.select("key", "text").join(wanted, F.col("key") == F.col("of")).select("node", "text")
    return stored(found.mapInArrow(tidy_task(_elements), "node long, elements binary").dropDuplicates(["node"]))


def _bucket_members(representatives: DataFrame) -> DataFrame:
    """``band, h, node, weight, members`` of all buckets with two members or more."""
    rows = representatives.select("node", "weight", F.posexplode("bands").alias("band", "h"))
    shared = rows.groupBy("band", "h").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    return stored(rows.join(shared, ["band", "h"]))


def _head_pairs(members: DataFrame) -> DataFrame:
    """``head, node``: every member with its bucket's most connected member and with a random one, if their weights allow a link."""
    score = members.groupBy("node").agg(F.sum("members").alias("score"))
    heads = (
        members.join(score, "node")
        .groupBy("band", "h")
        .agg(
            F.max(F.struct("score", "node", "weight")).alias("most"),
            F.min(F.struct(F.xxhash64("node").alias("order"), "node", "weight")).alias("any"),
        )
        .select("band", "h", F.explode(F.array(F.struct("most.node", "most.weight"), F.struct("any.node", "any.weight"))).alias("head"))
    )
    pairs = members.join(heads, ["band", "h"]).filter(F.col("node") != F.col("head.node")).filter(
        _weights_allow(F.col("weight"), F.col("head.weight"))
    )
    return pairs.select(F.col("head.node").alias("head"), "node").distinct()


def _weights_allow(a: Column, b: Column) -> Column:
    return F.least(a, b) * SIMILAR[1] >= F.greatest(a, b) * SIMILAR[0]


def _linked_pairs(pairs: DataFrame, elements: DataFrame) -> DataFrame:
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    heads = salted.select("head", "salt").distinct().join(elements, F.col("head") == F.col("node"))
    rest = salted.join(elements, "node")
    columns = ["head", "salt", "node", "elements"]
    rows = heads.select(columns).union(rest.select(columns))
    return (
        rows.repartition("head", "salt")
        .sortWithinPartitions("head", "salt", F.col("node") != F.col("head"))
        .select("head", "node", "elements")
        .mapInArrow(tidy_task(_against_head), "a long, b long")
    )


def _mixed_blocks(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``band, h, x, y, node, root``: the members of buckets of several components, once for each block they are tested in."""
    rows = members.filter("members > 2").join(roots.select("node", "root"), "node", "left")
    rows = rows.withColumn("root", F.coalesce("root", "node"))
    by_root = rows.groupBy("band", "h", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed_buckets = (
        by_root.groupBy("band", "h")
        .agg(F.count(F.lit(1)).alias("roots"), F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("all"))
        .filter("roots > 1")
        .select(
            "band", "h", F.col("main.root").alias("main"),
            F.ceil(F.col("main.n") / BLOCK).cast("int").alias("main_blocks"),
            F.ceil((F.col("all") - F.col("main.n")) / BLOCK).cast("int").alias("rest_blocks"),
        )
    )
    rows = rows.join(mixed_buckets, ["band", "h"])
    is_main = F.col("root") == F.col("main")
    own = F.pmod(F.xxhash64("node"), F.when(is_main, F.col("main_blocks")).otherwise(F.col("rest_blocks"))).cast("int")
    rest = F.sequence(F.lit(0), F.col("rest_blocks") - 1)
    main = F.sequence(F.lit(0), F.col("main_blocks") - 1)
    # x is a block of the rest; y is a block of the rest, or -1 - a block of the main component
    of_main = F.transform(rest, lambda x: F.struct(x.alias("x"), (-1 - F.col("own")).alias("y")))
    of_rest = F.concat(
        F.transform(rest, lambda y: F.struct(F.least(y, F.col("own")).alias("x"), F.greatest(y, F.col("own")).alias("y"))),
        F.transform(main, lambda y: F.struct(F.col("own").alias("x"), (-1 - y).alias("y"))),
    )
    return (
        rows.withColumn("own", own)
        .select("band", "h", "node", "root", F.explode(F.when(is_main, of_main).otherwise(of_rest)).alias("at"))
        .select("band", "h", "at.x", "at.y", "node", "root")
    )


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, kept, key`` of every row; ``key`` is the hash of the text."""
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), text_key(docs[text_col]).alias("key"))
    id_type = docs.schema[id_col].dataType.simpleString()
    signed = texts.mapInArrow(tidy_task(_signed), f"doc_id {id_type}, key binary, weight long, bands array<long>")
    signed = stored(signed.withColumn("node", F.monotonically_increasing_id()))
    worded = signed.filter("weight > 0")
    representatives = stored(
        worded.groupBy("key").agg(F.min_by(F.struct("doc_id", "node", "weight", "bands"), _first_row()).alias("first")).select("key", "first.*")
    )
    members = _bucket_members(representatives)
    pairs = stored(_head_pairs(members))
    tested = pairs.select("node").union(pairs.select("head")).union(members.filter("members > 2").select("node")).distinct()
    elements = _with_elements(tested, texts, representatives)
    links = stored(_linked_pairs(pairs, elements))
    roots = components(links)
    blocks = stored(_mixed_blocks(members, roots))
    more = (
        blocks.join(elements, "node")
        .repartition("band", "h", "x", "y")
        .sortWithinPartitions("band", "h", "x", "y")
        .select("band", "h", "x", "y", "node", "root", "elements")
        .mapInArrow(tidy_task(_blocks), "a long, b long")
    )
    more = stored(more)
    roots = components(links.union(more)) if not more.isEmpty() else roots
    rooted = representatives.select("key", "doc_id", "node").join(roots, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min(_first_row()).alias("first"))
    by_text = stored(rooted.join(named, "root").select(F.col("key").alias("of"), F.col("first.id").alias("class_id"), F.col("first.node").alias("first")))
    with_words = worded.join(by_text, F.col("key") == F.col("of")).select("doc_id", "class_id", (F.col("node") == F.col("first")).alias("kept"), "key")
    without = signed.filter("weight = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"), "key")
    return with_words.union(without)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, kept``: the class of every document; one row of each class is kept."""
    return classes(docs, id_col, text_col).select("doc_id", "class_id", "kept")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (with doc_id and text) that represent their class, with its columns, whatever their names."""
    inner, restore = shielded(docs, ["doc_id", "text"])
    kept = classes(inner).filter("kept").select(F.struct("doc_id", "key").alias("__kept"))
    rows = inner.withColumn("__key", text_key(inner["text"]))
    match = F.col("doc_id").eqNullSafe(F.col("__kept.doc_id")) & (F.col("__key") == F.col("__kept.key"))
    worded = rows.join(kept.dropDuplicates(), match, "left_semi")
    return restore(worded.dropDuplicates(["doc_id", "__key"]))
