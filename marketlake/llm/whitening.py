"""Embedding whitening: exact covariances by bit-sliced cross-products, then the leading principal components at unit variance.

Each entry becomes the integer floor(256 * entry). The fit list is each distinct integer vector once. A task packs every dimension's
shifted bits into planes, one 64-bit word per 64 rows; the cross-product of two dimensions is the sum over their planes a and b of
2^(a + b) times the popcount of plane a AND plane b. These are integers, so the sums of all tasks are exact whatever their order. They are
centred as integers (n * sum of products - product of sums) before the only division, and go to a symmetric eigensolver in double precision.

Defined results: vectors that are null or empty, or hold null or non-finite entries or entries whose integer exceeds 62 bits,
take no part; of different lengths, those of the most frequent length take part (of equally frequent ones the greatest). Rows that repeat are
each returned, but count once for the fit. Eigenvectors have either sign (the entry of largest size is positive) and ties of
eigenvalues any basis. Components without variance (up to rounding, as all are if there is one distinct vector) have a null ``whitened``
and are left out of ``identity_error``, which is null if no component is left; ``explained`` is null if there is no variance at all. A
``deviation`` beyond a long is null. An empty table gives an empty result. Other columns of the table are never read, so their names
are free. What passes the driver are numbers per dimension and pair of dimensions; their number doesn't grow with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import stored

SCALE, COMPONENTS = 256, 4
#: Integers of entries are below 2 ** 62 in size; products of up to 24 bits each, times a chunk's rows, stay below 63 bits.
MOST, NARROW_BITS, CHUNK = float(1 << 62), 24, 8192
LIMB = 30
LONG = (1 << 63) - 1


def integer_rows(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, x`` of the vectors that take part; x are their entries as integers."""
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vec_col].cast("array<double>").alias("v"))
    # comparisons with null are null, and with NaN false (NaN is the greatest number)
    fit = F.forall("v", lambda c: F.coalesce(F.abs(c * F.lit(float(SCALE))) < F.lit(MOST), F.lit(False)))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & fit)
    rows = stored(rows.select("id", F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))).cast("long")).alias("x")))
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(2).collect()
    return rows if len(lengths) < 2 else rows.filter(F.size("x") == lengths[0]["d"])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def bit_planes(y: np.ndarray, bits: list[int]) -> np.ndarray:
    """The planes of all dimensions of ``y`` (rows x dimensions, not negative), lowest bit first, as rows of 64-bit words."""
    words = -(-len(y) // 64)
    out = np.zeros((sum(bits), words * 8), np.uint8)
    at = 0
    for i, b in enumerate(bits):
        ones = (y[:, i, None] >> np.arange(b, dtype=np.uint64)) & np.uint64(1)
        packed = np.packbits(ones.astype(np.uint8), axis=0)
        out[at : at + b, : len(packed)] = packed.T
        at += b
    return out.view(np.uint64)


def cross_products(y: np.ndarray, bits: list[int]) -> np.ndarray:
    """Upper triangle of ``y.T @ y`` as exact integers, by AND and popcount of bit planes."""
    planes = bit_planes(y, bits)
    starts = np.concatenate([[0], np.cumsum(bits)[:-1]])
    shifts = np.concatenate([np.arange(b) for b in bits])
    wide = max(bits) > NARROW_BITS
    out = np.zeros((len(bits), len(bits)), object if wide else np.int64)
    for i, start in enumerate(starts):
        onward = planes[start:]
        for a in range(bits[i]):
            counts = np.bitwise_count(onward & planes[start + a]).sum(axis=1, dtype=np.int64)
            if wide:
                weighted = np.array([int(n) << int(a + s) for n, s in zip(counts, shifts[start:], strict=True)], object)
            else:
                weighted = counts << (a + shifts[start:])
            out[i, i:] += np.add.reduceat(weighted, starts[i:] - start)
    return out


def _products(lows: list[int], bits: list[int]):
    """Per task: (i, limb, the limb of each cross-product of dimension i), whose sums over tasks stay longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(bits), len(bits)), object)
        low = np.array(lows, np.int64)
        for batch in batches:
            x = _matrix(batch)
            for start in range(0, len(x), CHUNK):
                # the difference of two longs, taken modulo 2 ** 64, is right as an unsigned number
                total += cross_products((x[start : start + CHUNK] - low).view(np.uint64), bits)
        of, limb, parts = [], [], []
        for i, row in enumerate(total.tolist()):
            rest, k = row, 0
            while any(rest):
                of.append(i)
                limb.append(k)
                parts.append([int(v) & ((1 << LIMB) - 1) for v in rest])
                rest, k = [int(v) >> LIMB for v in rest], k + 1
        columns = [pa.array(of, pa.int32()), pa.array(limb, pa.int32()), pa.array(parts, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "limb", "parts"])

    return run


def covariance(fit: DataFrame) -> tuple[int, list[int], list[int], list[int], list[list[int]]]:
    """``n``, sums, least and greatest entries per dimension, and n * n times the covariances, all exact, of distinct rows ``x``."""
    entries = fit.select(F.posexplode("x").alias("i", "e")).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.min("e").alias("low"), F.max("e").alias("high"), F.sum(F.col("e").cast("decimal(38,0)")).alias("s")
    )
    by_dim = entries.orderBy("i").collect()
    if not by_dim:
        return 0, [], [], [], []
    n, d = by_dim[0]["n"], len(by_dim)
    sums, lows, highs = [int(r["s"]) for r in by_dim], [r["low"] for r in by_dim], [r["high"] for r in by_dim]
    bits = [max(1, (h - low).bit_length()) for low, h in zip(lows, highs, strict=True)]
    parts = fit.mapInArrow(_products(lows, bits), "i int, limb int, parts array<long>")
    limbs = parts.select("i", "limb", F.posexplode("parts").alias("j", "v")).groupBy("i", "limb", "j").agg(F.sum("v").alias("v"))
    cross = [[0] * d for _ in range(d)]
    for r in limbs.filter("v <> 0").collect():
        cross[r["i"]][r["j"]] += r["v"] << (LIMB * r["limb"])
    shifted = [s - n * low for s, low in zip(sums, lows, strict=True)]
    scatter = [[0] * d for _ in range(d)]
    for i in range(d):
        for j in range(i, d):
            scatter[i][j] = scatter[j][i] = n * cross[i][j] - shifted[i] * shifted[j]
    return n, sums, lows, highs, scatter


def components(n: int, scatter: list[list[int]], most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The leading unit eigenvectors (as columns), their eigenvalues (0 where only rounding is left), and their shares of the trace."""
    v = np.array([[e / (n * n) for e in row] for row in scatter], np.float64)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    least = max(values[0], 0) * len(scatter) * np.finfo(float).eps
    values = np.where(values > least, values, 0.0)
    trace = sum(scatter[i][i] for i in range(len(scatter))) / (n * n)
    return vectors, values, values / trace if trace > 0 else np.full(len(values), np.nan)


def _whitened(x: np.ndarray, n: int, sums: list[int], wide: bool, vectors: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whitened rows (NaN in components without variance), and n * x - sums as integers."""
    if wide:
        off = x.astype(object) * n - np.array(sums, object)
        centred = (off / n).astype(np.float64)
    else:
        off = x * n - np.array(sums, np.int64)
        centred = off / n
    with np.errstate(divide="ignore", invalid="ignore"):
        return centred @ vectors / np.where(values > 0, np.sqrt(values), np.nan), off


def _identity_error(fit: DataFrame, n: int, sums: list[int], wide: bool, vectors: np.ndarray, values: np.ndarray) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity, measured over its rows."""
    live = [k for k, e in enumerate(values) if e > 0]
    if not live:
        return None
    used, sizes = vectors[:, live], values[live]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(live), len(live)))
        for batch in batches:
            w, _ = _whitened(_matrix(batch), n, sums, wide, used, sizes)
            total += w.T @ w
        i, j = np.indices(total.shape)
        columns = [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "v"])

    found = fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    return max(abs(r["v"] / n - (r["i"] == r["j"])) for r in found)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """Per row that takes part and component up to ``most``: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    rows = integer_rows(vectors, id_col, vec_col)
    schema = T.StructType([T.StructField("vec_id", vectors.schema[id_col].dataType)]).add("component", "integer").add("n", "long")
    schema = schema.add("deviation", "long").add("whitened", "double").add("explained", "double").add("identity_error", "double")
    fit = stored(rows.select("x").distinct())
    n, sums, lows, highs, scatter = covariance(fit)
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    basis, values, shares = components(n, scatter, most)
    farthest = max(max(n * h - s, s - n * low) for s, low, h in zip(sums, lows, highs, strict=True))
    # the largest number on the way, then the largest sum of squares
    wide = max(n * max(map(abs, [*lows, *highs])), *map(abs, sums), farthest) > LONG
    square_wide = len(sums) * farthest * farthest > LONG
    error, k = _identity_error(fit, n, sums, wide, basis, values), len(values)
    shares = [None if np.isnan(e) else float(e) for e in shares]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            w, off = _whitened(_matrix(batch), n, sums, wide, basis, values)
            if square_wide:
                far = [v if v <= LONG else None for v in (off.astype(object) ** 2).sum(axis=1)]
            else:
                far = (off**2).sum(axis=1)
            each = pa.array(np.repeat(np.arange(batch.num_rows), k))
            many = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1), many), pa.int32()),
                    pa.array(np.full(many * k, n), pa.int64()), pa.array(far, pa.int64()).take(each),
                    pa.array(w.ravel(), pa.float64(), mask=np.isnan(w.ravel())), pa.array(shares * many, pa.float64()),
                    pa.array([error], pa.float64()).take(pa.array(np.zeros(many * k, np.int64))),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)
