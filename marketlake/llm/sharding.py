"""Sharding: minimax contiguous partition of ordered atomic groups.

Rows with equal text form one atomic group. Groups are ordered by the hash of their text, so a group's
place doesn't depend on the other data. Running sums of group sizes are computed in blocks of the hash
range. The smallest shard capacity with which a greedy walk fits everything into the shards is
found by bisection, many capacities at a time: a step of the walk asks the stored running
sums for the last group end that is within reach, which is one filtered aggregate (the filter
on the ends prunes row groups). Within that capacity the cuts go where the loads are near equal: a group above an even share gets a
shard of its own, what lies on both sides of it is cut again, and elsewhere each cut is at the group end nearest to an equal
share of what is left. Only those few numbers reach the driver.

Defined results: a null text has size 1 (no bytes plus 1) and checksum 0 and belongs to the group of the empty text; rows equal in
id and text are interchangeable; an empty table gives an empty result; a group larger than an even
share is kept whole and sets the capacity; texts are read whole, however long; other columns are never read, so their names are free; with fewer groups than shards some shards stay empty.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import parts, stored

#: Capacities tried per round; ranges of the hash that running sums are computed in; rows numbered together.
CANDIDATES, BLOCK_HEX, CELL_ROWS = 64, 3, 20_000


def group_ends(groups: DataFrame) -> DataFrame:
    """``groups`` (key, bytes) with ``stop``, the running sum of bytes in key order."""
    block = F.substring("key", 1, BLOCK_HEX)
    groups = groups.withColumn("block", block)
    sums = groups.groupBy("block").agg(F.sum("bytes").alias("inside"))
    # at most 16 ** BLOCK_HEX rows, whatever the data
    before = F.sum("inside").over(Window.orderBy("block")) - F.col("inside")
    offsets = sums.select(F.col("block").alias("of"), before.alias("before"))
    upto = F.sum("bytes").over(Window.partitionBy("block").orderBy("key"))
    return groups.join(offsets, F.col("block") == F.col("of")).select(
        "key", "bytes", (upto + F.col("before")).alias("stop")
    )


def walk(ends: DataFrame, capacities: list[int], shards: int, largest: int, total: int) -> list[list[int]]:
    """For each capacity the greedy cuts: each shard takes groups up to its capacity; the last entry is what is left over."""
    cuts = [[0] for _ in capacities]
    for _ in range(shards):
        reach = [c[-1] + most for c, most in zip(cuts, capacities, strict=True)]
        near = ends.filter((F.col("stop") > min(reach) - largest) & (F.col("stop") <= max(reach)))
        beyond = F.size(F.filter(F.lit(reach), lambda r: r < F.col("stop")))  # how many it is too far for
        last = dict(near.groupBy(beyond.alias("beyond")).agg(F.max("stop")).collect())  # a row per capacity at most
        at = 0
        for i, c in enumerate(cuts):
            at = max(at, last.get(i, 0))
            c.append(total if reach[i] >= total else max(c[-1], at))
    return cuts


def minimax_cuts(ends: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the running sums at which its shards end."""
    seen = ends.agg(F.max("stop"), F.max("bytes")).first()
    if seen[0] is None:
        return 0, [0] * shards
    total, largest = seen
    even = -(-total // shards)
    low, high = max(largest, even) - 1, even + largest  # low fails or is below every bound; high never fails
    best: list[int] = []
    while high - low > 1 or not best:
        step = max(1, (high - low) // (CANDIDATES + 1))
        tried = sorted({min(high, low + step * k) for k in range(1, CANDIDATES + 1)} | {high})
        for capacity, cuts in zip(tried, walk(ends, tried, shards, largest, total), strict=True):
            if cuts[-1] >= total:
                high, best = capacity, cuts[1:]
                break
            low = capacity
    return high, best


def _within(ends: DataFrame, low: int, high: int) -> DataFrame:
    """The groups between two running sums, as a table of its own."""
    return ends.filter((F.col("stop") > low) & (F.col("stop") <= high)).withColumn("stop", F.col("stop") - low)


def _even_cuts(ends: DataFrame, shards: int, capacity: int, largest: int, total: int) -> list[int]:
    """Cuts as near as can be to equal shares of what is left, with no shard beyond ``capacity`` (which is feasible)."""
    needed, latest = [total], total  # from each of these sums on, the shards that follow hold the rest
    for _ in range(shards - 1):
        # the last shards take as much as they can: the first group end from which all to the end fits
        far = ends.filter((F.col("stop") >= latest - capacity) & (F.col("stop") <= latest - capacity + largest)).agg(F.min("stop")).first()[0]
        latest = 0 if latest <= capacity else far
        needed.append(latest)
    cuts, start = [], 0
    for k in range(shards - 1):
        share = start + (total - start) / (shards - k)
        near = ends.filter((F.col("stop") > share - largest) & (F.col("stop") < share + largest)).agg(
            F.max(F.when(F.col("stop") <= share, F.col("stop"))).alias("below"), F.min(F.when(F.col("stop") >= share, F.col("stop"))).alias("above")
        ).first()
        below, above = max(start, near["below"] or 0), near["above"] or total
        cut = above if above - start <= capacity and (above - share <= share - below or below == start) else below
        start = max(start, cut, needed[shards - 1 - k])
        cuts.append(start)
    return [*cuts, total]


def balanced_cuts(ends: DataFrame, shards: int) -> list[int]:
    """Running sums at which the shards end: the largest load is the smallest that can be, and the others are near equal.

    A group above an even share gets a shard of its own, and what lies before and after it is cut again into the shards that are left, as
    long as that makes no load larger than the smallest feasible capacity.
    """
    seen = ends.agg(F.max("stop").alias("total"), F.max("bytes").alias("largest")).first()
    total, largest = seen["total"], seen["largest"]
    if total is None or shards < 2:
        return [total or 0] * shards
    capacity, _ = minimax_cuts(ends, shards)
    if largest * shards > total:
        at = ends.filter(F.col("bytes") == largest).agg(F.min("stop")).first()[0]
        before = at - largest
        held = ends.agg(F.count_if(F.col("stop") <= before).alias("left"), F.count_if(F.col("stop") > at).alias("right")).first()
        spare = shards - 1
        splits = [
            (max(before / n if n else 0, (total - at) / (spare - n) if spare - n else 0), n)
            for n in range(spare + 1)
            if (n > 0) == (before > 0) or (before == 0 and n <= max(0, spare - held["right"]))
            if spare - n > 0 or total == at
        ]
        whole = [x for x in splits if x[1] <= held["left"] and spare - x[1] <= held["right"]] or splits
        if whole:
            n = min(whole)[1]
            left = balanced_cuts(_within(ends, 0, before), n) if n else []
            right = [at + c for c in balanced_cuts(_within(ends, at, total), spare - n)] if spare - n else []
            cuts = [*left, at, *right]
            if cuts[-1] == total and max(b - a for a, b in pairwise([0, *cuts])) <= capacity:
                return cuts
    return _even_cuts(ends, shards, capacity, largest, total)


def shard_rows(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: whole groups, the largest shard as small as can be.

    ``slot`` numbers the rows of a shard from 0 without gaps, in cells of about CELL_ROWS rows.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = stored(
        docs.select(
            docs[id_col].alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("key"),
        )
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    ends = stored(group_ends(groups).sortWithinPartitions("stop"))
    shard = F.lit(0)
    for end in balanced_cuts(ends, shards)[:-1]:
        shard = shard + (F.col("stop") > end).cast("int")
    placed = ends.select(F.col("key").alias("of"), shard.alias("shard"))
    cells = parts(rows.count(), CELL_ROWS)
    cell = F.pmod(F.xxhash64("doc_id", "key"), F.lit(cells))
    numbered = stored(
        rows.join(placed, F.col("key") == F.col("of"))
        .withColumn("cell", cell)
        .select("doc_id", "size", "text_crc32", "shard", "cell", "key")
    )
    counts = numbered.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell")) - F.col("n")
    offsets = counts.select(F.col("shard").alias("in_shard"), F.col("cell").alias("in_cell"), before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "key"))
    return (
        numbered.withColumn("inside", inside)
        .join(offsets, (F.col("shard") == F.col("in_shard")) & (F.col("cell") == F.col("in_cell")))
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("before") + F.col("inside") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
