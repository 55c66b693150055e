"""Mixing sources to target weights by nested hash thresholds [DataFrame functions only].

Each source gets a token budget. Whole passes over a source are taken by everyone; the rest of
the budget is a prefix of the source in hash order, found without sorting documents: sum tokens
by source and the leading hash bits, locate the bucket that the budget ends in, and look only into
that bucket with the next bits. After the last level the threshold is one hash value per source,
and taking is a filter on the hash.

Defined results: a null text has size 0 and is taken 0 words; a null source is a source, last in
order; rows equal in id, source and text share a hash and are taken alike (at the boundary the whole tie
is in or out, whichever is nearer to the budget); an empty table gives an empty result; other
columns are ignored, whatever their names. Statistics cover all rows; one row per source is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import shielded, stored, word_count

HASH_HEX, LEVEL_BITS, LEVELS = 12, 12, 4


def mix_hash(doc_id: Column, source: Column, text: Column) -> Column:
    """48 bits that depend on a row's content only."""
    plain = [F.coalesce(c.cast("string"), F.lit("\\N")) for c in (doc_id, source, text)]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *plain)), 1, HASH_HEX), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int], share: float, max_repeats: int) -> DataFrame:
    """One row per source: ``source, source_size, target, whole`` (full passes) and ``rest`` (tokens beyond them).

    Sources in code point order (null last) weigh ``weights`` in turn and share ``share`` times all
    tokens. No target is above ``max_repeats`` times its source; the excess goes to the others by
    weight. That fixed point is one level ``L`` with target = min(cap, weight * L): with sources
    ordered by cap per weight, L is the largest of the levels got by capping each prefix.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    position = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (position % len(weights) + 1).cast("int"))
    totals = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeats)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    budget = F.lit(float(share)) * F.sum("source_size").over(every)
    level = totals.withColumn("level", (budget - before) / left)
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.max("level").over(every))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return (
        level.withColumn("target", target)
        .withColumn("whole", whole.cast("long"))
        .select(
            "source", "source_size", "target", "whole",
            (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"),
        )
    )


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``threshold``: rows with a hash below it are taken once more than ``whole`` times.

    The last tie is taken if that is nearer to the budget.
    """
    state = targets.withColumns({"prefix": F.lit(0).cast("long"), "base": F.lit(0).cast("long")})
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        current = state.withColumnRenamed("source", "of")
        bucket = F.shiftright("h", shift)
        inside = sized.join(
            current.select("of", "prefix", "base", "rest").filter("rest > 0"),
            F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix")),
        )
        counts = inside.groupBy("source", bucket.alias("bucket")).agg(
            F.sum("size").alias("s"), F.first("base").alias("base"), F.first("rest").alias("rest")
        )
        upto = F.sum("s").over(Window.partitionBy("source").orderBy("bucket")) + F.col("base")
        edge = (
            counts.withColumn("upto", upto)
            .withColumn("below", F.col("upto") - F.col("s"))
            .filter((F.col("below") < F.col("rest")) & (F.col("rest") <= F.col("upto")))
            .select(
                F.col("source").alias("at"), F.col("bucket"), F.col("below"),
                (F.col("below") + F.col("upto") < 2 * F.col("rest")).cast("long").alias("take"),
            )
        )
        last = level == LEVELS - 1
        state = stored(
            state.join(edge, F.col("source").eqNullSafe(F.col("at")), "left").select(
                "source", "source_size", "target", "whole", "rest",
                F.coalesce(F.col("bucket") + F.col("take") * int(last), F.lit(0).cast("long")).alias("prefix"),
                F.coalesce("below", F.lit(0).cast("long")).alias("base"),
            )
        )
    return state.select("source", "source_size", "target", "whole", F.col("prefix").alias("threshold"))


def sized_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    doc_id, source, text = docs[id_col], docs[source_col], docs[text_col]
    return docs.select(
        doc_id.alias("doc_id"), source.alias("source"), word_count(text).alias("size"),
        mix_hash(doc_id, source, text).alias("h"),
    )


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_repeats: int = 2,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` (words, repeats counted)."""
    sized = stored(sized_rows(docs, id_col, text_col, source_col))
    plan = thresholds(sized, stored(source_targets(sized, weights, share, max_repeats)))
    times = F.col("whole") + (F.col("h") < F.col("threshold")).cast("long")
    plan = plan.withColumnRenamed("source", "of")
    return sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def mixed_rows(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_repeats: int = 2,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all its columns unchanged, whatever their names."""
    docs, restore = shielded(docs, [id_col, text_col, source_col])
    sized = stored(sized_rows(docs, id_col, text_col, source_col))
    plan = thresholds(sized, stored(source_targets(sized, weights, share, max_repeats)))
    plan = plan.select(F.struct("source", "whole", "threshold").alias("__mix"))
    h = mix_hash(docs[id_col], docs[source_col], docs[text_col])
    marked = docs.withColumn("__mix_h", h).join(plan, docs[source_col].eqNullSafe(F.col("__mix.source")))
    times = (F.col("__mix.whole") + (F.col("__mix_h") < F.col("__mix.threshold")).cast("long")).cast("int")
    return restore(
        marked.withColumn("__mix_times", times)
        .filter("__mix_times > 0")
        .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_times"))))
    )


#: The same mix for DuckDB, by running totals in hash order instead of histograms.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '\N') || '|' || coalesce(source, '\N') || '|' || coalesce(text, '\N')), 1, 12))::BIGINT AS h
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 2 * source_size AS cap,
    [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM totals),
levels AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
      - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed WINDOW f AS (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST)),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * max(level) OVER ()) AS target FROM levels),
ties AS (SELECT source, h, sum(size)::BIGINT AS s FROM sized GROUP BY source, h),
running AS (SELECT *, (sum(s) OVER (PARTITION BY source ORDER BY h))::BIGINT AS upto FROM ties),
plan AS (
  SELECT r.source, r.h, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
    r.upto, r.s FROM running r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
taken AS (
  SELECT source, h, source_size, target,
    whole::BIGINT + CASE WHEN (2 * upto - s)::DOUBLE < 2 * (target - whole * source_size) THEN 1 ELSE 0 END AS times FROM plan)
SELECT z.doc_id, z.size::BIGINT AS size, t.source_size, t.target, (z.size * t.times)::BIGINT AS taken
FROM sized z JOIN taken t ON z.source IS NOT DISTINCT FROM t.source AND z.h = t.h
"""
