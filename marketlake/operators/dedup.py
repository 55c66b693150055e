"""Keep one row per key: the first row under a given ordering.

Two physical forms of the same semantics (ROW_NUMBER() ... = 1):

* ``window``: ``row_number`` over the key, filtered to 1.  Catalyst inserts a
  partial ``WindowGroupLimit`` before the shuffle, so duplicates of a hot key
  are cut map-side.
* ``aggregate``: ``max_by(struct(row), struct(order))`` grouped by the key;
  partial aggregation also collapses a hot key before the shuffle.

Both keep the whole row and never drop a key.  Ties (equal ordering values)
resolve to an arbitrary row, as in the SQL form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str] | list[Column], order: list[Column]) -> DataFrame:
    """Window form: rows ranked 1 per ``keys`` under ``order`` (Columns
    with asc/desc)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Aggregate form (``dedup="aggregate"`` in staging): the row with the greatest ``struct(by)`` per key.

    Equivalent to ``row_number() over (partition by keys order by by desc)``
    when ``by`` columns sort NULLs last under DESC (struct ordering puts NULL
    fields first, so max picks non-NULL first).
    """
    cols = df.columns
    picked = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in by]))
    return df.groupBy(*keys).agg(picked.alias("_row")).select("_row.*")
