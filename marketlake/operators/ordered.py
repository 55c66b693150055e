"""Order-dependent row operators that stay parallel without a partition key.

``lag() over (order by x)`` with no PARTITION BY makes Spark move every row
into one task.  ``lag_in_order`` deals the rows to range partitions of
(group, order value, hash of the row) instead -- as many as the session's
shuffle partitions -- runs ``lag`` inside each (group, partition) and takes
the first row's predecessor from the preceding partition of its group.  The
hash splits a frequent order value over partitions, and a group holding a
third of all rows is spread like everything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import stored_table


def lag_in_order(df: DataFrame, value: str, order_by: str, group_by: list[str] | None = None,
                 out: str = "prev_value") -> DataFrame:
    """Add ``out`` = ``value`` of the previous row in ``order_by`` order
    (within ``group_by`` if given), for any orderable type.  Rows with equal
    ``order_by`` are taken in order of a hash of the row (the SQL window form
    leaves their order open).

    The ranges are stored once and read twice: for the rows, and for one row
    per (group, partition) with its last value; these few rows are joined
    back.
    """
    group_by = list(group_by or [])
    keys = [*group_by, order_by]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    dealt = df.withColumn("_tie", tie).repartitionByRange(n, *keys, "_tie").withColumn("_part", F.spark_partition_id())
    dealt = stored_table(dealt, "ordered")  # both uses below must see the same ranges
    last = dealt.groupBy(*group_by, "_part").agg(F.max_by(value, F.struct(order_by, "_tie")).alias("_last"))
    before = Window.partitionBy(*group_by).orderBy("_part")  # one row per partition that the group is in
    carry = last.select(*[F.col(c).alias(f"_g_{c}") for c in group_by], F.col("_part").alias("_of"),
                        F.lag("_last").over(before).alias("_carry"))
    w = Window.partitionBy(*group_by, "_part").orderBy(order_by, "_tie")
    rows = dealt.withColumn("_prev", F.lag(value).over(w)).withColumn("_rn", F.row_number().over(w))
    match = F.col("_part") == F.col("_of")
    for c in group_by:
        match = match & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return rows.join(carry, match, "left").withColumn(
        out, F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_prev"))).select(*df.columns, out)
