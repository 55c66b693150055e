"""Presentation for cross-engine comparison: portable column types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame, round6: tuple[str, ...] = ()) -> DataFrame:
    """Decimals -> DOUBLE, TIMESTAMP -> TIMESTAMP_NTZ (UTC wall time) and
    optional 6-place rounding of inexact DOUBLE results (means, stddevs)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        if f.name in round6:
            c = F.round(c.cast("double"), 6)
        out.append(c.alias(f.name))
    return df.select(*out)
