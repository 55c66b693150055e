"""Column-level helpers (all built from pyspark.sql.functions, JVM-side)."""

from marketlake.functions.core import (  # noqa: F401
    col_of, computed_once, json_query, json_value, kafka_key, mid, notional, path_safe, random_value, safe_divide, safe_ln, scalar_field, scalar_text,
    spread, to_price, tolerant_bool, venue_symbol_key, with_json_fields,
)
