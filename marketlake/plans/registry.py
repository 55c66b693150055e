"""Every registered query and its oracle SQL (importing the catalogs fills them)."""

from marketlake.plans import (  # noqa: F401
    calendar_catalog, ingest_catalog, quality_catalog, serving_catalog, sketch_catalog, stream_state_catalog, streaming_catalog,
)
from marketlake.plans.catalog import QUERIES  # noqa: F401
from marketlake.plans.oracle import ORACLE_SQL  # noqa: F401
