"""Data-quality checks: each is ``fn(df, ...) -> DataFrame`` of violations.

An empty result means the check passes.  Row checks return the violating
rows themselves (all input columns); aggregate checks return one row per
failing group with the measured value.  ``suite.run_suite`` evaluates many
checks and fuses the row-level ones on the same table into one scan.
"""

from marketlake.quality.aggregates import *  # noqa: F401,F403
from marketlake.quality.column import *  # noqa: F401,F403
from marketlake.quality.distinct import *  # noqa: F401,F403
from marketlake.quality.distribution import *  # noqa: F401,F403
from marketlake.quality.engines import *  # noqa: F401,F403
from marketlake.quality.multi import *  # noqa: F401,F403
from marketlake.quality.project import *  # noqa: F401,F403
from marketlake.quality.strings import *  # noqa: F401,F403
from marketlake.quality.table import *  # noqa: F401,F403
