import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlake.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="marketlake-test-ckpt-")
    s = build_session("local[2]", app="marketlake-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "spark.default.parallelism": "2"})
    yield s
    s.stop()
