import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tagwave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def _remove_staged_tables(spark):
    """Tables a test stages in the shared folder are removed after it."""
    from tagwave.operators.stage import staging_scope
    with staging_scope(spark):
        yield
