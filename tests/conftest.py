import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

import fieldwatch  # noqa: E402,F401  (ships the package to Python workers)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fieldwatch.session import build_session, checkpoint_dir

    s = build_session("local[4]", app="fieldwatch-tests", shuffle_partitions=8)
    checkpoint_dir(s)  # uses the session's setting; a private folder only if unset (local)
    yield s
    s.stop()
