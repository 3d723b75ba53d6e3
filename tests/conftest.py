from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from remitlens.session import build_session, ensure_checkpoint_dir

    import tempfile

    warehouse = tempfile.mkdtemp(prefix="remitlens-warehouse-")
    s = build_session(
        master="local[*]",
        shuffle_partitions=8,
        app_name="remitlens-tests",
        extra_conf={"spark.sql.warehouse.dir": warehouse},
    )
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
