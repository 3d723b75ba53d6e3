"""bench.py prints exactly one JSON line with the fields the driver reads."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_REPEATS="1")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env, capture_output=True, text=True, timeout=900, check=True,
    )
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    report = json.loads(lines[0])
    assert report["unit"] == "sec" and report["sf"] == "0.001"
    assert set(report["headline"]) <= set(report["queries"])
    assert report["value"] == pytest.approx(sum(report["queries"][q] for q in report["headline"]), abs=0.01)
    assert "lifecycle_error" not in report
