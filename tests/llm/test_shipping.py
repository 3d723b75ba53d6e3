"""Task code reaches workers that have no copy of the package."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])  # the driver's path only
from remitlens.session import build_session, ensure_checkpoint_dir
from remitlens.llm.queries import queries
spark = build_session("local[4]", 4)
ensure_checkpoint_dir(spark)

def names(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("remitlens") is not None])], names=["found"])

assert not spark.range(1, numPartitions=1).mapInArrow(names, "found boolean").first()[0]
for name in sys.argv[3:]:
    print(name, queries()[name](spark, sys.argv[2]).count())
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    (tmp_path / "script.py").write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ops = ["op3_language_id", "op4_decontaminate", "op5_html_extract", "op6_quality", "op11_ranked_search", "op13_hard_negatives"]
    run = subprocess.run(
        [sys.executable, "script.py", ROOT, "/root/testdata/sf0.001", *ops], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert run.returncode == 0, run.stderr[-3000:]
    counts = dict(line.split() for line in run.stdout.splitlines() if line.startswith("op"))
    assert list(counts) == ops and counts["op3_language_id"] == "200" and counts["op5_html_extract"] == "50"
