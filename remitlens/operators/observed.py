"""Row conditions counted while a frame is written: checks without a scan.

A ``Watch`` puts metrics on a frame (``DataFrame.observe``); whatever writes the
frame, or a join that it goes into, counts them on the way. A stage that runs
again after an executor is lost may count its rows twice, and a plan that proves
a side empty may not read it. So only a zero over at least one row is taken as
the result; any other count is open and must be counted again.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Seconds to wait for metrics after the write has ended (they come by a listener).
PATIENCE = 10.0


class Watch:
    """Counts the rows of one frame on which each of some conditions holds.

    ``failing`` maps a name to a boolean Column; NULL counts as not holding.
    """

    def __init__(self, failing: Mapping[str, Column]):
        self.failing = dict(failing)
        self._observation: Observation | None = None

    def on(self, df: DataFrame) -> DataFrame:
        self._observation = Observation()
        counts = [F.sum(F.when(c, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(f"f{i}") for i, c in enumerate(self.failing.values())]
        return df.observe(self._observation, F.count(F.lit(1)).alias("rows"), *counts)

    def _metrics(self) -> dict | None:
        if self._observation is None:
            return None
        future = self._observation._jo.future()
        end = time.monotonic() + PATIENCE
        while not future.isCompleted():
            if time.monotonic() > end:
                return None
            time.sleep(0.01)
        return self._observation.get

    def passed(self) -> set[str]:
        """The conditions that no row met, of at least one row seen; to be asked
        after the write. All others are open."""
        metrics = self._metrics()
        if not metrics or not metrics.get("rows"):
            return set()
        return {name for i, name in enumerate(self.failing) if metrics.get(f"f{i}") == 0}
