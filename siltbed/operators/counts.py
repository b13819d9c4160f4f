"""Rows counted while they are written, without another scan."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, functions as F


class RowCounts:
    """Counts of watched frames by table and step, known once their rows were written.

    A frame that is watched must be written: asking for counts waits for it. A stage that Spark
    repeats after losing an executor may be counted again, so counts are for reports.
    """

    def __init__(self) -> None:
        self._observed: list[tuple[str, str, Observation]] = []
        self._lock = threading.Lock()

    def watch(self, df: DataFrame, table: str, step: str) -> DataFrame:
        observation = Observation()
        with self._lock:
            self._observed.append((table, step, observation))
        return df.observe(observation, F.count(F.lit(1)).alias("rows"))

    def totals(self) -> dict[str, dict[str, int]]:
        """Rows by table and step, summed over a table's batches."""
        out: dict[str, dict[str, int]] = {}
        for table, step, observation in self._observed:
            steps = out.setdefault(table, {})
            steps[step] = steps.get(step, 0) + observation.get["rows"]
        return out
