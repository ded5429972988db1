"""What a run has finished, so that a restarted run goes on where it stopped.

Every finished step is one small Parquet folder of its own under
``<root>.runs/<run id>``, written after the step's table is in place; steps of
one layer finish side by side and never share a folder. A step that was lost
half way has no entry and runs again (loads are keyed upserts, builds are full
refreshes, so repeating one changes nothing).
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

_ENTRY = "layer string, name string, location string"


class IncompleteLayerError(RuntimeError):
    """A layer was to be built on one that is not finished."""


class Ledger:
    def __init__(self, spark: SparkSession, root: str, run_id: str):
        if not re.fullmatch(r"[\w.-]+", run_id):
            raise ValueError(f"a run id is letters, digits, '_', '.' and '-', not {run_id!r}")
        self.spark, self.path = spark, f"{root.rstrip('/')}.runs/{run_id}"

    def finished(self, layer: str) -> dict[str, str]:
        """Names and locations of the layer's finished steps."""
        try:
            rows = self.spark.read.schema(_ENTRY).option("recursiveFileLookup", True).parquet(self.path)
            return {r["name"]: r["location"] for r in rows.filter(f"layer = '{layer}'").collect()}
        except AnalysisException:  # nothing finished yet
            return {}

    def finish(self, layer: str, name: str, location: str | None) -> None:
        entry = self.spark.createDataFrame([(layer, name, location)], _ENTRY)
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{layer}-{name}")

    def jobs(self, layer: str, jobs: dict) -> tuple[dict[str, str], dict]:
        """The finished steps, and the others as jobs that enter themselves."""
        done = {n: at for n, at in self.finished(layer).items() if n in jobs}

        def entered(name, job):
            def run():
                location = job()
                self.finish(layer, name, location)
                return location

            return run

        return done, {n: entered(n, j) for n, j in jobs.items() if n not in done}

    def require(self, layer: str, names) -> None:
        missing = sorted(set(names) - set(self.finished(layer)))
        if missing:
            raise IncompleteLayerError(f"layer {layer!r} of this run lacks {missing}")
