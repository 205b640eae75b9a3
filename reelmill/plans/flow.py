"""The stages in their order, run from any of them, each written as a table that the later ones read."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from enum import IntEnum

from pyspark.sql import DataFrame, SparkSession


class Stage(IntEnum):
    INGEST = 0
    EMBED = 1
    DEDUP = 2
    SCORE = 3
    MOTION = 4
    CAPTION = 5
    CAPTION_QUALITY = 6
    ENCODE_LATENTS = 7
    SHARD = 8
    MANIFEST = 9


#: Stages that a run without the later signals leaves out, and how often a stage is tried.
SECOND_VERSION = {Stage.MOTION, Stage.CAPTION_QUALITY, Stage.ENCODE_LATENTS}
TRIES = {Stage.INGEST: 3, Stage.MANIFEST: 1}
METRICS = "stage string, status string, tries int, seconds double"


@dataclass
class Flow:
    """``steps``: for a stage, a function of the tables of the stages before, by name; a stage without one is left out.

    Each table is written under ``folder``; a run from a later stage reads what an earlier run has left there. A stage
    that fails ends the run; its row of the metrics says so.
    """

    spark: SparkSession
    folder: str
    steps: dict[Stage, Callable[[dict[str, DataFrame]], DataFrame]]
    metrics: list[tuple[str, str, int, float]] = field(default_factory=list)

    def _path(self, stage: Stage) -> str:
        return f"{self.folder.rstrip('/')}/{stage.name.lower()}"

    def run(self, from_stage: Stage = Stage.INGEST, no_v2: bool = False, wait: float = 0.0) -> dict[str, DataFrame]:
        """The tables by stage name. Stages before ``from_stage`` are read, not run; ``no_v2`` leaves three out."""
        tables: dict[str, DataFrame] = {}
        for stage in Stage:
            step = self.steps.get(stage)
            if step is None or no_v2 and stage in SECOND_VERSION:
                continue
            if stage >= from_stage:
                self._tried(stage, step, tables, wait)
            tables[stage.name.lower()] = self.spark.read.parquet(self._path(stage))
        return tables

    def _tried(self, stage: Stage, step: Callable, tables: dict[str, DataFrame], wait: float) -> None:
        began, name = time.perf_counter(), stage.name.lower()
        most = TRIES.get(stage, 2)
        for k in range(1, most + 1):
            try:
                step(dict(tables)).write.mode("overwrite").parquet(self._path(stage))
            except Exception:
                if k == most:
                    self.metrics.append((name, "failed", k, round(time.perf_counter() - began, 3)))
                    raise
                time.sleep(wait)
            else:
                self.metrics.append((name, "ok", k, round(time.perf_counter() - began, 3)))
                return

    def metric_rows(self) -> DataFrame:
        """(stage, status, tries, seconds) of the stages that ran."""
        return self.spark.createDataFrame(self.metrics, METRICS)
