"""Runs of models and jobs, with their parameters and metrics, as appended tables."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import VersionedTable

RUNS = "tracked_run string, name string, started_at timestamp, status string, model_path string"
PARAMS = "tracked_run string, key string, value string"
METRICS = "tracked_run string, key string, step bigint, value double"


class Tracker:
    """Three tables under ``path``: runs, params, metrics.  A run that failed is logged as failed."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.tables = {n: VersionedTable(spark, f"{path.rstrip('/')}/{n}") for n in ("runs", "params", "metrics")}

    def log(self, name: str, now: datetime, params: dict | None = None, metrics: dict | None = None, steps: list[tuple[str, int, float]] | None = None, status: str = "finished", model_path: str | None = None) -> str:
        """One run; returns its id.  ``steps`` are (key, step, value); metrics without a number are left out."""
        run = uuid.uuid4().hex
        make = self.spark.createDataFrame
        self.tables["runs"].append(make([(run, name, now, status, model_path)], RUNS))
        if params:
            self.tables["params"].append(make([(run, k, None if v is None else str(v)) for k, v in params.items()], PARAMS))
        values = [(run, k, 0, float(v)) for k, v in (metrics or {}).items() if isinstance(v, (int, float)) and v == v] + [(run, k, s, float(v)) for k, s, v in steps or []]
        if values:
            self.tables["metrics"].append(make(values, METRICS))
        return run

    def read(self, table: str) -> DataFrame:
        return self.tables[table].read()
