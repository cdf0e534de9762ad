"""Train the model grid on the Gold table and keep the best model."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ..operators.learning import GridResult, run_grid


def train_and_store(features: DataFrame, out_dir: str, **grid) -> GridResult:
    """Run the grid and write the best model, its metrics and the results table."""
    spark = features.sparkSession
    outcome = run_grid(features, **grid)
    root = out_dir.rstrip("/")
    if outcome.best_model is not None:
        outcome.best_model.write().overwrite().save(f"{root}/best_model")
    outcome.results.coalesce(1).write.mode("overwrite").option("header", True).csv(
        f"{root}/results"
    )
    line = json.dumps(outcome.best or {}, sort_keys=True)
    metrics = spark.createDataFrame([(line,)], "value string").coalesce(1)
    metrics.write.mode("overwrite").text(f"{root}/metrics")
    return outcome


def load_model(out_dir: str) -> PipelineModel:
    return PipelineModel.load(f"{out_dir.rstrip('/')}/best_model")
