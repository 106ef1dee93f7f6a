"""Storing and loading fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.tuning import CrossValidatorModel


def save_model(model: PipelineModel | CrossValidatorModel, path: str) -> None:
    """Write a fitted pipeline, replacing what is there; of a search, the refitted winner."""
    if isinstance(model, CrossValidatorModel):
        model = model.bestModel
    if not isinstance(model, PipelineModel):
        model = PipelineModel([model])
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
