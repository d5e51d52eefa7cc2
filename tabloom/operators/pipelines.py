"""Feature pipelines that are saved and loaded.

``ColumnSelector`` lets a pipeline begin with a choice of columns; like every
stage it is written with the pipeline and read back by its class name.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame


class ColumnSelector(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the columns ``inputCols``, in that order; a missing one raises when the plan is built."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    @keyword_only
    def setParams(self, *, inputCols: Sequence[str] | None = None) -> ColumnSelector:
        return self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        missing = [c for c in self.getInputCols() if c not in dataset.columns]
        if missing:
            raise ValueError(f"no such columns: {missing}")
        return dataset.select(*["`" + c.replace("`", "``") + "`" for c in self.getInputCols()])


def scaled_features(keep: Sequence[str], numeric: Sequence[str], out: str = "features") -> Pipeline:
    """Column choice, missing numbers by their mean, assembly and standardisation (sample deviation)."""
    from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
    filled = [f"{c}__filled" for c in numeric]
    return Pipeline(stages=[ColumnSelector(inputCols=[*keep, *numeric]), Imputer(strategy="mean", inputCols=list(numeric), outputCols=filled),
                            VectorAssembler(inputCols=filled, outputCol="__raw"), StandardScaler(withMean=True, withStd=True, inputCol="__raw", outputCol=out)])


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    """Write a fitted pipeline under ``path`` (a shared folder) and read it back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
