"""Feature preparation with Spark ML: assemble, scale, project."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feature_pipeline(
    columns: Sequence[str], k: int | None = 5, output: str = "features", with_mean: bool = False
) -> Pipeline:
    """Assemble ``columns`` (a null raises), scale to unit sample deviation
    without centring, then project on ``k`` principal components
    (``k=None`` stops after scaling)."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol="_assembled", handleInvalid="error")
    scaled_col = output if k is None else "_scaled"
    scaler = StandardScaler(inputCol="_assembled", outputCol=scaled_col, withMean=with_mean, withStd=True)
    stages = [assembler, scaler]
    if k is not None:
        stages.append(PCA(k=k, inputCol="_scaled", outputCol=output))
    return Pipeline(stages=stages)


def fit_transform(pipeline: Pipeline, train: DataFrame, *others: DataFrame,
                  keep: Sequence[str] | None = None) -> tuple[PipelineModel, list[DataFrame]]:
    """Fit on ``train`` only and apply the same fitted model to every frame."""
    model = pipeline.fit(train)
    out = []
    for df in (train, *others):
        transformed = model.transform(df)
        out.append(transformed.select(*keep) if keep else transformed)
    return model, out


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Spread a vector column into named double columns."""
    arr = vector_to_array(F.col(vector))
    return df.select(*[c for c in df.columns if c != vector], *[arr[i].alias(n) for i, n in enumerate(names)])
