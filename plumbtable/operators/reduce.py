"""Principal components for exploration."""

from __future__ import annotations

from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def principal_components(
    df: DataFrame, columns: list[str], k: int = 2, keep: list[str] = ()
) -> tuple[DataFrame, list[float]]:
    """Mean-centred scores ``pc1..pck`` beside the ``keep`` columns, and explained-variance ratios.

    The covariance is accumulated per partition; only the k-column loading matrix reaches the
    driver. Component signs are arbitrary.
    """
    assembled = VectorAssembler(inputCols=columns, outputCol="__raw").transform(df)
    centre = StandardScaler(withMean=True, withStd=False, inputCol="__raw", outputCol="__centred")
    centred = centre.fit(assembled).transform(assembled)
    model = PCA(k=k, inputCol="__centred", outputCol="__pca").fit(centred)
    scores = vector_to_array("__pca")
    projected = model.transform(centred).select(
        *keep, *[F.get(scores, i).alias(f"pc{i + 1}") for i in range(k)]
    )
    return projected, [float(v) for v in model.explainedVariance]
