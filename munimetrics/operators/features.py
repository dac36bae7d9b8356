"""Feature preparation: population z-scores, variance and correlation filters, 2-D projection.

Fits read one row, or one columns-by-columns matrix, to the driver; the data itself stays distributed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VECTOR = "_features"


def assembled(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and one vector column; nulls and NaN are errors, as in any fit."""
    inputs = [f"_f{i}" for i in range(len(features))]
    columns = [F.col(f"`{c}`").cast("double").alias(alias) for c, alias in zip(features, inputs)]
    renamed = df.select(*[F.col(f"`{c}`") for c in keep], *columns)
    return VectorAssembler(inputCols=inputs, outputCol=_VECTOR).transform(renamed).drop(*inputs)


def moments(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population variance of each feature, all in one pass."""
    aggregates = []
    for i, c in enumerate(features):
        value = F.col(f"`{c}`").cast("double")
        aggregates += [F.avg(value).alias(f"m{i}"), F.var_pop(value).alias(f"v{i}")]
    row = df.agg(*aggregates).first()
    return {c: (row[f"m{i}"], row[f"v{i}"]) for i, c in enumerate(features)}


def standardize(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Z-scores with the population standard deviation; a constant column becomes zero."""
    scores = {}
    for c, (mean, variance) in moments(df, features).items():
        centred = F.col(f"`{c}`").cast("double") - F.lit(mean)
        scores[c] = centred / F.lit(variance**0.5) if variance else centred * F.lit(0.0)
    return df.withColumns(scores)


def variance_filter(df: DataFrame, features: Sequence[str], threshold: float = 0.05) -> list[str]:
    """Features whose population variance exceeds the threshold."""
    return [c for c, (_, variance) in moments(df, features).items() if variance is not None and variance > threshold]


def _correlations(df: DataFrame, features: Sequence[str]) -> np.ndarray:
    matrix = Correlation.corr(assembled(df, features), _VECTOR, "pearson").first()[0]
    return matrix.toArray()


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of features; null where a feature is constant."""
    matrix = _correlations(df, features)
    rows = [
        (a, b, None if np.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(features)
        for j, b in enumerate(features)
    ]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, correlation double")


def correlation_filter(
    df: DataFrame, features: Sequence[str], threshold: float = 0.90
) -> tuple[list[str], list[str]]:
    """Kept and dropped features: a feature goes if it correlates with any earlier one, kept or not."""
    strength = np.abs(_correlations(df, features))
    dropped = [c for j, c in enumerate(features) if (strength[:j, j] > threshold).any()]
    return [c for c in features if c not in dropped], dropped


def project(
    df: DataFrame, features: Sequence[str], names: Sequence[str] = ("umap_x", "umap_y")
) -> DataFrame:
    """Principal components of standardised features as new columns.

    A linear stand-in for a manifold layout, so coordinates are not comparable with one. The sign of a
    component is fixed by making its largest loading positive. The projection itself is a plain sum of
    products, which Spark compiles with the rest of the plan.
    """
    model = PCA(k=len(names), inputCol=_VECTOR, outputCol="_pc").fit(assembled(df, features))
    loadings = model.pc.toArray()
    centre = moments(df, features)
    columns = {}
    for k, name in enumerate(names):
        weights = loadings[:, k]
        weights = weights if weights[np.argmax(np.abs(weights))] > 0 else -weights
        terms = [
            (F.col(f"`{c}`").cast("double") - F.lit(centre[c][0])) * F.lit(float(w)) for c, w in zip(features, weights)
        ]
        columns[name] = reduce(lambda a, b: a + b, terms)
    return df.withColumns(columns)
