"""Mean silhouette by Euclidean distance, between bounds, without comparing all pairs.

The rows of a label are added up to boxes (count, sum, squares). The mean distance from a point to the rows of a box is at
least its distance to their mean and at most the root of that distance's square plus the rows' variance, so each row's
silhouette lies between two values. With one box per distinct row both are the exact one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from munimetrics.operators.features import _VECTOR, assembled
from munimetrics.session import cut_lineage, share_package

#: Boxes that every row is compared with, at most.
BOXES = 4000
_BLOCK = 1024


def feature_rows(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``(label, row)`` of columns; nulls and NaN are errors."""
    return assembled(df, features, [label]).select(F.col(label).alias("label"), vector_to_array(_VECTOR).alias("row"))


def _box_key(rows: DataFrame, boxes: int, labels: int, seed: int) -> Column:
    """The side of random planes through the rows' middle on which a row lies, as many as ``boxes`` allow."""
    planes = int(np.floor(np.log2(max(1, boxes // labels))))
    if not planes:
        return F.lit(0).cast("long")
    normals = np.random.default_rng(seed).normal(0, 1, (planes, len(rows.first()["row"])))
    sides = [F.aggregate(F.zip_with("row", F.array(*map(F.lit, map(float, n))), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b) for n in normals]
    middles = rows.agg(*[F.percentile_approx(s, 0.5, 1000) for s in sides]).first()
    key = F.lit(0).cast("long")
    for n, (side, middle) in enumerate(zip(sides, middles)):
        key = key + F.when(side > middle, 1 << n).otherwise(0)
    return key


def euclidean_silhouette(rows: DataFrame, boxes: int = BOXES, seed: int = 42) -> dict[str, float] | None:
    """``low``, ``high`` and ``mean`` (their middle) of the mean silhouette over ``rows`` (``label, row array<double>``).

    The exact value lies between ``low`` and ``high``, which meet where there are no more than ``boxes`` different rows. A
    label of one row has silhouette 0. Rows with a null label are left out; None with fewer than two labels. There
    must be fewer labels than ``boxes``, which all reach the driver.
    """
    share_package(rows.sparkSession)
    rows = cut_lineage(rows.where("label is not null").select("label", F.transform("row", lambda x: x.cast("double") + F.lit(0.0)).alias("row")))
    labels = rows.select("label").distinct().limit(boxes + 1).count()
    if labels < 2:
        return None
    if labels > boxes:
        raise ValueError(f"more than {boxes} labels")
    whole = rows.select("label", "row").distinct().limit(boxes + 1).count() <= boxes
    width = len(rows.first()["row"])
    key = F.col("row") if whole else _box_key(rows, boxes, labels, seed)
    squares = F.sum(F.aggregate("row", F.lit(0.0), lambda a, x: a + x * x)).alias("q")
    sums = [F.sum(F.col("row")[i]).alias(f"s{i}") for i in range(width)]
    added = rows.groupBy("label", key.alias("box")).agg(F.count(F.lit(1)).alias("n"), squares, *sums).orderBy("label", "box").toPandas()
    counts = added["n"].to_numpy(float)
    centres = added[[f"s{i}" for i in range(width)]].to_numpy(float) / counts[:, None]
    spread = np.zeros(len(counts)) if whole else np.maximum(added["q"].to_numpy(float) / counts - (centres**2).sum(1), 0)
    names, owner = np.unique(added["label"].to_numpy(), return_inverse=True)
    size = np.bincount(owner, counts)
    starts = np.searchsorted(owner, np.arange(len(names)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3)
        for batch in batches:
            for start in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(start, _BLOCK)
                own = np.searchsorted(names, part.column(0).to_numpy(zero_copy_only=False))
                points = part.column(1).flatten().to_numpy().reshape(-1, width)
                square = np.maximum((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None], 0)
                # What rounding leaves of the distance of a point to itself.
                square[square <= 1e-12 * np.maximum((points**2).sum(1), 1e-300)[:, None]] = 0
                near = np.add.reduceat(np.sqrt(square) * counts, starts, axis=1)
                far = np.add.reduceat(np.sqrt(square + spread) * counts, starts, axis=1)
                at = np.arange(len(own))
                others = np.maximum(size[own] - 1, 1)
                inner = near[at, own] / others, far[at, own] / others
                near, far = near / size, far / size
                near[at, own] = far[at, own] = np.inf
                outer = near.min(1), far.min(1)
                alone = size[own] == 1
                values = []
                for a, b in ((inner[1], outer[0]), (inner[0], outer[1])):
                    widest = np.maximum(a, b)
                    share = np.divide(b - a, widest, out=np.zeros(len(a)), where=widest > 0)
                    values.append(np.where(alone, 0, share).sum())
                total += [len(own), *values]
        if total[0]:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], ["n", "low", "high"])

    found = rows.select("label", "row").mapInArrow(run, "n double, low double, high double").agg(F.sum("n"), F.sum("low"), F.sum("high")).first()
    low, high = found[1] / found[0], found[2] / found[0]
    return {"low": low, "high": high, "mean": (low + high) / 2}
