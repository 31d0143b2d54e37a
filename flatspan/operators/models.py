"""Fitted models as Spark ML transformers: they add ``prediction``, and ``probability`` where there are classes.

A model is a set of arrays.  They are broadcast when a frame is scored, as any fitted model's are, and written as rows of at
most ``PART_BYTES`` beside the parameters, so that a model can be saved, put into a pipeline and loaded in another session.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatspan.operators.linear import chances

PART_BYTES = 1 << 22
#: Rows whose places in all trees are held at once.
ROWS = 1024


class FittedModel(Model, MLWritable, MLReadable):
    """``kind`` (linear, logistic, forest, boosting) and its arrays; ``n_classes`` is 0 for numbers."""

    def __init__(self, kind: str = "", n_classes: int = 0, arrays: dict[str, np.ndarray] | None = None) -> None:
        super().__init__()
        self.kind, self.n_classes, self.arrays = kind, n_classes, arrays or {}
        self._shared = None

    @property
    def coefficients(self) -> np.ndarray:
        return self.arrays["beta"][-1, 1:]

    @property
    def intercept(self) -> float:
        return float(self.arrays["beta"][-1, 0])

    def values(self, x: np.ndarray) -> np.ndarray:
        """Rows x classes of chances, or rows x 1 of numbers."""
        return values(self.kind, self.n_classes, self.arrays, x)

    def shared(self, spark):
        """The arrays, broadcast once for each session: a model has to fit a task, as any that is applied row by row."""
        if self._shared is None or self._shared[0] is not spark:
            self._shared = (spark, spark.sparkContext.broadcast(self.arrays))
        return self._shared[1]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kind, n_classes, known = self.kind, self.n_classes, self.shared(dataset.sparkSession)

        @F.pandas_udf("array<double>")
        def scored(rows: pd.Series) -> pd.Series:
            x = np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, 1))
            return pd.Series(list(values(kind, n_classes, known.value, x)))

        out = dataset.withColumn("probability", scored(vector_to_array("features")))
        if not n_classes:
            return out.withColumn("prediction", F.get("probability", F.lit(0))).drop("probability")
        best = F.array_position("probability", F.array_max("probability")) - 1
        return out.withColumn("prediction", best.cast("double")).withColumn("probability", array_to_vector("probability"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


def values(kind: str, n_classes: int, arrays: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    if not len(x):
        return np.zeros((0, max(n_classes, 1)))
    if kind == "linear":
        return (arrays["beta"][:, 0] + x @ arrays["beta"][:, 1:].T).reshape(-1, 1)
    if kind == "logistic":
        return chances(x, arrays["beta"])
    parts = [(forest_values if kind == "forest" else boosted_values)(n_classes, arrays, x[at : at + ROWS]) for at in range(0, len(x), ROWS)]
    return np.concatenate(parts)


def forest_values(n_classes: int, arrays: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The mean of the trees; leaves lead to themselves."""
    feature, threshold, left, right, value, roots = (arrays[n] for n in ("feature", "threshold", "left", "right", "value", "roots"))
    node = np.repeat(roots[:, None], len(x), axis=1)
    rows = np.arange(len(x))
    while True:
        f = feature[node]
        going = f >= 0
        if not going.any():
            return value[node].mean(axis=0)
        right_side = x[rows, np.maximum(f, 0)] > threshold[node]
        node = np.where(going, np.where(right_side, right[node], left[node]), node)


def boosted_values(n_classes: int, arrays: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Raw scores of complete trees, [round, output, place], as numbers or chances."""
    feature, threshold, value, base = (arrays[n] for n in ("feature", "threshold", "value", "base"))
    rounds, outputs, inner = feature.shape
    f, t = feature.reshape(-1, inner), threshold.reshape(-1, inner)
    node, rows, tree = np.zeros((len(f), len(x)), np.int64), np.arange(len(x)), np.arange(len(f))[:, None]
    for _ in range((inner + 1).bit_length() - 1):
        node = 2 * node + 1 + (x[rows, f[tree, node]] > t[tree, node])
    raw = base + value.reshape(len(f), -1)[tree, node - inner].reshape(rounds, outputs, -1).sum(axis=0).T
    if not n_classes:
        return raw
    raw = np.column_stack([np.zeros(len(x)), raw]) if n_classes == 2 else raw
    e = np.exp(raw - raw.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class _Writer(MLWriter):
    def __init__(self, instance: FittedModel) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m, spark = self.instance, self.sparkSession
        about = {"kind": m.kind, "n_classes": m.n_classes, "arrays": {n: [a.dtype.str, list(a.shape)] for n, a in m.arrays.items()}}
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"about": json.dumps(about)})
        rows = []
        for name, a in m.arrays.items():
            data = np.ascontiguousarray(a).tobytes()
            rows += [(name, at, data[at : at + PART_BYTES]) for at in range(0, max(len(data), 1), PART_BYTES)]
        spark.createDataFrame([(n, at, bytearray(d)) for n, at, d in rows], "name string, at long, data binary").write.mode("overwrite").parquet(f"{path}/arrays")


class _Reader(MLReader):
    def load(self, path: str) -> FittedModel:
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        about = json.loads(meta["about"])
        data: dict[str, list] = {}
        for r in sorted(spark.read.parquet(f"{path}/arrays").collect(), key=lambda r: r["at"]):  # a model
            data.setdefault(r["name"], []).append(bytes(r["data"]))
        arrays = {n: np.frombuffer(b"".join(data[n]), t).reshape(shape) for n, (t, shape) in about["arrays"].items()}
        return FittedModel(about["kind"], about["n_classes"], arrays)
