"""A trained network's weights as files, and its predictions batch by batch in the tasks.

For tables of vectors held as arrays, and for weights that come from elsewhere: a worker
loads the layers once, and each batch of rows is one matrix that passes through them.
"""

from __future__ import annotations

import numpy as np
import pyarrow.dataset as arrow_data
from pyarrow import fs as arrow_fs
from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_ROWS = 1024
Layers = list[tuple[np.ndarray, np.ndarray]]


def layers_of(model: MultilayerPerceptronClassificationModel) -> Layers:
    """Weights (inputs down, outputs across) and biases of each layer of a fitted model."""
    sizes, flat, layers, at = model.getLayers(), model.weights.toArray(), [], 0
    for inputs, outputs in zip(sizes, sizes[1:]):
        layers.append((flat[at:at + inputs * outputs].reshape(inputs, outputs), flat[at + inputs * outputs:at + (inputs + 1) * outputs]))
        at += (inputs + 1) * outputs
    return layers


def save_layers(spark, layers: Layers, path: str) -> None:
    """One row for each layer, at ``path``, which every executor must reach."""
    rows = [(i, w.shape[0], w.ravel().tolist(), b.tolist()) for i, (w, b) in enumerate(layers)]
    spark.createDataFrame(rows, "layer int, inputs int, weights array<double>, biases array<double>").coalesce(1).write.parquet(path)


def read_layers(path: str) -> Layers:
    """What ``save_layers`` wrote, read in a worker."""
    files, folder = arrow_fs.FileSystem.from_uri(path)
    rows = arrow_data.dataset(folder, filesystem=files, format="parquet").to_table().sort_by("layer").to_pylist()
    return [(np.array(r["weights"]).reshape(r["inputs"], -1), np.array(r["biases"])) for r in rows]


def forward(layers: Layers, rows: np.ndarray) -> np.ndarray:
    """Class probabilities: logistic units within, a softmax at the end."""
    for weights, biases in layers[:-1]:
        rows = 1 / (1 + np.exp(-(rows @ weights + biases)))
    scores = rows @ layers[-1][0] + layers[-1][1]
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def probabilities(path: str, inputs: int, features: str) -> Column:
    """The probability of each class from an array column of ``inputs`` numbers, none of them null."""
    def load():
        layers = read_layers(path)
        return lambda rows: forward(layers, rows)

    run = predict_batch_udf(load, return_type=T.ArrayType(T.DoubleType()), batch_size=BATCH_ROWS, input_tensor_shapes=[[inputs]])
    return run(F.col(features))


def predict(df: DataFrame, path: str, inputs: int, features: str) -> DataFrame:
    """``df`` with ``probability``, ``pred_class`` (the first of the likeliest) and ``pred_prob``.

    All three are null for an array that is null, has a null in it or not ``inputs`` numbers.
    """
    fits = (F.size(features) == inputs) & F.forall(features, lambda x: x.isNotNull())
    # such rows pass through the network as zeros
    plain = F.when(fits, F.col(features).cast("array<double>")).otherwise(F.array_repeat(F.lit(0.0), inputs))
    told = df.withColumn("__fits", F.coalesce(fits, F.lit(False))).withColumn("__plain", plain)
    told = told.withColumn("probability", probabilities(path, inputs, "__plain"))
    told = told.withColumn("probability", F.when(F.col("__fits"), F.col("probability"))).drop("__fits", "__plain")
    best = F.array_max("probability")
    return told.withColumns({"pred_class": (F.array_position("probability", best) - 1).cast("int"), "pred_prob": best})
