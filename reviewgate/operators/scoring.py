"""Batch scoring with any user-supplied scorer.

A scorer factory is called once per task (so a model is loaded once per
worker process and reused across Arrow batches); it maps a 2-D float array
of inputs to a 2-D array of logits. ``spark.sql.execution.arrow.maxRecordsPerBatch``
is the batch size. A nearest-centroid scorer ships with the library because no
deep-learning runtime is assumed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

ScorerFactory = Callable[[], Callable[[np.ndarray], np.ndarray]]


def score_batch(df: DataFrame, factory: ScorerFactory, input_col: str,
                output_col: str = "logits") -> DataFrame:
    """Adds ``output_col`` ARRAY<DOUBLE> of logits via mapInPandas.

    A null vector, one that holds a null or NaN, and one whose length is not the factory's
    ``n_inputs`` (if it has one) get null logits, which routing sends to review; without
    ``n_inputs`` the vectors of each length go to the scorer together."""
    schema = StructType(list(df.schema.fields) +
                        [StructField(output_col, ArrayType(DoubleType()))])

    def run(batches):
        scorer, wanted = factory(), getattr(factory, "n_inputs", None)
        for b in batches:
            logits = [None] * len(b)
            rows = defaultdict(list)
            for i, v in enumerate(b[input_col]):
                if v is not None and wanted in (None, len(v)) and not np.isnan(np.asarray(v, np.float64)).any():
                    rows[len(v)].append(i)
            for at in rows.values():
                x = np.stack([np.asarray(b[input_col].iloc[i], dtype=np.float64) for i in at])
                for i, z in zip(at, np.asarray(scorer(x), dtype=np.float64)):
                    logits[i] = z
            b[output_col] = pd.Series(logits, index=b.index, dtype=object)
            yield b

    return df.mapInPandas(run, schema)


def class_centroids(df: DataFrame, vector_col: str, label_col: str) -> DataFrame:
    """Element-wise mean vector per class in double (label, pos, mean):
    a partial aggregate with K x D output."""
    return df.select(F.col(label_col).alias("label"),
                     F.posexplode(F.col(vector_col)).alias("pos", "x")) \
        .groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def centroid_scorer(centroids: DataFrame, classes, scale: float = 20.0) -> ScorerFactory:
    """Factory of a scorer: logits = scale x (input . centroid_k). The centroid
    table is K x D (classes x dimensions), collected once on the driver."""
    rows = centroids.collect()
    dim = max(r["pos"] for r in rows) + 1 if rows else 0
    index = {c: i for i, c in enumerate(classes)}
    mat = np.zeros((len(classes), dim))
    for r in rows:
        if r["label"] in index:
            mat[index[r["label"]], r["pos"]] = r["mean"]

    def factory():
        m = mat.T * scale
        return lambda x: x @ m
    factory.n_inputs = dim
    return factory
