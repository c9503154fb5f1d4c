"""Fitting a linear window-to-horizon forecaster on all stations' windows.

The model is ridge regression from a scaled window to the scaled levels of the
next hours. Windows are never stored: they are cut inside the tasks and summed
into the matrix of inner products of ``[1, window, label]``, whose size depends
on the window alone. One pass over the data serves all hours ahead and all ridge
strengths, and both losses follow from the same matrices.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline.functions import as_moment, bind, epoch
from gaugeline.operators import blocks as B
from gaugeline.operators import windows
from gaugeline.session import cut_lineage
from gaugeline.sources import dims

#: Called per ridge strength with its number, training loss and validation loss.
Callback = Callable[[int, float, "float | None"], None]


def time_split(df: DataFrame, keys: Sequence[str], time_col: str, fraction: float = 0.8,
               cutoff=None, block: str = B.DEFAULT_BLOCK) -> DataFrame:
    """Adds ``is_train``: rows up to the cut-off.

    The cut-off is a given moment, or lies at ``fraction`` of each series' time
    range, in whole seconds.
    """
    if cutoff is not None:
        return df.withColumn("is_train", F.col(time_col) <= as_moment(cutoff))
    timed = B.with_block(df, keys, time_col, block).withColumn("_t", epoch(F.col(time_col)))
    ends = B.attach_stats(timed, ["_t"], ["min", "max"])
    edge = F.col("_min__t") + F.floor((F.col("_max__t") - F.col("_min__t")) * F.lit(fraction))
    return B.restore(ends.withColumn("is_train", F.col("_t") <= edge), [*df.columns, "is_train"], keys)


@dataclass
class LevelModel:
    """Coefficients per hour ahead, with the loss history of the fit."""

    version: str
    strength: float
    intercepts: np.ndarray
    weights: np.ndarray
    losses: list[tuple[int, float, float, float | None]] = field(default_factory=list)
    parameters: dict = field(default_factory=dict)

    def coefficients(self, spark: SparkSession) -> DataFrame:
        rows = [(h + 1, float(self.intercepts[h]), self.weights[h].tolist())
                for h in range(len(self.intercepts))]
        return dims.local_table(spark, rows, hour_ahead=pa.int32(), intercept=pa.float64(),
                                weights=pa.list_(pa.float64()))

    def loss_history(self, spark: SparkSession) -> DataFrame:
        """Training and validation loss per step of the fit."""
        rows = [(self.version, *entry) for entry in self.losses]
        return dims.local_table(spark, rows, model_version=pa.string(), step=pa.int32(),
                                strength=pa.float64(), train_loss=pa.float64(),
                                validation_loss=pa.float64())

    def predict(self, df: DataFrame, vector: Column, name: str = "predicted") -> DataFrame:
        """Adds the array of scaled levels of a scaled, flattened window; no Python in the plan."""
        packed = self.coefficients(df.sparkSession).agg(F.sort_array(F.collect_list(
            F.struct("hour_ahead", "intercept", "weights")))).scalar()

        def level(c, x):
            products = F.zip_with(c["weights"], x, lambda w, v: w * v)
            return F.aggregate(products, c["intercept"], lambda total, p: total + p)

        levels = bind(vector, lambda x: F.transform("_model", lambda c: level(c, x)))
        return df.withColumn("_model", packed).withColumn(name, levels).drop("_model")

    def save(self, spark: SparkSession, path: str) -> None:
        settings = json.dumps({"version": self.version, "strength": self.strength, **self.parameters})
        (self.coefficients(spark).withColumn("settings", F.lit(settings))
         .write.mode("overwrite").parquet(f"{path}/coefficients"))
        self.loss_history(spark).write.mode("overwrite").parquet(f"{path}/losses")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LevelModel":
        """The saved model; its files hold one row per hour ahead and per step."""
        rows = spark.read.parquet(f"{path}/coefficients").orderBy("hour_ahead").collect()
        losses = spark.read.parquet(f"{path}/losses").orderBy("step").collect()
        settings = json.loads(rows[0]["settings"])
        return LevelModel(
            settings.pop("version"), settings.pop("strength"),
            np.array([r["intercept"] for r in rows]), np.array([r["weights"] for r in rows]),
            [(r["step"], r["strength"], r["train_loss"], r["validation_loss"]) for r in losses],
            settings)


def inner_products(pairs: DataFrame) -> np.ndarray:
    """Sum over windows of the outer product of ``[1, window, label]``; incomplete windows are left out."""
    row = F.concat(F.array(F.lit(1.0)), F.flatten("window"), "label")
    whole = pairs.select(row.alias("r")).filter(~F.exists("r", lambda x: x.isNull()))
    vectors = MLUtils.convertVectorColumnsFromML(whole.select(array_to_vector("r").alias("v")), "v")
    return RowMatrix(vectors).computeGramianMatrix().toArray()


def _loss(products: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Mean squared error per hour ahead, from the inner products."""
    p = beta.shape[0]
    inputs, cross, labels = products[:p, :p], products[:p, p:], np.diag(products[p:, p:])
    squared = labels - 2 * (beta * cross).sum(axis=0) + (beta * (inputs @ beta)).sum(axis=0)
    return np.maximum(squared, 0.0) / products[0, 0]


def explained(found: LevelModel, variance: Column) -> Column:
    """Accuracy of a model between 0 and 1: the share of the labels' ``variance`` that its loss leaves, the held-out loss where there is one."""
    step = next(row for row in found.losses if row[1] == found.strength)
    loss = step[2] if step[3] is None else step[3]
    return F.greatest(F.lit(0.0), 1 - F.lit(float(loss)) / F.when(variance > 0, variance))


def fit(train: DataFrame, validation: DataFrame | None = None, version: str = "linear-1",
        horizon: int = C.HORIZON, strengths: Sequence[float] = (1.0, 0.1, 0.01, 0.001),
        callback: Callback | None = None, parameters: dict | None = None) -> LevelModel:
    """Ridge regression for all hours ahead; the strength with the lowest loss is kept.

    ``train`` and ``validation`` are training pairs with ``horizon`` labels.
    The choice is made on the validation loss if there is one.
    """
    if min(strengths) <= 0:
        raise ValueError("ridge strengths must be positive")
    seen = inner_products(train)
    held = None if validation is None else inner_products(validation)
    p = seen.shape[0] - horizon
    inputs, cross, n = seen[:p, :p], seen[:p, p:], seen[0, 0]
    penalised = np.eye(p)
    penalised[0, 0] = 0.0
    best, losses = None, []
    for step, strength in enumerate(strengths, start=1):
        beta = np.linalg.solve(inputs + strength * n * penalised, cross)
        train_loss = float(_loss(seen, beta).mean())
        held_loss = None if held is None else float(_loss(held, beta).mean())
        losses.append((step, float(strength), train_loss, held_loss))
        if callback:
            callback(step, train_loss, held_loss)
        judged = train_loss if held_loss is None else held_loss
        if best is None or judged < best[0]:
            best = (judged, float(strength), beta)
    _, strength, beta = best
    settings = {"horizon": horizon, "windows": int(n), **(parameters or {})}
    return LevelModel(version, strength, beta[0].copy(), beta[1:].T.copy(), losses, settings)


def fit_series(dense: DataFrame, keys: Sequence[str], time_col: str,
               features: Sequence[str] = tuple(C.FEATURES), target: str = C.TARGET,
               length: int = C.WINDOW_ROWS, horizon: int = C.HORIZON, fraction: float = 0.8,
               position: str | None = None, block: str = B.DEFAULT_BLOCK, **options) -> LevelModel:
    """Split every series by time, scale both parts by themselves, cut windows and fit.

    The split series, one row per bin, is checkpointed: both parts are read from
    it. Windows, many times its size, are only ever streamed into the sums.
    """
    complete = F.lit(True)
    for name in dict.fromkeys([*features, target]):
        complete = complete & F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))
    known = dense.filter(complete)
    if position is not None:  # counted anew: rows that were left out would be holes
        position = None
    split = cut_lineage(time_split(known, keys, time_col, fraction, block=block))

    def pairs(rows: DataFrame) -> DataFrame:
        return windows.training_pairs(rows, keys, time_col, features, target, length, horizon,
                                      position=position, block=block)

    settings = {"features": list(features), "length": length, **options.pop("parameters", {})}
    return fit(pairs(split.filter("is_train")), pairs(split.filter(~F.col("is_train"))),
               horizon=horizon, parameters=settings, **options)
