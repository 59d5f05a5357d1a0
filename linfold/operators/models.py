"""Model objects: small driver-held coefficient vectors whose predictions
are plain column expressions evaluated by the executors."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linfold.functions.vectors import linear_sql


@dataclass
class LinearModel:
    """``w . z + intercept`` where z = features, or [features, their two-way
    products] when ``interactions`` (then ``d`` is the base width)."""

    name: str
    weights: np.ndarray
    intercept: float = 0.0
    d: int = 0
    interactions: bool = False
    info: dict = field(default_factory=dict)

    def prediction(self, features: str = "features") -> Column:
        """One code-generated expression; interaction products are formed on
        the fly from the base features, never materialised as an array."""
        d = self.d or len(self.weights)
        return F.expr(linear_sql(features, self.weights, self.intercept, d, self.interactions))

    def weights_frame(self, spark: SparkSession) -> DataFrame:
        """``(feature BIGINT, weight DOUBLE)``; the intercept is feature -1."""
        rows = [(int(k), float(w)) for k, w in enumerate(self.weights)]
        if self.intercept or self.info.get("has_intercept"):
            rows.append((-1, float(self.intercept)))
        schema = T.StructType([T.StructField("feature", T.LongType()),
                               T.StructField("weight", T.DoubleType())])
        return spark.createDataFrame(rows, schema)


@dataclass
class ConstantModel:
    """Predicts one number for every row (the training-mean baseline)."""

    name: str
    value: float
    interactions = False
    weights = np.zeros(0)

    @property
    def intercept(self) -> float:
        return float(self.value)

    def prediction(self, features: str = "features") -> Column:
        return F.lit(float(self.value))


#: The table of stored models: feature -1 is the intercept, ``width`` the base width.
MODEL_SCHEMA = "model string, width int, interactions boolean, feature long, weight double"
STORED_NUMBERS = 32_000_000  # weights that are read back at once: 256 MB


def save_models(spark: SparkSession, models: Mapping[str, LinearModel | ConstantModel], d: int, path: str) -> None:
    """Write models as rows ``(model, width, interactions, feature, weight)``."""
    table = pa.Table.from_batches([pa.RecordBatch.from_pydict({
        "model": [name] * (1 + len(m.weights)), "width": pa.array([d] * (1 + len(m.weights)), pa.int32()),
        "interactions": [bool(m.interactions)] * (1 + len(m.weights)), "feature": pa.array(range(-1, len(m.weights)), pa.int64()),
        "weight": np.append(float(m.intercept), m.weights)}) for name, m in models.items()])
    spark.createDataFrame(table, schema=MODEL_SCHEMA).write.mode("error").parquet(path)


def load_models(stored: DataFrame) -> dict[str, LinearModel]:
    """The models of a stored table, by name. Their number of weights is checked
    first; a feature without a row weighs 0, two rows for one are an error."""
    many = stored.count()
    if many > STORED_NUMBERS:
        raise ValueError(f"{many} stored weights: read the models in parts")
    rows = stored.select("model", "width", "interactions", "feature", "weight").toArrow().to_pandas()
    if rows.duplicated(["model", "feature"]).any():
        raise ValueError("a stored model has two weights for one feature")
    out = {}
    for name, part in rows.groupby("model", sort=True):
        d, crossed = int(part["width"].iloc[0]), bool(part["interactions"].iloc[0])
        w = np.zeros(1 + (d + d * d if crossed else d))
        w[part["feature"].to_numpy() + 1] = part["weight"].to_numpy()
        out[name] = LinearModel(name, w[1:], float(w[0]), d, crossed, {"has_intercept": True})
    return out


def ideal_prediction(label: str = "label") -> Column:
    """The perfect predictor: the label itself."""
    return F.col(label)
