"""Dense-vector arithmetic on ``ARRAY<DOUBLE>`` columns.

When the width ``d`` is known (the usual case after a width check) every
function expands into plain scalar arithmetic over ``features[k]`` so the
whole expression stays inside whole-stage code generation. Without ``d``
the higher-order-function forms are used (interpreted, still JVM-side).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_double(x: float) -> str:
    """An exact SQL DOUBLE literal (shortest round-trip digits, ``D`` suffix)."""
    x = float(x)
    if math.isnan(x):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(x):
        return "CAST('Infinity' AS DOUBLE)" if x > 0 else "CAST('-Infinity' AS DOUBLE)"
    r = repr(x)
    return f"({r}D)" if not r.startswith("-") else f"(-{r[1:]}D)"


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def term_sql(features: str, d: int, interactions: bool = False) -> list[str]:
    """SQL text of the model terms: ``f[k]``, then ``f[i] * f[j]`` row-major."""
    f = _quote(features)
    terms = [f"{f}[{k}]" for k in range(d)]
    if interactions:
        terms += [f"({f}[{i}] * {f}[{j}])" for i in range(d) for j in range(d)]
    return terms


def linear_sql(features: str, weights: Sequence[float], intercept: float | None = None,
               d: int | None = None, interactions: bool = False) -> str:
    """SQL text of ``sum_k z_k * w_k (+ intercept)``, summed left to right.

    Wide models are emitted as one expression string so building them costs
    one call into the JVM, not one per term.
    """
    d = len(weights) if d is None else d
    terms = term_sql(features, d, interactions)
    if len(terms) != len(weights):
        raise ValueError(f"{len(weights)} weights for {len(terms)} terms")
    parts = [f"{t} * {sql_double(w)}" for t, w in zip(terms, weights)]
    if intercept:
        parts.append(sql_double(intercept))
    return " + ".join(parts) if parts else "(0.0D)"


def dot(features: Column | str, weights: Sequence[float]) -> Column:
    """``features . weights`` as a sum of ``features[k] * w_k`` terms."""
    if isinstance(features, str):
        return F.expr(linear_sql(features, weights))
    f = features
    terms = [f.getItem(k) * F.lit(float(w)) for k, w in enumerate(weights)]
    if not terms:
        return F.lit(0.0)
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def predict(features: Column | str, weights: Sequence[float],
            intercept: float = 0.0) -> Column:
    """Linear prediction ``w . x + intercept``."""
    if isinstance(features, str):
        return F.expr(linear_sql(features, weights, intercept))
    out = dot(features, weights)
    if intercept:
        out = out + F.lit(float(intercept))
    return out


def scale(features: Column | str, factor: Column | float) -> Column:
    """Scalar times vector."""
    c = factor if isinstance(factor, Column) else F.lit(float(factor))
    return F.transform(_col(features), lambda v: v * c)


def gradient_summand(features: Column | str, label: Column | str,
                     weights: Sequence[float]) -> Column:
    """``(w . x - y) * x`` for one row, as an array column."""
    err = dot(features, weights) - _col(label)
    return scale(features, err)


def squared_error(label: Column | str, prediction: Column | str) -> Column:
    diff = _col(label) - _col(prediction)
    return diff * diff


def interaction_terms(features: Column | str, d: int) -> list[Column]:
    """Row-major products ``x_i * x_j`` for i, j in [0, d) (duplicates kept)."""
    f = _col(features)
    return [f.getItem(i) * f.getItem(j) for i in range(d) for j in range(d)]


def two_way_interactions(features: Column | str, d: int | None = None) -> Column:
    """``[x, flatten(outer(x, x))]``: width d -> d + d^2, order row-major."""
    f = _col(features)
    if d is None:
        return F.concat(f, F.flatten(F.transform(f, lambda a: F.transform(f, lambda b: a * b))))
    return F.array(*([f.getItem(k) for k in range(d)] + interaction_terms(f, d)))


def to_ml_vector(features: Column | str) -> Column:
    """``ARRAY<DOUBLE>`` -> ``pyspark.ml`` dense vector (only for ML interop)."""
    from pyspark.ml.functions import array_to_vector
    return array_to_vector(_col(features))


def from_ml_vector(vector: Column | str) -> Column:
    """``pyspark.ml`` vector -> ``ARRAY<DOUBLE>`` (``toArray`` per row)."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(_col(vector))
