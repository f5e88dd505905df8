"""Least squares by normal equations, and the two sample surfaces of the notebook."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.schemas import inline_rows


def least_squares(rows: DataFrame, inputs: Sequence[str], target: str) -> DataFrame:
    """Coefficients without intercept: one pass sums the products, the small system is solved after it."""
    inputs = list(inputs)
    sums = [F.sum(F.col(a) * F.col(b)).alias(f"{i}_{j}") for i, a in enumerate(inputs) for j, b in enumerate(inputs) if i <= j]
    sums += [F.sum(F.col(a) * F.col(target)).alias(f"{i}_y") for i, a in enumerate(inputs)]
    complete = rows.dropna(subset=[*inputs, target])
    total = complete.agg(*sums).first()
    size = range(len(inputs))
    xtx = np.array([[total[f"{min(i, j)}_{max(i, j)}"] for j in size] for i in size], dtype=float)
    xty = np.array([total[f"{i}_y"] for i in size], dtype=float)
    beta = np.linalg.solve(xtx, xty)
    return inline_rows(rows.sparkSession, list(zip(inputs, map(float, beta), strict=True)), ("term", "beta"))


def sine_curve(x: Column) -> Column:
    return F.sin(x * F.lit(8.0))


def gauss_surface(x: Column, y: Column) -> Column:
    return F.exp(-(x * x + y * y) / F.lit(2.0))


def sample_tsv(rows: DataFrame, fraction: float, seed: int = 1234) -> DataFrame:
    """A random share of the rows as tab-separated lines."""
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in rows.columns])
    return rows.sample(withReplacement=False, fraction=fraction, seed=seed).select(line.alias("line"))


def hash_sample(rows: DataFrame, key: str, fraction: float, seed: int = 1234) -> DataFrame:
    """A share of the rows chosen by a hash of `key`: the same rows on every run, engine and partitioning."""
    digits = F.left(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), F.lit(8))
    return rows.filter(digits < F.lit(f"{round(fraction * 16**8):08x}"))
