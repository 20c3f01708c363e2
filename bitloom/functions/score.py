"""Scores of a translation against another, and of a sample."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

ORDERS, BETA2, COPY = 6, 4.0, 90.0


def chrf_of(hypothesis: str | None, reference: str | None) -> float:
    """Sentence chrF: character 1- to 6-grams without white space, beta 2, orders that both sides are long enough for."""
    h, r = ("".join((s or "").replace("﻿", "").split()) for s in (hypothesis, reference))
    last = min(ORDERS, len(h), len(r))
    if not last:
        return 0.0
    precision = recall = 0.0
    for n in range(1, last + 1):
        a, b = (Counter(map("".join, zip(*(s[k:] for k in range(n))))) for s in (h, r))
        common = sum((a & b).values())
        precision += common / (len(h) - n + 1)
        recall += common / (len(r) - n + 1)
    p, q = precision / last, recall / last
    return 100 * (1 + BETA2) * p * q / (BETA2 * p + q) if p + q else 0.0


@F.pandas_udf(DoubleType())
def chrf(hypothesis: pd.Series, reference: pd.Series) -> pd.Series:
    return pd.Series([chrf_of(h, r) for h, r in zip(hypothesis, reference)])


def is_copy(score: Column) -> Column:
    return score >= COPY


def one_place(score: Column) -> Column:
    """Rounded to one place, halves up."""
    return F.floor(score * 10 + 0.5) / 10


def wilson(k: Column, n: Column, z: float = 1.96) -> Column:
    """Struct (low, high): the 95 % interval of k of n in per cent; (0, 0) of none."""
    k, n = k.cast("double"), n.cast("double")
    p, z2 = k / F.nullif(n, F.lit(0.0)), z * z
    mid = (p + z2 / (2 * n)) / (1 + z2 / n)
    half = z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    none = F.coalesce(n, F.lit(0.0)) == 0
    return F.struct(
        F.when(none, 0.0).otherwise(F.greatest(F.lit(0.0), mid - half) * 100).alias("low"), F.when(none, 0.0).otherwise(F.least(F.lit(1.0), mid + half) * 100).alias("high")
    )
