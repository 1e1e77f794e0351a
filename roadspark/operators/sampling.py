"""Reproducible sampling and fold assignment by hashing the row id."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadspark import schema as S


def _digest(seed: int, id_col: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def _hash32(seed: int, id_col: str) -> Column:
    return F.conv(F.substring(_digest(seed, id_col), 1, 8), 16, 10).cast("bigint")


def fold_column(k: int, seed: int = S.SEED, id_col: str = S.ID) -> Column:
    """Fold 0..k-1 of a row. Depends on the id alone, so it needs no shuffle or sort."""
    return (_hash32(seed, id_col) % k).cast("int")


def with_folds(df: DataFrame, k: int = S.CV_FOLDS, seed: int = S.SEED, id_col: str = S.ID) -> DataFrame:
    return df.withColumn("fold", fold_column(k, seed, id_col))


def hash_sample(df: DataFrame, n: int, seed: int = S.SEED, id_col: str = S.ID) -> DataFrame:
    """``n`` rows (or all, if fewer) drawn without replacement.

    Keeps the ``n`` smallest hashes. A first threshold on the hash lets only
    about ``n`` rows reach the sort, whatever the table's size.
    """
    total = df.count()
    if total <= n:
        return df
    likely = n + 6 * math.sqrt(n) + 10
    candidates = df
    if likely * 4 < total:
        candidates = df.where(_hash32(seed, id_col) < int(likely / total * 2**32) + 1)
        if candidates.count() < n:
            candidates = df
    return candidates.orderBy(_digest(seed, id_col), id_col).limit(n)
