"""Carry whole rows through an operator without its columns meeting theirs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(df: DataFrame, *columns: Column, without: str | None = None) -> DataFrame:
    """One struct ``_doc`` with all columns of ``df`` but ``without``, and the given columns beside it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != without]).alias("_doc"), *columns)


def unpacked(df: DataFrame, names: list[str], **replaced: Column) -> DataFrame:
    """The columns of ``_doc`` again, some of them replaced."""
    return df.select(*[replaced.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in names])

