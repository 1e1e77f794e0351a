"""Exact quantiles whose memory does not grow with the data.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. That
is used here only while the counted input is small. Beyond that, a quantile
sketch brackets each wanted rank, one aggregation pass counts what lies below
and inside each bracket, and brackets are narrowed until the few values left can
be ranked. Every pass is a scan with partial aggregation; nothing is sampled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUFFER_ROWS = 2_000_000
_SKETCH = 10_000
_MAX_PASSES = 12


@dataclass
class _Bracket:
    """The interval that holds the sorted positions ``first`` and ``last``."""

    first: int
    last: int
    low: float
    high: float
    smallest: float      # of the whole group
    largest: float
    narrow: bool = True
    below: int = 0       # rows < low
    at_low: int = 0
    between: int = 0     # rows strictly inside (low, high)
    upto: int = 0        # rows <= high

    def holds(self) -> bool:
        return self.below <= self.first and self.last < self.upto


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probs: list[float],
    by: str | None = None,
    rows_at_most: int | None = None,
    buffer_rows: int = BUFFER_ROWS,
    sketch: int = _SKETCH,
) -> DataFrame:
    """Linearly interpolated quantiles as rows ``([by], prob, value)``.

    ``by`` must have few distinct values (a category); NULL groups and NULL
    values are left out. ``rows_at_most`` saves counting where the caller has
    counted already.
    """
    x = F.col(value) if isinstance(value, str) else value
    rows = df.select((F.col(by) if by else F.lit("")).alias("_g"), x.cast("double").alias("_x"))
    rows = rows.where("_g IS NOT NULL AND _x IS NOT NULL")
    size = rows.count() if rows_at_most is None else rows_at_most
    if size <= buffer_rows:
        table = _buffered(rows, probs)
    else:
        table = _narrowed(rows, probs, buffer_rows, sketch)
    keys = [F.col("_g").alias(by)] if by else []
    return table.select(*keys, "prob", "value")


def quantile_values(df: DataFrame, value: str | Column, probs: list[float], **options) -> list[float]:
    """The quantiles of one column on the driver, in the order of ``probs``."""
    found = {r["prob"]: r["value"] for r in exact_quantiles(df, value, probs, **options).collect()}
    return [found.get(p) for p in probs]


def _buffered(rows: DataFrame, probs: list[float]) -> DataFrame:
    ladder = F.array(*map(F.lit, probs))
    return (
        rows.groupBy("_g")
        .agg(F.percentile("_x", ladder).alias("q"))
        .select("_g", F.posexplode("q").alias("i", "value"))
        .select("_g", F.element_at(ladder, F.col("i") + 1).alias("prob"), "value")
    )


def _brackets_table(rows: DataFrame, brackets: dict) -> DataFrame:
    """One row per group with its brackets, for a broadcast join."""
    bounds = T.ArrayType(T.StructType([
        T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType()),
    ]))
    schema = T.StructType([rows.schema["_g"], T.StructField("b", bounds)])
    data = [(g, [(b.low, b.high) for b in bs]) for g, bs in brackets.items()]
    return F.broadcast(rows.sparkSession.createDataFrame(data, schema))


def _narrowed(rows: DataFrame, probs: list[float], limit: int, sketch: int) -> DataFrame:
    margin = 2.0 / sketch
    ladder = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-margin, margin)})
    first = rows.groupBy("_g").agg(
        F.count("_x").alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"),
        F.percentile_approx("_x", F.array(*map(F.lit, ladder)), sketch).alias("q"),
    ).collect()
    sizes = {r["_g"]: r["n"] for r in first}
    brackets = {}
    for r in first:
        at = dict(zip(ladder, r["q"]))
        brackets[r["_g"]] = [
            _bracket(p, r["n"], r["lo"], r["hi"], at, margin, r["n"] > limit) for p in probs
        ]
    _count(rows, brackets)
    for _ in range(_MAX_PASSES):
        wide = {
            g: [b.narrow and b.between > limit for b in bs] for g, bs in brackets.items()
        }
        if not any(any(w) for w in wide.values()):
            break
        _tighten(rows, brackets, wide, margin, sketch)
        _count(rows, brackets)
    return _pick(rows, brackets, sizes, probs)


def _bracket(p, n, low, high, at, margin, narrow) -> _Bracket:
    position = p * (n - 1)
    bracket = _Bracket(math.floor(position), math.ceil(position), low, high, low, high, narrow)
    if narrow:
        bracket.low = low if p - margin <= 0 else at[max(p - margin, 0.0)]
        bracket.high = high if p + margin >= 1 else at[min(p + margin, 1.0)]
    return bracket


def _count(rows: DataFrame, brackets: dict) -> None:
    """Fill in the counts of all brackets in one scan."""
    width = len(next(iter(brackets.values())))
    joined = rows.join(_brackets_table(rows, brackets), "_g")
    x, counts = F.col("_x"), []
    for i in range(width):
        b = F.col("b")[i]
        counts += [
            F.count_if(x < b["low"]).alias(f"below{i}"),
            F.count_if(x == b["low"]).alias(f"at{i}"),
            F.count_if((x > b["low"]) & (x < b["high"])).alias(f"between{i}"),
            F.count_if(x <= b["high"]).alias(f"upto{i}"),
        ]
    missed = False
    for r in joined.groupBy("_g").agg(*counts).collect():
        for i, b in enumerate(brackets[r["_g"]]):
            b.below, b.at_low = r[f"below{i}"], r[f"at{i}"]
            b.between, b.upto = r[f"between{i}"], r[f"upto{i}"]
            if not b.holds():
                # Outside the sketch's error bound: rank the whole group instead.
                b.low, b.high, b.narrow, missed = b.smallest, b.largest, False, True
    if missed:
        _count(rows, brackets)


def _tighten(rows: DataFrame, brackets: dict, wide: dict, margin: float, sketch: int) -> None:
    """Replace the bounds of over-full brackets by sketch values from their inside."""
    width = len(next(iter(brackets.values())))
    inside = rows.join(_brackets_table(rows, brackets), "_g")
    x, sketches = F.col("_x"), []
    steps = max(int(1 / margin), 2)
    ladder = F.array(*[F.lit(i / steps) for i in range(steps + 1)])
    for i in range(width):
        b = F.col("b")[i]
        value = F.when((x > b["low"]) & (x < b["high"]), x)
        sketches.append(F.percentile_approx(value, ladder, sketch).alias(f"q{i}"))
    for r in inside.groupBy("_g").agg(*sketches).collect():
        for i, b in enumerate(brackets[r["_g"]]):
            if not wide[r["_g"]][i]:
                continue
            start = b.below + b.at_low
            lower = (b.first - start) / b.between * steps - 2
            upper = (b.last - start) / b.between * steps + 2
            low = b.low if lower < 0 else r[f"q{i}"][min(int(lower), steps)]
            high = b.high if upper > steps else r[f"q{i}"][max(math.ceil(upper), 0)]
            b.narrow = (low, high) != (b.low, b.high)
            b.low, b.high = low, high


def _pick(rows: DataFrame, brackets: dict, sizes: dict, probs: list[float]) -> DataFrame:
    """Rank the values left in each bracket and read off the wanted positions."""
    g = rows.schema["_g"]
    schema = T.StructType([
        g, T.StructField("i", T.IntegerType()), T.StructField("prob", T.DoubleType()),
        T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType()),
        T.StructField("below", T.LongType()), T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()), T.StructField("share", T.DoubleType()),
    ])
    data = [
        (k, i, p, b.low, b.high, b.below, b.first, b.last, p * (sizes[k] - 1) - b.first)
        for k, bs in brackets.items() for i, (p, b) in enumerate(zip(probs, bs))
    ]
    wanted = F.broadcast(rows.sparkSession.createDataFrame(data, schema))
    left = (
        rows.join(wanted.select("_g", "i", "low", "high"), "_g")
        .where("_x BETWEEN low AND high")
        .groupBy("_g", "i", "_x").agg(F.count("*").alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("_g", "i").orderBy("_x"))
    ranked = left.withColumn("upto", upto).join(wanted.drop("low", "high"), ["_g", "i"])
    start, end = F.col("below") + F.col("upto") - F.col("n"), F.col("below") + F.col("upto")

    def at(position: str) -> Column:
        return F.max(F.when((start <= F.col(position)) & (F.col(position) < end), F.col("_x")))

    return (
        ranked.groupBy("_g", "i", "prob", "share").agg(at("first").alias("a"), at("last").alias("b"))
        .select("_g", "prob", (F.col("a") + (F.col("b") - F.col("a")) * F.col("share")).alias("value"))
    )
