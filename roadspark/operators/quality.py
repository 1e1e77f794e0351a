"""Data-quality profile. Each report is one pass over all columns, then tidy rows.

With ``by`` (a dataset tag) every report is made per dataset in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadspark import schema as S
from roadspark.functions.moments import rounded, sample_kurtosis, sample_skewness
from roadspark.functions.quantiles import exact_quantiles
from roadspark.runtime import BROADCAST_ROWS, written

TARGET_QUANTILES = [0.25, 0.50, 0.75, 0.90, 0.95, 0.99]


def tag_datasets(**datasets: DataFrame) -> DataFrame:
    """Stack datasets with a ``dataset`` column; a column one of them lacks is NULL there."""
    tagged = [df.withColumn("dataset", F.lit(name)) for name, df in datasets.items()]
    stacked = tagged[0]
    for df in tagged[1:]:
        stacked = stacked.unionByName(df, allowMissingColumns=True)
    return stacked


def _columns(df: DataFrame, by: str | None) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name != by]


def _numeric(df: DataFrame, by: str | None) -> list[str]:
    return [f.name for f in _columns(df, by) if isinstance(f.dataType, T.NumericType)]


def _group(df: DataFrame, by: str | None):
    return df.groupBy(by) if by else df.groupBy()


def _keys(by: str | None) -> list[str]:
    return [by] if by else []


def _percent(part: Column, whole: Column, half_even: bool) -> Column:
    return rounded(F.try_divide(part, whole) * 100, 2, half_even)


def _null_counts(df: DataFrame, by: str | None) -> DataFrame:
    """Rows ``([by], column, count, total_rows)`` for every column."""
    names = [f.name for f in _columns(df, by)]
    one = _group(df, by).agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(names)],
    )
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("count")) for i, c in enumerate(names)]
    return one.select(*_keys(by), "total_rows", F.inline(F.array(*cells)))


def missing_by_column(df: DataFrame, by: str | None = None, half_even: bool = True) -> DataFrame:
    """Columns with missing cells: count and percentage."""
    return _null_counts(df, by).where("count > 0").select(
        *_keys(by), "column", "count",
        _percent(F.col("count"), F.col("total_rows"), half_even).alias("percentage"),
    )


def total_missing_cells(df: DataFrame, by: str | None = None) -> DataFrame:
    return _group(_null_counts(df, by), by).agg(
        F.max("total_rows").alias("total_rows"), F.sum("count").alias("total_missing_cells")
    )


def duplicates(df: DataFrame, columns: list[str], by: str | None = None) -> DataFrame:
    """Rows equal to an earlier one on ``columns``; NULLs are equal."""
    groups = df.groupBy(*_keys(by), *columns).agg(F.count("*").alias("_n"))
    return _group(groups, by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def full_duplicates(df: DataFrame, by: str | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows equal to an earlier one on all columns; NULLs are equal.

    Only an 8-byte hash of each row is shuffled at first. Rows whose hash occurs
    more than once are then compared in full, so a collision counts for nothing.
    """
    names = [f.name for f in _columns(df, by)]
    hashed = df.withColumn("_h", F.xxhash64(*names))
    counts = hashed.groupBy(*_keys(by), "_h").agg(F.count("*").alias("_n"))
    repeated = written(counts.where("_n > 1").select("_h").distinct(), "repeated")
    small = repeated.count() <= broadcast_rows
    suspects = hashed.join(F.broadcast(repeated) if small else repeated, "_h", "left_semi")
    copies = suspects.groupBy(*_keys(by), *names).agg((F.count("*") - 1).alias("_extra"))
    extra = copies.select(F.lit(0).cast("bigint").alias("_rows"), "_extra", *_keys(by))
    rows = _group(df, by).agg(F.count("*").alias("_rows")).select(
        "_rows", F.lit(0).cast("bigint").alias("_extra"), *_keys(by)
    )
    return _group(rows.unionByName(extra), by).agg(
        F.sum("_rows").alias("total_rows"), F.sum("_extra").alias("full_duplicates")
    )


def key_duplicates(df: DataFrame, by: str | None = None, keys: list[str] = S.KEY_COLUMNS) -> DataFrame:
    return duplicates(df, keys, by).withColumnRenamed("duplicates", "key_duplicates")


def shape_and_types(df: DataFrame, by: str | None = None) -> DataFrame:
    fields = _columns(df, by)
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("dtype"))
        for i, f in enumerate(fields)
    ]
    rows = _group(df, by).agg(F.count("*").alias("rows"))
    return rows.select(
        *_keys(by), "rows", F.lit(len(fields)).alias("columns"), F.inline(F.array(*cells))
    )


def _long(df: DataFrame, names: list[str], by: str | None, kind: str) -> DataFrame:
    casts = [F.col(c).cast(kind).alias(c) for c in names]
    return df.select(*_keys(by), *casts).unpivot(_keys(by), names, "column", "value")


def numeric_describe(
    df: DataFrame, by: str | None = None, digits: int = 4, half_even: bool = True
) -> DataFrame:
    """Count, mean, std, min, quartiles and max of every numeric column."""
    names = _numeric(df, by)
    parts = []
    for i, c in enumerate(names):
        x = F.col(c).cast("double")
        parts += [F.struct(
            F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
        ).alias(f"s{i}")]
    stats = _group(df, by).agg(*parts).select(
        *_keys(by), F.inline(F.array(*[f"s{i}" for i in range(len(names))]))
    )
    # One group per dataset and numeric column.
    tag = F.col(by) if by else F.lit("")
    long = _long(df, names, by, "double").withColumn("_k", F.concat_ws("\x1f", tag, F.col("column")))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], by="_k")
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("value")))
    q = q.groupBy("_k").agg(at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"))
    table = stats.withColumn("_k", F.concat_ws("\x1f", tag, F.col("column"))).join(
        F.broadcast(q), "_k", "left"
    )
    measures = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return table.select(
        *_keys(by), "column", "count",
        *[rounded(F.col(m), digits, half_even).alias(m) for m in measures],
    )


def categorical_profile(df: DataFrame, by: str | None = None, top: int = 5) -> DataFrame:
    """Per text column: distinct values, missing cells and the most frequent values."""
    names = [f.name for f in _columns(df, by) if isinstance(f.dataType, T.StringType)]
    keys = [*_keys(by), "column"]
    counts = _long(df, names, by, "string").groupBy(*keys, "value").agg(F.count("*").alias("n"))
    totals = counts.groupBy(*keys).agg(
        F.count("value").alias("unique_values"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
    )
    # NULLs are ranked last and dropped afterwards: a filter on the value would go
    # down to the scan and keep the two uses of counts from sharing one shuffle.
    order = Window.partitionBy(*keys).orderBy(F.col("value").isNull(), F.desc("n"), "value")
    best = counts.withColumn("position", F.row_number().over(order)).where(
        (F.col("position") <= top) & F.col("value").isNotNull()
    )
    # totals: one row per text column.
    return best.join(F.broadcast(totals), keys, "right").select(
        *keys, "unique_values", "missing", "position", "value", F.col("n").alias("value_count")
    )


def target_analysis(df: DataFrame, column: str = S.TARGET) -> DataFrame:
    """One row with moments, extremes and quantiles of the target."""
    x = F.col(column)
    quantiles = {
        r["prob"]: r["value"] for r in exact_quantiles(df, column, TARGET_QUANTILES).collect()
    }
    return df.agg(
        F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
        sample_skewness(x).alias("skewness"), sample_kurtosis(x).alias("kurtosis"),
    ).withColumns({
        "median": F.lit(quantiles.get(0.5)).cast("double"),
        **{f"p{round(p * 100)}": F.lit(quantiles.get(p)).cast("double") for p in TARGET_QUANTILES},
    })


def feature_summary(df: DataFrame, by: str | None = None, half_even: bool = True) -> DataFrame:
    """Per column: type, missing cells, distinct values; numeric ones also mean, std, min, max."""
    numeric = set(_numeric(df, by))
    parts = []
    for i, f in enumerate(_columns(df, by)):
        x = F.col(f.name)
        d = x.cast("double") if f.name in numeric else F.lit(None).cast("double")
        parts.append(F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("feature"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.count_if(x.isNull()).alias("missing_count"),
            _percent(F.count_if(x.isNull()), F.count("*"), half_even).alias("missing_pct"),
            F.count_distinct(x).alias("unique_values"),
            rounded(F.avg(d), 4, half_even).alias("mean"),
            rounded(F.stddev_samp(d), 4, half_even).alias("std"),
            F.min(d).alias("min"), F.max(d).alias("max"),
        ).alias(f"s{i}"))
    return _group(df, by).agg(*parts).select(
        *_keys(by), F.inline(F.array(*[f"s{i}" for i in range(len(parts))]))
    )


def validate_schema(raw: DataFrame, kind: str = "train", by: str | None = None) -> DataFrame:
    """Compare a table read as text with the expected columns, types and value domains.

    Rows ``(position, column, status, expected_type, bad_type, bad_domain,
    schema_valid)``: expected columns first, then extra ones in file order. Extra
    columns do not make the schema invalid.
    """
    expected = S.SCHEMAS[kind].fields
    present = [c for c in raw.columns if c != by]
    valid = all(f.name in present for f in expected)
    extra = [c for c in present if c not in S.SCHEMAS[kind].names]
    parts = []
    for f in expected:
        text = F.col(f.name).cast("string") if f.name in present else None
        bad_type = bad_domain = F.lit(None).cast("bigint")
        if text is not None:
            bad_type = F.count_if(text.isNotNull() & text.try_cast(f.dataType).isNull())
            if f.name in S.DOMAINS:
                bad_domain = F.count_if(text.isNotNull() & ~text.isin(S.DOMAINS[f.name]))
        status = "ok" if text is not None else "missing"
        parts.append((f.name, status, f.dataType.simpleString(), bad_type, bad_domain))
    nothing = F.lit(None).cast("bigint")
    parts += [(c, "extra", None, nothing, nothing) for c in extra]
    structs = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(status).alias("status"),
            F.lit(kind_).cast("string").alias("expected_type"),
            bad_type.alias("bad_type"), bad_domain.alias("bad_domain"),
            F.lit(valid).alias("schema_valid"),
        ).alias(f"s{i}")
        for i, (name, status, kind_, bad_type, bad_domain) in enumerate(parts)
    ]
    return _group(raw, by).agg(*structs).select(
        *_keys(by), F.inline(F.array(*[f"s{i}" for i in range(len(structs))]))
    )


def quality_report(train: DataFrame, test: DataFrame, half_even: bool = True) -> DataFrame:
    """One nested row per dataset, with the target analysis on the training one."""
    tagged = tag_datasets(train=train, test=test)
    by = "dataset"

    def nested(table: DataFrame, name: str) -> DataFrame:
        rest = [c for c in table.columns if c != by]
        # A report has one row per column, or per column and top value.
        return table.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(*rest))).alias(name))

    report = total_missing_cells(tagged, by)
    for table in (
        full_duplicates(tagged, by).drop("total_rows"),
        key_duplicates(tagged, by).drop("total_rows"),
        nested(shape_and_types(tagged, by).drop("rows", "columns"), "dtypes"),
        nested(missing_by_column(tagged, by, half_even), "columns_with_missing"),
        nested(numeric_describe(tagged, by, 4, half_even), "numerical_statistics"),
        nested(categorical_profile(tagged, by), "categorical_statistics"),
        target_analysis(train).select(
            F.lit("train").alias(by), F.struct("*").alias("target_analysis")
        ),
    ):
        report = report.join(F.broadcast(table), by, "left")
    return report
