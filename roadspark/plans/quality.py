"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspark.operators import quality as Q
from roadspark.plans.base import r, r6, traffic, train_test, with_traffic
from roadspark.schema import TARGET

COLUMNS = {
    "Index": "bigint", "geohash": "string", "day": "int", "timestamp": "string", "demand": "double",
    "RoadType": "string", "NumberofLanes": "int", "LargeVehicles": "string", "Landmarks": "string",
    "Temperature": "double", "Weather": "string",
}
NUMERIC = [c for c, t in COLUMNS.items() if t != "string"]
TEXT = [c for c, t in COLUMNS.items() if t == "string"]
KEYS = "geohash, day, timestamp"


def with_copies(df: DataFrame) -> DataFrame:
    """Every 50th row once more: the traffic rows have no duplicates of their own."""
    return df.unionByName(df.where(F.col("Index") % 50 == 0))


def both(spark, sf_dir) -> DataFrame:
    """Train and test stacked; test rows come without the target."""
    train, test = train_test(spark, sf_dir)
    return Q.tag_datasets(train=train, test=test.drop(TARGET))


def raw_text(spark, sf_dir) -> DataFrame:
    """Observations as text with faults: bad numbers, an unknown weather, a missing and an extra column."""
    df = traffic(spark, sf_dir)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns if c != "Landmarks"])
    return text.withColumns({
        "Temperature": F.when(F.col("Index") % 500 == 7, "warm").otherwise(F.col("Temperature")),
        "Weather": F.when(F.col("Index") % 400 == 3, "Windy").otherwise(F.col("Weather")),
        "source": F.lit("sensor"),
    })


QUERIES = {
    "S02_validate_schema": lambda s, d: Q.validate_schema(raw_text(s, d)),
    "Q01_missing_by_column": lambda s, d: r6(Q.missing_by_column(traffic(s, d), half_even=False)),
    "Q02_total_missing_cells": lambda s, d: Q.total_missing_cells(traffic(s, d)),
    "Q03_full_duplicates": lambda s, d: Q.full_duplicates(with_copies(traffic(s, d))),
    "Q04_key_duplicates": lambda s, d: Q.key_duplicates(traffic(s, d)),
    "Q05_shape_and_types": lambda s, d: Q.shape_and_types(traffic(s, d)),
    "Q06_numeric_describe": lambda s, d: Q.numeric_describe(traffic(s, d), half_even=False),
    "Q07_categorical_profile": lambda s, d: Q.categorical_profile(traffic(s, d)),
    "Q08_target_analysis": lambda s, d: r6(Q.target_analysis(traffic(s, d))),
    "Q09_feature_summary": lambda s, d: r6(Q.feature_summary(traffic(s, d), half_even=False)),
    "Q10_missing_by_dataset": lambda s, d: r6(Q.missing_by_column(both(s, d), "dataset", half_even=False)),
    "Q10_duplicates_by_dataset": lambda s, d: Q.key_duplicates(both(s, d), "dataset"),
    "Q10_describe_by_dataset": lambda s, d: Q.numeric_describe(both(s, d), "dataset", half_even=False),
    "Q10_categories_by_dataset": lambda s, d: Q.categorical_profile(both(s, d), "dataset"),
    "Q10_feature_summary_by_dataset": lambda s, d: r6(Q.feature_summary(both(s, d), "dataset", half_even=False)),
}

_BOTH = """both_sides AS (SELECT *, 'train' AS dataset FROM train
    UNION ALL SELECT * REPLACE (NULL::DOUBLE AS demand), 'test' AS dataset FROM test)"""


def _union(template: str, names: list[str]) -> str:
    return " UNION ALL ".join(template.format(c=f'"{c}"', n=c, t=COLUMNS[c], i=list(COLUMNS).index(c)) for c in names)


def _missing(source: str, by: str = "") -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    parts = _union(
        f"SELECT {key}'{{n}}' AS \"column\", count(*) - count({{c}}) AS count,"
        f" round((count(*) - count({{c}})) / count(*) * 100, 2) AS percentage FROM {source} {group}", list(COLUMNS)
    )
    return f"SELECT {key}\"column\", count, {r('percentage')} FROM ({parts}) WHERE count > 0"


def _describe(source: str, by: str = "") -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return _union(
        f"SELECT {key}'{{n}}' AS \"column\", count({{c}}) AS count, round(avg({{c}}), 4) AS mean,"
        f" round(stddev_samp({{c}}), 4) AS std, round(min({{c}})::DOUBLE, 4) AS min,"
        f" round(quantile_cont({{c}}::DOUBLE, 0.25), 4) AS p25, round(quantile_cont({{c}}::DOUBLE, 0.5), 4) AS p50,"
        f" round(quantile_cont({{c}}::DOUBLE, 0.75), 4) AS p75, round(max({{c}})::DOUBLE, 4) AS max"
        f" FROM {source} {group}", NUMERIC
    )


def _profile(source: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    using = f"USING ({by})" if by else "ON true"
    part = (
        f"SELECT {key}'{{n}}' AS \"column\", unique_values, missing, CAST(position AS INTEGER) AS position,"
        f" value, value_count FROM (SELECT {key}count(DISTINCT {{c}}) AS unique_values,"
        f" count(*) - count({{c}}) AS missing FROM {source} {group}) LEFT JOIN (SELECT {key}{{c}} AS value,"
        f" count(*) AS value_count, row_number() OVER ({'PARTITION BY ' + by if by else ''} ORDER BY count(*) DESC, {{c}})"
        f" AS position FROM {source} WHERE {{c}} IS NOT NULL GROUP BY {key}{{c}} QUALIFY position <= 5) {using}"
    )
    return _union(part, TEXT)


def _summary(source: str, by: str = "") -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    parts = []
    for i, (c, t) in enumerate(COLUMNS.items()):
        measures = (
            f"round(avg(\"{c}\"), 4) AS mean, round(stddev_samp(\"{c}\"), 4) AS std,"
            f" min(\"{c}\")::DOUBLE AS min, max(\"{c}\")::DOUBLE AS max"
            if t != "string" else
            "NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS max"
        )
        parts.append(
            f"SELECT {key}{i} AS position, '{c}' AS feature, '{t}' AS dtype, count(*) - count(\"{c}\") AS missing_count,"
            f" round((count(*) - count(\"{c}\")) / count(*) * 100, 2) AS missing_pct,"
            f" count(DISTINCT \"{c}\") AS unique_values, {measures} FROM {source} {group}"
        )
    inner = " UNION ALL ".join(parts)
    return f"""SELECT {key}position, feature, dtype, missing_count, {r('missing_pct')}, unique_values,
        {r('mean')}, {r('std')}, {r('min')}, {r('max')} FROM ({inner})"""


_EXPECTED = [(c, t) for c, t in COLUMNS.items()]


def _schema_rows() -> str:
    bad = {"Temperature": "count(*) FILTER (\"Index\" % 500 = 7)"}
    domain = {
        "RoadType": "0", "LargeVehicles": "0", "Weather": "count(*) FILTER (\"Index\" % 400 = 3)",
    }
    rows = []
    for i, (c, t) in enumerate(_EXPECTED):
        missing = c == "Landmarks"
        rows.append(
            f"SELECT {i} AS position, '{c}' AS \"column\", '{'missing' if missing else 'ok'}' AS status,"
            f" '{t}' AS expected_type, CAST({'NULL' if missing else bad.get(c, '0')} AS BIGINT) AS bad_type,"
            f" CAST({'NULL' if missing else domain.get(c, 'NULL')} AS BIGINT) AS bad_domain,"
            f" false AS schema_valid FROM traffic"
        )
    rows = [q if "count(" in q else q + " LIMIT 1" for q in rows]
    rows.append(
        f"SELECT {len(_EXPECTED)}, 'source', 'extra', NULL, NULL::BIGINT, NULL::BIGINT, false FROM traffic LIMIT 1"
    )
    return " UNION ALL ".join(f"({q})" for q in rows)


_TARGET = ", ".join(
    [r("avg(demand)", "mean"), r("stddev_samp(demand)", "std"), r("min(demand)", "min"), r("max(demand)", "max"),
     r("skewness(demand)", "skewness"), r("kurtosis(demand)", "kurtosis"), r("median(demand)", "median")]
    + [r(f"quantile_cont(demand, {p})", f"p{round(p * 100)}") for p in Q.TARGET_QUANTILES]
)

ORACLE = {
    "S02_validate_schema": with_traffic(_schema_rows()),
    "Q01_missing_by_column": with_traffic(_missing("traffic")),
    "Q02_total_missing_cells": with_traffic(
        "SELECT count(*) AS total_rows, CAST("
        + " + ".join(f'count(*) - count("{c}")' for c in COLUMNS)
        + " AS BIGINT) AS total_missing_cells FROM traffic"
    ),
    "Q03_full_duplicates": with_traffic(
        """SELECT count(*) AS total_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM copies))
        AS full_duplicates FROM copies""",
        'copies AS (SELECT * FROM traffic UNION ALL SELECT * FROM traffic WHERE "Index" % 50 = 0)',
    ),
    "Q04_key_duplicates": with_traffic(
        f"""SELECT count(*) AS total_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {KEYS} FROM traffic))
        AS key_duplicates FROM traffic"""
    ),
    "Q05_shape_and_types": with_traffic(_union(
        "SELECT count(*) AS rows, 11 AS columns, {i} AS position, '{n}' AS \"column\", '{t}' AS dtype FROM traffic",
        list(COLUMNS),
    )),
    "Q06_numeric_describe": with_traffic(_describe("traffic")),
    "Q07_categorical_profile": with_traffic(_profile("traffic")),
    "Q08_target_analysis": with_traffic(f"SELECT {_TARGET} FROM traffic"),
    "Q09_feature_summary": with_traffic(_summary("traffic")),
    "Q10_missing_by_dataset": with_traffic(_missing("both_sides", "dataset"), _BOTH),
    "Q10_duplicates_by_dataset": with_traffic(
        f"""SELECT dataset, CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS key_duplicates
        FROM (SELECT dataset, count(*) AS n FROM both_sides GROUP BY dataset, {KEYS}) GROUP BY dataset""", _BOTH,
    ),
    "Q10_describe_by_dataset": with_traffic(_describe("both_sides", "dataset"), _BOTH),
    "Q10_categories_by_dataset": with_traffic(_profile("both_sides", "dataset"), _BOTH),
    "Q10_feature_summary_by_dataset": with_traffic(_summary("both_sides", "dataset"), _BOTH),
}
