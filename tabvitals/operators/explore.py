"""Exploration: descriptive statistics and value counts."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabvitals.functions.numeric import column, normalise, number, quoted, rounded_scaled
from tabvitals.functions.text import literal
from tabvitals.operators.measure import measure, row_count, to_rows
from tabvitals.operators.quantiles import WHOLE, Family, Value, exact_quantiles, family_of

_QUARTILES = [0.25, 0.5, 0.75]
_STATISTICS = {"count": "count", "mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
_NUMBERS = (*WHOLE, T.DecimalType, T.FloatType, T.DoubleType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def _of_type(df: DataFrame, kinds: tuple) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def _deviation(name: str, family: Family, median: Value | None) -> tuple[str, str]:
    """A column as double, less a number near its median, and that number (SQL).

    Whole numbers beyond 2^53 and decimals are moved near zero before they become doubles, which
    then hold them and their squares; other columns stay as they are.
    """
    plain = f"CAST({quoted(name)} AS DOUBLE)", "0D"
    if median is None or family.kind == "double":
        return plain
    centre = int(float(int(median)))  # exact as a double
    if family.kind == "whole" and abs(centre) < 2**52:
        return plain
    exact = f"CAST({quoted(name)} AS DECIMAL(38,{family.scale}))"
    moved = f"CAST(try_subtract({exact}, CAST('{centre}' AS DECIMAL(38,0))) AS DOUBLE)"
    if family.kind == "decimal":  # differences of 38 digits don't fit
        moved = f"coalesce({moved}, CAST({exact} AS DOUBLE) - {number(float(centre))})"
    return moved, number(float(centre))


def describe(df: DataFrame) -> DataFrame:
    """A row per numeric column: count, mean, sample deviation, range and exact quartiles.

    Values have 2 decimals. Quartiles of whole numbers and decimals are exact before they are shown,
    and their mean and deviation are taken of distances from the median.
    """
    names = _of_type(df, _NUMBERS)
    quartiles = exact_quantiles(df, names, _QUARTILES)
    df = normalise(df)
    aggregates, entries = row_count(), []
    for i, name in enumerate(names):
        value, place = f"CAST({quoted(name)} AS DOUBLE)", df.columns.index(name)
        moved, centre = _deviation(name, family_of(df, name), quartiles[name][1])
        for key, function in _STATISTICS.items():
            measured = moved if key in ("mean", "std") else value
            aggregates[f"{key}_{i}"] = (place, F.expr(f"{function}({measured})"))
        statistics = {"mean": f"(mean_{i} + {centre})"} | {k: f"{k}_{i}" for k in ("std", "min", "max")}
        found = [None if q is None else float(q) for q in quartiles[name]]
        statistics |= {k: number(q) for k, q in zip(("p25", "p50", "p75"), found, strict=True)}
        entries.append(
            {"column_name": literal(name), "count": f"count_{i}"}
            | {k: rounded_scaled(s, 2) for k, s in statistics.items()}
        )
    rows = to_rows(
        measure(df, aggregates),
        entries,
        "column_name string, count bigint, mean double, std double, min double, max double, "
        "p25 double, p50 double, p75 double",
    )
    return rows.select(
        "ordinal", "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def _micros(name: str, data_type: T.DataType) -> Column:
    """Microseconds since 1970, in UTC for a timestamp and by the clock for one without zone."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column(name))
    # By way of an interval: `timestampdiff` would pass through the zone of the session.
    seconds = f"CAST({quoted(name)} - timestamp_ntz'1970-01-01' AS INTERVAL SECOND)"
    return F.expr(f"CAST(CAST({seconds} AS DECIMAL(20,6)) * 1000000 AS BIGINT)")


def describe_timestamps(df: DataFrame) -> DataFrame:
    """A row per timestamp column: count, mean, range and exact quartiles.

    Mean and quartiles are cut to whole microseconds. A timestamp has no deviation. Zoned
    timestamps are shown in UTC.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    names = _of_type(df, _TIMES)
    micros = df.select(*[_micros(n, types[n]).alias(n) for n in names])
    quartiles = exact_quantiles(micros, names, _QUARTILES)
    aggregates, entries = row_count(), []
    for i, name in enumerate(names):
        value = quoted(name)
        aggregates |= {
            f"count_{i}": (i, F.expr(f"count({value})")),
            # Summed exactly: a double cannot hold such sums to the microsecond.
            f"sum_{i}": (i, F.expr(f"sum(CAST({value} AS DECIMAL(20,0)))")),
            f"min_{i}": (i, F.expr(f"min({value})")),
            f"max_{i}": (i, F.expr(f"max({value})")),
        }
        rows = f"nullif(count_{i}, 0)"
        statistics = {
            "mean": f"(sum_{i} - pmod(sum_{i}, {rows})) / {rows}",
            "min": f"min_{i}",
            "max": f"max_{i}",
        }
        for key, quartile in zip(("p25", "p50", "p75"), quartiles[name]):
            statistics[key] = "NULL" if quartile is None else str(math.floor(quartile))
        entries.append(
            {"column_name": literal(name), "count": f"count_{i}"}
            | {k: _moment(s) for k, s in statistics.items()}
        )
    times = ", ".join(f"{k} timestamp_ntz" for k in ("mean", "min", "max", "p25", "p50", "p75"))
    schema = f"column_name string, count bigint, {times}"
    rows = to_rows(measure(micros, aggregates), entries, schema)
    return rows.select(
        "ordinal", "column_name", "count", "mean", "min", "p25", "p50", "p75", "max"
    )


def _moment(micros: str) -> str:
    seconds = f"CAST({micros} AS DECIMAL(20,0)) / 1000000"
    return f"timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, {seconds})"


def _shown(df: DataFrame, name: str) -> str:
    """-0.0 counts as 0.0, which it equals; as text they differ."""
    kind = df.schema[name].dataType.simpleString()
    return f"{quoted(name)} + CAST(0 AS {kind})" if kind in ("float", "double") else quoted(name)


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per column and value, missing values included, most frequent first.

    Columns that do not exist are left out. All columns are counted in one scan, so values are
    shown as text.
    """
    df = normalise(df)
    present = [c for c in columns if c in df.columns]
    if not present:
        schema = "column_name string, value string, count bigint"
        return df.sparkSession.createDataFrame([], schema)
    entries = ", ".join(
        f"{i}, {literal(c)}, CAST({_shown(df, c)} AS STRING)" for i, c in enumerate(present)
    )
    return (
        df.selectExpr(f"stack({len(present)}, {entries}) AS (ordinal, column_name, value)")
        .groupBy("ordinal", "column_name", "value")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("ordinal", F.desc("count"), F.asc_nulls_last("value"))
        .select("column_name", "value", "count")
    )
