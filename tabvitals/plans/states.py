"""States of profiles that merge: a table that grows is not scanned again, only its new part is.

What a profile counts (missing values, bytes, violations of rules and expectations) adds up over
parts of a table, and so do moments, ranges and quantile sketches of its numbers. `save_state` scans
one part, such as a day, and writes what it measured, a row; saving a part again replaces it.
`merged_state` adds the rows of all parts up, in a job over as many rows as there are parts, and
gives the sections of the profile of the whole table. Those of counts are the same as of a scan of
everything; quantiles are the sketches'. Repeated rows and outlier counts are not mergeable.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabvitals.functions.numeric import column, normalise, quoted, rounded_scaled
from tabvitals.functions.text import literal
from tabvitals.operators.expectations import (
    Expectation,
    expectation_aggregates,
    validation_rows,
)
from tabvitals.operators.measure import (
    Aggregates,
    materialise,
    measure,
    merge_rows,
    row_count,
    to_rows,
)
from tabvitals.operators.nulls import null_aggregates, null_rows
from tabvitals.operators.overview import (
    column_type_rows,
    numeric_columns,
    overview_rows,
    size_aggregates,
)
from tabvitals.operators.quantiles import sketches
from tabvitals.operators.rules import Rule, applicable, rule_aggregates, rule_rows

_QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


@dataclass(frozen=True)
class MergedState:
    """The state of all parts of a table, in one row, and the sections of its profile."""

    measured: DataFrame
    empty: DataFrame  # of the table's columns
    rules: Sequence[Rule]
    suite: Sequence[Expectation]

    def overview(self, dataset: str, profiled_at: Column | None = None) -> DataFrame:
        return overview_rows(self.measured, self.empty, dataset, profiled_at)

    def column_types(self) -> DataFrame:
        return column_type_rows(self.measured, self.empty)

    def null_profile(self) -> DataFrame:
        return null_rows(self.measured, self.empty)

    def rule_profile(self) -> DataFrame:
        return rule_rows(self.measured, applicable(self.empty, self.rules))

    def validate(self) -> DataFrame:
        return validation_rows(self.measured, self.empty, self.suite)

    def describe(self) -> DataFrame:
        """A row per int, bigint, decimal and double column, as `describe`, with quartiles of the
        sketches: values of the column whose rank is off by some thousandths at most."""
        entries = []
        for i, name in enumerate(numeric_columns(self.empty)):
            shares = ", ".join(f"{p}D" for p in _QUARTILES.values())
            found = f"kll_sketch_get_quantile_double(sketch_{i}, array({shares}))"
            entries.append(
                {"column_name": literal(name), "count": f"valid_{i}"}
                | {k: f"IF(valid_{i} > 0, {k}_{i}, NULL)" for k in ("mean", "min", "max")}
                | {"std": f"IF(valid_{i} > 1, sqrt(spread_{i} / (valid_{i} - 1)), NULL)"}
                | {q: f"IF(valid_{i} > 0, {found}[{k}], NULL)" for k, q in enumerate(_QUARTILES)}
            )
        figures = ("mean", "std", "min", *_QUARTILES, "max")
        schema = "column_name string, count bigint, " + ", ".join(f"{f} double" for f in figures)
        rows = to_rows(self.measured, entries, schema)
        shown = [f"{rounded_scaled(f, 2)} AS {f}" for f in figures]
        return rows.selectExpr("ordinal", "column_name", "count", *shown)


def _counts(df: DataFrame, rules: Sequence[Rule], suite: Sequence[Expectation]) -> Aggregates:
    """What adds up over parts."""
    return (
        row_count()
        | null_aggregates(df)
        | size_aggregates(df)
        | rule_aggregates(df, rules)
        | expectation_aggregates(df, suite)
    )


def _moments(df: DataFrame) -> Aggregates:
    """Per numeric column: count, mean, sum of squared distances from it, and range."""
    result = {}
    for i, name in enumerate(numeric_columns(df)):
        value, place = f"CAST({quoted(name)} AS DOUBLE)", df.columns.index(name)
        aggregates = {
            "valid": f"count({value})",
            "mean": f"coalesce(avg({value}), 0D)",
            "spread": f"coalesce(var_pop({value}) * count({value}), 0D)",
            "min": f"min({value})",
            "max": f"max({value})",
        }
        result |= {f"{k}_{i}": (place, F.expr(a)) for k, a in aggregates.items()}
    return result


def _merged(df: DataFrame, rules: Sequence[Rule], suite: Sequence[Expectation]) -> list[Column]:
    """The aggregates that merge the columns of states. Means and spreads are merged about the
    mean of all, so nothing is lost to the size of the values."""
    result = [F.expr(f"sum({n})").cast("bigint").alias(n) for n in _counts(df, rules, suite)]
    for i in range(len(numeric_columns(df))):
        n, mean = f"valid_{i}", f"mean_{i}"
        squares = f"sum(spread_{i} + {n} * power({mean} - whole_mean_{i}, 2))"
        aggregates = {
            n: f"sum({n})",
            mean: f"first(whole_mean_{i})",
            f"spread_{i}": squares,
            f"min_{i}": f"min(min_{i})",
            f"max_{i}": f"max(max_{i})",
            f"sketch_{i}": f"kll_merge_agg_double(sketch_{i})",
        }
        result += [F.expr(a).alias(k) for k, a in aggregates.items()]
    return result


def save_state(
    df: DataFrame,
    dataset: str,
    part: str,
    path: str,
    rules: Sequence[Rule] = (),
    suite: Sequence[Expectation] = (),
) -> None:
    """Scan a part of a table and write its state below `path`, in place of an earlier one."""
    clean = normalise(df)
    parts = [measure(clean, _counts(clean, applicable(clean, rules), suite) | _moments(clean))]
    if numeric := numeric_columns(clean):
        made = sketches(clean.select(*[column(c) for c in numeric]), numeric, [])
        names = {f"s{i}": f"sketch_{i}" for i in range(len(numeric))}
        parts.append(made.withColumnsRenamed(names))
    row = merge_rows(parts).withColumn("columns", F.lit(json.dumps(clean.schema.jsonValue())))
    row = row.withColumn("dataset", F.lit(dataset)).withColumn("part", F.lit(part))
    (
        row.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset", "part")
        .parquet(path)
    )


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def merged_state(
    spark: SparkSession,
    dataset: str,
    path: str,
    rules: Sequence[Rule] = (),
    suite: Sequence[Expectation] = (),
) -> MergedState:
    """The state of all saved parts of a table, with the rules and the suite they were saved with.

    Fails if there is no part, or if parts have different columns.
    """
    folder = f"{path.rstrip('/')}/dataset={dataset}"
    states = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(folder)
    schemas = [
        T.StructType.fromJson(json.loads(r["columns"]))
        for r in states.select("columns").distinct().limit(2).collect()
    ]
    if len({str(_shape(s)) for s in schemas}) != 1:
        raise ValueError(f"parts of {dataset} have different columns")
    empty = spark.createDataFrame([], schemas[0])
    fitting = applicable(empty, rules)
    totals = [
        F.expr(f"sum(valid_{i} * mean_{i}) / nullif(sum(valid_{i}), 0)").alias(f"whole_mean_{i}")
        for i in range(len(numeric_columns(empty)))
    ]
    if totals:
        means = states.agg(*totals).first().asDict()
        states = states.withColumns({k: F.lit(m).cast("double") for k, m in means.items()})
    measured = materialise(states.agg(*_merged(empty, fitting, suite)))
    return MergedState(measured, empty, rules, suite)
