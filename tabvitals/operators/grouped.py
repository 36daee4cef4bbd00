"""Quartiles and fences by group, with any number of groups and no group in one task.

The steps are those of `quantiles`, but what they find stays a table with a row per group: sketches
by group give brackets, rows meet the brackets of their group, and values inside one are counted.
Groups may be few and huge or many and small. A sketch is no larger than its group, and a group's
rows are aggregated where they are before they are shuffled; values of a group that reach one task
are those inside its brackets, at most `4 * ERROR` of its rows for each quartile.

Values are compared as doubles.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabvitals.functions.numeric import quoted
from tabvitals.operators.measure import group_name
from tabvitals.operators.quantiles import ERROR, sketches
from tabvitals.sources.scratch import written

_QUARTERS = (1, 3)
_ENDS = ("low1", "high1", "low3", "high3")
#: The least and greatest rank that a quartile lies between, from 0.
_RANKS = {
    f"{side}{q}": f"{f}((total - 1) * {q / 4}D)"
    for q in _QUARTERS
    for side, f in (("below", "floor"), ("above", "ceil"))
}


def _joined(rows: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """Rows beside the row of their group; a missing value is a group like others."""
    renamed = groups.withColumnsRenamed({group_name(i): f"of {i}" for i in range(n)})
    same = [F.col(f"`{group_name(i)}`").eqNullSafe(F.col(f"`of {i}`")) for i in range(n)]
    return rows.join(renamed, same).drop(*[f"of {i}" for i in range(n)])


def _values(df: DataFrame, columns: list[str], by: Sequence[str]) -> DataFrame:
    groups = [f"{quoted(c)} AS {quoted(group_name(i))}" for i, c in enumerate(by)]
    values = [f"nanvl(CAST({quoted(c)} AS DOUBLE), NULL) AS v{i}" for i, c in enumerate(columns)]
    return df.selectExpr(*groups, *values)


def _brackets(values: DataFrame, keys: list[str], n: int) -> DataFrame:
    """A row per group: the ends of its brackets, `low1_0` and so on; null without values."""
    ends = [min(1.0, max(0.0, q / 4 + d)) for q in _QUARTERS for d in (-2 * ERROR, 2 * ERROR)]
    listed = ", ".join(f"{e!r}D" for e in ends)
    made = sketches(values, [f"v{i}" for i in range(n)], keys)
    found = [
        f"CASE WHEN kll_sketch_get_n_double(s{i}) > 0 "
        f"THEN kll_sketch_get_quantile_double(s{i}, array({listed})) END AS e{i}"
        for i in range(n)
    ]
    names = [quoted(k) for k in keys]
    flat = [f"e{i}[{k}] AS {name}_{i}" for i in range(n) for k, name in enumerate(_ENDS)]
    return made.selectExpr(*names, *found).selectExpr(*names, *flat)


def _neighbours(values: DataFrame, brackets: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Written, per group and slot: rows with a value and the neighbours of both quartiles.

    A neighbour outside of its bracket is null.
    """
    entries = ", ".join(f"{i}, v{i}, {', '.join(f'{e}_{i}' for e in _ENDS)}" for i in range(n))
    names = [quoted(k) for k in keys]
    unfolded = _joined(values, brackets, len(keys)).selectExpr(
        *names, f"stack({n}, {entries}) AS (slot, value, {', '.join(_ENDS)})"
    )
    region = (
        "CASE WHEN value < low1 THEN 0 WHEN value <= high1 THEN 1 "
        "WHEN value < low3 THEN 2 WHEN value <= high3 THEN 3 ELSE 4 END AS region"
    )
    counted = (
        unfolded.where("value IS NOT NULL AND low1 IS NOT NULL")
        .selectExpr(*names, "slot", "value", region)
        .selectExpr(*names, "slot", "region", "IF(region % 2 = 1, value, NULL) AS value")
        .groupBy(*keys, "slot", "region", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    part = f"PARTITION BY {', '.join(names)}, slot"
    ordered = counted.selectExpr(
        "*",
        f"sum(rows) OVER ({part} ORDER BY region, value) - rows AS before",
        f"sum(rows) OVER ({part}) AS total",
    )
    held = [
        F.expr(f"max(CASE WHEN before <= {r} AND {r} < before + rows THEN value END) AS {name}")
        for name, r in _RANKS.items()
    ]
    return written(ordered.groupBy(*keys, "slot").agg(F.max("total").alias("total"), *held), "ranks")


def _quartile(q: int) -> str:
    """Between its neighbours, from the nearer end, as for whole tables."""
    low, high, at = f"below{q}", f"above{q}", f"((total - 1) * {q / 4}D)"
    part = f"({at} - floor({at}))"
    return (
        f"CASE WHEN {low} = {high} THEN {low} WHEN {part} >= 0.5D "
        f"THEN {high} - ({high} - {low}) * (1D - {part}) ELSE {low} + ({high} - {low}) * {part} END"
    )


def fences_by(df: DataFrame, columns: list[str], by: Sequence[str], factor: float) -> DataFrame:
    """A row per group: `q1_0`, `q3_0`, `iqr_0`, `lower_fence_0`, `upper_fence_0` and so on.

    The numbers at the end are the places of the columns. All are null for a column that has no
    values in a group.
    """
    n, keys = len(columns), [group_name(i) for i in range(len(by))]
    values = _values(df, columns, by)
    # Written, brackets have a known size: while they are small they are broadcast, and no group's
    # rows meet in one task. Planned over the sketches, they count as large as those.
    brackets = written(_brackets(values, keys, n), "brackets")
    found = _neighbours(values, brackets, keys, n)
    missed = found.where(" OR ".join(f"{name} IS NULL" for name in _RANKS))
    if missed.limit(1).count():  # a sketch was off by more than its brackets allow for
        ends = {e: "-Infinity" if e.startswith("low") else "Infinity" for e in _ENDS}
        all_numbers = [
            F.expr(f"max(IF(slot = {i}, CAST('{end}' AS DOUBLE), NULL)) AS {e}_{i}")
            for i in range(n)
            for e, end in ends.items()
        ]
        again = _neighbours(values, missed.groupBy(*keys).agg(*all_numbers), keys, n)
        right = found.where(" AND ".join(f"{name} IS NOT NULL" for name in _RANKS))
        found = right.unionByName(again)
    quartiles = found.selectExpr(
        *map(quoted, keys), "slot", f"{_quartile(1)} AS q1", f"{_quartile(3)} AS q3"
    ).selectExpr("*", "nanvl(q3 - q1, NULL) AS iqr")
    limits = quartiles.selectExpr(
        "*",
        f"nanvl(q1 - {factor}D * iqr, NULL) AS lower_fence",
        f"nanvl(q3 + {factor}D * iqr, NULL) AS upper_fence",
    )
    shown = ("q1", "q3", "iqr", "lower_fence", "upper_fence")
    wide = [F.expr(f"max(IF(slot = {i}, {s}, NULL)) AS {s}_{i}") for i in range(n) for s in shown]
    return limits.groupBy(*keys).agg(*wide)


def measured_by(
    df: DataFrame, columns: list[str], by: Sequence[str], factor: float
) -> DataFrame:
    """A row per group: fences as in `fences_by`, and counts `low_0`, `high_0`, `valid_0`, and
    `min_0` and `max_0`."""
    n, keys = len(columns), [group_name(i) for i in range(len(by))]
    limits = fences_by(df, columns, by, factor)
    rows = _joined(_values(df, columns, by), limits, len(keys))
    per_column = [
        {
            f"low_{i}": f"count_if(v{i} < lower_fence_{i})",
            f"high_{i}": f"count_if(v{i} > upper_fence_{i})",
            f"valid_{i}": f"count(v{i})",
            f"min_{i}": f"min(v{i})",
            f"max_{i}": f"max(v{i})",
        }
        for i in range(n)
    ]
    aggregates = reduce(lambda a, b: a | b, per_column)
    counts = rows.groupBy(*keys).agg(*[F.expr(e).alias(k) for k, e in aggregates.items()])
    return _joined(counts, limits, len(keys))
