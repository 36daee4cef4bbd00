"""The shared scan: many named aggregates of one table, computed together into one row."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabvitals.functions.numeric import column, quoted

ROWS = "rows"

# An aggregate by name, with the position of the (first) column it reads.
Aggregates = dict[str, tuple[int, Column]]

# Above this many aggregates a table is read in slices. Wider scans still work, but their
# generated code passes the size up to which the JVM compiles methods (8000 bytes; about 110
# aggregates came to 6700), and then run several times slower.
PER_SCAN = 60


def row_count() -> Aggregates:
    return {ROWS: (0, F.count(F.lit(1)))}


def group_name(place: int) -> str:
    """The name of a grouping column beside the aggregates, whose names have no space."""
    return f"group {place}"


def measure(
    df: DataFrame, aggregates: Aggregates, per_scan: int = PER_SCAN, *, by: Sequence[str] = ()
) -> DataFrame:
    """One row with a column per named aggregate, or one row per group with `by`.

    Slices follow column order, so each reads mostly columns the others do not.
    """
    names = sorted(aggregates, key=lambda name: aggregates[name][0])
    slices = [names[i : i + per_scan] for i in range(0, len(names), per_scan)]
    groups = df.groupBy(*[column(c).alias(group_name(i)) for i, c in enumerate(by)])
    parts = [groups.agg(*[aggregates[n][1].alias(n) for n in part]) for part in slices]
    return merge_rows(parts, len(by))


def merge_rows(parts: list[DataFrame], groups: int = 0) -> DataFrame:
    """One-row frames with different columns, put side by side without a join; or rows by group."""
    if len(parts) == 1:
        return parts[0]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    keys = [group_name(i) for i in range(groups)]
    others = [n for n in stacked.columns if n not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(n).alias(n) for n in others])


def to_rows(
    measured: DataFrame, entries: list[dict[str, str]], schema: str, by: Sequence[str] = ()
) -> DataFrame:
    """Turn the measured row into one row per entry, numbered in `ordinal` from 0.

    An entry gives the SQL expression of each field. With `by`, each group's row is turned into
    such rows, which have the group's columns first.
    """
    if by:
        groups = [f"{quoted(group_name(i))} AS {quoted(c)}" for i, c in enumerate(by)]
        if not entries:
            fields = ", ".join(f"`{f.split()[0]}`: {f.split()[1]}" for f in schema.split(", "))
            nothing = f"CAST(array() AS ARRAY<STRUCT<ordinal: INT, {fields}>>)"
            return measured.selectExpr(*groups, f"inline({nothing})")
    if not entries:
        return measured.sparkSession.createDataFrame([], f"ordinal int, {schema}")
    structs = [
        f"named_struct('ordinal', {i}, " + ", ".join(f"'{n}', {e}" for n, e in entry.items()) + ")"
        for i, entry in enumerate(entries)
    ]
    rows = f"inline(array({', '.join(structs)}))"
    return measured.selectExpr(*groups, rows) if by else measured.selectExpr(rows)


def unambiguous(frame: DataFrame) -> DataFrame:
    """The frame, whose grouping columns must not be called like the other columns of a result."""
    repeated = {c for c in frame.columns if frame.columns.count(c) > 1}
    if repeated:
        raise ValueError(f"grouping columns are called like columns of the result: {repeated}")
    return frame


def materialise(measured: DataFrame) -> DataFrame:
    """Compute a one-row frame once and hold its row, whose width follows the checks.

    The row becomes literals in one partition: what is derived from them is folded while planning,
    and takes one task, not one per core.
    """
    values = zip(measured.first(), measured.schema.fields, strict=True)
    literals = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in values]
    return measured.sparkSession.range(0, 1, 1, 1).select(*literals)
