"""Exact quantiles of many columns in two scans, with nothing large in one task.

Sorting, or Spark's `percentile`, ends with all distinct values of a column in one task. Here the
first scan aggregates a mergeable sketch per column. It gives a bracket around each quantile, a
little wider than the sketch may err. The second scan counts the values between brackets, and each
value inside one. As counts are exact, so are the order statistics found among them; should one
lie outside its bracket after all, the bracket is widened and the scan is done again.

Values are compared as what they are: doubles, whole numbers, or decimals of one scale. Only the
sketch sees whole numbers and decimals as doubles, and brackets are widened by that error too.

Both scans read only the columns asked for and shuffle only sketches and counts. Brackets with more
values than a task should order are written to a shared folder and narrowed down there: cut into
`_BINS` ranges, of which those that hold a wanted rank are cut again, until values can be ordered.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from decimal import ROUND_CEILING, ROUND_FLOOR, Context, Decimal
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from tabvitals.functions.numeric import column, number, quoted
from tabvitals.functions.text import literal
from tabvitals.sources.scratch import written

Exact = float | int | Decimal  # an order statistic, in its column's own kind
Value = float | Fraction  # a quantile

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# The sketch keeps some 3 * K values. At most one in a hundred is off by more than this share of
# the rows, and brackets reach twice as far.
_K = 16_384
ERROR = 2.296 / _K**0.9021
_BINS = 65_536
_SHARE = f"least(floor(way / length * {_BINS}), {_BINS - 1}D)"
# The ends of a range have bins of their own, so that every cut takes values away.
_BIN = "CASE WHEN by_value THEN 0D WHEN value = low THEN -1D WHEN value = high THEN 1e9D ELSE {} END"
# Columns of one job: their entries in the second scan keep the generated code small enough for
# the JVM to compile (8000 bytes).
_COLUMNS_PER_JOB = 12
_JOBS = 4
_MERGERS = 256
_DIGITS = Context(prec=1000)


@dataclass(frozen=True)
class Family:
    """Columns whose values are compared with each other's kind: how SQL and Python write them."""

    kind: str  # double, whole or decimal
    scale: int = 0

    @classmethod
    def of(cls, data_type: T.DataType) -> Family:
        if isinstance(data_type, T.DecimalType):
            return cls("decimal", data_type.scale)
        return cls("whole" if isinstance(data_type, WHOLE) else "double")

    @property
    def sql_type(self) -> str:
        return {"double": "DOUBLE", "whole": "BIGINT"}.get(self.kind, f"DECIMAL(38,{self.scale})")

    def values(self, column: str) -> str:
        """The values of a column, without NaN."""
        cast = f"CAST({column} AS {self.sql_type})"
        return f"nanvl({cast}, NULL)" if self.kind == "double" else cast

    def literal(self, value: Exact) -> str:
        return number(value) if self.kind == "double" else f"CAST('{value}' AS {self.sql_type})"

    def distance(self, column: str) -> str:
        """How far a column is above `low`, as a double, or half of that in ranges too wide for it.

        Whole numbers and decimals are subtracted before they are rounded, where that is possible.
        """
        if self.kind == "double":
            return f"IF(high - low = double('inf'), {column} / 2 - low / 2, {column} - low)"
        exact, low, high = (f"CAST({c} AS DECIMAL(38,{self.scale}))" for c in (column, "low", "high"))
        return (
            f"IF(try_subtract({high}, {low}) IS NULL, CAST({column} AS DOUBLE) - CAST(low AS DOUBLE), "
            f"CAST(try_subtract({exact}, {low}) AS DOUBLE))"
        )

    def _limit(self, sign: int) -> Exact:
        if self.kind == "whole":
            return 2**63 - 1 if sign > 0 else -(2**63)
        return Decimal(sign * (10**38 - 1)).scaleb(-self.scale, _DIGITS)

    def outward(self, value: float, sign: int) -> Exact:
        """A value of this kind that no value the sketch took for `value` lies beyond."""
        beyond = math.nextafter(value, sign * math.inf)
        if self.kind == "double":
            return beyond
        if math.isinf(beyond):
            return self._limit(sign)
        rounding = ROUND_CEILING if sign > 0 else ROUND_FLOOR
        step = Decimal(1).scaleb(-self.scale)
        exact = Decimal(beyond).quantize(step, rounding, context=_DIGITS)
        limit = self._limit(sign)
        exact = min(exact, limit) if sign > 0 else max(exact, limit)
        return int(exact) if self.kind == "whole" else exact

    def within(self, limit: Value, sign: int) -> Exact | None:
        """The value of this kind nearest to the limit, not above it (sign > 0) or not below it.

        None if all values of this kind are on the other side.
        """
        if self.kind == "double":
            return float(limit)
        scaled = Fraction(limit) * 10**self.scale
        whole = math.floor(scaled) if sign > 0 else math.ceil(scaled)
        exact = Decimal(whole).scaleb(-self.scale, _DIGITS)
        low, high = self._limit(-1), self._limit(1)
        if exact < low and sign > 0 or exact > high and sign < 0:
            return None
        exact = min(max(exact, low), high)
        return int(exact) if self.kind == "whole" else exact


def family_of(df: DataFrame, column: str) -> Family:
    return Family.of(df.schema[column].dataType)


@dataclass(frozen=True)
class Quantile:
    """A quantile between two neighbours in the order of a column's values."""

    low: Exact
    high: Exact
    part: float  # the way from low to high

    @property
    def value(self) -> Value:
        if self.low == self.high:
            return self.low if isinstance(self.low, float) else Fraction(self.low)
        if isinstance(self.low, float):
            # From the nearer end, as pandas does: the two forms differ in the last bit.
            width = self.high - self.low
            near = self.part >= 0.5
            return self.high - width * (1 - self.part) if near else self.low + width * self.part
        low, high = Fraction(self.low), Fraction(self.high)
        return low + (high - low) * Fraction(self.part)


@dataclass
class _Column:
    """What is known of a column: rows with a value, brackets, and the order statistics found."""

    name: str
    family: Family
    rows: int
    brackets: list[tuple[Exact, Exact]]
    found: dict[int, Exact]

    def ranks(self, probabilities: list[float]) -> list[int]:
        positions = [(self.rows - 1) * p for p in probabilities] if self.rows else []
        return sorted({f(x) for x in positions for f in (math.floor, math.ceil)})

    def quantile(self, probability: float) -> Quantile | None:
        if not self.rows:
            return None
        position = (self.rows - 1) * probability
        low, high = self.found[math.floor(position)], self.found[math.ceil(position)]
        return Quantile(low, high, position - math.floor(position))


def quantiles_between(
    df: DataFrame, columns: list[str], probabilities: list[float]
) -> dict[str, tuple[int, list[Quantile | None]]]:
    """Per column: rows with a value, and its quantiles, None for a column without values.

    What reaches the driver is two order statistics per quantile, and the brackets.
    """
    families: dict[Family, list[str]] = {}
    for c in columns:
        families.setdefault(family_of(df, c), []).append(c)
    jobs = [
        (family, names[i : i + _COLUMNS_PER_JOB])
        for family, names in families.items()
        for i in range(0, len(names), _COLUMNS_PER_JOB)
    ]

    def run(job: tuple[Family, list[str]]) -> list[_Column]:
        return _of_family(df, *job, probabilities)

    # Jobs need nothing of each other, and each leaves executors idle between its scans.
    with ThreadPoolExecutor(_JOBS) as pool:
        parts = list(pool.map(inheritable_thread_target(df.sparkSession)(run), jobs))
    found = {c.name: (c.rows, [c.quantile(p) for p in probabilities]) for p in parts for c in p}
    return {c: found[c] for c in columns}


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float]
) -> dict[str, list[Value | None]]:
    """Linearly interpolated quantiles per column, None for a column without values.

    Those of whole numbers and decimals are fractions, exact at any size.
    """
    found = quantiles_between(df, columns, probabilities)
    return {c: [q.value if q else None for q in quantiles] for c, (_, quantiles) in found.items()}


def approximate_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float]
) -> dict[str, list[float | None]]:
    """Quantiles of the sketches alone: one scan, off by `ERROR` of the rows at most (99 in 100).

    Nothing is interpolated: each is a value of the column.
    """
    families = {c: family_of(df, c) for c in columns}
    values = df.selectExpr(*[f"{f.values(quoted(c))} AS {quoted(c)}" for c, f in families.items()])
    row = _sketched(values, columns, probabilities).first() if columns else []
    none = [None] * len(probabilities)
    return {c: list(row[i]["at"]) if row[i]["n"] else none for i, c in enumerate(columns)}


def sketch(value: str) -> str:
    """SQL aggregate: the mergeable sketch of a numeric expression."""
    return f"kll_sketch_agg_double(CAST({value} AS DOUBLE), {_K})"


def sketches(values: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """A row per group, or one without keys: the sketch of each column (`s0` and so on).

    Every task of the scan makes sketches of some 400 kB. They are merged in `_MERGERS` tasks
    first, so that neither one task nor that of a large group gets those of the whole table.
    """
    merger = f"pmod(spark_partition_id(), {_MERGERS}) AS merger"
    made = [F.expr(f"{sketch(quoted(c))} AS s{i}") for i, c in enumerate(columns)]
    merged = [F.expr(f"kll_merge_agg_double(s{i}) AS s{i}") for i in range(len(columns))]
    some = values.selectExpr("*", merger).groupBy(*keys, "merger").agg(*made)
    return some.groupBy(*keys).agg(*merged)


def _sketched(values: DataFrame, columns: list[str], ranks: list[float]) -> DataFrame:
    """A row with a struct per column: rows (n) and the values at the ranks (at)."""
    row = sketches(values.select(*[column(c) for c in columns]), columns, [])
    listed = ", ".join(f"{r!r}D" for r in ranks)
    structs = []
    for i in range(len(columns)):
        n = f"coalesce(kll_sketch_get_n_double(s{i}), 0L)"
        at = f"CASE WHEN {n} > 0 THEN kll_sketch_get_quantile_double(s{i}, array({listed})) END"
        structs.append(f"named_struct('n', {n}, 'at', {at}) AS c{i}")
    return row.selectExpr(*structs)


def _of_family(
    df: DataFrame, family: Family, names: list[str], probabilities: list[float]
) -> list[_Column]:
    values = df.selectExpr(*[f"{family.values(quoted(c))} AS {quoted(c)}" for c in names])
    margin, todo, done = 2 * ERROR, names, []
    while todo:
        columns = _bracketed(values, family, todo, probabilities, margin)
        share = 2 * margin * len(probabilities)
        if max(c.rows for c in columns) * min(1.0, share) <= _BINS:
            _find_in_one_job(values, columns, probabilities)
        else:
            _find_in_written(values, columns, probabilities)
        complete = [c for c in columns if c.found.keys() >= set(c.ranks(probabilities))]
        done += complete
        todo = [c.name for c in columns if c not in complete]
        margin *= 4
    return done


def _bracketed(values, family, names, probabilities, margin) -> list[_Column]:
    ends = [min(1.0, max(0.0, p + d)) for p in probabilities for d in (-margin, margin)]
    row = _sketched(values, names, ends).first()
    columns = []
    for i, name in enumerate(names):
        column = _Column(name, family, row[i]["n"], [], {})
        if column.rows:
            at = row[i]["at"]
            pairs = sorted(
                (family.outward(a, -1), family.outward(z, 1))
                for a, z in zip(at[::2], at[1::2], strict=True)
            )
            for low, high in pairs:
                if column.brackets and low <= column.brackets[-1][1]:
                    first, last = column.brackets[-1]
                    column.brackets[-1] = (first, max(last, high))
                else:
                    column.brackets.append((low, high))
        columns.append(column)
    return columns


def _counted(values: DataFrame, columns: list[_Column], width: int) -> DataFrame:
    """slot, region, value and rows: a row per region between brackets, and per value in one.

    Odd regions are brackets; values outside of them are not kept.
    """
    entries = []
    for slot, c in enumerate(columns):
        if not c.rows:
            continue
        padded = c.brackets + [c.brackets[-1]] * (width - len(c.brackets))
        ends = [c.family.literal(x) for pair in padded for x in pair]
        entries.append(", ".join([str(slot), quoted(c.name), *ends]))
    ends = [f"{side}{k}" for k in range(width) for side in ("low", "high")]
    unfolded = values.selectExpr(
        f"stack({len(entries)}, {', '.join(entries)}) AS (slot, value, {', '.join(ends)})"
    )
    cases = " ".join(
        f"WHEN value < low{k} THEN {2 * k} WHEN value <= high{k} THEN {2 * k + 1}"
        for k in range(width)
    )
    return (
        unfolded.where("value IS NOT NULL")
        .selectExpr("slot", "value", f"CASE {cases} ELSE {2 * width} END AS region")
        .selectExpr("slot", "region", "IF(region % 2 = 1, value, NULL) AS value")
        .groupBy("slot", "region", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _holding(ranks: list[int]) -> str:
    return " OR ".join(f"(below <= {r} AND {r} < below + rows)" for r in ranks)


def _find_in_one_job(values, columns, probabilities) -> None:
    """Brackets of few values are put in order where they are counted."""
    if not any(c.rows for c in columns):
        return
    ranks = [c.ranks(probabilities) for c in columns]
    wanted = " OR ".join(
        f"(slot = {slot} AND ({_holding(r)}))" for slot, r in enumerate(ranks) if r
    )
    ordered = _counted(values, columns, len(probabilities)).selectExpr(
        "*", "sum(rows) OVER (PARTITION BY slot ORDER BY region, value) - rows AS below"
    )
    for row in ordered.where("value IS NOT NULL").where(wanted).collect():
        held = [r for r in ranks[row["slot"]] if row["below"] <= r < row["below"] + row["rows"]]
        columns[row["slot"]].found |= dict.fromkeys(held, row["value"])


@dataclass(frozen=True)
class _Range:
    """Values from `low` to `high` of a slot: `rows` of them, `before` smaller ones."""

    slot: int
    low: Exact
    high: Exact
    before: int
    rows: int


def _find_in_written(values, columns, probabilities) -> None:
    """Brackets of many values: written once, then narrowed down in the written table."""
    if not any(c.rows for c in columns):
        return
    family = columns[0].family
    counted = written(_counted(values, columns, len(probabilities)), "bracket-values")
    totals = counted.groupBy("slot", "region").agg(
        F.sum("rows").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    regions = {(r["slot"], r["region"]): r for r in totals.collect()}
    ranges = []
    for slot, c in enumerate(columns):
        before = 0
        for region in range(2 * len(probabilities) + 1):
            held = regions.get((slot, region))
            if held and region % 2:
                ranges.append(_Range(slot, held["low"], held["high"], before, held["rows"]))
            before += held["rows"] if held else 0
    while ranges:
        ranges = _narrowed(counted, family, ranges, columns, probabilities)


def _narrowed(counted, family, ranges, columns, probabilities) -> list[_Range]:
    """Takes what ranges give away of the wanted order statistics; returns finer ranges."""
    wanted = {
        k: [r - g.before for r in columns[g.slot].ranks(probabilities) if g.before <= r < g.before + g.rows]
        for k, g in enumerate(ranges)
    }
    ranges_held = [k for k, ranks in wanted.items() if ranks]
    if not ranges_held:
        return []
    listed = ", ".join(
        f"struct({k}, {ranges[k].slot}, {family.literal(ranges[k].low)}, "
        f"{family.literal(ranges[k].high)}, {str(ranges[k].rows <= _BINS).lower()})"
        for k in ranges_held
    )
    spark = counted.sparkSession
    named = spark.range(1).selectExpr(f"inline(array({listed})) AS (k, of, low, high, by_value)")
    # By value, or by place between the ends.
    way, length = family.distance("value"), family.distance("high")
    bins = (
        counted.join(F.broadcast(named), F.expr("slot = of AND value BETWEEN low AND high"))
        .selectExpr("*", f"{way} AS way", f"{length} AS length")
        .selectExpr(
            "k",
            "value",
            "rows",
            "IF(by_value, value, NULL) AS single",
            f"{_BIN.format(_SHARE)} AS bin",
        )
        .groupBy("k", "bin", "single")
        .agg(F.sum("rows").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"))
        .selectExpr("*", "sum(rows) OVER (PARTITION BY k ORDER BY bin, single) - rows AS below")
    )
    held = " OR ".join(f"(k = {k} AND ({_holding(wanted[k])}))" for k in ranges_held)
    finer = []
    for row in bins.where(held).collect():
        g = ranges[row["k"]]
        if row["low"] == row["high"]:
            ranks = [g.before + r for r in wanted[row["k"]]]
            start = g.before + row["below"]
            columns[g.slot].found |= {
                r: row["low"] for r in ranks if start <= r < start + row["rows"]
            }
        else:
            finer.append(_Range(g.slot, row["low"], row["high"], g.before + row["below"], row["rows"]))
    return finer


_SCHEMA = (
    "ordinal int, column_name string, probability double, count bigint, lower_value string, "
    "upper_value string, value double"
)


def _in_full(value: Exact) -> str:
    return format(value, "f") if isinstance(value, Decimal) else str(value)


def quantile_profile(
    df: DataFrame, columns: list[str], probabilities: list[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """A row per column and probability: rows with a value, the quantile, and its two neighbours.

    `lower_value` and `upper_value` are the values of the column that the quantile lies between,
    written out in full: whole numbers and decimals of any size are told apart. `value` is
    interpolated between them and then rounded once, to the nearest double. A column without
    values has nulls; NaN counts as missing.
    """
    rows = []
    for name, (count, found) in quantiles_between(df, columns, list(probabilities)).items():
        for p, q in zip(probabilities, found, strict=True):
            ends = ["NULL"] * 2 if q is None else [literal(_in_full(v)) for v in (q.low, q.high)]
            value = number(float(q.value) if q else None)
            rows.append(
                f"struct({len(rows)}, {literal(name)}, {number(float(p))}, {count}L, "
                f"{', '.join(ends)}, {value})"
            )
    if not rows:
        return df.sparkSession.createDataFrame([], _SCHEMA)
    names = ", ".join(field.split()[0] for field in _SCHEMA.split(", "))
    return df.sparkSession.range(1).selectExpr(f"inline(array({', '.join(rows)})) AS ({names})")
