"""Duplicate rows: repeats after the first occurrence, over all columns and over key columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabvitals.functions.grading import KEY_DUPLICATE_LIMIT
from tabvitals.functions.numeric import column, normalise, percent, round_columns
from tabvitals.operators.measure import ROWS
from tabvitals.operators.overview import names


def count_repeats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row (repeats, rows) of grouping by `columns`, where NULL equals NULL.

    The grouping collapses copies before the shuffle, so a row copied a billion times reaches
    the exchange once per task.
    """
    return (
        _comparable(df.select(*[column(c) for c in columns]))
        .groupBy(*[column(c) for c in columns])
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("repeats"),
            F.coalesce(F.sum("copies"), F.lit(0)).alias(ROWS),
        )
    )


def _comparable(df: DataFrame) -> DataFrame:
    """VARIANT cannot be grouped by; its text can."""
    return df.select(
        *[
            column(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, T.VariantType)
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def _canonical(value: Column, data_type: T.DataType) -> Column:
    """A struct whose hash tells apart what grouping tells apart.

    Hashes skip missing values and the ends of lists, so both are marked. Maps become lists of
    entries in the order of their keys. -0.0 and NaN hash as grouping compares them.
    """
    missing = value.isNull().alias("missing")
    if isinstance(data_type, T.StructType):
        parts = [_canonical(value[f.name], f.dataType) for f in data_type.fields]
        return F.struct(missing, *[p.alias(f"f{i}") for i, p in enumerate(parts)])
    if isinstance(data_type, T.ArrayType):
        items = F.transform(value, lambda x: _canonical(x, data_type.elementType))
        return F.struct(missing, F.size(value).alias("size"), items.alias("items"))
    if isinstance(data_type, T.MapType):
        keys = F.array_sort(F.map_keys(value))

        def entry(key: Column) -> Column:
            return F.struct(
                _canonical(key, data_type.keyType).alias("key"),
                _canonical(value[key], data_type.valueType).alias("value"),
            )

        return F.struct(
            missing, F.size(value).alias("size"), F.transform(keys, entry).alias("items")
        )
    if isinstance(data_type, T.VariantType):
        value = value.cast("string")
    return F.struct(missing, value.alias("value"))


def _digest(df: DataFrame, columns: list[str], name: str) -> list[Column]:
    """128 bits of the columns: two hashes with seeds of their own, equal for equal values."""
    values = [_canonical(column(c), df.schema[c].dataType) for c in columns]
    return [F.xxhash64(F.lit(seed), *values).alias(f"{name}{seed}") for seed in (1, 2)]


def _key_repeats(df: DataFrame, key_columns: list[str]) -> DataFrame:
    """One row (repeats, rows) by the key columns that exist; without any, nothing repeats."""
    present = [c for c in key_columns if c in df.columns]
    if present:
        return count_repeats(df, present)
    return df.agg(F.lit(0).cast("bigint").alias("repeats"), F.count(F.lit(1)).alias(ROWS))


def duplicate_measures(df: DataFrame, key_columns: list[str]) -> DataFrame:
    """One row: full_repeats and key_repeats of a normalised table, and its row count.

    One scan and one exchange for both. Each row gives two digests of 128 bits, of all its columns
    and of its key, which are counted together; so it takes two entries of some 30 bytes, whatever
    its width. Copies collapse before the exchange: a row or key that fills a third of the table is
    an entry per task. Among 10 ** 13 rows, the probability that any two different ones have the
    same digest is below 10 ** -12.
    """
    present = [c for c in key_columns if c in df.columns]
    digests = [*_digest(df, df.columns, "row"), *(_digest(df, present, "key") if present else [])]
    entries = ["true, row1, row2", *(["false, key1, key2"] if present else [])]
    counted = (
        df.select(*digests)
        .selectExpr(f"stack({len(entries)}, {', '.join(entries)}) AS (is_row, first, second)")
        .groupBy("is_row", "first", "second")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return counted.agg(
        F.expr("coalesce(sum(IF(is_row, copies - 1, 0L)), 0L)").alias("full_repeats"),
        F.expr("coalesce(sum(IF(is_row, 0L, copies - 1)), 0L)").alias("key_repeats"),
        F.expr("coalesce(sum(IF(is_row, copies, 0L)), 0L)").alias(ROWS),
    )


def duplicate_rows(measured: DataFrame, df: DataFrame, key_columns: list[str]) -> DataFrame:
    present = [c for c in key_columns if c in df.columns]
    shares = measured.select(
        F.col("full_repeats").alias("full_duplicates"),
        percent("full_repeats", ROWS).alias("full_duplicate_pct"),
        F.col("key_repeats").alias("key_column_dupes"),
        percent("key_repeats", ROWS).alias("key_dupe_pct"),
        names(present).alias("key_columns_checked"),
    )
    return round_columns(shares, {"full_duplicate_pct": 2, "key_dupe_pct": 2}).withColumn(
        "severity",
        F.when(F.col("full_duplicate_pct").isNull(), None)
        .when(F.col("full_duplicates") > 0, "critical")
        .when(F.col("key_column_dupes") == 0, "ok")
        .when(F.col("key_dupe_pct") < KEY_DUPLICATE_LIMIT, "warning")
        .otherwise("critical"),
    )


def duplicate_profile(df: DataFrame, key_columns: list[str]) -> DataFrame:
    """One row: repeated full rows, repeated keys (on the key columns that exist), severity."""
    df = normalise(df)
    return duplicate_rows(duplicate_measures(df, key_columns), df, key_columns)


def key_duplicates(df: DataFrame, key_columns: list[str]) -> DataFrame:
    """One row: rows whose key occurred before, and their share of all rows.

    Key columns that do not exist are left out; without any, no row counts as repeated.
    """
    repeats = _key_repeats(normalise(df), key_columns)
    shares = repeats.select(
        F.col("repeats").alias("key_column_dupes"), percent("repeats", ROWS).alias("key_dupe_pct")
    )
    return round_columns(shares, {"key_dupe_pct": 2})
