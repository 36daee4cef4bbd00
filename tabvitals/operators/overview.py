"""Dataset overview: shape, types, logical size, first rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabvitals.functions.numeric import column, normalise, quoted, round_columns
from tabvitals.functions.text import literal
from tabvitals.operators.measure import ROWS, Aggregates, measure, row_count, to_rows

_WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DayTimeIntervalType: 8,
    T.YearMonthIntervalType: 4,
}


def _fixed_width(data_type: T.DataType) -> int | None:
    if isinstance(data_type, T.DecimalType):
        return 8 if data_type.precision <= 18 else 16
    return _WIDTHS.get(type(data_type))


def value_bytes(value: Column, data_type: T.DataType) -> Column:
    """Logical bytes of one value as bigint; NULL takes none."""
    width = _fixed_width(data_type)
    if width is not None:
        size = F.lit(width).cast("bigint")
        return F.when(value.isNotNull(), size).otherwise(F.lit(0).cast("bigint"))
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        size = F.octet_length(value).cast("bigint")
    elif isinstance(data_type, T.ArrayType):
        element = _fixed_width(data_type.elementType)
        if element is not None:
            size = F.size(value).cast("bigint") * element
        else:
            size = F.aggregate(
                value,
                F.lit(0).cast("bigint"),
                lambda total, item: total + value_bytes(item, data_type.elementType),
            )
    elif isinstance(data_type, T.StructType):
        size = sum(
            (value_bytes(value[f.name], f.dataType) for f in data_type.fields),
            F.lit(0).cast("bigint"),
        )
    elif isinstance(data_type, T.MapType):
        size = value_bytes(F.map_keys(value), T.ArrayType(data_type.keyType)) + value_bytes(
            F.map_values(value), T.ArrayType(data_type.valueType)
        )
    else:
        size = F.octet_length(value.cast("string")).cast("bigint")
    return F.when(value.isNotNull(), size).otherwise(F.lit(0).cast("bigint"))


def column_bytes(name: str, data_type: T.DataType) -> Column:
    """Aggregate: logical bytes of a column. Fixed-width types need no look at the values."""
    width = _fixed_width(data_type)
    if width is not None:
        return F.expr(f"count({quoted(name)}) * {width}")
    return F.coalesce(F.sum(value_bytes(column(name), data_type)), F.lit(0).cast("bigint"))


def size_aggregates(df: DataFrame) -> Aggregates:
    return {
        f"bytes_{i}": (i, column_bytes(f.name, f.dataType))
        for i, f in enumerate(df.schema.fields)
    }


def run_time(given: Column | None) -> Column:
    """The given time of a run, or now."""
    return F.current_timestamp() if given is None else given.cast("timestamp")


def names(columns: list[str]) -> Column:
    """An array of column names."""
    return F.expr(f"CAST(array({', '.join(literal(c) for c in columns)}) AS ARRAY<STRING>)")


def overview_rows(
    measured: DataFrame, df: DataFrame, dataset_name: str, profiled_at: Column | None = None
) -> DataFrame:
    total_bytes = F.expr(" + ".join(["0L", *[f"bytes_{i}" for i in range(len(df.columns))]]))
    row = measured.select(
        F.lit(dataset_name).alias("dataset_name"),
        run_time(profiled_at).alias("profiled_at"),
        F.col(ROWS).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        names(df.columns).alias("columns"),
        (total_bytes / 1024 / 1024).alias("size_mb"),
    )
    return round_columns(row, {"size_mb": 2})


def overview(
    df: DataFrame, dataset_name: str = "dataset", profiled_at: Column | None = None
) -> DataFrame:
    """One row: name, time, row and column counts, column names, logical size in MB."""
    df = normalise(df)
    measured = measure(df, row_count() | size_aggregates(df))
    return overview_rows(measured, df, dataset_name, profiled_at)


def column_type_rows(measured: DataFrame, df: DataFrame) -> DataFrame:
    entries = [
        {
            "column_name": literal(name),
            "data_type": literal(data_type),
            "logical_bytes": f"bytes_{i}",
        }
        for i, (name, data_type) in enumerate(df.dtypes)
    ]
    return to_rows(measured, entries, "column_name string, data_type string, logical_bytes bigint")


def column_types(df: DataFrame) -> DataFrame:
    """A row per column: position, name, type and logical bytes held."""
    df = normalise(df)
    return column_type_rows(measure(df, size_aggregates(df)), df)


def numeric_columns(df: DataFrame) -> list[str]:
    """The columns that outlier checks pick by themselves: int, bigint, decimal and double."""
    wanted = (T.IntegerType, T.LongType, T.DecimalType, T.DoubleType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def first_rows(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """A preview of `n` rows; with `order_by` it is the same rows every time."""
    if order_by:
        df = df.orderBy(*[column(c) for c in order_by])
    return df.limit(n)
