"""Column helpers shared by the operators: naming, missing values, percentages, rounding."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPLITTER = float(2**27 + 1)


def quoted(name: str) -> str:
    """A column name for use in SQL, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """The column called exactly `name`."""
    return F.col(quoted(name))


def number(x: float | None) -> str:
    """A double as SQL literal, exact to the last bit."""
    return "CAST(NULL AS DOUBLE)" if x is None else f"CAST('{x!r}' AS DOUBLE)"


def normalise(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float and double column.

    The checks treat both as missing, while Spark sorts NaN above all numbers, so this runs
    once where a table enters an operator.
    """
    return df.select(
        *[
            F.nanvl(column(f.name), F.lit(None)).alias(f.name)
            if isinstance(f.dataType, (T.FloatType, T.DoubleType))
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def round_columns(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round double columns to so many decimals, as Python's `round` does: by their exact value.

    `rint(x * 10**digits)` is wrong only where the product rounds onto a tie. There the sign of
    the product's rounding error, from an exact product in two halves, says which way to go.
    """
    scaled, final = [], {}
    for name, places in digits.items():
        x, scale = quoted(name), f"{float(10**places)}D"
        product, spread = f"`{name} scaled`", f"`{name} spread`"
        scaled += [f"{x} * {scale} AS {product}", f"{x} * {_SPLITTER}D AS {spread}"]
        high = f"({spread} - ({spread} - {x}))"
        error = f"({high} * {scale} - {product}) + ({x} - {high}) * {scale}"
        nudge = f"IF(abs({product} - rint({product})) = 0.5D, 0.25D * signum({error}), 0D)"
        rounded = f"rint({product} + {nudge}) / {scale}"
        # From 2**53 on, neighbouring doubles are further apart than the last decimal.
        final[name] = f"IF(abs({product}) < {2.0**53}D, {rounded}, {x}) AS {x}"
    columns = [final.get(c, quoted(c)) for c in df.columns]
    return df.selectExpr("*", *scaled).selectExpr(*columns)


def rounded_scaled(x: str, digits: int) -> str:
    """SQL: rounded as numpy and pandas do: scaled, rounded half to even, scaled back."""
    scale = f"{float(10**digits)}D"
    return f"rint({x} * {scale}) / {scale}"


def percent(part: str, whole: str) -> Column:
    """One column in percent of another, unrounded; NULL where that is 0."""
    return F.expr(f"`{part}` / nullif(`{whole}`, 0) * 100")
