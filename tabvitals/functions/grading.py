"""Severity levels and grades."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (upper bound of the percentage, level); 0 is "ok", the rest is "severe".
NULL_LEVELS = ((5, "warning"), (20, "critical"))
OUTLIER_LEVELS = ((1, "warning"), (5, "critical"))
# Fixed value: key duplicates below this percentage are a warning.
KEY_DUPLICATE_LIMIT = 2
# Lowest score of each grade; anything lower is a D.
GRADES = ((90, "A"), (75, "B"), (60, "C"))
# The levels that count as serious.
SERIOUS = ("critical", "severe")


def level(percentage: Column, levels: tuple) -> Column:
    """Severity of a rounded percentage; NULL stays NULL."""
    chosen = F.when(percentage == 0, "ok")
    for bound, name in levels:
        chosen = chosen.when(percentage < bound, name)
    return chosen.when(percentage.isNotNull(), "severe")


def grade(score: Column) -> Column:
    chosen = F.when(score.isNull(), None)
    for bound, name in GRADES:
        chosen = chosen.when(score >= bound, name)
    return chosen.otherwise("D")


def is_serious(severity: Column) -> Column:
    return severity.isin(*SERIOUS)
