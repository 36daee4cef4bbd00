"""Stored answers of a language model that explain findings: from raw text to issue rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabvitals.functions.text import strip

# The fields of an answer, and what an issue shows where a field is missing.
ISSUE_DEFAULTS = {
    "issue": "Unknown",
    "column": "N/A",
    "severity": "N/A",
    "violation_count": "0",
    "what_happened": "",
    "likely_cause": "",
    "business_impact": "",
    "recommended_action": "",
}
FENCE = "```"
FENCE_LANGUAGE = "json"

PARSE_ERROR = "response is not one JSON object"
LIST_ERROR = "explanations is not a list of objects"

_ISSUE = ", ".join(f"`{name}`: string" for name in ISSUE_DEFAULTS)
_ANSWERS = "array<struct<explanations: variant, overall_assessment: string>>"
_OBJECT = "answer struct<overall_assessment: string>"

# Each item is read on its own; one that is no object becomes NULL.
_ITEMS = (
    "transform(try_variant_get(parsed.explanations, '$', 'array<variant>'), "
    f"i -> try_variant_get(i, '$', 'struct<{_ISSUE}>'))"
)
_REASON = (
    f"CASE WHEN parsed IS NULL THEN '{PARSE_ERROR}' "
    "WHEN parsed.explanations IS NULL OR is_variant_null(parsed.explanations) THEN NULL "
    f"WHEN items IS NULL OR exists(items, i -> i IS NULL) THEN '{LIST_ERROR}' END"
)


def parse_explanations(df: DataFrame, response: str = "response") -> DataFrame:
    """Add `answer`, `explanations`, `overall_assessment`, `raw_response` and `parse_error`.

    `answer` is the text without its fence, with all fields. Only a response that is exactly one
    JSON object, fenced or not, is parsed; for any other the last two columns hold its text and
    the reason. Items of `explanations` that are no objects are left out; then, and if it is no
    list at all, `parse_error` says so.
    """
    text = F.col("raw_response")
    inner = F.regexp_replace(F.get(F.split(text, FENCE), F.lit(1)), f"^{FENCE_LANGUAGE}", "")
    # JSON readers ignore what follows a complete value. Between brackets, it must be a comma
    # and another item, or close the bracket; between braces, it cannot close the bracket.
    strict = {"allowSingleQuotes": "false"}
    in_list = F.from_json(F.concat(F.lit("["), text, F.lit("]")), _ANSWERS, strict)
    in_object = F.from_json(F.concat(F.lit('{"answer":'), text, F.lit("}")), _OBJECT, strict)
    is_one = "startswith(raw_response, '{') AND size(answers) = 1 AND object.answer IS NOT NULL"
    return (
        df.withColumn("raw_response", strip(F.col(response)))
        .withColumn("raw_response", F.when(text.startswith(FENCE), strip(inner)).otherwise(text))
        .withColumn("answers", in_list)
        .withColumn("object", in_object)
        .withColumn("parsed", F.expr(f"IF({is_one}, answers[0], NULL)"))
        .withColumn("items", F.expr(_ITEMS))
        .withColumn("explanations", F.expr("filter(items, i -> i IS NOT NULL)"))
        .withColumn("overall_assessment", F.col("parsed.overall_assessment"))
        .withColumn("parse_error", F.expr(_REASON))
        .withColumn("answer", text)
        .withColumn("raw_response", F.when(F.col("parsed").isNull(), text))
        .drop("answers", "object", "parsed", "items")
    )


def issues(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """A row per explained issue, with the `keep` columns of its answer and its position."""
    # Not the plain explode: Spark would filter out empty lists first, parsing twice for it.
    exploded = parsed.select(
        *keep, F.posexplode_outer("explanations").alias("position", "found")
    ).where("position IS NOT NULL")
    fields = {
        name: F.coalesce(F.col(f"found.{name}"), F.lit(default))
        for name, default in ISSUE_DEFAULTS.items()
    }
    number = fields["violation_count"].try_cast("decimal(38,6)").try_cast("bigint")
    fields["violation_count"] = F.coalesce(number, F.lit(0).cast("bigint"))
    return exploded.select(*keep, "position", *[c.alias(n) for n, c in fields.items()])


def issue_counts(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """A row per answer: the number of issues it explains."""
    return parsed.select(
        *keep,
        F.when(F.col("explanations").isNull(), 0)
        .otherwise(F.size("explanations"))
        .alias("issue_count"),
    )
