"""The same queries in DuckDB SQL, written from the definitions of the checks."""

from catalog import given, inputs

KEYS = ["user_id", "event_type"]
OUTLIER_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

NAN = "CAST('NaN' AS DOUBLE)"


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rounded(x: str, digits: int) -> str:
    """Rounded by the exact value, as C and Python print decimals."""
    return f"CAST(printf('%.{digits}f', CAST({x} AS DOUBLE)) AS DOUBLE)"


def rounded_scaled(x: str, digits: int) -> str:
    return f"(round_even(({x}) * {10**digits}, 0) / {10**digits})"


def pct(part: str, whole: str) -> str:
    return rounded(f"CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100", 2)


def level(share: str, warning: int, critical: int) -> str:
    return (
        f"CASE WHEN {share} IS NULL THEN NULL WHEN {share} = 0 THEN 'ok' "
        f"WHEN {share} < {warning} THEN 'warning' WHEN {share} < {critical} THEN 'critical' "
        "ELSE 'severe' END"
    )


def clean(source: inputs.Input, doubles: str) -> str:
    """The input with NaN made NULL in the given columns."""
    replaced = ", ".join(f"nullif({c}, {NAN}) AS {c}" for c in doubles.split())
    return f"(SELECT * REPLACE ({replaced}) FROM {source.sql})"


LINEITEM = clean(inputs.LINEITEM, "l_quantity l_extendedprice l_discount l_tax")
EVENTS = clean(inputs.EVENTS, "value")
LARGE = inputs.LARGE.sql
DAILY = clean(inputs.DAILY, "l_quantity l_extendedprice l_discount l_tax")
SHIPMENTS, ORDERS, TRIPS = inputs.SHIPMENTS.sql, inputs.ORDERS.sql, inputs.TRIPS.sql
DOCUMENTS, PART, CUSTOMER = inputs.DOCUMENTS.sql, inputs.PART.sql, inputs.CUSTOMER.sql


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(f"({p})" for p in parts)


def grouping(by: str) -> tuple[str, str]:
    """The grouping columns before others, and the clause that groups by them."""
    return (f"{by}, ", f" GROUP BY {by}") if by else ("", "")


# Overview


def overview(source: str, name: str, sizes: dict[str, str]) -> str:
    total = " + ".join(sizes.values())
    return (
        f"SELECT {quote(name)} AS dataset_name, count(*) AS row_count, "
        f"{len(sizes)} AS column_count, {quote(','.join(sizes))} AS columns, "
        f"{rounded(f'CAST({total} AS DOUBLE) / 1024 / 1024', 2)} AS size_mb FROM {source}"
    )


def column_types(source: str, types: dict[str, str], sizes: dict[str, str]) -> str:
    return union(
        [
            f"SELECT {i} AS ordinal, {quote(c)} AS column_name, {quote(t)} AS data_type, "
            f"CAST({sizes[c]} AS BIGINT) AS logical_bytes FROM {source}"
            for i, (c, t) in enumerate(types.items())
        ]
    )


WIDTHS = {"int": 4, "bigint": 8, "double": 8, "timestamp_ntz": 8}


def sizes(types: dict[str, str]) -> dict[str, str]:
    def size(name, data_type):
        if data_type == "string":
            return f"coalesce(sum(octet_length(encode({name}))), 0)"
        if data_type == "array<float>":
            return f"coalesce(sum(len({name}) * 4), 0)"
        return f"count({name}) * {WIDTHS[data_type]}"

    return {c: size(c, t) for c, t in types.items()}


def shapes() -> str:
    return union(
        [
            f"SELECT {quote(t)} AS dataset_name, (SELECT count(*) FROM {t}) AS row_count, "
            f"CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INTEGER) AS column_count"
            for t in inputs.TABLES
        ]
    )


LINEITEM_TYPES = dict.fromkeys(inputs.LINEITEM.columns, "double") | {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}
EMBEDDING_TYPES = {"vec_id": "bigint", "embedding": "array<float>", "label": "int"}
DOCUMENT_TYPES = {"text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


# Nulls


def null_profile(source: str, columns, by: str = "") -> str:
    first, last = grouping(by)
    counts = union(
        [
            f"SELECT {first}{i} AS ordinal, {quote(c)} AS column_name, "
            f"count(*) - count({c}) AS null_count, count(*) AS n FROM {source}{last}"
            for i, c in enumerate(columns)
        ]
    )
    shares = f"SELECT *, {pct('null_count', 'n')} AS null_pct FROM ({counts})"
    return (
        f"SELECT {first}ordinal, column_name, null_count, null_pct, {level('null_pct', 5, 20)} AS severity "
        f"FROM ({shares})"
    )


def null_summary(profile: str, by: str = "") -> str:
    first, last = grouping(by)
    return (
        f"SELECT {first}count_if(null_count > 0) AS columns_with_nulls, "
        "count_if(severity IN ('critical', 'severe')) AS columns_critical, "
        f"CAST(sum(null_count) AS BIGINT) AS total_null_cells FROM ({profile}){last}"
    )


LINEITEM_NULLS = null_profile(LINEITEM, inputs.LINEITEM.columns)


# Duplicates


def repeats(source: str, columns: list[str]) -> str:
    names = ", ".join(columns)
    return f"(SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT {names} FROM {source}))"


def duplicate_profile(source: str, columns, keys: list[str]) -> str:
    counts = (
        f"SELECT {repeats(source, list(columns))} AS full_duplicates, "
        f"{repeats(source, keys)} AS key_column_dupes, (SELECT count(*) FROM {source}) AS n"
    )
    shares = (
        f"SELECT *, {pct('full_duplicates', 'n')} AS full_duplicate_pct, "
        f"{pct('key_column_dupes', 'n')} AS key_dupe_pct FROM ({counts})"
    )
    return (
        "SELECT full_duplicates, full_duplicate_pct, key_column_dupes, key_dupe_pct, "
        f"{quote(','.join(keys))} AS key_columns_checked, "
        "CASE WHEN full_duplicates > 0 THEN 'critical' WHEN key_column_dupes = 0 THEN 'ok' "
        f"WHEN key_dupe_pct < 2 THEN 'warning' ELSE 'critical' END AS severity FROM ({shares})"
    )


# Outliers


def outlier_profile(source: str, columns: list[str]) -> str:
    parts = []
    for i, c in enumerate(columns):
        values = f"SELECT CAST({c} AS DOUBLE) AS v FROM {source} WHERE {c} IS NOT NULL"
        quartiles = (
            "SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, "
            f"count(*) AS n, min(v) AS low, max(v) AS high FROM ({values})"
        )
        limits = (
            "SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi "
            f"FROM ({quartiles})"
        )
        counted = (
            f"SELECT *, (SELECT count(*) FROM ({values}) WHERE v < lo) AS outliers_low, "
            f"(SELECT count(*) FROM ({values}) WHERE v > hi) AS outliers_high FROM ({limits})"
        )
        shares = (
            "SELECT *, outliers_low + outliers_high AS total_outliers, "
            f"{pct('(outliers_low + outliers_high)', 'n')} "
            f"AS outlier_pct FROM ({counted})"
        )
        parts.append(
            f"SELECT {i} AS ordinal, {quote(c)} AS column_name, {rounded('q1', 4)} AS q1, "
            f"{rounded('q3', 4)} AS q3, {rounded('iqr', 4)} AS iqr, "
            f"{rounded('lo', 4)} AS lower_fence, {rounded('hi', 4)} AS upper_fence, "
            "outliers_low, outliers_high, total_outliers, outlier_pct, "
            f"{rounded('low', 4)} AS actual_min, {rounded('high', 4)} AS actual_max, "
            f"{level('outlier_pct', 1, 5)} AS severity FROM ({shares})"
        )
    return union(parts)


def ranked(source: str, column: str) -> str:
    """Values in order, with their rank from 0 and their number."""
    return (
        f"SELECT {column} AS v, row_number() OVER (ORDER BY {column}) - 1 AS r, "
        f"count(*) OVER () AS n FROM {source} WHERE {column} IS NOT NULL"
    )


def exact_outlier_profile(source: str, columns: dict[str, int]) -> str:
    """In whole numbers: values in units of 1 / scale, quartiles in quarters, fences in eighths."""
    parts = []
    for i, (c, scale) in enumerate(columns.items()):
        values = f"SELECT CAST({c} * {scale} AS BIGINT) AS v FROM {source}"
        order = ranked(f"({values})", "v")
        fourths = [
            f"4 * max(CASE WHEN r = ({k} * (n - 1)) // 4 THEN v END) + (({k} * max(n - 1)) % 4) "
            f"* (max(CASE WHEN r = ({k} * (n - 1) + 3) // 4 THEN v END) "
            f"- max(CASE WHEN r = ({k} * (n - 1)) // 4 THEN v END)) AS f{k}"
            for k in (1, 3)
        ]
        limits = (
            f"SELECT *, 2 * f1 - 3 * (f3 - f1) AS lo, 2 * f3 + 3 * (f3 - f1) AS hi FROM (SELECT "
            f"{', '.join(fourths)}, max(n) AS n, min(v) AS low, max(v) AS high FROM ({order}))"
        )
        counted = (
            f"SELECT *, (SELECT count(*) FROM ({values}) WHERE 8 * v < lo) AS outliers_low, "
            f"(SELECT count(*) FROM ({values}) WHERE 8 * v > hi) AS outliers_high FROM ({limits})"
        )
        shares = (
            "SELECT *, outliers_low + outliers_high AS total_outliers, "
            f"{pct('(outliers_low + outliers_high)', 'n')} AS outlier_pct FROM ({counted})"
        )

        def shown(x: str, units: int) -> str:
            return rounded(f"CAST(CAST({x} AS BIGINT) AS DOUBLE) / {units}", 4)

        parts.append(
            f"SELECT {i} AS ordinal, {quote(c)} AS column_name, {shown('f1', 4 * scale)} AS q1, "
            f"{shown('f3', 4 * scale)} AS q3, {shown('f3 - f1', 4 * scale)} AS iqr, "
            f"{shown('lo', 8 * scale)} AS lower_fence, {shown('hi', 8 * scale)} AS upper_fence, "
            "outliers_low, outliers_high, total_outliers, outlier_pct, "
            f"{shown('low', scale)} AS actual_min, {shown('high', scale)} AS actual_max, "
            f"{level('outlier_pct', 1, 5)} AS severity FROM ({shares})"
        )
    return union(parts)


def quantile_profile(source: str, columns: list[str], quarters: list[int]) -> str:
    parts = []
    for i, c in enumerate(columns):
        for j, k in enumerate(quarters):
            ends = ", ".join(
                f"CAST(max(CASE WHEN r = ({k} * (n - 1) + {up}) // 4 THEN v END) AS VARCHAR) AS {name}"
                for up, name in ((0, "lower_value"), (3, "upper_value"))
            )
            parts.append(
                f"SELECT {i * len(quarters) + j} AS ordinal, {quote(c)} AS column_name, "
                f"CAST({k / 4} AS DOUBLE) AS probability, count(*) AS count, {ends} "
                f"FROM ({ranked(source, c)})"
            )
    return union(parts)


def between_neighbours(k: int) -> str:
    """The k-th quartile of an ordered list `vs` of `n` values, from the nearer neighbour."""
    low, high = f"vs[CAST(floor((n - 1) * {k / 4}) AS BIGINT) + 1]", f"vs[CAST(ceil((n - 1) * {k / 4}) AS BIGINT) + 1]"
    part = f"CAST(({k} * (n - 1)) % 4 AS DOUBLE) / 4"
    return (
        f"CASE WHEN {part} >= 0.5 THEN {high} - ({high} - {low}) * (CAST(1 AS DOUBLE) - {part}) "
        f"ELSE {low} + ({high} - {low}) * ({part}) END"
    )


def outlier_profile_by(source: str, columns: list[str], by: str) -> str:
    parts = []
    for i, c in enumerate(columns):
        values = f"SELECT {by} AS b, CAST({c} AS DOUBLE) AS v FROM {source}"
        limits = (
            "SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM "
            f"(SELECT b, {between_neighbours(1)} AS q1, {between_neighbours(3)} AS q3, n, low, high "
            "FROM (SELECT b, list(v ORDER BY v) FILTER (v IS NOT NULL) AS vs, count(v) AS n, "
            f"min(v) AS low, max(v) AS high FROM ({values}) GROUP BY b))"
        )
        counted = (
            "SELECT l.b, q1, q3, iqr, lo, hi, n, low, high, count_if(v < lo) AS outliers_low, "
            f"count_if(v > hi) AS outliers_high FROM ({limits}) l JOIN ({values}) x "
            "ON l.b IS NOT DISTINCT FROM x.b GROUP BY ALL"
        )
        shares = (
            "SELECT *, outliers_low + outliers_high AS total_outliers, "
            f"{pct('(outliers_low + outliers_high)', 'n')} AS outlier_pct FROM ({counted})"
        )
        parts.append(
            f"SELECT b AS {by}, {i} AS ordinal, {quote(c)} AS column_name, {rounded('q1', 4)} AS q1, "
            f"{rounded('q3', 4)} AS q3, {rounded('iqr', 4)} AS iqr, "
            f"{rounded('lo', 4)} AS lower_fence, {rounded('hi', 4)} AS upper_fence, "
            "outliers_low, outliers_high, total_outliers, outlier_pct, "
            f"{rounded('low', 4)} AS actual_min, {rounded('high', 4)} AS actual_max, "
            f"{level('outlier_pct', 1, 5)} AS severity FROM ({shares})"
        )
    return union(parts)


def outlier_summary(profile: str) -> str:
    return (
        "SELECT count(*) AS columns_checked, "
        "count_if(total_outliers > 0) AS columns_with_outliers, "
        "count_if(severity IN ('critical', 'severe')) AS columns_severe, "
        f"CAST(sum(total_outliers) AS BIGINT) AS total_outlier_cells FROM ({profile})"
    )


LINEITEM_OUTLIERS = outlier_profile(LINEITEM, OUTLIER_COLUMNS)
LINEITEM_NUMBERS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    *OUTLIER_COLUMNS,
]
TRIP_OUTLIERS = outlier_profile(TRIPS, given.OUTLIER_COLUMNS)


# Rules


def rule_profile(source: str, rules: list[tuple], by: str = "") -> str:
    first, last = grouping(by)
    counts = union(
        [
            f"SELECT {first}{i} AS ordinal, {quote(name)} AS rule_name, {quote(column)} AS \"column\", "
            f"{quote(rule)} AS rule, count_if({violation}) AS violations, count(*) AS n, "
            f"{quote(on_fail)} AS on_fail FROM {source}{last}"
            for i, (name, column, rule, violation, on_fail) in enumerate(rules)
        ]
    )
    return (
        f'SELECT {first}ordinal, rule_name, "column", rule, violations, '
        f"{pct('violations', 'n')} AS violation_pct, "
        f"CASE WHEN violations = 0 THEN 'ok' ELSE on_fail END AS severity FROM ({counts})"
    )


def rule_summary(profile: str) -> str:
    return (
        "SELECT count(*) AS rules_checked, count_if(violations = 0) AS rules_passed, "
        "count_if(violations > 0) AS rules_failed, "
        f"CAST(sum(violations) AS BIGINT) AS total_violations FROM ({profile})"
    )


def mismatch(total: str, parts: list[str]) -> str:
    amount = " + ".join(f"coalesce({p}, 0)" for p in parts)
    return f"abs({rounded_scaled(amount, 2)} - {rounded_scaled(total, 2)}) > CAST(0.1 AS DOUBLE)"


SHIPMENT_CHECKS = [
    ("discount_positive", "l_discount", "l_discount > 0", "l_discount <= 0", "critical"),
    ("tax_non_negative", "l_tax", "l_tax >= 0", "l_tax < 0", "critical"),
    (
        "quantity_in_range",
        "l_quantity",
        "5 <= l_quantity <= 45",
        "l_quantity NOT BETWEEN 5 AND 45",
        "warning",
    ),
    (
        "shipped_before_received",
        "l_shipdate + l_receiptdate",
        "l_shipdate < l_receiptdate",
        "l_shipdate >= l_receiptdate",
        "critical",
    ),
    (
        "shipped_in_1998",
        "l_shipdate",
        "year(l_shipdate) == 1998",
        "year(l_shipdate) IS DISTINCT FROM 1998",
        "critical",
    ),
    (
        "taxed_without_discount",
        "l_discount + l_tax",
        "NOT (l_discount==0 AND l_tax>0)",
        "l_discount = 0 AND l_tax > 0",
        "warning",
    ),
    (
        "total_matches_parts",
        "total",
        "total = sum of parts",
        mismatch("total", ["part_price", "part_tax", "part_discount"]),
        "warning",
    ),
]
SHIPMENT_RULES = rule_profile(SHIPMENTS, SHIPMENT_CHECKS)
TRIP_RULES = rule_profile(
    TRIPS,
    [
        (
            "fare_amount_must_be_positive",
            "fare_amount",
            "fare_amount > 0",
            "fare_amount <= 0",
            "critical",
        ),
        (
            "trip_distance_non_negative",
            "trip_distance",
            "trip_distance >= 0",
            "trip_distance < 0",
            "critical",
        ),
        (
            "passenger_count_valid_range",
            "passenger_count",
            "1 <= passenger_count <= 6",
            "passenger_count NOT BETWEEN 1 AND 6",
            "warning",
        ),
        (
            "pickup_before_dropoff",
            "tpep_pickup_datetime + tpep_dropoff_datetime",
            "pickup_datetime < dropoff_datetime",
            "tpep_pickup_datetime >= tpep_dropoff_datetime",
            "critical",
        ),
        (
            "pickup_year_must_be_2024",
            "tpep_pickup_datetime",
            "year(pickup_datetime) == 2024",
            "year(tpep_pickup_datetime) IS DISTINCT FROM 2024",
            "critical",
        ),
        (
            "zero_distance_with_fare",
            "trip_distance + fare_amount",
            "NOT (trip_distance==0 AND fare_amount>0)",
            "trip_distance = 0 AND fare_amount > 0",
            "warning",
        ),
        (
            "total_amount_matches_components",
            "total_amount",
            "total_amount ≈ sum of all fare components (±$0.10)",
            mismatch("total_amount", given.AMOUNT_PARTS),
            "warning",
        ),
    ],
)


def checks(source: str, violations: dict[str, str]) -> str:
    return union(
        [
            f'SELECT {i} AS ordinal, {quote(name)} AS "check", count_if({v}) AS violations FROM {source}'
            for i, (name, v) in enumerate(violations.items())
        ]
    )


# Health


def health_score_by(nulls: str, rules: str, by: str) -> str:
    parts = (
        f"SELECT * FROM (SELECT {by}, CAST(count_if(violations = 0) AS DOUBLE) / count(*) * 100 AS r "
        f"FROM ({rules}) GROUP BY {by}) JOIN (SELECT {by}, "
        f"CAST(count_if(severity = 'ok') AS DOUBLE) / count(*) * 100 AS n FROM ({nulls}) GROUP BY {by}) "
        f"USING ({by})"
    )
    scores = (
        f"SELECT {by}, {rounded('CAST(0.6 AS DOUBLE) * r + CAST(0.4 AS DOUBLE) * n', 1)} AS score, "
        f"{rounded('r', 1)} AS rule_score, {rounded('n', 1)} AS null_score FROM ({parts})"
    )
    return (
        "SELECT *, CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' "
        f"WHEN score >= 60 THEN 'C' ELSE 'D' END AS grade FROM ({scores})"
    )


def health_score(nulls: str, rules: str | None) -> str:
    rule_score = (
        f"(SELECT CAST(count_if(violations = 0) AS DOUBLE) / count(*) * 100 FROM ({rules}))"
        if rules
        else "CAST(100 AS DOUBLE)"
    )
    parts = (
        f"SELECT {rule_score} AS r, "
        f"(SELECT CAST(count_if(severity = 'ok') AS DOUBLE) / count(*) * 100 FROM ({nulls})) AS n"
    )
    scores = (
        f"SELECT {rounded('CAST(0.6 AS DOUBLE) * r + CAST(0.4 AS DOUBLE) * n', 1)} AS score, "
        f"{rounded('r', 1)} AS rule_score, {rounded('n', 1)} AS null_score FROM ({parts})"
    )
    return (
        "SELECT *, CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' "
        f"WHEN score >= 60 THEN 'C' ELSE 'D' END AS grade FROM ({scores})"
    )


# Expectations


def column_check(type_name, column, unexpected, considered, mostly=1.0, group="general", description=""):
    return (type_name, column, group, description, unexpected, considered, mostly, None, None)


def not_null(column, mostly=1.0, **meta):
    name = "expect_column_values_to_not_be_null"
    return column_check(name, column, f"{column} IS NULL", "count(*)", mostly, **meta)


def between(column, low=None, high=None, mostly=1.0, **meta):
    tests = [f"{column} < {low}"] * (low is not None) + [f"{column} > {high}"] * (high is not None)
    name = "expect_column_values_to_be_between"
    return column_check(name, column, " OR ".join(tests), f"count({column})", mostly, **meta)


def in_set(column, values, mostly=1.0, **meta):
    name = "expect_column_values_to_be_in_set"
    listed = ", ".join(quote(v) if isinstance(v, str) else str(v) for v in values)
    test = f"{column} NOT IN ({listed})"
    return column_check(name, column, test, f"count({column})", mostly, **meta)


def table_check(type_name, holds, group="general", description="", column="table-level", reason=None):
    return (type_name, column, group, description, None, None, None, holds, reason)


def columns_match(holds: bool, **meta):
    return table_check("expect_table_columns_to_match_set", str(holds).lower(), **meta)


def column_count(holds: bool, **meta):
    return table_check("expect_table_column_count_to_equal", str(holds).lower(), **meta)


def row_count(holds: str, **meta):
    return table_check("expect_table_row_count_to_be_between", holds, **meta)


def validation(source: str, suite: list[tuple], by: str = "") -> str:
    first, last = grouping(by)
    parts = []
    for i, (name, column, group, description, unexpected, considered, mostly, holds, reason) in enumerate(suite):
        if holds is not None:
            counts = f"0 AS bad, 0 AS n, bool_and(true) AND {holds} AS passed"
        else:
            counts = (
                f"count_if({unexpected}) AS bad, {considered} AS n, "
                f"coalesce(CAST({considered} - count_if({unexpected}) AS DOUBLE) "
                f"/ nullif({considered}, 0) >= CAST({mostly} AS DOUBLE), true) AS passed"
            )
        parts.append(
            f"SELECT {first}{i} AS ordinal, {quote(name)} AS expectation, {quote(column)} AS \"column\", "
            f"{quote(group)} AS \"group\", {counts}, {quote(description)} AS description, "
            f"{'CAST(NULL AS VARCHAR)' if reason is None else quote(reason)} AS reason FROM {source}{last}"
        )
    return (
        f'SELECT {first}ordinal, expectation, "column", "group", passed, '
        "CASE WHEN passed THEN 0 ELSE bad END AS violation_count, "
        f"CASE WHEN passed OR n = 0 THEN 0.0 ELSE {pct('bad', 'n')} END AS violation_pct, "
        f"description, reason FROM ({union(parts)})"
    )


def validation_summary(results: str, by: str = "") -> str:
    first, last = grouping(by)
    return (
        f"SELECT {first}count(*) AS total, count_if(passed) AS passed, count_if(NOT passed) AS failed, "
        f"{rounded('CAST(count_if(passed) AS DOUBLE) / count(*) * 100', 1)} AS success_pct "
        f"FROM ({results}){last}"
    )


LINEITEM_SUITE = [
    columns_match(True, group="schema", description="keys"),
    columns_match(False, group="schema", description="all"),
    not_null("l_orderkey", group="nulls", description="order"),
    not_null("l_quantity", group="nulls", description="quantity"),
    not_null("l_tax", 0.85, group="nulls", description="tax, mostly"),
    between("l_extendedprice", 1000, 100000, group="ranges", description="price"),
    between("l_tax", high=0.05, group="ranges", description="upper bound only"),
    between("l_quantity", 2, 50, 0.95, group="ranges", description="tolerated"),
    in_set("l_returnflag", ["A", "N"], group="categorical", description="flag"),
    in_set("l_linestatus", ["F", "O"], group="categorical", description="status"),
    table_check(
        "expect_column_values_to_be_in_set",
        "false",
        description="no such column",
        column="l_color",
        reason="column not found",
    ),
    row_count("count(*) BETWEEN 1000000 AND 5000000", group="dataset", description="rows"),
    row_count("count(*) >= 1", group="dataset", description="some rows"),
    column_count(True, group="dataset", description="columns"),
]
LINEITEM_RESULTS = validation(LINEITEM, LINEITEM_SUITE)
TRIP_RESULTS = validation(
    TRIPS,
    [
        columns_match(
            True,
            group="schema",
            description="All critical columns must be present in the dataset",
        ),
        *[
            not_null(
                c,
                group="nulls",
                description=f"{c} must never be null — required for every valid trip record",
            )
            for c in given.NEVER_NULL
        ],
        *[
            between(c, low, high, mostly, group="ranges", description=d)
            for c, low, high, mostly, d in given.RANGES
        ],
        *[
            in_set(c, values, mostly, group="categorical", description=d)
            for c, values, mostly, d in given.VALUE_SETS
        ],
        row_count(
            "count(*) BETWEEN 1000000 AND 5000000",
            group="dataset",
            description="Row count must be between 1M and 5M for a full month of NYC trips",
        ),
        column_count(
            True,
            group="dataset",
            description="Dataset must have exactly 19 columns — catches schema drift",
        ),
        *[
            between(
                c,
                1,
                265,
                group="cross_column",
                description=f"{side} location must be a valid NYC taxi zone (1-265)",
            )
            for c, side in (("PULocationID", "Pickup"), ("DOLocationID", "Dropoff"))
        ],
    ],
)


# Exploration


def describe(source: str, columns: dict[str, int], less: str = "0") -> str:
    """Deviations are taken after subtracting `less`, which brings large numbers near zero."""
    parts = []
    for c, i in columns.items():
        statistics = {
            "mean": f"avg({c})",
            "std": f"stddev_samp({c} - {less})",
            "min": f"CAST(min({c}) AS DOUBLE)",
            "p25": f"quantile_cont(CAST({c} AS DOUBLE), 0.25)",
            "p50": f"quantile_cont(CAST({c} AS DOUBLE), 0.5)",
            "p75": f"quantile_cont(CAST({c} AS DOUBLE), 0.75)",
            "max": f"CAST(max({c}) AS DOUBLE)",
        }
        listed = ", ".join(f"{rounded_scaled(e, 2)} AS {k}" for k, e in statistics.items())
        parts.append(
            f"SELECT {i} AS ordinal, {quote(c)} AS column_name, count({c}) AS count, {listed} "
            f"FROM {source}"
        )
    return union(parts)


def describe_timestamps(source: str, column: str) -> str:
    micros = f"epoch_us({column})"
    quartile = "make_timestamp(CAST(floor(quantile_cont(CAST({m} AS DOUBLE), {p})) AS BIGINT))"
    quartiles = ", ".join(
        f"{quartile.format(m=micros, p=p)} AS {k}"
        for k, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    )
    return (
        f"SELECT 0 AS ordinal, {quote(column)} AS column_name, count({column}) AS count, "
        f"make_timestamp(CAST(sum({micros}) // count({column}) AS BIGINT)) AS mean, "
        f"min({column}) AS min, {quartiles}, max({column}) AS max FROM {source}"
    )


def value_counts(source: str, columns: list[str]) -> str:
    return union(
        [
            f"SELECT {quote(c)} AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS count "
            f"FROM {source} GROUP BY {c}"
            for c in columns
        ]
    )


SHIPMENT_NUMBERS = [
    *LINEITEM_NUMBERS,
    "part_price",
    "part_tax",
    "part_discount",
    "total",
]

# Findings

TRIP_NULLS = null_profile(TRIPS, inputs.TRIPS.columns)
TRIP_DUPLICATES = duplicate_profile(TRIPS, inputs.TRIPS.columns, given.KEY_COLUMNS)
TRIP_HEALTH = health_score(TRIP_NULLS, TRIP_RULES)

FINDINGS = union(
    [
        "SELECT 'trips' AS dataset, 'rule' AS kind, ordinal, rule_name AS name, \"column\", "
        "violations AS count, violation_pct AS pct, severity, rule AS detail "
        f"FROM ({TRIP_RULES}) WHERE violations > 0",
        "SELECT 'trips', 'outlier', ordinal, 'iqr_outliers', column_name, total_outliers, "
        "outlier_pct, severity, 'actual [' || CAST(actual_min AS VARCHAR) || ', ' || "
        "CAST(actual_max AS VARCHAR) || '], expected [' || CAST(lower_fence AS VARCHAR) || ', ' "
        f"|| CAST(upper_fence AS VARCHAR) || ']' FROM ({TRIP_OUTLIERS}) "
        "WHERE severity IN ('critical', 'severe')",
        "SELECT 'trips', 'expectation', ordinal, expectation, \"column\", violation_count, "
        f"violation_pct, CAST(NULL AS VARCHAR), description FROM ({TRIP_RESULTS}) WHERE NOT passed",
    ]
)


def _lines(templates: tuple) -> str:
    """The lines of a section as one SQL text."""
    shown = {
        "n": "format('{{:,}}', {0})",
        "d": "CAST({0} AS VARCHAR)",
        "f": "CAST({0} AS VARCHAR)",
        "s": "{0}",
        "S": "upper({0})",
    }
    lines = []
    for template, *specs in templates:
        pieces = [quote(p.replace("%%", "%")) for p in template.split("%s")]
        for i, spec in enumerate(specs):
            kind, name = spec.split(":")
            pieces.insert(2 * i + 1, shown[kind].format(f'"{name}"'))
        lines.append(" || ".join(pieces))
    return " || chr(10) || ".join(f"({line})" for line in lines)


def _sections() -> str:
    overview_row = (
        f"SELECT 'trips' AS dataset_name, (SELECT count(*) FROM {TRIPS}) AS row_count, "
        f"{len(inputs.TRIPS.columns)} AS column_count, '2024-01-31T12:00:00' AS profiled_at, * "
        f"FROM ({TRIP_HEALTH})"
    )
    sections = [
        (given.OVERVIEW_LINES, overview_row, "0"),
        (given.NULL_LINES, null_summary(TRIP_NULLS), "0"),
        (given.DUPLICATE_LINES, TRIP_DUPLICATES, "0"),
        (given.OUTLIER_LINES, outlier_summary(TRIP_OUTLIERS), "0"),
        (
            given.SEVERE_OUTLIER_LINES,
            f"SELECT * FROM ({TRIP_OUTLIERS}) WHERE severity IN ('critical', 'severe')",
            "ordinal",
        ),
        (given.RULE_LINES, rule_summary(TRIP_RULES), "0"),
        (given.FAILED_RULE_LINES, f"SELECT * FROM ({TRIP_RULES}) WHERE violations > 0", "ordinal"),
        (given.VALIDATION_LINES, validation_summary(TRIP_RESULTS), "0"),
        (
            given.FAILED_EXPECTATION_LINES,
            f"SELECT * FROM ({TRIP_RESULTS}) WHERE NOT passed",
            "ordinal",
        ),
    ]
    return union(
        [
            f"SELECT {i} AS section, {item} AS item, {_lines(lines)} AS lines FROM ({rows})"
            for i, (lines, rows, item) in enumerate(sections)
        ]
    )


FINDINGS_TEXT = (
    "SELECT 'trips' AS dataset, string_agg(lines, chr(10) ORDER BY section, item) "
    f"AS findings_text FROM ({_sections()})"
)


# Explanations


def parsed(source: str) -> str:
    """The answers without a fence, and whether each is exactly one JSON object."""
    space = "' ' || chr(9) || chr(10) || chr(13)"
    stripped = f"SELECT *, trim(response, {space}) AS t FROM {source}"
    unfenced = (
        "SELECT * EXCLUDE (t), CASE WHEN starts_with(t, '```') "
        f"THEN trim(regexp_replace(string_split(t, '```')[2], '^json', ''), {space}) "
        f"ELSE t END AS t FROM ({stripped})"
    )
    return (
        "SELECT *, json_valid(t) AND coalesce(json_type(CASE WHEN json_valid(t) THEN t END), '') "
        f"= 'OBJECT' AS good FROM ({unfenced})"
    )


ANSWERS = parsed(inputs.ANSWERS.sql)
_JSON = "CASE WHEN good THEN CAST(t AS JSON) END"
_EXPLAINED = f"json_extract({_JSON}, '$.explanations')"
ISSUE_COUNT = f"CAST(coalesce(json_array_length({_EXPLAINED}), 0) AS INTEGER)"


def _mixed() -> str:
    """Answers with their text, their list of explanations, and what is wrong with it."""
    listed = f"SELECT *, {_EXPLAINED} AS e FROM ({parsed(inputs.MIXED_ANSWERS.sql)})"
    items = "CASE WHEN json_type(e) = 'ARRAY' THEN CAST(e AS JSON[]) ELSE [] END"
    good = "list_filter(items, lambda i: json_type(i) = 'OBJECT')"
    return (
        f"SELECT *, {good} AS found, CASE WHEN NOT good THEN {quote(given.NOT_ONE_OBJECT)} "
        "WHEN coalesce(json_type(e), 'NULL') = 'NULL' THEN NULL "
        f"WHEN json_type(e) <> 'ARRAY' OR len({good}) < len(items) THEN {quote(given.NOT_A_LIST)} "
        f"END AS parse_error FROM (SELECT *, {items} AS items FROM ({listed}))"
    )


def _answer(columns: str, source: str) -> str:
    return (
        f"SELECT {columns}, CASE WHEN good THEN NULL ELSE t END AS raw_response, "
        f"CASE WHEN good THEN NULL ELSE {quote(given.NOT_ONE_OBJECT)} END AS parse_error FROM ({source})"
    )


def _issues(items: str) -> str:
    fields = ", ".join(
        f"coalesce(item ->> '$.{name}', {quote(default)}) AS \"{name}\""
        for name, default in given.ISSUE_DEFAULTS.items()
        if name != "violation_count"
    )
    count = "coalesce(TRY_CAST(item ->> '$.violation_count' AS BIGINT), 0) AS violation_count"
    return f"SELECT event_id, CAST(position AS INTEGER) AS position, {fields}, {count} FROM ({items})"


ISSUES = _issues(
    f"SELECT event_id, unnest(CAST({_EXPLAINED} AS JSON[])) AS item, "
    f"unnest(range(len(CAST({_EXPLAINED} AS JSON[])))) AS position FROM ({ANSWERS}) "
    "WHERE good"
)
MIXED_ISSUES = _issues(
    "SELECT event_id, unnest(found) AS item, unnest(range(len(found))) AS position "
    f"FROM ({_mixed()})"
)

# Three of four rows and more are infinite, so both quartiles are, and nothing lies between them.
INFINITE_OUTLIERS = (
    "SELECT 0 AS ordinal, 'endless' AS column_name, max(endless) AS q1, max(endless) AS q3, "
    "CAST(NULL AS DOUBLE) AS iqr, CAST(NULL AS DOUBLE) AS lower_fence, "
    "CAST(NULL AS DOUBLE) AS upper_fence, CAST(0 AS BIGINT) AS outliers_low, "
    "CAST(0 AS BIGINT) AS outliers_high, CAST(0 AS BIGINT) AS total_outliers, "
    f"CAST(0 AS DOUBLE) AS outlier_pct, {rounded('min(endless)', 4)} AS actual_min, "
    f"max(endless) AS actual_max, 'ok' AS severity FROM {inputs.SIGNED.sql}"
)

ORACLE = {
    "table_shapes": shapes(),
    "overview": overview(LINEITEM, "lineitem", sizes(LINEITEM_TYPES)),
    "column_types": column_types(LINEITEM, LINEITEM_TYPES, sizes(LINEITEM_TYPES)),
    "nested_column_types": column_types("embeddings", EMBEDDING_TYPES, sizes(EMBEDDING_TYPES)),
    "text_column_sizes": column_types(DOCUMENTS, DOCUMENT_TYPES, sizes(DOCUMENT_TYPES)),
    "first_rows": f"SELECT * FROM {ORDERS} ORDER BY o_orderkey LIMIT 5",
    "null_profile": LINEITEM_NULLS,
    "null_profile_events": null_profile(EVENTS, inputs.EVENTS.columns),
    "null_profile_by_day": null_profile(DAILY, inputs.LINEITEM.columns, "day"),
    "null_summary_by_flag": null_summary(
        null_profile(
            LINEITEM,
            [c for c in inputs.LINEITEM.columns if c not in ("l_returnflag", "l_linestatus")],
            "l_returnflag, l_linestatus",
        ),
        "l_returnflag, l_linestatus",
    ),
    "null_summary": null_summary(LINEITEM_NULLS),
    "columns_with_nulls": f"SELECT * FROM ({LINEITEM_NULLS}) WHERE null_count > 0",
    "duplicate_profile": duplicate_profile(DOCUMENTS, inputs.DOCUMENTS.columns, ["lang", "n_chars"]),
    "duplicate_profile_clean": duplicate_profile(EVENTS, inputs.EVENTS.columns, ["event_id"]),
    "key_duplicates": (
        f"SELECT k AS key_column_dupes, {pct('k', 'n')} AS key_dupe_pct FROM "
        f"(SELECT {repeats(EVENTS, KEYS)} AS k, (SELECT count(*) FROM {EVENTS}) AS n)"
    ),
    "key_duplicates_absent": (
        f"SELECT key_column_dupes, {pct('key_column_dupes', 'n')} AS key_dupe_pct FROM ("
        f"SELECT {repeats(EVENTS, ['event_type'])} AS key_column_dupes, "
        f"(SELECT count(*) FROM {EVENTS}) AS n) UNION ALL SELECT 0, 0.0"
    ),
    "shifted_duplicates": duplicate_profile(inputs.SHIFTED.sql, ["a", "b"], ["a"]),
    "outlier_profile_infinite": INFINITE_OUTLIERS,
    "outlier_profile": LINEITEM_OUTLIERS,
    "outlier_profile_all_numeric": outlier_profile(LINEITEM, LINEITEM_NUMBERS),
    "outlier_profile_by_flag": outlier_profile_by(LINEITEM, OUTLIER_COLUMNS, "l_returnflag"),
    "outlier_profile_by_day": outlier_profile_by(DAILY, ["l_extendedprice"], "day"),
    "outlier_profile_exact": exact_outlier_profile(LARGE, {"price": 100, "far_key": 1}),
    "quantile_profile": quantile_profile(LARGE, list(inputs.LARGE.columns), [0, 1, 2, 3, 4]),
    "outlier_profile_events": outlier_profile(EVENTS, ["value"]),
    "outlier_summary": outlier_summary(LINEITEM_OUTLIERS),
    "severe_outliers": (
        f"SELECT * FROM ({outlier_profile(EVENTS, ['value'])}) "
        "WHERE severity IN ('critical', 'severe')"
    ),
    "rule_profile": SHIPMENT_RULES,
    "rule_profile_orders": rule_profile(
        ORDERS,
        [
            (
                "year(o_orderdate) == 1998",
                "o_orderdate",
                "year(o_orderdate) == 1998",
                "year(o_orderdate) IS DISTINCT FROM 1998",
                "critical",
            ),
            ("o_totalprice > 0", "o_totalprice", "o_totalprice > 0", "o_totalprice <= 0", "critical"),
        ],
    ),
    "rule_profile_customer": rule_profile(
        CUSTOMER, [("c_acctbal >= 0", "c_acctbal", "c_acctbal >= 0", "c_acctbal < 0", "critical")]
    ),
    "rule_profile_part": rule_profile(
        PART,
        [("1 <= p_size <= 40", "p_size", "1 <= p_size <= 40", "p_size NOT BETWEEN 1 AND 40", "critical")],
    ),
    "rule_profile_by_day": rule_profile(
        f"(SELECT *, CAST(l_shipdate AS DATE) AS day FROM {SHIPMENTS})", SHIPMENT_CHECKS, "day"
    ),
    "rule_summary": rule_summary(SHIPMENT_RULES),
    "failed_rules": f"SELECT * FROM ({SHIPMENT_RULES}) WHERE violations > 0",
    "exploration_checks": checks(
        TRIPS,
        {
            "distance_below_zero": "trip_distance < 0",
            "fare_not_positive": "fare_amount <= 0",
            "fare_over_500": "fare_amount > 500",
            "no_passengers": "passenger_count = 0",
            "fare_without_distance": "trip_distance = 0 AND fare_amount > 0",
            "pickup_after_dropoff": "tpep_pickup_datetime > tpep_dropoff_datetime",
        },
    ),
    "health_score": health_score(null_profile(SHIPMENTS, inputs.SHIPMENTS.columns), SHIPMENT_RULES),
    "health_score_by_status": health_score_by(
        null_profile(
            SHIPMENTS, [c for c in inputs.SHIPMENTS.columns if c != "l_linestatus"], "l_linestatus"
        ),
        rule_profile(SHIPMENTS, SHIPMENT_CHECKS, "l_linestatus"),
        "l_linestatus",
    ),
    "health_score_without_rules": health_score(LINEITEM_NULLS, None),
    "expect_columns": validation(
        LINEITEM, [columns_match(True), columns_match(False), column_count(True)]
    ),
    "expect_not_null": validation(LINEITEM, [not_null("l_quantity"), not_null("l_orderkey")]),
    "expect_between": validation(
        LINEITEM, [between("l_extendedprice", 1000, 100000), between("l_tax", 0, 0.05)]
    ),
    "expect_in_set": validation(
        LINEITEM, [in_set("l_returnflag", ["A", "N"]), in_set("l_linestatus", ["F", "O"])]
    ),
    "expect_in_set_with_none": validation(LINEITEM, [in_set("l_returnflag", ["A"])]),
    "expect_row_count": validation(
        LINEITEM, [row_count("count(*) BETWEEN 1000000 AND 5000000"), row_count("count(*) >= 1")]
    ),
    "expect_mostly": validation(PART, [between("p_size", 1, 48, 0.95), between("p_size", 1, 48)]),
    "validation_results": LINEITEM_RESULTS,
    "validation_by_day": validation(
        DAILY, [*LINEITEM_SUITE[:-1], column_count(False, group="dataset", description="columns")], "day"
    ),
    "validation_summary_by_flag": validation_summary(
        validation(LINEITEM, LINEITEM_SUITE, "l_returnflag"), "l_returnflag"
    ),
    "validation_summary": validation_summary(LINEITEM_RESULTS),
    "failed_details": f"SELECT * FROM ({LINEITEM_RESULTS}) WHERE NOT passed",
    "describe": describe(LINEITEM, {c: i for i, c in enumerate(LINEITEM_NUMBERS)}),
    "describe_orders": describe(ORDERS, {"o_orderkey": 0, "o_custkey": 1, "o_totalprice": 2}),
    "describe_decimals": union(
        [
            describe(LARGE, {"price": 0}),
            describe(LARGE, {"key": 1}, "CAST(9007199254740992 AS BIGINT)"),
        ]
    ),
    "describe_timestamps": describe_timestamps(ORDERS, "o_orderdate"),
    "describe_event_times": describe_timestamps(EVENTS, "ts"),
    "value_counts": value_counts(LINEITEM, ["l_returnflag", "l_linenumber"]),
    "taxi_rules": TRIP_RULES,
    "taxi_validation": TRIP_RESULTS,
    "taxi_outliers": TRIP_OUTLIERS,
    "taxi_duplicates": TRIP_DUPLICATES,
    "value_counts_signed_zero": value_counts(
        f"(SELECT CASE WHEN zero = 0 THEN CAST(0 AS DOUBLE) ELSE zero END AS zero "
        f"FROM {inputs.SIGNED.sql})",
        ["zero"],
    ),
    "taxi_value_counts": value_counts(TRIPS, given.CATEGORIES),
    "taxi_health": f"SELECT 'trips' AS dataset, * FROM ({TRIP_HEALTH})",
    "findings": FINDINGS,
    "findings_text": FINDINGS_TEXT,
    "latest_findings_text": FINDINGS_TEXT,
    "merged_null_profile": null_profile(SHIPMENTS, inputs.SHIPMENTS.columns),
    "merged_rule_profile": SHIPMENT_RULES,
    "merged_moments": (
        "SELECT * EXCLUDE (p25, p50, p75) FROM "
        f"({describe(SHIPMENTS, {c: i for i, c in enumerate(SHIPMENT_NUMBERS)})})"
    ),
    "saved_profile": f"SELECT 'trips' AS dataset, * FROM ({TRIP_RULES})",
    "saved_validation": (
        "SELECT 'lineitem' AS dataset, "
        f"(SELECT success_pct FROM ({validation_summary(LINEITEM_RESULTS)})) AS success_pct, * "
        f"FROM ({LINEITEM_RESULTS}) WHERE NOT passed"
    ),
    "saved_explanations": (
        f"SELECT CAST(event_id AS VARCHAR) AS dataset, t AS answer, "
        f"{_JSON} ->> '$.overall_assessment' "
        f"AS overall_assessment, CASE WHEN good THEN NULL ELSE {quote(given.NOT_ONE_OBJECT)} END "
        f"AS parse_error, {ISSUE_COUNT} AS issue_count FROM ({ANSWERS})"
    ),
    "run_times": (
        "SELECT unnest([TIMESTAMP '2024-01-31 12:00:00', TIMESTAMP '2024-01-31 12:00:00']) AS run_at"
    ),
    "latest_report": (
        "SELECT * FROM (SELECT * FROM "
        f"{inputs.HISTORY.sql} QUALIFY row_number() OVER (PARTITION BY dataset, kind "
        "ORDER BY run_ts DESC, run_id DESC) = 1)"
    ),
    "parse_explanations": _answer(
        f"event_id, {_JSON} ->> '$.overall_assessment' AS overall_assessment", ANSWERS
    ),
    "parse_chats": _answer("conv_id, turn", parsed(inputs.CHATS.sql)),
    "parse_mixed": (
        "SELECT event_id, t AS answer, "
        f"{_JSON} ->> '$.overall_assessment' AS overall_assessment, parse_error, "
        f"CAST(len(found) AS INTEGER) AS issue_count FROM ({_mixed()})"
    ),
    "mixed_issues": MIXED_ISSUES,
    "issues": ISSUES,
    "issue_counts": f"SELECT event_id, {ISSUE_COUNT} AS issue_count FROM ({ANSWERS})",
}
