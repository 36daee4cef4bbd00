"""Inputs of the registered queries: the given tables, some with derived columns.

The tables hold no missing values, so these inputs make some out of the values of other
columns. The expressions mean the same in Spark SQL and in DuckDB.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tabvitals.sources.tables import read_table

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@dataclass(frozen=True)
class Input:
    table: str
    columns: dict[str, str]

    def frame(self, spark: SparkSession, folder: str) -> DataFrame:
        table = read_table(spark, f"{folder}/{self.table}.parquet")
        return table.selectExpr(*[f"{e} AS {n}" for n, e in self.columns.items()])

    @property
    def sql(self) -> str:
        columns = ", ".join(f"{e} AS {n}" for n, e in self.columns.items())
        return f"(SELECT {columns} FROM {self.table})"


def _plain(names: str) -> dict[str, str]:
    return {n: n for n in names.split()}


_LINEITEM = _plain(
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
)

# NULL and NaN in a few columns, and a price that some rows carry tenfold.
LINEITEM = Input(
    "lineitem",
    _LINEITEM
    | {
        "l_quantity": "CASE WHEN l_discount = 0.0 THEN NULL ELSE l_quantity END",
        "l_extendedprice": (
            "CASE WHEN l_tax = 0.03 AND l_quantity = 7.0 THEN l_extendedprice * 10 "
            "ELSE l_extendedprice END"
        ),
        "l_tax": "CASE WHEN l_tax = 0.08 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END",
        "l_returnflag": (
            "CASE WHEN l_linenumber = 7 AND l_linestatus = 'F' THEN NULL ELSE l_returnflag END"
        ),
    },
)

# The same, with the day of shipping.
DAILY = Input("lineitem", LINEITEM.columns | {"day": "CAST(l_shipdate AS DATE)"})

# A second date before, at or after the ship date, and a total of three parts that is missing
# or wrong in some rows.
SHIPMENTS = Input(
    "lineitem",
    _LINEITEM
    | {
        "l_receiptdate": (
            "CASE WHEN l_linenumber = 1 THEN l_shipdate - INTERVAL '1' DAY "
            "WHEN l_linenumber = 2 THEN l_shipdate ELSE l_shipdate + INTERVAL '7' DAY END"
        ),
        "part_price": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END",
        "part_tax": "l_tax",
        "part_discount": "CASE WHEN l_linenumber = 4 THEN NULL ELSE l_discount END",
        "total": (
            "CASE WHEN l_linenumber = 5 THEN NULL ELSE "
            "CASE WHEN l_linenumber = 3 THEN 0 ELSE l_extendedprice END + l_tax "
            "+ CASE WHEN l_linenumber = 4 THEN 0 ELSE l_discount END "
            "+ CASE WHEN l_quantity = 11.0 THEN 1 ELSE 0 END END"
        ),
    },
)

ORDERS = Input(
    "orders",
    _plain("o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority")
    | {"o_orderdate": "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL ELSE o_orderdate END"},
)

EVENTS = Input(
    "events",
    _plain("event_id ts user_id event_type value props")
    | {"value": "CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END"},
)

PART = Input("part", _plain("p_partkey p_name p_brand p_type p_size p_retailprice"))
CUSTOMER = Input("customer", _plain("c_custkey c_name c_nationkey c_acctbal c_mktsegment"))
EMBEDDINGS = Input("embeddings", _plain("vec_id embedding label"))
# Without the id, copied documents are duplicate rows.
DOCUMENTS = Input("documents", _plain("text lang source n_chars"))

_PICKUP = (
    "CASE WHEN l_discount = 0.01 AND l_tax = 0.01 THEN NULL "
    "ELSE l_shipdate + INTERVAL '25' YEAR END"
)
_FARE = "l_extendedprice / 100 - 10"
_TOLLS = "l_quantity * 5"
_CONGESTION = "CASE WHEN l_tax = 0.0 THEN NULL ELSE CAST(2.5 AS DOUBLE) END"
_AIRPORT = "CASE WHEN l_linestatus = 'F' THEN CAST(1.25 AS DOUBLE) ELSE NULL END"

# Order lines read as taxi trips, with every kind of defect the taxi checks look for.
TRIPS = Input(
    "lineitem",
    {
        "VendorID": (
            "CAST(CASE WHEN l_linenumber = 7 THEN 6 WHEN l_linenumber = 6 THEN 3 "
            "ELSE 1 + l_linenumber % 2 END AS INT)"
        ),
        "tpep_pickup_datetime": _PICKUP,
        "tpep_dropoff_datetime": (
            "CASE WHEN l_linenumber = 1 AND l_tax = 0.0 "
            "THEN l_shipdate + INTERVAL '25' YEAR - INTERVAL '5' MINUTE "
            "WHEN l_linenumber = 2 AND l_tax = 0.0 THEN l_shipdate + INTERVAL '25' YEAR "
            "ELSE l_shipdate + INTERVAL '25' YEAR + INTERVAL '20' MINUTE END"
        ),
        "passenger_count": "CASE WHEN l_tax = 0.0 THEN NULL ELSE CAST(l_linenumber - 1 AS BIGINT) END",
        "trip_distance": (
            "CASE WHEN l_discount = 0.1 THEN 0 - l_quantity WHEN l_discount = 0.09 "
            "THEN 0 * l_quantity ELSE l_quantity END"
        ),
        "RatecodeID": "CASE WHEN l_linestatus = 'O' THEN CAST(l_linenumber AS BIGINT) ELSE NULL END",
        "store_and_fwd_flag": (
            "CASE WHEN l_returnflag = 'R' THEN 'Y' WHEN l_returnflag = 'A' THEN 'N' "
            "WHEN l_linenumber = 1 THEN 'X' ELSE NULL END"
        ),
        "PULocationID": "CAST(l_suppkey + 1 AS INT)",
        "DOLocationID": "CAST(l_partkey % 300 AS INT)",
        "payment_type": "CAST(l_linenumber % 6 AS BIGINT)",
        "fare_amount": _FARE,
        "extra": "l_discount * 10",
        "mta_tax": "CAST(0.5 AS DOUBLE)",
        "tip_amount": "l_tax * 100",
        "tolls_amount": _TOLLS,
        "improvement_surcharge": "CAST(1 AS DOUBLE)",
        "total_amount": (
            "CASE WHEN l_discount = 0.02 AND l_linenumber = 1 THEN NULL ELSE "
            f"{_FARE} + l_discount * 10 + 0.5 + l_tax * 100 + {_TOLLS} + 1 "
            f"+ COALESCE({_CONGESTION}, 0) + COALESCE({_AIRPORT}, 0) "
            "+ CASE WHEN l_discount = 0.05 THEN 0.2 ELSE 0 END END"
        ),
        "congestion_surcharge": _CONGESTION,
        "Airport_fee": _AIRPORT,
    },
)

# Events as stored answers: plain, fenced and broken ones, with missing fields and odd counts.
_ISSUE = (
    "concat('{\"issue\": \"', event_type, '\", \"column\": \"value\", \"violation_count\": ', "
    "CAST(user_id AS STRING), ', \"what_happened\": \"user ', CAST(user_id AS STRING), '\"}')"
)
_SHORT_ISSUE = "concat('{\"issue\": \"', event_type, '\", \"severity\": \"info\"}')"
_OBJECT = (
    f"concat('{{\"explanations\": [', {_ISSUE}, ', ', {_SHORT_ISSUE}, '], "
    "\"overall_assessment\": \"', event_type, ' event\"}')"
)
ANSWERS = Input(
    "events",
    {
        "event_id": "event_id",
        "response": (
            f"CASE WHEN event_type = 'click' THEN concat('```json\n', {_OBJECT}, '\n```') "
            f"WHEN event_type = 'view' THEN concat(' \n', {_OBJECT}, ' ') "
            f"WHEN event_type = 'purchase' THEN concat({_OBJECT}, ' and more') "
            f"WHEN event_type = 'error' THEN concat('```\n', {_OBJECT}, '\n```\nthat is all') "
            "ELSE props END"
        ),
    },
)

# Events as answers whose explanations are not what they should be.
MIXED_ANSWERS = Input(
    "events",
    {
        "event_id": "event_id",
        "response": (
            "CASE WHEN event_type = 'click' THEN concat('{\"explanations\": [', "
            f"{_ISSUE}, ', \"oops\", 3], \"notes\": \"kept\"}}') "
            "WHEN event_type = 'view' THEN concat('{\"explanations\": \"none\", "
            "\"overall_assessment\": \"', event_type, '\"}') "
            "WHEN event_type = 'purchase' THEN '{\"explanations\": null}' "
            f"ELSE concat('{{\"explanations\": [', {_SHORT_ISSUE}, ', null]}}') END"
        ),
    },
)

# Order lines with both zeros, and with infinite quartiles.
SIGNED = Input(
    "lineitem",
    {
        "zero": (
            "CASE WHEN l_linenumber = 1 THEN CAST('-0.0' AS DOUBLE) "
            "WHEN l_linenumber = 2 THEN CAST(0 AS DOUBLE) ELSE CAST(l_linenumber AS DOUBLE) END"
        ),
        "endless": "CASE WHEN l_linenumber < 7 THEN CAST('Infinity' AS DOUBLE) ELSE l_tax END",
    },
)

# Rows with a missing value in either of two columns.
SHIFTED = Input(
    "events",
    {
        "a": "CASE WHEN user_id % 2 = 0 THEN event_type END",
        "b": "CASE WHEN user_id % 2 = 1 THEN event_type END",
    },
)

# Chat turns as stored answers, none of which is JSON.
CHATS = Input(
    "conversations",
    {"conv_id": "conv_id", "turn": "turn", "response": "text"},
)

# Events as a history of reports.
HISTORY = Input(
    "events",
    {
        "dataset": "event_type",
        "kind": "CASE WHEN value > 50 THEN 'profile' ELSE 'validation' END",
        "run_ts": "ts",
        "run_id": "event_id",
        "content": "props",
    },
)

# Whole numbers beyond 2^53, neighbours of each other, and decimals, some of them tenfold.
LARGE = Input(
    "lineitem",
    {
        "key": "CAST(9007199254740992 AS BIGINT) + l_orderkey",
        "price": (
            "CAST(CASE WHEN l_tax = 0.03 AND l_quantity = 7.0 THEN l_extendedprice * 10 "
            "WHEN l_discount = 0.0 THEN NULL ELSE l_extendedprice END AS DECIMAL(14,2))"
        ),
        "serial": (
            "CAST(CAST(l_partkey AS DECIMAL(30,4)) "
            "+ CAST('123456789012345678901.0001' AS DECIMAL(30,4)) AS DECIMAL(30,4))"
        ),
        "far_key": (
            "CASE WHEN l_linenumber = 7 THEN CAST(-9007199254740993 AS BIGINT) "
            "ELSE CAST(9007199254740992 AS BIGINT) + l_suppkey END"
        ),
    },
)
