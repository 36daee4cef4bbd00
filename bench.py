"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of cores.
"""

import json
import os
import sys
import tempfile
import time
from pathlib import Path
from statistics import median

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog.queries import QUERIES  # noqa: E402

try:  # the folders of the text operators can be taken away
    from tabvitals.llm.queries import QUERIES as TEXT_QUERIES
except ModuleNotFoundError:
    TEXT_QUERIES = {}

HEADLINE = [
    "overview",
    "column_types",
    "first_rows",
    "null_profile",
    "duplicate_profile",
    "key_duplicates",
    "outlier_profile",
    "outlier_profile_all_numeric",
    "rule_profile",
    "exploration_checks",
    "health_score",
    "validation_results",
    "describe",
    "describe_timestamps",
    "value_counts",
    "taxi_rules",
    "taxi_validation",
    "taxi_outliers",
    "taxi_duplicates",
    "findings",
    "findings_text",
    "latest_report",
    "issues",
]


#: One run each; the total is of the headline queries alone, as in earlier rounds.
LATER = ["quantile_profile", "null_profile_by_day", "outlier_profile_by_flag", "merged_null_profile"]


def session(cpus: str, checkpoints: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", checkpoints)
        # Call sites for error messages double the time it takes to build small queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    with tempfile.TemporaryDirectory() as checkpoints:
        run(session(os.environ.get("BENCH_CPUS", str(os.cpu_count())), checkpoints))


def run(spark: SparkSession) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    QUERIES["null_summary"](spark, folder).collect()  # starts the JVM's code paths
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(median(runs), 3)
    total = round(sum(seconds.values()), 3)
    for name, query in ({n: QUERIES[n] for n in LATER} | TEXT_QUERIES).items():
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of the headline queries, each the median of three runs to no sink",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
