from collections import Counter

from pyspark.sql import functions as F

from tabvitals.llm import lines

SCHEMA = "doc_id int, source string, text string, bad string, n_lines string"
ROWS = [
    *[(i, "a", f"menu\nown {i}\n  menu \n\nlast", "x", "y") for i in range(4)],
    (4, "a", None, None, None),
    (5, "a", "", None, None),
    (6, "a", "menu", None, None),
    *[(7, "b", "menu\nfooter", None, None)] * 2,
    *[(10 + i, None, "same\n" + "z" * i, None, None) for i in range(3)],
    (20, "a", "long\n" * 5000 + "menu", None, None),
]


def expected(rows, ratio, least):
    pages = Counter(r[1] for r in rows)
    seen = Counter((r[1], x) for r in rows for x in {y.strip(" ") for y in (r[2] or "").split("\n")})
    out = []
    for key, host, text, *_ in rows:
        if text is None:
            out.append((key, host, None, 0, 0))
            continue
        parts = text.split("\n")
        kept = [
            x
            for x in parts
            if not x.strip(" ")
            or seen[host, x.strip(" ")] < least
            or seen[host, x.strip(" ")] <= ratio * pages[host]
        ]
        out.append((key, host, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return out


def test_against_brute_force(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    for ratio, least in ((0.1, 3), (0.5, 2), (0.9, 1)):
        got = lines.without_boilerplate(frame, ratio=ratio, min_pages=least)
        rows = [tuple(r) for r in got.select("doc_id", "source", "text", "n_lines", "n_dropped").collect()]
        assert sorted(rows, key=str) == sorted(expected(ROWS, ratio, least), key=str)


def test_other_columns_stay(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    assert lines.without_boilerplate(frame).columns == [
        "doc_id", "source", "text", "bad", "n_lines", "n_dropped",
    ]
    plain = lines.without_boilerplate(frame, counts=False)
    assert plain.columns == frame.columns
    assert plain.filter(F.col("n_lines") == "y").count() == 4


def test_empty_table(spark):
    assert lines.without_boilerplate(spark.createDataFrame([], SCHEMA)).count() == 0
