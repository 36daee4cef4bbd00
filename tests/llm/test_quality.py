import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabvitals.llm import quality

SPACE = " \t\n\v\f\r"


def counts(text):
    words = [w for w in "".join(" " if c in SPACE else c for c in text or "").split(" ") if w]
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if any(c not in SPACE for c in line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {
        i + j
        for i in range(len(words) - 4)
        if windows[tuple(words[i : i + 5])] > 1
        for j in range(5)
    }
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        again,
        len(inside),
        n < 10 or 100 * len(inside) > 20 * n,
    )


def texts():
    rnd = random.Random(1)
    pieces = ["a", "the", "und", "é日", "##", "x y", " ", "\x1c", "B!!", "1<2", "a b c d e f"]
    out = [None, "", " \n\t", "one", "a b c d e a b c d e", "a " * 9, "x\nx\n\nx", "w " * 30_000]
    for _ in range(300):
        n = rnd.choice([3, 12, 60])
        out.append("".join(rnd.choice(pieces) + rnd.choice([" ", "\n", "  ", "\r\n"]) for _ in range(n)))
    return out


def test_counts_against_brute_force():
    for text in texts():
        assert quality.measured(text)[:6] == counts(text), text


def plain_em(rows, rounds):
    """The label model, document by document."""
    post = [0.2 if min(r) < 0 else 0.9 for r in rows]
    for _ in range(rounds):
        g, b = [], []
        for j in range(len(rows[0])):
            yes_g = sum(p for p, r in zip(post, rows) if r[j] > 0) + 9.7
            no_g = sum(p for p, r in zip(post, rows) if r[j] < 0) + 0.3
            yes_b = sum(1 - p for p, r in zip(post, rows) if r[j] > 0) + 7
            no_b = sum(1 - p for p, r in zip(post, rows) if r[j] < 0) + 3
            right = min(max(yes_g / (yes_g + no_g), 0.9), 0.9995)
            g.append(right)
            b.append(min(max(no_b / (no_b + yes_b), 1 - right, 0.005), 0.995))
        good = min(max((sum(post) + 1) / (len(rows) + 2), 0.01), 0.99)
        post = []
        for r in rows:
            odds = math.log(good / (1 - good))
            for v, x, y in zip(r, g, b):
                odds += math.log(x / (1 - y)) if v > 0 else math.log((1 - x) / y) if v < 0 else 0
            post.append(1 / (1 + math.exp(-odds)))
    return post


def test_patterns_give_what_documents_give():
    rnd = random.Random(2)
    rows = [tuple(rnd.choice([1, 1, 1, 0, -1]) for _ in range(4)) for _ in range(200)]
    patterns = Counter(rows)
    votes = np.array(list(patterns), float)
    *_, post = quality.estimated(votes, np.array(list(patterns.values()), float), 30)
    by_pattern = dict(zip(patterns, post))
    assert [by_pattern[r] for r in rows] == pytest.approx(plain_em(rows, 30), rel=1e-9)


@pytest.mark.parametrize("share", [0.1, 0.3, 0.5, 0.9])
def test_share_of_good_documents_is_found_whatever_it_is(share):
    """Ten rules, of which four in five vote: right about 96 % of the good, 50 % of the bad."""
    rnd = np.random.default_rng(5)
    good = rnd.random(20_000) < share
    right = rnd.random((20_000, 10)) < np.where(good, 0.96, 0.5)[:, None]
    votes = np.where(rnd.random((20_000, 10)) < 0.8, np.where(right == good[:, None], 1, -1), 0)
    patterns, places, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    found, *_, post = quality.estimated(patterns.astype(float), counts.astype(float))
    kept = post[places.ravel()] >= 0.5
    assert abs(found - share) < 0.03
    assert (kept & ~good).sum() < 0.2 * kept.sum() and (kept & good).sum() > 0.8 * good.sum()


def test_edges(spark):
    rows = [(None if i == 3 else i % 40, t, "q", 1) for i, t in enumerate(texts())]
    frame = spark.createDataFrame(rows, "doc_id int, text string, kept string, measured int")
    out = quality.scored(frame).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (*[r[c] for c in quality.COUNTS], r.base_failed) == counts(r.text)
        assert not (r.kept and r.base_failed) and r.measured == 1
    stage = quality.without_rejects(frame)
    assert stage.columns == frame.columns and stage.filter("kept = 'q'").count() == sum(r.kept for r in out)
    assert quality.scored(frame.limit(0)).count() == 0


def test_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("quality", "label")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = quality.scored(docs).filter("NOT base_failed").join(labels, "doc_id")
    table = {(r.label, r.kept): r.n for r in rows.groupBy("label", "kept").agg(F.count("*").alias("n")).collect()}
    assert table.get((1, True), 0) >= 0.99 * (table.get((1, True), 0) + table.get((1, False), 0))
    assert table.get((0, False), 0) >= 0.9 * (table.get((0, True), 0) + table.get((0, False), 0))
