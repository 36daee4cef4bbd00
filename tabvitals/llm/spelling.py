"""Spelling variants: words of a corpus that differ by one character, led back to a frequent form.

Two words are near if one inserted, deleted or replaced code point makes them equal. Then a word's
first half is a prefix of the other word, or its second half a suffix, exactly; so words meet in
blocks dealt by such halves. Each block is a bidirectional FM-index (`fm_index`) of its words. The
search scheme matches the half as it is, from its delimiter on, and goes on across the other half
with one error; intervals of suffix ranks shrink as symbols are added on either side. A pair that
both halves would find counts on the side of the first.

1. Words are counted: each task counts its own texts, Spark adds up.
2. Words are dealt to blocks by halves, an index entry per half that a near word could ask for.
   Small halves share a block; one whose words have more than `BLOCK` characters is dealt to
   several, each of which is asked. Blocks give back a row per word: how many near words, the
   most frequent one. Pairs are never written out.
3. Forms are followed to the last by doubling; a form has five times the word's count, so there
   are few steps.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabvitals.llm.common import written
from tabvitals.llm.fm_index import LEFT, RIGHT, BidirectionalIndex

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
BLOCK = 400_000  # characters of a block's index
KEPT = 200_000  # different words that a task counts before it passes them on
QUERIES = 4096  # words searched together

_LOWER = {c: c + 32 for c in range(65, 91)}


def lowered(text: str) -> str:
    """A-Z in lower case; other characters as they are."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def word_of(prefix: int, run: str, thin: int | None) -> str:
    """The run, or without one character if its checksum (begun with `prefix`) is divisible."""
    if thin:
        checksum = zlib.crc32(run.encode(), prefix)
        if checksum % thin == 0:
            at = checksum % len(run)
            return run[:at] + run[at + 1 :]
    return run


def counted(docs: DataFrame, key: str, text: str, thin: int | None) -> DataFrame:
    """A row per word that is long and frequent enough: word and n."""
    source = docs.select(F.col(f"`{key}`").cast("string"), F.col(f"`{text}`"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed_on() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()), pa.array(counts.values(), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        counts: Counter[str] = Counter()
        for batch in batches:
            for one, cell in zip(batch.column(0), batch.column(1), strict=True):
                prefix = zlib.crc32(f"{one.as_py() or ''}:".encode())
                found = Counter(RUN.findall(lowered(cell.as_py() or "")))
                for run, n in found.items():
                    word = word_of(prefix, run, thin)
                    if len(word) >= LEAST_LENGTH:
                        counts[word] += n
                if len(counts) >= KEPT:
                    yield passed_on()
        yield passed_on()

    rows = source.mapInArrow(count, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _dealt(words: DataFrame, block: int) -> DataFrame:
    """Rows for the blocks: side, bucket, part, word, n, whether it asks and whether it is asked."""
    size = F.length("word")
    half = F.expr("length(word) div 2")
    # A near word has as many characters, or one more or less; its first half ends accordingly.
    before, after = F.expr("(length(word) - 1) div 2"), F.expr("(length(word) + 1) div 2")
    other = F.when(before < half, before).otherwise(after)

    def entry(side: int, first: F.Column, asks: bool) -> F.Column:
        text = F.substring("word", F.lit(1), first)
        if side == LEFT:  # the second half of a word as long as this one is, or nearly
            text = F.substring("word", first + 1, size)
        return F.struct(
            F.lit(side).alias("side"),
            F.when(F.lit(side) == RIGHT, first).otherwise(size - first).alias("length"),
            text.alias("text"),
            F.lit(asks).alias("asks"),
        )

    # A second half has half the characters, rounded up: of n characters, n - n div 2.
    entries = [entry(RIGHT, half, True), entry(RIGHT, other, False), entry(LEFT, half, True)]
    late = F.when(size % 2 == 0, half - 1).otherwise(half + 1)
    entries += [entry(LEFT, late, False)]
    rows = words.select("word", "n", F.explode(F.array(*entries)).alias("e"))
    rows = rows.select("word", "n", "e.side", "e.asks", F.xxhash64("e.length", "e.text").alias("h"))
    total = words.agg(F.sum(size + 1)).first()[0] or 0
    buckets = max(1, 4 * total // block)
    large = (
        rows.groupBy("side", "h")
        .agg(F.sum(size + 1).alias("load"))
        .filter(F.col("load") > block)
        .select("side", "h", F.ceil(F.col("load") / block).cast("int").alias("parts"))
    )
    rows = rows.join(large, ["side", "h"], "left")
    hot = F.col("parts").isNotNull()
    own = F.when(hot, F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts"))).otherwise(0)
    asked = F.when(F.col("asks") & hot, F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.withColumn("own", own.cast("int"))
    rows = rows.withColumn("part", F.explode(F.coalesce(asked, F.array("own"))))
    return rows.select(
        "side",
        F.when(hot, F.col("h")).otherwise(F.pmod("h", F.lit(buckets))).alias("bucket"),
        "part",
        "word",
        "n",
        "asks",
        (F.col("part") == F.col("own")).alias("asked"),
    )


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per word that has any: word, n_near, and the near word `near` of largest n (`near_n`).

    Of several, that is the smallest in code-point order.
    """

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        side = int(rows["side"].iloc[0])
        indexed = rows[rows["asked"]].drop_duplicates("word").sort_values("word")
        asking = rows[rows["asks"]].drop_duplicates("word")["word"].tolist()
        entries, n = indexed["word"].tolist(), indexed["n"].to_numpy()
        index = BidirectionalIndex(entries)
        word, n_near, best = [], [], []
        for i in range(0, len(asking), QUERIES):
            queries = asking[i : i + QUERIES]
            halves = [len(w) // 2 for w in queries]
            exact = [h if side == RIGHT else len(w) - h for w, h in zip(queries, halves, strict=True)]
            at, to = index.near(queries, np.array(exact), side)
            if side == LEFT:  # those that share the first half were found by it
                late = [
                    not entries[b].startswith(queries[a][: halves[a]])
                    for a, b in zip(at.tolist(), to.tolist(), strict=True)
                ]
                at, to = at[late], to[late]
            order = np.lexsort((to, -n[to], at))
            at, to = at[order], to[order]
            asked, first, found = np.unique(at, return_index=True, return_counts=True)
            word += [queries[a] for a in asked]
            n_near += found.tolist()
            best += to[first].tolist()
        columns = {
            "word": pd.Series(word, dtype=object),
            "n_near": pd.Series(n_near, dtype="int64"),
            "near": pd.Series([entries[b] for b in best], dtype=object),
            "near_n": pd.Series(n[best], dtype="int64"),
        }
        return pd.DataFrame(columns)

    schema = "word string, n_near bigint, near string, near_n bigint"
    found = _dealt(words, block).groupBy("side", "bucket", "part").applyInPandas(search, schema)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", F.col("best.near"), (-F.col("best.minus")).alias("near_n"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of every word that has a form (word, form)."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        beyond = roots.select(F.col("word").alias("root"), F.col("root").alias("far"))
        roots = written(
            roots.join(beyond, "root", "left").select(
                "word", F.coalesce("far", "root").alias("root"), F.isnotnull("far").alias("moved")
            ),
            "roots",
        )
        moved = roots.filter("moved").limit(1).count()
        roots = roots.select("word", "root")
        if not moved:
            return roots


def grouped(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    thin: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """A row per word: word, form, root, n, n_near and form_n.

    Words are the runs of letters (`RUN`, A-Z in lower case) of whole texts with at least six
    characters and five occurrences. A word's form is its most frequent near word, if that is five
    times as frequent; its root is where forms lead. With `thin`, a run whose checksum with the
    row's key is divisible by it loses a character, which plants misspellings.

    Null and empty texts have no words; a row without a key has an empty text for its key. Repeated
    rows count again. Of near words of the same count the smallest is the form. Runs of any length
    are words. Other columns are ignored, and an empty table gives no rows.
    """
    words = written(counted(docs, key, text, thin), "words")
    near = near_words(words, block)
    is_form = F.col("near_n") >= TIMES * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"),
        F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    rows = written(rows, "forms")
    roots = _roots(rows.filter("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
