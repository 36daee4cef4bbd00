"""Groups of near-duplicate texts: MinHash buckets, star-shaped candidates, exact links.

A text's set are its distinct runs of some words (`spaced_words`); texts whose sets have a
similarity of 0.8 or more (in whole numbers: `100 * shared >= 80 * united`) are linked, and linked
texts form a group. Sets are 64-bit hashes of whole texts; links are confirmed on full sets.

1. Each text is sketched once (`sketch`). Texts with equal sets are one class, by a 128-bit
   fingerprint and partial aggregates, so copies cost nothing from here on.
2. Classes that share the bucket of a band are candidates. In each bucket the class that meets
   most others over all its buckets is the hub; it is usually the original that others were
   copied from. Candidates are the links from hub to member, a star: as many as members.
3. Links are confirmed, and their components found. Buckets whose members are all in one component
   by now are settled, the large ones among them.
4. In the other buckets, the members outside of the bucket's largest component are compared with
   all others, across components only and without writing pairs out: they are dealt into blocks, the
   members too, and a task gets a block of each and gives back links only. A pair is compared in the
   first band it shares, and buckets with the same members once. So no link between classes that
   share a bucket is lost, no group meets in one task, and an outsider in a large family costs as
   many comparisons as the family has members.

Two sets at the limit share no bucket with a probability of 5e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabvitals.llm.common import (
    WordHashes,
    fresh,
    in_few_tasks,
    shingle_hashes,
    spaced_words,
    written,
)
from tabvitals.llm.components import components
from tabvitals.llm.sketch import band_keys, fingerprint

WIDTH = 5  # words in a shingle
PERCENT = 80  # least similarity
BLOCK = 1024  # outsiders of a bucket that a task compares with as many members


def shingles(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """The sorted set of a text. With fewer words it is the whole sequence; without any, empty."""
    return np.unique(shingle_hashes(hashes.of(spaced_words(text)), width))


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    shared = small + large - len(np.unique(np.concatenate([a, b])))
    return 100 * shared >= percent * (small + large - shared)


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, row_hash, text_hash and text: the two hashes tell rows apart, if they differ."""
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return source.select("key", *_hashes(F.col("key"), F.col("text")), "text")


def _hashes(key: Column, text: Column) -> tuple[Column, Column]:
    return (
        F.xxhash64(F.isnull(key), key, text).alias("row_hash"),
        F.xxhash64(text, F.lit(1)).alias("text_hash"),
    )


def sketched(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Written, per row: key, both hashes, n_shingles, print and bands (null without words)."""
    source = identified(docs, key, text)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            counts, prints, bands = [], [], []
            for one in batch.column(3):
                found = shingles(one.as_py(), width, hashes)
                counts.append(len(found))
                prints.append(fingerprint(found) if len(found) else None)
                bands.append(band_keys(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(counts, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["key", "row_hash", "text_hash", "n_shingles", "print", "bands"],
            )

    kind = source.schema["key"].dataType.simpleString()
    rows = source.mapInArrow(
        sketch,
        f"key {kind}, row_hash bigint, text_hash bigint, n_shingles bigint, print binary, "
        "bands array<bigint>",
    )
    return written(rows, "sketches")


def classes(sketches: DataFrame) -> DataFrame:
    """Written, per different set: node (a number of its own), print, and one of its texts.

    That is the text with the smallest key (null keys last), then the smallest hash.
    """
    columns = ["key", "text_hash", "row_hash", "n_shingles", "bands"]
    one = F.struct(F.isnull("key").alias("no_key"), *columns)
    found = (
        sketches.filter("print IS NOT NULL")
        .groupBy("print")
        .agg(F.min(one).alias("one"))
        .select("print", *[f"one.{c}" for c in columns])
    )
    return written(found.withColumn("node", F.monotonically_increasing_id()), "classes")


def members(nodes: DataFrame) -> DataFrame:
    """Written: the classes of each bucket that has several, and the bucket's size."""
    rows = nodes.select("node", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    return written(rows.join(sizes, "bucket"), "members")


def stars(found: DataFrame) -> DataFrame:
    """Candidates: hub a and member b of each bucket, each pair once, with sizes that can do."""
    centre = found.groupBy("node").agg(F.sum("size").alias("met"))
    hubs = (
        found.join(centre, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("met", (-F.col("node")).alias("minus"), "n_shingles")).alias("hub"))
        .select("bucket", (-F.col("hub.minus")).alias("a"), F.col("hub.n_shingles").alias("n_a"))
    )
    least, most = F.least("n_a", "n_shingles"), F.greatest("n_a", "n_shingles")
    return (
        found.join(hubs, "bucket")
        .filter((F.col("node") != F.col("a")) & (100 * least >= PERCENT * most))
        .select("a", F.col("node").alias("b"))
        .distinct()
    )


def texts_of(docs: DataFrame, key: str, text: str, nodes: DataFrame) -> DataFrame:
    """Written: node and text of each class in `nodes` (node and both hashes)."""
    source = identified(docs, key, text).drop("key")
    found = source.join(nodes, ["row_hash", "text_hash"]).dropDuplicates(["row_hash", "text_hash"])
    return written(found.select("node", "text"), "texts")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Written: the pairs (a, b) that are linked."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, kept = WordHashes(), {}
        for batch in batches:
            a, text_a, text_b = batch.column(0), batch.column(2), batch.column(3)
            mask = []
            for i in range(batch.num_rows):
                node = a[i].as_py()
                if node not in kept:
                    if len(kept) >= 64:  # hubs come up often
                        kept.clear()
                    kept[node] = shingles(text_a[i].as_py(), width, hashes)
                other = shingles(text_b[i].as_py(), width, hashes)
                mask.append(linked(kept[node], other, percent))
            yield batch.select([0, 1]).filter(pa.array(mask, pa.bool_()))

    rows = both.select("a", "b", "text_a", "text_b").mapInArrow(confirm, "a bigint, b bigint")
    return written(rows, "links")


def open_buckets(labelled: DataFrame) -> DataFrame:
    """Buckets whose members are in several components: bucket, band, largest, n and n_outside.

    Of buckets with the same members the first stays. `largest` is the component with the most
    members (n_outside are in others), of equal ones that with the largest number.
    """
    parts = labelled.groupBy("bucket", "component").agg(
        F.count("*").alias("n"),
        F.min("band").alias("band"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
    )
    buckets = (
        parts.groupBy("bucket")
        .agg(
            F.max(F.struct("n", "component")).alias("top"),
            F.count("*").alias("components"),
            F.sum("n").alias("n"),
            F.min("band").alias("band"),
            F.bit_xor("one").alias("one"),
            F.bit_xor("two").alias("two"),
        )
        .filter("components > 1")
    )
    n_outside = (F.col("n") - F.col("top.n")).alias("n_outside")
    kept = F.min(F.struct("band", "bucket", "top.component", n_outside))
    return (
        buckets.groupBy("one", "two", "n")
        .agg(kept.alias("kept"))
        .select(
            F.col("kept.bucket").alias("bucket"),
            F.col("kept.band").alias("band"),
            F.col("kept.component").alias("largest"),
            "n",
            F.col("kept.n_outside").alias("n_outside"),
        )
    )


def dealt(labelled: DataFrame, buckets: DataFrame) -> DataFrame:
    """A row for each task that a member takes part in, with the outsiders' block and the members'.

    `asks` members are compared with all in the task that are `asked`, an outsider with other
    outsiders of larger numbers only.
    """
    members = F.ceil(F.col("n") / BLOCK).cast("int")
    outsiders = F.ceil(F.col("n_outside") / BLOCK).cast("int")
    rows = labelled.join(buckets, "bucket").select(
        "bucket",
        "band",
        "node",
        "n_shingles",
        "component",
        (F.col("component") != F.col("largest")).alias("outside"),
        F.pmod(F.xxhash64("node"), members).cast("int").alias("mine"),
        F.pmod(F.xxhash64("node", F.lit(1)), outsiders).cast("int").alias("own"),
        members.alias("members"),
        outsiders.alias("outsiders"),
    )

    def task(low: Column, high: Column, asks: Column, asked: Column) -> Column:
        return F.struct(
            low.alias("low"), high.alias("high"), asks.alias("asks"), asked.alias("asked")
        )

    outside, own, mine = F.col("outside"), F.col("own"), F.col("mine")
    as_member = F.transform(
        F.sequence(F.lit(0), F.col("outsiders") - 1),
        lambda low: task(low, mine, outside & (low == own), F.lit(True)),
    )
    elsewhere = F.filter(F.sequence(F.lit(0), F.col("members") - 1), lambda high: high != mine)
    as_outsider = F.transform(elsewhere, lambda high: task(own, high, F.lit(True), F.lit(False)))
    tasks = F.when(outside, F.concat(as_member, as_outsider)).otherwise(as_member)
    return rows.select(
        "bucket", "band", "node", "n_shingles", "component", "outside", F.inline(tasks)
    )


def rest(
    found: DataFrame,
    nodes: DataFrame,
    texts: DataFrame,
    labels: DataFrame,
    width: int,
    percent: int,
) -> DataFrame:
    """Written: links (a, b) between components, from buckets whose members are in several."""
    labelled = found.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    labelled = written(labelled, "labelled")
    tasks = dealt(labelled.drop("band"), written(in_few_tasks(open_buckets(labelled)), "open"))
    rows = tasks.join(nodes.select("node", "bands"), "node").join(texts, "node")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", ignore_index=True)
        hashes, sets = WordHashes(), {}
        band = int(group["band"].iloc[0])
        bands = np.array(group["bands"].tolist(), np.int64)
        nodes, sizes = group["node"].to_numpy(), group["n_shingles"].to_numpy()
        own, outside = group["component"].to_numpy().copy(), group["outside"].to_numpy()
        asked, links = group["asked"].to_numpy(), []

        def set_of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles(group["text"].iloc[i], width, hashes)
            return sets[i]

        for i in np.flatnonzero(group["asks"]).tolist():
            others = np.flatnonzero(
                asked
                & (own != own[i])
                & (~outside | (nodes > nodes[i]))
                & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
            )
            others = others[(bands[others] == bands[i]).argmax(axis=1) == band]
            for j in others.tolist():
                if own[j] != own[i] and linked(set_of(i), set_of(j), percent):
                    links.append((nodes[i], nodes[j]))
                    own[own == own[j]] = own[i]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    pairs = rows.groupBy("bucket", "low", "high").applyInPandas(compare, "a bigint, b bigint")
    return written(pairs, "links")


def grouped(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """A row per row of the input: key, n_shingles, component_id, kept, group and both hashes.

    `component_id` is the smallest key of the group, `kept` whether the key is that key. Null and
    empty texts and those of white space have no shingles and form no groups: their component is
    their own key, and they are kept. Rows without a key are grouped like others but never give
    their group its id; a group without any key has a null id, and its rows are kept. Rows that
    repeat a key are kept together. `group` is a number of the group, null for texts without words;
    it may differ from run to run. Other columns are ignored; an empty table gives none.
    """
    sketches = sketched(docs, key, text, width)
    nodes = classes(sketches)
    found = members(nodes)
    candidates = nodes.join(found.select("node").distinct(), "node", "left_semi")
    texts = texts_of(docs, key, text, candidates.select("node", "row_hash", "text_hash"))
    links = confirmed(stars(found), texts, width, percent)
    labels = components(links)
    late = rest(found, nodes, texts, labels, width, percent)
    labels = components(links.union(late))
    firsts = (
        labels.join(nodes.select("node", "key"), "node")
        .groupBy("component")
        .agg(F.min("key").alias("component_id"))
    )
    ids = labels.join(firsts, "component").select("node", "component", "component_id")
    resolved = nodes.join(ids, "node", "left").select(
        "print",
        F.coalesce("component", "node").alias("group"),
        F.when(F.col("component").isNull(), F.col("key"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    )
    rows = sketches.drop("bands").join(resolved, "print", "left")
    component = F.when(F.col("print").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return rows.select(
        F.col("key").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
        "group",
        "row_hash",
        "text_hash",
    )


def without_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """One row of each group, with all columns of the documents, and all rows without words.

    It is a row with the group's smallest key; of several, one with the smallest hash of its text.
    Of rows that repeat a key and a text with words, one stays.
    """
    row_hash, text_hash = fresh(docs, "row_hash"), fresh(docs, "text_hash")
    firsts = (
        grouped(docs, key, text, width, percent)
        .filter("kept AND group IS NOT NULL")
        .groupBy("group")
        .agg(F.min(F.struct("text_hash", "row_hash")).alias("first"))
        .select(
            F.col("first.row_hash").alias(row_hash), F.col("first.text_hash").alias(text_hash)
        )
    )
    own, words = _hashes(F.col(f"`{key}`"), F.col(f"`{text}`"))
    rows = docs.withColumn(row_hash, own).withColumn(text_hash, words)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    kept = rows.join(firsts, [row_hash, text_hash]).dropDuplicates([row_hash, text_hash])
    wordless = F.coalesce(~F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    return kept.select(*columns).unionAll(docs.filter(wordless))
