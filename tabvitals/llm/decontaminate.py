"""Passages of benchmark items in documents, also edited ones.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the lower-cased (A-Z) text. A document holds an
item of n words if some run of its words is at most `0.2 * n` word edits (insertions, deletions,
replacements) away from it.

The edit distance is made a Hamming distance by random walks (the CGK embedding): a pointer runs
over the words of a window; at each of 3n steps the word under it is put out, and a random bit of
word and step says whether the pointer moves on. Strings with few edits between them fall back
into step, so most of their output agrees. The walks are repeated with other random bits, and each
output is sampled at a few steps several times; a window whose sample equals that of an item of
its size is a candidate. With `WALKS * SAMPLES` tries, over 99 % of the windows at the largest
distance become candidates (measured in the tests). Candidates are verified by their edit distance.

That holds for few edits only, so an item of more than `PIECE` words is embedded in pieces of about
equal size. The limits of the pieces add up to no less than that of the item, so in every match
some piece is within its own. What becomes a candidate by a piece is verified as a whole item.

Windows have the size of pieces. They are opened where a run of up to three words stands in both:
n words with k edits keep a run of `(n - k) / (k + 1)` words, so every match has such a place.

Plan: one pass over the documents in Arrow batches, without shuffle. Items are the stated query
set: they go to the executors in blocks of at most `BLOCK_WORDS` words, one pass for each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabvitals.llm.common import WordHashes, mixed, plain_words, shingle_hashes

EDITS = 0.2  # of the words of an item
WALKS, SAMPLES, STEPS = 12, 12, 4  # walks, samples of each, steps in a sample
PIECE = 60  # words that are embedded together, at most
BLOCK_WORDS = 2_000_000  # of items: 16 MB of hashes
_SEED_WORDS = 3
_PAD = np.uint64(0)


def most_edits(n_words: int) -> int:
    return int(EDITS * n_words)


def pieces(n_words: int) -> list[tuple[int, int]]:
    """The first word and the size of each piece of an item; together they are the item.

    A match in which every piece has more than `EDITS` of its size has more than that of them all.
    """
    n = -(-n_words // PIECE)
    return [(a, b - a) for a, b in pairwise(i * n_words // n for i in range(n + 1))]


def seed_words(n_words: int) -> int:
    """How many words in a row every match of a piece of this length shares with it, up to 3."""
    k = most_edits(n_words)
    return min(_SEED_WORDS, -(-(n_words - k) // (k + 1)))


def walked(windows: np.ndarray, sizes: np.ndarray, walk: int) -> np.ndarray:
    """The output of a walk over each window (a row of word hashes), 3 steps a word of the widest.

    Beyond the end of its window a walk puts out padding.
    """
    n, width = windows.shape
    rows, at = np.arange(n), np.zeros(n, np.int64)
    out = np.full((n, 3 * width), _PAD)
    padded = np.hstack([windows, np.full((n, 1), _PAD)])
    for step in range(3 * width):
        inside = at < sizes
        word = padded[rows, np.where(inside, at, width)]
        out[:, step] = word
        salt = mixed(np.array([(walk + 1) << 32 | step], np.uint64))
        at += (mixed(word ^ salt) >> np.uint64(63)).astype(np.int64)
    return out


def _steps(walk: int, sample: int) -> np.ndarray:
    """Where an output is sampled, as shares of its length.

    A walk moves at every other step, so it has left its window after about two thirds of its
    steps; padding, in which all walks agree, is not sampled.
    """
    return np.random.default_rng([walk, sample]).random(STEPS) * 2 / 3


def buckets(windows: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """For each walk and sample, the bucket of each window; windows of other sizes never meet."""
    rows = np.arange(len(windows))
    for walk in range(WALKS):
        out = walked(windows, sizes, walk)
        for sample in range(SAMPLES):
            key = mixed(sizes.astype(np.uint64) + np.uint64((walk << 16 | sample) + 1))
            with np.errstate(over="ignore"):
                for share in _steps(walk, sample):
                    step = (share * 3 * sizes).astype(np.int64)
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + out[rows, step])
            yield key


def least_edits(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """The least edits from an item to any run of the words, and where the first such run ends."""
    row = np.zeros(len(words) + 1, np.int64)
    places = np.arange(len(words) + 1)
    for i, word in enumerate(item, 1):
        best = np.empty_like(row)
        best[0] = i
        best[1:] = np.minimum(row[:-1] + (words != word), row[1:] + 1)
        row = np.minimum.accumulate(best - places) + places
    end = int(row.argmin())
    return int(row[end]), end


@dataclass(frozen=True)
class Buckets:
    """The pieces of each bucket of one sample."""

    keys: np.ndarray
    pieces: dict[int, list[int]]


@dataclass(frozen=True)
class Index:
    """A block of items: their words and pieces (item, first word, size), and of these the places
    of their seeds, and their buckets."""

    ids: list
    items: list[np.ndarray]
    pieces: list[tuple[int, int, int]]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    buckets: list[Buckets]


def _table(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in rows], np.int64)
    table = np.full((len(rows), max(sizes, default=0)), _PAD)
    for i, row in enumerate(rows):
        table[i, : len(row)] = row
    return table, sizes


def indexed(block: list[tuple[object, str | None]]) -> Index:
    """The index of a block of items (id, text); items without words match nothing."""
    hashes = WordHashes()
    pairs = [(i, hashes.of(plain_words(text))) for i, text in block]
    pairs = [(i, words) for i, words in pairs if len(words)]
    items = [words for _, words in pairs]
    parts = [(n, a, size) for n, words in enumerate(items) for a, size in pieces(len(words))]
    texts = [items[n][a : a + size] for n, a, size in parts]
    seeds = {}
    for q in range(1, _SEED_WORDS + 1):
        found = [
            (seed, at, n)
            for n, words in enumerate(texts)
            if seed_words(len(words)) == q
            for at, seed in enumerate(shingle_hashes(words, q).tolist())
        ]
        if found:
            found.sort()
            seed = np.array([f[0] for f in found], np.uint64)
            at, n = (np.array([f[i] for f in found], np.int64) for i in (1, 2))
            known = np.zeros(1 << max(16, int(len(seed) * 16).bit_length()), bool)
            known[(seed & np.uint64(len(known) - 1)).astype(np.int64)] = True
            seeds[q] = (known, seed, at, n)
    maps = []
    if items:
        for keys in buckets(*_table(texts)):
            table: dict[int, list[int]] = {}
            for n, key in enumerate(keys.tolist()):
                table.setdefault(key, []).append(n)
            maps.append(Buckets(np.unique(keys), table))
    return Index([i for i, _ in pairs], items, parts, seeds, maps)


def _windows(index: Index, words: np.ndarray) -> list[tuple[int, int]]:
    """Starts and sizes of windows that share a seed with a piece, each once."""
    out = set()
    for q, (known, seed, at, n) in index.seeds.items():
        if len(words) < q:
            continue
        here = shingle_hashes(words, q)
        places = np.flatnonzero(known[(here & np.uint64(len(known) - 1)).astype(np.int64)])
        low = np.searchsorted(seed, here[places], "left")
        high = np.searchsorted(seed, here[places], "right")
        for place, a, b in zip(places.tolist(), low.tolist(), high.tolist(), strict=True):
            for j in range(a, b):
                out.add((place - int(at[j]), index.pieces[n[j]][2]))
    return sorted(out)


#: Windows are embedded so many at a time, which bounds the memory of a batch.
_WINDOWS = 8192


def _embedded(
    index: Index, texts: list[np.ndarray], opened: list[tuple[int, int, int]]
) -> set[tuple[int, int, int]]:
    """Candidates among windows (text, start, size): text, item, and where the item would start.

    The window and a piece of the item are in equal buckets.
    """
    sizes = np.array([size for _, _, size in opened], np.int64)
    table = np.full((len(opened), int(sizes.max())), _PAD)
    for i, (text, start, size) in enumerate(opened):
        words = texts[text][max(start, 0) : max(start + size, 0)]
        table[i, : len(words)] = words
    out = set()
    for keys, known in zip(buckets(table, sizes), index.buckets, strict=True):
        for i in np.flatnonzero(np.isin(keys, known.keys)).tolist():
            text, start, _ = opened[i]
            for piece in known.pieces[int(keys[i])]:
                n, first, _ = index.pieces[piece]
                out.add((text, n, start - first))
    return out


def _ranges(
    index: Index, candidates: set[tuple[int, int, int]]
) -> Iterator[tuple[int, int, int, int]]:
    """Text, item, and the words to search for it: overlapping ranges of an item are one."""
    last = None
    for text, n, start in sorted(candidates):
        size = len(index.items[n])
        left, right = max(start - most_edits(size), 0), max(start + size + most_edits(size), 0)
        if last and last[:2] == (text, n) and left <= last[3]:
            last = (text, n, last[2], right)
            continue
        if last:
            yield last
        last = (text, n, left, right)
    if last:
        yield last


def matches(index: Index, texts: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
    """Text, item, fewest edits and where the first such passage ends, by text and item."""
    opened = [(i, s, n) for i, words in enumerate(texts) for s, n in _windows(index, words)]
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for begin in range(0, len(opened), _WINDOWS):
        candidates = _embedded(index, texts, opened[begin : begin + _WINDOWS])
        for text, n, left, right in _ranges(index, candidates):
            edits, end = least_edits(index.items[n], texts[text][left:right])
            if edits <= most_edits(len(index.items[n])):
                now = (edits, left + end)
                best[text, n] = min(best.get((text, n), now), now)
    return [(*at, edits, end) for at, (edits, end) in sorted(best.items())]


def blocks(items: DataFrame, key: str, text: str, most_words: int = BLOCK_WORDS) -> Iterator[Index]:
    """Indexes of the items, so many words at a time."""
    block, size = [], 0
    rows = items.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    for row in rows.orderBy("key", "text").toLocalIterator():
        block.append((row["key"], row["text"]))
        size += len(plain_words(row["text"]))
        if size >= most_words:
            yield indexed(block)
            block, size = [], 0
    yield indexed(block)


def found(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    most_words: int = BLOCK_WORDS,
) -> DataFrame:
    """A row per document and item in it: both keys, n_words and edits of the item, end_word.

    `end_word` is the number of words of the document up to the end of the passage with the fewest
    edits (the first of them). Null and empty texts hold nothing, and null or empty items are held
    by nothing. Repeated documents or items give repeated rows; rows without keys are rows like
    others; other columns are ignored. Whole texts are searched, however long.
    """
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kinds = (
        source.schema["key"].dataType.simpleString(),
        items.schema[item_key].dataType.simpleString(),
    )
    context = docs.sparkSession.sparkContext
    parts = [
        _searched(source, context.broadcast(block), *kinds)
        for block in blocks(items, item_key, item_text, most_words)
    ]
    rows = reduce(DataFrame.unionAll, parts)
    return rows.toDF(key, item_key, "n_words", "edits", "end_word")


def _searched(source: DataFrame, index, key_kind: str, item_kind: str) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        schema = None
        for batch in batches:
            block = index.value
            ids = pa.array(block.ids, _ARROW[item_kind])
            rows, which, n_words, edits, ends = [], [], [], [], []
            texts = [hashes.of(plain_words(text.as_py())) for text in batch.column(1)]
            for i, n, e, end in matches(block, texts):
                rows.append(i)
                which.append(n)
                n_words.append(len(block.items[n]))
                edits.append(e)
                ends.append(end)
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                ids.take(pa.array(which, pa.int64())),
                *[pa.array(c, pa.int64()) for c in (n_words, edits, ends)],
            ]
            schema = schema or ["key", "item", "n_words", "edits", "end_word"]
            yield pa.RecordBatch.from_arrays(columns, schema)

    return source.mapInArrow(
        search,
        f"key {key_kind}, item {item_kind}, n_words bigint, edits bigint, end_word bigint",
    )


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def holds(
    text: Column,
    items: DataFrame,
    item_key: str = "item_id",
    item_text: str = "text",
    most_words: int = BLOCK_WORDS,
) -> Column:
    """Whether a text holds an item; false for null and empty texts."""
    context = items.sparkSession.sparkContext

    def one(index) -> Column:
        @F.pandas_udf("boolean")
        def any_match(texts: pd.Series) -> pd.Series:
            hashes = WordHashes()
            words = [hashes.of(plain_words(t)) for t in texts]
            out = np.zeros(len(words), bool)
            out[[i for i, *_ in matches(index.value, words)]] = True
            return pd.Series(out)

        return any_match(text)

    parts = [one(context.broadcast(b)) for b in blocks(items, item_key, item_text, most_words)]
    return reduce(Column.__or__, parts)
