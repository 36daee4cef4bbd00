"""Licences named in texts: ordered signature rules behind a keyword filter.

A text is reduced to words, lower-cased and joined by single spaces. One pass of an Aho-Corasick
automaton finds the keywords of all rules in it; only rules whose keywords are all there are tried.
Their matches are detections over intervals of words. Overlaps are resolved in order of priority,
then length, then place in the text, then order of the rules: a detection goes if its interval
lies within that of one that was taken before it. So "Licensed under CC BY-NC-SA 4.0" is one
detection, not also those of "CC BY-NC" and "CC BY".

Plan: one pass over the texts in Arrow batches; no shuffle, and no row needs another.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabvitals.llm.common import plain_words
from tabvitals.llm.license_rules import Rule, rules

#: Phrases (words that stand one after another) and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

Detection = tuple[int, int, str, str, float]  # start and end in words, label, rule, score

_DETECTIONS = pa.list_(
    pa.struct(
        [
            ("start_word", pa.int64()),
            ("end_word", pa.int64()),
            ("label", pa.string()),
            ("rule", pa.string()),
            ("score", pa.float64()),
        ]
    )
)
_PLACES = pa.list_(pa.struct([("start_word", pa.int64()), ("label", pa.string())]))


_CELL = 64  # words


class Scanner:
    def __init__(self, signatures: list[Rule]):
        self.rules = signatures
        self.automaton = ahocorasick.Automaton()
        for word in {w for r in signatures for group in r.keywords for w in group}:
            self.automaton.add_word(word, word)
        self.automaton.make_automaton()

    def detections(self, joined: str) -> list[Detection]:
        """All detections in joined words that no better one contains, by their start."""
        if not joined:
            return []
        seen = {word for _, word in self.automaton.iter(f" {joined} ")}
        if not seen:
            return []
        hits = [
            (rule.priority, order, match.span())
            for order, rule in enumerate(self.rules)
            if all(group & seen for group in rule.keywords)
            for match in rule.pattern.finditer(joined)
        ]
        if not hits:
            return []
        places = word_numbers(joined, [at for *_, span in hits for at in span])
        found = []
        for (priority, order, _), start, last in zip(hits, places[::2], places[1::2], strict=True):
            found.append((-priority, start - last - 1, start, order, last + 1))
        taken: dict[int, list[tuple[int, int]]] = {}  # by cells of the text that they reach into
        kept = []
        for _, _, start, order, end in sorted(found):
            if not any(a <= start and end <= b for a, b in taken.get(start // _CELL, ())):
                for cell in range(start // _CELL, (end - 1) // _CELL + 1):
                    taken.setdefault(cell, []).append((start, end))
                rule = self.rules[order]
                kept.append((start, end, rule.label, rule.name, rule.score))
        return sorted(kept)


@cache
def scanner() -> Scanner:
    return Scanner(rules())


def word_numbers(joined: str, places: list[int]) -> list[int]:
    """The number of the word that each place of a character lies in or ends."""
    if not places:
        return []
    letters = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    return np.searchsorted(np.flatnonzero(letters == 32), places).tolist()


def base_places(joined: str, phrases: dict[str, str]) -> list[tuple[int, str]]:
    """Where the words of a phrase stand one after another: first word and label."""
    places, labels = [], []
    padded = f" {joined} "
    for phrase, label in phrases.items():
        at = padded.find(f" {phrase} ")
        while at >= 0:
            places.append(at)
            labels.append(label)
            at = padded.find(f" {phrase} ", at + 1)
    return sorted(zip(word_numbers(padded, places), labels, strict=True))


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of the input: key, n_words, places (of base phrases) and detections.

    Null and empty texts have no words, places or detections. A whole text is scanned, however
    long; repeated rows and rows without a key are rows like others, and other columns are ignored.
    """
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner().detections
        for batch in batches:
            n_words, places, detections = [], [], []
            for one in batch.column(1):
                words = plain_words(one.as_py())
                joined = b" ".join(words).decode()
                n_words.append(len(words))
                places.append(
                    [{"start_word": a, "label": b} for a, b in base_places(joined, BASE_PHRASES)]
                )
                detections.append(
                    [dict(zip(_FIELDS, found, strict=True)) for found in find(joined)]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(places, _PLACES),
                    pa.array(detections, _DETECTIONS),
                ],
                ["key", "n_words", "places", "detections"],
            )

    kind = source.schema["key"].dataType.simpleString()
    rows = source.mapInArrow(
        scan,
        f"key {kind}, n_words bigint, places array<struct<start_word: bigint, label: string>>, "
        "detections array<struct<start_word: bigint, end_word: bigint, label: string, "
        "rule: string, score: double>>",
    )
    return rows.withColumnRenamed("key", key)


_FIELDS = ["start_word", "end_word", "label", "rule", "score"]


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, labels and score of each scanned row, in columns of plain types."""
    starts = F.col("places.start_word")
    base = F.array_sort(F.array_distinct(F.col("places.label")))
    labels = F.array_sort(F.array_union(F.col("places.label"), F.col("detections.label")))
    best = F.coalesce(F.array_max(F.col("detections.score")), F.lit(0.0))
    return found.select(
        key,
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(best, F.when(F.size("places") > 0, 0.8).otherwise(0.0)).alias("score"),
        F.size("detections").cast("long").alias("n_detections"),
    )
