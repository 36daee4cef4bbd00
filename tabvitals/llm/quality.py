"""Quality of documents by weak supervision: rules vote or abstain, their accuracies are estimated.

Each rule looks at one property of the text and votes 1 (good), -1 (bad) or 0 (abstains). No rule
decides alone, and no labels are used. The label model takes the votes of a document as
independent given its quality: a rule that votes is right about good and about bad documents
with an accuracy of its own for each, and whether it votes does not depend on quality.
Expectation-maximisation estimates all accuracies and the share of good documents; a document is
kept if its posterior probability of being good is at least the threshold.

Plan: one pass measures the texts in Arrow batches. Documents with the same votes are alike for
the model, so it is fitted on counts of vote patterns, of which there are at most 3 ** 10 = 59,049
whatever the number of documents; only these reach the driver. The posterior is a sum of
logarithms, a plain expression over the votes.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabvitals.llm.common import fresh

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: Function words of the languages of the corpus; a text of running prose has some of them.
FUNCTION_WORDS = (
    "the of and to in that is was for it with as be by on not are this from "
    "der die das und ist nicht von mit ein eine den dem des sich auch zu "
    "le la les des et un une est dans pour que qui sur pas au du "
    "el los las una del por con para es se su no lo como de en"
).split()
_FUNCTION = frozenset(w.encode() for w in FUNCTION_WORDS)
_SPACES = [b" ", b"\t", b"\n", b"\v", b"\f", b"\r"]
_CAPITALS = [bytes([c]) for c in range(65, 91)]
_SMALL = [bytes([c]) for c in range(97, 123)]
#: Bytes that words of prose don't end with.
_ODD = frozenset(b"#*$%&|<>~^_=+@\\/{[(")
_LETTERS_AND_SPACES = bytes(
    c for c in range(256) if c >= 128 or bytes([c]).isalnum() or bytes([c]).isspace()
)
_ENDINGS = tuple(".?!:;…。؟？！\"')]}»”")

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = [
    "symbols",
    "word_ends",
    "punctuation",
    "capitals",
    "repeated_lines",
    "repeated_words",
    "line_ends",
    "function_words",
    "variety",
    "shouting",
]
FEATURES = "struct<" + ", ".join(
    [*[f"{c}: bigint" for c in COUNTS], "base_failed: boolean", *[f"{r}: tinyint" for r in RULES]]
) + ">"


def _vote(good: bool, bad: bool) -> int:
    return -1 if bad else int(good)


def _repeated(words: list[bytes]) -> int:
    """Words inside windows of five that stand in the text at least twice."""
    if len(words) <= WINDOW:
        return 0
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    starts = np.fromiter((times[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for i in range(WINDOW):
        covered[i : i + len(starts)] |= starts
    return int(covered.sum())


def measured(text: str | None) -> tuple:
    """The counts, whether the base rules fail, and the votes of one text; null is empty."""
    text = text or ""
    data = text.encode()
    words = data.split()
    n = len(words)
    chars = len(text) - sum(map(data.count, _SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.split()]
    dup_lines = len(lines) - len(set(lines))
    repeated = _repeated(words)
    counts = (n, chars, symbols, dup_lines, repeated)
    failed = n < 10 or 100 * repeated > 20 * n
    if not n:
        return (*counts, failed, *[0] * len(RULES))
    upper = sum(map(data.count, _CAPITALS))
    lower = sum(map(data.count, _SMALL))
    ended = sum(x.decode().rstrip().endswith(_ENDINGS) for x in lines) / len(lines)
    marks = len(data.translate(None, _LETTERS_AND_SPACES)) / chars
    odd = sum(w[-1] in _ODD for w in words) / n
    distinct = set(words)
    known = len(_FUNCTION & {w.lower() for w in distinct if len(w) < 6})
    shouted = sum(w.endswith((b"!!", b"??", b"!?")) for w in words) / n
    votes = (
        _vote(symbols < 0.02 * n, symbols > 0.1 * n),
        _vote(odd < 0.02, odd > 0.1),
        _vote(marks < 0.08, marks > 0.2),
        _vote(upper < 0.15 * lower, upper > 0.5 * lower and upper > 10),
        _vote(dup_lines == 0 and len(lines) > 2, dup_lines > 0.3 * len(lines)),
        _vote(n >= 20 and repeated < 0.05 * n, repeated > 0.2 * n),
        _vote(ended >= 0.5, ended < 0.1 and len(lines) > 3),
        _vote(known >= 3, known == 0 and n >= 30),
        _vote(
            n >= 20 and len(distinct) > min(0.4 * n, 200),
            n >= 30 and len(distinct) < 0.15 * min(n, 500),
        ),
        _vote(shouted == 0, shouted > 0.05),
    )
    return (*counts, failed, *votes)


def features(text: Column) -> Column:
    """A struct of the counts, base_failed, and one vote per rule."""

    @F.pandas_udf(FEATURES)
    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            [measured(t) for t in texts], columns=[*COUNTS, "base_failed", *RULES]
        )

    return measure(text)


@dataclass(frozen=True)
class LabelModel:
    """The share of good documents; how often a rule that votes is right about good and bad ones."""

    good: float
    right_of_good: dict[str, float]
    right_of_bad: dict[str, float]

    def posterior(self, votes: dict[str, Column]) -> Column:
        """The probability that a document with these votes is good."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for rule in sorted(self.right_of_good):
            g, b = self.right_of_good[rule], self.right_of_bad[rule]
            said = F.when(votes[rule] > 0, math.log(g / (1 - b)))
            said = said.when(votes[rule] < 0, math.log((1 - g) / b))
            odds = odds + said.otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


#: Votes that a rule is supposed to have given before any data: 97 of 100 right about good
#: documents, 30 of 100 about bad ones, as a rule sees one kind of fault and others have others.
_PRIOR, _GOOD, _BAD = 10.0, 0.97, 0.3


def estimated(
    votes: np.ndarray, counts: np.ndarray, rounds: int = 100
) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """EM over vote patterns (rows of -1, 0, 1) and how many documents have each.

    Gives the share of good documents, the accuracies about good and about bad ones, and the
    posterior of each pattern. It starts from documents without a bad vote as probably good. A
    good document may have a bad vote by accident, but rules are taken as right about at least
    90 % of the good ones, and as no worse than chance about bad ones (accuracies add up to 1 or
    more). This settles which of the two classes is meant, whatever their shares.
    """
    post = np.where((votes < 0).any(axis=1), 0.2, 0.9)
    for _ in range(rounds):
        is_good, is_bad = (post * counts)[:, None], ((1 - post) * counts)[:, None]
        yes, no = votes > 0, votes < 0
        g = (yes * is_good).sum(axis=0) + _PRIOR * _GOOD
        g /= g + (no * is_good).sum(axis=0) + _PRIOR * (1 - _GOOD)
        b = (no * is_bad).sum(axis=0) + _PRIOR * _BAD
        b /= b + (yes * is_bad).sum(axis=0) + _PRIOR * (1 - _BAD)
        g = g.clip(0.9, 0.9995)
        b = np.maximum(b, 1 - g).clip(0.005, 0.995)
        good = float(np.clip((is_good.sum() + 1) / (counts.sum() + 2), 0.01, 0.99))
        odds = math.log(good / (1 - good)) + yes @ np.log(g / (1 - b)) + no @ np.log((1 - g) / b)
        post = 1 / (1 + np.exp(-odds))
    return good, g, b, post


def fitted(votes: DataFrame, rounds: int = 100) -> LabelModel:
    """The model of a frame with a column of votes per rule; without rows, that of the prior."""
    patterns = votes.groupBy(*RULES).agg(F.count("*").alias("n_texts")).orderBy(*RULES).collect()
    table = np.array([[*row] for row in patterns], np.float64).reshape(-1, len(RULES) + 1)
    good, g, b, _ = estimated(table[:, :-1], table[:, -1], rounds)
    return LabelModel(
        good, dict(zip(RULES, g.tolist(), strict=True)), dict(zip(RULES, b.tolist(), strict=True))
    )


def _judged(
    docs: DataFrame, text: str, threshold: float, found: str
) -> tuple[DataFrame, Column, Column]:
    """The rows with a struct of measures, their quality, and whether they are kept."""
    rows = docs.withColumn(found, features(F.col(f"`{text}`")))
    model = fitted(rows.select(f"{found}.*").select(*RULES))
    quality = model.posterior({r: F.col(f"{found}.{r}") for r in RULES})
    return rows, quality, ~F.col(f"{found}.base_failed") & (quality >= threshold)


def scored(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows with the counts, base_failed, votes, quality (posterior) and kept.

    A null or empty text has no words and fails the base rules, so it is not kept. Repeated rows
    count and are judged as often as they stand; a whole text is measured, however long. An empty
    frame stays empty. Columns of the input that have a name of the result are replaced.
    """
    names = [*COUNTS, "base_failed", *RULES, "quality", "kept"]
    rest = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names or c == text]
    )
    found = fresh(rest, "measured")
    rows, quality, kept = _judged(rest, text, threshold, found)
    parts = [F.col(f"{found}.{c}").alias(c) for c in [*COUNTS, "base_failed", *RULES]]
    columns = [F.col(f"`{c}`") for c in rest.columns]
    return rows.select(*columns, *parts, quality.alias("quality"), kept.alias("kept"))


def without_rejects(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that are kept, with their own columns and no others."""
    rows, _, kept = _judged(docs, text, threshold, fresh(docs, "measured"))
    return rows.filter(kept).select(*[F.col(f"`{c}`") for c in docs.columns])
