"""Secrets in texts: fixed patterns, and strings whose characters are too evenly mixed.

Patterns find the base spans: assignments, access keys and long runs of hex digits. Beyond these,
candidates are cut at separators: runs of at least 20 letters and digits, each of one class by its
characters (hex digits, one case, both cases). Keys in base64 have separators inside, so runs of
letters, digits and `+/_=-` are candidates too, of a class of their own. A window of 20 characters
slides over a candidate; the counts of its characters change by one that comes and one that goes,
and with them the sum of `c * log2(c)`, which gives the Shannon entropy of the window without
counting again. Counts are packed, five bits each, into six numbers, so a step is a few operations.

Each class has a limit that all but some 1 in 200 windows of random characters of the class reach.
A span goes from a candidate's first window at the limit to its last. It is dropped if it is on the
allow-list (placeholders, sequences, repeats) or lies within a base span or a longer entropy span.
Candidates that are shaped like names, numbers or identifiers are not looked at.

Everything is an expression over the text: no Python, no shuffle, one pass. Patterns are tried once
on each text, and the rest is worked out for texts that match, in time in proportion to the text.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabvitals.llm.common import sha256

#: Patterns of the base kinds, the group whose length counts, and that length.
BASE = {
    "assign": (
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
        r"([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: The same as two of the patterns for runs that are long enough; runs don't touch each other.
_LONG = {"hex": r"[0-9a-f]{24,}", "access": r"AKIA[A-Z0-9]{16,}"}

WINDOW = 20
CHUNK = 1024  # matches whose places are added up together
#: Least bits a character of a window, by class: hex digits, one case, both cases, with separators.
HEX_BITS, SINGLE_BITS, MIXED_BITS, JOINED_BITS = 2.8, 3.27, 3.55, 3.65
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_RUN, _JOINED = r"[A-Za-z0-9]{20,}", r"[A-Za-z0-9+/_=-]{20,}"
#: Runs of letters, or of letters and up to four digits, and runs of digits.
_NAMES = [r"^[A-Za-z]+[0-9]{0,4}$", r"^[0-9]+$"]
#: The same in segments, and identifiers.
_JOINED_NAMES = [
    r"^(?:[A-Za-z]++[0-9]{0,4}+|[0-9]{0,8}+)(?:[-_/=+](?:[A-Za-z]++[0-9]{0,4}+|[0-9]{0,8}+))*+$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
]
ALLOWED = [
    r"(?i)example|sample|dummy|placeholder|changeme|your[-_]?(key|token|secret)|xxxx|0123456789",
    r"(?i)abcdefgh|(.)\1{7}",
]

KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_single", "entropy_mixed", "entropy_joined"]
_HEX, _SINGLE, _MIXED, _MANY = range(3, 7)
_SPAN = "struct<start: bigint, ord: int, end: bigint, text: string>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _none() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


def _spans(text: Column, pattern: str, group: int, order: int) -> Column:
    """All matches, leftmost first and without overlaps, with their places in code points.

    The lengths of the pieces between the matches and of the matches add up to the places. They
    are added in chunks, as an array grows by copying.
    """
    regex = F.lit(pattern)
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, regex, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, regex, F.lit(group)).alias("group"),
    )
    lengths = F.transform(
        F.filter(parts, lambda p: p["hit"].isNotNull()),
        lambda p: F.struct(
            F.length(p["gap"]).alias("gap"),
            F.length(p["hit"]).alias("hit"),
            p["group"].alias("text"),
        ),
    )
    return _let(lengths, lambda steps: _placed(steps, order))


def _placed(steps: Column, order: int) -> Column:
    def step(at: Column, one: Column) -> tuple[Column, Column]:
        begin = at + one["gap"]
        end = begin + one["hit"]
        span = F.struct(
            begin.alias("start"), F.lit(order).alias("ord"), end.alias("end"), one["text"]
        )
        return end, span

    return _scanned(steps, step)


def _scanned(items: Column, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """The spans that a step makes of each item and a running number, which it moves on.

    Arrays grow by copying, so spans are gathered in chunks of items, and these put together.
    """
    firsts = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int"))
    chunks = F.transform(firsts, lambda c: F.slice(items, c * CHUNK + 1, F.lit(CHUNK)))

    def start(at: Column) -> Column:
        return F.struct(at.cast("bigint").alias("at"), _none().alias("spans"))

    def one(state: Column, item: Column) -> Column:
        at, span = step(state["at"], item)
        spans = F.concat(state["spans"], F.array(span))
        return F.struct(at.cast("bigint").alias("at"), spans.alias("spans"))

    def chunk(state: Column, items: Column) -> Column:
        return _let(
            F.aggregate(items, start(state["at"]), one),
            lambda done: F.struct(
                done["at"].alias("at"), F.concat(state["spans"], done["spans"]).alias("spans")
            ),
        )

    scanned = F.aggregate(chunks, start(F.lit(0)), chunk, lambda state: state["spans"])
    return F.when(F.size(items) > 0, scanned).otherwise(_none())


def base_spans(text: Column, kind: str) -> Column:
    """The matches of a base kind whose counted group is long enough."""
    pattern, group, least = BASE[kind]
    pattern = _LONG.get(kind, pattern)
    spans = F.filter(
        _spans(text, pattern, group, KINDS.index(kind)), lambda s: F.length(s["text"]) >= least
    )
    return F.when(text.rlike(pattern), spans).otherwise(_none())


def _part(count: Column) -> Column:
    """`c * log2(c)` of a count in a window, in millionths."""
    parts = [round(c * math.log2(c) * 1e6) if c else 0 for c in range(WINDOW + 1)]
    return F.get(F.array(*[F.lit(p) for p in parts]), count)


def _most(bits: float) -> int:
    """The largest sum of parts in a window with so many bits a character."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * 1e6)


_IN_WORD = 12  # counts of five bits in a number


def _moves(text: Column) -> Column:
    """For each step of the window, the letter that comes and the one that goes, or -1.

    A letter is a place in the packed counts: number, and bits to shift.
    """
    places = F.transform(F.split(text, "", -1), lambda c: F.position(c, F.lit(ALPHABET)) - 1)
    letters = F.filter(places, lambda i: i >= 0)
    return _let(
        letters,
        lambda all_: F.transform(
            all_,
            lambda come, i: F.struct(
                i.alias("i"),
                come.alias("come"),
                F.when(i >= WINDOW, F.get(all_, i - WINDOW)).otherwise(-1).alias("go"),
            ),
        ),
    )


def _windows(moves: Column, most: Column) -> Column:
    """First and last window whose sum of parts is no larger than `most`, as a struct, or nulls."""
    n_words = -(-len(ALPHABET) // _IN_WORD)
    words = [f"c{k}" for k in range(n_words)]
    start = F.struct(
        *[F.lit(0).cast("bigint").alias(w) for w in words],
        F.lit(0).alias("total"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def one(letter: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), letter % _IN_WORD * 5)

    def count(state: Column, letter: Column) -> Column:
        word = F.get(F.array(*[state[w] for w in words]), F.floor(letter / _IN_WORD).cast("int"))
        return F.call_function("shiftright", word, letter % _IN_WORD * 5).bitwiseAND(31).cast("int")

    def step(state: Column, move: Column) -> Column:
        come, go = move["come"], move["go"]
        gone = count(state, go)
        less = F.when(go >= 0, _part(gone - 1) - _part(gone)).otherwise(F.lit(0))
        before = count(state, come) - F.when(come == go, 1).otherwise(0)
        total = state["total"] + less + _part(before + 1) - _part(before)
        enough = (move["i"] >= WINDOW - 1) & (total <= most)
        window = move["i"] - (WINDOW - 1)

        def changed(k: int) -> Column:
            first, end = k * _IN_WORD, (k + 1) * _IN_WORD
            more = F.when((come >= first) & (come < end), one(come)).otherwise(F.lit(0))
            fewer = F.when((go >= first) & (go < end), one(go)).otherwise(F.lit(0))
            return (state[words[k]] + more - fewer).alias(words[k])

        return F.struct(
            *[changed(k) for k in range(n_words)],
            total.alias("total"),
            F.when(enough, F.coalesce(state["first"], window))
            .otherwise(state["first"])
            .alias("first"),
            F.when(enough, window).otherwise(state["last"]).alias("last"),
        )

    return F.aggregate(moves, start, step, lambda s: F.struct(s["first"], s["last"]))


def _like(text: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for pattern in patterns:
        out = out | text.rlike(pattern)
    return out


def _reached(candidates: Column, kind: Callable[[Column], Column]) -> Column:
    """The spans of candidates from their first window at the limit to the last, not allowed ones.

    `kind` tells a candidate's class. One transformation after another, so that each part is worked
    out once for a candidate.
    """
    limits = {_HEX: HEX_BITS, _SINGLE: SINGLE_BITS, _MIXED: MIXED_BITS, _MANY: JOINED_BITS}
    classed = F.transform(
        candidates,
        lambda s: F.struct(s.alias("span"), kind(s["text"]).alias("ord"), _moves(s["text"]).alias("moves")),
    )

    def at(item: Column) -> Column:
        most = F.element_at(
            F.create_map(*[F.lit(x) for k, b in limits.items() for x in (k, _most(b))]), item["ord"]
        )
        return F.struct(item["span"], item["ord"], _windows(item["moves"], most).alias("at"))

    windows = F.filter(F.transform(classed, at), lambda w: w["at"]["first"].isNotNull())

    def bounds(window: Column) -> Column:
        span, first, last = window["span"], window["at"]["first"], window["at"]["last"]
        return F.struct(
            (span["start"] + first).alias("start"),
            window["ord"].alias("ord"),
            (span["start"] + last + WINDOW).alias("end"),
            F.substring(span["text"], first + 1, last - first + WINDOW).alias("text"),
        )

    return F.filter(F.transform(windows, bounds), lambda s: ~_like(s["text"], ALLOWED))


def _outside(spans: Column, others: Column) -> Column:
    """The spans that do not lie within one of the others, by one pass over all in their order."""

    def item(is_other: bool) -> Callable[[Column], Column]:
        return lambda s: F.struct(
            s["start"].alias("start"), F.lit(not is_other).alias("kept"), s.alias("span")
        )

    both = F.array_sort(
        F.concat(F.transform(others, item(True)), F.transform(spans, item(False)))
    )

    def step(reach: Column, item: Column) -> tuple[Column, Column]:
        # `reach` is how far the others so far extend; a span within it has no text any more.
        span = item["span"]
        outside = item["kept"] & (span["end"] > reach)
        return (
            F.when(item["kept"], reach).otherwise(F.greatest(reach, span["end"])),
            F.struct(
                span["start"].alias("start"),
                span["ord"].alias("ord"),
                span["end"].alias("end"),
                F.when(outside, span["text"]).alias("text"),
            ),
        )

    scanned = _let(both, lambda items: _scanned(items, step))
    outside = F.filter(scanned, lambda s: s["text"].isNotNull())
    return F.when(F.size(others) > 0, outside).otherwise(spans)


def run_spans(text: Column) -> Column:
    """Spans in runs of letters and digits."""

    def kind(run: Column) -> Column:
        single = run.rlike("^([0-9A-Z]+|[0-9a-z]+)$")
        return F.when(run.rlike("^[0-9a-fA-F]+$"), _HEX).otherwise(
            F.when(single, _SINGLE).otherwise(_MIXED)
        )

    runs = F.filter(_spans(text, _RUN, 0, 0), lambda s: ~_like(s["text"], _NAMES))
    return F.when(text.rlike(_RUN), _reached(runs, kind)).otherwise(_none())


def joined_spans(text: Column) -> Column:
    """Spans in runs that separators join, with letters of both cases and digits."""
    runs = F.filter(
        _spans(text, _JOINED, 0, 0),
        lambda s: s["text"].rlike("[-+/_=]") & ~_like(s["text"], _JOINED_NAMES),
    )
    spans = F.filter(
        _reached(runs, lambda _: F.lit(_MANY)),
        lambda s: s["text"].rlike("[a-z]") & s["text"].rlike("[A-Z]") & s["text"].rlike("[0-9]"),
    )
    return F.when(text.rlike(_JOINED), spans).otherwise(_none())


def found(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of the input: key, assign, access, hex and entropy (arrays of spans).

    A span has its start and end (in code points, end exclusive), the place of its kind in KINDS,
    and what counts of it: the value of an assignment, else the string. Null and empty texts have
    no spans. Whole texts are scanned; repeated rows and rows without a key are rows like others.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias(key), whole.alias("whole_text"))
    whole = F.col("whole_text")
    rows = rows.select(key, whole, *[base_spans(whole, k).alias(k) for k in BASE])
    base = F.concat(*[F.col(k) for k in BASE])
    rows = rows.select(
        "*",
        base.alias("base"),
        run_spans(whole).alias("runs"),
        joined_spans(whole).alias("joined"),
    )
    joined = _outside(F.col("joined"), F.col("base"))
    rows = rows.withColumn("joined", joined)
    runs = _outside(_outside(F.col("runs"), F.col("base")), F.col("joined"))
    return rows.select(key, *BASE, F.concat(runs, F.col("joined")).alias("entropy"))


def listed(spans: Column) -> Column:
    """`kind:start:end` of spans, by start, then kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    texts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.get(names, s["ord"]), s["start"], s["end"]),
    )
    return F.array_join(texts, ",")


def digest(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as one string."""
    base = F.concat(*[F.col(k) for k in BASE])
    return rows.select(
        key,
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        sha256(listed(base)).alias("base_sha256"),
        listed(F.concat(base, F.col("entropy"))).alias("spans"),
    )
