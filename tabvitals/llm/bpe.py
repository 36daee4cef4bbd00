"""Byte-level BPE: texts to token ids and back, with an index of where pairs occur.

The words that a batch has for the first time are laid out as sequences of symbols. An index
maps each adjacent pair that the vocabulary can merge to all its positions in that sequence. Pairs
are taken in ascending rank: all positions of the pair with the lowest active rank are merged at
once, and only the lists of the pairs beside them are updated. Merging a pair makes a symbol that
only later ranks use, so every word ends as if it had been merged on its own.

Plan: one pass over the texts in Arrow batches, no shuffle. The vocabulary, whose size is that of
its file, goes to the executors as a broadcast. Each Python worker keeps the encoded words it has
seen, in generations of bounded size; a text's ids live only as long as the text is worked on.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: how the vocabulary's texts are cut into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT_WORDS = 300_000  # of a generation; two of pieces and two of words take some 250 MB
INDEXED = 3_000  # words of one index of pairs, so that its lists stay in a processor's cache


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Vocabulary:
    """tokens: bytes by id; merges: (left id, right id, merged id) by rank."""

    tokens: list[bytes]
    special: dict[str, int]
    bytes_to_id: list[int]
    merges: list[tuple[int, int, int]]

    def ranks_by_left(self) -> list[dict[int, int]]:
        """For each left id, the ranks of its pairs by right id; the last entry is of gaps."""
        ranks: list[dict[int, int]] = [{} for _ in range(len(self.tokens) + 1)]
        for rank, (left, right, _) in enumerate(self.merges):
            ranks[left][right] = rank
        return ranks


def load(path: str) -> Vocabulary:
    """The vocabulary of a tokenizer file of the byte-level kind."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    letters = _byte_letters()
    ids = stored["model"]["vocab"]
    special = {t["content"]: t["id"] for t in stored["added_tokens"]}
    tokens = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in ids.items():
        tokens[i] = bytes(letters[c] for c in token)
    for token, i in special.items():
        tokens[i] = token.encode()
    single = {tokens[i]: i for t, i in ids.items() if len(t) == 1}
    merges = []
    for pair in stored["model"]["merges"]:
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        merges.append((ids[left], ids[right], ids[left + right]))
    return Vocabulary(tokens, special, [single[bytes([b])] for b in range(256)], merges)


def merged(
    words: list[bytes], vocabulary: Vocabulary, ranks: list[dict[int, int]]
) -> tuple[list[int], list[int]]:
    """The token ids of all words, one after another, and where each word's ids end.

    Found by the index of pair occurrences; `ranks` are the vocabulary's ranks by left id.
    """
    if not words:
        return [], []
    merges, gap, dead = vocabulary.merges, -1, -2
    ends = np.cumsum([len(w) + 1 for w in words])
    data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
    # Symbols, a gap after each word; a gap pairs with nothing.
    ids = np.array(vocabulary.bytes_to_id, np.int64)[data]
    ids[ends - 1] = gap
    # The index: positions of each pair, by its rank.
    codes = ids[:-1] << 32 | ids[1:]
    codes[(ids[:-1] < 0) | (ids[1:] < 0)] = gap
    order = np.argsort(codes, kind="stable")
    firsts = np.flatnonzero(np.diff(codes[order], prepend=codes[order[:1]] - 1))
    places: dict[int, list[int]] = {}
    for code, at in zip(codes[order[firsts]].tolist(), np.split(order, firsts[1:]), strict=True):
        rank = ranks[code >> 32].get(code & 0xFFFFFFFF)
        if rank is not None:
            places[rank] = at.tolist()
    active = list(places)
    heapq.heapify(active)
    following = list(range(1, len(ids) + 1))
    preceding = list(range(-1, len(ids) - 1))
    symbols, places_of = ids.tolist(), places.get
    while active:
        rank = heapq.heappop(active)
        left, right, new = merges[rank]
        of_new, at = ranks[new], places.pop(rank)
        if left == right:
            at.sort()  # of overlapping occurrences, the leftmost are merged
        for i in at:
            if symbols[i] != left:
                continue
            j = following[i]
            if symbols[j] != right:
                continue
            symbols[i], symbols[j] = new, dead
            k = following[i] = following[j]
            preceding[k] = i
            # Only the lists of the two pairs beside the new symbol change.
            rank_after = of_new.get(symbols[k])
            if rank_after is not None:
                listed = places_of(rank_after)
                if listed is None:
                    places[rank_after] = [i]
                    heapq.heappush(active, rank_after)
                else:
                    listed.append(i)
            h = preceding[i]
            rank_before = ranks[symbols[h]].get(new)
            if rank_before is not None:
                listed = places_of(rank_before)
                if listed is None:
                    places[rank_before] = [h]
                    heapq.heappush(active, rank_before)
                else:
                    listed.append(h)
    left_over = np.array(symbols, np.int64)
    is_token = left_over >= 0
    return left_over[is_token].tolist(), np.cumsum(is_token)[ends - 1].tolist()


class _Kept:
    """Texts by text, for a bounded number of them: what a generation does not use is dropped.

    Strings only, which the garbage collector need not follow.
    """

    def __init__(self, most: int):
        self.most = most
        self.now: dict[str, str] = {}
        self.before: dict[str, str] = {}

    def __len__(self) -> int:
        return len(self.now)

    def turn(self) -> None:
        """To be called between uses: a full generation becomes the one before."""
        if len(self.now) >= self.most:
            self.now, self.before = {}, self.now

    def unknown(self, keys: set[str]) -> list[str]:
        """The keys that are in no generation; those of the one before are taken over."""
        new = keys.difference(self.now)
        old = new.intersection(self.before)
        self.now.update(zip(old, map(self.before.__getitem__, old), strict=True))
        return list(new.difference(old))


class Coder:
    """Texts to ids and back. Ids are handed on as text, decimals joined by commas.

    Pieces of texts between spaces, and the words they are cut into, are kept with their ids over
    runs, some `kept_words` of each twice, as many as two generations hold.
    """

    def __init__(self, vocabulary: Vocabulary, kept_words: int = KEPT_WORDS):
        self.vocabulary = vocabulary
        self.ranks = vocabulary.ranks_by_left()
        self.known, self.words = _Kept(kept_words), _Kept(kept_words)
        self.numerals = [str(i) for i in range(len(vocabulary.tokens))]
        self.tokens = dict(zip(self.numerals, vocabulary.tokens, strict=True))
        self.cut = regex.compile(PATTERN)
        special = "|".join(map(regex.escape, sorted(vocabulary.special, reverse=True)))
        self.special = regex.compile(f"({special})")

    def pieces(self, text: str) -> list[str]:
        """Pieces that no word reaches across: white space alone between others starts a new one."""
        if not text:
            return []
        if _is_plain(text):
            return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
        parts = text.split(" ")
        out = [parts[0]] if parts[0] else []
        for part in parts[1:]:
            if part and not part[0].isspace() and part[0] not in _MORE_SPACES:
                out.append(" " + part)
            elif out:
                out[-1] += " " + part
            else:
                out.append(" " + part)
        return out

    def _learn(self, pieces: set[str]) -> None:
        """Makes all pieces known."""
        self.known.turn()
        self.words.turn()
        new = self.known.unknown(pieces)
        cut = [self.cut.findall(p) for p in new]
        words = self.words.unknown({w for ws in cut for w in ws})
        for i in range(0, len(words), INDEXED):
            some = words[i : i + INDEXED]
            ids, ends = merged([w.encode() for w in some], self.vocabulary, self.ranks)
            shown, start = list(map(self.numerals.__getitem__, ids)), 0
            for word, end in zip(some, ends, strict=True):
                self.words.now[word] = ",".join(shown[start:end])
                start = end
        ids_of = self.words.now.__getitem__
        for piece, ws in zip(new, cut, strict=True):
            self.known.now[piece] = ids_of(ws[0]) if len(ws) == 1 else ",".join(map(ids_of, ws))

    def listed(self, texts: Iterable[str | None]) -> Iterator[str]:
        """The ids of each text, as text; null counts as empty."""
        split, pieces = [], set()
        for text in texts:
            parts = [text or ""]
            if any(name in parts[0] for name in self.vocabulary.special):
                parts = self.special.split(parts[0])
            found = [self.pieces(p) if i % 2 == 0 else [p] for i, p in enumerate(parts)]
            split.append(found)
            for part in found[::2]:
                pieces.update(part)
        self._learn(pieces)
        ids_of = self.known.now.__getitem__
        for found in split:
            if len(found) == 1:
                yield ",".join(map(ids_of, found[0]))
                continue
            out = []
            for i, part in enumerate(found):
                if i % 2:
                    out.append(self.numerals[self.vocabulary.special[part[0]]])
                else:
                    out += map(ids_of, part)
            yield ",".join(out)

    def encoded(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        """The ids of each text; null counts as empty."""
        for ids in self.listed(texts):
            yield numbers(ids).tolist()

    def decoded(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids)).decode("utf-8", "replace")

    def decoded_list(self, ids: str) -> str:
        """The text of ids that are joined by commas."""
        if not ids:
            return ""
        return b"".join(map(self.tokens.__getitem__, ids.split(","))).decode("utf-8", "replace")


def numbers(ids: str) -> np.ndarray:
    """Ids out of their text."""
    return np.fromstring(ids, np.int32, sep=",") if ids else np.zeros(0, np.int32)


#: Characters that some engines count as white space and some don't; such pieces stay together.
_MORE_SPACES = "\x1c\x1d\x1e\x1f\x85᠎​⁠﻿"
#: White space other than blanks and line ends, or what may count as such, and the cut's own mark.
_ODD_SPACES = re.compile(rf"[^\S \n]|[\0{_MORE_SPACES}]")


def _is_plain(text: str) -> bool:
    """Whether white space is single blanks and line ends, each between other characters."""
    ends = text[0], text[-1]
    return (
        not any(pair in text for pair in ("  ", "\n\n", " \n", "\n "))
        and " " not in ends
        and "\n" not in ends
        and not _ODD_SPACES.search(text)
    )


_coders: dict[tuple[int, int], Coder] = {}


def _coder(shared, kept_words: int = KEPT_WORDS) -> Coder:
    """The worker's coder for a broadcast vocabulary."""
    name = id(shared.value), kept_words
    if name not in _coders:
        _coders.clear()
        _coders[name] = Coder(shared.value, kept_words)
        gc.freeze()  # the vocabulary stays, so the garbage collector need not visit it
    return _coders[name]


#: Texts are worked on in runs of about so many characters, which bounds a worker's memory.
_RUN = 2_000_000


def _runs(texts: pa.Array) -> Iterator[list[str | None]]:
    run, size = [], 0
    for text in texts:
        run.append(text.as_py())
        size += len(run[-1] or "")
        if size >= _RUN:
            yield run
            run, size = [], 0
    if run:
        yield run


def encoded(
    docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per row of the input: key and ids (array of int).

    Null and empty texts have no ids. Whole texts are encoded, however long. Repeated rows, rows
    without a key and special tokens written out in a text are encoded like the library does.
    """
    source, kind = _source(docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for batch in batches:
            at = 0
            for run in _runs(batch.column(1)):
                ids = pa.array(list(coder.encoded(run)), pa.list_(pa.int32()))
                keys = batch.column(0).slice(at, len(run))
                at += len(run)
                yield pa.RecordBatch.from_arrays([keys, ids], ["key", "ids"])

    rows = source.mapInArrow(encode, f"key {kind}, ids array<int>")
    return rows.withColumnRenamed("key", key)


def decoded(rows: DataFrame, vocabulary: Vocabulary, key: str = "doc_id") -> DataFrame:
    """A row per row of ids: key and text. Null ids count as none."""
    source, kind = _source(rows, key, "ids")
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for batch in batches:
            texts = [coder.decoded(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts)], ["key", "text"])

    return source.mapInArrow(decode, f"key {kind}, text string").withColumnRenamed("key", key)


def coded(
    docs: DataFrame,
    vocabulary: Vocabulary,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
    kept_words: int = KEPT_WORDS,
) -> DataFrame:
    """Per row of the input: key, ids, n_tokens, ids_sha256 and decoded_sha256.

    The digests are those of the ids in decimal, joined by commas, and of the text decoded from
    them, in UTF-8; both are taken where the ids are made. `with_ids` says whether there is a
    column of ids; `kept_words` bounds the pieces and words that a worker keeps.
    """
    source, kind = _source(docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    fields = {"key": kind} | ({"ids": "array<int>"} if with_ids else {})
    fields |= {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, kept_words)
        for batch in batches:
            at = 0
            for run in _runs(batch.column(1)):
                all_ids, n_tokens, ids_hex, text_hex = [], [], [], []
                for ids in coder.listed(run):
                    if with_ids:
                        all_ids.append(numbers(ids))
                    n_tokens.append(ids.count(",") + 1 if ids else 0)
                    ids_hex.append(hashlib.sha256(ids.encode()).hexdigest())
                    text_hex.append(hashlib.sha256(coder.decoded_list(ids).encode()).hexdigest())
                keys = batch.column(0).slice(at, len(run))
                at += len(run)
                columns = [keys, *([pa.array(all_ids, pa.list_(pa.int32()))] if with_ids else [])]
                columns += [pa.array(n_tokens, pa.int64()), pa.array(ids_hex), pa.array(text_hex)]
                yield pa.RecordBatch.from_arrays(columns, list(fields))

    rows = source.mapInArrow(work, ", ".join(f"{name} {type_}" for name, type_ in fields.items()))
    return rows.withColumnRenamed("key", key)


def _source(rows: DataFrame, key: str, value: str) -> tuple[DataFrame, str]:
    source = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{value}`").alias("value"))
    return source, source.schema["key"].dataType.simpleString()
