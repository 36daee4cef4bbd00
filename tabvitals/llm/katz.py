"""Language model scores: bigrams with Katz backoff, learned and applied in one go.

Tokens are the words `[^\\x20\\x09-\\x0D]+` of the lower-cased (A-Z) text, then one end. With c a
count in the training texts and d its Good-Turing discount (Katz: for counts up to 5):

    P(w)     = d(c(w)) c(w) / (N + 1), if w is known; all unknown words together have the rest
    P(w | h) = d(c(h w)) c(h w) / (c(h) + 1), if the bigram is known
             = alpha(h) P(w), otherwise; P(w), if h is unknown as well

The one event added to each total keeps some probability for the unseen even where no count is
discounted. `alpha(h)` divides what is left in h by what its unseen words have together in P(w),
summed over all known bigrams of h, so each P(. | h) adds up to 1.

Plan: texts are turned once into blocks of some million tokens, written as a table. What a block
needs to know goes through tables split by hash: a block asks for each of its different n-grams
once, with its own count, and gets the total back. Requests are sorted 64-bit hashes, packed, so a
hot word or bigram is one number a block, and no group grows with it. Blocks score their tokens
with these totals; sums that make up alpha are gathered by context in the same way, as whole
numbers, each bigram's by one of the blocks that hold it. Nothing of the model passes the driver
but its counts of counts. The table `model` (by order and bucket: n-gram hashes and counts) stays.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabvitals.llm.common import mixed, spaced_words, written

CUTOFF = 5  # counts above it are not discounted
BLOCK_TOKENS = 2_000_000  # laid out, some 100 MB
BUCKET_KEYS = 1_000_000  # requests that meet in one group, about
#: Hashes of the marks around a text; no word has white space.
START, END = (xxhash.xxh3_64_intdigest(mark) for mark in (b"\nstart", b"\nend"))


# Packed columns


def packed(values: np.ndarray) -> bytes:
    """Numbers as zstd-compressed planes of bytes, behind the letter of their type."""
    values = np.ascontiguousarray(values)
    if values.dtype.kind == "i":
        top = int(np.abs(values).max(initial=0))
        values = values.astype(np.int8 if top < 127 else np.int32 if top < 1 << 31 else np.int64)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    body = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())
    return values.dtype.char.encode() + body


def unpacked(data: bytes) -> np.ndarray:
    kind = np.dtype(chr(data[0]))
    body = zstandard.ZstdDecompressor().decompress(data[1:])
    planes = np.frombuffer(body, np.uint8).reshape(kind.itemsize, len(body) // kind.itemsize)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes, by their differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def bucket_slices(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Sorted hashes by their top bits: the buckets that have some, and where."""
    if not len(keys):
        return
    buckets = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
    starts = np.flatnonzero(np.diff(buckets, prepend=buckets[:1] + np.uint64(1)))
    for i, j in zip(starts, [*starts[1:], len(keys)], strict=True):
        yield int(buckets[i]), slice(int(i), int(j))


def bits_for(n_keys: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n_keys) / BUCKET_KEYS)))


def bigram_keys(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(mixed(contexts) * np.uint64(0x9E3779B97F4A7C15) + words)


# Blocks of tokens

_BLOCK_SQL = (
    "block bigint, n_tokens bigint, n_words bigint, keys array<{kind}>, train binary, "
    "lengths binary, words binary, tokens binary"
)


def blocks(docs: DataFrame, train: Column, key: str, text: str) -> DataFrame:
    """Written: the texts as blocks of word numbers, with the hash of each word of the block."""
    source = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{text}`").alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    kind = source.schema["key"].dataType.simpleString()

    def block_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 24
        number = count()
        texts: list[np.ndarray] = []
        keys: list[pa.Array] = []
        train: list[bool] = []
        ids: dict[bytes, int] = defaultdict(count().__next__)
        size = 0

        def row() -> pa.RecordBatch:
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, ids), np.uint64, len(ids))
            tokens = np.concatenate(texts)
            lengths = np.array([len(t) for t in texts], np.int64)
            all_keys = pa.concat_arrays(keys)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([first + next(number)], pa.int64()),
                    pa.array([size + len(texts)], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(all_keys)], pa.int32()), all_keys),
                    pa.array([packed(np.array(train, np.int8))], pa.binary()),
                    pa.array([packed(lengths)], pa.binary()),
                    pa.array([packed(hashes)], pa.binary()),
                    pa.array([packed(tokens)], pa.binary()),
                ],
                ["block", "n_tokens", "n_words", "keys", "train", "lengths", "words", "tokens"],
            )

        for batch in batches:
            for i in range(batch.num_rows):
                words = spaced_words(batch.column(1)[i].as_py())
                texts.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
                keys.append(batch.column(0).slice(i, 1))
                train.append(batch.column(2)[i].as_py())
                size += len(words)
                if size >= BLOCK_TOKENS:
                    yield row()
                    texts, keys, train, size = [], [], [], 0
                    ids = defaultdict(count().__next__)
        if texts:
            yield row()

    return written(source.mapInArrow(block_up, _BLOCK_SQL.format(kind=kind)), "blocks")


@dataclass
class Block:
    """A block laid out: hashes by word number, and per token its number and its context's."""

    hashes: np.ndarray
    words: np.ndarray
    contexts: np.ndarray
    train: np.ndarray  # by text
    lengths: np.ndarray  # tokens by text, the end included
    order: np.ndarray  # numbers of the words and the end by their hash

    @classmethod
    def of(cls, train: bytes, lengths: bytes, words: bytes, tokens: bytes) -> Block:
        hashes = np.concatenate([unpacked(words), np.array([END, START], np.uint64)])
        end, start = len(hashes) - 2, len(hashes) - 1
        sizes = unpacked(lengths).astype(np.int64)
        ends = np.cumsum(sizes + 1) - 1
        numbers = np.full(int(sizes.sum()) + len(sizes), end, np.int32)
        inside = np.ones(len(numbers), bool)
        inside[ends] = False
        numbers[inside] = unpacked(tokens)
        contexts = np.concatenate([[start], numbers[:-1]]).astype(np.int32)
        contexts[1:][~inside[:-1]] = start
        return cls(
            hashes,
            numbers,
            contexts,
            unpacked(train).astype(bool),
            sizes + 1,
            np.argsort(hashes[:start]),
        )

    def bigrams(self) -> np.ndarray:
        return bigram_keys(self.hashes[self.contexts], self.hashes[self.words])


def requests(table: DataFrame, bits: dict[int, int]) -> DataFrame:
    """Per block, order and bucket: the different n-grams (hashes) and their training counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.of(row["train"], row["lengths"], row["words"], row["tokens"])
                taught = np.repeat(block.train, block.lengths)
                counts = np.bincount(block.words[taught], minlength=len(block.hashes))[block.order]
                yield rows(row["block"], 1, block.hashes[block.order], counts)
                keys, which = np.unique(block.bigrams(), return_inverse=True)
                counts = np.bincount(which[taught], minlength=len(keys))
                del which
                yield rows(row["block"], 2, keys, counts)

    def rows(block: int, order: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        parts = list(bucket_slices(keys, bits[order]))
        n = len(parts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([order] * n, pa.int32()),
                pa.array([b for b, _ in parts], pa.int64()),
                pa.array([block] * n, pa.int64()),
                pa.array([packed_keys(keys[s]) for _, s in parts], pa.binary()),
                pa.array([packed(counts[s].astype(np.int64)) for _, s in parts], pa.binary()),
            ],
            ["order", "bucket", "block", "keys", "counts"],
        )

    source = table.select("block", "train", "lengths", "words", "tokens")
    return source.mapInArrow(
        ask, "order int, bucket bigint, block bigint, keys binary, counts binary"
    )


_RANKS = [f"n_{r}" for r in range(1, CUTOFF + 2)]


def totals(asked: DataFrame) -> DataFrame:
    """Written, by kind and order: the model's n-grams with counts, and the answers to blocks.

    An answer has the totals of the n-grams that a block asked for in a bucket, in their order, and
    which of them it owns: an n-gram belongs to the first block that asks for it.
    """

    def add_up(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        order, bucket = key
        group = group.sort_values("block", ignore_index=True)
        parts = [unpacked_keys(k) for k in group["keys"]]
        keys = np.concatenate(parts)
        own = np.concatenate([unpacked(c) for c in group["counts"]]).astype(np.int64)
        known, first, which = np.unique(keys, return_index=True, return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, which, own)
        owned = np.zeros(len(keys), np.int8)
        owned[first] = 1
        answers = total[which]
        ends = np.cumsum([len(p) for p in parts])
        out = [
            (order, bucket, "answer", int(block), None, packed(a), packed(o), *[0] * len(_STATS))
            for block, a, o in zip(
                group["block"],
                np.split(answers, ends[:-1]),
                np.split(owned, ends[:-1]),
                strict=True,
            )
        ]
        seen = total > 0
        ranks = np.bincount(np.minimum(total, CUTOFF + 2), minlength=CUTOFF + 3)[1 : CUTOFF + 2]
        out.append(
            (
                order, bucket, "model", -1, packed_keys(known[seen]), packed(total[seen]), None,
                int(seen.sum()), int(total.sum()), *ranks.tolist(),
            )
        )
        return pd.DataFrame(
            out,
            columns=["order", "bucket", "kind", "block", "keys", "counts", "owned", *_STATS],
        )

    stats = ", ".join(f"{s} bigint" for s in _STATS)
    rows = asked.groupBy("order", "bucket").applyInPandas(
        add_up,
        "order int, bucket bigint, kind string, block bigint, keys binary, counts binary, "
        f"owned binary, {stats}",
    )
    return written(rows, "ngrams", ["kind", "order"])


_STATS = ["n_types", "n_events", *_RANKS]


# Discounts


def discounts(ranks: list[int]) -> np.ndarray:
    """Katz's discounts of counts 0 to CUTOFF, from how many n-grams have counts 1 to CUTOFF + 1.

    The largest cutoff is taken with which all discounts lie between 0 and 1; with none, counts
    stay as they are.
    """
    out = np.ones(CUTOFF + 1)
    for k in range(CUTOFF, 0, -1):
        n = [0.0, *map(float, ranks[: k + 1])]
        if min(n[1:]) <= 0:
            continue
        common = (k + 1) * n[k + 1] / n[1]
        if common >= 1:
            continue
        found = [((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) for r in range(1, k + 1)]
        if all(0 < d < 1 for d in found):
            out[1 : k + 1] = found
            break
    return out


@dataclass(frozen=True)
class Model:
    """What all blocks know: totals and discounts of words and bigrams."""

    n_tokens: int
    n_words: int
    word_ranks: tuple[int, ...]
    word_discounts: np.ndarray
    bigram_discounts: np.ndarray

    @classmethod
    def of(cls, stats: dict[int, dict[str, int]]) -> Model:
        none = dict.fromkeys(_STATS, 0)
        words, bigrams = ([stats.get(o, none)[s] for s in _STATS] for o in (1, 2))
        return cls(
            words[1], words[0], tuple(words[2:]), discounts(words[2:]), discounts(bigrams[2:])
        )

    def word_probability(self, counts: np.ndarray) -> np.ndarray:
        """P(w) by the count of w; for 0, what all unknown words have together."""
        d = np.append(self.word_discounts, 1.0)[np.minimum(counts, CUTOFF + 1)]
        cut = self.word_discounts[1:]
        taken = sum(
            n * r * (1 - x) for r, (n, x) in enumerate(zip(self.word_ranks, cut, strict=False), 1)
        )
        return np.where(counts > 0, d * counts, 1 + taken) / (self.n_tokens + 1)

    def bigram_probability(self, counts: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        d = np.append(self.bigram_discounts, 1.0)[np.minimum(counts, CUTOFF + 1)]
        return d * counts / (contexts + 1)

    def log_weights(
        self, ranks: np.ndarray, word_ranks: np.ndarray, rest: np.ndarray
    ) -> np.ndarray:
        """log10 of alpha(h) * (c(h) + 1), from what is known of h's bigrams.

        ranks: how many have counts 1 to CUTOFF; word_ranks: of how many has the second word such
        a count; rest: the sum of the counts of the other second words.
        """
        r = np.arange(1, CUTOFF + 1)
        left = 1 + ranks @ (r * (1 - self.bigram_discounts[1:]))
        seen = (rest + word_ranks @ (r * self.word_discounts[1:])) / (self.n_tokens + 1)
        return np.log10(left / (1 - seen))


# Scores

_SCORED_SQL = "kind string, block bigint, bucket bigint, keys array<{kind}>, parts array<binary>"


def _by_text(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.cumsum(lengths) - lengths) if len(lengths) else values


def partly_scored(
    table: DataFrame, answers: DataFrame, model: Model, bits: int, kind: str
) -> DataFrame:
    """Written: rows of texts with scores that lack alpha, and rows of what a block knows of it."""

    def score(block_rows: pd.DataFrame, answer_rows: pd.DataFrame) -> pd.DataFrame:
        row = block_rows.iloc[0]
        block = Block.of(row["train"], row["lengths"], row["words"], row["tokens"])
        answer_rows = answer_rows.sort_values(["order", "bucket"])
        one, two = (answer_rows[answer_rows["order"] == o] for o in (1, 2))
        counts = np.zeros(len(block.hashes), np.int64)
        counts[block.order] = np.concatenate([unpacked(c) for c in one["counts"]])
        counts[-1] = counts[-2]  # a text has a start for its end
        firsts, which = np.unique(block.bigrams(), return_index=True, return_inverse=True)[1:]
        pairs = np.concatenate([unpacked(c) for c in two["counts"]]).astype(np.int64)
        owned = np.concatenate([unpacked(c) for c in two["owned"]]).astype(bool)

        of_word, of_context = counts[block.words], counts[block.contexts]
        base = np.log10((counts + 0.5) / (model.n_tokens + 0.5 * (model.n_words + 1)))
        alone = np.log10(model.word_probability(counts))
        seen = pairs[which] > 0
        scores = np.where(
            seen,
            np.log10(np.maximum(model.bigram_probability(pairs[which], of_context), 1e-300)),
            alone[block.words],
        )
        weighed = ~seen & (of_context > 0)

        # What the bigrams that belong to this block add to their contexts.
        mine = np.flatnonzero(owned & (pairs > 0))
        context, word = block.contexts[firsts[mine]], block.words[firsts[mine]]
        n = len(block.hashes)
        bigram_rank, word_rank = pairs[mine], counts[word]
        known = [
            np.bincount(context[bigram_rank == r], minlength=n) for r in range(1, CUTOFF + 1)
        ] + [np.bincount(context[word_rank == r], minlength=n) for r in range(1, CUTOFF + 1)]
        high = word_rank > CUTOFF
        rest = np.zeros(n, np.int64)
        np.add.at(rest, context[high], word_rank[high])
        known.append(rest)
        wanted = np.zeros(n, bool)
        wanted[block.contexts[weighed]] = True
        told = np.zeros(n, bool)
        told[context] = True
        sent = np.flatnonzero(told | wanted)
        sent = sent[np.argsort(block.hashes[sent])]
        keys, wants = block.hashes[sent], wanted[sent]
        out = [
            (
                "context", row["block"], bucket, None,
                [packed_keys(keys[s]), packed(wants[s].astype(np.int8)),
                 *[packed(k[sent[s]].astype(np.int64)) for k in known]],
            )
            for bucket, s in bucket_slices(keys, bits)
        ]
        # Places among the contexts that the block wants to know, in the order of their hashes.
        place = np.zeros(n, np.int64)
        place[sent[wants]] = np.arange(int(wants.sum()))
        backed = block.contexts[weighed]
        scores[weighed] -= np.log10(counts[backed] + 1)
        parts = [
            block.train.astype(np.int8),
            block.lengths,
            _by_text((of_word > 0).astype(np.int64), block.lengths),
            _by_text(base[block.words], block.lengths),
            _by_text(scores, block.lengths),
            _by_text(weighed.astype(np.int64), block.lengths),
            place[backed],
        ]
        out.append(("texts", row["block"], -1, list(row["keys"]), [packed(p) for p in parts]))
        return pd.DataFrame(out, columns=["kind", "block", "bucket", "keys", "parts"])

    rows = (
        table.groupBy("block")
        .cogroup(answers.select("block", "order", "bucket", "counts", "owned").groupBy("block"))
        .applyInPandas(score, _SCORED_SQL.format(kind=kind))
    )
    return written(rows, "scored", ["kind"])


def weights(contexts: DataFrame, model: Model) -> DataFrame:
    """Per block and bucket: log10 of alpha * (count + 1) of the contexts that the block wants."""

    def add_up(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        parts = [[unpacked(p) if i else unpacked_keys(p) for i, p in enumerate(row)]
                 for row in group["parts"]]
        known, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = np.zeros((len(known), 2 * CUTOFF + 1), np.int64)
        np.add.at(
            sums, which, np.concatenate([np.stack(p[2:], axis=1).astype(np.int64) for p in parts])
        )
        found = model.log_weights(sums[:, :CUTOFF], sums[:, CUTOFF : 2 * CUTOFF], sums[:, -1])
        ends = np.cumsum([len(p[0]) for p in parts])[:-1]
        out = [
            (int(block), key[0], packed(w[p[1] > 0]))
            for block, w, p in zip(group["block"], np.split(found[which], ends), parts, strict=True)
            if p[1].any()
        ]
        return pd.DataFrame(out, columns=["block", "bucket", "weights"])

    return contexts.groupBy("bucket").applyInPandas(
        add_up, "block bigint, bucket bigint, weights binary"
    )


def finished(texts: DataFrame, found: DataFrame, kind: str) -> DataFrame:
    """A row per text: key, train, n_tokens, n_known, base_score and score."""

    def finish(text_rows: pd.DataFrame, weight_rows: pd.DataFrame) -> pd.DataFrame:
        row = text_rows.iloc[0]
        train, lengths, known, base, scores, backed, place = map(unpacked, row["parts"])
        ordered = weight_rows.sort_values("bucket")["weights"]
        table = np.concatenate([np.zeros(0), *map(unpacked, ordered)])
        text = np.repeat(np.arange(len(backed)), backed)
        scores = scores + np.bincount(text, weights=table[place], minlength=len(backed))
        return pd.DataFrame(
            {
                "key": list(row["keys"]),
                "train": train.astype(bool),
                "n_tokens": lengths.astype(np.int64),
                "n_known": known.astype(np.int64),
                "base_score": base,
                "score": scores,
            }
        )

    return (
        texts.groupBy("block")
        .cogroup(found.groupBy("block"))
        .applyInPandas(
            finish,
            f"key {kind}, train boolean, n_tokens bigint, n_known bigint, base_score double, "
            "score double",
        )
    )


def fitted(table: DataFrame) -> tuple[DataFrame, Model, dict[int, int]]:
    """The n-gram table of blocks, what all blocks know of it, and its buckets (bits) by order."""
    sizes = table.agg(F.sum("n_tokens").alias("n"), F.sum("n_words").alias("w")).first()
    bits = {1: bits_for(sizes["w"] or 0), 2: bits_for(sizes["n"] or 0)}
    ngrams = totals(requests(table, bits))
    sums = [F.sum(s).alias(s) for s in _STATS]
    rows = ngrams.filter("kind = 'model'").groupBy("order").agg(*sums).collect()
    return ngrams, Model.of({r["order"]: r.asDict() for r in rows}), bits


def scored(
    docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per row of the input: key, held_out, n_tokens, n_known, train_tokens, both scores.

    `train` says which rows are learned from (null: no); all are scored. `base_score` is that of
    single words with half a count added to each, `score` the model's log10 probability. Null and
    empty texts are one token, the end. Repeated rows count as often as they stand; rows without a
    key are rows like others; other columns are ignored; an empty table gives no rows. Without any
    training text all words are unknown and every score is 0.
    """
    kind = docs.schema[key].dataType.simpleString()
    table = blocks(docs, train, key, text)
    ngrams, model, bits = fitted(table)
    answers = ngrams.filter("kind = 'answer'")
    rows = partly_scored(table, answers, model, bits[1], kind)
    found = weights(rows.filter("kind = 'context'"), model)
    done = finished(rows.filter("kind = 'texts'"), found, kind)
    return done.select(
        F.col("key").alias(key),
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
