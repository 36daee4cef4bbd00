import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from tabvitals.llm import decontaminate as d
from tabvitals.llm.common import WordHashes, plain_words

ITEMS = pq.read_table("/root/testdata/sf0.01/benchmark.parquet").to_pylist()


def distance(item, words):
    """Fewest edits from the item to any run of the words."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        above, row = row, [i] + [0] * len(words)
        for j, b in enumerate(words, 1):
            row[j] = min(above[j - 1] + (a != b), above[j] + 1, row[j - 1] + 1)
    return min(row)


def edited(rnd, words, k, others):
    words = list(words)
    for _ in range(k):
        at, how = rnd.randrange(len(words)), rnd.choice("sid")
        if how == "d" and len(words) > 1:
            del words[at]
        elif how == "i":
            words.insert(at, rnd.choice(others))
        else:
            words[at] = rnd.choice(others)
    return words


def corpus(rnd, n):
    """Texts with items, edited up to the limit and beyond, between other words."""
    other = [w.decode() for t in ITEMS[:100] for w in plain_words(t["text"])]
    out = []
    for i in range(n):
        item = [w.decode() for w in plain_words(ITEMS[i % len(ITEMS)]["text"])]
        k = rnd.choice([0, 1, d.most_edits(len(item)), d.most_edits(len(item)) + 3])
        before, after = (rnd.choices(other, k=rnd.choice([0, 1, 80])) for _ in range(2))
        out.append(" ".join(before + edited(rnd, item, k, other) + after))
    return out


def test_edit_distance():
    rnd = random.Random(1)
    for _ in range(300):
        a = [rnd.randrange(4) for _ in range(rnd.randint(1, 8))]
        b = [rnd.randrange(4) for _ in range(rnd.randint(0, 12))]
        edits, _ = d.least_edits(np.array(a, np.uint64), np.array(b, np.uint64))
        assert edits == distance(a, b)


def test_recall_against_brute_force():
    """At least 99 % of what brute force finds, and nothing else."""
    rnd = random.Random(2)
    index = d.indexed([(t["item_id"], t["text"]) for t in ITEMS])
    hashes = WordHashes()
    texts = corpus(rnd, 160)
    words = [hashes.of(plain_words(t)) for t in texts]
    got = {(i, index.ids[n]): e for i, n, e, _ in d.matches(index, words)}
    expected = {}
    for i, text in enumerate(texts):
        mine = plain_words(text)
        for t in rnd.sample(ITEMS, 8) + [ITEMS[i % len(ITEMS)]]:
            item = plain_words(t["text"])
            edits = distance(item, mine)
            if edits <= d.most_edits(len(item)):
                expected[i, t["item_id"]] = edits
            else:
                assert (i, t["item_id"]) not in got
    assert len(expected) > 100
    missed = [k for k, e in expected.items() if got.get(k) != e]
    assert len(missed) <= 0.01 * len(expected)


@pytest.mark.parametrize("size", [100, 250, 500, 1000])
def test_recall_of_long_items(size):
    """At least 99 % of long passages with as many edits as allowed, and none with too many."""
    rnd = random.Random(size)
    other = [w.decode() for t in ITEMS for w in plain_words(t["text"])]
    items = [rnd.choices(other, k=size) for _ in range(4)]
    hashes = WordHashes()
    index = d.indexed([(i, " ".join(item)) for i, item in enumerate(items)])
    texts, expected = [], {}
    for i in range(100):
        k = d.most_edits(size) * (3 if i % 5 == 0 else 1)
        text = rnd.choices(other, k=40) + edited(rnd, items[i % 4], k, other) + rnd.choices(other, k=40)
        texts.append(hashes.of(plain_words(" ".join(text))))
        edits, _ = d.least_edits(index.items[i % 4], texts[-1])
        if edits <= d.most_edits(size):
            expected[i, i % 4] = edits
    got = {(i, n): e for i, n, e, _ in d.matches(index, texts)}
    assert len(expected) == 80 and set(got) <= set(expected)
    missed = [k for k, e in expected.items() if got.get(k) != e]
    assert len(missed) <= 0.01 * len(expected)


def test_pieces_share_the_edits_of_their_item():
    for n in range(1, 3000):
        cut = d.pieces(n)
        assert [a for a, _ in cut] == [sum(size for _, size in cut[:i]) for i in range(len(cut))]
        assert sum(size for _, size in cut) == n and 0 < max(size for _, size in cut) <= d.PIECE
        assert sum(d.most_edits(size) + 1 for _, size in cut) > d.most_edits(n)


def test_every_match_keeps_a_seed():
    for n in range(1, 200):
        k, q = d.most_edits(n), d.seed_words(n)
        assert 1 <= q <= 3 and (k + 1) * (q - 1) < n - k + (k + 1) * 0 + (q == 1)


def test_frames(spark):
    item = ITEMS[0]["text"]
    rows = [(1, None, "a"), (2, "", "b"), (3, f"So. {item.upper()} End", "c"), (None, item, "d")]
    rows += [(5, "nothing here", "e"), (6, item, "f"), (6, item, "f"), (7, "w " * 30_000 + item, "g")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, item_id string")
    items = [(t["item_id"], t["text"]) for t in ITEMS[:20]] + [(900, None), (901, ""), (902, item)]
    items = spark.createDataFrame(items, "item_id bigint, text string")
    for most_words in (d.BLOCK_WORDS, 50):
        out = d.found(frame, items, most_words=most_words).collect()
        got = sorted((str(r.doc_id), r.item_id, r.edits) for r in out)
        own = sorted((k, i, 0) for k in ["3", "None", "6", "6", "7"] for i in (ITEMS[0]["item_id"], 902))
        assert got == own
        kept = frame.filter(~d.holds(frame["text"], items, most_words=most_words)).collect()
        assert sorted(r.doc_id for r in kept) == [1, 2, 5]
    assert d.found(frame.limit(0), items).count() == 0
    assert d.found(frame, items.limit(0)).count() == 0
