import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabvitals.llm import katz

SCHEMA = "doc_id int, text string, train boolean, score string"


def rows():
    rnd = random.Random(6)
    vocabulary = [f"w{int(rnd.paretovariate(0.9))}" for _ in range(400)]
    out = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([0, 3, 40]))), i % 5 != 1, "s") for i in range(200)]
    out += [(300, None, True, "s"), (301, None, False, "s"), (302, "", True, "s"), (None, "W1 w2\tnever", False, "s")]
    return out + [(303, "w1 w1 ÄW1", True, "s")] * 3 + [(304, "w1 " * 5000, None, "s")]


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return lowered.split() + [None]


class Plain:
    """The model, n-gram by n-gram."""

    def __init__(self, texts):
        self.one, self.two, self.context = Counter(), Counter(), Counter()
        for text in texts:
            before = "start"
            for word in tokens(text):
                self.one[word] += 1
                self.two[before, word] += 1
                self.context[before] += 1
                before = (word,)
        self.n = sum(self.one.values())
        self.d1, self.d2 = (
            katz.discounts([sum(v == r for v in c.values()) for r in range(1, 7)])
            for c in (self.one, self.two)
        )
        self.unknown = 1 - sum(map(self.word, self.one))
        left, seen = Counter(), Counter()
        for (h, w), c in self.two.items():
            left[h] += self.d(self.d2, c) * c / (self.context[h] + 1)
            seen[h] += self.word(w)
        self.alpha = {h: (1 - left[h]) / (1 - seen[h]) for h in left}

    @staticmethod
    def d(table, c):
        return table[c] if c <= katz.CUTOFF else 1.0

    def word(self, w):
        c = self.one[w]
        return self.d(self.d1, c) * c / (self.n + 1) if c else self.unknown

    def pair(self, h, w):
        c = self.two[h, w]
        if c:
            return self.d(self.d2, c) * c / (self.context[h] + 1)
        return self.alpha.get(h, 1.0) * self.word(w)

    def score(self, text):
        before, out = "start", 0.0
        for word in tokens(text):
            out += math.log10(self.pair(before, word))
            before = (word,)
        return out


@pytest.mark.parametrize("block_tokens, bucket_keys", [(4_000_000, 1_000_000), (300, 200)])
def test_against_brute_force(spark, monkeypatch, block_tokens, bucket_keys):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", block_tokens)
    monkeypatch.setattr(katz, "BUCKET_KEYS", bucket_keys)
    data = rows()
    plain = Plain([t for _, t, train, _ in data if train])
    out = katz.scored(spark.createDataFrame(data, SCHEMA).repartition(3), F.col("train")).collect()
    assert len(out) == len(data)
    texts = {(k, bool(train)): t for k, t, train, _ in data}
    types = len(plain.one)
    for r in out:
        text = texts[r.doc_id, not r.held_out]
        mine = tokens(text)
        assert r.n_tokens == len(mine) and r.train_tokens == plain.n
        assert r.n_known == sum(w in plain.one for w in mine)
        base = sum(math.log10((plain.one[w] + 0.5) / (plain.n + 0.5 * (types + 1))) for w in mine)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(plain.score(text), rel=1e-9)


def test_probabilities_add_up_to_one():
    plain = Plain([t for _, t, train, _ in rows() if train])
    assert sum(map(plain.word, plain.one)) + plain.unknown == pytest.approx(1)
    for h in plain.alpha:
        total = sum(plain.pair(h, w) for w in plain.one) + plain.alpha[h] * plain.unknown
        assert total == pytest.approx(1)
        assert plain.alpha[h] > 0


def test_discounts():
    assert katz.discounts([0] * 6).tolist() == [1.0] * 6
    found = katz.discounts([1000, 400, 200, 120, 80, 60])
    assert all(0 < x < 1 for x in found[1:])


def test_packing():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 1000):
        for values in (rnd.integers(-100, 100, n), rnd.integers(0, 1 << 40, n), rnd.random(n)):
            assert katz.unpacked(katz.packed(values)).tolist() == values.tolist()
        keys = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        assert katz.unpacked_keys(katz.packed_keys(keys)).tolist() == keys.tolist()
        parts = list(katz.bucket_slices(keys, 4))
        assert sum(s.stop - s.start for _, s in parts) == len(keys)
        assert all((keys[s] >> np.uint64(60) == b).all() for b, s in parts)


def test_nothing_to_learn_from(spark):
    data = [(1, "a b", False, "s"), (2, None, False, "s")]
    out = katz.scored(spark.createDataFrame(data, SCHEMA), F.col("train")).orderBy("doc_id").collect()
    assert [(r.n_known, r.train_tokens, r.score) for r in out] == [(0, 0, 0.0)] * 2
    assert katz.scored(spark.createDataFrame([], SCHEMA), F.col("train")).count() == 0
