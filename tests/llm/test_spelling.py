import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabvitals.llm import spelling
from tabvitals.llm.fm_index import LEFT, RIGHT, BidirectionalIndex, suffix_order


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    small, large = sorted((a, b), key=len)
    return len(large) - len(small) == 1 and any(large[:i] + large[i + 1 :] == small for i in range(len(large)))


def words_of(rows, thin):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if thin and h % thin == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute(rows, thin=None):
    words = words_of(rows, thin)
    variants = defaultdict(set)  # words that share one of these may be near
    for w in words:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            variants[v].add(w)
    near = defaultdict(set)
    for group in variants.values():
        for a in group:
            near[a] |= {b for b in group if distance_one(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def result(frame):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect())


def test_suffix_order():
    rnd = random.Random(2)
    for _ in range(100):
        words = sorted({"".join(rnd.choices("ab", k=rnd.randint(1, 6))) for _ in range(8)})
        text = [0] + [c for w in words for c in [*(ord(x) for x in w), 0]]
        ends = [i for i, c in enumerate(text) if c == 0]
        keys = [tuple((c, i if c == 0 else 0) for i, c in enumerate(text[s:], s)) for s in range(len(text))]
        assert suffix_order(np.array(text)).tolist() == sorted(range(len(text)), key=keys.__getitem__)
        assert suffix_order(np.array(text)).tolist()[: len(ends)] == ends


def test_search_scheme_against_brute_force():
    rnd = random.Random(1)
    for _ in range(40):
        letters = "abcé"[: rnd.randint(1, 4)]
        words = sorted({"".join(rnd.choices(letters, k=rnd.randint(2, 7))) for _ in range(rnd.randint(1, 60))})
        asked = ["".join(rnd.choices(letters + "zñ", k=rnd.randint(2, 8))) for _ in range(40)] + words
        index, halves = BidirectionalIndex(words), np.array([len(q) // 2 for q in asked])
        lengths = np.array([len(q) for q in asked])
        first = set(zip(*index.near(asked, halves, RIGHT).tolist(), strict=True))
        second = set(zip(*index.near(asked, lengths - halves, LEFT).tolist(), strict=True))
        for i, q in enumerate(asked):
            for j, w in enumerate(words):
                near = distance_one(q, w)
                assert ((i, j) in first) == (near and w.startswith(q[: len(q) // 2]))
                assert ((i, j) in second) == (near and w.endswith(q[len(q) // 2 :]))
                assert near == ((i, j) in first | second)


def test_many_suffixes_try_all_letters():
    words = sorted({f"{a}{b}{c}xyz" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"})
    index = BidirectionalIndex(words)
    at, to = index.near(words, np.full(len(words), 3), LEFT)
    assert Counter(at.tolist()) == {i: 21 for i in range(len(words))}
    assert all(distance_one(words[a], words[b]) for a, b in zip(at, to, strict=True))


def corpus(seed=7, n=300):
    rnd = random.Random(seed)
    stems = ["".join(rnd.choices("aeinrstéÀ", k=rnd.randint(4, 9))) for _ in range(60)]
    texts = []
    for i in range(n):
        words = rnd.choices(stems, weights=[1 / (k + 1) for k in range(60)], k=60)
        for j in range(0, len(words), 9):
            w, at = words[j], rnd.randrange(len(words[j]))
            words[j] = rnd.choice([w[:at] + w[at + 1 :], w[:at] + rnd.choice("aé") + w[at:], w.upper()])
        texts.append((i, rnd.choice([" ", "-", "\n", "9"]).join(words)))
    return texts


@pytest.mark.parametrize("block", [spelling.BLOCK, 300, 20])
def test_against_brute_force(spark, block):
    rows = [*corpus(), (None, "Straße straße"), (1000, None), (1001, ""), (1, "same same")]
    rows += [(2000 + i, f"{'longer' * 400} {'longer' * 400}x abcdef abcdeg abcdeh") for i in range(6)]
    rows += [(3000, "abcdeg " * 30), (3000, "abcdeg " * 30), (3001, "abcdefg " * 400)]
    frame = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id bigint, text string, word int")
    out = result(spelling.grouped(frame, thin=7, block=block))
    assert out == brute(rows, thin=7)
    assert sum(r[1] is not None for r in out) > 5 and any(r[1] != r[2] for r in out if r[1])


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = result(spelling.grouped(docs, thin=199))
    assert out == brute(rows, thin=199)
    assert any(r[1] for r in out)


def test_without_words(spark):
    frame = spark.createDataFrame([(1, None), (2, "a b c"), (3, "123 ...")], "doc_id int, text string")
    assert spelling.grouped(frame).count() == 0
    assert spelling.grouped(frame.limit(0)).count() == 0


def test_words_of_a_common_half(spark):
    """A third of all words share their first half; they are dealt to several parts."""
    rnd = random.Random(4)
    words = {"common" + "".join(rnd.choices("abc", k=6)) for _ in range(700)}
    words |= {"".join(rnd.choices("defghi", k=8)) for _ in range(500)}
    frame = spark.createDataFrame([(1, " ".join(w for w in words for _ in range(5)))], "doc_id int, text string")
    whole = result(spelling.grouped(frame))
    assert whole == result(spelling.grouped(frame, block=2000)) == brute([(1, " ".join(sorted(words) * 5))])
