import hashlib
import random
import re
import time

import pyarrow.parquet as pq
import pytest

from tabvitals.llm import pii

BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(ds(m)) <= 19 and slow_luhn(ds(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(ds(m)) <= 15),
]


def ds(text):
    return [int(c) for c in text if c in "0123456789"]


def slow_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base(text):
    return sorted(
        (m.start(), order, m.end())
        for order, (_, pattern, valid) in enumerate(BASE)
        for m in re.finditer(pattern, text or "")
        if valid(m[0])
    )


def own_base(text):
    return [(a, o, z) for a, o, z, _ in pii.spans(text) if o < len(BASE)]


def random_texts(n, seed=3):
    rnd = random.Random(seed)
    pool = list(" ..@@--++()0123456789 aZ_%é😀\n:/") + [
        "555-0199", "4111111111111111", "4111 1111 1111 1111", "10.0.0.1", "256.1.1.1", "a@b.co", "x.y@z-1.com.",
        "+49 30 1234567", "call", "card", "1.2.3.4.5.6.7.8", "000.00001.2.3", "٣", "12-34",
    ]
    return ["".join(rnd.choices(pool, k=rnd.randint(0, 40))) for _ in range(n)]


def test_base_spans_against_brute_force():
    given = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    texts = [None, "", *random_texts(4000), *given]
    assert [own_base(t) for t in texts] == [base(t) for t in texts]
    assert {o for t in texts for _, o, _ in base(t)} == {0, 1, 2, 3}


def test_base_spans_in_all_short_texts_of_few_characters():
    rnd = random.Random(8)
    for letters in ("a@.", "1.", "1 -", "+1 ("):
        for _ in range(3000):
            text = "".join(rnd.choices(letters, k=rnd.randint(1, 24)))
            assert own_base(text) == base(text), text


@pytest.mark.parametrize(
    ("kind", "good", "bad"),
    [
        ("iban", "account DE89370400440532013000 of", "account DE89370400440532013001 of"),
        ("iban", "to GB82 WEST 1234 5698 7654 32, now", "to GB82 WEST 1234 5698 7654 33, now"),
        ("ssn", "his social security number 219-09-9999", "the number 219-09-9999"),
        ("ssn", "ssn 219-09-9999", "ssn 666-09-9999"),
        ("nhs", "NHS patient 943 476 5919", "NHS patient 943 476 5918"),
        ("cpf", "o cpf 529.982.247-25 foi", "o cpf 529.982.247-26 foi"),
        ("nir", "numéro insee 1 84 12 76 451 089 46.", "numéro insee 1 84 12 76 451 089 47."),
        ("dni", "dni 12345678Z", "dni 12345678A"),
        ("dni", "nie X1234567L", "12345678Z"),
        ("tax_id", "Steuer-ID 86095742719", "Steuer-ID 86095742718"),
        ("routing", "routing number 021000021", "routing number 021000022"),
        ("birth", "born on 24-12-1980", "on 24-12-1980"),
        ("birth", "date of birth: 1980-12-24", "born 1980-13-44"),
        ("passport", "passport C01234567", "the C01234567"),
        ("local_phone", "call (407) 555-7710", "the (407) 555-7710"),
        ("ipv6", "from 2001:db8::ff00:42:8329 to", "at 12:30:45 to"),
        ("mac", "device 00:1a:2b:3c:4d:5e", "device 00:1a:2b-3c:4d:5e"),
    ],
)
def test_further_kinds(kind, good, bad):
    def kinds(text):
        return [pii.NAMES[o] for _, o, _, _ in pii.spans(text)]

    assert kind in kinds(good)
    assert kind not in kinds(bad)


def test_checksums_catch_every_changed_digit():
    for name, text in (("iban", "GB82WEST12345698765432"), ("cpf", "529.982.247-25")):
        valid = next(k.valid for k in pii.KINDS if k.name == name)
        assert valid(text)
        for i in [i for i, c in enumerate(text) if c.isdigit()]:
            others = [text[:i] + d + text[i + 1 :] for d in "0123456789" if d != text[i]]
            assert not any(valid(t) for t in others)


def test_context_moves_scores():
    def score(text):
        return pii.spans(text)[0][3]

    card = "4111111111111111"
    assert score(f"my credit card {card}") > score(f"so it is {card}") > score(f"order {card}")
    far = "credit card" + " word" * 30
    assert score(f"{far} {card}") == score(card)
    assert score(f"{card}, a visa") == score(f"visa {card}")


def test_spans_of_other_kinds_do_not_overlap():
    for text in random_texts(2000, seed=4):
        found = pii.spans(f"phone, ssn, nhs, tin, born: {text}")
        others = [s for s in found if s[1] >= len(BASE)]
        for s in others:
            assert not [t for t in found if t is not s and t[0] < s[2] and s[0] < t[2]]
            assert s[3] >= pii.LEAST


def test_long_texts_take_linear_time():
    for unit in ("a", "1", "1 ", "a@", "1.", "+1 ", ":", "ab:", "DE44 ", "(111) ", "-", "x1-"):
        text = unit * (600_000 // len(unit))
        start = time.perf_counter()
        pii.spans(text)
        assert time.perf_counter() - start < 15, unit
    hidden = "word " * 200_000 + "a@b.co"
    assert pii.spans(hidden) == [(1_000_000, 0, 1_000_006, 0.6)]


def test_frames(spark):
    texts = [None, "", "mail a@b.co, card 4111 1111 1111 1111, iban DE89370400440532013000", "x" * 100_000, "😀 a@b.co"]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, texts[2], "s"), (2, texts[2], "s")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    out = pii.digest(pii.found(frame)).collect()
    assert len(out) == len(rows)
    for r in out:
        text = texts[2 if r.doc_id is None else r.doc_id]
        found = base(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in found) for k in range(4)]
        listed = ",".join(f"{BASE[o][0]}:{a}:{z}" for a, o, z in found)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.spans == ",".join(f"{pii.NAMES[o]}:{a}:{z}" for a, o, z, _ in pii.spans(text))
    masked = {r.doc_id: r.text for r in pii.masked(frame).collect()}
    assert masked[2] == "mail [email], card [card], iban [iban]" and masked[0] is None
    assert pii.masked(frame).columns == frame.columns
    assert pii.digest(pii.found(frame.limit(0))).count() == 0
