import hashlib
import math
import random
import re
import time
from collections import Counter

from tabvitals.llm import secrets

BASE = [
    ("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
RUN, JOINED = r"[A-Za-z0-9]{20,}", r"[A-Za-z0-9+/_=-]{20,}"
SEGMENT = "([A-Za-z]+[0-9]{0,4}|[0-9]{0,8})"
NAMES = [
    rf"{SEGMENT}([-_/=+]{SEGMENT})*",
    "[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
]


def base(text):
    return sorted(
        (m.start(), order, m.end())
        for order, (_, pattern, group, least) in enumerate(BASE)
        for m in re.finditer(pattern, text or "")
        if len(m.group(group)) >= least
    )


def entropy(text):
    return -sum(c / len(text) * math.log2(c / len(text)) for c in Counter(text).values())


def reached(match, kind, limit):
    """From the first window at the limit to the last, unless that is on the allow-list."""
    at = [i for i in range(len(match[0]) - 19) if entropy(match[0][i : i + 20]) >= limit]
    if at:
        found = match[0][at[0] : at[-1] + 20]
        if not any(re.search(p, found) for p in secrets.ALLOWED):
            yield match.start() + at[0], kind, match.start() + at[-1] + 20


def kind_of(run):
    if re.fullmatch("[0-9a-fA-F]+", run):
        return 3, secrets.HEX_BITS
    single = re.fullmatch("[0-9A-Z]+|[0-9a-z]+", run)
    return (4, secrets.SINGLE_BITS) if single else (5, secrets.MIXED_BITS)


def within(span, others):
    return any(o[0] <= span[0] and span[2] <= o[2] for o in others)


def added(text):
    text, runs, joined = text or "", [], []
    for m in re.finditer(RUN, text):
        if not re.fullmatch("[A-Za-z]+[0-9]{0,4}|[0-9]+", m[0]):
            runs += reached(m, *kind_of(m[0]))
    for m in re.finditer(JOINED, text):
        if re.search("[-+/_=]", m[0]) and not any(re.fullmatch(p, m[0]) for p in NAMES):
            joined += reached(m, 6, secrets.JOINED_BITS)
    joined = [s for s in joined if all(re.search(c, text[s[0] : s[2]]) for c in ("[a-z]", "[A-Z]", "[0-9]"))]
    joined = [s for s in joined if not within(s, base(text))]
    return [s for s in runs if not within(s, base(text)) and not within(s, joined)] + joined


def listed(spans):
    return ",".join(f"{secrets.KINDS[o]}:{a}:{b}" for a, o, b in sorted(spans))


def texts():
    rnd = random.Random(5)
    alphabet = secrets.ALPHABET
    pool = [
        "token", "Secret", "api_key", "APIKEY", "=", ":", " ", "\n", "é", "😀", "'", '"', "abc", "AKIA",
        "0123456789abcdef", "word", "password:token: abcdefg", "x" * 30, "some-long-name-of-a-thing-12",
        "123e4567-e89b-12d3-a456-426614174000", "example", "ſecret", "toKen",
    ]
    out = [None, "", "password:token: abcdefg", "Zx9Kq2Lm8Tr5Wv1Yb7Nc4Hj6" * 300]
    for _ in range(250):
        parts = rnd.choices(pool, k=rnd.randint(1, 12))
        parts += ["".join(rnd.choices(alphabet, k=rnd.randint(18, 60))) for _ in range(rnd.randint(0, 2))]
        parts += ["".join(rnd.choices("0123456789ABCDEF", k=rnd.randint(18, 50)))]
        parts += ["".join(rnd.choices("0123456789abcdef", k=rnd.randint(18, 50)))]
        rnd.shuffle(parts)
        out.append(rnd.choice(["", " "]).join(parts))
    return out


def test_against_brute_force(spark):
    many = texts()
    rows = [(i, t, "x") for i, t in enumerate(many)] + [(None, many[7], "x"), (7, many[7], "x")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, spans string")
    out = secrets.digest(secrets.found(frame)).collect()
    assert len(out) == len(rows)
    n_added = 0
    for r in out:
        text = many[7 if r.doc_id is None else r.doc_id]
        spans = base(text)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert r.base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert r.spans == listed(spans + added(text)), text
        n_added += len(added(text))
    assert n_added > 20
    assert secrets.digest(secrets.found(frame.limit(0))).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    frame = spark.createDataFrame([(1, "x")], "doc_id int, text string")
    secrets.digest(secrets.found(frame)).explain("simple")
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange" not in plan


def test_secrets_joined_to_other_text_are_found_whole(spark):
    """Random secrets of many kinds, behind prefixes and alone."""
    rnd = random.Random(11)
    upper_hex, base62 = "0123456789ABCDEF", secrets.ALPHABET[:62]
    kinds = [
        ("", upper_hex, 32), ("key=", upper_hex, 32), ("HMAC=", upper_hex, 32), ("id-", upper_hex, 32),
        ("", "abcdefghijklmnopqrstuvwxyz0123456789", 20), ("", "abcdefghijklmnopqrstuvwxyz0123456789", 24),
        ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 32), ("examples/", base62, 40), ("x=", base62, 32),
        ("", base62 + "+/", 40), ("AWS_KEY:", base62 + "+/", 40),
    ]
    rows = []
    for k, (prefix, letters, n) in enumerate(kinds):
        for _ in range(300):
            secret = "".join(rnd.choices(letters, k=n))
            rows.append((k, f"see {prefix}{secret} there", 4 + len(prefix), 4 + len(prefix) + n))
    frame = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows)], "doc_id int, text string")
    covered = [0] * len(kinds)
    for r in secrets.found(frame).collect():
        k, _, start, end = rows[r.doc_id]
        spans = [*r["assign"], *r["access"], *r["hex"], *r["entropy"]]
        covered[k] += any(s["start"] <= start and end <= s["end"] for s in spans)
    assert all(c >= 0.95 * 300 for c in covered), covered


def test_names_and_numbers_are_left_alone(spark):
    texts = [
        "Donaudampfschifffahrtsgesellschaft und Rechtsschutzversicherungsgesellschaften",
        "internationalization2024 some-long-name-of-a-thing-12 usr/local/share/python3/lib-dynload",
        "123e4567-e89b-12d3-a456-426614174000 2024-05-06/07-08-09_10-11-12 +49-30-1234567-890-1234",
        "password = example and YOUR_TOKEN_0123456789abcdefghijk xxxxxxxxxxxxxxxxxxxxxxxxx1A",
        "camelCaseNamesOfManyWordsThatGoOnAndOn99 SCREAMING_SNAKE_CASE_OF_CONSTANTS_42",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert [r.entropy for r in secrets.found(frame).orderBy("doc_id").collect()] == [[]] * len(texts)


def test_long_texts(spark):
    """A megabyte with one hit, with very many, and of one run: time grows with the text only."""
    rnd = random.Random(12)
    prose = "The quick brown fox jumps over a lazy dog, and then some. " * 17_500
    texts = [
        prose[:500_000] + "0123456789abcdef" * 2 + prose[500_000:],
        "token = abcdef123; " * 50_000,
        "a-" * 500_000,
        "x " + " ".join("".join(rnd.choices(secrets.ALPHABET, k=40)) for _ in range(2_000)),
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    start = time.perf_counter()
    out = {r.doc_id: r for r in secrets.digest(secrets.found(frame)).collect()}
    assert time.perf_counter() - start < 60
    assert [out[i].n_hex for i in range(3)] == [1, 0, 0] and out[1].n_assign == 50_000
    for i, text in enumerate(texts[:3]):
        assert out[i].base_sha256 == hashlib.sha256(listed(base(text)).encode()).hexdigest()
    assert out[3].spans == listed(base(texts[3]) + added(texts[3]))
