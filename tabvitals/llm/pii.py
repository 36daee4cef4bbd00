"""Personal data in texts: patterns propose, checksums confirm, words nearby adjust the score.

Every kind has a pattern that proposes spans, a validator that confirms or drops them, and a score
to start from. A validator is a checksum where the kind has one (Luhn, mod 97, mod 11, mod 23),
else a rule of the format. Words that stand near a span and speak of its kind raise the score, and
words that speak of something else (orders, versions, examples) lower it. The four base kinds are
reported whatever their score. Others need `LEAST`, and most reach it only with a word of their
kind nearby; where two kinds claim the same characters, the base kind stays, then the higher score.

Patterns are tried in time linear in the text: each starts from a character that is rare or from
the edge of its run. One pass over whole texts in Arrow batches, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabvitals.llm.common import sha256

LEAST = 0.5  # score from which a span beyond the base kinds is reported
NEARBY = 60  # characters on either side in which words count
RAISED, LOWERED = 0.35, 0.3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NO_DIGIT = re.compile("[^0-9]+")


def _digits(text: str) -> str:
    return _NO_DIGIT.sub("", text)


def luhn(digits: str) -> bool:
    """From the right, every second digit doubled, and its digits added: a multiple of 10."""
    total = sum(map(int, digits[::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(code: str) -> bool:
    """An account number: its first four characters moved to the end, letters as numbers, mod 97."""
    rest = 0
    for c in code[4:] + code[:4]:
        value = int(c, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def weighted(digits: str, weights: Iterator[int] | range) -> int:
    return sum(int(d) * w for d, w in zip(digits, weights, strict=False))


def _is_ip(text: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in text.split(".")))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


#: Countries of account numbers, with the length of theirs.
_IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22,
    "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20,
    "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18,
    "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30,
    "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28,
    "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "TN": 24, "TR": 26, "UA": 29, "XK": 20,
}


def _iban(text: str) -> int:
    """How many characters of the proposed run are an account number, 0 if none."""
    length = _IBAN_LENGTHS.get(text[:2].upper(), 0)
    code = text.replace(" ", "").upper()
    if not length or len(code) < length or not mod97(code[:length]):
        return 0
    end = 0
    while length:
        length -= text[end] != " "
        end += 1
    return 0 if end < len(text) and text[end] != " " else end


def _is_ssn(text: str) -> bool:
    area, group, serial = re.split("[- ]", text)
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _is_nhs(text: str) -> bool:
    digits = _digits(text)
    check = -weighted(digits, range(10, 1, -1)) % 11
    return check == int(digits[9])


def _is_cpf(text: str) -> bool:
    digits = _digits(text)
    first = weighted(digits, range(10, 1, -1)) * 10 % 11 % 10
    second = weighted(digits, range(11, 1, -1)) * 10 % 11 % 10
    return len(set(digits)) > 1 and digits[9:] == f"{first}{second}"


def _is_nir(text: str) -> bool:
    """A French number: 13 characters, and a key of two digits by mod 97."""
    code = text.replace(" ", "").upper().replace("2A", "19").replace("2B", "18")
    return code.isdigit() and len(code) == 15 and 97 - int(code[:13]) % 97 == int(code[13:])


def _is_dni(text: str) -> bool:
    """A Spanish number: eight digits, and a letter by mod 23."""
    code = text.upper().replace("-", "")
    number = str("XYZ".find(code[0])) + code[1:-1] if code[0] in "XYZ" else code[:-1]
    return "TRWAGMYFPDXBNJZSQVHLCKE"[int(number) % 23] == code[-1]


def _is_tax_id(text: str) -> bool:
    """A German number: eleven digits by mod 11, 10, one of the first ten two or three times."""
    digits, product = _digits(text), 10
    for d in digits[:10]:
        product = ((int(d) + product) % 10 or 10) * 2 % 11
    repeats = sorted(digits[:10].count(d) for d in set(digits[:10]))
    check = (11 - product) % 10
    return digits[0] != "0" and check == int(digits[10]) and 2 <= repeats[-1] <= 3


def _is_routing(text: str) -> bool:
    """An American bank number: digits weighted 3, 7, 1 by mod 10."""
    return text > "01" and weighted(text, [3, 7, 1] * 3) % 10 == 0


def _is_date(text: str) -> bool:
    parts = [int(p) for p in re.split("[-./]", text)]
    if parts[0] > 31:
        parts = parts[::-1]
    return 1900 <= parts[2] <= 2025 and 1 <= max(parts[:2]) <= 31 and 1 <= min(parts[:2]) <= 12


def _is_ipv6(text: str) -> bool:
    left, gap, right = text.partition("::")
    if "::" in right:
        return False
    groups = [g for side in (left, right) if side for g in side.split(":")]
    if any(not g or len(g) > 4 for g in groups):
        return False
    return (len(groups) < 8 and len(groups) > 2) if gap else len(groups) == 8


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: what proposes it, what confirms it, and its score.

    `words` are stems of words that raise the score, matched from the start of a word.
    """

    name: str
    pattern: str
    valid: Callable[[str], bool | int]
    score: float
    words: str
    base: bool = False


_EDGE, _END = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
KINDS = [
    Kind(
        "email", "", lambda text: True, 0.6,
        "e-?mail|mail|contact|write|schreib|correo|courriel|kontakt|contacto", True,
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", _is_ip, 0.5,
        "ip|host|server|address|adresse|client|login|direcci", True,
    ),
    Kind(
        "card", r"[0-9]([\x20-]?[0-9])+", _is_card, 0.6,
        "card|credit|debit|visa|master|amex|kredit|karte|tarjeta|carte|pay|cvv|cvc", True,
    ),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]", _is_phone, 0.5,
        "phone|call|tel|mobile|cell|fax|whatsapp|handy|anruf|llam|movil|móvil|appel", True,
    ),
    Kind(
        "iban", _EDGE + r"[A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){10,40}", _iban, 0.8,
        "iban|account|bank|konto|cuenta|compte|swift|bic",
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}([- ])[0-9]{2}\1[0-9]{4}(?![0-9-])", _is_ssn, 0.2,
        "ssn|social|security|taxpayer",
    ),
    Kind(
        "nhs", r"(?<![0-9-])[0-9]{3}[- ]?[0-9]{3}[- ]?[0-9]{4}(?![0-9-])", _is_nhs, 0.2,
        "nhs|patient|health",
    ),
    Kind(
        "cpf", r"(?<![0-9])[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}(?![0-9])", _is_cpf, 0.6,
        "cpf|cadastro|contribuinte",
    ),
    Kind(
        "nir",
        r"(?<![0-9])[12]\x20?[0-9]{2}\x20?[0-9]{2}\x20?[0-9][0-9AaBb]\x20?[0-9]{3}\x20?[0-9]{3}\x20?[0-9]{2}(?![0-9])",
        _is_nir, 0.3, "nir|insee|sécurité|securite|sociale|numéro|numero",
    ),
    Kind(
        "dni", _EDGE + r"(?:[0-9]{8}|[XYZxyz]-?[0-9]{7})-?[A-Za-z]" + _END, _is_dni, 0.4,
        "dni|nie|nif|documento|identidad",
    ),
    Kind(
        "tax_id", r"(?<![0-9])[0-9]{2}\x20?[0-9]{3}\x20?[0-9]{3}\x20?[0-9]{3}(?![0-9])",
        _is_tax_id, 0.2, "steuer|idnr|tin",
    ),
    Kind(
        "routing", r"(?<![0-9-])[0-9]{9}(?![0-9-])", _is_routing, 0.2,
        "routing|aba|rtn|transit",
    ),
    Kind(
        "birth", r"(?<![0-9.-])(?:[0-9]{1,2}([-./])[0-9]{1,2}\1[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9-])",
        _is_date, 0.2, "born|birth|dob|birthday|geboren|geburt|nacid|nacimiento|né|née|naissance",
    ),
    Kind(
        "passport", _EDGE + r"[A-Za-z]{1,2}[0-9]{6,8}" + _END, lambda text: True, 0.2,
        "passport|reisepass|pasaporte|passeport",
    ),
    Kind(
        "local_phone",
        r"(?<![0-9+(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-])",
        lambda text: True, 0.2, "phone|call|tel|mobile|cell|fax|dial|text",
    ),
    Kind(
        "ipv6", r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:.])",
        _is_ipv6, 0.5, "ip|ipv6|host|server|address|login",
    ),
    Kind(
        "mac", r"(?<![0-9A-Za-z:-])[0-9A-Fa-f]{2}([:-])(?:[0-9A-Fa-f]{2}\1){4}[0-9A-Fa-f]{2}(?![0-9A-Za-z:-])",
        lambda text: True, 0.4, "mac|device|hardware|ethernet|wifi|adapter",
    ),
]
NAMES = [k.name for k in KINDS]
BASE = [k.name for k in KINDS if k.base]
_LOWERING = re.compile(
    r"\b(?:example|sample|test|dummy|order|invoice|version|isbn|issn|serial|sku|part|model|"
    r"ticket|tracking|beispiel|ejemplo|exemple)",
    re.IGNORECASE,
)


def _stems(words: str) -> re.Pattern:
    return re.compile(rf"(?<!\w)(?:{words})", re.IGNORECASE)


_PATTERNS = {k.name: re.compile(k.pattern) for k in KINDS if k.pattern}
_WORDS = {k.name: _stems(k.words) for k in KINDS}
_HAS_DIGIT = re.compile("[0-9]")

Span = tuple[int, int, int, float]  # start, place of the kind, end, score


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Places of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from the @."""
    free = 0  # where a match may start
    for match in _DOMAIN.finditer(text):
        start = match.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < match.start():
            yield start, match.end()
            free = match.end()
        else:
            free = match.start() + 1


def _proposed(text: str, kind: Kind) -> Iterator[tuple[int, int]]:
    if kind.name == "email":
        yield from _emails(text)
        return
    for match in _PATTERNS[kind.name].finditer(text):
        found = kind.valid(match[0])
        if found:
            yield match.start(), match.start() + found if found is not True else match.end()


def score(text: str, start: int, end: int, kind: Kind) -> float:
    """The kind's score, raised and lowered by words around the span, between 0 and 1."""
    around = (text[max(0, start - NEARBY) : start], text[end : end + NEARBY])
    value = kind.score
    if any(_WORDS[kind.name].search(side) for side in around):
        value += RAISED
    if any(_LOWERING.search(side) for side in around):
        value -= LOWERED
    return round(min(1.0, max(0.0, value)), 2)


def spans(text: str | None) -> list[Span]:
    """All spans of a text, by start, then kind."""
    text = text or ""
    base, others = [], []
    if "@" in text:
        base += [(a, 0, z, score(text, a, z, KINDS[0])) for a, z in _emails(text)]
    if _HAS_DIGIT.search(text):
        for order, kind in enumerate(KINDS[1:], 1):
            for start, end in _proposed(text, kind):
                value = score(text, start, end, kind)
                if kind.base:
                    base.append((start, order, end, value))
                elif value >= LEAST:
                    others.append((start, order, end, value))
    base.sort()
    return sorted(base + _free(len(text), base, others)) if others else base


def _free(length: int, base: list[Span], others: list[Span]) -> list[Span]:
    """Those of the other kinds that share no character with a base span or a better one."""
    kept, taken = [], bytearray(length)
    for start, _, end, _ in base:
        taken[start:end] = b"x" * (end - start)
    for span in sorted(others, key=lambda s: (-s[3], s[0], s[1])):
        start, _, end, _ = span
        if not any(taken[start:end]):
            taken[start:end] = b"x" * (end - start)
            kept.append(span)
    return kept


_SPAN = "struct<kind: string, start: bigint, end: bigint, score: double>"


def found(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of the input: key and spans (kind, start, end and score).

    Places are code points, the end is exclusive; spans go by start, then by their kind's place in
    KINDS. Null and empty texts have no spans. Whole texts are scanned, however long; repeated rows
    and rows without a key are rows like others, other columns are ignored, and an empty table
    gives none.
    """
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("value"))
    kind = source.schema["key"].dataType.simpleString()
    struct = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [
                    {"kind": NAMES[o], "start": a, "end": z, "score": s}
                    for a, o, z, s in spans(cell.as_py())
                ]
                for cell in batch.column(1)
            ]
            columns = [batch.column(0), pa.array(rows, pa.list_(struct))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "spans"])

    rows = source.mapInArrow(scan, f"key {kind}, spans array<{_SPAN}>")
    return rows.withColumnRenamed("key", key)


def masked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; of overlaps, the first."""
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def mask(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in values:
            yield series.map(_masked, na_action="ignore")

    replace = F.pandas_udf(mask, "string")
    return docs.withColumn(text, replace(F.col(f"`{text}`"))).select(*columns)


def _masked(text: str) -> str:
    parts, end = [], 0
    for start, order, stop, _ in spans(text):
        if start >= end:
            parts += [text[end:start], f"[{NAMES[order]}]"]
        end = max(end, stop)
    return "".join([*parts, text[end:]])


def listed(spans: F.Column) -> F.Column:
    """`kind:start:end` of spans in their order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _is_of(kind: str) -> Callable[[F.Column], F.Column]:
    return lambda span: span["kind"] == kind


def digest(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of their spans, all spans as a string, the best score."""
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    return rows.select(
        F.col(f"`{key}`"),
        *[F.size(F.filter("spans", _is_of(k))).cast("long").alias(f"n_{k}") for k in BASE],
        sha256(listed(base)).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.array_max(F.transform("spans", lambda s: s["score"])).alias("top_score"),
    )
