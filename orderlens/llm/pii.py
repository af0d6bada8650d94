"""Personal data: patterns propose spans, checksums confirm them, nearby words score them.

Base spans (email, ip, card, phone) are always reported. Further kinds (iban, amex, ssn) are
reported where checksum and context lift their score to KEEP. Offsets are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "amex", "ssn")
KEEP = 0.5
REDACT = 0.3
NEAR = 48  # characters looked at on either side of a span

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive repeats and the look-behind only spare work: a run of digits that fails from its
# start would fail from every later digit too.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
                  r"(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

START = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.6, "amex": 0.3, "ssn": 0.3}
MORE, LESS = 0.3, 0.3
FOR = {
    "email": "mail contact write kontakt courriel correo",
    "ip": "ip address host server client login adresse",
    "card": "card visa mastercard credit payment karte carte tarjeta",
    "phone": "phone tel call mobile fax telefon téléphone teléfono",
    "iban": "iban account bank transfer konto compte cuenta",
    "amex": "amex american express card credit",
    "ssn": "ssn social security insurance",
}
AGAINST = {
    "email": "example noreply", "ip": "version release build section chapter",
    "card": "isbn order invoice tracking serial", "phone": "offset gmt utc",
    "iban": "serial", "amex": "isbn order tracking serial", "ssn": "part serial order",
}


def _near(words: str) -> re.Pattern:
    return re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, words.split()))})(?!\w)", re.I)


FOR_RE = {k: _near(v) for k, v in FOR.items()}
AGAINST_RE = {k: _near(v) for k, v in AGAINST.items()}


def luhn(digits: str) -> bool:
    """Check digit of payment cards."""
    own = [int(d) for d in digits[::-1]]
    return sum(own[::2] + [d * 2 - 9 * (d > 4) for d in own[1::2]]) % 10 == 0


def mod97(iban: str) -> bool:
    """Check digits of bank account numbers: letters count from 10, the first four go last."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each ``@``
    leftwards, so a long run without one costs nothing."""
    free = 0
    at = text.find("@")
    while at >= 0:
        first = at
        while first > free and text[first - 1] in LOCAL:
            first -= 1
        found = DOMAIN.match(text, at + 1) if first < at else None
        if found:
            free = found.end()
            yield first, free
        at = text.find("@", max(at + 1, free))


def _digits(value: str) -> str:
    return re.sub("[^0-9]", "", value)


def spans_of(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of all confirmed spans, base kinds first, each by start."""
    found: list[tuple[str, int, int]] = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    if text.count(".") > 2:
        found += [("ip", m.start(), m.end()) for m in IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                         for p in m[0].split("."))]
    numbers = [(m.start(), m.end(), d) for m in CARD.finditer(text)
               if m.end() - m.start() >= 15 and 15 <= len(d := _digits(m[0])) <= 19]
    found += [("card", a, b) for a, b, d in numbers if len(d) >= 16 and luhn(d)]
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text)
                  if 8 <= len(_digits(m[0])) <= 15]
    if IBAN_START.search(text):
        found += [("iban", m.start(), m.end()) for m in IBAN.finditer(text)
                  if mod97(m[0].replace(" ", ""))]
    found += [("amex", a, b) for a, b, d in numbers
              if len(d) == 15 and d[:2] in ("34", "37") and luhn(d)]
    if text.count("-") > 1:
        found += [("ssn", m.start(), m.end()) for m in SSN.finditer(text)]
    scored = [(k, a, b, score(text, k, a, b)) for k, a, b in found]
    return [s for s in scored if s[0] in BASE or s[3] >= KEEP]


IBAN_START = re.compile(r"[A-Z]{2}[0-9]{2}")


def score(text: str, kind: str, start: int, end: int) -> float:
    """Confidence of a confirmed span, moved by words around it."""
    around = text[max(0, start - NEAR):start] + "\n" + text[end:end + NEAR]
    value = START[kind]
    value += MORE * bool(FOR_RE[kind].search(around))
    value -= LESS * bool(AGAINST_RE[kind].search(around))
    return min(1.0, max(0.0, value))


def redacted(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span of a score of REDACT or more replaced by its kind; of
    overlapping spans the earlier and longer one names the whole stretch."""
    out, free = [], 0
    for kind, start, end, value in sorted(spans, key=lambda s: (s[1], -s[2])):
        if value < REDACT or end <= free:
            continue
        if start >= free:
            out += [text[free:start], f"<{kind.upper()}>"]
        free = end
    return "".join(out) + text[free:]


SCAN = ("n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string, "
        "scores string")


def _text(spans: list[tuple[str, int, int, float]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans)


def scan(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts per base kind, base spans, all spans and their scores as text.

    A null text counts as empty: no spans. One row per input row, repeats included.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [spans_of(t.as_py()) for t in batch.column(1)]
            base = [[s for s in row if s[0] in BASE] for row in rows]
            counts = [pa.array([sum(s[0] == k for s in row) for row in base], pa.int64())
                      for k in BASE]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(map(_text, base), pa.string()),
                 pa.array(map(_text, rows), pa.string()),
                 pa.array([",".join(f"{s[3]:.1f}" for s in row) for row in rows], pa.string())],
                ["doc_id", *[f"n_{k}" for k in BASE], "base_spans", "spans", "scores"])

    plain = docs.select(F.col(doc).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    return plain.mapInArrow(run, f"doc_id long, {SCAN}")


def redact(text: Column) -> Column:
    """Text with personal data replaced by its kind; null stays null."""
    @F.pandas_udf("string")
    def run(texts):  # noqa: ANN001, ANN202
        return texts.map(lambda t: None if t is None else redacted(t, spans_of(t)))

    return run(text)


def digest(value: str) -> str:
    """Lowercase hex SHA-256, as the query's digest columns have it."""
    return hashlib.sha256(value.encode()).hexdigest()
