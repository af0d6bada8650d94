import random
import re

import pytest
from helpers import no_docs, odd_docs, odd_rows

from orderlens.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text)
            if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", m.start(), m.end()) for m in PHONE.finditer(text)
                  if 8 <= len(digits(m)) <= 15]


def base(text):
    return [s[:3] for s in pii.spans_of(text) if s[0] in pii.BASE]


def test_random_texts_against_the_plain_patterns():
    rnd = random.Random(11)
    parts = ["a", "b.c", "@", "@x.org", "x@y", ".", "-", "_", "%", "+", "+1", "1", "10.0.0.1",
             "256", "4111111111111111", "4111 1111 1111 1111", " ", "  ", "(202)", "555", "é", "\n",
             "1.2.3", "0007", "user@host.example.com", "ü@b.de", "5500-0000-0000-0004", "००"]
    for _ in range(30_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14)))
        assert base(text) == brute(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "+1 " * 50_000, "1." * 50_000,
                                  "x@" * 50_000, "+1" + " " * 200_000, "a.b-" * 50_000])
def test_long_runs_take_no_square_time(text):
    import time

    start = time.time()
    pii.spans_of(text)
    assert time.time() - start < 5


def test_added_kinds_need_checksum_and_context():
    iban = "pay to account GB29 NWBK 6016 1331 9268 19 please"
    assert [s[0] for s in pii.spans_of(iban)] == ["iban"]
    assert pii.spans_of(iban.replace("29", "28")) == []
    assert [s[0] for s in pii.spans_of("my amex card 378282246310005 ok")] == ["amex"]
    assert [s[0] for s in pii.spans_of("order 378282246310005 ok")] == []
    assert [s[0] for s in pii.spans_of("ssn 219-09-9999")] == ["ssn"]


def test_redaction_follows_the_score():
    text = "write to bob@example.org now, version 1.2.3.4"
    assert pii.redacted(text, pii.spans_of(text)) == "write to <EMAIL> now, version 1.2.3.4"


def test_scan_of_odd_documents(spark):
    rows = pii.scan(odd_docs(spark)).collect()
    want = sorted(",".join(f"{k}:{a}:{b}" for k, a, b in brute(r[1] or "")) for r in odd_rows())
    assert sorted(r["base_spans"] for r in rows) == want
    assert pii.scan(no_docs(spark)).collect() == []
