"""Periodic runs against their definition."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import by_id, no_docs, odd_docs, odd_rows

from orderlens.llm import periodic
from orderlens.llm.queries import queries


def brute_runs(words, least=6, times=4):
    """Stretches in which words q apart are identical, for every q that is their smallest."""
    numbers = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    n, out = len(ids), []
    for q in range(1, n // times + 1):
        same = np.concatenate([[0], (ids[q:] == ids[:-q]).astype(int), [0]])
        edges = np.flatnonzero(np.diff(same))
        for i, j in zip(edges[::2], edges[1::2]):
            part = ids[i:j + q]
            if len(part) >= max(least, times * q) and not any(
                    (part[d:] == part[:-d]).all() for d in range(1, q)):
                out.append((int(i), len(part), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc, text, least=6, times=4):
    w = (text or "").encode().split()
    found = brute_runs(w, least, times)
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return doc, len(w), found, best, kept.decode()


def planted(doc, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(w)
    if doc is None or h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(w[a + (i - a) % p] if i >= a else w[i] for i in range(n)).decode()


def plain(row):
    return (row["doc_id"], row["n_words"], [tuple(r) for r in row["runs"]],
            row["best"] and tuple(row["best"]), row["collapsed"])


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r)))


def repeated(rnd, n):
    kinds = rnd.choice([1, 2, 2, 3, 6])
    w = [f"k{rnd.randrange(kinds)}" for _ in range(n)]
    for _ in range(rnd.randint(0, 3)):
        a, p = rnd.randrange(n + 1), rnd.randint(1, 7)
        for i in range(a + p, min(n, a + rnd.randint(4, 50))):
            w[i] = w[i - p]
    return w


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (5, 3), (1, 2)])
def test_runs_of_random_words(least, times):
    rnd, seen = random.Random(least), 0
    for _ in range(1500):
        w = repeated(rnd, rnd.randint(0, 70))
        numbers = {}
        ids = np.array([numbers.setdefault(x, len(numbers)) for x in w], np.int32)
        want = brute_runs(w, least, times)
        seen += len(want)
        assert periodic.runs_of(ids, least, times) == want
    assert seen > 500


def test_many_texts_at_once(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(i, " ".join(repeated(rnd, rnd.randint(0, 60)) + [f"u{i}"])) for i in range(500)]
    rows += [(500 + i, " ".join(f"v{rnd.randrange(9999)}" for _ in range(300))) for i in range(50)]
    want = [brute_row(*r) for r in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for limit, bits in ((200_000, 20), (40, 2)):
        monkeypatch.setattr(periodic, "WORDS_AT_ONCE", limit)
        monkeypatch.setattr(periodic, "TABLE_BITS", bits)
        assert order(map(plain, periodic.runs(df).collect())) == order(want)


def test_two_long_runs_of_one_root():
    part = [f"r{i}" for i in range(7)]
    w = part * 900 + ["break"] + part * 700 + part[:3] + ["end"]
    numbers = {}
    ids = np.array([numbers.setdefault(x, len(numbers)) for x in w], np.int32)
    assert periodic.runs_of(ids) == [(0, 6300, 7), (6301, 4903, 7)]


def test_odd_documents(spark):
    got = map(plain, periodic.runs(odd_docs(spark)).collect())
    assert order(got) == order([brute_row(*r[:2]) for r in odd_rows() if r[1] is None
                                or len(r[1].split()) < 5000]
                               + [(i, len(t.split()), [], None, t) for i, t, *_ in odd_rows()
                                  if t and len(t.split()) >= 5000])
    assert periodic.runs(no_docs(spark)).collect() == []


def test_planted_period(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 23))) for i in range(400)]
    rows += [r[:2] for r in odd_rows()] + [(-7, "a b c d e f g")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r[0], r[1]) for r in periodic.with_planted_period(df).collect()]
    want = [(d, planted(d, t)) for d, t in rows]
    assert order(got) == order(want)
    assert sum(a != b for a, b in zip(rows, want)) > 25


def test_query_on_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()

    def digest(data):
        return hashlib.sha256(data.encode()).hexdigest()

    want = []
    for r in docs:
        text = planted(r["doc_id"], r["text"])
        if len((text or "").split()) > 4000:
            continue
        doc, _, found, best, kept = brute_row(r["doc_id"], text)
        s, k, q = best or (None,) * 3
        want.append([doc, len(found), s, k, q, best and 1000 * k // q,
                     digest("".join(f"{a},{b},{c}\n" for a, b, c in found)), digest(kept)])
    got = by_id(queries["op12_periodic"].run(spark, sf).collect(), "doc_id", "n_runs", "start",
                "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert len(got) == len(docs)
    ids = {w[0] for w in want}
    assert len(ids) > 0.9 * len(docs)
    assert [g for g in got if g[0] in ids] == sorted(want)
    assert sum(1 for w in want if w[1]) > 10
