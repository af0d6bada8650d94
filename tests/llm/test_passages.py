"""Repeated passages against plain Python."""

import random

import numpy as np
import pytest
from helpers import no_docs, odd_docs, odd_rows

from orderlens.llm import passages


def brute(rows, window):
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in texts:
        for i in range(len(w) - window + 1):
            if d is not None:
                key = tuple(w[i:i + window])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        spans = [(i, i + 1) for i in sorted(gone)]
        joined = []
        for a, b in spans:
            if joined and joined[-1][1] == a:
                joined[-1] = (joined[-1][0], b)
            else:
                joined.append((a, b))
        out.append((d, len(w), len(gone), joined,
                    b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return order(out)


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r)))


def found(df):
    return order((r["doc_id"], r["n_words"], r["n_removed"], [tuple(s) for s in r["removed"]],
                  r["kept"]) for r in df.collect())


def corpus(seed, n=150):
    rnd = random.Random(seed)
    shared = [[f"s{rnd.randrange(300)}" for _ in range(rnd.randint(3, 60))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rnd.randint(0, 5)):
            if rnd.random() < 0.6:
                part = rnd.choice(shared)
                a = rnd.randrange(len(part))
                words += part[a:a + rnd.randint(1, 60)]
            else:
                words += [f"w{rnd.randrange(4)}" for _ in range(rnd.randint(1, 30))]
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[rnd.randrange(n)][1]) for i in range(20)]
    rows += [(i, rows[i + 1][1]) for i in range(5)] + [rows[3]]
    rows += [(None, rows[i][1]) for i in range(5)] + [(-3, rows[9][1])]
    return rows


@pytest.mark.parametrize("window,gram,at_once", [(12, 4, 200_000), (12, 10, 30), (5, 10, 7),
                                                  (1, 1, 50)])
def test_against_brute_force(spark, monkeypatch, window, gram, at_once):
    monkeypatch.setattr(passages, "GRAM", gram)
    monkeypatch.setattr(passages, "WORDS_AT_ONCE", at_once)
    monkeypatch.setattr(passages, "WORDS_KNOWN", 50)
    rows = corpus(window)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows, window)
    assert sum(1 for r in want if 0 < r[2] < r[1]) > 10
    assert found(passages.dedup(df, window)) == want


def test_hot_passage_with_many_borders(spark):
    rnd = random.Random(3)
    part = [f"p{i}" for i in range(70)]
    rows = [(i, " ".join([f"a{rnd.randrange(10 ** 6)}" for _ in range(rnd.randint(0, 9))] + part
                         + [f"b{rnd.randrange(10 ** 6)}" for _ in range(rnd.randint(0, 9))]))
            for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(passages.dedup(df, 50)) == brute(rows, 50)


def test_odd_documents(spark):
    small = [r[:2] for r in odd_rows()]
    assert found(passages.dedup(odd_docs(spark), 12)) == brute(small, 12)
    assert passages.dedup(no_docs(spark)).collect() == []


def test_stretch_hashes():
    rnd = np.random.default_rng(1)
    words = rnd.integers(0, 2 ** 64, 400, np.uint64)
    words[200:300] = words[50:150]
    roll = passages.Rolling(words)
    assert (roll.windows(50)[200:251] == roll.windows(50)[50:101]).all()
    assert len(set(roll.windows(50).tolist())) == 351 - 51
    assert roll.between(np.array([50]), np.array([150])) == roll.between(
        np.array([200]), np.array([300]))


def test_query_equals_sql(spark, con, sf):
    from oracle import compare

    from orderlens.llm.queries import queries

    for name in ("op11_negatives", "op13_passages"):
        verdict, note = compare(spark, con, queries[name], sf)
        assert verdict == "ok", f"{name}: {note}"
