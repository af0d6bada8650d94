import random

import xxhash
from helpers import by_id, no_docs, odd_docs, odd_rows

from orderlens.llm import simhash


def brute_print(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [
        b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64)
               if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_roots(prints, most=2):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = sorted(root)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def brute_classes(rows, width=3):
    prints = [brute_print(t, width) for _, t in rows]
    roots = brute_roots(prints)
    least = {}
    for (doc, _), p in zip(rows, prints):
        seen = least.get(roots[p])
        least[roots[p]] = doc if seen is None else seen if doc is None else min(seen, doc)
    return [(doc, f"{p:016x}", least[roots[p]]) for (doc, _), p in zip(rows, prints)]


def found(df):
    from pyspark.sql import functions as F

    return [(r[0], r[1], r[2]) for r in df.select(
        "doc_id", simhash.hex_of(F.col("fp")), "component_id").collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0))


def test_odd_documents(spark):
    mine = found(simhash.classes(odd_docs(spark)))
    assert order(mine) == order(brute_classes([r[:2] for r in odd_rows()]))


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert order(found(simhash.classes(docs))) == order(brute_classes(rows))


def test_empty_table(spark):
    assert simhash.classes(no_docs(spark)).collect() == []
    rows = no_docs(spark).selectExpr("cast(_row as long) _row", "doc_id", "text")
    assert simhash.representatives(rows).collect() == []


def crowded(n, seed):
    """Fingerprints close to a few centres, some at either side of the limit."""
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(3)] + [0, 2 ** 64 - 1]
    prints = set()
    while len(prints) < n:
        p = rnd.choice(centres)
        for bit in rnd.sample(range(64), rnd.choice([0, 1, 1, 2, 3, 4])):
            p ^= 1 << bit
        prints.add(p)
    return sorted(prints)


def test_small_and_large_blocks_agree(spark, monkeypatch):
    prints = crowded(400, 7)
    signed = [p - 2 ** 64 if p >= 2 ** 63 else p for p in prints]
    expected = brute_roots(signed)
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    for limit in (1, 64, 10_000):
        monkeypatch.setattr(simhash, "SMALL_BLOCK", limit)
        got = {r["node"]: r["root"] for r in simhash.components(simhash.close_links(df)).collect()}
        assert {p: got.get(p, p) for p in signed} == expected


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7 + 1)]
    got = {r["node"]: r["root"] for r in simhash.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 300)}}


def brute_stage(rows):
    """Rows (row, doc_id, text) of which one per class stays."""
    prints = [brute_print(t, 3) for *_, t in rows]
    roots = brute_roots(prints)
    best = {}
    for (row, doc, _), p in zip(rows, prints):
        key = (doc is None, doc or 0, row)
        best[roots[p]] = min(best.get(roots[p], key), key)
    return sorted([key[2]] for key in best.values())


def test_stage_equals_brute_force(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for _ in range(40):
        base = [rnd.choice(words) for _ in range(rnd.randint(150, 900))]
        for copy in range(4):
            text = list(base)
            for _ in range(copy):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append((len(rows), 1000 - len(rows), " ".join(text)))
    rows += [(len(rows) + i, None, rows[i][2]) for i in range(30)]
    df = spark.createDataFrame(rows, "_row long, doc_id long, text string")
    want = brute_stage(rows)
    assert 40 <= len(want) < 150
    assert by_id(simhash.representatives(df).collect(), "_row") == want


def test_stage_keeps_the_smallest_id_of_equal_texts(spark):
    rows = [(i, d, t) for i, (d, t) in enumerate(
        [(5, "a b c d e f"), (3, "A b c d e f"), (None, "a b c d e f"), (9, "x y"), (9, "x y")])]
    df = spark.createDataFrame(rows, "_row long, doc_id long, text string")
    assert by_id(simhash.representatives(df).collect(), "_row") == [[1], [3]]
