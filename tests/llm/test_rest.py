"""Fingerprints, URLs, packing and chat against plain Python."""

import hashlib
import itertools
import random
from collections import Counter

import pytest
from helpers import no_docs, odd_docs, odd_rows

from orderlens.llm import chat, cws, packing, urls


def words(text):
    return (text or "").encode().split()


def likeness(a, b):
    x, y = Counter(words(a)), Counter(words(b))
    most = sum((x | y).values())
    return sum((x & y).values()) / most if most else 1.0


def edited(docs):
    docs = sorted(set(docs), key=lambda d: -d[0])
    out = {}
    for i, (doc, text) in enumerate(docs):
        follows = docs[(i + 1) % len(docs)][1]
        cut = len(text) // 3
        out[doc] = (text[:len(text) - cut] + follows[:cut], follows)
    return out


def test_samples_collide_as_often_as_texts_are_alike(spark):
    rnd = random.Random(4)
    docs = [(i, " ".join(rnd.choices([f"w{k}" for k in range(20 + 10 * (i % 5))], k=80 + i)))
            for i in range(12)]
    got = cws.compare(spark.createDataFrame(docs, "doc_id long, text string"), samples=256).collect()
    want = edited(docs)
    texts = dict(docs)
    gaps = []
    for r in got:
        text, follows = want[r["doc_id"]]
        assert r["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        gaps += [r["near_edited"] - likeness(texts[r["doc_id"]], text),
                 r["near_next"] - likeness(texts[r["doc_id"]], follows)]
    # 256 samples: a standard deviation of 0.03 at most; the mean of 24 within 0.02.
    assert max(map(abs, gaps)) < 0.12 and abs(sum(gaps) / len(gaps)) < 0.02


def test_whole_table_edits(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = edited([(r["doc_id"], r["text"] or "") for r in docs.collect()])
    got = cws.compare(docs).collect()
    assert len(got) == len(want)
    for r in got:
        assert r["edited_sha256"] == hashlib.sha256(want[r["doc_id"]][0].encode()).hexdigest()


def test_fingerprints_of_odd_documents(spark):
    rows = cws.compare(odd_docs(spark)).collect()
    assert len(rows) == len(odd_rows())
    prints = {}
    for doc in rows:
        assert 0 <= doc["near_edited"] <= 1 and 0 <= doc["near_next"] <= 1
        prints.setdefault(doc["doc_id"], set()).add(doc["fingerprint"])
    assert prints[6] & prints[7] and prints[0] == prints[1] == prints[2] == {""}
    assert cws.compare(no_docs(spark)).collect() == []


def test_one_document_follows_itself(spark):
    row = cws.compare(spark.createDataFrame([(1, "a b c d é")], "doc_id long, text string")).first()
    assert row["near_next"] == 1.0
    assert row["edited_sha256"] == hashlib.sha256("a b c a b".encode()).hexdigest()


def brute_verdict(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    if rest is None:
        return "", "", None, "allow"
    host = rest
    for stop in "/?#":
        host = host.split(stop, 1)[0]
    path = rest[len(host):]
    for stop in "?#":
        path = path.split(stop, 1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(d + p), d + p, a) for a, d, p in urls.RULES
            if (host == d or host.endswith("." + d)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    return host, path, None, "block" if key_of(host, path) in listed else "allow"


def key_of(host, path):
    if not host:
        return None
    for mark in ("www.", "m."):
        if host.startswith(mark):
            host = host[len(mark):]
            break
    cut = path.rstrip("/")
    return host + (cut[:-5] if cut.endswith(".html") else cut)


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "http:///x", "a://B.C/d?e://f", "x\ny://h.org\n/fr/z",
    "https://EXAMPLE.net/en/1", "https://example.net/EN/1", "http://a.example.com/de/x.html#f",
    "http://notexample.com/de/", "http://org/fr/", "http://x.org/fr", "http://m.q.org/p/",
    "http://www.q.org/p.html?utm=1", "http://q.org/p", "HTTP://Q.org/p.html/", "ftp://q.org#x/y",
    "http://İ.com/ä", "http://q.org/p.html.html",
]


def test_odd_urls(spark, monkeypatch):
    listed = {"q.org/p", "İ.com/ä"}
    pages = spark.createDataFrame(
        [(i, u, "x", "y", "z") for i, u in enumerate(ODD_URLS + ODD_URLS[-3:])],
        "page_id long, url string, html string, key string, _rule string")
    table = spark.createDataFrame([(k,) for k in [*listed, None, "q.org/p"]], "key string")
    want = [(i, *brute_verdict(u, listed)) for i, u in enumerate(ODD_URLS + ODD_URLS[-3:])]
    for most in (0, 10 ** 6):
        monkeypatch.setattr(urls, "BROADCAST_BLOCKS", most)
        got = urls.judge(pages, table).collect()
        assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])
                      for r in got) == want
    assert urls.judge(pages.limit(0), table).collect() == []
    assert all(r["verdict"] == "allow" for r in urls.judge(pages, table.limit(0)).collect()
               if r["rule"] is None)


def test_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(20_000).selectExpr("concat('k', id) key")
    others = spark.range(20_000).selectExpr("concat('x', id) key")
    assert urls.possible_hits(listed, listed, "key", 20_000).count() == 20_000
    assert urls.possible_hits(others, listed, "key", 20_000).count() < 200


def padded(lengths, counts, limits):
    return sum(n * min(u for u in limits if u >= k) for k, n in zip(lengths, counts))


def test_bucket_limits_pad_least():
    rnd = random.Random(9)
    for _ in range(60):
        lengths = sorted(rnd.sample(range(0, 60), rnd.randint(1, 9)))
        counts = [rnd.randint(1, 20) for _ in lengths]
        for buckets in (1, 2, 3, 4):
            best = packing.best_limits(lengths, counts, buckets)
            options = [[*c, lengths[-1]] for n in range(buckets)
                       for c in itertools.combinations(lengths[:-1], n)]
            assert len(best) <= buckets and best[-1] == lengths[-1]
            assert padded(lengths, counts, best) == min(
                padded(lengths, counts, o) for o in options)
    assert packing.best_limits([], [], 3) == []


def check_packed(rows, budget):
    taken = Counter((r["bucket"], r["batch"], r["slot"]) for r in rows)
    assert max(taken.values()) == 1
    sizes = Counter((r["bucket"], r["batch"]) for r in rows)
    for bucket in {r["bucket"] for r in rows}:
        room = max(1, budget // max(bucket, 1))
        own = [n for (b, _), n in sorted(sizes.items()) if b == bucket]
        assert all(n == room for n in own[:-1]) and 0 < own[-1] <= room  # one open batch each
    assert all(0 <= r["padding"] == r["bucket"] - r["n_tokens"] for r in rows)


def test_packing_fills_batches(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    monkeypatch.setattr(packing, "CHUNK_ROWS", 7)
    rows = packing.pack(docs, packing.n_words(), buckets=8, budget=5_000).collect()
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: len(words(r["text"])) for r in docs.collect()}
    assert all(r["n_tokens"] == truth[r["doc_id"]] for r in rows)
    check_packed(rows, 5_000)


def test_packing_odd_documents(spark):
    rows = packing.pack(odd_docs(spark), packing.n_words()).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(words(r[1])) for r in odd_rows())
    check_packed(rows, 65_536)
    assert packing.pack(no_docs(spark), packing.n_words()).collect() == []


def test_packing_many_equal_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_ROWS", 20)
    rows = [(None, "a b c")] * 300 + [(7, "a b")] * 200 + [(i, "w " * (i % 40)) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = packing.pack(df, packing.n_words(), buckets=3, budget=100).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter(
        (d, len(t.split())) for d, t in rows)
    check_packed(got, 100)


def test_limits_stay_optimal_for_many_lengths():
    rnd = random.Random(3)
    lengths = sorted(rnd.sample(range(200_000), 300))
    counts = [rnd.randint(1, 9) for _ in lengths]
    seen = [0, *itertools.accumulate(counts)]
    cost = [0] + [10 ** 18] * 300
    for _ in range(16):  # the plain recurrence
        cost = [0 if j == 0 else min(cost[i] + (seen[j] - seen[i]) * lengths[j - 1]
                                     for i in range(j)) for j in range(301)]
    best = packing.best_limits(lengths, counts, 16)
    assert len(best) == 16 and padded(lengths, counts, best) == cost[300]


def test_a_limit_is_the_length_of_some_text(spark):
    df = spark.createDataFrame([(2 ** 30 + 5,), (2 ** 30 + 9,), (3,)], "n long")
    assert packing.bucket_limits(df, "n", 4) == [3, 2 ** 30 + 9]


def test_long_lengths_share_bins(spark):
    from pyspark.sql import functions as F

    values = [0, 1, 1024, 1025, 100_001, 2 ** 20 + 1, 2 ** 39 + 12345]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v long").orderBy("v")
           .select(packing.bin_of(F.col("v"))).collect()]
    assert got[:5] == values[:5]
    assert all(v <= b <= v * (1 + 2 ** -16) + 1 for v, b in zip(values, got))


TURNS = [
    (1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "<\\|x é🙂\n"), (1, 2, "assistant", None),
    (2, 0, None, "x"), (2, 0, "a\\n\nb<|", "<|<\\\\|"), (2, None, "assistant", ""), (None, 1, "user", "n"),
    (3, 1, "assistant", "same"), (3, 1, "assistant", "same"), (4, 0, "assistant", "z" * 300_000),
]


def brute_chat(turns):
    def key(t):
        return (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")

    out = {}
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=key)
        said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        learned = "".join(t[3] or "" for t in own if t[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                     hashlib.sha256(learned.encode()).hexdigest())
    return out


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_odd_turns_come_back(spark, batch):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(batch))
    try:
        turns = spark.createDataFrame(
            [(*t, "x", 1) for t in TURNS],
            "conv_id long, turn long, role string, text string, segment string, loss_start long")
        got = {r["conv_id"]: tuple(r)[1:5]
               for r in chat.read_back(chat.in_order(chat.format_turns(turns))).collect()}
        assert got == brute_chat(TURNS)
        assert chat.read_back(chat.in_order(chat.format_turns(turns.limit(0)))).collect() == []
    finally:
        spark.conf.set(setting, before)


def test_segments_hold_no_forged_mark(spark):
    rows = chat.format_turns(spark.createDataFrame(
        TURNS, "conv_id long, turn long, role string, text string")).collect()
    for r in rows:
        assert r["segment"].count("<|") == 2
        assert r["segment"].startswith("<|im_start|>") and r["segment"].endswith("<|im_end|>\n")
