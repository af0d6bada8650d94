"""The pipeline, stage by stage and whole, against plain Python on small documents."""

import random

from helpers import no_docs, odd_docs
from test_simhash import brute_stage

import corpus_pipeline
from orderlens.llm import pii, quality, stages

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(8)
    vocabulary = [f"{a}{b}" for a in "bcdfgh" for b in range(300)]

    def prose(n):
        return " ".join(rnd.choices(vocabulary, k=n))

    rows, copies = [], {}
    for i in range(60):
        rows.append((i, "\n".join(prose(60) for _ in range(3))))
    for i in range(20):  # exact copies
        rows.append((100 + i, rows[i][1]))
        copies[100 + i] = i
    for i in range(20, 40):  # near copies: a few words changed
        w = rows[i][1].split(" ")
        w[rnd.randrange(len(w))] = "changed"
        rows.append((100 + i, " ".join(w)))
        copies[100 + i] = i
    rows.append((200, "short"))
    rows.append((201, "repeat these words " * 40))
    rows.append((202, rows[50][1] + "\nmail me at bob@example.org or call +1 (202) 555-0143"))
    copies[202] = 50
    rows.append((203, prose(90) + " write to ann@example.com"))
    full = [(d, t, "en", f"s{d % 2}", len(t)) for d, t in rows]
    return full, copies


def test_stages_and_whole(spark, tmp_path):
    rows, copies = corpus()
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    one = stages.quality_rules(spark, docs, str(tmp_path))
    assert one.columns == docs.columns and one.dtypes == docs.dtypes
    kept = {r["doc_id"]: r["text"] for r in one.collect()}
    assert kept == {d: t for d, t, *_ in rows if d not in (200, 201)}

    two = stages.near_duplicates(spark, one, str(tmp_path))
    assert two.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in two.collect()}
    numbered = [(i, d, t) for i, (d, t) in enumerate(kept.items())]
    want = {numbered[row][1] for [row] in brute_stage(numbered)}
    assert set(left) == want
    assert not want & set(range(100, 120))  # exact copies go
    assert len(want) < 60 + 20

    three = stages.personal_data(spark, two, str(tmp_path))
    assert three.columns == docs.columns
    clean = {r["doc_id"]: r for r in three.collect()}
    assert clean[203]["text"].endswith("write to <EMAIL>")
    for d, r in clean.items():
        assert r["text"] == pii.redacted(left[d], pii.spans_of(left[d]))
        assert r["n_chars"] == len(r["text"])

    last = stages.packing(spark, three, str(tmp_path)).collect()
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, run)) == sorted(map(tuple, last))
    assert sorted((r["doc_id"], r["n_tokens"]) for r in run) == sorted(
        (d, len(r["text"].split())) for d, r in clean.items())


def test_boilerplate_lines_leave_kept_texts(spark, monkeypatch):
    rnd = random.Random(1)

    def prose(n):
        return " ".join(f"w{rnd.randrange(9999)}" for _ in range(n))

    rows = [(i, f"{prose(60)}\nShare this page with friends\n{prose(60)}", "en", "h", 1)
            for i in range(30)]
    docs = spark.createDataFrame(rows, COLUMNS)
    out = {r["doc_id"]: r for r in stages.quality_rules(spark, docs, "").collect()}
    for d, text, *_ in rows:
        a, _, b = text.split("\n")
        assert out[d]["text"] == f"{a}\n{b}" and out[d]["n_chars"] == len(out[d]["text"])
    assert quality.MIN_DOCS < 30


def test_odd_documents(spark):
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.collect()
        assert stage(spark, no_docs(spark), "").collect() == []
    twice = stages.near_duplicates(spark, docs, "").collect()
    assert len([r for r in twice if r["doc_id"] == 6]) == 2  # two texts under one id
    assert stages.packing(spark, no_docs(spark), "").collect() == []


def test_near_copies_leave_one_of_their_group(spark):
    from test_spans import host_with_near_copies

    rows = [(d, t, "en", h, len(t)) for d, t, h in host_with_near_copies(25, 1, 200)]
    kept = stages.quality_rules(spark, spark.createDataFrame(rows, COLUMNS), "")
    left = {r["doc_id"] for r in stages.near_duplicates(spark, kept, "").collect()}
    assert 10_000 in left and set(range(200)) <= left
