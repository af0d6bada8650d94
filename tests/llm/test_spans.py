"""Quality, license and secret scans: against SQL, plain Python, and odd documents."""

import re

import pytest
from helpers import by_id, no_docs, odd_docs, odd_rows

from orderlens.llm import licenses, quality, secret_scan
from orderlens.llm.queries import queries

SECRET = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)


@pytest.mark.parametrize("name", ["op3_quality", "op4_licenses", "op7_urls", "op10_chat"])
def test_against_sql(spark, con, sf, name):
    from oracle import compare

    verdict, note = compare(spark, con, queries[name], sf)
    assert verdict == "ok", note


def view(con, rows):
    con.execute("CREATE OR REPLACE TEMP TABLE odd_documents "
                "(doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO odd_documents VALUES (?, ?, ?)",
                    [(r[0], r[1], r[3]) for r in rows])


@pytest.mark.parametrize("name, run", [
    ("op3_quality", lambda d: quality.judged(d)), ("op4_licenses", lambda d: licenses.scan(d))])
def test_odd_documents_against_sql(spark, con, name, run):
    from oracle import rows_of

    view(con, odd_rows())
    cur = con.execute(queries[name].sql.replace("FROM documents", "FROM odd_documents"))
    names = [d[0] for d in cur.description]
    df = run(odd_docs(spark)).select(*names)
    assert rows_of(names, df.collect()) == rows_of(names, cur.fetchall())
    assert run(no_docs(spark)).collect() == []


def corpus(spark, monkeypatch):
    monkeypatch.setattr(quality, "MIN_DOCS", 3)
    import random

    rnd = random.Random(2)

    def sentence(n):
        return " ".join(f"v{rnd.randrange(10_000)}" for _ in range(n))

    banner = "accept all the cookies of this site to go on " + "please " * 20
    rows = [(i, "\n".join([sentence(40), banner, sentence(40), sentence(30)]), "h")
            for i in range(20)]
    rows += [(100 + i, "\n".join([sentence(10), banner.strip(), sentence(10)]), "h")
             for i in range(6)]
    story = [sentence(20) for _ in range(6)]
    for i in range(12):  # near copies: one line of each differs
        text = list(story)
        text[i % 6] = sentence(20)
        rows.append((200 + i, "\n".join(text), "h"))
    rows += [(300 + i, "\n".join([sentence(40), banner, sentence(40)]), "other") for i in range(3)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_boilerplate_goes_and_copies_stay(spark, monkeypatch):
    rows, docs = corpus(spark, monkeypatch)
    out = {r["doc_id"]: r for r in quality.judged(docs, "source").collect()}
    found = quality.frequent_lines.__defaults__
    assert found == (10, 0.005)  # the limits of the query
    assert all(out[i]["n_removed_lines"] == 1 and out[i]["kept"] for i in range(20))
    assert not any(out[100 + i]["kept"] for i in range(6))
    assert all(out[200 + i]["n_removed_lines"] == 0 and out[200 + i]["kept"] for i in range(12))
    assert all(out[300 + i]["n_removed_lines"] == 0 for i in range(3))


def test_header_and_footer_of_several_lines_go(spark):
    import random

    rnd = random.Random(6)

    def sentence(n):
        return " ".join(f"v{rnd.randrange(10_000)}" for _ in range(n))

    top, foot = ["home news", "sign in"], ["all rights", "our terms", "last line"]
    rows = [(i, "\n".join([*top, sentence(60), sentence(30), *foot]), "h") for i in range(30)]
    block = ["fixed part " + "of words " * 20 + str(i) * 3 for i in "abc"]
    rows += [(100 + i, "\n".join([sentence(10), *block]), "h") for i in range(30)]
    copied = "\n".join(sentence(30) for _ in range(3))
    rows += [(200 + i, copied, "h") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in quality.judged(docs).collect()}
    assert all(out[i]["n_removed_lines"] == 5 and out[i]["kept"] for i in range(30))
    assert all(out[100 + i]["n_removed_lines"] == 3 and not out[100 + i]["kept"]
               for i in range(30))
    assert all(out[200 + i]["n_removed_lines"] == 0 and out[200 + i]["kept"] for i in range(40))


def host_with_near_copies(copies, edits, others=600, seed=4):
    """Unrelated texts under one footer, and copies of one text, each with its own edits."""
    import random

    rnd = random.Random(seed)

    def sentence(n):
        return " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(n))

    foot = ["all rights", "our terms", "last line"]
    rows = [(i, "\n".join([*(sentence(15) for _ in range(8)), *foot]), "h")
            for i in range(others)]
    story = [sentence(12) for _ in range(20)]
    for i in range(copies):
        text = list(story)
        for place in rnd.sample(range(20), edits if i else 0):
            text[place] = sentence(12)
        rows.append((10_000 + i, "\n".join(text), "h"))
    return rows


@pytest.mark.parametrize("copies,edits", [(25, 1), (300, 1), (300, 3)])
def test_near_copies_do_not_remove_each_other(spark, copies, edits):
    rows = host_with_near_copies(copies, edits)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = quality.judged(docs).collect()
    assert all(r["n_removed_lines"] == (3 if r["doc_id"] < 10_000 else 0) for r in out)
    assert all(r["kept"] for r in out)


def test_quality_sql_on_near_copies_and_footers(spark, con):
    from oracle import rows_of

    rows = [(d, t, None, h) for d, t, h in host_with_near_copies(40, 2, 60)]
    rows += [(20_000 + i, f"only this {i}\n" + "\n".join(f"fixed {j} block " * 9 for j in "abc"),
              None, "other") for i in range(30)]
    view(con, rows)
    cur = con.execute(queries["op3_quality"].sql.replace("FROM documents", "FROM odd_documents"))
    names = [d[0] for d in cur.description]
    docs = spark.createDataFrame(rows, "doc_id long, text string, x string, source string")
    got = rows_of(names, quality.judged(docs).select(*names).collect())
    assert got == rows_of(names, cur.fetchall())


def test_limit_does_not_grow_with_a_large_host(spark):
    from pyspark.sql import functions as F

    notice = F.when(F.col("id") < 150, F.lit("\na notice of the house"))
    rare = F.when(F.col("id").between(200, 290), F.lit("\na rarer line"))
    docs = spark.range(40_000).select(
        F.col("id").alias("_row"), F.lit("h").alias("_host"),
        F.concat(F.concat(F.lit("text "), F.translate(F.col("id").cast("string"), "0123456789",
                                                      "abcdefghij")),
                 F.coalesce(notice, F.lit("")), F.coalesce(rare, F.lit(""))).alias("t"))
    found = quality.frequent_lines(quality.with_lines(docs, "t")).collect()
    line = spark.range(1).select(quality.line_hash(F.lit("a notice of the house"))).first()[0]
    assert [(r["h"], r["n"]) for r in found] == [(line, 150)]


def test_removed_lines_leave_the_text(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("A  b\nkeep\na B ", "a b")], "text string, line string")
    got = df.select(quality.without_lines(F.col("text"), F.array(quality.line_hash(F.col("line"))))).first()[0]
    assert got == "keep"


def test_every_template_is_found_at_the_threshold(spark):
    rows, want = [], {}
    for n, (label, text) in enumerate(licenses.TEMPLATES.items()):
        words = text.split()
        distinct = sorted(set(words))
        need = -(-len(distinct) * 8 // 10)
        held = [w for w in words if w in distinct[:need]]
        rows += [(2 * n, "x y\n" + "; ".join(held) + "\nz", "s"),
                 (2 * n + 1, "x y\n" + " ".join(w for w in words if w in distinct[:need - 1]), "s")]
        want[2 * n], want[2 * n + 1] = label, None
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sets = {k: set(t.split()) for k, t in licenses.TEMPLATES.items()}
    for r in licenses.scan(docs).collect():
        got = set(filter(None, r["labels"].split(",")))
        lines = [set(line.replace(";", "").split()) for line in rows[r["doc_id"]][1].split("\n")]
        brute = {k for k, s in sets.items()
                 if any(len(s & line) * 10 >= 8 * len(s) for line in lines)}
        assert brute == got - set(licenses.PHRASES.values())
        if want[r["doc_id"]]:
            assert want[r["doc_id"]] in got


def brute_secrets(text):
    out = [(m.start(), 0, "assign", m.end()) for m in SECRET.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
            if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text)
            if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def test_secrets_against_plain_patterns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = by_id([{"doc_id": r["doc_id"], "s": brute_secrets(r["text"] or "")}
                  for r in docs.collect()], "doc_id", "s")
    assert by_id(secret_scan.scan(docs).collect(), "doc_id", "base_spans") == want


def test_odd_secrets(spark):
    texts = ["secret=token:abcdefgh12", "PassWord\"  :  'abcdefgh' é token=12345678",
             "é🙂 token=" + "a" * 40, "AKIAAKIA AKIA" + "A" * 20, "secret" + " " * 50_000 + "x",
             "api_key=short apikey=longenough1 api__key=longenough1", ("0" * 33 + "g") * 3000,
             'a b"c token="x=y=z====" passwd : zzzzzzzzz\n', None, ""]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(2, texts[2], "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = by_id([{"d": r[0], "s": brute_secrets(r[1] or "")} for r in rows], "d", "s")
    assert by_id(secret_scan.scan(docs).collect(), "doc_id", "base_spans") == want
    odd = secret_scan.scan(odd_docs(spark))
    assert sorted(r["base_spans"] for r in odd.collect()) == sorted(
        brute_secrets(r[1] or "") for r in odd_rows())
    assert secret_scan.scan(no_docs(spark)).collect() == []


def test_widely_copied_values_are_examples(spark):
    key = "ghp_" + "Ab1" * 12
    rows = [(i, f"x {key} y", f"owner{i % 4}") for i in range(8)]
    rows += [(90, "x ghp_" + "Zz9" * 12 + " y", "owner1"), (91, "token=abcdefgh1", "owner1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in secret_scan.scan(docs).collect()}
    assert all(out[i]["spans"] == "" for i in range(8))
    assert out[90]["spans"] == "github:2:42" and out[90]["n_live"] == 1
    assert out[91]["spans"] == "assign:0:15" and out[91]["base_spans"] == "assign:0:15"


def test_wrapped_notices_are_found(spark):
    rows = []
    for width in (3, 5, 8):
        for text in licenses.TEMPLATES.values():
            w = text.split()
            lines = [" * " + " ".join(w[i:i + width]) for i in range(0, len(w), width)]
            rows.append((len(rows), "\n".join(["some code above", *lines, "and more below"]), "s"))
    far = licenses.TEMPLATES["isc"].split()
    rows.append((900, "\n".join(f"{w} " + "filler " * 40 for w in far), "s"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan(docs).collect()}
    names = list(licenses.TEMPLATES)
    for n in range(len(rows) - 1):
        assert names[n % len(names)] in out[n], rows[n]
    assert "isc" not in out[900]


def test_a_value_copied_widely_inside_one_owner_is_an_example(spark):
    key = "ghp_" + "Cd2" * 12
    rows = [(i, f"x {key} y", "hot") for i in range(60)]
    rows += [(90 + i, "x ghp_" + "Yy8" * 12 + " y", "hot") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in secret_scan.scan(docs).collect()}
    assert all(out[i]["n_live"] == 0 and out[i]["spans"] == "" for i in range(60))
    assert all(out[90 + i]["n_live"] == 1 and out[90 + i]["spans"] for i in range(3))
