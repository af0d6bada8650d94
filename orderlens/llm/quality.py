"""Quality rules with cross-document line frequency, in DataFrame functions only.

A line counts as boilerplate of a host if more independent documents of the host hold it than
the limit allows. Documents with the same lines in the same order count once. So do near
copies: a document is known by one of its lines, the one at a fifth of them in ascending order
of how many documents hold it, and documents known by the same line count once. Copies that
share four fifths of their lines are known by a few lines they share, however many they are;
unrelated documents under one header and footer are each known by a line of their own.
Documents that lose too large a part of their words are depleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import BLANKS, lookup, whole, words
from orderlens.session import staged

MIN_WORDS = 50
MOST_REPEATED = 50   # percent of words in repeated windows
SYMBOLS = "#*$%&|<>"
MIN_DOCS = 10        # a line in no more documents of a host is never boilerplate ...
SHARE = 0.005        # ... nor one in no more than this share of them,
MOST_SHARE = 100     # which asks for no more than so many, however large the host
KNOWN_BY = 0.2       # place of the line a document is known by, from the rarest on
MOST_REMOVED = 0.5   # a document that loses more of its words is depleted


def shifted(array: Column, by: int) -> Column:
    """The array from its element ``by`` on."""
    return F.slice(array, F.lit(by + 1), F.greatest(F.size(array) - by, F.lit(0)))


def base_metrics(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """Word, symbol, line and repetition counts of whole texts beside the kept columns."""
    text = whole()
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{BLANKS}]"))
    step1 = docs.select(*keep, text.alias("_text"), words(text).alias("_w"), lines.alias("_l"))
    # Hashes of the three-word windows with their places, equal ones next to each other.
    windows = F.zip_with(F.zip_with("_w", shifted(F.col("_w"), 1), lambda a, b: F.when(
        b.isNotNull(), F.xxhash64(a, b))), shifted(F.col("_w"), 2), lambda a, b: F.when(
            b.isNotNull(), F.xxhash64(a, b)))
    placed = F.filter(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))),
                      lambda s: s["h"].isNotNull())
    step2 = step1.select(
        *[c for c in step1.columns if c not in ("_w", "_l")],
        F.size("_w").cast("long").alias("n_words"),
        F.aggregate("_w", F.lit(0).cast("long"),
                    lambda s, w: s + F.char_length(w)).alias("word_chars"),
        F.char_length(F.regexp_replace("_text", f"[^{SYMBOLS}]+", "")).cast("long")
        .alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.sort_array(placed).alias("_s"))
    step3 = step2.withColumn("_s", F.concat(
        F.array(F.lit(None).cast("struct<h:bigint,i:int>")), "_s"))
    equal = F.zip_with("_s", shifted(F.col("_s"), 1), lambda a, b: F.when(
        a["h"] == b["h"], F.array(a["i"], b["i"])))
    twice = F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda p: p.isNotNull()))))
    step4 = step3.withColumn("_r", twice).drop("_s")
    # A repeated window covers three words, or as far as the next one's start.
    covered = F.zip_with("_r", shifted(F.col("_r"), 1),
                         lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    repeated = F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
    return step4.withColumn("n_repeat_words", repeated).drop("_r")


def base_failed() -> Column:
    """Too short, or too repetitive."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def normalised(text: Column) -> Column:
    """Lower case, digits as 0, blanks other than line breaks as one space."""
    text = F.regexp_replace(F.lower(text), "[0-9]", "0")
    return F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")


def line_hash(line: Column) -> Column:
    """60 bits of the line's MD5, which SQL engines agree on."""
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("long")


def with_lines(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``_lines``: hash and word count of each normalised line that has a word."""
    lines = F.filter(F.transform(F.split(normalised(F.col(text)), "\n"), lambda x: F.trim(x)),
                     lambda x: x != "")
    return docs.withColumn("_lines", F.transform(lines, lambda x: F.struct(
        line_hash(x).alias("h"),
        (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("n"))))


def frequent_lines(rows: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """Boilerplate (_host, h) of a written table (_row, _host, _lines), with the number of
    lines it stands for as ``n``.

    Lines are counted over the first documents of equal lines, then, where that passes the
    limit, over the lines their documents are known by. All counts combine before the shuffle;
    a line that every document of a hot host holds costs one row per task and known line.
    """
    hosts = staged(rows.groupBy("_host").agg(F.count("*").alias("_all")))
    hashes = F.transform("_lines", lambda x: x["h"])
    texts = rows.select("_row", "_host", hashes.alias("_h")).withColumn("_text", F.xxhash64("_h"))
    copied = staged(texts.groupBy("_host", "_text").agg(
        F.min("_row").alias("_first"), F.count("*").alias("_copies")).where("_copies > 1"))
    distinct = lookup(texts, copied, ["_host", "_text"], "_copies").where(
        F.col("_first").isNull() | (F.col("_first") == F.col("_row")))
    lines = distinct.select(
        "_row", "_host", F.coalesce("_copies", F.lit(1)).alias("_n"),
        F.explode(F.array_distinct("_h")).alias("h"))
    counts = staged(lines.groupBy("_host", "h").agg(
        F.count("*").alias("docs"), F.sum("_n").alias("n")).where("docs > 1"))
    limit = F.least(share * F.col("_all"), F.lit(float(MOST_SHARE)))
    many = staged(lookup(counts.where(F.col("docs") > min_docs), hosts, ["_host"], "_all").where(
        F.col("docs") > limit).withColumn("_limit", F.greatest(F.lit(float(min_docs)), limit))
        .drop("_all"))

    # The documents of those lines, with the counts of all their lines.
    holders = lookup(lines.select("_row", "_host", "h"), many.select("_host", "h", "docs"),
                     ["_host", "h"], "docs").where("docs is not null").select("_row").distinct()
    held = lookup(lines.join(holders, "_row", "left_semi").select("_row", "_host", "h"),
                  counts.drop("n"), ["_host", "h"], "docs")
    ordered = held.groupBy("_row", "_host").agg(F.sort_array(F.collect_list(F.struct(
        F.coalesce("docs", F.lit(1)).alias("docs"), "h"))).alias("_l"))
    place = F.floor(F.size("_l") * F.lit(KNOWN_BY)).cast("int")
    known = ordered.select("_host", F.get("_l", place)["h"].alias("_by"),
                           F.explode(F.filter("_l", lambda x: x["docs"] > min_docs)).alias("_x"))
    groups = known.groupBy("_host", F.col("_x.h").alias("h"), "_by").agg(F.lit(1).alias("_one")) \
        .groupBy("_host", "h").agg(F.count("*").alias("groups"))
    return many.join(groups, ["_host", "h"]).where(F.col("groups") > F.col("_limit")).select(
        "_host", "h", "n")


def removed_words(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """Per row: boilerplate lines and their words, and the distinct hashes."""
    places = rows.select("_row", "_host", F.inline("_lines"))
    met = lookup(places.withColumnRenamed("n", "_n"), frequent.withColumnRenamed("n", "docs"),
                 ["_host", "h"], "docs").where(F.col("docs").isNotNull())
    return met.groupBy("_row").agg(
        F.count("*").alias("n_removed_lines"), F.sum("_n").alias("n_removed_words"),
        F.collect_set("h").alias("_gone"))


def judged(docs: DataFrame, host: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Every document with its counts, ``base_failed``, ``kept`` and the hashes to remove.

    ``keep`` names columns to carry (``doc_id`` by default). A null text has no words and
    fails; a null host is a host of its own; a line repeated within a document counts once
    for it; repeated rows are documents each. No rows give no rows.
    """
    keep = keep or ["doc_id"]
    counted = base_metrics(docs, [
        *[F.col(c) for c in keep],
        F.coalesce(F.col(host).cast("string"), F.lit("\u0000")).alias("_host")])
    lined = with_lines(counted, "_text").drop("_text")
    rows = staged(lined.withColumn("_row", F.monotonically_increasing_id()))
    frequent = staged(frequent_lines(rows))
    removed = removed_words(rows, frequent)
    out = rows.drop("_lines", "_host").join(removed, "_row", "left").withColumn(
        "base_failed", base_failed())
    gone = F.coalesce("n_removed_words", F.lit(0))
    return (
        out.withColumn("n_removed_words", gone)
        .withColumn("n_removed_lines", F.coalesce("n_removed_lines", F.lit(0)))
        .withColumn("kept", ~F.col("base_failed") & (
            F.col("n_removed_words") <= MOST_REMOVED * F.col("n_words"))))


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines whose normalised hash is in ``gone``."""
    lines = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(
        gone, line_hash(F.trim(normalised(x)))))
    return F.when(F.size(gone) > 0, F.array_join(lines, "\n")).otherwise(text)
