"""Secret scan: patterns with exact places, and corpus-wide ownership of every value.

Spark has no function for the places of all matches. Splitting a text by a pattern gives the
gaps between its matches, so a match starts where the gaps and matches before it end; the
running sum is a window over one document's matches. DataFrame functions only.

A value that many owners or many repositories hold is a copied example; one that a single owner
or two hold in few repositories looks live. Base spans are always reported, spans of the
further kinds only where they look live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.llm.common import document_key, lookup, whole
from orderlens.session import staged

ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
# kind: pattern, group with the value, least characters of it, text any match contains.
BASE = {
    "assign": (ASSIGN, 2, 8, None),
    "access": (r"AKIA[A-Z0-9]+", 0, 16, "AKIA"),
    # A run of hex digits is taken whole, so the length can stand in the pattern.
    "hex": (r"[0-9a-f]{32,}", 0, 32, None),
}
MORE = {
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 36, "gh"),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30, "eyJ"),
    "pem": (r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]+", 0, 60, "-----BEGIN "),
}
ORDER = [*BASE, *MORE]
MOST_OWNERS = 2  # a value of more owners is an example,
MOST_REPOS = 20  # and so is one in more repositories, under however few owners


def matches(docs: DataFrame) -> DataFrame:
    """Long enough matches of all kinds in one pass over the texts: key columns, kind number,
    start, end, and the value's hash."""
    key, text = ["_doc", "_hash", "_owner", "_repo"], F.col("text")

    def places(kind: int, pattern: str, hint: str | None) -> Column:
        may = text.contains(hint) if hint else F.lit(True)
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.when(may & text.rlike(pattern), F.struct(
            F.lit(kind).alias("kind"),
            F.arrays_zip(gaps.alias("gap"), found.alias("match")).alias("places")))

    kinds = {**BASE, **MORE}
    hits = docs.select(*key, F.explode(F.array_compact(F.array(*[
        places(n, pattern, hint) for n, (pattern, _, _, hint) in enumerate(kinds.values())])))
        .alias("_k"))
    parts = hits.select(*key, "_k.kind", F.posexplode("_k.places").alias("_i", "_p")).select(
        *key, "kind", "_i", "_p.*").where(F.col("match").isNotNull())
    # Repeated rows have the same matches; one copy is enough.
    parts = parts.dropDuplicates([*key, "kind", "_i"])
    before = W.partitionBy(*key, "kind").orderBy("_i")
    ends = F.sum(F.col("gap") + F.char_length("match")).over(before)
    value, least = F.col("match"), F.lit(0)
    for n, (pattern, group, short, _) in enumerate(kinds.values()):
        if group:
            value = F.when(F.col("kind") == n, F.regexp_extract("match", pattern, group)) \
                .otherwise(value)
        least = F.when(F.col("kind") == n, short).otherwise(least)
    return parts.select(
        *key, "kind", (ends - F.char_length("match")).alias("start"), ends.alias("end"),
        value.alias("value")).where(F.char_length("value") >= least).withColumn(
        "value", F.sha2("value", 256))


def ownership(spans: DataFrame) -> DataFrame:
    """Per value: distinct owners and repositories, and rows. Each level combines before its
    shuffle, so a value that everyone has travels once per task and owner."""
    per_repo = spans.groupBy("value", "_owner", "_repo").agg(F.count("*").alias("rows"))
    per_owner = per_repo.groupBy("value", "_owner").agg(
        F.count("*").alias("repos"), F.sum("rows").alias("rows"))
    return per_owner.groupBy("value").agg(
        F.count("*").alias("owners"), F.sum("repos").alias("repos"), F.sum("rows").alias("rows"))


def scan(docs: DataFrame, owner: str = "source", repo: str = "doc_id", doc: str = "doc_id",
         text: str = "text", most_owners: int = MOST_OWNERS,
         most_repos: int = MOST_REPOS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_spans, spans, n_live, n_example.

    ``owner`` and ``repo`` name the columns that own a document. Span lists are text,
    ``kind:start:end`` by start, then kind. A null text has none; a null owner is one owner;
    repeated rows stay and count as one repository.
    """
    plain = docs.select(
        F.col(doc).alias("doc_id"), whole(text).alias("text"),
        F.coalesce(F.col(owner).cast("string"), F.lit("\u0000")).alias("_owner"),
        F.coalesce(F.col(repo).cast("string"), F.lit("\u0000")).alias("_repo"))
    plain = plain.select("*", *document_key())
    spans = staged(matches(plain))
    owners = staged(ownership(spans))
    known = lookup(spans, owners, ["value"], "rows").withColumn(
        "live", (F.col("owners") <= most_owners) & (F.col("repos") <= most_repos))
    name = F.element_at(F.array(*map(F.lit, ORDER)), F.col("kind") + 1)
    told = F.concat_ws(":", name, F.col("start"), F.col("end"))
    base = F.col("kind") < len(BASE)
    key = ["_doc", "_hash", "_owner", "_repo"]
    listed = known.where(base | F.col("live")).groupBy(*key).agg(
        *[F.count(F.when(F.col("kind") == n, 1)).alias(f"n_{k}") for n, k in enumerate(BASE)],
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", told.alias("s"))))
        .alias("_spans"),
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.count(F.when(~F.col("live"), 1)).alias("n_example"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: s["s"]), ",")

    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,s:string>>")
    out = plain.select("doc_id", *key).join(listed, key, "left").withColumn(
        "_spans", F.coalesce("_spans", none))
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", *[F.coalesce(c, zero).alias(c) for c in (f"n_{k}" for k in BASE)],
        joined(F.filter("_spans", lambda s: s["kind"] < len(BASE))).alias("base_spans"),
        joined(F.col("_spans")).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"),
        F.coalesce("n_example", zero).alias("n_example"))
