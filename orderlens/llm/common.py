"""Helpers the text operators share: words, document keys and a skew-safe lookup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space of the word rule, as the inside of a character class.
BLANKS = r"\x20\x09-\x0D"
# A key is hot above this share of the rows; fewer than HOT_KEYS keys can be.
HOT_KEYS = 1000


def whole(text: str = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(text), F.lit(""))


def words(text: Column) -> Column:
    """Runs of other characters than blanks."""
    return F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")


def document_key(doc: str = "doc_id", text: str = "text") -> list[Column]:
    """Non-null ``_doc`` and ``_hash``, equal only for equal rows of (id, text).

    Repeated rows share a key, so a table grouped by it has one row for all of them, and a
    left join from the documents keeps their number.
    """
    return [F.coalesce(F.col(doc).cast("long"), F.lit(-2 ** 63)).alias("_doc"),
            F.xxhash64(F.col(doc), F.col(text)).alias("_hash")]


def lookup(left: DataFrame, right: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Left join to a table that is unique by ``keys`` and counts in ``weight`` the rows of
    ``left`` with that key; pass ``right`` as a written table, it is read twice.

    Keys with more than 1/HOT_KEYS of all counted rows are answered by a broadcast of fewer
    than HOT_KEYS rows. Their rows, and those with a null key, then go to the shuffle join
    under a salt that matches nothing, so they spread over all tasks.
    """
    fields = [c for c in right.columns if c not in keys]
    total = right.agg(F.sum(weight)).first()[0] or 0
    hot = right.where(F.col(weight) * HOT_KEYS > total).select(
        *keys, F.struct(*fields).alias("_hot"))
    cold = right.select(*keys, F.lit(0).alias("_salt"), F.struct(*fields).alias("_cold"))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(2 ** 20)).cast("int") + 1
    out = (
        left.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.when(F.col("_hot").isNull() & known, 0).otherwise(spread))
        .join(cold, [*keys, "_salt"], "left")
        .withColumn("_got", F.coalesce("_hot", "_cold")))
    return out.select(*left.columns, *[F.col(f"_got.{f}").alias(f) for f in fields])


def total(parts: list[Column]) -> Column:
    """Sum of columns."""
    return reduce(lambda a, b: a + b, parts)
