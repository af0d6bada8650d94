"""Pipeline stages: each takes (spark, docs, folder) and returns the documents it lets on.

All but the last return the columns they got. Extra columns, whatever their names, are
carried along; a changed text updates ``n_chars`` where there is such a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import packing as pack
from orderlens.llm import pii, quality, simhash
from orderlens.llm.common import lookup
from orderlens.session import staged


def _own(docs: DataFrame) -> DataFrame:
    """Rows as one struct ``_all`` with a stable number ``_row``; no column can clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return staged(docs.select(whole.alias("_all"), F.monotonically_increasing_id().alias("_row")))


def _with_text(docs: DataFrame, text: Column) -> list[Column]:
    """The columns of the documents with another text, out of ``_all``."""
    def column(name: str) -> Column:
        own = F.col("_all").getField(name)
        if name == "text":
            return text.alias(name)
        if name == "n_chars":
            changed = ~text.eqNullSafe(F.col("_all").getField("text"))
            kind = docs.schema["n_chars"].dataType
            return F.when(changed, F.char_length(text).cast(kind)).otherwise(own).alias(name)
        return own.alias(name)

    return [column(c) for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops rejected documents; boilerplate lines of the others go from their text."""
    rows = _own(docs)
    plain = rows.select("_row", F.col("_all.text").alias("text"),
                        F.col("_all.source").alias("source"))
    verdict = quality.judged(plain.withColumnRenamed("_row", "_at"), keep=["_at"])
    kept = verdict.where("kept").select(F.col("_at").alias("_row"), "_gone")
    text = F.when(F.col("_gone").isNull(), F.col("_all.text")).otherwise(
        quality.without_lines(F.col("_all.text"), F.col("_gone")))
    return rows.join(kept, "_row").select(*_with_text(docs, text))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of ``simhash.classes`` stays, the one with the smallest id:
    fingerprints of three-word shingles, linked at two or fewer differing bits."""
    rows = _own(docs)
    plain = rows.select("_row", F.col("_all.doc_id").alias("doc_id"),
                        F.col("_all.text").alias("text"))
    keep = simhash.representatives(plain)
    return rows.join(keep, "_row", "left_semi").select("_all.*")


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replaces personal data by its kind; no document goes."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"))
    clean = rows.withColumn("_clean", pii.redact(F.col("_all.text")))
    return clean.select(*_with_text(docs, F.col("_clean")))


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document's length bucket, batch and slot."""
    return pack.pack(docs, pack.n_words())
