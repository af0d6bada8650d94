"""Splits, class weights and the design matrix. Statistics come from the train part only."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens import constants as C
from orderlens.operators.ordering import exact_medians, hash_cuts, hash_key
from orderlens.schemas import FeatureSpec
from orderlens.session import bounded_rows

MAX_CLASSES = 1000
MAX_LEVELS = 10_000


def class_sizes(df: DataFrame, label: str) -> dict:
    rows = bounded_rows(df.groupBy(label).count(), MAX_CLASSES, f"classes of {label}")
    return {r[label]: r["count"] for r in rows}


def _below_cut(label: str, hashed: Column, cuts: dict, quota: dict) -> Column:
    expr = F.lit(False)
    for cls, q in quota.items():
        expr = F.when(F.col(label).eqNullSafe(F.lit(cls)), hashed <= F.lit(cuts[cls][q])) \
            .otherwise(expr)
    return expr


def stratified_split(df: DataFrame, identifier: str, label: str, percent: int = 20,
                     seed: int = C.SPLIT_SEED) -> DataFrame:
    """Adds ``split``: exactly ``percent`` % of every class (half up) is 'test'.

    Membership depends on the id alone, so it is the same under any partitioning.
    """
    quota = {cls: (percent * n * 2 + 100) // 200 for cls, n in class_sizes(df, label).items()}
    return _split_by_quota(df, identifier, label, quota, seed, "test")


def quota_split(df: DataFrame, identifier: str, label: str, val_size: int,
                seed: int = C.SPLIT_SEED) -> DataFrame:
    """Adds ``split``: val_size // classes rows of every class are 'val', the rest 'train'."""
    sizes = class_sizes(df, label)
    quota = {cls: min(n, val_size // len(sizes)) for cls, n in sizes.items()}
    return _split_by_quota(df, identifier, label, quota, seed, "val")


def _split_by_quota(df, identifier, label, quota, seed, name) -> DataFrame:
    cuts = hash_cuts(df, identifier, label, seed, {c: [q] for c, q in quota.items()})
    inside = _below_cut(label, hash_key(identifier, seed), cuts, quota)
    return df.withColumn("split", F.when(inside, name).otherwise("train"))


def stratified_folds(df: DataFrame, identifier: str, label: str, folds: int = 5,
                     seed: int = C.SPLIT_SEED) -> DataFrame:
    """Adds ``fold`` 0..folds-1; every class is spread over the folds as evenly as possible."""
    sizes = class_sizes(df, label)
    ends = {c: [n * (k + 1) // folds for k in range(folds - 1)] for c, n in sizes.items()}
    cuts = hash_cuts(df, identifier, label, seed, ends)
    hashed = hash_key(identifier, seed)
    fold = F.lit(0)
    for cls, marks in ends.items():
        above = sum(((hashed > F.lit(cuts[cls][m])).cast("int") for m in marks), F.lit(0))
        fold = F.when(F.col(label).eqNullSafe(F.lit(cls)), above).otherwise(fold)
    return df.withColumn("fold", fold.cast("int"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c), one row per class."""
    sizes = class_sizes(df, label)
    total, k = sum(sizes.values()), len(sizes)
    rows = [(c, n, total / (k * n)) for c, n in sizes.items()]
    kind = df.schema[label].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"{label} {kind}, n bigint, weight double")


def weight_column(df: DataFrame, label: str) -> Column:
    """The balanced weight of a row as an expression; nothing is joined."""
    sizes = class_sizes(df, label)
    total, k = sum(sizes.values()), len(sizes)
    expr = F.lit(None).cast("double")
    for cls, n in sizes.items():
        expr = F.when(F.col(label).eqNullSafe(F.lit(cls)), total / (k * n)).otherwise(expr)
    return expr


def _sql_double(value: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if value is None else f"CAST('{float(value)!r}' AS DOUBLE)"


def _sql_text(value: str | None) -> str:
    """A string literal; every character but plain ones is written as its number."""
    if value is None:
        return "CAST(NULL AS STRING)"
    plain = "".join(ch if ch.isalnum() and ch.isascii() or ch in " _-" else f"\\U{ord(ch):08X}"
                    for ch in str(value))
    return f"'{plain}'"


@dataclass
class Preprocessor:
    """Median/mode imputation, population standardisation and one-hot levels, once fitted."""

    spec: FeatureSpec
    medians: dict = field(default_factory=dict)
    means: dict = field(default_factory=dict)
    stds: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    levels: dict = field(default_factory=dict)

    @classmethod
    def fit(cls, train: DataFrame, spec: FeatureSpec) -> Preprocessor:
        medians = exact_medians(train, spec.numeric)
        moments = []
        for c in spec.numeric:
            filled = F.coalesce(F.col(c).cast("double"), F.lit(medians[c]))
            moments += [F.avg(filled).alias(f"m_{c}"), F.stddev_pop(filled).alias(f"s_{c}")]
        row = train.agg(*moments).first()
        modes, levels = {}, {}
        for c in spec.categorical:
            counts = bounded_rows(
                train.where(F.col(c).isNotNull()).groupBy(c).count(), MAX_LEVELS,
                f"levels of {c}")
            levels[c] = sorted(r[c] for r in counts)
            modes[c] = min(counts, key=lambda r: (-r["count"], r[c]))[c] if counts else None
        return cls(
            spec, medians,
            {c: row[f"m_{c}"] for c in spec.numeric},
            {c: row[f"s_{c}"] or 1.0 for c in spec.numeric},
            modes, levels)

    def columns(self) -> dict[str, Column]:
        """Design-matrix columns by name; an unseen level gives zeros everywhere."""
        out = {}
        for c in self.spec.numeric:
            filled = F.coalesce(F.col(c).cast("double"), F.lit(self.medians[c]))
            out[f"num__{c}"] = (filled - self.means[c]) / self.stds[c]
        for c in self.spec.categorical:
            filled = F.coalesce(F.col(c), F.lit(self.modes[c]))
            for level in self.levels[c]:
                out[f"cat__{c}_{level}"] = (filled == level).cast("double")
        return out

    def names(self) -> list[str]:
        return list(self.columns())

    def stages(self, vector: str = "features") -> list[Transformer]:
        """The same columns as two transformers that can be saved in front of a model.

        The statistics stand in the SQL text as exact literals, so a reloaded pipeline scores
        raw rows without anything else. A value that stays NULL (no median or mode) counts as 0.
        """
        names, parts = [], []
        for number, expression in enumerate(self._sql()):
            names.append(f"_feature_{number}")
            parts.append(f"coalesce({expression}, 0D) AS {names[-1]}")
        return [
            SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"),
            VectorAssembler(inputCols=names, outputCol=vector)]

    def _sql(self) -> Iterator[str]:
        for c in self.spec.numeric:
            filled = f"coalesce(CAST(`{c}` AS DOUBLE), {_sql_double(self.medians[c])})"
            yield f"({filled} - {_sql_double(self.means[c])}) / {_sql_double(self.stds[c])}"
        for c in self.spec.categorical:
            filled = f"coalesce(`{c}`, {_sql_text(self.modes[c])})"
            for level in self.levels[c]:
                yield f"CAST({filled} = {_sql_text(level)} AS DOUBLE)"

    def transform(self, df: DataFrame, vector: str = "features") -> DataFrame:
        from pyspark.ml.functions import array_to_vector

        return df.withColumn(vector, array_to_vector(F.array(*self.columns().values())))


def missing_features(features: Column, required: list[str] | None = None) -> Column:
    """Required keys a feature map does not have, in contract order."""
    wanted = F.array(*[F.lit(f) for f in required or C.FEATURES])
    return F.array_except(wanted, F.map_keys(features))
