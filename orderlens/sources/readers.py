"""Readers: every one declares its schema, so nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import constants as C
from orderlens import schemas as S
from orderlens.operators.orders import labelled_orders, order_features
from orderlens.session import staged


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SMALL_INPUT = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """Rows of a small input dealt out to all cores before CPU-heavy work.

    A file with one row group is one task however many cores there are. Large inputs have
    enough row groups and are left as they are, so nothing large is shuffled.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SMALL_INPUT:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [table(spark, folder, n) for n in names]


_order_tables: dict[tuple[str, str], DataFrame] = {}


def order_history(spark: SparkSession, folder: str) -> DataFrame:
    """The order table, built once per application and folder and then read as written.

    The line table is scanned and shuffled once; its per-order result is staged too, because
    the history columns need two passes over it. ``forget_order_tables`` makes later calls
    build anew, for a folder whose tables have changed.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _order_tables:
        orders, lineitem, customer = tables(spark, folder, "orders", "lineitem", "customer")
        _order_tables[key] = staged(
            order_features(staged(labelled_orders(orders, lineitem)), customer))
    return _order_tables[key]


def forget_order_tables() -> None:
    _order_tables.clear()


def require_path(spark: SparkSession, path: str) -> None:
    """A plain error when an input was never written."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        raise FileNotFoundError(f"{path} not found; write it first")


def orders_csv(spark: SparkSession, path: str, schema: T.StructType = S.ORDERS) -> DataFrame:
    """Order table from CSV. Columns are bound by name, whatever their order in the file; a
    missing column raises. Missing values are NULL, never NaN."""
    require_path(spark, path)
    raw = _csv_text(spark, path)
    absent = [f.name for f in schema if f.name not in raw.columns]
    if absent:
        raise ValueError(f"{path}: no column {', '.join(absent)}")
    return raw.select(*[
        F.nullif(F.col(f"`{f.name}`").try_cast(f.dataType), F.lit(float("nan"))).alias(f.name)
        if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def _csv_text(spark: SparkSession, path: str, corrupt: str | None = None) -> DataFrame:
    """All columns as text. Quoted cells may hold line breaks; quotes inside are doubled.
    ``corrupt`` names a column for lines that do not fit the header, else NULL."""
    options = {"header": True, "multiLine": True, "escape": '"'}
    names = spark.read.options(**options).csv(path).columns
    fields = [T.StructField(c, T.StringType()) for c in names]
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType()))
        options["columnNameOfCorruptRecord"] = corrupt
    return spark.read.options(**options).schema(T.StructType(fields)).csv(path)


def batch_csv(spark: SparkSession, path: str, expected: T.StructType = S.ORDERS) -> DataFrame:
    """User file: columns are matched by name; a bad value becomes NULL, not a failed job.

    Adds ``missing_columns``, the contract columns the file does not have, ``bad_columns``, those
    whose cell cannot be read as its type, and ``corrupt_record``, the whole line where it has
    more or fewer cells than the header. A column that is absent is different from a value that
    is NULL.
    """
    raw = _csv_text(spark, path, "corrupt_record")
    have = set(raw.columns)
    absent = [f.name for f in expected if f.name not in have]
    typed = [
        F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in have
        else F.lit(None).cast(f.dataType).alias(f.name) for f in expected]
    extra = [c for c in raw.columns if c not in {f.name for f in expected}]
    bad = [F.when((F.col(f.name) != "") & F.col(f.name).try_cast(f.dataType).isNull(),
                  F.lit(f.name)) for f in expected if f.name in have]
    return raw.select(
        *typed, *extra, F.array_compact(F.array(*bad)).cast("array<string>").alias("bad_columns"),
        F.array(*[F.lit(a) for a in absent]).cast("array<string>").alias("missing_columns"))


def batch_json(spark: SparkSession, path: str, identifier: str = "order_id",
               expected: T.StructType = S.ORDERS, required: list[str] | None = None) -> DataFrame:
    """User rows as JSON lines {identifier, features: {name: value}}, each with keys of its own.

    Returns the identifier, the required features with their types (``required``: the contract
    features by default), ``missing_features`` (required keys the row does not have, in
    contract order) and ``bad_features`` (values that cannot be read as their type). A key
    whose value is null is neither.
    """
    require_path(spark, path)
    kinds = {f.name: f.dataType for f in expected}
    names = required or C.FEATURES
    raw = spark.read.schema(T.StructType([
        T.StructField(identifier, kinds[identifier]),
        T.StructField("features", T.MapType(T.StringType(), T.StringType()))])).json(path)
    cells = F.coalesce("features", F.create_map().cast("map<string,string>"))

    given = {n: F.nullif(cells[n], F.lit("")) for n in names}
    read = {n: given[n].try_cast(kinds[n]) for n in names}

    def typed(name: str) -> Column:
        # NaN stands for a missing number.
        return F.nullif(read[name], F.lit(float("nan"))) \
            if isinstance(kinds[name], T.DoubleType) else read[name]

    bad = [F.when(given[n].isNotNull() & read[n].isNull(), F.lit(n)) for n in names]
    wanted = F.array(*[F.lit(n) for n in names])
    return raw.select(
        identifier, *[typed(n).alias(n) for n in names],
        F.array_except(wanted, F.map_keys(cells)).alias("missing_features"),
        F.array_compact(F.array(*bad)).alias("bad_features"))


def coerced(value: Column) -> Column:
    """Per-value typing of text: integer, else double, else text, as a struct."""
    as_int = value.try_cast("bigint")
    as_double = F.when(as_int.isNull(), value.try_cast("double"))
    return F.struct(
        as_int.alias("as_int"), as_double.alias("as_double"),
        F.when(as_int.isNull() & as_double.isNull(), value).alias("as_text"))


def coerced_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV of unknown types: every cell typed on its own."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[coerced(F.col(c)).alias(c) for c in raw.columns])


def documents(spark: SparkSession, path: str, pattern: str = "*.md",
              at_least: int = 12, identifier: str | None = None) -> DataFrame:
    """Whole-file documents. The first line must be ``# Title``; the rest is the text.

    The id is the file's name, or the folder value ``identifier=...`` where that is given.
    """
    raw = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True).select(
        F.col("value"), F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "")
        .alias("id") if identifier is None else F.col(identifier).cast("string").alias("id"))
    lines = F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), r"\r?\n")
    first = F.element_at(lines, 1)
    body = F.filter(
        F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))),
                    lambda line: F.trim(line)),
        lambda s: s != "")
    parsed = raw.select(
        "id", F.when(first.startswith("# "), F.trim(F.substr(first, F.lit(3))))
        .otherwise(F.raise_error(F.concat("id", F.lit(": first line must be '# Title'"))))
        .alias("title"),
        F.concat_ws(" ", body).alias("text"))
    found = raw.limit(at_least).count()
    if found < at_least:
        raise ValueError(f"knowledge base has only {found} documents; need >= {at_least}")
    return parsed


def catalog_json(spark: SparkSession, path: str, schema: T.StructType = S.CATALOG) -> DataFrame:
    """Catalog from a JSON array file."""
    require_path(spark, path)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def feature_cache(spark: SparkSession, path: str) -> DataFrame:
    require_path(spark, path)
    return spark.read.parquet(path)


def json_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
