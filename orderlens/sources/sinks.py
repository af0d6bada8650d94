"""Writers. All overwrite their target, so a re-run replaces its own output."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def csv_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def json_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


Encoder = Callable[[pa.RecordBatch], pa.RecordBatch]


def write_feature_cache(df: DataFrame, path: str, encode: Encoder, schema: str) -> None:
    """Run the encoder once over Arrow batches and keep the vectors; training reads them."""
    parquet(encode_batches(df, encode, schema), path)


def encode_batches(df: DataFrame, encode: Encoder, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield encode(batch)

    return df.mapInArrow(run, schema)


def hashed_bag_encoder(dim: int = 64) -> Encoder:
    """Default local encoder: tokens hashed into ``dim`` signed slots, unit length.

    Takes (id, tokens) and gives (id, features). A token's number is the first 52 bits of its
    MD5: modulo ``dim`` its slot, the 17th bit its sign. Every distinct token of a batch is
    hashed once, and the slots of all rows are summed together.
    """
    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens = batch.column("tokens")
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        flat = tokens.flatten().dictionary_encode()
        number = np.array([int(md5(t.encode()).hexdigest()[:13], 16)
                           for t in flat.dictionary.to_pylist()], np.int64)
        code = flat.indices.to_numpy(zero_copy_only=False)
        cell = np.repeat(np.arange(len(lengths)), lengths) * dim + (number % dim)[code]
        sign = np.where(number >> 16 & 1, 1.0, -1.0)[code]
        sums = np.bincount(cell, sign, len(lengths) * dim).astype(float).reshape(-1, dim)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        out = np.divide(sums, norms, out=np.zeros_like(sums), where=norms > 0)
        offsets = pa.array(np.arange(len(lengths) + 1, dtype=np.int32) * dim)
        return pa.RecordBatch.from_arrays(
            [batch.column("id"),
             pa.ListArray.from_arrays(offsets, pa.array(out.ravel().astype(np.float32)))],
            names=["id", "features"])

    return encode


def nested_report(df: DataFrame, key: list[str], name: str, fields: list[str]) -> DataFrame:
    """Rows folded into one JSON document per key. For keys with few rows (report tables)."""
    return df.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
