"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialize, shared_dir

__all__ = ["materialize", "shared_dir", "slices", "spread_sample", "table"]

SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text, so that work space doesn't grow with the texts' lengths.

    A slice is larger than that by one text at most; an empty batch gives none.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // most
    start = 0
    while start < len(part):
        end = max(start + 1, int(np.searchsorted(part, part[start], side="right")))
        yield batch.slice(start, end - start)
        start = end


def spread_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, chosen by a hash of ``key`` and the same in every run.

    Rows are thinned by hash before they are ordered, so no task hands on more than its share of the sample.
    """
    thin = max(1, df.count() // max(1, 2 * limit))
    return df.where(F.pmod(F.xxhash64(key, F.lit(1)), F.lit(thin)) == 0).orderBy(F.xxhash64(key), key).limit(limit)
