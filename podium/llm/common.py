"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.shared import working_dir

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def remainder(column: Column, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; a null counts as empty text."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % n


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8."""
    return text.encode().lower().split() if text else []


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches a few rows at a time.

    Spark's batches hold up to 64 MB; what is made of texts in Python takes several
    times that, and each executor has several workers.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def kept(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends there."""
    path = working_dir(df.sparkSession, purpose)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit values with all bits stirred (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * GOLDEN
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))
