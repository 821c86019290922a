"""Streams of files whose schema is inferred once."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from podium.shared import Folder

PINNED = "schema.json"


def pinned_schema(
    spark: SparkSession, path: str, fmt: str, checkpoint: str, **options: str
) -> StructType:
    """The schema kept beside ``checkpoint``, or else that of the files there are now.

    Inference reads the files; it happens before the first start only. Spark's own
    ``spark.sql.streaming.schemaInference`` infers again at each start, and a stream whose
    state or sink has the old columns then fails or changes its meaning.
    """
    folder = Folder(spark, checkpoint)
    if not folder.exists(PINNED):
        found = spark.read.format(fmt).options(**options).load(path).schema
        folder.write(PINNED, found.json())
    return StructType.fromJson(json.loads(folder.read(PINNED)))


def read_feed(
    spark: SparkSession,
    path: str,
    fmt: str,
    checkpoint: str,
    max_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream of a directory's files without a schema given.

    ``checkpoint`` is the stream's own: started on it again, the stream has the columns it
    had at first, whatever files came since. Columns they add are not read; a JSON or CSV
    value of another type is null, and a Parquet one an error, as Spark has it.
    """
    schema = pinned_schema(spark, path, fmt, checkpoint, **options)
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.load(path)
