"""Tables in files: CSV in the landing area, Parquet in the layers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_landing_csv(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """CSV with a header row.

    Types are inferred, which reads all the files once more; on large files
    give ``schema`` and save that pass.
    """
    if schema is not None:
        return spark.read.csv(path, header=True, schema=schema)
    return spark.read.csv(path, header=True, inferSchema=True)


def read_layer(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(layer_path(root, layer, table))
