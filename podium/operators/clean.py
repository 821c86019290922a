"""Cleaning of whole tables."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from podium.functions.text import normalized


def quoted(name: str) -> Column:
    """Column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def field(df: DataFrame, name: str) -> StructField:
    """The column that Spark means by ``name``: without case, unless the session minds it.

    A name of the same case goes first; several others are ambiguous.
    """
    fields = df.schema.fields
    found = [f for f in fields if f.name == name]
    if not found and df.sparkSession.conf.get("spark.sql.caseSensitive") != "true":
        found = [f for f in fields if f.name.lower() == name.lower()]
    if len(found) != 1:
        problem = "no column" if not found else "more than one column"
        raise ValueError(f"{problem} {name!r} among {df.columns}")
    return found[0]


def as_measure(df: DataFrame, name: str) -> Column:
    """The column as double; text that is no number gives null.

    CSV inference leaves a measure as text when a single cell is not a number,
    and under ANSI rules a plain cast of that cell would fail the job.
    """
    found = field(df, name)
    if isinstance(found.dataType, DoubleType):
        return quoted(found.name)
    return quoted(found.name).try_cast("double")


def normalize_text(df: DataFrame) -> DataFrame:
    """Lower and trim every string column, in one projection."""
    return df.select(
        [
            normalized(quoted(f.name)).alias(f.name)
            if f.dataType == StringType()
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows, all columns compared.

    Nulls are equal, NaNs are equal, and -0.0 equals 0.0. Each task drops its
    own copies before the shuffle, so a row with very many copies reaches the
    shuffle at most once per task.
    """
    return df.dropDuplicates()


def drop_missing(
    df: DataFrame, columns: Sequence[str] = ("height", "weight")
) -> DataFrame:
    """Keep rows where every one of ``columns`` is a number, not null or NaN."""
    present = [
        as_measure(df, name).isNotNull() & ~F.isnan(as_measure(df, name))
        for name in columns
    ]
    return df.filter(reduce(and_, present))
