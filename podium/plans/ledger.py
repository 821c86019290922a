"""Count medals, write the counts down, see that the last one is recent."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from podium.operators.ledger import append_count, count_pairs, count_pairs_jdbc, is_fresh
from podium.sources import read_jdbc


def record_medal_count(
    results: DataFrame,
    pairs: Sequence[tuple[str, str]],
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
    table: str | None = None,
) -> bool:
    """Append one entry per (label, medal) and check that the ledger is fresh.

    The ledger is a ``table`` of the catalog, Parquet at ``path`` or a database table.
    """
    return _recorded(count_pairs(results, "medal", pairs), path, jdbc, table)


def record_medal_count_jdbc(
    spark: SparkSession,
    pairs: Sequence[tuple[str, str]],
    results: dict[str, str],
    ledger: dict[str, str],
) -> bool:
    """The same with results and ledger in a database, which does the counting.

    Both have the arguments of ``read_jdbc``.
    """
    return _recorded(count_pairs_jdbc(spark, "medal", pairs, **results), None, ledger)


def _recorded(
    counts: DataFrame,
    path: str | None,
    jdbc: dict[str, str] | None,
    table: str | None = None,
) -> bool:
    spark = counts.sparkSession
    append_count(counts, path, jdbc, table)
    if table is not None:
        return is_fresh(spark.table(table))
    if jdbc is not None:
        return is_fresh(read_jdbc(spark, **jdbc, partition_column=None))
    return is_fresh(spark.read.parquet(path))
