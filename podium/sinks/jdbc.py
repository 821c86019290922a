"""Append to a table of a SQL database."""

from pyspark.sql import DataFrame

from podium.sources.jdbc import NUM_PARTITIONS, jdbc_options

BATCH_ROWS = 10_000


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    column_types: str | None = None,
    num_partitions: int = NUM_PARTITIONS,
) -> None:
    """Append ``df`` over ``num_partitions`` connections.

    The table is made if it is missing, with ``column_types`` where given. The rows
    are dealt out first: Spark would else bring the stages above the write down to
    so few tasks.
    """
    options = {
        **jdbc_options(url, table, driver, user, password),
        "batchsize": str(BATCH_ROWS),
        "numPartitions": str(num_partitions),
    }
    if column_types is not None:
        options["createTableColumnTypes"] = column_types
    df.repartition(num_partitions).write.format("jdbc").options(**options).mode("append").save()
