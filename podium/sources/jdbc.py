"""Tables in a SQL database."""

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# The column biographies are read in ranges of, that of results, of
# which no key has many rows, and the number of connections a write uses.
PARTITION_COLUMN = "athlete_id"
RESULT_COLUMN = "result_id"
NUM_PARTITIONS = 10

FETCH_ROWS = 10_000


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
) -> dict[str, str]:
    options = {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "user": user,
        "password": password,
    }
    return {name: value for name, value in options.items() if value is not None}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = PARTITION_COLUMN,
    bounds: tuple | None = None,
    num_partitions: int | None = None,
    equal_counts: bool = False,
) -> DataFrame:
    """Read ``table`` in ``num_partitions`` ranges of ``partition_column``.

    As many ranges as the session has cores, unless given. Ranges are of equal width
    between ``bounds``, which only set the stride: rows outside them are read too. By
    default the database is asked for the least and greatest key, so that the ranges cover
    the keys there are. ``equal_counts`` asks it for quantiles of the column instead, one
    sort of its keys there, and the ranges have about equally many rows however the keys
    are spread; keys of any type that compares will do.

    Ranges are those of the moment of this call. A stream that keeps what this returns
    keeps its ranges; one that calls it in each epoch (``enrich_epochs``) has new ones. A
    range holds all rows of its keys: where one athlete may have a large part of the
    results, read those in ranges of another column, such as ``result_id``. ``None`` reads
    a small table in one go.
    """
    access = jdbc_options(url, table, driver, user, password)
    options = {**access, "fetchsize": str(FETCH_ROWS)}
    if partition_column is not None and equal_counts:
        if bounds is not None:
            raise ValueError("bounds are for ranges of equal width")
        n = num_partitions or spark.sparkContext.defaultParallelism
        ranges = equal_count_ranges(spark, access, partition_column, n)
        if len(ranges) > 1:
            properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
            return spark.read.jdbc(url, table, predicates=ranges, properties=properties)
        partition_column = None
    if partition_column is None:
        bounds = None
    elif bounds is None:
        ends = f"(select min({partition_column}) as lo, max({partition_column}) as hi from {table}) ends"
        row = spark.read.format("jdbc").options(**{**access, "dbtable": ends}).load().first()
        bounds = None if row[0] is None else (row[0], row[1])
    if bounds is not None:
        options["partitionColumn"] = partition_column
        options["lowerBound"] = str(bounds[0])
        options["upperBound"] = str(bounds[1])
        options["numPartitions"] = str(num_partitions or spark.sparkContext.defaultParallelism)
    return spark.read.format("jdbc").options(**options).load()


def equal_count_ranges(
    spark: SparkSession, access: dict[str, str], column: str, n: int
) -> list[str]:
    """Conditions that part a table into at most ``n`` ranges of about equally many rows.

    The database deals its sorted keys into ``n`` tiles and gives the last key of each:
    ``n`` rows come back. Keys that end several tiles end one range. Each row, one without
    key among them, meets exactly one condition.
    """
    tiles = (
        f"(select tile, max(k) as upto from (select {column} as k, "
        f"ntile({n}) over (order by {column}) as tile from {access['dbtable']} "
        f"where {column} is not null) keyed group by tile) tiles"
    )
    rows = spark.read.format("jdbc").options(**{**access, "dbtable": tiles}).load().collect()
    ends = sorted({row["upto"] for row in rows})[:-1]
    if not ends:
        return []
    texts = [literal(end) for end in ends]
    return [
        f"{column} <= {texts[0]} or {column} is null",
        *(f"{column} > {a} and {column} <= {b}" for a, b in zip(texts, texts[1:])),
        f"{column} > {texts[-1]}",
    ]


def literal(value: object) -> str:
    """A key as SQL: numbers as they are, all else as quoted text."""
    if isinstance(value, int | float | Decimal) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"
