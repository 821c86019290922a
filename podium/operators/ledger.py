"""Filtered counts, kept in a ledger, and a check that the last is recent."""

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.operators.clean import field, quoted
from podium.schemas import LEDGER, LEDGER_COLUMN_TYPES, LEDGER_DDL
from podium.sinks import write_jdbc
from podium.sources import read_jdbc
from podium.sources.jdbc import literal

# Fixed value: how old, in seconds, the last entry may be.
FRESH_SECONDS = 30

# Ledger label and the medal that is counted under it. The
# labels do not name the medals counted.
ROTATED_PAIRS = [("Bronze", "Gold"), ("Silver", "Bronze"), ("Gold", "Silver")]

# Under which Spark keeps a column's default.
DEFAULT = "CURRENT_DEFAULT"


def count_where(df: DataFrame, column: str, value: object) -> DataFrame:
    """One row, ``count``: rows whose ``column`` equals ``value``, case and all."""
    found = quoted(field(df, column).name)
    return df.filter(found == F.lit(value)).agg(F.count("*").alias("count"))


def count_pairs(
    df: DataFrame, column: str, pairs: Sequence[tuple[str, object]]
) -> DataFrame:
    """``medal_type`` and ``count`` for each (label, value), in a single scan.

    A value that never occurs has count 0.
    """
    found = quoted(field(df, column).name)
    counts = df.filter(found.isin([value for _, value in pairs])).agg(
        *[
            F.count_if(found == F.lit(value)).alias(f"count_{i}")
            for i, (_, value) in enumerate(pairs)
        ]
    )
    return _entries(counts, pairs)


def _entries(counts: DataFrame, pairs: Sequence[tuple[str, object]]) -> DataFrame:
    entries = [
        F.struct(F.lit(label).alias("medal_type"), F.col(f"count_{i}").alias("count"))
        for i, (label, _) in enumerate(pairs)
    ]
    return counts.select(F.inline(F.array(*entries)))


def count_pairs_jdbc(
    spark: SparkSession, column: str, pairs: Sequence[tuple[str, object]], **access: str
) -> DataFrame:
    """``count_pairs`` with the counting done by the database.

    ``access`` has the arguments of ``read_jdbc``. One grouped row set comes back, with a
    row for each of the values asked for that there is, and for values that the database
    takes as equal to one. What has no such value counts 0.
    """
    wanted = ", ".join(dict.fromkeys(literal(value) for _, value in pairs))
    grouped = (
        f"(select {column} as v, count(*) as n from {access['table']} "
        f"where {column} in ({wanted}) group by {column}) counts"
    )
    rows = read_jdbc(spark, **{**access, "table": grouped}, partition_column=None)
    counts = rows.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("v") == F.lit(value), F.col("n"))), F.lit(0))
            .cast("long")
            .alias(f"count_{i}")
            for i, (_, value) in enumerate(pairs)
        ]
    )
    return _entries(counts, pairs)


def create_ledger(spark: SparkSession, table: str, path: str | None = None) -> None:
    """Make a ledger in the catalog, if it is not there.

    Its columns have fixed types, the label a greatest width, and the time of an entry is
    put in by the table itself where an insert gives none. ``path`` is where its files lie,
    in the warehouse if not given; over files that are there already the ledger has their
    rows. A table of that name with other columns, or without that default, is an error.
    """
    where = "" if path is None else f" LOCATION {literal(path)}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({LEDGER_DDL}) USING parquet{where}")
    found = spark.table(table).schema
    default = found["created_at"].metadata.get(DEFAULT) if "created_at" in found.names else None
    if [(f.name, f.dataType) for f in found] != [(f.name, f.dataType) for f in LEDGER] or not default:
        raise ValueError(f"{table} is a table, but not a ledger")


def append_count(
    counts: DataFrame,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
    table: str | None = None,
) -> datetime:
    """Append ``medal_type, count`` rows with the time of insertion.

    The counts (a row for each label) are finished first and the time is taken after that,
    by the query that inserts them. To a ledger of the catalog (``table``, whose own default
    gives the time), to Parquet at ``path``, or to a database with the arguments of
    ``write_jdbc`` in ``jdbc``; each is made if it is missing. Returns when the counts were
    finished.
    """
    spark = counts.sparkSession
    rows = counts.select("medal_type", F.col("count").cast("long").alias("count"))
    finished = spark.createDataFrame(rows.collect(), rows.schema)
    counted = datetime.now(UTC)
    if table is not None:
        create_ledger(spark, table, path)
        spark.sql(
            f"INSERT INTO {table} (medal_type, count) SELECT medal_type, count FROM {{entries}}",
            entries=finished,
        )
        return counted
    entries = finished.withColumn("created_at", F.current_timestamp())
    if jdbc is not None:
        write_jdbc(entries, column_types=LEDGER_COLUMN_TYPES, **jdbc)
    else:
        entries.write.mode("append").parquet(path)
    return counted


def recent_entry(
    ledger: DataFrame, seconds: int = FRESH_SECONDS, now: Column | None = None
) -> DataFrame:
    """``fresh`` = 1 and the time of the latest entry, if it is recent.

    No row if no entry is less than ``seconds`` older than ``now``, which is
    the clock unless given.
    """
    now = F.current_timestamp() if now is None else now
    oldest = now - F.expr(f"INTERVAL {int(seconds)} SECOND")
    return (
        ledger.filter(F.col("created_at") > oldest)
        .orderBy(F.col("created_at").desc())
        .limit(1)
        .select(F.lit(1).alias("fresh"), "created_at")
    )


def is_fresh(
    ledger: DataFrame, seconds: int = FRESH_SECONDS, now: Column | None = None
) -> bool:
    """Whether the ledger has an entry less than ``seconds`` old."""
    return not recent_entry(ledger, seconds, now).isEmpty()
