"""Landing area to bronze, silver and gold."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from podium.operators.clean import drop_duplicate_rows, normalize_text
from podium.operators.enrich import avg_stats
from podium.sinks import preview, write_layer
from podium.sources import read_landing_csv, read_layer

# Names of the two tables and of the table of averages.
BIO = "athlete_bio"
RESULTS = "athlete_event_results"
GOLD = "avg_stats"


def landing_to_bronze(
    spark: SparkSession,
    landing: str,
    root: str,
    tables: Sequence[str] = (BIO, RESULTS),
    schemas: Mapping[str, StructType] | None = None,
    verify: bool = True,
    preview_rows: int = 0,
) -> dict[str, DataFrame]:
    """Each ``<landing>/<table>.csv`` to a bronze table."""
    schemas = schemas or {}
    bronze = {}
    for table in tables:
        df = read_landing_csv(spark, f"{landing}/{table}.csv", schemas.get(table))
        bronze[table] = write_layer(df, root, "bronze", table, verify)
    return _shown(bronze, preview_rows)


def bronze_to_silver(
    spark: SparkSession,
    root: str,
    tables: Sequence[str] = (BIO, RESULTS),
    verify: bool = True,
    preview_rows: int = 0,
) -> dict[str, DataFrame]:
    """Clean the text of each bronze table, drop equal rows, write silver."""
    silver = {}
    for table in tables:
        df = normalize_text(read_layer(spark, root, "bronze", table))
        silver[table] = write_layer(
            drop_duplicate_rows(df), root, "silver", table, verify
        )
    return _shown(silver, preview_rows)


def silver_to_gold(
    spark: SparkSession,
    root: str,
    verify: bool = True,
    preview_rows: int = 0,
    **options,
) -> DataFrame:
    """Averages by group, with the country of the result row.

    ``options`` go to ``avg_stats``.
    """
    stats = avg_stats(
        read_layer(spark, root, "silver", RESULTS),
        read_layer(spark, root, "silver", BIO),
        **options,
    )
    gold = write_layer(stats, root, "gold", GOLD, verify)
    return _shown({GOLD: gold}, preview_rows)[GOLD]


def run_medallion(
    spark: SparkSession,
    landing: str,
    root: str,
    schemas: Mapping[str, StructType] | None = None,
    verify: bool = True,
    preview_rows: int = 0,
) -> DataFrame:
    """The three steps in order; the gold table comes back."""
    landing_to_bronze(
        spark, landing, root, schemas=schemas, verify=verify, preview_rows=preview_rows
    )
    bronze_to_silver(spark, root, verify=verify, preview_rows=preview_rows)
    return silver_to_gold(spark, root, verify=verify, preview_rows=preview_rows)


def _shown(tables: dict[str, DataFrame], rows: int) -> dict[str, DataFrame]:
    if rows:
        for table in tables.values():
            preview(table, rows)
    return tables
