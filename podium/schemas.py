"""Declared schemas of the JSON messages and of the medal ledger."""

from pyspark.sql import types as T

# Column names and types of the message formats.
EVENT_RESULTS = T.StructType(
    [
        T.StructField("edition", T.StringType()),
        T.StructField("edition_id", T.IntegerType()),
        T.StructField("country_noc", T.StringType()),
        T.StructField("sport", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("result_id", T.IntegerType()),
        T.StructField("athlete", T.StringType()),
        T.StructField("athlete_id", T.IntegerType()),
        T.StructField("pos", T.StringType()),
        T.StructField("medal", T.StringType()),
        T.StructField("isTeamSport", T.BooleanType()),
    ]
)

ENRICHED_AVG = T.StructType(
    [
        T.StructField("sport", T.StringType()),
        T.StructField("medal", T.StringType()),
        T.StructField("sex", T.StringType()),
        T.StructField("country_noc", T.StringType()),
        T.StructField("avg_height", T.DoubleType()),
        T.StructField("avg_weight", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("medal_type", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# Width of the ledger's label column in a database, and the columns of a
# ledger in the catalog with what fills in the time.
LEDGER_COLUMN_TYPES = "medal_type VARCHAR(10)"
LEDGER_DDL = (
    "medal_type VARCHAR(10), count BIGINT, created_at TIMESTAMP DEFAULT current_timestamp()"
)


def with_names(schema: T.StructType, renames: dict[str, str]) -> T.StructType:
    """Copy of ``schema`` with some fields called otherwise.

    A reader that asks for a field the messages do not carry gets null there:
    ``with_names(ENRICHED_AVG, {"country_noc": "noc_country"})`` is such a
    reader.
    """
    return T.StructType(
        [
            T.StructField(renames.get(f.name, f.name), f.dataType, f.nullable)
            for f in schema.fields
        ]
    )
