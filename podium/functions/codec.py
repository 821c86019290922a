"""Rows to JSON messages and back."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# What unwrapping takes away: every backslash, one quote at the
# start and one at the end. The end is also before a last line break.
BACKSLASH = "\\"
QUOTE = '"'
QUOTE_AT_END = '"$'
LINE_BREAKS = ["\n", "\r", "\u0085", "\u2028", "\u2029"]


def encode_json(df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """One message per row: null ``key`` and all columns as JSON in ``value``.

    Null fields are left out of the text and timestamps are cut to
    milliseconds. ``options={"timestampFormat":
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}`` keeps microseconds.
    """
    return df.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct("*"), options).alias("value"),
    )


def unwrap_json(column: Column) -> Column:
    r"""Undo a second JSON encoding: drop backslashes, then the outer quotes.

    Lossy: a value that itself holds an escaped quote no longer parses after
    this, and ``a\\b`` turns into ``ab``. Use it only on topics known to be
    encoded twice.
    """
    value = F.replace(column.cast("string"), F.lit(BACKSLASH), F.lit(""))
    value = F.when(value.startswith(QUOTE), F.substr(value, F.lit(2))).otherwise(value)
    # The pattern is tried on the few values that need it.
    return (
        F.when(value.endswith(QUOTE), F.left(value, F.length(value) - 1))
        .when(
            F.right(value, F.lit(1)).isin(LINE_BREAKS),
            F.regexp_replace(value, QUOTE_AT_END, ""),
        )
        .otherwise(value)
    )


def decode_json(
    messages: DataFrame,
    schema: StructType,
    fields: Sequence[str] | None = None,
    unwrap: bool = False,
    options: dict[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse ``value`` by ``schema``; give ``fields``, or all of them.

    ``keep`` names columns of the message, such as ``key``, that go before them.

    A message that does not parse gives a row of nulls, a field of another
    type gives null in that field. Field names match with case. Only the
    fields asked for are converted.

    ``inline`` of the one parsed struct instead of ``data.*``: a later filter on
    a field would else move below the parsing and parse each message twice.
    """
    value = F.col("value")
    value = unwrap_json(value) if unwrap else value.cast("string")
    if fields is not None:
        schema = StructType([schema[name] for name in fields])
    data = F.from_json("value", schema, options)
    parsed = messages.select(*keep, value.alias("value"))
    return parsed.select(*keep, F.inline(F.array(data)))
