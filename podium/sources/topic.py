"""Topics as streams of messages.

``fmt="kafka"`` reads a broker and needs Spark's Kafka connector. ``"text"``
(one message a line) and ``"parquet"`` (``key``, ``value``) read a directory
of files instead, new files being new messages.
"""

from pyspark.sql import DataFrame, SparkSession

# Where a reader starts, and messages per micro-batch.
STARTING_OFFSETS = "earliest"
MAX_OFFSETS_PER_TRIGGER = 50

FILE_SCHEMAS = {"text": "value string", "parquet": "key string, value string"}


def topic_options(
    topic: str,
    servers: list[str] | None,
    max_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Options of the broker reader."""
    options = {
        "kafka.bootstrap.servers": ",".join(servers or []),
        "subscribe": topic,
        "startingOffsets": STARTING_OFFSETS,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if not fail_on_data_loss:
        options["failOnDataLoss"] = "false"
    return options


def read_topic(
    spark: SparkSession,
    topic: str,
    servers: list[str] | None = None,
    fmt: str = "kafka",
    max_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
    **options: str,
) -> DataFrame:
    """Stream of messages from the earliest on.

    ``max_per_trigger`` bounds a micro-batch: messages of a broker, files of a
    directory. ``topic`` is the directory for file formats. Further options go
    to Spark's reader, such as ``minPartitions`` to split a large topic
    partition among tasks. Without ``fail_on_data_loss`` a stream goes on when messages
    are gone before it has read them; Spark does so for files in any case, and
    ``FeedWatch`` counts them or stops the query.
    """
    if fmt == "kafka":
        options = {
            **topic_options(topic, servers, max_per_trigger, fail_on_data_loss),
            **options,
        }
        return spark.readStream.format("kafka").options(**options).load()
    reader = spark.readStream.format(fmt).schema(FILE_SCHEMAS[fmt]).options(**options)
    if max_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    if not fail_on_data_loss:
        reader = reader.option("ignoreMissingFiles", "true")
    return reader.load(topic)
