"""Publish a table, enrich it as a stream, and read the outcome."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from podium.functions.codec import decode_json, encode_json, unwrap_json
from podium.operators.enrich import GROUP, add_sums, average_sums, avg_stats, sum_stats
from podium.schemas import ENRICHED_AVG, EVENT_RESULTS
from podium.shared import Folder, checkpoint_for
from podium.sinks import preview, write_topic
from podium.streaming.console import CONSOLE_ROWS, Sink, to_console, write_console
from podium.streaming.fanout import (
    drop_epochs,
    epochs,
    fan_out,
    latest_snapshot,
    own,
    to_table,
)
from podium.streaming.stop import Stop
from podium.streaming.whole import REMEMBERED, first_of_each


def publish_table(
    df: DataFrame,
    topic: str,
    servers: list[str] | None = None,
    fmt: str = "kafka",
    preview_rows: int = 0,
    json_options: dict[str, str] | None = None,
    **options: str,
) -> None:
    """Append every row to a topic as a JSON message."""
    if preview_rows:
        preview(df, preview_rows)
    write_topic(encode_json(df, json_options), topic, servers, fmt, **options)


def enrich_stream(
    messages: DataFrame,
    bio: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    schema: StructType = EVENT_RESULTS,
    unwrap: bool = False,
    country_from: str = "bio",
    drop_missing: bool = True,
    available_now: bool = False,
    console: bool = False,
    console_rows: int = CONSOLE_ROWS,
    together: bool = False,
    stop: Stop | None = None,
    **options,
) -> StreamingQuery:
    """Decode result messages, join biographies, keep the averages up to date.

    Each epoch gives the whole result to every sink, to one after the other or
    ``together``. ``console`` prints it as well, as one more sink of the same query, so
    that the topic is read once and the state kept once. ``stop`` ends the query between
    two epochs; wait for it with ``stop.wait``. ``options`` go to ``avg_stats``.

    Start again on the same ``checkpoint`` to go on where the query stopped.
    The number of shuffle partitions at the first start stays with it.
    """
    fields = ["athlete_id", "sport", "medal"]
    if country_from == "event":
        fields.append("country_noc")
    results = decode_json(messages, schema, fields, unwrap)
    # Beside what Spark keeps there: a new start puts its sums in place of the old.
    static_dir = f"{checkpoint.rstrip('/')}/static"
    stats = avg_stats(
        results, bio, country_from, drop_missing, **{"static_dir": static_dir, **options}
    )
    if console:
        sinks = [to_console(console_rows), *sinks]
    if not sinks:
        raise ValueError("a stream that keeps state needs a sink that reads it")
    return _started(
        stats.writeStream.outputMode("complete"),
        fan_out(*sinks, together=together),
        checkpoint,
        available_now,
        stop,
    )


def enrich_epochs(
    messages: DataFrame,
    read_bio: Callable[[], DataFrame],
    sinks: Sequence[Sink],
    checkpoint: str,
    schema: StructType = EVENT_RESULTS,
    unwrap: bool = False,
    country_from: str = "bio",
    drop_missing: bool = True,
    available_now: bool = False,
    together: bool = False,
    stop: Stop | None = None,
    **options,
) -> StreamingQuery:
    """``enrich_stream`` with the biographies asked for anew in each epoch.

    ``read_bio`` gives them: a table of a database is then read in ranges of the keys it
    has at that time, and what is broadcast is measured at that time. An epoch is a batch
    to Spark, so AQE plans its joins. The sums so far are a table beside the checkpoint, a
    row a group: an epoch adds its own to those of the epoch before, and has the same
    outcome when it runs again. Results meet the biographies of their epoch. ``options``
    go to ``sum_stats``.
    """
    if not sinks:
        raise ValueError("a stream needs a sink")
    fields = ["athlete_id", "sport", "medal"]
    if country_from == "event":
        fields.append("country_noc")
    sums = f"{checkpoint.rstrip('/')}/sums"
    keep, write = to_table(sums), fan_out(*sinks, together=together)

    def update(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [n for n in epochs(spark, sums) if n < epoch_id]
        results = decode_json(batch, schema, fields, unwrap).persist()
        try:
            added = sum_stats(results, read_bio(), country_from, drop_missing, **options)
            if earlier:
                added = added.unionByName(spark.read.parquet(f"{sums}/epoch_id={earlier[-1]}"))
            keep(add_sums(added), epoch_id)
        finally:
            results.unpersist()
        write(average_sums(spark.read.parquet(f"{sums}/epoch_id={epoch_id}")), epoch_id)
        if earlier:  # needed until this epoch is in the checkpoint
            drop_epochs(spark, sums, earlier[-1])

    return _started(messages.writeStream, update, checkpoint, available_now, stop)


def _started(
    writer: DataStreamWriter, write: Sink, checkpoint: str, available_now: bool, stop: Stop | None
) -> StreamingQuery:
    writer = writer.foreachBatch(write if stop is None else stop.gate(write))
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def consume_topic(
    messages: DataFrame,
    schema: StructType = ENRICHED_AVG,
    unwrap: bool = False,
    path: str | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
    json_options: dict[str, str] | None = None,
    stop: Stop | None = None,
) -> StreamingQuery:
    """Decode messages, each once, to the console or to Parquet at ``path``.

    A message that does not parse is a row of nulls. Stops when it has caught
    up, unless told otherwise. Without ``checkpoint`` it is in the folder that the
    session names for checkpoints, or a new one in the shared folder.
    """
    rows = decode_json(messages, schema, unwrap=unwrap, options=json_options)
    if path is None:
        return write_console(
            rows, available_now=available_now, checkpoint=checkpoint, stop=stop
        )
    writer = rows.writeStream.outputMode("append").format("parquet")
    checkpoint = checkpoint_for(rows.sparkSession, checkpoint, "consumer")
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def consume_epochs(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    schema: StructType = ENRICHED_AVG,
    keys: Sequence[str] = GROUP,
    epoch_column: str = "epoch_id",
    rows_column: str = "epoch_rows",
    unwrap: bool = False,
    available_now: bool = True,
    json_options: dict[str, str] | None = None,
    remembered: int = REMEMBERED,
    stop: Stop | None = None,
) -> StreamingQuery:
    """Put whole results together again that ``to_topic`` published, and keep the last.

    Each epoch of such a topic holds all groups, told by ``keys``. Micro-batches cut
    epochs anywhere, an epoch may come twice, and the last may be broken off. Spark keeps,
    for each group, which of the last ``remembered`` epochs it has seen, and lets the first
    of each pass. An epoch is complete once it has as many rows as its messages say; epochs
    before the last complete one go. ``last_epoch`` reads it. Messages that do not parse
    or belong to no epoch are left out.
    """
    numbers = [StructField(epoch_column, LongType()), StructField(rows_column, LongType())]
    text = unwrap_json(F.col("value")) if unwrap else F.col("value").cast("string")
    texts = messages.select(text.alias("value"))
    told = StructType([*(schema[k] for k in keys), *numbers])
    parsed = texts.withColumn("told", F.from_json("value", told, json_options))
    rows = parsed.select(
        F.to_json(F.struct(*(F.col("told")[k].alias(k) for k in keys))).alias("group"),
        F.col("told")[epoch_column].alias("epoch_id"),
        F.col("told")[rows_column].alias("rows"),
        "value",
    ).filter("epoch_id is not null and rows is not null")
    whole = StructType([f for f in schema if f.name not in (epoch_column, rows_column)])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own(spark, path, batch_id)
        last = max(epochs(spark, path), default=-1)
        batch = batch.persist()
        try:
            # A number of rows for each epoch that has messages in this micro-batch.
            met = batch.groupBy("epoch_id").agg(F.max("rows").alias("rows")).collect()
            data = F.from_json("value", whole, json_options)
            (
                batch.filter(F.col("epoch_id") > last)
                .select("epoch_id", F.lit(batch_id).alias("batch"), F.inline(F.array(data)))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("epoch_id", "batch")
                .parquet(path)
            )
        finally:
            batch.unpersist()
        folder = Folder(spark, path)
        for row in sorted(met, key=lambda r: r["epoch_id"]):
            at = f"epoch_id={row['epoch_id']}"
            if folder.exists(at) and spark.read.parquet(f"{path}/{at}").count() >= row["rows"]:
                folder.write(f"{at}/_SUCCESS")
        last = max(epochs(spark, path), default=-1)
        for name in folder.names():
            if name.startswith("epoch_id=") and int(name[9:]) < last:
                folder.delete(name)

    return _started(
        first_of_each(rows, remembered).writeStream.outputMode("append"),
        write,
        checkpoint,
        available_now,
        stop,
    )


def last_epoch(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the last complete epoch that ``consume_epochs`` has put together."""
    return latest_snapshot(spark, path).drop("batch")
