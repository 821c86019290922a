"""One micro-batch to several sinks.

A sink is a function of the micro-batch and its epoch number. An epoch that fails midway
runs again after a restart. Sinks that keep a log (``log=``) and ``to_table`` then write
what is missing only; the others write the epoch again.
"""

import logging
import re
import uuid
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions.codec import encode_json
from podium.shared import Folder
from podium.sinks import write_jdbc, write_topic
from podium.sources import read_jdbc
from podium.streaming.console import Sink
from podium.streaming.epochs import EpochLog, append_files_once, once, query_id, run_only

log = logging.getLogger(__name__)

# Messages of a file, where the rows of an epoch are counted before they are written.
FILE_ROWS = 1 << 17

# Beside the epochs of a table: the query that writes them.
OWNER = "_query"


def fan_out(*sinks: Sink, together: bool = False) -> Sink:
    """Write each micro-batch to every sink, for ``foreachBatch``.

    In order, or ``together``: as jobs at the same time, of which the first error cancels
    the others. With more than one sink the micro-batch is kept while it is written, so it
    is computed once. An error is logged and raised, which stops the query.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        kept = len(sinks) > 1
        if kept:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if kept and together:
                _write_together(sinks, batch, epoch_id)
            else:
                for sink in sinks:
                    sink(batch, epoch_id)
        except Exception:
            log.exception("epoch %s failed", epoch_id)
            raise
        finally:
            if kept:
                batch.unpersist()

    return write


def _write_together(sinks: tuple[Sink, ...], batch: DataFrame, epoch_id: int) -> None:
    """Each sink in a thread of its own, with the query's properties.

    The micro-batch is computed first: two jobs that find it missing would both run its
    tasks, and each task saves state once.
    """
    spark, tag = batch.sparkSession, f"podium-{uuid.uuid4().hex}"
    run_only(batch)

    def write(sink: Sink) -> None:
        spark.sparkContext.addJobTag(tag)
        sink(batch, epoch_id)

    with ThreadPoolExecutor(len(sinks)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write), s) for s in sinks]
        done, _ = wait(running, return_when=FIRST_EXCEPTION)
        failed = [f.exception() for f in done if f.exception() is not None]
        while failed and wait(running, timeout=0.2).not_done:
            spark.sparkContext.cancelJobsWithTag(tag)  # those submitted since, too
    if failed:
        raise failed[0]


def _with_epoch(
    batch: DataFrame, epoch_id: int, column: str | None, query_column: str | None = None
) -> DataFrame:
    if query_column is not None:
        batch = batch.withColumn(query_column, F.lit(query_id(batch.sparkSession)))
    return batch if column is None else batch.withColumn(column, F.lit(epoch_id).cast("long"))


def to_topic(
    topic: str,
    servers: list[str] | None = None,
    fmt: str = "kafka",
    json_options: dict[str, str] | None = None,
    epoch_column: str | None = None,
    rows_column: str | None = None,
    log: str | None = None,
    **options: str,
) -> Sink:
    """Publish the rows as JSON messages.

    ``epoch_column`` adds the number of the epoch under that name and ``rows_column`` its
    number of rows, by which a reader can tell the whole results apart, knows when one is
    complete and drops one that was sent twice. An epoch that is counted is kept for that,
    so it is computed once, and goes to as few files as its rows need: a reader that takes
    so many files at a time is not held up by one for each task. ``log`` is a folder that
    notes the epochs written: one that runs again is left out. Files then come once
    whatever fails; to a broker an epoch goes again if the failure comes before the note.
    Further options go to Spark's writer, such as a broker's security protocol.
    """

    def send(rows: DataFrame, epoch_id: int) -> None:
        messages = encode_json(rows, json_options)
        if log is not None and fmt != "kafka":
            append_files_once(messages, topic, fmt, epoch_id, log, **options)
        else:
            write_topic(messages, topic, servers, fmt, **options)

    def write(batch: DataFrame, epoch_id: int) -> None:
        if rows_column is None:
            send(_with_epoch(batch, epoch_id, epoch_column), epoch_id)
            return
        keep = batch.storageLevel == StorageLevel.NONE  # else ``fan_out`` keeps it
        if keep:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = batch.count()
            rows = batch if fmt == "kafka" else batch.coalesce(n // FILE_ROWS + 1)
            rows = _with_epoch(rows, epoch_id, epoch_column)
            send(rows.withColumn(rows_column, F.lit(n).cast("long")), epoch_id)
        finally:
            if keep:
                batch.unpersist()

    return once(write, log) if log is not None and fmt == "kafka" else write


def to_jdbc(
    url: str,
    table: str,
    epoch_column: str | None = None,
    query_column: str | None = None,
    log: str | None = None,
    **access: str,
) -> Sink:
    """Append to a database table, with the arguments of ``write_jdbc``.

    ``epoch_column`` as for ``to_topic``; ``query_column`` adds the id of the query, for a
    table that several queries append to. ``log`` is a folder that notes the epochs
    written. An epoch that was begun and not noted is looked for in the table by its
    number, and each goes over one connection, that is in one transaction: so it is there
    once, whatever fails. That needs the ``epoch_column``.
    """
    if log is not None and epoch_column is None:
        raise ValueError("an epoch can be looked for by its epoch_column only")
    notes = EpochLog(log) if log is not None else None

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        rows = _with_epoch(batch, epoch_id, epoch_column, query_column)
        if notes is None:
            write_jdbc(rows, url, table, **access)
            return
        if notes.is_written(spark, epoch_id):
            run_only(batch)
            return
        if notes.is_begun(spark, epoch_id) and there(rows, epoch_id):
            run_only(batch)
        else:
            notes.begin(spark, epoch_id)
            write_jdbc(rows, url, table, **{**access, "num_partitions": 1})
        notes.written(spark, epoch_id)

    def there(rows: DataFrame, epoch_id: int) -> bool:
        spark = rows.sparkSession
        write_jdbc(rows.limit(0), url, table, **{**access, "num_partitions": 1})  # makes the table
        mine = f"{epoch_column} = {epoch_id}"
        if query_column is not None:
            mine += f" and {query_column} = '{query_id(spark)}'"
        asked = f"(select count(*) as n from {table} where {mine}) epoch"
        reading = {k: v for k, v in access.items() if k in ("driver", "user", "password")}
        return read_jdbc(spark, url, asked, **reading, partition_column=None).first()[0] > 0

    return write


def to_table(path: str, snapshot: str = "append") -> Sink:
    """Write each epoch to a folder ``epoch_id=<n>`` of a Parquet table at ``path``.

    ``"append"`` keeps all epochs. ``"replace"`` keeps the latest: older ones go
    once it is complete, so there is one to read at any time (with
    ``latest_snapshot``). An epoch that runs again replaces itself. Epochs are
    numbered by the checkpoint, whose query is noted beside them: a table with epochs of
    another checkpoint is refused.
    """
    if snapshot not in ("append", "replace"):
        raise ValueError("snapshot is 'append' or 'replace'")
    return partial(_write_epoch, path=path, snapshot=snapshot)


def own(spark: SparkSession, path: str, epoch_id: int) -> None:
    """Note whose epochs lie at ``path``; an error if they are another query's."""
    folder, me = Folder(spark, path), query_id(spark)
    if folder.exists(OWNER):
        known = folder.read(OWNER) == me
    else:  # one that was written before queries were noted, or nothing yet
        known = epoch_id > 0 or not epochs(spark, path)
    if not known:
        raise ValueError(f"{path} has epochs of another checkpoint; use a new table")
    if not folder.exists(OWNER):
        folder.write(OWNER, me)


def _write_epoch(batch: DataFrame, epoch_id: int, path: str, snapshot: str) -> None:
    spark = batch.sparkSession
    own(spark, path, epoch_id)
    if epoch_id == 0 and any(n > 0 for n in epochs(spark, path)):
        raise ValueError(f"{path} has epochs of another checkpoint; use a new table")
    batch.write.mode("overwrite").parquet(f"{path}/epoch_id={epoch_id}")
    if snapshot == "replace":
        drop_epochs(spark, path, epoch_id)


def drop_epochs(spark: SparkSession, path: str, before: int) -> None:
    """Remove the complete epochs below ``before``."""
    for n in epochs(spark, path):
        if n < before:
            Folder(spark, path).delete(f"epoch_id={n}")


def epochs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete epochs, by the names of folders alone."""
    folder = Folder(spark, path)
    found = [int(n[9:]) for n in folder.names() if re.fullmatch(r"epoch_id=\d+", n)]
    return sorted(n for n in found if folder.exists(f"epoch_id={n}/_SUCCESS"))


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the last complete epoch of a table that ``to_table`` writes."""
    found = epochs(spark, path)
    if not found:
        raise ValueError(f"{path} has no complete epoch")
    return spark.read.parquet(f"{path}/epoch_id={found[-1]}")
