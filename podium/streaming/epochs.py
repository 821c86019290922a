"""Epochs that run again are not written again.

A query that fails after some sinks of an epoch were written runs the whole epoch again
when it is started anew. A log beside the sink says which epoch was written last; epochs
are those of one checkpoint, whose query has an id of its own.
"""

from pyspark.sql import DataFrame, SparkSession

from podium.shared import Folder
from podium.sinks import write_topic
from podium.streaming.console import Sink

QUERY_ID = "sql.streaming.queryId"


def query_id(spark: SparkSession) -> str:
    """Id of the checkpoint whose epoch is being written; "none" outside of a stream."""
    return spark.sparkContext.getLocalProperty(QUERY_ID) or "none"


class EpochLog:
    """The last epoch that was begun and the last that was written, by query.

    Empty files ``<path>/<query id>/<begun or written>-<epoch>``. Epochs come in order, so
    the last number is enough, and older ones go.
    """

    def __init__(self, path: str):
        self.path = path

    def _last(self, spark: SparkSession, kind: str) -> int:
        names = Folder(spark, f"{self.path}/{query_id(spark)}").names()
        found = [int(n.split("-")[1]) for n in names if n.startswith(f"{kind}-")]
        return max(found, default=-1)

    def _note(self, spark: SparkSession, kind: str, epoch_id: int) -> None:
        folder = Folder(spark, f"{self.path}/{query_id(spark)}")
        folder.write(f"{kind}-{epoch_id}")
        for name in folder.names():
            if name.startswith(f"{kind}-") and int(name.split("-")[1]) < epoch_id:
                folder.delete(name)

    def is_written(self, spark: SparkSession, epoch_id: int) -> bool:
        return self._last(spark, "written") >= epoch_id

    def is_begun(self, spark: SparkSession, epoch_id: int) -> bool:
        return self._last(spark, "begun") >= epoch_id

    def begin(self, spark: SparkSession, epoch_id: int) -> None:
        self._note(spark, "begun", epoch_id)

    def written(self, spark: SparkSession, epoch_id: int) -> None:
        self._note(spark, "written", epoch_id)


def run_only(batch: DataFrame) -> None:
    """Run all tasks of a micro-batch, which saves their state, and write nothing."""
    batch.write.format("noop").mode("append").save()


def once(sink: Sink, log: str) -> Sink:
    """``sink``, left out for an epoch that the log at ``log`` says is written.

    What remains is a failure after the sink's last write and before the note, which is
    one small file: that epoch is written again. ``to_topic`` of files, ``to_jdbc`` and
    ``to_table`` close that gap by themselves.
    """
    notes = EpochLog(log)

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if notes.is_written(spark, epoch_id):
            run_only(batch)
            return
        sink(batch, epoch_id)
        notes.written(spark, epoch_id)

    return write


def append_files_once(
    messages: DataFrame, topic: str, fmt: str, epoch_id: int, log: str, **options: str
) -> None:
    """Append an epoch's messages to a directory, all of them and once.

    They are written to a hidden folder, noted as begun, and then moved file by file;
    an epoch that broke off is moved on and not written anew.
    """
    spark = messages.sparkSession
    notes, folder = EpochLog(log), Folder(spark, topic)
    stage = f"_epoch-{query_id(spark)}-{epoch_id}"
    if notes.is_written(spark, epoch_id):
        run_only(messages)
    else:
        if not notes.is_begun(spark, epoch_id):
            folder.delete(stage)
            write_topic(messages, f"{topic}/{stage}", fmt=fmt, **options)
            notes.begin(spark, epoch_id)
        else:
            run_only(messages)
        for name in folder.names(stage):
            if not name.startswith(("_", ".")):
                folder.move(f"{stage}/{name}", f"epoch-{epoch_id}-{name}")
        notes.written(spark, epoch_id)
    folder.delete(stage)
