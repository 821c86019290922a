"""Micro-batches on the console."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from podium.shared import checkpoint_for

Sink = Callable[[DataFrame, int], None]

# Fixed value: rows shown of an epoch.
CONSOLE_ROWS = 50


def to_console(
    rows: int = CONSOLE_ROWS, truncate: bool = False, stateful: bool = True
) -> Sink:
    """Sink that prints the first ``rows`` rows of an epoch.

    Spark's own console sink brings the whole micro-batch to the driver; this
    one brings the rows it prints. A stateful micro-batch is sorted to choose
    them: every task then runs and saves its state, which a bare ``show``
    leaves out for the tasks it does not need.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        print(f"Batch: {epoch_id}")
        if stateful:
            batch = batch.orderBy(*batch.columns)
        batch.show(rows, truncate=truncate)

    return write


def write_console(
    df: DataFrame,
    output_mode: str = "append",
    available_now: bool = False,
    rows: int = CONSOLE_ROWS,
    truncate: bool = False,
    checkpoint: str | None = None,
    stop=None,
) -> StreamingQuery:
    """Start a query that prints each micro-batch.

    ``available_now`` stops it when it has caught up; otherwise it goes on as
    fast as it can. Without ``checkpoint`` it is in the folder that the session
    names for checkpoints, or a new one in the shared folder. ``stop`` (a ``Stop``) ends
    it between two epochs.
    """
    sink = to_console(rows, truncate, stateful=output_mode != "append")
    writer = df.writeStream.outputMode(output_mode).foreachBatch(
        sink if stop is None else stop.gate(sink)
    )
    checkpoint = checkpoint_for(df.sparkSession, checkpoint, "console")
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
