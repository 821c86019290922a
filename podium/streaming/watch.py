"""What a stream has read, and what was gone before it could be read."""

import ast
import json
import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from podium.shared import Folder


class DataLoss(Exception):
    """Files of a feed were gone before they were read."""


class FeedWatch(StreamingQueryListener):
    """Counts, over the epochs of one query, messages read and lost.

    ``read`` are messages. Of a broker's topic ``lost`` are the messages between an epoch's
    first and last offsets that did not come (compacted topics and transactions leave gaps
    of their own, which count too). Of a directory ``missing`` are files that an epoch was
    to read and that are gone when it ends; what they held is not known. ``checkpoint`` is
    where their names are; a directory needs it.

    Spark reads on when a directory's file is gone, whatever it is told. With
    ``fail_on_data_loss`` the query is stopped after such an epoch, and leaving the block
    is an error. A broker's topic has that from Spark (``read_topic``).

    >>> with FeedWatch(spark, query, checkpoint) as watch: query.awaitTermination()
    """

    def __init__(
        self,
        spark: SparkSession,
        query: StreamingQuery,
        checkpoint: str | None = None,
        fail_on_data_loss: bool = False,
    ):
        self._spark, self._id, self._checkpoint = spark, str(query.id), checkpoint
        self._fail = fail_on_data_loss
        self._query = query
        self._seen: set[int] = set()
        self._lock = threading.Lock()
        self.read = self.lost = 0
        self.missing: list[str] = []

    def __enter__(self) -> "FeedWatch":
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, kind: type | None, *_: object) -> None:
        """Epochs whose report is still on its way are taken from the query itself."""
        self._spark.streams.removeListener(self)
        for progress in self._query.recentProgress:
            self.add(progress)
        if self._fail and self.missing and kind is None:
            raise DataLoss(f"{len(self.missing)} files were gone, the first {self.missing[0]}")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self._id:
            self.add(event.progress)
            if self._fail and self.missing:
                self._query.stop()

    def add(self, progress) -> None:
        """Count an epoch, once."""
        with self._lock:
            if progress.batchId in self._seen or not progress.numInputRows + self._news(progress):
                return
            self._seen.add(progress.batchId)
            for i, source in enumerate(progress.sources):
                self.read += source.numInputRows
                start, end = _offsets(source.startOffset), _offsets(source.endOffset)
                if "logOffset" in end:
                    files = self._files(i, start.get("logOffset", -1), end["logOffset"])
                    self.missing += [f for f in files if not self._exists(f)]
                else:
                    self.lost += max(0, _between(start, end) - source.numInputRows)

    @staticmethod
    def _news(progress) -> bool:
        return any(s.startOffset != s.endOffset for s in progress.sources)

    def _files(self, source: int, after: int, last: int) -> list[str]:
        """Files that the checkpoint's log lists for the offsets from ``after`` on."""
        if self._checkpoint is None:
            return []
        folder = Folder(self._spark, f"{self._checkpoint}/sources/{source}")
        found = {}
        for name in folder.names():
            number = name.removesuffix(".compact")
            if not number.isdigit() or int(number) <= after:
                continue
            for line in folder.read(name).splitlines()[1:]:
                entry = json.loads(line)
                if after < entry["batchId"] <= last:
                    found[entry["path"]] = None
        return list(found)

    def _exists(self, file: str) -> bool:
        folder, name = file.rsplit("/", 1)
        return Folder(self._spark, folder).exists(name)


def _offsets(value: str | None) -> dict:
    """Offsets as a listener gets them, in JSON, or as a query's progress has them in Python."""
    if not value or value == "None":
        return {}
    try:
        found = json.loads(value)
    except ValueError:
        found = ast.literal_eval(value)
    return found if isinstance(found, dict) else {}


def _between(start: dict, end: dict) -> int:
    """Messages between the offsets of a topic's partitions, of those known at the start."""
    return sum(
        last - start.get(topic, {}).get(part, last)
        for topic, parts in end.items()
        for part, last in parts.items()
    )
