"""Working folders that every executor can reach."""

import atexit
import re
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without the setting: driver and executors are
    one process there, so a temporary folder of the machine is shared too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    # One process: "local", "local[4]"; but "local-cluster[...]" starts others.
    if not re.match(r"local($|\[)", spark.conf.get("spark.master", "")):
        raise ValueError(
            "set spark.checkpoint.dir to a folder that all executors share"
        )
    return tempfile.mkdtemp(prefix="podium-")


def checkpoint_for(spark: SparkSession, given: str | None, purpose: str) -> str | None:
    """Where a query that was given no checkpoint keeps it.

    ``None`` if the session names a folder for that, in which Spark makes one.
    Spark's own choice otherwise would be a temporary folder of the driver.
    """
    if given is not None:
        return given
    if spark.conf.get("spark.sql.streaming.checkpointLocation", None):
        return None
    return working_dir(spark, purpose)


def working_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name for one run; the writer makes the folder."""
    return f"{shared_root(spark)}/podium/{purpose}-{uuid.uuid4().hex}"


class Folder:
    """A folder of any store, as Hadoop sees it; names are relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self._at("").getFileSystem(conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._files.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """What lies in it, in order; nothing if it is not there."""
        if not self.exists(name):
            return []
        return sorted(f.getPath().getName() for f in self._files.listStatus(self._at(name)))

    def read(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str = "") -> None:
        """A small file, there as a whole or not at all; replaces one of the name."""
        *parents, last = name.split("/")
        hidden = "/".join([*parents, f"_{last}.{uuid.uuid4().hex}"])
        stream = self._files.create(self._at(hidden), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        self.delete(name)
        self.move(hidden, name)

    def move(self, name: str, to: str) -> None:
        if not self._files.rename(self._at(name), self._at(to)):
            raise OSError(f"{self.path}: {name} cannot be moved to {to}")

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)


def removed_at_exit(spark: SparkSession, path: str, table: str | None = None) -> None:
    """Remove what only this program's results read, once it ends.

    ``path`` is a folder and ``table`` a name of the catalog. Nothing happens if the
    session was stopped before.
    """
    atexit.register(remove, spark, path, table)


def remove(spark: SparkSession, path: str, table: str | None = None) -> None:
    if SparkContext._active_spark_context is None:
        return
    if table is not None:
        spark.sql(f"drop table if exists {table}")
    Folder(spark, path).delete("")
