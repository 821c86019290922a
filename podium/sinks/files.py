"""Parquet layers, and a look at a table."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from podium.sources.files import layer_path, read_layer


def write_layer(
    df: DataFrame, root: str, layer: str, table: str, verify: bool | str = False
) -> DataFrame:
    """Overwrite a table of a layer and give it back as read from the files.

    ``verify`` compares what is read back to what was written, in columns and
    number of rows. The rows are counted while they are written, so ``df`` is
    evaluated once, and the count of the files comes from their footers.
    ``verify="content"`` also compares a checksum over all values, which does not depend
    on the order of rows: it is taken while writing, and the files are read once more.
    """
    if verify not in (True, False, "content"):
        raise ValueError("verify is True, False or 'content'")
    path = layer_path(root, layer, table)
    written = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    if verify == "content":
        measures.append(checksum(df).alias("content"))
    if verify:
        columns = _columns(df)
        df = df.observe(written, *measures)
    df.write.mode("overwrite").parquet(path)
    back = read_layer(df.sparkSession, root, layer, table)
    if verify:
        if _columns(back) != columns:
            raise ValueError(f"{path}: columns differ from those written")
        if verify == "content":
            found = back.agg(F.count(F.lit(1)).alias("rows"), checksum(back).alias("content")).first()
        else:
            found = {"rows": back.count()}
        if found["rows"] != written.get["rows"]:
            raise ValueError(f"{path}: number of rows differs from that written")
        if verify == "content" and found["content"] != written.get["content"]:
            raise ValueError(f"{path}: values differ from those written")
    return back


def checksum(df: DataFrame) -> Column:
    """Sum of the rows' 64-bit hashes: equal for equal rows in any order.

    Repeated rows count each. A null is told from a value and by its column. Maps are
    hashed by their sorted entries.
    """
    values = []
    for f in df.schema.fields:
        value = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, MapType):
            value = F.array_sort(F.map_entries(value))
        values += [value, value.isNull()]
    hashed = F.xxhash64(*values) if values else F.lit(0)
    return F.coalesce(F.sum(hashed.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def preview(df: DataFrame, rows: int = 20, truncate: bool = False) -> None:
    """Print the first rows."""
    df.show(rows, truncate=truncate)
