"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(column: Column) -> Column:
    """Lower case without outer spaces. Tabs and other white space stay."""
    return F.trim(F.lower(column))
