"""Whole results that come in pieces and more than once."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Epochs of a group that are told apart from repeats of them.
REMEMBERED = 16

PASSED = "epoch_id long, rows long, value string"


def first_of_each(rows: DataFrame, remembered: int = REMEMBERED) -> DataFrame:
    """The first row of each ``group`` and ``epoch_id`` of a stream.

    Columns ``group``, ``epoch_id``, ``rows`` and ``value``. The state is one row a group:
    the last ``remembered`` epochs it was seen in. Rows of epochs older than those, which
    come later, are taken for repeats.
    """

    def passed(key, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        seen = list(state.get[0]) if state.exists else []
        before = min(seen) if len(seen) == remembered else None
        for part in parts:
            fresh = []
            for epoch in part["epoch_id"].tolist():
                new = epoch not in seen and (before is None or epoch > before)
                fresh.append(new)
                if new:
                    seen.append(epoch)
            yield part.loc[fresh, ["epoch_id", "rows", "value"]]
        state.update((sorted(seen)[-remembered:],))

    return rows.groupBy("group").applyInPandasWithState(
        passed, PASSED, "seen array<long>", "append", "NoTimeout"
    )
