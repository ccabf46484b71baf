"""Hand-over to client frames."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame

from ..functions.casts import decimals_to_double


def report_frames(df: DataFrame, rows: int = 50_000) -> Iterator:
    """pandas frames of at most ``rows`` rows, decimals as floats, together the whole result.

    Partitions come one after the other, so the client holds one at a time whatever the size; an empty
    result gives one empty frame.
    """
    import pandas as pd

    out = decimals_to_double(df)
    fetched, first = out.toLocalIterator(prefetchPartitions=True), True
    while (part := list(islice(fetched, rows))) or first:
        first = False
        yield pd.DataFrame.from_records([tuple(r) for r in part], columns=out.columns)
