"""The escape hatches of the UDF surface.

``pipe`` chains table functions (``df.transform``).  ``map_batches`` runs a
pandas function over Arrow batches of each partition (``mapInPandas``) — for
per-row logic no built-in expression covers; Spark still partitions and
schedules the work, and nothing is gathered on the driver.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame


def pipe(df: DataFrame, *steps) -> DataFrame:
    """Apply table functions in order; a step is ``f`` or ``(f, *args)``."""
    for st in steps:
        f, args = (st[0], st[1:]) if isinstance(st, tuple) else (st, ())
        df = df.transform(f, *args)
    return df


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Apply ``fn(pandas.DataFrame) -> pandas.DataFrame`` to every Arrow batch."""
    def run(batches: Iterator):
        for b in batches:
            yield fn(b)
    return df.mapInPandas(run, schema)
