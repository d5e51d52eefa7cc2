"""Small helpers shared by the training-data operators."""
from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: White space that separates words everywhere in this subpackage (Java regex class body).
SPACE = r"\x20\x09-\x0D"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    The optimiser may inline a projected column into every lambda that reads
    it; a lambda variable is bound once instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column) -> Column:
    """Sum of an array of integers as long; 0 when empty."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a non-null text."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def runs(batches: Iterable, key: str) -> Iterator:
    """Frames with all rows of one key, from sorted pandas batches (for ``mapInPandas``).

    Several whole keys may come in one frame, so that small groups share the
    fixed cost; a key is never split over two frames.
    """
    import pandas as pd

    held = []
    for b in batches:
        if not len(b):
            continue
        last = b[key].iloc[-1]
        if b[key].iloc[0] != last or (held and held[-1][key].iloc[-1] != last):
            cut = int((b[key].to_numpy() != last).sum())
            yield pd.concat([*held, b.iloc[:cut]], ignore_index=True)
            held = [b.iloc[cut:]]
        else:
            held.append(b)
    if held:
        yield pd.concat(held, ignore_index=True)
