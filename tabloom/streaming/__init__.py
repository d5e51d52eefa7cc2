"""Apply batch feature operators to a stream, one micro-batch at a time."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def run_per_batch(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str,
                  checkpoint: str, fmt: str = "parquet", trigger_once: bool = True):
    """``foreachBatch`` sink: ``transform`` each micro-batch and write it under ``path``.

    The streaming checkpoint must live in shared storage; a replayed batch
    overwrites its own folder (``batch_id=...``), so it is never counted twice.
    """
    def write(batch: DataFrame, batch_id: int):
        out = transform(batch)
        out.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
