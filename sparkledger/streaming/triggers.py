"""Work done as rows arrive: child rows for updated parents, and the state of a queue."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkledger.plans.hygiene import backfill_children


def backfill_on_update(
    updates: DataFrame, child_path: str, checkpoint: str, key: str, kind_column: str, kind: int, defaults: dict,
    trigger: dict | None = None,
) -> StreamingQuery:
    """For each batch of updated parents, append a default child row to those that lack one.

    The whole batch is handled as a set. Each batch writes to its own folder in overwrite mode, so a batch
    that is repeated after a failure leaves the same rows. The folder names the checkpoint as well as the
    batch: batches of another checkpoint are numbered from 0 again and must not take the place of these.
    `trigger` holds the arguments of `DataStreamWriter.trigger`; by default, what is available is handled once.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def add_children(batch: DataFrame, batch_id: int) -> None:
        own = f"run={run}/batch={batch_id}"
        child = batch.sparkSession.read.option("basePath", child_path).option("recursiveFileLookup", "true").parquet(child_path)
        # A repeated batch must not see its own first attempt.
        child = child.where(~F.col("_metadata.file_path").contains(f"/{own}/"))
        rows = backfill_children(batch, child, key, kind_column, kind, defaults)
        rows.write.mode("overwrite").parquet(f"{child_path}/{own}")

    return (
        updates.writeStream.foreachBatch(add_children)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def backlog_by_state(queue: DataFrame, ts: str, state: str, delay: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Rows per state and hour of a streaming queue; late rows count until the watermark passes."""
    return (
        queue.withWatermark(ts, delay)
        .groupBy(F.window(ts, window), state)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.col("window.start").alias("window_start"), state, "n_rows")
    )
