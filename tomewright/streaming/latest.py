"""Latest row of each key from an append-only stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tomewright.operators.dedupe import latest_by


def keep_latest(stream: DataFrame, keys: list[str], order: list[str], checkpoint: str, target: str) -> StreamingQuery:
    """Each batch is folded into the newest table version below `target`; a replayed batch writes the same version again."""

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if number:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(f"{target}/v{number - 1}"))
        latest_by(rows, keys, order).write.mode("overwrite").parquet(f"{target}/v{number}")

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
