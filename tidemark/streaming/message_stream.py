"""Message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.routes import route_message
from tidemark.schema import TEXT_LIMIT


def dedupe_messages(messages: DataFrame, id_column: str = "message_id", time_column: str = "received_at",
                    delay: str = "10 minutes") -> DataFrame:
    """Drop replays of a message within the delay; state is bounded by the watermark."""
    return messages.withWatermark(time_column, delay).dropDuplicatesWithinWatermark([id_column])


def run_message_routes(messages: DataFrame, messages_path: str, acks_path: str, checkpoint: str,
                       limit: int = TEXT_LIMIT, with_error: bool = False, topics: str | None = None,
                       trigger: dict | None = None) -> StreamingQuery:
    """Route a stream of messages; acknowledgements are a second output of the same batch.

    Both outputs are folders per batch, overwritten when a batch is retried, so
    each message is there once.  The routed batch is written first and the
    acknowledgements are read back from it: no message is acknowledged before
    it is stored, and the source is read once.
    """
    routed = route_message(messages, limit, with_error, topics)

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = f"{messages_path}/batch_id={batch_id}"
        batch.write.mode("overwrite").partitionBy("route").parquet(target)
        stored = spark.read.schema(batch.schema).parquet(target)
        (stored.where(F.col("ack").isNotNull()).select("message_id", "remote_address", "ack")
         .write.mode("overwrite").parquet(f"{acks_path}/batch_id={batch_id}"))

    return (routed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
