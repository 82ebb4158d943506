"""The cleaning operators on a Structured Streaming source.

The reference processes its interaction table in batch only; nothing here
adds an operator. Because the operators are DataFrame -> DataFrame functions,
the same block-list exclusion (a stream-static anti join, stateless) and the
same per-user / per-item activity aggregates (stateful, kept by the streaming
engine in its checkpointed state store) run on files that keep arriving.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from encore.operators import activity, joins
from encore.session import scratch_path


def read_interaction_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files appearing under ``path`` as an unbounded table."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def cleaned_activity_stream(
    interactions: DataFrame, blocked: DataFrame, user: str = "user_id", item: str = "song_id", plays: str = "plays"
) -> DataFrame:
    """Per-user activity over the stream, after removing blocked items."""
    kept = joins.exclude(interactions, blocked, item)
    return activity.user_activity(kept, user, item, plays)


def start_activity_query(
    activity_stream: DataFrame, sink, checkpoint: str | None = None, output_mode: str = "update"
) -> StreamingQuery:
    """Start the aggregate with ``sink(batch_df, batch_id)`` per micro-batch.

    ``checkpoint`` defaults to a fresh folder under the shared checkpoint
    directory, so state and progress survive a restart of the driver.
    """
    spark = activity_stream.sparkSession
    location = checkpoint or scratch_path(spark, "stream-activity")
    return (
        activity_stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", location)
        .foreachBatch(sink)
        .start()
    )
