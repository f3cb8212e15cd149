"""Incremental scoring with Structured Streaming.

New observation files landing in a folder are scored as they arrive: the
same feature engineering and the same literal-coefficient projection as the
batch path, so each micro-batch is a narrow, shuffle-free map.  Progress is
kept by the streaming checkpoint, which belongs to the output folder: the file
sink's own log knows batches by number, so a run that began to count anew
would have its batches taken for ones already written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.enrich import engineer
from ..catalog import REGION_KEY
from ..operators.model import LinearModel, predict
from ..sources.observations import OBSERVATION_SCHEMA

STREAM_SCHEMA = OBSERVATION_SCHEMA + ", timestamp timestamp_ntz, month bigint"


def scored_stream(spark: SparkSession, source_dir: str, model: LinearModel,
                  schema: str = STREAM_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of scored observations read from parquet files."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return predict(model, engineer(reader.parquet(source_dir)))


def start_scoring(spark: SparkSession, source_dir: str, sink_dir: str, model: LinearModel,
                  checkpoint: str | None = None, available_now: bool = True,
                  schema: str = STREAM_SCHEMA, partition_by_region: bool = True) -> StreamingQuery:
    """Score every file in ``source_dir`` into parquet files under ``sink_dir``.

    ``available_now`` processes what is there and stops (a catch-up run);
    otherwise the query keeps running and picks up new files.  With
    ``partition_by_region`` the output has the layout of a stored predictions
    table (``state_key = lower(region)`` folders), so region lookups prune.
    The checkpoint is a hidden folder of the output unless one is given; later
    runs over the same output must use the same.
    """
    if checkpoint is None:
        checkpoint = sink_dir.rstrip("/") + "/_scoring_checkpoint"
    scored = scored_stream(spark, source_dir, model, schema)
    if partition_by_region:
        scored = scored.withColumn(REGION_KEY, F.lower(F.col("state_province")))
    writer = (scored.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if partition_by_region:
        writer = writer.partitionBy(REGION_KEY)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()
