"""The row-wise stages over a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lekha.operators import curate


def raw_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """JSON-line snapshots as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def clean_stream(raw: DataFrame) -> DataFrame:
    """Normalised and filtered records; the stages keep no state, so batch and stream give the same rows."""
    return raw.transform(curate.normalized_rows).transform(curate.clean_rows)


def write_clean(stream: DataFrame, path: str, checkpoint: str):
    """Exactly-once Parquet sink, one folder per source, for the data that is there now."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("source_name").trigger(availableNow=True).start()
