"""The row-wise and windowed operators on a stream.

What was learned from a batch is applied to new rows as they come (cleaning values, scale,
encodings); duplicates are removed within a bound on lateness; run rows are counted per window.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flatspan.operators import clean, features, history
from flatspan.session import new_stage_path


def read_folder(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet") -> DataFrame:
    """New parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def clean_stream(stream: DataFrame, model: clean.CleaningModel) -> DataFrame:
    """Cleaning with learned values: stateless, so no lateness bound is needed."""
    return clean.apply_cleaning(stream, model)


def feature_stream(stream: DataFrame, model: features.FeatureModel) -> DataFrame:
    """The feature step with learned state.  Frequency tables are static sides of LEFT joins."""
    return features.apply_features(stream, model)


def drop_late_duplicates(stream: DataFrame, keys: list[str], time: str, lateness: str) -> DataFrame:
    """First row per key; state is kept for the lateness bound only."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def health_stream(runs: DataFrame, window: str, lateness: str, time: str = "started_at") -> DataFrame:
    """Run counts per window and step; a window comes out once no row for it can come any more."""
    return history.run_health(runs.withWatermark(time, lateness), window, time)


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Process what is there now into a table under the shared folder, and read the table."""
    spark = stream.sparkSession
    path = new_stage_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", os.path.join(path, "data"))
        .option("checkpointLocation", os.path.join(path, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(os.path.join(path, "data"))
