"""Raw-frame text source: one frame per line, blank lines skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def not_blank(frames: DataFrame) -> DataFrame:
    return frames.filter(F.regexp_replace("value", r"\s", "") != "")


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    return not_blank(spark.read.option("lineSep", "\n").text(path))


def stream_frames(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.option("lineSep", "\n")  # a carriage return is a blank inside a frame
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return not_blank(reader.text(path))
