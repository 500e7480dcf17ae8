"""Shared parts of the streaming operators: the run folder under the
session's checkpoint folder and the file-stream reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.session import run_folder


def run_dir(spark: SparkSession, name: str) -> str:
    return run_folder(spark, f"streams/{name}")


def file_stream(spark: SparkSession, source: str, schema: str, fmt: str, files_per_trigger: int | None,
                glob: str | None) -> DataFrame:
    """A stream over a folder of files or over one file.

    A file source takes folders or patterns; the last character of the path
    is written as a pattern, which matches a table in either shape.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        return reader.option("pathGlobFilter", glob).load(source)
    path = source.rstrip("/")
    return reader.load(path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]")
