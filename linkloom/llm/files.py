"""Files of an operator's own format in the shared folder: written whole by tasks, read back by Spark."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def put(directory: str, name: str, content: bytes) -> str:
    """Write one file; it appears under its name only when whole, and a retried task replaces it."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(directory)
    store.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(content)
    store.move(part, f"{path}/{name}")
    return name


def contents(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """path, content of the files of a folder, by Spark's own reader."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory).select("path", "content")
