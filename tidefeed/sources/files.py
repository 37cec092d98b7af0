"""Change tables kept as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidefeed.operators.changes import SOURCE_FILE


def _with_file(changes: DataFrame) -> DataFrame:
    return changes.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def read_changes(
    spark: SparkSession,
    path: str | list[str],
    file_format: str = "parquet",
    schema: StructType | None = None,
    with_file: bool = False,
) -> DataFrame:
    """A change table as a batch DataFrame; ``with_file`` adds the file each change is from."""
    reader = spark.read.format(file_format)
    changes = (reader if schema is None else reader.schema(schema)).load(path)
    return _with_file(changes) if with_file else changes


def stream_changes(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    file_format: str = "parquet",
    max_files: int | None = None,
    max_bytes: str | None = None,
    with_file: bool = False,
) -> DataFrame:
    """A change table as a stream of its files, in order of arrival.

    Without a schema, the files that are there give it. ``max_files`` or ``max_bytes`` (such as
    ``"200g"``) bound a batch. One that is a single file is named inside braces, as in
    ``.../{orders.parquet}``: a stream takes a folder or a pattern. ``with_file`` adds the file
    each change is from, which ``start_feed`` needs to complete positions by itself.
    """
    if schema is None:
        schema = read_changes(spark, path, file_format).schema
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return _with_file(reader.load(path)) if with_file else reader.load(path)
