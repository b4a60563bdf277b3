"""Binary records written by Spark's text sink and read by its binary-file source.

The text sink writes a string column byte for byte, each row followed by
``lineSep``. A binary column cast to string so becomes a file of raw records on
any file system that Spark writes to, under Spark's commit protocol: attempts
that fail or run twice leave nothing behind. ``records`` bounds a file's rows,
and so its bytes, for the reader holds one file at a time. Files sort by name in
the order of partitions and rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_records(df: DataFrame, column: str, path: str, end: str, records: int, compression: str = "none") -> None:
    (df.select(F.col(column).cast("string").alias("value")).write.option("lineSep", end).option("compression", compression)
     .option("maxRecordsPerFile", records).text(path))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """path, content: one row per file, without Spark's marker files."""
    return spark.read.format("binaryFile").load(path).select("path", "content").where(F.length("content") > 0)
