"""Binary files of zstd frames, written and read by Spark's own file sources, so any file system Spark knows will do.

The text source writes the bytes of a string column as they are and a separator after each row. With an
empty skippable frame as the separator, rows that hold zstd frames make a valid zstd stream. Task
attempts are committed like those of any other Spark output.
"""

from __future__ import annotations

import struct
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.session import shared_dir

_EMPTY = 0x184D2A50  # skippable frames have the magic numbers 0x184D2A50 to 0x184D2A5F
SEPARATOR = struct.pack("<II", _EMPTY, 0)


def skippable(payload: bytes, magic: int = _EMPTY) -> bytes:
    """A skippable frame around some bytes."""
    return struct.pack("<II", magic, len(payload)) + payload


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/leadloom/{what}-{uuid.uuid4().hex}"


def write_frames(frames: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """One file for each partition that has rows, from the binary column ``value`` in its order.

    With ``rows_per_file`` a partition begins a new file after so many rows.
    """
    whole = frames.select(F.col("value").cast("string"))
    whole.write.option("lineSep", SEPARATOR.decode("ascii")).option("maxRecordsPerFile", rows_per_file).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, content) of each file; file names sort in the order of the partitions that wrote them. Files without a byte are left out."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return found.filter("length > 0").select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
