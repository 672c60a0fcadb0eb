"""Looking at input paths, and the position columns that fix the load order."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Where a row came from: rank of the loader, rank of the file, byte offset of the
# split, and a counter that grows inside the split.
POSITION = ("seq_source", "seq_part", "seq_block", "seq_row")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def children(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Names directly below a folder; [] when it does not exist."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(hadoop_path))
    return sorted(name for name in names if name.endswith(suffix) and not name.startswith("."))


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def file_uri(spark: SparkSession, path: str) -> str | None:
    """The full name of a file, None for a folder or a pattern."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return None
    status = fs.getFileStatus(hadoop_path)
    return status.getPath().toString() if status.isFile() else None


def first_bytes(spark: SparkSession, path: str, most: int, by_line: Callable[[bytes], bool]) -> bytes:
    """A file's first line, at most `most` bytes; where `by_line` of its first two bytes is false, that many bytes."""
    fs, hadoop_path = _fs(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    stream = fs.open(hadoop_path)
    try:
        begin = bytes(stream.readNBytes(2))
        if not by_line(begin):
            return begin + bytes(stream.readNBytes(most))
        stream.seek(0)
        line = hadoop.io.Text()
        hadoop.util.LineReader(stream).readLine(line, most, most)
        # An empty first line is not an empty file.
        return bytes(line.copyBytes()) or begin
    finally:
        stream.close()


def read_small(spark: SparkSession, path: str) -> str:
    """The whole of a small text file."""
    fs, hadoop_path = _fs(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file; it appears complete, under its name, by one rename."""
    fs, hadoop_path = _fs(spark, path)
    if fs.exists(hadoop_path):
        raise FileExistsError(f"{path} is there already: another job writes this table")
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(aside)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(aside, hadoop_path):
        fs.delete(aside, False)
        raise FileExistsError(f"{path} is there already: another job writes this table")


def metadata_path(path: str) -> str:
    """A listed path as `_metadata.file_path` spells it: one slash after 'file:'."""
    return re.sub(r"^file:/+", "file:/", path)


def ranked(rows: DataFrame, paths: list[str], column: str = "__path") -> DataFrame:
    """Add `seq_part`, the file's rank in `paths` (load order), to rows with their path."""
    if len(paths) == 1:
        return rows.withColumn("seq_part", F.lit(0))
    order = [(path, i) for i, path in enumerate(paths)]
    ranks = rows.sparkSession.createDataFrame(order, f"{column} string, seq_part int")
    # The driver has listed the files; Spark, which cannot tell how few they are, would shuffle all rows.
    return rows.join(F.broadcast(ranks), column)


def positioned(rows: DataFrame, part: F.Column | int = 0, block: F.Column | int = 0) -> DataFrame:
    """Stamp position columns on freshly read rows, before anything shuffles them.

    `monotonically_increasing_id` alone depends on how splits are packed into
    tasks; together with the file and the split's byte offset its order does not.
    """
    as_column = [F.lit(v) if isinstance(v, int) else v for v in (part, block)]
    return (
        rows.withColumn("seq_part", as_column[0].cast("int"))
        .withColumn("seq_block", as_column[1].cast("bigint"))
        .withColumn("seq_row", F.monotonically_increasing_id())
    )


def ordered_by(rows: DataFrame, order: str) -> DataFrame:
    """Position columns for rows that carry their own order column."""
    return (
        rows.withColumn("seq_part", F.lit(0))
        .withColumn("seq_block", F.shiftright(F.col(order).cast("bigint"), 20))
        .withColumn("seq_row", F.col(order).cast("bigint"))
    )


def from_source(rows: DataFrame, rank: int) -> DataFrame:
    return rows.withColumn("seq_source", F.lit(rank))
