"""Binary files in the folder that driver and executors share.

Tasks write under names of their own and report them as rows. Only rows of committed
tasks are read, so a task that was lost or ran twice leaves a file that nobody names.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyarrow import fs
from pyspark.sql import SparkSession

from tallyhouse.llm.text import scratch


def new_folder(spark: SparkSession, label: str) -> str:
    """A new shared folder as a full URI, whatever the default file system is."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(scratch(spark, label))
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(hadoop)
    uri = system.makeQualified(hadoop).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once a session, however it was started."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(context, "_shipped_tallyhouse", False) or not package.is_dir():
        return
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, str(source.relative_to(package.parent)))
    path = f"{new_folder(spark, 'package')}/{package.name}.zip"
    with writing(path) as out:
        out.write(held.getvalue())
    context.addPyFile(path)
    context._shipped_tallyhouse = True


def unique(folder: str, label: str, ending: str) -> str:
    return f"{folder}/{label}-{uuid.uuid4().hex}.{ending}"


@contextmanager
def writing(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_output_stream(path, compression=None) as out:
        yield out


@contextmanager
def reading(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as data:
        yield data
