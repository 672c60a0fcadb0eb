"""Delimited files, lines and whole documents in whatever encoding they come.

Encoding is a property of the content: a UTF-16 byte order mark decides, then
UTF-8 if every byte sequence is valid, else windows-1251.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.elements import END, cut_elements
from tallyhouse.sources.files import file_uri, first_bytes, metadata_path, positioned, ranked
from tallyhouse.sources.records import PLACE, line_ends, read_records

# Byte order marks and the charset each one announces.
UTF16_MARKS = {"FFFE": "UTF-16LE", "FEFF": "UTF-16BE"}
FALLBACK = "windows-1251"
MARK = "\ufeff"
HEAD_READERS = 16
HEAD_BYTES = 1 << 16  # the longest first line
PYTHON_CODEC = {FALLBACK: "cp1251"}


@dataclass(frozen=True)
class TextFile:
    path: str
    encoding: str
    head: str
    quoted_newlines: bool


@dataclass(frozen=True)
class Hints:
    """What is known about files beforehand. Given both, they are not read to find out."""

    encoding: str | None = None
    quoted_newlines: bool | None = None


UNKNOWN = Hints()


def sniff(
    spark: SparkSession, paths: Sequence[str], hints: Hints = UNKNOWN, delimiter: str = ","
) -> list[TextFile]:
    """Encoding, first line and quoting of every non-empty file, in the order given.

    One distributed pass, whatever the number of files: a newline byte is never part of a
    longer UTF-8 sequence, so a file is valid UTF-8 exactly when each of its lines is. A
    quoted field spans lines exactly when some line ends inside a field that began with a
    quote. Quotes inside a field mean nothing. First lines are read by the driver.
    """
    files = listed_files(spark, paths)
    facts = _facts(spark, files, hints, delimiter)

    def by_line(begin: bytes) -> bool:
        return not (hints.encoding or UTF16_MARKS.get(begin.hex().upper(), "")).startswith("UTF-16")

    with ThreadPoolExecutor(HEAD_READERS) as pool:
        heads = list(pool.map(lambda path: first_bytes(spark, path, HEAD_BYTES, by_line), files))
    found = []
    for path, head in zip(files, heads, strict=True):
        if not head:
            continue
        utf8, spans = facts.get(path, (True, False))
        mark = UTF16_MARKS.get(head[:2].hex().upper())
        charset = hints.encoding or mark or ("UTF-8" if utf8 else FALLBACK)
        # A hint may name the charset in any of its spellings.
        text = head.decode(PYTHON_CODEC.get(charset, charset), errors="replace")
        line = re.split(r"\r\n|\r|\n", text.lstrip(MARK), maxsplit=1)[0]
        found.append(TextFile(path, charset, line, spans if hints.quoted_newlines is None else hints.quoted_newlines))
    return found


def listed_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Files in the order given, those of a folder by name, spelled as `_metadata.file_path` does."""
    found = []
    for path in paths:
        single = file_uri(spark, path)
        found += [single] if single else sorted(spark.read.text(path).inputFiles())
    return [metadata_path(f) for f in found]


def _facts(
    spark: SparkSession, files: list[str], hints: Hints, delimiter: str
) -> dict[str, tuple[bool, bool]]:
    if not files or (hints.encoding and hints.quoted_newlines is not None):
        return {}
    lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("path"), "value")
    # Cheap and never false for a line that ends inside, so few lines are taken apart.
    maybe = F.col("value").rlike(rf'(^|{re.escape(delimiter)})"[^"]*+(""[^"]*+)*+$')
    facts = lines.groupBy("path").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.bool_or(F.when(maybe, line_ends(F.col("value"), delimiter)["outside"]).otherwise(False)).alias("spans"),
    )
    return {f["path"]: (f["utf8"], f["spans"]) for f in facts.collect()}  # one row per file


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def read_delimited(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str],
    delimiter: str = ",",
    hints: Hints = UNKNOWN,
    by_position: bool = False,
) -> DataFrame | None:
    """Named columns of delimited files as strings, plus position columns.

    Headers are matched by name, a missing column is NULL and extra ones are not
    parsed. Files that share encoding and header are one scan. `by_position` skips
    the header and names the columns by their place. None when nothing was found.
    """
    files = sniff(spark, paths, hints, delimiter)
    if not files:
        return None
    groups: dict[tuple, list[str]] = defaultdict(list)
    for file in files:
        header = tuple(columns) if by_position else tuple(next(csv.reader([file.head], delimiter=delimiter), ()))
        groups[(file.encoding, header, file.quoted_newlines)].append(file.path)

    parts = []
    for (charset, header, spans), members in groups.items():
        # With a repeated name the last column wins.
        place = {name: f"_c{i}" for i, name in enumerate(header)}
        schema = ", ".join(f"_c{i} string" for i in range(max(1, len(header))))
        options = {"sep": delimiter, "quote": '"', "escape": '"'}
        picked = [F.col(place[c]).alias(c) if c in place else F.lit(None).cast("string").alias(c) for c in columns]
        wide = charset.startswith("UTF-16")  # its bytes cannot be cut at newlines
        if spans and not wide:
            text = F.col("value") if charset == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
            records = read_records(spark, members, delimiter, text)
            fields = F.from_csv("record", schema, options | {"multiLine": "true"})
            rows = records.select(*PLACE, fields.alias("f")).select(*PLACE, "f.*").select(
                *picked, "__path", F.col("__block").alias("seq_block"), F.col("__row").alias("seq_row")
            )
            parts.append(rows)
            continue
        rows = (
            spark.read.schema(schema).options(**options)
            .option("header", True).option("encoding", charset).option("multiLine", wide)
            .csv(members)
            .select(*picked, F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__block"))
        )
        parts.append(positioned(rows, block=F.col("__block")).drop("seq_part", "__block"))
    return ranked(_stack(parts), [f.path for f in files])


def decoded(content: F.Column) -> F.Column:
    """Text of a binary document by the same content rule."""
    mark = F.hex(F.substring(content, 1, 2))
    plain = content.cast("string")
    return (
        F.when(mark == "FFFE", F.decode(F.substring(content, 3, 2**31 - 1), "UTF-16LE"))
        .when(mark == "FEFF", F.decode(F.substring(content, 3, 2**31 - 1), "UTF-16BE"))
        .when(F.is_valid_utf8(plain), F.regexp_replace(plain, f"^{MARK}", ""))
        .otherwise(F.decode(content, FALLBACK))
    )


def read_documents(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per file: `content` and the rank of the file.

    A JSON document has no split points, so a file is the unit of work here.
    """
    return _stack([
        spark.read.format("binaryFile").load(path).select(
            decoded(F.col("content")).alias("content"), F.lit(i).alias("seq_part")
        )
        for i, path in enumerate(paths)
    ])


def read_elements(spark: SparkSession, paths: Sequence[str], path: str) -> DataFrame | None:
    """Elements of the array at `path` in JSON documents: `__json`, position columns, and `__refused`.

    Documents are cut by many tasks at once (`elements`); only those in UTF-16 are decoded
    whole. A refused row has a reason, and in `__json` the text that could not be read.
    """
    files = listed_files(spark, paths)
    if not files:
        return None
    pieces = spark.read.option("lineSep", END).text(files).groupBy(F.col("_metadata.file_path").alias("path"))
    facts = {f["path"]: f["utf8"] for f in pieces.agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8")).collect()}
    wide = [f for f in files if first_bytes(spark, f, 2, lambda begin: False)[:2].hex().upper() in UTF16_MARKS]
    groups = {
        "UTF-8": [f for f in facts if facts[f] and f not in wide],
        FALLBACK: [f for f in facts if not facts[f] and f not in wide],
    }
    parts = []
    for charset, members in groups.items():
        if members:
            text = F.col("value") if charset == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
            parts.append(cut_elements(spark, members, path, text))
    if wide:
        *outer, last = path.split(".")
        schema = f"`{last}`: array<string>"
        for name in reversed(outer):
            schema = f"`{name}`: struct<{schema}>"
        whole = spark.read.format("binaryFile").load(wide).select(
            F.col("_metadata.file_path").alias("__path"), decoded(F.col("content")).alias("content")
        )
        read = whole.withColumn("read", F.from_json("content", f"struct<{schema}, __broken: string>", {"columnNameOfCorruptRecord": "__broken"}))
        broken = F.col("read.__broken").isNotNull()
        items = F.when(broken, F.array("content")).otherwise(F.col("read." + ".".join(f"`{n}`" for n in path.split("."))))
        parts.append(read.select("__path", broken.alias("broken"), F.posexplode(items).alias("at", "__json")).select(
            "__path", F.lit(0).cast("bigint").alias("seq_block"), F.col("at").cast("bigint").alias("seq_row"), "__json",
            F.when(F.col("broken"), F.lit("document is no JSON")).alias("__refused"),
        ))
    return ranked(_stack(parts), files) if parts else None


def read_lines(spark: SparkSession, paths: Sequence[str], hints: Hints = UNKNOWN) -> DataFrame | None:
    """Lines with position columns. UTF-16 files are decoded whole, others split."""
    files = sniff(spark, paths, hints)
    if not files:
        return None
    wide = [f.path for f in files if f.encoding.startswith("UTF-16")]
    parts = []
    for charset in ("UTF-8", FALLBACK):
        members = [f.path for f in files if f.encoding == charset]
        if members:
            value = F.col("value")
            if charset == FALLBACK:
                value = F.decode(value.cast("binary"), FALLBACK)
            rows = spark.read.text(members).select(
                value.alias("line"),
                F.col("_metadata.file_path").alias("__path"),
                F.col("_metadata.file_block_start").alias("__block"),
            )
            parts.append(positioned(rows, block=F.col("__block")).drop("seq_part", "__block"))
    if wide:
        rows = spark.read.format("binaryFile").load(wide).select(
            F.explode(F.split(decoded(F.col("content")), r"\r\n|\r|\n")).alias("line"),
            F.col("_metadata.file_path").alias("__path"),
        )
        parts.append(positioned(rows).drop("seq_part"))
    return ranked(_stack(parts), [f.path for f in files])
