"""Extra feeds listed in a manifest: file, format, target table, column mapping."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.functions.text import blank_to_null
from tallyhouse.sources.files import exists
from tallyhouse.sources.rules import carried, normalise_manifest_rows, nothing
from tallyhouse.sources.text import UNKNOWN, Hints, read_delimited, read_documents


def read_manifest(spark: SparkSession, folder: str) -> list[Mapping[str, Any]]:
    path = f"{folder}/manifest.json"
    if not exists(spark, path):
        return []
    content = read_documents(spark, [path]).first()["content"]
    return json.loads(content).get("additional_loaders", [])


def entry_path(folder: str, file: str) -> str | None:
    """Where an entry points, None when that is outside the manifest's folder."""
    scheme, mark, root = folder.rpartition("://")
    root = posixpath.normpath(root)
    path = posixpath.normpath(posixpath.join(root, file))
    return f"{scheme}{mark}{path}" if path.startswith(root.rstrip("/") + "/") else None


def entry_delimiter(spec: Mapping[str, Any]) -> str | None:
    """None for a format this loader does not read."""
    kind = (spec.get("format") or "csv").lower()
    if kind in ("tsv", "tab"):
        return "\t"
    return (str(spec.get("delimiter") or ",") or ",") if kind == "csv" else None


def project(rows: DataFrame, spec: Mapping[str, Any]) -> DataFrame:
    """Source headers → the entry's target columns, then the table's row rules."""
    columns = [str(c) for c in spec["columns"]]
    mapping = spec.get("column_map")
    if mapping:
        # A target that is named twice takes the later header.
        header_of = {target: header for header, target in mapping.items() if target in columns}
        present = set(rows.columns)
        rows = rows.select(
            *[
                blank_to_null(header_of[c]).alias(c)
                if header_of.get(c) in present
                else nothing().alias(c)
                for c in columns
            ],
            *carried(rows),
        )
    return normalise_manifest_rows(rows, table_name(spec))


def table_name(spec: Mapping[str, Any]) -> str:
    return str(spec["table"]).split(".")[-1]


def load_entry(
    spark: SparkSession, folder: str, spec: Mapping[str, Any], hints: Hints = UNKNOWN
) -> DataFrame | None:
    """Rows of one entry, None when the entry is to be skipped."""
    if not spec.get("file") or not spec.get("table") or not spec.get("columns"):
        return None
    path, delimiter = entry_path(folder, spec["file"]), entry_delimiter(spec)
    if path is None or delimiter is None or not exists(spark, path):
        return None
    mapping = spec.get("column_map")
    headers = list(dict.fromkeys(mapping)) if mapping else [str(c) for c in spec["columns"]]
    rows = read_delimited(spark, [path], headers, delimiter, hints)
    return None if rows is None else project(rows, spec)
