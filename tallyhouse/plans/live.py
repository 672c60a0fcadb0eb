"""Tables made of pieces, and the list that says which pieces are live.

    <table>/w=<write>/<slot>/part-….parquet   one folder for each write, cut into slots
    <table>/_live/<number>.json               the list; the highest number counts

A slot is a hash bucket or a day. A write puts new pieces next to the old ones; nobody sees
them until a new list, written aside, gets its number by one rename. So a reader resolves
either the old list or the new one, and pieces the new list leaves alone are kept by
reference. A frame keeps the files it resolved: pieces stay until the list after next.

The list holds a line of counts for each live piece, so it grows with slots, not with rows.
There is one writer at a time; a second one finds its number taken and stops.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.files import children, delete, read_small, write_small

KEPT_LISTS = 2
WRITE = "w"

# (write, slot)
Piece = tuple[str, str]


@dataclass(frozen=True)
class Live:
    """What is live: rows of each slot of each write, and facts the table keeps about itself."""

    number: int = 0
    rows: dict[Piece, int] = field(default_factory=dict)
    cut: dict[str, int] = field(default_factory=dict)  # slots each write was cut into
    buckets: int = 1
    highest: int | None = None  # of the id column, where it is known

    def without(self, pieces: Iterable[Piece]) -> Live:
        gone = set(pieces)
        kept = {p: n for p, n in self.rows.items() if p not in gone}
        return replace(self, rows=kept, cut={w: n for w, n in self.cut.items() if any(p[0] == w for p in kept)})

    def with_write(self, slots: dict[str, int], write: str) -> Live:
        more = {(write, slot): n for slot, n in slots.items()}
        return replace(self, rows=self.rows | more, cut=self.cut | ({write: len(slots)} if slots else {}))

    def total(self) -> int:
        return sum(self.rows.values())

    def folders(self, pieces: Iterable[Piece]) -> list[str]:
        """Relative folders of pieces; a write that is wanted whole is one folder."""
        by_write: dict[str, list[str]] = {}
        for write, slot in pieces:
            by_write.setdefault(write, []).append(slot)
        return [
            folder
            for write, slots in sorted(by_write.items())
            for folder in ([write] if len(slots) == self.cut[write] else [f"{write}/{s}" for s in sorted(slots)])
        ]

    def to_json(self) -> str:
        writes = {w: {"cut": n, "rows": {s: r for (of, s), r in self.rows.items() if of == w}} for w, n in self.cut.items()}
        return json.dumps({"buckets": self.buckets, "highest": self.highest, "writes": writes})

    @staticmethod
    def from_json(number: int, text: str) -> Live:
        found = json.loads(text)
        rows = {(w, s): n for w, write in found["writes"].items() for s, n in write["rows"].items()}
        cut = {w: write["cut"] for w, write in found["writes"].items()}
        return Live(number, rows, cut, found["buckets"], found["highest"])


class LiveTable:
    """One table folder. `slot` is the column its writes are cut by."""

    def __init__(self, spark: SparkSession, folder: str, slot: str, slot_type: str) -> None:
        self.spark, self.folder, self.slot, self.slot_type = spark, folder.rstrip("/"), slot, slot_type

    def numbers(self) -> list[int]:
        """Numbers of the lists that are kept, oldest first."""
        return [int(name[:-5]) for name in children(self.spark, f"{self.folder}/_live", ".json")]

    def live(self) -> Live | None:
        """The current list, None when the table was never written."""
        numbers = self.numbers()
        return self._list(numbers[-1]) if numbers else None

    def _list(self, number: int) -> Live:
        return Live.from_json(number, read_small(self.spark, self._list_path(number)))

    def _list_path(self, number: int) -> str:
        return f"{self.folder}/_live/{number:010d}.json"

    def read(self, schema: str, live: Live, pieces: Iterable[Piece] | None = None, extra: Iterable[str] = ()) -> DataFrame:
        """Rows of the live pieces, or of some of them, with the columns of `schema` and `extra` (slot, write)."""
        folders = live.folders(live.rows if pieces is None else pieces)
        shape = self.spark.createDataFrame([], schema).schema
        columns = [*shape.names, *extra]
        full = schema if self.slot in shape.names else f"{schema}, {self.slot} {self.slot_type}"
        full = f"{full}, {WRITE} string"
        if not folders:
            return self.spark.createDataFrame([], full).select(*columns)
        reader = self.spark.read.schema(full).option("basePath", self.folder)
        return reader.parquet(*[f"{self.folder}/{f}" for f in folders]).select(*columns)

    def write(self, rows: DataFrame) -> tuple[str, dict[str, int]]:
        """Write rows, which carry the slot column, aside: the write's name and the rows of each of its slots."""
        write = f"{WRITE}={uuid.uuid4().hex}"
        path = f"{self.folder}/{write}"
        rows.write.partitionBy(self.slot).parquet(path)
        if not any(name.startswith(f"{self.slot}=") for name in children(self.spark, path)):
            delete(self.spark, path)
            return write, {}
        # One row a slot; only file footers are read.
        counted = self.spark.read.schema(f"{self.slot} string").option("basePath", path).parquet(path).groupBy(self.slot).count()
        return write, {f"{self.slot}={r[0]}": r[1] for r in counted.collect()}

    def swap(self, before: Live | None, after: Live) -> Live:
        """Make `after` the list that follows `before`, and drop what no kept list names."""
        after = replace(after, number=(before.number if before else 0) + 1)
        write_small(self.spark, self._list_path(after.number), after.to_json())
        numbers = self.numbers()
        kept = [self._list(n) for n in numbers[-KEPT_LISTS:]]
        named = {p for live in kept for p in live.rows}
        writes = {w for w, _ in named}
        for number in numbers[:-KEPT_LISTS]:
            gone = [p for p in self._list(number).rows if p not in named and p[0] in writes]
            for write, slot in gone:
                delete(self.spark, f"{self.folder}/{write}/{slot}")
            delete(self.spark, self._list_path(number))
        # Also what jobs that died have left behind.
        for name in children(self.spark, self.folder):
            if name.startswith(f"{WRITE}=") and name not in writes:
                delete(self.spark, f"{self.folder}/{name}")
        return after


def bucket_of(key: Iterable[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int") if buckets > 1 else F.lit(0)
