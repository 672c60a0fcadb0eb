"""Where tables live and how a new state of one becomes visible.

    stg/<table>/batch_id=<n>/      one folder per load, rewritten whole on a retry
    core/<table>/                  pieces cut by hash buckets of the conflict key, see `live`
    marts/<mart>/                  pieces cut by date, see `live`
    rejects/<table>/batch_id=<n>/  refused rows with the reason
    work/batch_id=<n>/             materialised steps of a running load

Everything is Parquet written by executors. A state of a core table or a mart is a list of
live pieces; the next one appears by one rename, so a lost executor or a failed job leaves
the previous state in place, whatever marks Spark leaves behind. A merge writes the rows of
the batch and the pieces that hold one of its keys; all other pieces are kept by reference.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.ids import highest_id
from tallyhouse.operators.staging import REFUSED, with_load_seq
from tallyhouse.plans.live import WRITE, Live, LiveTable, Piece, bucket_of
from tallyhouse.operators.upsert import apply_to
from tallyhouse.reference_data import DICTIONARIES, dictionary
from tallyhouse.schemas import CORE, MART_DATE, MART_SORT, MARTS, staging_columns
from tallyhouse.session import configure
from tallyhouse.sources.files import delete, exists, write_small

# Facts are laid out by date, so window filters skip row groups by their min/max.
CLUSTER = {
    "transactions": ("operation_date", "client_id", "transaction_id"),
    "digital_events": ("event_date", "client_id", "digital_event_id"),
}
# A bucket is meant to hold this many rows; with twice as many a table is cut anew.
BUCKET_ROWS = 4_000_000
# Pieces of a bucket are folded into one when this many of a size class have come together,
# classes being that many times larger each, so a row is rewritten once a class.
FOLD_AT = 8
DONE = "_complete"


def staging_schema(table: str) -> str:
    fields = [f"{c} {'int' if c == 'product_id' else 'string'}" for c in staging_columns(table)]
    return ", ".join([*fields, "loaded_at timestamp", "seq_part int", "seq_block bigint",
                      "seq_row bigint", "seq_source int", *[f"{c} string" for c in REFUSED]])


class Warehouse:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def empty(self, schema: str) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    # staging

    def write_staging(self, table: str, batch_id: int, rows: DataFrame) -> None:
        rows.drop("batch_id").write.mode("overwrite").parquet(
            self.path("stg", table, f"batch_id={batch_id}")
        )

    def staging(
        self, table: str, batch_id: int, refused: bool = False, numbered: bool = True
    ) -> DataFrame:
        """One batch, read by folder: accepted rows with load_seq, or the refused ones.

        Refused rows stay in staging next to their reason. `numbered` is off for
        readers that need no order.
        """
        folder = self.path("stg", table, f"batch_id={batch_id}")
        schema = staging_schema(table)
        if not exists(self.spark, folder):
            rows = self.empty(schema)
            return rows if refused else rows.withColumn("load_seq", F.lit(0).cast("bigint"))
        rows = self.spark.read.schema(schema).parquet(folder)
        if refused:
            return rows.where("reject_reason IS NOT NULL")
        rows = rows.where("reject_reason IS NULL").drop(*REFUSED)
        return with_load_seq(rows) if numbered else rows

    def has_staging(self, table: str, batch_id: int) -> bool:
        return exists(self.spark, self.path("stg", table, f"batch_id={batch_id}"))

    # core

    def _table(self, table: str) -> LiveTable:
        return LiveTable(self.spark, self.path("core", table), "bucket", "int")

    def _schema(self, table: str) -> str:
        return CORE[table].schema if table in CORE else DICTIONARIES[table][1]

    def versions(self, table: str) -> list[int]:
        """Numbers of the states that can be read, oldest first."""
        return self._table(table).numbers()

    def core(self, table: str) -> DataFrame | None:
        """The current state, None when the table was never written."""
        live = self._table(table).live()
        return None if live is None else self._table(table).read(self._schema(table), live)

    def core_or_empty(self, table: str) -> DataFrame:
        current = self.core(table)
        return self.empty(self._schema(table)) if current is None else current

    def highest(self, table: str) -> int:
        """The highest id given out, kept with the state; 0 for a table without rows or ids."""
        live, column = self._table(table).live(), CORE[table].id
        if live is None or not column:
            return 0
        return highest_id(self.core(table), column) if live.highest is None else live.highest

    def _arranged(self, table: str, rows: DataFrame, buckets: int) -> DataFrame:
        """Rows with their bucket, ready to be written: a task writes few buckets, facts sorted by date."""
        key = CORE[table].key if table in CORE else ()
        rows = rows.withColumn("bucket", bucket_of(key, buckets))
        if table in CLUSTER:
            order = ("bucket", *CLUSTER[table])
            return rows.repartitionByRange(*order).sortWithinPartitions(*order)
        return rows.hint("rebalance", "bucket") if buckets > 1 else rows

    def write_core(self, table: str, rows: DataFrame) -> DataFrame:
        """Write the next state whole; it may be computed from the current one."""
        home = self._table(table)
        before = home.live()
        buckets = _buckets(before.total()) if before else 1
        write, slots = home.write(self._arranged(table, rows, buckets))
        after = home.swap(before, Live(buckets=buckets).with_write(slots, write))
        return home.read(self._schema(table), after)

    def merge_core(
        self, table: str, batch: DataFrame, merged: Callable[[DataFrame | None, DataFrame], DataFrame] | None = None
    ) -> DataFrame:
        """Merge a batch with one row per key (stored, as it is read several times); the batch's rows as they are now.

        Only the pieces that hold a key of the batch are read whole and written again, none for
        a table without updated columns; new keys come as pieces of their own. `merged` gives
        the new rows of target rows (None without a target) and batch.
        """
        home, key, updates = self._table(table), list(CORE[table].key), CORE[table].updates
        before = home.live()
        if before is None:
            rows = batch if merged is None else merged(None, batch)
            buckets = _buckets(batch.count())
            write, slots = home.write(self._arranged(table, rows, buckets))
            after = Live(buckets=buckets).with_write(slots, write)
            after = home.swap(None, replace(after, highest=self._raised(table, 0, batch)))
            return home.read(self._schema(table), after)

        hit = self._holding(home, table, batch, before)
        held = home.read(self._schema(table), before, hit)
        if merged is not None:
            gone, rows = hit, merged(held, batch)
        elif updates:
            gone, rows = hit, apply_to(held, batch, key, updates)
        else:
            gone, rows = [], batch.join(held.select(*key), key, "left_anti").select(*held.columns)
        folded = _to_fold(before.without(gone))
        if folded:
            rows = rows.unionByName(home.read(self._schema(table), before, folded))
        write, slots = home.write(self._arranged(table, rows, before.buckets))
        after = before.without([*gone, *folded]).with_write(slots, write)
        after = home.swap(before, replace(after, highest=self._raised(table, self.highest(table), batch)))
        if after.total() > 2 * BUCKET_ROWS * after.buckets:
            self._cut_anew(home, table, after)
            return self.core(table).join(batch.select(*key), key, "left_semi")
        now = [(write, slot) for slot in slots] + [p for p in hit if p in after.rows]
        return home.read(self._schema(table), after, now).join(batch.select(*key), key, "left_semi")

    def _holding(self, home: LiveTable, table: str, batch: DataFrame, live: Live) -> list[Piece]:
        """The pieces that hold a key of the batch; only the keys of the batch's buckets are read."""
        key = list(CORE[table].key)
        keys = batch.select(*key, bucket_of(key, live.buckets).alias("bucket"))
        touched = {f"bucket={r.bucket}" for r in keys.select("bucket").distinct().collect()}  # at most `buckets`
        near = [p for p in live.rows if p[1] in touched]
        if not near:
            return []
        there = home.read(self._schema(table), live, near, extra=("bucket", WRITE)).select(*key, "bucket", WRITE)
        # At most one row a piece.
        found = there.join(keys.select(*key), key, "left_semi").select(WRITE, "bucket").distinct().collect()
        return sorted((f"{WRITE}={r[0]}", f"bucket={r[1]}") for r in found)

    def _raised(self, table: str, highest: int, batch: DataFrame) -> int | None:
        column = CORE[table].id
        return max(highest, highest_id(batch, column)) if column else None

    def _cut_anew(self, home: LiveTable, table: str, live: Live) -> None:
        """Twice the rows, twice the buckets: the one full rewrite, once a doubling."""
        buckets = _buckets(live.total())
        write, slots = home.write(self._arranged(table, home.read(self._schema(table), live), buckets))
        home.swap(live, Live(buckets=buckets, highest=live.highest).with_write(slots, write))

    def seed_dictionaries(self) -> None:
        """Insert missing dictionary rows; only segment names are refreshed."""
        for name in DICTIONARIES:
            rows = dictionary(self.spark, name)
            key = [rows.columns[0]]
            updates = ["segment_type_name", "description"] if name == "segment_types" else []
            current = self.core(name)
            if current is None:
                self.write_core(name, rows)
            elif updates or not rows.join(current, key, "left_anti").isEmpty():
                self.write_core(name, apply_to(current, rows, key, updates))

    def reset(self) -> None:
        """Empty staging, entities, facts and snapshots; dictionaries and marts stay."""
        for folder in ("stg", "work", "rejects"):
            delete(self.spark, self.path(folder))
        for table, spec in CORE.items():
            if table == "client_profile_export":
                delete(self.spark, self.path("core", table))
            else:
                self.write_core(table, self.empty(spec.schema))

    # materialised steps and rejects

    def materialise(self, batch_id: int, name: str, rows: DataFrame) -> DataFrame:
        """Write an intermediate result once, so later steps read it instead of recomputing.

        A step an earlier attempt completed is taken as it is: a repeated load then
        continues with the ids it has already given out.
        """
        folder = self.path("work", f"batch_id={batch_id}", name)
        if not exists(self.spark, f"{folder}/{DONE}"):
            rows.write.mode("overwrite").parquet(folder)
            write_small(self.spark, f"{folder}/{DONE}", "")
        return self.spark.read.schema(rows.schema).parquet(folder)

    def drop_work(self, batch_id: int) -> None:
        delete(self.spark, self.path("work", f"batch_id={batch_id}"))

    def write_rejects(self, table: str, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self.path("rejects", table, f"batch_id={batch_id}"))

    # snapshots and marts

    def profile_export(self) -> DataFrame:
        schema = CORE["client_profile_export"].schema
        return read_dates(self.spark, self.path("core", "client_profile_export"), schema, "report_date")

    def write_profile_export(self, rows: DataFrame, report_date: date) -> int:
        return replace_dates(
            rows, self.path("core", "client_profile_export"), "report_date",
            report_date, report_date, ("client_id",),
        )

    def mart(self, name: str) -> DataFrame:
        return read_dates(self.spark, self.path("marts", name), MARTS[name], MART_DATE[name])

    def write_mart(
        self, name: str, rows: DataFrame, first: date, last: date, now: datetime | None = None
    ) -> int:
        """Replace the dates from `first` to `last` of a mart and return the row count."""
        stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
        shaped = mart_shape(name, rows.withColumn("loaded_at", F.date_trunc("MILLISECOND", stamp)))
        return replace_dates(
            shaped, self.path("marts", name), MART_DATE[name], first, last, MART_SORT[name]
        )


def mart_shape(name: str, rows: DataFrame) -> DataFrame:
    fields = [f.strip().split(" ") for f in MARTS[name].replace(", ", ";").split(";")]
    return rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in fields])


def laid_out(rows: DataFrame, day: str, sort: tuple[str, ...]) -> DataFrame:
    """Rows ready for a write partitioned by `day`.

    Range partitioning over (day, key) cuts a heavy day into several tasks and lets
    light days share one; sorted files give readers narrow min/max ranges.
    """
    return rows.repartitionByRange(day, *sort).sortWithinPartitions(day, *sort)


def replace_dates(
    rows: DataFrame, folder: str, day: str, first: date, last: date, sort: tuple[str, ...]
) -> int:
    """Replace the days of `folder` from `first` to `last` by `rows`; the number of rows written.

    The new days are written aside and the old ones, also those that got no rows, go by the
    same swap of the list: a reader sees all of the range as it was or as it is. Days outside
    the range are not touched.
    """
    home = LiveTable(rows.sparkSession, folder, day, "date")
    before = home.live()
    inside = rows.where((F.col(day) >= F.lit(first)) & (F.col(day) <= F.lit(last)))
    write, slots = home.write(laid_out(inside, day, sort))
    span = f"{day}={first.isoformat()}", f"{day}={last.isoformat()}"
    kept = before or Live()
    home.swap(before, kept.without([p for p in kept.rows if span[0] <= p[1] <= span[1]]).with_write(slots, write))
    return sum(slots.values())


def read_dates(spark: SparkSession, folder: str, schema: str, day: str) -> DataFrame:
    """The rows of a folder whose days are replaced by `replace_dates`, none if it was never written."""
    home = LiveTable(spark, folder, day, "date")
    return home.read(schema, home.live() or Live())


def _buckets(rows: int) -> int:
    """A power of two."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS)))


def _to_fold(live: Live) -> list[Piece]:
    """Pieces of buckets and size classes of which there are too many."""

    def kind(piece: Piece) -> tuple[str, int]:
        return piece[1], int(math.log(max(1, live.rows[piece]), FOLD_AT))

    count = Counter(kind(p) for p in live.rows)
    return sorted(p for p in live.rows if count[kind(p)] >= FOLD_AT)
