"""Parquet tables of the three layers under one root folder."""

from __future__ import annotations

import contextlib
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart import schemas as S
from tallymart.session import observed, shuffles_freed
from tallymart.sources.snapshots import Folder, Snapshot, SnapshotLog, Transaction

BUCKET = "bucket"


@dataclass(frozen=True)
class Table:
    schema: T.StructType
    partition_by: tuple[str, ...] = field(default=())
    # Rows alike in these columns share files; a hot value is split by size.
    gather_by: tuple[str, ...] = field(default=())
    # Rows are dealt into buckets by these columns; an upsert rewrites only buckets it touches.
    bucket_by: tuple[str, ...] = field(default=())
    buckets: int = 64

    @property
    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    @property
    def folders(self) -> tuple[str, ...]:
        return (BUCKET,) if self.bucket_by else self.partition_by


TABLES = {
    "bronze/raw_transactions": Table(S.bronze_schema("raw_transactions"), ("_batch_id",)),
    "bronze/raw_inventory": Table(S.bronze_schema("raw_inventory"), ("_batch_id",)),
    "bronze/raw_stores": Table(S.bronze_schema("raw_stores"), ("_batch_id",)),
    "bronze/run_events": Table(S.RUN_EVENT_SCHEMA),
    "bronze/run_steps": Table(S.RUN_STEP_SCHEMA),
    "quarantine/raw_transactions": Table(
        S.quarantine_schema("raw_transactions"), ("_batch_id",), gather_by=("reject_rule",)
    ),
    "quarantine/raw_inventory": Table(
        S.quarantine_schema("raw_inventory"), ("_batch_id",), gather_by=("reject_rule",)
    ),
    "quarantine/raw_stores": Table(
        S.quarantine_schema("raw_stores"), ("_batch_id",), gather_by=("reject_rule",)
    ),
    "quarantine/metrics": Table(S.METRIC_SCHEMAS["quarantine"], ("_batch_id",)),
    "quarantine/recovered": Table(S.METRIC_SCHEMAS["recovered"], ("_batch_id",)),
    # What became of every row that was held, only ever added to.
    "quarantine/changes": Table(S.METRIC_SCHEMAS["changes"], ("_batch_id",)),
    "quarantine/rejected_records": Table(S.REJECTED_RECORD_SCHEMA, ("_batch_id", "source_table")),
    "silver/stores": Table(S.SILVER_SCHEMAS["stores"], bucket_by=("store_id",), buckets=8),
    "silver/inventory": Table(S.SILVER_SCHEMAS["inventory"], bucket_by=("store_id", "product_id")),
    "silver/transactions": Table(
        S.SILVER_SCHEMAS["transactions"], ("txn_month",), gather_by=("txn_month",)
    ),
    # Beside silver transactions: which keys its months hold, and what its rows add to gold and
    # checks. They are small, so their folders are years.
    "silver/transaction_filters": Table(S.METRIC_SCHEMAS["filters"], ("txn_year",), gather_by=("txn_year",)),
    "silver/transaction_metrics": Table(S.METRIC_SCHEMAS["transactions"], ("txn_year",), gather_by=("txn_year",)),
    "gold/daily_store_sales": Table(
        S.GOLD_SCHEMAS["daily_store_sales"], ("sales_month",), gather_by=("sales_month",)
    ),
    "gold/inventory_health": Table(
        S.GOLD_SCHEMAS["inventory_health"], ("snapshot_date",), gather_by=("snapshot_date",)
    ),
}


# Characters that Spark writes as %XX in the names of partition folders.
_ESCAPED = set('"#%\'*/:=?\\\x7f{[]^') | {chr(i) for i in range(1, 32)}


def _folder_name(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))


def _partition_values(partition: str) -> dict[str, str]:
    """``{column: value}`` of a partition's folder name."""
    steps = (step.split("=", 1) for step in partition.split("/") if step)
    return {c: re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), v) for c, v in steps}


@dataclass(frozen=True)
class Segment:
    """Rows that were written once, not yet part of any snapshot."""

    table: str
    name: str
    partitions: tuple[str, ...]
    rows: int
    frame: DataFrame


class LayerStore:
    """Reads and writes the tables of one root folder that all executors can reach.

    What is written outside of ``transaction`` is a commit of its own. Within one, reads see the
    snapshot it began with and its own writes, and everything becomes visible with its commit.
    """

    def __init__(self, spark: SparkSession, root: str, snapshot: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = SnapshotLog(spark, self.root)
        self._pinned = snapshot
        self._open: Transaction | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # --- snapshots ---

    def at(self, number: int) -> LayerStore:
        """The same tables as they were in one snapshot, whatever is committed later."""
        return LayerStore(self.spark, self.root, number)

    def snapshot(self) -> Snapshot:
        if self._open:
            return self._open.view
        return self.log.latest() if self._pinned is None else self.log.at(self._pinned)

    @contextlib.contextmanager
    def transaction(self) -> Iterator[Transaction]:
        """All changes within become visible together at its end, or earlier by ``commit``; an
        error or ``abort`` leaves the tables as they were. One within another joins it."""
        if self._pinned is not None:
            raise RuntimeError("a pinned snapshot can't be changed")
        if self._open:
            yield self._open
            return
        self._open = Transaction(self.log)
        try:
            yield self._open
            if not self._open.done:
                self._open.commit()
        finally:
            self._open = None

    # --- reading ---

    def empty(self, schema: T.StructType) -> DataFrame:
        """No rows, in a form Spark knows to be empty when it plans joins."""
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return self.spark.range(0).select(*nulls)

    def read(self, name: str, where: Callable[[dict[str, str]], bool] | None = None) -> DataFrame:
        """The table's rows; empty when it was never written. ``where`` picks partitions by their
        values as text: the folders of others aren't even listed."""
        if self._open and not name.startswith("bronze/"):  # bronze rows only change with an intent
            self._open.read |= {name, "intents"}
        parts = self.snapshot().tables.get(name, {})
        chosen = {p: s for p, s in parts.items() if where is None or where(_partition_values(p))}
        return self._read_folders(name, chosen)

    def read_segments(self, name: str, parts: dict[str, list[str]]) -> DataFrame:
        """Rows of the given segments by partition, whether or not a snapshot has them still."""
        return self._read_folders(name, parts)

    def _read_folders(self, name: str, parts: dict[str, list[str]]) -> DataFrame:
        """A folder that is listed and lost is an error, not an empty table."""
        schema = TABLES[name].schema
        base = self.path(name)
        paths = [f"{base}/segment={s}/{p}".rstrip("/") for p, names in sorted(parts.items()) for s in names]
        if not paths:
            return self.empty(schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)

    def partitions(self, name: str) -> list[dict[str, str]]:
        return [_partition_values(p) for p in self.snapshot().tables.get(name, {})]

    def folders_of(self, name: str, values: Sequence[dict[str, str]]) -> list[str]:
        """Partition folders with any of the given values."""
        wanted = [{c: str(v) for c, v in each.items()} for each in values]
        parts = self.snapshot().tables.get(name, {})
        return [p for p in parts if any(w.items() <= _partition_values(p).items() for w in wanted)]

    def segments_of(self, name: str, values: dict[str, str]) -> dict[str, list[str]]:
        """Live segments of the partitions with the given values."""
        parts = self.snapshot().tables.get(name, {})
        return {p: list(s) for p, s in parts.items() if values.items() <= _partition_values(p).items()}

    # --- marks and intents ---

    def mark(self, kind: str, value: str, at=None, **details) -> None:
        with self.transaction() as tx:
            tx.mark(kind, value, details | ({"at": str(at)} if at is not None else {}))

    def marked(self, kind: str) -> dict[str, dict]:
        """Marked values with their details, in the order they were first marked."""
        return self.snapshot().marks.get(kind, {})

    def intents(self) -> dict[str, dict]:
        return self.snapshot().intents

    # --- writing ---

    def write(
        self, df: DataFrame, name: str, segment: str | None = None, values: dict[str, str] | None = None
    ) -> Segment:
        """Write rows as a new segment that no reader sees before it is added to a snapshot.

        ``values`` tell that all rows lie in one partition. They go straight into its folder, where
        a write by partition columns would sort all rows of every task by them first.
        """
        table = TABLES[name]
        segment = segment or uuid.uuid4().hex
        path = f"{self.path(name)}/segment={segment}"
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if values and all(values.get(c) for c in table.folders):
            folder = "/".join(f"{c}={_folder_name(values[c])}" for c in table.folders)
            df = self._gathered(df, name).drop(*table.folders)
            with shuffles_freed(self.spark):
                df.write.mode("errorifexists").parquet(f"{path}/{folder}")
            frame = self._read_folders(name, {folder: [segment]})
            rows = observed(seen, frame.count)
            return Segment(name, segment, (folder,) if rows else (), rows, frame)
        with shuffles_freed(self.spark):
            self._gathered(df, name).write.partitionBy(*table.folders).mode("errorifexists").parquet(path)
        found = [""]
        for _ in table.folders:
            below = [(p, Folder(self.spark, f"{path}/{p}".rstrip("/")).names()) for p in found]
            found = [f"{p}/{n}".lstrip("/") for p, names in below for n in names if "=" in n]
        frame = self._read_folders(name, {p: [segment] for p in found})
        return Segment(name, segment, tuple(found), observed(seen, frame.count), frame)

    def add(self, segment: Segment) -> None:
        with self.transaction() as tx:
            tx.add(segment.table, segment.name, segment.partitions)

    def replace(self, segment: Segment, also: Sequence[dict[str, str]] = ()) -> None:
        """The segment takes the place of its partitions and of those named in ``also``; all
        others stay as they are."""
        gone = [{c: str(v) for c, v in values.items()} for values in also]
        own = set(segment.partitions)
        with self.transaction() as tx:
            tx.drop(segment.table, lambda p: p in own or _partition_values(p) in gone)
            tx.add(segment.table, segment.name, segment.partitions)

    def append(self, df: DataFrame, name: str) -> None:
        self.add(self.write(df, name))

    def replace_partitions(self, df: DataFrame, name: str, also: Sequence[dict[str, str]] = ()) -> None:
        self.replace(self.write(df, name), also)

    def clear_partition(self, name: str, values: dict[str, str]) -> None:
        """Leave the partitions with the given values without rows."""
        wanted = {c: str(v) for c, v in values.items()}
        if not self.segments_of(name, wanted):
            return
        with self.transaction() as tx:
            tx.drop(name, lambda p: wanted.items() <= _partition_values(p).items())

    def replace_all(self, df: DataFrame, name: str) -> None:
        segment = self.write(df, name)
        with self.transaction() as tx:
            tx.drop(name, lambda p: True)
            tx.add(name, segment.name, segment.partitions)

    def write_version(self, df: DataFrame, name: str, version: str) -> DataFrame:
        """A whole new content that readers do not see before ``commit_version``. Every attempt
        needs a name of its own."""
        return self.write(df, name, version).frame

    def commit_version(self, name: str, version: str) -> None:
        table = TABLES[name]
        found = [""]
        for _ in table.folders:
            found = [n for n in Folder(self.spark, f"{self.path(name)}/segment={version}").names() if "=" in n]
        with self.transaction() as tx:
            tx.drop(name, lambda p: True)
            tx.add(name, version, found)

    def _gathered(self, df: DataFrame, name: str) -> DataFrame:
        table = TABLES[name]
        df = df.select(*table.schema.names)
        if table.bucket_by:
            df = df.withColumn(BUCKET, table.bucket)
        if table.gather_by or table.bucket_by:
            df = df.hint("rebalance", *(table.gather_by or (BUCKET,)))
        return df

    # --- upkeep ---

    def compact(self, name: str, most: int = 1) -> int:
        """Put the segments of every partition that has more than ``most`` into one; returns how
        many partitions were rewritten. Rows stay the same, so do older snapshots."""
        crowded = {p: s for p, s in self.snapshot().tables.get(name, {}).items() if len(s) > most}
        if not crowded:
            return 0
        with self.transaction() as tx:
            tx.read.add(name)
            segment = self.write(self._read_folders(name, crowded), name)
            tx.drop(name, lambda p: p in crowded)
            tx.add(name, segment.name, segment.partitions)
        return len(crowded)

    def expire(self, keep: int = 10, grace_hours: float = 24.0) -> tuple[int, int]:
        """Delete all but the last ``keep`` snapshots, and segments that none of those left names.

        Segments written within the grace time stay, as a run may be about to commit them.
        Returns the snapshots and segments deleted. Readers pinned to a kept snapshot go on.
        """
        numbers = self.log.numbers()
        kept = numbers[-keep:]
        live = set().union(*(self.log.at(n).segments() for n in kept)) if kept else set()
        gone = 0
        for name in TABLES:
            folder = Folder(self.spark, self.path(name))
            for entry, age in folder.ages():
                segment = entry.removeprefix("segment=")
                if entry.startswith("segment=") and (name, segment) not in live and age >= grace_hours * 3600:
                    folder.delete(entry)
                    gone += 1
        for n in numbers[:-keep]:
            self.log.forget(n)
        return len(numbers[:-keep]), gone

    def reset(self, layers: tuple[str, ...] = ("bronze", "quarantine", "silver", "gold")) -> None:
        """Empty every table of the given layers, and with bronze what is known of its batches."""
        with self.transaction() as tx:
            if "bronze" in layers:
                for kind in ("batches.loaded", "batches.published", "batches.months", *(f"batches.{f}" for f in S.FEED_COLUMNS)):
                    tx.unmark(kind)
            for name in TABLES:
                if name.split("/")[0] in layers:
                    tx.drop(name, lambda p: True)
            if "silver" in layers or "bronze" in layers:
                for key in list(self.intents()):
                    tx.intend(key, None)
